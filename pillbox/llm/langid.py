"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram's vector binds
those of its letters, each permuted by its place (two steps, one step, none).
A text's vector bundles (adds) its trigrams; a language's prototype bundles
the texts of that language.  A text gets the language whose prototype is
nearest by cosine.

Tasks bundle what they read and send one vector a language, so training data
of any size and any mix of sources gathers a few rows.  Prototypes are
languages x ``DIMS`` numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pillbox.llm.common import numbered_columns, numbered_types, others, slices

DIMS = 1024
SEED = 7
PIECE = 1 << 20  # characters of a text that are turned into trigrams at once
ROWS = 128  # texts bundled by one matrix product
UNKNOWN = "und"


def letters(text: str) -> np.ndarray:
    """Code points of the letters of a lower-cased text; each run of anything else is one 0."""
    cps = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    kinds = np.unique(cps)
    alphabetic = kinds[[chr(c).isalpha() for c in kinds.tolist()]] if len(kinds) else kinds
    return one_gap(np.where(np.isin(cps, alphabetic), cps, 0))


def one_gap(x: np.ndarray) -> np.ndarray:
    return x[(x != 0) | np.append(True, x[:-1] != 0)]


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct trigram keys, counts) of the whole text with a 0 at both ends; none if it has no letter.

    Long texts are taken in pieces; the last two letters of a piece go before the next, so that cuts change nothing.
    """
    text = (text or "").lower()
    keys, counts, before, found = [], [], np.zeros(1, np.int64), False
    for i in range(0, len(text), PIECE):
        x = letters(text[i : i + PIECE])
        found = found or bool(x.any())
        x = one_gap(np.concatenate([before, x, np.zeros(int(i + PIECE >= len(text)), np.int64)]))
        k, c = np.unique((x[:-2] << 42) | (x[1:-1] << 21) | x[2:], return_counts=True)
        keys.append(k)
        counts.append(c)
        before = x[-2:]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(keys) == 1:
        return keys[0], counts[0]
    k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)


def trigram_vectors(keys: np.ndarray, cache: dict, dims: int) -> np.ndarray:
    parts = [(keys >> s) & ((1 << 21) - 1) for s in (42, 21, 0)]
    used, inverse = np.unique(np.concatenate(parts), return_inverse=True)
    for c in used.tolist():
        if c not in cache:
            cache[c] = np.random.default_rng([SEED, c]).integers(0, 2, dims).astype(np.int8) * 2 - 1
    items = np.stack([cache[c] for c in used.tolist()])
    a, b, c = np.split(inverse, 3)
    return (np.roll(items, 2, axis=1)[a] * np.roll(items, 1, axis=1)[b] * items[c]).astype(np.float32)


def bundles(texts: list[str | None], cache: dict, dims: int) -> np.ndarray:
    """A vector for each text; zero if it has no letter."""
    grams = [trigrams(t) for t in texts]
    keys, inverse = np.unique(np.concatenate([k for k, _ in grams]), return_inverse=True)
    if not len(keys):
        return np.zeros((len(texts), dims), np.float32)
    counts = np.zeros((len(texts), len(keys)), np.float32)
    counts[np.repeat(np.arange(len(texts)), [len(k) for k, _ in grams]), inverse] = np.concatenate([c for _, c in grams])
    return counts @ trigram_vectors(keys, cache, dims)


def prototypes(labelled: DataFrame, text_col: str, lang_col: str, dims: int = DIMS) -> dict[str, np.ndarray]:
    """Summed vectors by language of all rows with a language and a text.  The result has languages x dims numbers."""

    def bundle(batches):
        cache, sums = {}, {}
        for b in slices(batches, ROWS):
            langs = b.column("lang").to_pylist()
            for lang, v in zip(langs, bundles(b.column("text").to_pylist(), cache, dims).astype(np.float64)):
                sums[lang] = sums.get(lang, 0) + v
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["lang", "v"])

    def add(batches):
        sums = {}
        for b in batches:
            for lang, v in zip(b.column("lang").to_pylist(), b.column("v").to_pylist()):
                sums[lang] = sums.get(lang, 0) + np.frombuffer(v)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["lang", "v"])

    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    parts = rows.mapInArrow(bundle, "lang string, v binary")
    found: dict[str, np.ndarray] = {}
    for r in parts.repartition(8, "lang").mapInArrow(add, "lang string, v binary").collect():
        found[r["lang"]] = found.get(r["lang"], 0) + np.frombuffer(bytes(r["v"]))
    return {k: v for k, v in sorted(found.items()) if np.any(v)}


def predict(docs: DataFrame, protos: dict[str, np.ndarray], text_col: str = "text", dims: int = DIMS) -> DataFrame:
    """The input columns plus lang_pred and score: the nearest prototype (of equal ones the first by name) and its cosine.

    A null text and one without a letter get ``und`` and 0, as does every text if there are no prototypes; a
    negative cosine shows as 0.  Input columns named lang_pred or score are replaced.
    """
    names = list(protos)
    matrix = np.stack([v / np.linalg.norm(v) for v in protos.values()]).astype(np.float32) if names else np.zeros((0, dims), np.float32)
    kept = others(docs, "lang_pred", "score")
    src = docs.select(*numbered_columns(docs, kept), F.col(text_col).alias("text"))

    def run(batches):
        cache = {}
        for b in slices(batches, ROWS):
            v = bundles(b.column("text").to_pylist(), cache, dims)
            norm = np.linalg.norm(v, axis=1)
            cosines = (v @ matrix.T) / np.maximum(norm, 1e-9)[:, None] if names else np.zeros((len(v), 1), np.float32)
            best = cosines.argmax(axis=1)
            known = (norm > 0) & bool(names)
            pred = [names[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            score = np.where(known, np.clip(cosines[np.arange(len(best)), best], 0, 1), 0).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], pa.array(pred), pa.array(score)], names=[*b.schema.names[: len(kept)], "lang_pred", "score"])

    fields = [*numbered_types(docs, kept), "lang_pred string", "score double"]
    return src.mapInArrow(run, ", ".join(fields)).toDF(*kept, "lang_pred", "score")


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held_fold: int = 1, dims: int = DIMS) -> DataFrame:
    """(id, held_out, lang_pred, score) for every row; learns from the rows that are not held out.

    A row is held out if crc32 of its id as text, modulo ``folds``, is ``held_fold``; a null id counts as empty
    text.  Language and id never enter a prediction, so repeated rows are predicted alike.  An empty table gives an
    empty result, and a table without languages ``und`` throughout.
    """
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == held_fold
    src = docs.select(F.col(id_col).alias("id"), held.alias("held_out"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    protos = prototypes(src.where("not held_out"), "text", "lang", dims)
    done = predict(src.select("id", "held_out", "text"), protos, "text", dims)
    return done.select(F.col("id").alias(id_col), "held_out", "lang_pred", "score")
