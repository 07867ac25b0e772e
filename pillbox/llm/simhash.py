"""SimHash near-dedup on a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints at most
``d`` bits apart differ in at most ``d`` bytes, so they share at least
``8 - d`` (position, byte) entries: the guaranteed minimum.  Pairs that share
single entries are far too many to list (a byte value holds 1/256 of all
rows), so the index is keyed by every choice of ``8 - d`` positions with
their bytes: exactly the pairs that reach the guaranteed minimum meet in a
posting list, and no other pair is ever formed.  In a list the tally of
shared bytes is taken and the bit distance verified.

Postings hold distinct fingerprints, so exact copies cost one entry.  A list
of the index has ``8 - d`` fixed bytes; for d = 2 it holds at most 65,536
fingerprints whatever the size of the corpus.  From each list go only links to the
smallest fingerprint of each linked part, never all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pillbox.llm.common import batch, components, materialise, slices

SMALL = 256  # a list up to this size is compared as a matrix


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, repeats included."""
    words = text.lower().split()  # bytes: A-Z and \x20 \x09-\x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[: len(words) - shingle + 1].tolist()
    ends = (ends[shingle - 1 :] - 1).tolist()
    hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], 42) for s, e in zip(starts, ends)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    def run(batches):
        for b in slices(batches):
            fps = np.array([fingerprint(t or b"", shingle) for t in b.column("text").cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fps.view(np.int64))], names=["id", "fp"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, fp bigint")


def linked(fps: np.ndarray, free: tuple[int, ...], max_bits: int) -> np.ndarray:
    """For the fingerprints of one posting list: the smallest that each is linked to, directly or in steps."""
    n = len(fps)
    if n <= SMALL:
        diff = fps[:, None] ^ fps[None, :]
        shared = 8 - (diff.view(np.uint8).reshape(n, n, 8) != 0).sum(axis=2)  # the tally of shared positional bytes
        near = (shared >= 8 - max_bits) & (np.bitwise_count(diff) <= max_bits)
        low = np.arange(n)
        while True:
            new = np.where(near, low[None, :], n).min(axis=1)
            new = new[new]
            if (new == low).all():
                return fps[low]
            low = new
    # only the free bytes differ: look every neighbour up in a table of their values
    value = np.zeros(n, np.int64)
    for k, p in enumerate(free):
        value |= ((fps >> np.uint64(8 * p)) & np.uint64(255)).astype(np.int64) << (8 * k)
    bits = 8 * len(free)
    place = np.full(1 << bits, -1, np.int64)
    place[value] = np.arange(n)
    flips = [sum(1 << b for b in c) for d in range(1, max_bits + 1) for c in combinations(range(bits), d)]
    low = np.arange(n)
    while True:
        new = low.copy()
        for f in flips:
            other = place[value ^ f]
            hit = other >= 0
            new[hit] = np.minimum(new[hit], low[other[hit]])
        new = new[new]
        if (new == low).all():
            return fps[low]
        low = new


def links(max_bits: int):
    """mapInArrow function: postings sorted by (positions, bytes, fingerprint) -> links a, b."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    free = list(combinations(range(8), max_bits))

    def of(combo, key, fps):
        cut = np.flatnonzero((np.diff(key) != 0) | (np.diff(combo) != 0)) + 1
        starts, ends = np.r_[0, cut], np.r_[cut, len(key)]
        many = ends - starts > 1
        for s, e in zip(starts[many].tolist(), ends[many].tolist()):
            own = np.unique(fps[s:e])
            low = linked(own, free[combo[s]], max_bits)
            m = low != own
            if m.any():
                yield own[m].view(np.int64), low[m].view(np.int64)

    def run(batches):
        held = [np.zeros(0, np.int64)] * 3
        for b in batches:
            new = [b.column(c).to_numpy(zero_copy_only=False).astype(np.int64, copy=False) for c in ("combo", "key", "fp")]
            held = [np.concatenate(x) for x in zip(held, new)]
            combo, key, fp = held
            last = np.flatnonzero((key != key[-1]) | (combo != combo[-1])) if len(key) else []
            cut = int(last[-1]) + 1 if len(last) else 0  # the last list may go on in the next batch
            found = list(of(combo[:cut], key[:cut], fp[:cut].view(np.uint64))) if cut else []
            if found:
                yield batch(schema, *(pa.array(np.concatenate(x)) for x in zip(*found)))
            held = [x[cut:] for x in held]
        if len(held[0]):
            found = list(of(held[0], held[1], held[2].view(np.uint64)))
            if found:
                yield batch(schema, *(pa.array(np.concatenate(x)) for x in zip(*found)))

    return run


def postings(fps: DataFrame, max_bits: int) -> DataFrame:
    """(combo, key, fp): every choice of positions with the bytes there, of distinct fingerprints."""
    entries = []
    for i, free in enumerate(combinations(range(8), max_bits)):
        mask = ((1 << 64) - 1) & ~sum(255 << (8 * p) for p in free)
        signed = mask - (1 << 64) if mask >> 63 else mask
        entries.append(F.struct(F.lit(i).alias("combo"), F.col("fp").bitwiseAND(F.lit(signed)).alias("key")))
    return fps.select(F.explode(F.array(*entries)).alias("e"), "fp").select("e.combo", "e.key", "fp")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (smallest id reachable).

    Words, shingles and hash as in ``fingerprint``; null and wordless texts
    have fingerprint zero and are linked like any other.  Null ids are
    ignored when the smallest id is taken; a component of null ids only has a
    null component_id.  Repeated rows stay repeated.  Only the two named
    columns are read; an empty table gives an empty result.
    """
    if not 0 < max_bits <= 2:
        raise ValueError("max_bits must be 1 or 2: the index bounds a posting list to 65,536 fingerprints for these")
    rows = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = materialise(rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-distinct")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = postings(distinct.select("fp"), max_bits).repartition(parts, "combo", "key").sortWithinPartitions("combo", "key", "fp")
    nodes = components(dealt.mapInArrow(links(max_bits), "a bigint, b bigint"))
    member = distinct.join(nodes, distinct.fp == nodes.node).select("fp", "component", "low")
    # a fingerprint without links is its own component
    label = materialise(member.join(member.groupBy("component").agg(F.min("low").alias("linked_low")), "component").select("fp", "linked_low"), "simhash-labels")
    alone = distinct.join(label, "fp", "left").select("fp", F.when(F.col("linked_low").isNull(), F.col("low")).otherwise(F.col("linked_low")).alias("component_id"))
    return rows.join(alone, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
