"""Exact dedup by Golomb-coded fingerprint exchange.

1. Every task sends, for each owner of a range of fingerprints, its sorted
   distinct fingerprints as Golomb-Rice coded gaps (about ``SPARE_BITS`` + 2
   bits each; a fingerprint that a chunk holds twice is flagged).
2. Each owner decodes the lists it gets and answers every list with a bitmap:
   which of its fingerprints occur more than once anywhere.
3. The marked fingerprints are the suspects.  Only their texts are shuffled,
   and grouped by their bytes.

A text held by a third of all rows is one entry per chunk in step 1, and one
row per task in step 3 (both aggregate before the shuffle).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pillbox.llm.common import batch, materialise, slices

SPARE_BITS = 20  # fingerprint bits beyond log2(rows): one row in 2**20 is a false suspect
CHUNK = 1 << 19  # fingerprints that a task sorts at once
OWNED = 1 << 21  # fingerprints an owner gets on average, at most


def golomb(values: np.ndarray, k: int) -> tuple[bytes, bytes]:
    """Sorted distinct non-negative ints as (unary quotients, k-bit remainders) of their gaps."""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    q, r = (gaps >> np.uint64(k)).astype(np.int64), gaps & np.uint64((1 << k) - 1)
    ends = np.cumsum(q + 1)
    unary = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 1
    rest = (r[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(unary).tobytes(), np.packbits(rest.astype(np.uint8)).tobytes()


def ungolomb(unary: bytes, rest: bytes, k: int, n: int) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    q = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(rest, np.uint8))[: n * k].reshape(n, k).astype(np.uint64)
    r = (bits << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) if k else np.zeros(n, np.uint64)
    return np.cumsum((q.astype(np.uint64) << np.uint64(k)) + r, dtype=np.uint64)


def fingerprint_rows(fp_bits: int | None, with_text: bool):
    """mapInArrow function: (id, [rid], text) -> (id, [rid], fp, sha) or (fp, sha, norm)."""
    schema = pa.schema([("fp", pa.int64()), ("sha", pa.binary()), ("norm", pa.binary())])

    def run(batches):
        for b in slices(batches):
            texts = [(t or b"").lower() for t in b.column("text").cast(pa.binary()).to_pylist()]  # bytes.lower() changes A-Z only
            fps = [xxhash.xxh64_intdigest(t) for t in texts]
            shas = [hashlib.sha256(t).digest() for t in texts]
            if with_text:
                yield batch(schema, [f >> (64 - fp_bits) for f in fps], shas, texts)
            else:
                fps = np.array(fps, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("rid"), pa.array(fps), pa.array(shas, pa.binary())], names=["id", "rid", "fp", "sha"])

    return run


def send(fp_bits: int, owner_bits: int):
    """mapInArrow function: fingerprints of a partition -> one compressed list per chunk and owner."""
    schema = pa.schema([("owner", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("k", pa.int32()), ("unary", pa.binary()), ("rest", pa.binary()), ("twice", pa.binary())])

    def lists(fps: np.ndarray, chunk: int):
        fps, counts = np.unique(fps, return_counts=True)
        width = fp_bits - owner_bits
        owners = (fps >> np.uint64(width)).astype(np.int64)
        cuts = np.searchsorted(owners, np.arange((1 << owner_bits) + 1))
        rows = []
        for o in np.unique(owners):
            lo, hi = cuts[o], cuts[o + 1]
            own = fps[lo:hi] & np.uint64((1 << width) - 1)
            k = max(0, int(math.log2(max(1.0, 0.69 * 2.0**width / len(own)))))
            rows.append((int(o), chunk, len(own), k, *golomb(own, k), np.packbits(counts[lo:hi] > 1).tobytes()))
        return batch(schema, *zip(*rows))

    def run(batches):
        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            fps = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - fp_bits)
            held.append(fps)
            n += len(fps)
            if n >= CHUNK:
                yield lists(np.concatenate(held), (part << 24) + seq)
                seq, held, n = seq + 1, [], 0
        if n:
            yield lists(np.concatenate(held), (part << 24) + seq)

    return run


def own(pdf):
    """applyInPandas function of an owner: its lists -> the bitmap of duplicates for each."""
    lists = [ungolomb(u, r, k, n) for u, r, k, n in zip(pdf.unary, pdf.rest, pdf.k, pdf.n)]
    twice = [np.unpackbits(np.frombuffer(t, np.uint8))[:n].astype(np.int64) for t, n in zip(pdf.twice, pdf.n)]
    _, inverse, = np.unique(np.concatenate(lists), return_inverse=True)
    seen = np.bincount(inverse) + np.bincount(inverse, weights=np.concatenate(twice)).astype(np.int64)
    marks = np.split(seen[inverse] > 1, np.cumsum(pdf.n.to_numpy())[:-1])
    out = pdf[["owner", "chunk"]].copy()
    out["bitmap"] = [np.packbits(m).tobytes() if m.any() else None for m in marks]
    return out[out.bitmap.notna()]


def receive(fp_bits: int, owner_bits: int):
    """mapInArrow function: lists with their bitmaps -> the suspect fingerprints."""
    schema = pa.schema([("fp", pa.int64())])

    def run(batches):
        for b in slices(batches, 64):
            for owner, n, k, unary, rest, bitmap in zip(*(b.column(c).to_pylist() for c in ("owner", "n", "k", "unary", "rest", "bitmap"))):
                marked = np.unpackbits(np.frombuffer(bitmap, np.uint8))[:n].astype(bool)
                fps = ungolomb(unary, rest, k, n)[marked] + np.uint64(owner << (fp_bits - owner_bits))
                yield batch(schema, pa.array(fps.view(np.int64)))

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, row_id.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  Of equal texts the row with the largest id stays; null ids rank
    lowest; of repeated rows with that id exactly one is kept, the one with
    the largest ``row_col`` (a long, unique in the table; one is made up if
    none is named).  Only the named columns are read, so other columns may
    have any name.  An empty table gives an empty result.
    """
    rid = F.col(row_col) if row_col else F.monotonically_increasing_id()
    src = docs.select(F.col(id_col).alias("id"), rid.alias("rid"), F.col(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    rows = materialise(
        src.mapInArrow(fingerprint_rows(None, False), f"id {id_type}, rid bigint, fp bigint, sha binary"),
        "fingerprints",
    )
    n = rows.count()
    fp_bits = min(62, max(1, n).bit_length() + SPARE_BITS)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owner_bits = min(fp_bits - 1, max(1, parts, n // OWNED).bit_length())
    lists = materialise(
        rows.select("fp").mapInArrow(send(fp_bits, owner_bits), "owner bigint, chunk bigint, n bigint, k int, unary binary, rest binary, twice binary"),
        "golomb-lists",
    )
    bitmaps = lists.groupBy("owner").applyInPandas(own, "owner bigint, chunk bigint, bitmap binary")
    suspects = materialise(
        lists.join(bitmaps, ["owner", "chunk"]).mapInArrow(receive(fp_bits, owner_bits), "fp bigint").distinct(), "suspects"
    )
    # the same bits of the same hash in rows and texts: JVM shift of the stored 64-bit value
    of_rows = rows.withColumn("fp", F.shiftrightunsigned("fp", 64 - fp_bits))
    ranked = (
        of_rows.join(suspects, "fp", "left_semi").groupBy("fp", "sha")
        .agg(F.max(F.struct("id", "rid")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    )
    verified = (
        src.select("text").mapInArrow(fingerprint_rows(fp_bits, True), "fp bigint, sha binary, norm binary")
        .join(suspects, "fp", "left_semi")
        .groupBy("fp", "sha", "norm").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("fp", "sha").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"))
    )
    groups = materialise(
        ranked.join(verified, ["fp", "sha"], "left")
        .withColumn("group_size", F.when((F.col("texts") == 1) & (F.col("n") == F.col("group_size")), F.col("group_size"))
                    .otherwise(F.raise_error(F.lit("texts of one fingerprint differ, or the input changed between reads")).cast("bigint")))
        .where("group_size > 1")
        .select("sha", "keep", "group_size"),
        "groups",
    )
    mine = F.struct("id", "rid")
    return rows.join(groups, "sha", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("keep").isNull(), F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (F.col("keep").isNull() | (F.col("keep.rid") == F.col("rid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        F.col("rid").alias("row_id"),
    )
