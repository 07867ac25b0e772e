"""WARC archives: writing pages, and reading back by boundary-chain verification.

Writing: equal payloads (SHA-256) of some size are stored once; the other
records are revisits.  Spark's text writer lays the records out, on any file
system it can write.

Reading: the bytes ``WARC/1.`` also occur inside payloads, so a match proves
nothing.  Each task emits a candidate for every match: its offset, the offset
just behind the record that its header claims, and what the record holds.
For each archive pointer jumping follows these links from the start
of the file, doubling its step every round, and keeps what it reaches.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pillbox.llm.common import materialise

MIN_SHARED = 100  # payload bytes from which equal payloads are stored once
ARCHIVE_BYTES = 16 << 20  # aimed at: an archive is read by one task
# Fixed values of the format.
MAGIC = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HEAD = re.compile(rb"WARC/1\.[01]\r\n((?:[\w-]+:[^\r\n]*\r\n)+)\r\n")
LINE = re.compile(rb"([\w-]+):([^\r\n]*)")
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row.  Of equal payloads of at least ``MIN_SHARED`` bytes the rows with the smallest id are
    responses, the others revisit it; smaller payloads, and groups without any id, are all responses.

    A null html is an empty payload, a null url or id leaves its header out; line breaks in a url are escaped.
    """
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    src = src.withColumns({"size": F.octet_length("html"), "digest": F.sha2("html", 256)})
    groups = materialise(src.groupBy("digest").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size")), "warc-digests")
    total = groups.agg(F.sum(F.col("n") * F.col("size")).alias("bytes"), F.sum("n").alias("n")).first()
    shared = materialise(groups.where((F.col("n") > 1) & (F.col("size") >= MIN_SHARED) & F.col("first_id").isNotNull()).select("digest", "first_id"), "warc-shared")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    block = F.concat(F.lit(HTTP_HEAD), F.when(revisit, "").otherwise(F.col("html")))
    header = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(f"\r\nWARC-Date: {date}\r\n"),
        header("WARC-Record-ID", urn(F.col("id"))),
        header("WARC-Target-URI", F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        header("X-Payload-Length", F.col("size").cast("string")),
        header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        header("WARC-Refers-To", F.when(revisit, urn(F.col("first_id")))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("block").cast("string"),
        F.lit("\r\n\r\n"), F.col("block"), F.lit("\r\n"),  # the line end that the writer adds is the second of the two
    )
    per_file = max(1, int(ARCHIVE_BYTES // max(1, (total.bytes or 0) / max(1, total.n or 0) + 600)))
    src.join(shared, "digest", "left").withColumn("block", block).select(record.alias("value")).write.option("lineSep", "\r\n").option("maxRecordsPerFile", per_file).text(path)


def candidates(content: bytes) -> list[tuple]:
    """(offset, successor, id, type, refers_to, digest, size) for every match of the magic that a header follows."""
    found, at = [], content.find(MAGIC)
    while at >= 0:
        m = HEAD.match(content, at)
        head = {k.decode().lower(): v.decode("utf-8", "replace").strip() for k, v in LINE.findall(m[1])} if m else {}
        if head.get("content-length", "").isdigit():
            start = m.end()
            stop = start + int(head["content-length"])
            urn = lambda name: (re.findall(r"<urn:page:(.*)>", head.get(name, "")) or [None])[0]  # noqa: B023, E731
            digest, size = head.get("warc-payload-digest", "").removeprefix("sha256:"), head.get("x-payload-length", "")
            if head.get("warc-type") != "revisit":
                body = content[start:stop]
                cut = body.find(b"\r\n\r\n")
                payload = body[cut + 4 :] if cut >= 0 and body.startswith(b"HTTP/") else body
                true = hashlib.sha256(payload).hexdigest()
                digest, size = true if digest in ("", true) else f"{true} differs from {digest}", len(payload)
            whole = content[stop : stop + 4] == b"\r\n\r\n"
            found.append((at, stop + 4 if whole else -1, urn("warc-record-id"), head.get("warc-type"), urn("warc-refers-to"), digest, int(size or 0)))
        at = content.find(MAGIC, at + 1)
    return found


FIELDS = ("at", "next", "id", "record_type", "refers_to", "payload_digest", "payload_bytes")
SCHEMA = "path string, file_bytes bigint, at bigint, next bigint, id string, record_type string, refers_to string, payload_digest string, payload_bytes bigint"


def scan(batches):
    for b in batches:
        for i in range(b.num_rows):
            content = b.column("content")[i].as_buffer().to_pybytes()
            rows = [(b.column("path")[i].as_py(), len(content), *r) for r in candidates(content)]
            if rows:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["path", "file_bytes", *FIELDS])


def reachable(at: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Which records the chain from offset 0 reaches, by pointer jumping.  ``at`` is sorted."""
    n = len(at)
    place = np.searchsorted(at, following)
    jump = np.where((place < n) & (at[np.minimum(place, n - 1)] == following), place, n)
    jump = np.append(jump, n)  # the end points to itself
    seen = np.zeros(n + 1, bool)
    seen[0] = n > 0 and at[0] == 0
    while True:
        new = seen.copy()
        new[jump[np.flatnonzero(seen)]] = True
        jump = jump[jump]
        if (new == seen).all():
            return seen[:n]
        seen = new


def chain(pdf):
    pdf = pdf.sort_values("at")
    keep = reachable(pdf["at"].to_numpy(), pdf["next"].to_numpy())
    return pdf[keep][["path", *FIELDS]]


def read_warc(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, at, next, id, record_type, refers_to, payload_digest, payload_bytes) of every record of the archives.

    Digest and size of a response are taken from its payload; if its header names another digest, both are shown.
    A revisit has those of its header.  A record that is cut off is the last of its chain (next = -1).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    rows = files.mapInArrow(scan, SCHEMA)
    return rows.groupBy("path").applyInPandas(chain, "path string, at bigint, next bigint, id string, record_type string, refers_to string, payload_digest string, payload_bytes bigint")


def warc_round_trip(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write, read back: id, payload_bytes, payload_digest, record_type, refers_to for every record.

    Only the three named columns are read.  An empty table gives an empty result.
    """
    write_warc(pages, path, id_col, url_col, html_col)
    kind = pages.schema[id_col].dataType.simpleString()
    back = read_warc(pages.sparkSession, path, "part-*")
    return back.select(F.col("id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
