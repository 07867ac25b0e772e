"""Periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of at least ``MIN_WORDS`` words whose smallest period fits in it at least ``MIN_PERIODS`` times and
that no neighbouring word extends.  Every word of a run with period q stands in it again q words further or nearer, so

1. a word that occurs fewer than ``MIN_PERIODS`` times in its segment is in no run there: it splits the segment;
2. counts are taken anew in the parts, until nothing splits any more.  Parts too short for a run go;
3. periods are taken in doubling ranges.  For periods up to p the occurrences must lie within (MIN_PERIODS - 1) * p
   words, so that a frequent word of a long text splits it as well;
4. in the segments that survive, lag q compares words q apart: first at every (need / 4)-th place, where a run shows at
   four places in a row, then in full around these.  The inside of a known run is left out where the
   periods looked for are small beside it (two runs share fewer words than the sum of their periods).

All texts of a slice are split and scanned together as numpy arrays.  No row meets another, so nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pillbox.llm.common import slices_of_bytes

MIN_WORDS = 24
MIN_PERIODS = 3
FIRST_RANGE = 8  # the largest period of the first range
PROBES = 4


def split(words: np.ndarray, at: np.ndarray, span: int, least: int) -> np.ndarray:
    """The places (of ``at``, ascending) left when rare words split their segments, to stability.

    A segment is a stretch of consecutive places.  A place stays if its word occurs ``MIN_PERIODS`` times within
    ``span`` words of the segment, this place included, and the segment has ``least`` places or more.
    """
    far = MIN_PERIODS - 1
    while len(at):
        segment = np.cumsum(np.diff(at, prepend=at[0]) > 1)
        keep = np.bincount(segment)[segment] >= least
        at, segment = at[keep], segment[keep]
        if not len(at):
            break
        word = words[at]
        key = segment * (int(word.max()) + 1) + word
        order = np.argsort(key, kind="stable")
        key, place = key[order], at[order]
        close = np.flatnonzero((key[far:] == key[:-far]) & (place[far:] - place[:-far] <= span))
        often = np.zeros(len(at), bool)
        for k in range(MIN_PERIODS):
            often[order[close + k]] = True
        if often.all():
            break
        at = at[often]
    return at


def lag_scan(words: np.ndarray, at: np.ndarray, lags: range):
    """(start, end, lag) of every maximal stretch with that period in the segments of ``at`` that is long enough."""
    new = np.diff(at, prepend=at[0] - 2) > 1
    spread = np.arange(len(at)) + np.cumsum(new) - 1  # a separator between segments, equal to nothing
    w = -1 - np.arange(spread[-1] + 1, dtype=np.int64)
    w[spread] = words[at]
    place = np.zeros(len(w), np.int64)
    place[spread] = at
    for q in lags:
        need = max(MIN_WORDS - q, (MIN_PERIODS - 1) * q)  # equal pairs in a run
        if len(w) - q < need:
            break
        step = max(1, need // PROBES)
        probe = w[: len(w) - q : step] == w[q::step]
        n = len(probe) - PROBES + 1
        if n < 1 or np.count_nonzero(probe) < PROBES:
            continue
        chain = probe[:n].copy()
        for k in range(1, PROBES):
            chain &= probe[k : n + k]
        hits = np.flatnonzero(chain)
        if not len(hits):
            continue
        cuts = np.flatnonzero(np.diff(hits) > 1)
        for first, last in zip(hits[np.append(0, cuts + 1)].tolist(), hits[np.append(cuts, len(hits) - 1)].tolist()):
            lo, hi = max(0, first * step - step + 1), min(len(w) - q, (last + PROBES - 1) * step + step)
            edges = np.flatnonzero(np.diff(np.concatenate(([False], w[lo:hi] == w[lo + q : hi + q], [False]))))
            for a, b in edges.reshape(-1, 2).tolist():
                if b - a >= need:
                    start = int(place[lo + a])
                    yield start, start + b - a + q, q


def find_runs(words: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of the runs, sorted; ``at`` has the places of the texts, with a gap between two texts."""
    known: dict[tuple[int, int], int] = {}  # a stretch has its smallest period first: lags only grow
    low, high = 1, FIRST_RANGE
    while True:
        least = max(MIN_WORDS, MIN_PERIODS * low)
        at = split(words, at, len(words), least)
        if not len(at):
            return sorted((s, e, q) for (s, e), q in known.items())
        # a run with a period up to high that is not a known one shares fewer than q + high words with that
        inside = np.zeros(len(words) + 1, np.int64)
        for (s, e), q in known.items():
            if e - s > 2 * (q + high):
                inside[s + q + high] += 1
                inside[e - q - high] -= 1
        here = split(words, at[np.cumsum(inside)[at] == 0], (MIN_PERIODS - 1) * high, least)
        if len(here):
            for s, e, q in lag_scan(words, here, range(low, high + 1)):
                known.setdefault((s, e), q)
        low, high = high + 1, 2 * high


def scan_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words, by start, then period."""
    number = defaultdict(count().__next__)
    sizes = np.array([len(ws) for ws in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.full(int(starts[-1]), -1, np.int64)
    inner = np.ones(len(words), bool)
    inner[starts[1:] - 1] = False
    words[inner] = np.fromiter((number[w] for ws in texts for w in ws), np.int64, int(sizes.sum()))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    runs = find_runs(words, np.flatnonzero(inner))
    for k, (s, e, q) in zip((np.searchsorted(starts, [s for s, _, _ in runs], "right") - 1).tolist(), runs):
        out[k].append((s - int(starts[k]), e - s, q))
    return [sorted(rs, key=lambda r: (r[0], r[2])) for rs in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, joined by a space."""
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            drop[start + period] += 1
            drop[start + length] -= 1
        words = [w for w, d in zip(words, np.cumsum(drop).tolist()) if not d]
    return b" ".join(words)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable | None = None) -> DataFrame:
    """One row per input row: id, n_runs, runs (array of start, length, period), best (one of them), collapsed.

    Words are what ASCII white space separates, numbered from 0.  ``runs`` is sorted by start, then period; ``best`` has
    the greatest exact length / period, of equal ones the smallest start, then period, and is null without a run.
    ``collapsed`` has the words that no run covers behind its first period, joined by a space.  ``rewrite(id, words)``
    may give other words before the scan (a list of bytes).

    A null, empty or blank text has no words: no run, empty ``collapsed``.  Texts are scanned whole, whatever their
    length; a task holds a slice of about a megabyte, or one longer text.  Repeated rows and ids, null ids included,
    each give their own row.  Only the two named columns are read, so others may have any name.  An empty table gives
    an empty result.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["id", "n_runs", "runs", "best", "collapsed"]

    def run(batches):
        for b in slices_of_bytes(batches, "text"):
            ids = b.column("id").to_pylist()
            texts = [(t or b"").split() for t in b.column("text").cast(pa.binary()).to_pylist()]
            if rewrite:
                texts = [rewrite(i, ws) for i, ws in zip(ids, texts)]
            found = scan_texts(texts)
            best = [min(rs, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2])) if rs else None for rs in found]
            as_run = lambda r: dict(zip(("start", "length", "period"), r))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id"),
                    pa.array([len(rs) for rs in found], pa.int64()),
                    pa.array([[as_run(r) for r in rs] for rs in found], pa.list_(RUN)),
                    pa.array([r and as_run(r) for r in best], RUN),
                    pa.array([collapse(ws, rs) for ws, rs in zip(texts, found)], pa.binary()).cast(pa.string()),
                ],
                names=names,
            )

    kind = "struct<start: bigint, length: bigint, period: bigint>"
    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n_runs bigint, runs array<{kind}>, best {kind}, collapsed string")
    return out.withColumnRenamed("id", id_col)
