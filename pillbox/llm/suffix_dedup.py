"""Removal of repeated byte strings with run-length indexes (r-index).

A byte goes if a 50-byte string that covers it also starts in a document with
a smaller id.  Every 50-byte window has one minimizer, the 25-gram of
smallest hash in it, which its content alone decides; equal windows therefore
meet under the same minimizer.

1. Tasks send the minimizers' fingerprints, Golomb-coded, to owners of hash
   ranges, which answer with a bitmap of the slots that hold a repeated one.
   All slots together have a fixed size (``FILTER_BITS``); the bitmap only saves
   work, as an unrepeated minimizer that passes it finds no partner later.
2. A task cuts the text around each minimizer that passes: the snippet of the
   windows it stands for.  It sends each distinct snippet once, compressed
   with its neighbours, to the bucket of its minimizer, with where it occurs.  Only
   the first ``POSTED`` places go with it; further ones (a passage that a third of all
   documents hold) wait as rows of their own, dealt out evenly.
   The owners also say which slots hold a hot minimizer, one with ``HOT`` places or
   more (a line of boilerplate between ever different text): its snippets would be
   one index in one task.  They and their places go as rows instead.
3. In a bucket equal snippets are united.  Where a minimizer has several, their
   suffixes are sorted into a run-compressed Burrows-Wheeler transform with suffix
   samples at run ends.  All snippets stream through it in step by LF over the
   runs; the rows they visit give their matching statistics, cut at 50, and
   the smallest id of each match.
   Snippets of hot minimizers are cut into their windows, the smallest id of each
   window is aggregated (combined before the shuffle) and joined back, byte by byte.
4. Rows that waited join the verdict on their snippet (a skewed join that Spark
   splits), marks are gathered by document, and bytes removed.  A bitmap of fixed
   size says which texts have marks; only these are shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pillbox.llm.common import materialise, slices
from pillbox.llm.exact_dedup import golomb, ungolomb

SPAN, GRAM = 50, 25
PER_WINDOW = SPAN - GRAM + 1  # grams in a window
FP_BITS = 48
FILTER_BITS = 28  # slots of the repeat bitmap: 32 MB, whatever the corpus
OWNER_BITS = 8
CHUNK = 1 << 19  # fingerprints that a task sorts at once
PIECE = 1 << 22  # bytes of a text that are hashed at once
HELD = 200_000  # distinct snippets that a task holds before it sends them
HOT = 1 << 14  # places of a minimizer from which its snippets are compared window by window, by a shuffle
COUNTED = (1 << 16) - 1  # a list says so many places of a fingerprint at most
POSTED = 16  # places of a snippet that travel with it, in one part of a task
MARK_BITS = 23  # slots of the bitmap of texts with marks: 1 MB
BLOCK = 1 << 20  # bytes of snippets in one index, at least (the snippets of a minimizer stay together)
LAST = (1 << 63) - 1  # null ids rank last

BYTE_VALUES = np.random.default_rng(25).integers(0, 1 << 63, 256).astype(np.uint64)
LOW_BITS = np.uint64((1 << 24) - 1)
BASE, SPREAD = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)  # odd


def gram_hashes(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every 25-gram: a polynomial modulo 2**64 put together from those of 1, 2, 4, 8 and 16 bytes, then mixed."""
    power = lambda k: np.uint64(pow(BASE, k, 1 << 64))
    n = len(x) - GRAM + 1
    by = {1: BYTE_VALUES[x]}
    for k in (1, 2, 4, 8):
        by[2 * k] = by[k][:-k] * power(k) + by[k][k:]
    h = by[16][:n] * power(8)
    h += by[8][16 : 16 + n]
    h *= power(1)
    h += by[1][24 : 24 + n]
    return spread(h)


def spread(h: np.ndarray) -> np.ndarray:
    """Mixes the bits, in place."""
    h ^= h >> np.uint64(29)
    h *= SPREAD
    h ^= h >> np.uint64(32)
    return h


def minimizers(data: bytes):
    """Yields (fingerprints, first window, number of windows): each minimizer with the run of windows it stands for."""
    for at in range(0, max(len(data) - SPAN + 1, 0), PIECE):
        x = np.frombuffer(data, np.uint8, min(PIECE + SPAN - 1, len(data) - at), at)
        h = gram_hashes(x)
        n = len(h) - PER_WINDOW + 1
        # smallest hash, then leftmost: position in the low bits
        low = h & ~LOW_BITS
        low |= np.arange(len(h), dtype=np.uint64)
        for s in (1, 2, 4, 8):
            low = np.minimum(low[:-s], low[s:])
        low = np.minimum(low[:n], low[PER_WINDOW - 16 : PER_WINDOW - 16 + n])
        first = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
        # the smallest of many hashes is small: mixed once more, fingerprints are spread evenly over owners and slots
        yield spread(h[(low[first] & LOW_BITS).astype(np.int64)]) >> np.uint64(64 - FP_BITS), first + at, np.diff(first, append=n)


def send(batches):
    """Fingerprints of a partition -> one compressed list per chunk and owner."""

    def lists(held):
        fps, counts = np.unique(np.concatenate(held), return_counts=True)
        width = FP_BITS - OWNER_BITS
        cuts = np.searchsorted(fps >> np.uint64(width), np.arange((1 << OWNER_BITS) + 1, dtype=np.uint64))
        rows = []
        for o in np.flatnonzero(np.diff(cuts)):
            own = fps[cuts[o] : cuts[o + 1]] & np.uint64((1 << width) - 1)
            k = max(0, int(np.log2(0.69 * 2.0**width / len(own))))
            seen = counts[cuts[o] : cuts[o + 1]]
            many = zstandard.compress(np.minimum(seen[seen > 1], COUNTED).astype("<u2").tobytes(), 1)
            rows.append((int(o), len(own), k, *golomb(own, k), np.packbits(seen > 1).tobytes(), many))
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["owner", "n", "k", "unary", "rest", "twice", "many"])

    held, n = [], 0
    for b in slices(batches):
        for data in b.column("text").cast(pa.binary()).to_pylist():
            found = [f for f, _, _ in minimizers(data or b"")]
            if found:
                held.append(np.unique(np.concatenate(found)))
                n += len(held[-1])
            if n >= CHUNK:
                yield lists(held)
                held, n = [], 0
    if n:
        yield lists(held)


def own(pdf):
    """An owner's lists -> its slice of the repeat bitmap, and its slots with a hot minimizer."""
    fps = np.concatenate([ungolomb(u, r, k, n) for u, r, k, n in zip(pdf.unary, pdf.rest, pdf.k, pdf.n)])
    seen = np.ones(len(fps), np.int64)
    twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8))[:n].astype(bool) for t, n in zip(pdf.twice, pdf.n)])
    seen[twice] = np.concatenate([np.frombuffer(zstandard.decompress(m), "<u2") for m in pdf.many])
    order = np.argsort(fps)
    fps, seen = fps[order], seen[order]
    starts = np.flatnonzero(np.append(True, fps[1:] != fps[:-1]))
    total, slot = np.add.reduceat(seen, starts), (fps[starts] >> np.uint64(FP_BITS - FILTER_BITS)).astype(np.int64)
    slots = np.zeros(1 << (FILTER_BITS - OWNER_BITS), bool)
    slots[slot[total > 1]] = True
    return pdf.iloc[:1][["owner"]].assign(slots=[np.packbits(slots).tobytes()], hot=[np.unique(slot[total >= HOT]).astype(np.int32).tobytes()])


def repeat_filter(src: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The bitmap of slots with a repeated minimizer, always 2 ** FILTER_BITS bits, and the slots with a hot one, ascending.

    Each hot slot stands for ``HOT`` places, and they are no more than there are slots.
    """
    size = 1 << (FILTER_BITS - OWNER_BITS - 3)
    bits, hot = np.zeros(size << OWNER_BITS, np.uint8), []
    sent = src.select("text").mapInArrow(send, "owner int, n bigint, k int, unary binary, rest binary, twice binary, many binary")
    for r in sent.groupBy("owner").applyInPandas(own, "owner int, slots binary, hot binary").toLocalIterator():
        bits[r["owner"] * size : (r["owner"] + 1) * size] = np.frombuffer(bytes(r["slots"]), np.uint8)
        hot.append(np.frombuffer(bytes(r["hot"]), np.int32) + np.int32(r["owner"] << (FILTER_BITS - OWNER_BITS)))
    return bits, np.sort(np.concatenate([np.zeros(0, np.int32), *hot]))


CUT = "bucket int, blob binary, fp bigint, key bigint, id bigint, text_hash bigint, at bigint, windows int, low bigint, snippet binary"
JUDGED = "fp bigint, key bigint, id bigint, text_hash bigint, at bigint, windows int, low bigint, mask bigint, snippet binary"


def rows_of(schema: str, **columns) -> pa.RecordBatch:
    """A batch of the schema; columns that are not given are null."""
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    n = len(next(iter(columns.values())))
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds[k]) if c in columns else pa.nulls(n, kinds[k]) for c, k in fields], names=[c for c, _ in fields])


def planes(a: np.ndarray) -> bytes:
    """64-bit numbers byte by byte: the bytes that hardly differ stand together and compress to nothing."""
    return np.ascontiguousarray(a.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(data: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, 8 * n).reshape(8, n).T).view(np.int64).ravel()


def pack(fps: np.ndarray, snippets: list[bytes], counts: np.ndarray, places: np.ndarray) -> bytes:
    """Snippets sorted by fingerprint, with how many places each has, and the places (id, text hash, offset)."""
    head = np.array([len(fps), len(places)], np.int64).tobytes()
    sizes = bytes(map(len, snippets)) + counts.astype(np.uint8).tobytes()
    body = planes(np.diff(fps, prepend=0)) + b"".join(planes(places[:, i]) for i in range(3)) + b"".join(snippets)
    return zstandard.ZstdCompressor(level=3).compress(head + sizes + body)


def unpack(blob: bytes) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """(fps, snippets, number of places of each, places)"""
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(data, np.int64, 2).tolist()
    sizes, counts = np.frombuffer(data, np.uint8, n, 16), np.frombuffer(data, np.uint8, n, 16 + n)
    at = 16 + 2 * n
    fps = np.cumsum(unplanes(data[at : at + 8 * n], n))
    at += 8 * n
    places = np.stack([unplanes(data[at + 8 * m * i : at + 8 * m * (i + 1)], m) for i in range(3)], axis=1)
    at += 24 * m
    ends = at + np.cumsum(sizes.astype(np.int64))
    return fps, [data[e - k : e] for e, k in zip(ends.tolist(), sizes.tolist())], counts.astype(np.int64), places


def key_of(snippet: bytes) -> int:
    k = xxhash.xxh64_intdigest(snippet)
    return k - (1 << 64) if k >> 63 else k


def cut(shared, buckets: int):
    """mapInArrow function: texts -> a blob of snippets for each bucket, and the places that wait (blob null)."""

    def send_off(number: dict[bytes, int], fps: list[int], own: list[int], docs: list[np.ndarray]):
        snippets, fps, own = list(number), np.array(fps, np.int64), np.array(own, np.int64)
        # snippets by bucket and fingerprint, places by snippet and id: the smallest ids stay with the snippet
        order = np.lexsort((fps, fps % buckets))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        places = np.concatenate(docs)
        by = np.lexsort((places[:, 0], rank[own]))
        own, places = rank[own][by], places[by]
        starts = np.searchsorted(own, np.arange(len(order) + 1))
        fps = fps[order]
        hot = is_hot(fps)
        late = (np.arange(len(own)) - starts[own] >= POSTED) | hot[own]
        posted = np.concatenate([[0], np.cumsum(np.where(hot, 0, np.minimum(np.diff(starts), POSTED)))])
        early = places[~late]
        alone = np.flatnonzero(hot)  # these travel as rows, each with the smallest id it has here
        if len(alone):
            yield rows_of(
                CUT, bucket=(alone % buckets).astype(np.int32), fp=fps[alone], key=[key_of(snippets[i]) for i in order[alone].tolist()],
                low=places[starts[alone], 0], snippet=[snippets[i] for i in order[alone].tolist()],
            )
        cold = np.flatnonzero(~hot)
        order_cold, counts = order[cold], np.diff(posted)[cold]
        posted = np.concatenate([[0], np.cumsum(counts)])
        cuts = np.searchsorted(fps[cold] % buckets, np.arange(buckets + 1))
        at = np.flatnonzero(np.diff(cuts))
        blobs = [
            pack(fps[cold[a:b]], [snippets[i] for i in order_cold[a:b].tolist()], counts[a:b], early[posted[a] : posted[b]])
            for a, b in zip(cuts[at].tolist(), cuts[at + 1].tolist())
        ]
        if len(at):
            yield rows_of(CUT, bucket=at.astype(np.int32), blob=blobs)
        late = np.flatnonzero(late)
        for i in range(0, len(late), 1 << 16):
            part = late[i : i + (1 << 16)]
            which = [snippets[k] for k in order[own[part]].tolist()]
            doc, text_hash, offset = places[part].T
            yield rows_of(
                CUT, bucket=(np.arange(len(part)) % buckets).astype(np.int32), fp=fps[own[part]], key=list(map(key_of, which)), id=doc,
                text_hash=text_hash, at=offset, windows=np.array(list(map(len, which)), np.int32) - SPAN + 1,
            )

    def is_hot(fps: np.ndarray) -> np.ndarray:
        hot = shared.value[1]
        if not len(hot):
            return np.zeros(len(fps), bool)
        slot = fps >> (FP_BITS - FILTER_BITS)
        return hot[np.minimum(np.searchsorted(hot, slot), len(hot) - 1)] == slot

    def run(batches):
        bits = shared.value[0]
        number: dict[bytes, int] = {}  # a snippet's content decides its minimizer
        all_fps, own, docs = [], [], []
        for b in slices(batches, 256):
            for doc, text_hash, data in zip(b.column("id").to_pylist(), b.column("text_hash").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                for fps, first, windows in minimizers(data or b""):
                    slot = (fps >> np.uint64(FP_BITS - FILTER_BITS)).astype(np.int64)
                    hit = np.flatnonzero((bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1)
                    if not len(hit):
                        continue
                    first = first[hit]
                    last = first + windows[hit] + (SPAN - 1)
                    for f, a, z in zip(fps[hit].tolist(), first.tolist(), last.tolist()):
                        snippet = data[a:z]
                        k = number.get(snippet)
                        if k is None:
                            k = number[snippet] = len(all_fps)
                            all_fps.append(f)
                        own.append(k)
                    place = np.empty((len(first), 3), np.int64)
                    place[:, 0], place[:, 1], place[:, 2] = doc, text_hash, first
                    docs.append(place)
            if len(all_fps) >= HELD or len(own) >= 4 * HELD:
                yield from send_off(number, all_fps, own, docs)
                number, all_fps, own, docs = {}, [], [], []
        if own:
            yield from send_off(number, all_fps, own, docs)

    return run


class RunIndex:
    """r-index of a list of strings: run-compressed BWT of their collection, LF over runs, suffix samples at run ends.

    Suffixes are ordered as if each string ended in a mark of its own, marks smaller than bytes and in string order.
    """

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) for s in strings])
        text = np.frombuffer(b"".join([s + b"\0" for s in strings]), np.uint8).astype(np.int64) + 1
        self.ends = np.cumsum(sizes + 1) - 1
        text[self.ends] = 0
        n, longest = len(text), int(sizes.max()) + 1
        self.string = np.repeat(np.arange(len(strings)), sizes + 1)
        self.left = self.ends[self.string] - np.arange(n)  # bytes up to the mark
        # ranks by the first 7 symbols, nothing behind a mark; then doubled, where suffixes still tie
        key = np.zeros(n, np.int64)
        for k in range(7):
            key = (key << 9) | np.where(self.left >= k, np.concatenate([text[k:], np.zeros(k, np.int64)]), 0)
        rank, tied = self._ranked(np.arange(n), key, np.zeros(n, np.int64))
        width, self.ranks = 7, {7: rank}
        while width < longest:
            if len(tied):
                key = np.where(self.left[tied] >= width, rank[np.minimum(tied + width, n - 1)], -1)
                rank = rank.copy()
                rank[tied], again = self._ranked(tied, key, rank[tied])
                tied = tied[again]
            width *= 2
            self.ranks[width] = rank
        order = np.argsort(rank, kind="stable")  # equal up to their marks: by string
        before = np.where(order > 0, text[order - 1], 0)
        before[self.left[order] == sizes[self.string[order]]] = 0  # a string's start follows a mark
        # runs of the transform, with where LF takes their first row, and samples of their ends
        self.run_at = np.flatnonzero(np.diff(before, prepend=-1))
        heads, lengths = before[self.run_at], np.diff(self.run_at, append=n)
        by_head = np.argsort(heads, kind="stable")
        self.lf = np.empty(len(heads), np.int64)
        self.lf[by_head] = np.concatenate([[0], np.cumsum(lengths[by_head])[:-1]])
        self.samples = order[self.run_at], order[self.run_at + lengths - 1]
        self.order, self.sizes = order, sizes

    @staticmethod
    def _ranked(items: np.ndarray, key: np.ndarray, old: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the items by (old rank, key), and which still tie; a rank is that of the first of its equals."""
        order = np.lexsort((key, old)) if old.any() else np.argsort(key, kind="stable")
        k, o = key[order], old[order]
        new_group = np.append(True, o[1:] != o[:-1])
        new = new_group | np.append(True, k[1:] != k[:-1])
        at = np.arange(len(order))
        start = np.maximum.accumulate(np.where(new, at, 0))
        group = np.maximum.accumulate(np.where(new_group, at, 0))
        ranks = np.empty(len(order), np.int64)
        ranks[order] = o + start - group
        alone = new & np.append(new[1:], True)
        return ranks, np.sort(order[~alone])

    def step(self, rows: np.ndarray) -> np.ndarray:
        """LF: from suffixes to those one byte longer."""
        run = np.searchsorted(self.run_at, rows, "right") - 1
        return self.lf[run] + rows - self.run_at[run]

    def intervals(self, span: int) -> np.ndarray:
        """For every row the number of its interval: rows whose suffixes share their first ``span`` bytes."""
        width = max(w for w in self.ranks if w <= span)
        a = self.ranks[width][self.order]
        b = self.ranks[width][np.minimum(self.order + span - width, len(self.order) - 1)]
        long = self.left[self.order] >= span
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & long[1:] & long[:-1]
        return np.concatenate([[0], np.cumsum(~same)])


def repeated_windows(strings: list[bytes], ids: np.ndarray) -> list[int]:
    """For each string the bit mask of its windows that a string with a smaller id holds."""
    index = RunIndex(strings)
    interval = index.intervals(SPAN)
    starts = np.flatnonzero(np.diff(interval, prepend=-1))
    smallest = np.minimum.reduceat(ids[index.string[index.order]], starts)
    masks = np.zeros(len(strings), np.int64)
    todo = np.arange(len(strings))
    rows = todo.copy()  # the marks are the first rows, in order of the strings
    for length in range(1, int(index.sizes.max()) + 1):
        going = index.sizes[todo] >= length
        todo, rows = todo[going], index.step(rows[going])
        if length >= SPAN:
            hit = smallest[interval[rows]] < ids[todo]
            masks[todo[hit]] |= np.int64(1) << (index.sizes[todo[hit]] - length)
    return masks.tolist()


def verdicts(fps: np.ndarray, snippets: list[bytes], low: np.ndarray) -> np.ndarray:
    """Masks of distinct snippets, sorted by fingerprint, with the smallest id of each: see ``repeated_windows``."""
    masks = np.zeros(len(fps), np.int64)
    same = fps[1:] == fps[:-1]
    several = np.flatnonzero(np.append(same, False) | np.append(False, same))  # a lone snippet has nothing but itself
    size = np.cumsum([len(snippets[i]) for i in several.tolist()])
    start = 0
    while start < len(several):
        stop = int(np.searchsorted(size, (size[start - 1] if start else 0) + BLOCK)) + 1
        while stop < len(several) and fps[several[stop]] == fps[several[stop - 1]]:
            stop += 1
        part = several[start:stop]
        masks[part] = repeated_windows([snippets[i] for i in part.tolist()], low[part])
        start = stop
    return masks


def judge(batches):
    """mapInArrow function: blobs and waiting rows, sorted by bucket -> marks (fp null), verdicts (low given), waiting rows."""

    def of(blobs: list[bytes]):
        parts = [unpack(x) for x in blobs]
        number: dict[tuple[int, bytes], int] = {}
        own = [number.setdefault(k, len(number)) for fps, snippets, _, _ in parts for k in zip(fps.tolist(), snippets)]
        counts = np.concatenate([c for _, _, c, _ in parts])
        places = np.concatenate([p for _, _, _, p in parts])
        order = sorted(number, key=lambda k: k[0])  # distinct snippets by fingerprint
        rank = np.empty(len(number), np.int64)
        rank[[number[k] for k in order]] = np.arange(len(number))
        own = rank[own]
        of_place = np.repeat(own, counts)
        fps, snippets = np.array([k[0] for k in order], np.int64), [k[1] for k in order]
        low = np.full(len(order), LAST, np.int64)
        np.minimum.at(low, of_place, places[:, 0])
        masks = verdicts(fps, snippets, low)
        whole = (np.int64(1) << (np.array(list(map(len, snippets))) - SPAN + 1)) - 1
        mark = np.where(places[:, 0] > low[of_place], whole[of_place], masks[of_place])
        m = mark != 0
        if m.any():
            yield rows_of(JUDGED, id=places[m, 0], text_hash=places[m, 1], at=places[m, 2], mask=mark[m])
        full = np.unique(own[counts == POSTED])  # others have no place that waits
        if len(full):
            yield rows_of(JUDGED, fp=fps[full], key=[key_of(snippets[i]) for i in full.tolist()], low=low[full], mask=masks[full])

    bucket, blobs = None, []
    for b in batches:
        late = b.filter(pc.is_null(b.column("blob")))
        if late.num_rows:
            yield rows_of(JUDGED, **{c: late.column(c) for c in ("fp", "key", "id", "text_hash", "at", "windows", "low", "snippet")})
        for k, blob in zip(b.column("bucket").to_pylist(), b.column("blob").to_pylist()):
            if blob is not None:
                if k != bucket and blobs:
                    yield from of(blobs)
                    blobs = []
                bucket = k
                blobs.append(blob)
    if blobs:
        yield from of(blobs)


DONE = (("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()))


def unmarked(shared):
    """mapInArrow function: texts without marks are done (and no longer carried), the others stay."""

    def run(batches):
        bits = shared.value
        for b in slices(batches, 256):
            slot = b.column("text_hash").to_numpy() & ((1 << MARK_BITS) - 1)
            marked = ((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            out = [(None,) * 4 if m else (len(t), 0, 0, hashlib.sha256(t).hexdigest()) for t, m in zip(texts, marked)]
            kept = pa.array([t if m else None for t, m in zip(texts, marked)], pa.binary())
            done = [pa.array([r[i] for r in out], k) for i, (_, k) in enumerate(DONE)]
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("id"), b.column("text_hash"), kept, *done], names=["doc", "id", "text_hash", "text", *(n for n, _ in DONE)])

    return run


def strike(batches):
    """mapInArrow function: texts with their marks -> what is removed and kept."""
    for b in slices(batches, 256):
        out = list(zip(*(b.column(n).to_pylist() for n, _ in DONE)))
        for i, (data, ats, masks) in enumerate(zip(b.column("text").to_pylist(), b.column("ats").to_pylist(), b.column("masks").to_pylist())):
            if data is None:
                continue
            if not ats:  # another text has the slot
                out[i] = (len(data), 0, 0, hashlib.sha256(data).hexdigest())
                continue
            bits = (np.array(masks, np.int64)[:, None] >> np.arange(PER_WINDOW)) & 1
            starts = (np.array(ats, np.int64)[:, None] + np.arange(PER_WINDOW))[bits.astype(bool)]
            edges = np.bincount(starts, minlength=len(data) + 1) - np.bincount(starts + SPAN, minlength=len(data) + 1)
            gone = np.cumsum(edges)[:-1] > 0
            spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            out[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column("doc"), *(pa.array([r[i] for r in out], k) for i, (_, k) in enumerate(DONE))], names=["doc", *(n for n, _ in DONE)])


def hot_verdicts(judged: DataFrame) -> DataFrame:
    """(fp, key, low, part) of the snippets of hot minimizers: the smallest id of a snippet, and the windows that a smaller id holds."""
    snippets = judged.where("snippet is not null").groupBy("fp", "key").agg(F.min("low").alias("low"), F.min("snippet").alias("snippet"))
    snippets = materialise(snippets, "hot")
    windows = snippets.select("fp", "key", "low", F.explode(F.expr(f"sequence(0, octet_length(snippet) - {SPAN})")).alias("i"), "snippet")
    windows = windows.select("fp", "key", "low", "i", F.expr(f"substring(snippet, i + 1, {SPAN})").alias("w"))
    first = windows.groupBy("w").agg(F.min("low").alias("first"))
    held = windows.join(first, "w").where(F.col("first") < F.col("low"))
    parts = held.groupBy("fp", "key").agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("part"))
    return snippets.select("fp", "key", "low").join(parts, ["fp", "key"], "left").withColumn("part", F.coalesce("part", F.lit(0).cast("bigint")))


def marks(src: DataFrame) -> DataFrame:
    """(id, text_hash, ats, masks): the removed windows of every text that has one; bit i of a mask is the window at + i."""
    spark = src.sparkSession
    buckets = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shared = spark.sparkContext.broadcast(repeat_filter(src))  # 2 ** FILTER_BITS bits, and the hot slots
    sent = src.mapInArrow(cut(shared, buckets), CUT).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    judged = materialise(sent.mapInArrow(judge, JUDGED), "judged")
    direct = judged.where("fp is null").select("id", "text_hash", "at", "mask")
    late = judged.where("windows is not null").select("fp", "key", "id", "text_hash", "at", "windows")
    known = judged.where("low is not null and snippet is null").select("fp", "key", "low", F.col("mask").alias("part"))
    late = late.join(known.unionByName(hot_verdicts(judged)), ["fp", "key"])
    late = late.select("id", "text_hash", "at", F.when(F.col("id") > F.col("low"), F.expr("shiftleft(1L, windows) - 1")).otherwise(F.col("part")).alias("mask"))
    every = direct.union(late.where("mask <> 0"))
    # a set: copies with one id (null ids are equal) name the same windows, so the list is bounded by the text
    return every.groupBy("id", "text_hash").agg(F.collect_set(F.struct("at", "mask")).alias("m")).select("id", "text_hash", F.col("m.at").alias("ats"), F.col("m.mask").alias("masks"))


def mark_filter(removed: DataFrame) -> np.ndarray:
    """The bitmap of texts with marks: always 2 ** MARK_BITS bits, in 256 rows."""
    slot = F.col("text_hash").bitwiseAND(F.lit((1 << MARK_BITS) - 1)) + 1
    rows = removed.groupBy(F.bitmap_bucket_number(slot).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    out = np.zeros(1 << (MARK_BITS - 3), np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["b"] - 1) * 4096 : (r["b"] - 1) * 4096 + len(part)] = part
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) for every row.

    A null text counts as empty; texts under 50 bytes lose nothing.  Ids are
    integers; rows with equal ids do not remove each other's bytes; a null id is larger
    than any other, and null ids are equal.  Only the two named columns are read;
    an empty table gives an empty result.
    """
    src = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    removed = materialise(marks(src.drop("doc")), "marks")
    kind = src.schema["doc"].dataType.simpleString()
    done = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    shared = src.sparkSession.sparkContext.broadcast(mark_filter(removed))  # 2 ** MARK_BITS bits
    rows = src.mapInArrow(unmarked(shared), f"doc {kind}, id bigint, text_hash bigint, text binary, {done}")
    both = rows.join(removed, ["id", "text_hash"], "left")
    return both.mapInArrow(strike, f"doc {kind}, {done}").withColumnRenamed("doc", id_col)
