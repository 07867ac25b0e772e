"""Exact dedup, SimHash and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from pillbox.llm import exact_dedup as E
from pillbox.llm import simhash as H
from pillbox.llm import suffix_dedup as S
from pillbox.llm.common import components


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for k in (0, 1, 7, 31):
        v = np.unique(rng.integers(0, 1 << 34, 400)).astype(np.uint64) if k > 20 else np.unique(rng.integers(0, 3000, 400)).astype(np.uint64)
        assert (E.ungolomb(*E.golomb(v, k), k, len(v)) == v).all()


def test_exact_dedup(messy, texts):
    rows = E.exact_dedup(messy).collect()
    groups = defaultdict(list)
    for i, t in texts:
        groups[lower(t)].append(i)
    assert len(rows) == len(texts)
    expected = Counter()
    for t, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        for i in ids:
            expected[i, best, len(ids), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == expected
    assert Counter(r.text_sha256 for r in rows if r.kept) == Counter(hashlib.sha256(t.encode()).hexdigest() for t in groups)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, bits=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                root[find(a)] = find(b)
    low = defaultdict(list)
    for k, i in enumerate(ids):
        low[find(k)].append(i)
    return [min((i for i in low[find(k)] if i is not None), default=None) for k in range(len(ids))]


def test_simhash(messy, texts):
    fps = [fingerprint(t) for _, t in texts]
    expected = Counter((i, f"{f:016x}", c) for (i, _), f, c in zip(texts, fps, brute_components([i for i, _ in texts], fps)))
    assert Counter(map(tuple, H.simhash_dedup(messy).collect())) == expected
    with pytest.raises(ValueError):
        H.simhash_dedup(messy, max_bits=3)


def test_simhash_links_chains_and_full_lists(spark, monkeypatch):
    rnd = random.Random(2)
    seeds = [rnd.getrandbits(64) for _ in range(6)]
    fps = []
    for s in seeds:
        for _ in range(80):  # walks of up to three flips, so chains form
            fps.append(s)
            for b in rnd.sample(range(64), rnd.randint(0, 3)):
                s ^= 1 << b
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    expected = brute_components(signed, fps)
    for small in (256, 1):  # both ways to compare a posting list
        monkeypatch.setattr(H, "SMALL", small)
        own = spark.createDataFrame([(f,) for f in set(signed)], "fp long")
        dealt = H.postings(own, 2).repartition(5, "combo", "key").sortWithinPartitions("combo", "key", "fp")
        found = {r.node: r.component for r in components(dealt.mapInArrow(H.links(2), "a long, b long")).collect()}
        assert {f: found.get(f, f) for f in signed} == dict(zip(signed, expected))


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (7, 7), (200, 200), (None, 5)] + [(300, 301 + k) for k in range(50)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, **{300 + k: 300 for k in range(51)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_removal(docs):
    first = {}
    key = [(S.LAST if i is None else i, (t or "").encode()) for i, t in docs]
    for i, t in sorted(key):
        for k in range(len(t) - 49):
            first.setdefault(t[k : k + 50], i)
    out = []
    for (i, _), (rank, t) in zip(docs, key):
        gone = bytearray(len(t))
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < rank:
                gone[k : k + 50] = b"\1" * 50
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return Counter(out)


def test_remove_repeats(messy, texts):
    assert Counter(map(tuple, S.remove_repeats(messy).collect())) == brute_removal(texts)


@pytest.mark.parametrize("hot", [S.HOT, 3])  # 3: nearly all repeated minimizers go by rows
def test_remove_repeats_of_pasted_passages(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "HELD", 50)  # snippets are sent in several parts
    monkeypatch.setattr(S, "POSTED", 2)  # most places wait for the verdict
    monkeypatch.setattr(S, "BLOCK", 4000)  # and several indexes are built
    monkeypatch.setattr(S, "PIECE", 300)  # and texts are hashed in pieces
    rnd = random.Random(4)
    base = ["".join(rnd.choice("abc de") for _ in range(400)) for _ in range(5)]
    docs = [
        (rnd.randint(0, 90), "".join(rnd.choice([rnd.choice(base)[rnd.randint(0, 300) :][: rnd.randint(20, 200)], "".join(rnd.choice("abcé ") for _ in range(40))]) for _ in range(rnd.randint(0, 6))))
        for _ in range(150)
    ]
    docs += [(100 + k, "x" * (45 + k)) for k in range(12)] + [(200, "y" * 120), (200, "y" * 120), (201, "y" * 49), (202, "y" * 50)]
    got = Counter(map(tuple, S.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()))
    assert got == brute_removal(docs)


def test_a_phrase_between_ever_different_text(spark, monkeypatch):
    """One minimizer with a snippet for each of many documents: it makes no index, and its windows are compared by a shuffle."""
    monkeypatch.setattr(S, "HOT", 100)
    monkeypatch.setattr(S, "HELD", 200)
    rnd = random.Random(14)
    noise = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    phrase = "ALL RIGHTS RESERVED (C) EXAMPLE"  # 31 bytes: never a repeated window by itself
    docs = [(k, noise(60) + phrase + noise(60)) for k in range(400)]
    docs += [(1000 + k, noise(30) + t[30:110] + noise(20)) for k, (_, t) in enumerate(docs[:25])]  # and with it, repeated windows
    docs += [(None, docs[3][1])] * 5 + [(3, docs[3][1].upper())]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bits, slots = S.repeat_filter(table)
    assert len(slots) >= 1 and all(bits[k >> 3] >> (7 - (k & 7)) & 1 for k in slots.tolist())
    limit = S.verdicts

    def small(fps, snippets, low):
        assert len(snippets) < 1 or np.unique(fps, return_counts=True)[1].max() < 100, "a hot minimizer came to an index"
        return limit(fps, snippets, low)

    monkeypatch.setattr(S, "verdicts", small)
    got = Counter(map(tuple, S.remove_repeats(table).collect()))
    assert got == brute_removal(docs)
    assert sum(r[2] > 0 for r in got) >= 25


def test_run_index():
    rnd = random.Random(6)
    strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 75))) for _ in range(80)] + [b"a" * 70, b"a" * 70, b""]
    index = S.RunIndex(strings)
    suffixes = sorted(((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1)), key=lambda x: (x[0] + b"\0", x[1]))
    starts = np.cumsum([0, *(len(s) + 1 for s in strings)])
    assert index.order.tolist() == [int(starts[k]) + i for _, k, i in suffixes]
    row = {int(p): r for r, p in enumerate(index.order)}
    inside = [p for p in row if index.left[p] < index.sizes[index.string[p]]]
    assert index.step(np.array([row[p] for p in inside])).tolist() == [row[p - 1] for p in inside]
    first, last = index.samples
    assert len(first) == len(last) < len(index.order)


@pytest.mark.parametrize("run", [E.exact_dedup, H.simhash_dedup, S.remove_repeats])
def test_empty_table(messy, run):
    assert run(messy.where("doc_id = -1")).collect() == []


def test_pack_round_trip():
    rnd = random.Random(8)
    fps = sorted(rnd.getrandbits(48) for _ in range(40))
    snippets = [bytes(rnd.randrange(256) for _ in range(rnd.randint(50, 75))) for _ in fps]
    places = [[(rnd.choice([0, 5, S.LAST, -3]), rnd.getrandbits(63) - (1 << 62), rnd.randrange(1 << 40)) for _ in range(rnd.randint(1, 16))] for _ in fps]
    got = S.unpack(S.pack(np.array(fps), snippets, np.array(list(map(len, places))), np.array([x for p in places for x in p])))
    assert got[0].tolist() == fps and got[1] == snippets and got[2].tolist() == list(map(len, places))
    assert list(map(tuple, got[3].tolist())) == [x for p in places for x in p]


def test_mark_filter_holds_every_text(spark):
    rnd = random.Random(9)
    hashes = [rnd.getrandbits(64) - (1 << 63) for _ in range(3000)] + [0, -1, (1 << S.MARK_BITS) - 1, 1 << S.MARK_BITS]
    bits = S.mark_filter(spark.createDataFrame([(h,) for h in hashes], "text_hash long"))
    slots = {h & ((1 << S.MARK_BITS) - 1) for h in hashes}
    assert all(bits[s >> 3] >> (s & 7) & 1 for s in slots) and int(np.bitwise_count(bits).sum()) == len(slots)
    assert not S.mark_filter(spark.createDataFrame([], "text_hash long")).any()


def test_repeat_filter_holds_every_repeated_minimizer(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 100)
    rnd = random.Random(10)
    texts = ["".join(rnd.choice("abcdef ") for _ in range(200)) for _ in range(40)]
    texts += [t[20:150] + "!" * 60 for t in texts[:15]] + texts[:3]
    monkeypatch.setattr(S, "HOT", 3)
    bits, hot = S.repeat_filter(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4))
    seen = Counter(f for t in texts for f in {int(f) for fs, _, _ in S.minimizers(t.encode()) for f in fs})
    slot = lambda f: f >> (S.FP_BITS - S.FILTER_BITS)
    marked = lambda f: bits[slot(f) >> 3] >> (7 - (slot(f) & 7)) & 1
    assert all(marked(f) for f, n in seen.items() if n > 1) and sum(bool(marked(f)) for f, n in seen.items() if n == 1) <= 1
    assert set(hot.tolist()) == {slot(f) for f, n in seen.items() if n >= 3} and (np.diff(hot) > 0).all()
