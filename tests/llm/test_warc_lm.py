"""WARC round trip and LM scoring."""

import hashlib
import math
import pickle
import zlib
from collections import Counter

import numpy as np
import pytest

from pillbox.llm import lm, warc
from pillbox.llm.queries import BPE_RANKS
from pillbox.session import scratch_path

TRAP = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"


def pages(spark):
    rows = [
        (4, "http://a/", "x" * 150), (2, None, "x" * 150), (7, "u\r\nv", "x" * 150), (7, "again", "x" * 150), (5, "s", "short"), (6, "s", "short"),
        (8, "n", None), (10, "e", ""), (11, "t", TRAP * 3 + "tail"), (12, "w", "WARC/1.0 is a word"), (None, "k", "é" * 80), (13, "k", "é" * 80),
        (None, "z", "z" * 120), (None, "z", "z" * 120), (14, "l", "long " * 200_000), (15, "q", "\r\n\r\nWARC/1.0\r\n"),
    ]
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 200_000)  # several archives
    df = pages(spark)
    path = scratch_path(spark, "test-warc")
    got = Counter(map(tuple, warc.warc_round_trip(df, path).collect()))
    rows = [(r.page_id, (r.html or "").encode()) for r in df.collect()]
    expected = Counter()
    for i, body in rows:
        first = min((j for j, b in rows if b == body and j is not None), default=None)
        again = len(body) >= 100 and first is not None and i != first
        expected[i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None] += 1
    assert got == expected
    raw = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(path + "/part-*").select("content").collect())
    assert raw.count(warc.MAGIC) > len(rows) and raw.startswith(b"WARC/1.0\r\n") and raw.endswith(b"\r\n\r\n")
    assert warc.warc_round_trip(df.where("page_id = -1"), scratch_path(spark, "test-warc")).collect() == []


def test_chain_drops_what_the_start_does_not_reach():
    at, following = np.array([0, 30, 50, 90, 120]), np.array([50, 90, 120, 120, 200])
    assert warc.reachable(at, following).tolist() == [True, False, True, False, True]
    assert warc.reachable(np.array([5, 9]), np.array([9, 20])).tolist() == [False, False]
    assert warc.reachable(np.array([], int), np.array([], int)).tolist() == []
    n = 1000
    assert warc.reachable(np.arange(n), np.arange(1, n + 1)).all()


def test_cut_record_ends_the_chain(spark):
    record = TRAP.encode()
    found = warc.candidates(record + record[:-5])
    assert [f[1] for f in found] == [len(record), -1]


@pytest.fixture(scope="module")
def subwords():
    return lm.Subwords.load(BPE_RANKS)


def naive_score(w, ids):
    """One text, token by token."""
    x, y, d = [lm.START, *ids], [*ids, lm.END], lm.WIDTH
    q, k, v, own = (w["table"][:, i * d : (i + 1) * d].astype(float) for i in range(4))
    total = 0.0
    for t, target in enumerate(y):
        lo = max(0, t // lm.BLOCK * lm.BLOCK - lm.BLOCK)
        s = np.array([q[x[t]] @ k[x[j]] / math.sqrt(d) + w["near"][t - j] for j in range(lo, t + 1)])
        a = np.exp(s - s.max())
        h = np.maximum(own[x[t]] + (a / a.sum()) @ v[x[lo : t + 1]], 0)
        c, m = divmod(target, lm.CLASS)
        for z, i in ((h @ w["to_class"] + w["class_bias"], c), (h @ w["to_member"][c] + w["member_bias"][c], m)):
            total += z[i] - math.log(np.exp(z).sum())
    return total / math.log(10)


def test_lm_against_brute_force(spark, messy, texts, subwords, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 5)  # most words take the way of the rare ones
    used = {}
    trained = lm.train_round
    monkeypatch.setattr(lm, "train_round", lambda *a: used.setdefault(a[-1], trained(*a)))
    rows = lm.lm_score(messy, BPE_RANKS).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    c = Counter(x for i, t in texts if not held(i) for x in tokens(t))
    n, v = sum(c.values()), len(c)
    w = used[lm.ROUNDS - 1]

    def expected(i, t):
        words = tokens(t)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in words)
        return i, held(i), len(words), sum(c[x] > 0 for x in words), n, round(base, 4), float(f"{naive_score(w, lm.subword_ids((t or '').encode(), subwords).tolist()):.3g}")

    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), float(f"{r.score:.3g}")) for r in rows)
    want = Counter(expected(i, t) for i, t in texts)
    assert Counter(k[:6] for k in got.elements()) == Counter(k[:6] for k in want.elements())
    for a, b in zip(sorted(got.elements(), key=str), sorted(want.elements(), key=str)):
        assert a[6] == pytest.approx(b[6], rel=0.01)
    assert lm.lm_score(messy.where("doc_id = -1"), BPE_RANKS).collect() == []


def test_probabilities_add_up(subwords):
    w = lm.initial(np.arange(lm.VOCAB + 2))
    rng = np.random.default_rng(0)
    w = {k: (v + 0.3 * rng.standard_normal(v.shape)).astype(np.float32) if "bias" not in k else v for k, v in w.items()}
    prefix = lm.subword_ids(b"the of and a longer start of a text so that the context is used up", subwords)
    every = [lm.whole(np.append(prefix, i)) for i in range(0, lm.VOCAB)]
    x, y, first, number = lm.blocks_of([(a[:-1], np.append(np.full(len(prefix), -1), b[len(prefix)])) for a, b in every] + [(np.append(lm.START, prefix), np.append(np.full(len(prefix), -1), lm.END))])
    assert np.exp(lm.score_blocks(w, x, y, first)[y.ravel() >= 0]).sum() == pytest.approx(1, abs=1e-3)


def test_gradients(subwords):
    texts = [lm.whole(lm.subword_ids(t, subwords)) for t in (b"a small text with a few words", b"x", b"and one that is longer " * 6)]
    x, y, first, _ = lm.blocks_of(texts)
    w = {k: v.astype(float) for k, v in lm.initial(np.arange(lm.VOCAB + 2)).items()}
    g, _ = lm.gradients(w, x, y, first)
    rng = np.random.default_rng(1)
    for k in w:
        for _ in range(4):
            at = tuple(int(rng.integers(0, s)) for s in w[k].shape) if k != "table" else (int(rng.choice(x.ravel())), int(rng.integers(0, 4 * lm.WIDTH)))
            losses = []
            for e in (1e-5, -1e-5):
                w[k][at] += e
                losses.append(lm.gradients(w, x, y, first)[1])
                w[k][at] -= e
            assert (losses[0] - losses[1]) / 2e-5 == pytest.approx(g[k][at], abs=1e-6)


def test_training_beats_the_counts(spark, subwords):
    from pillbox.llm.common import read

    docs = read(spark, "/root/testdata/sf0.01", "documents")
    train, held = docs.where("doc_id % 5 > 0"), docs.where("doc_id % 5 = 0")
    counts = lm.word_counts(train)
    w = lm.initial(lm.subword_counts(counts, subwords))
    texts = [lm.whole(lm.subword_ids((r.text or "").encode(), subwords)) for r in held.limit(60).collect()]
    x, y, first, _ = lm.blocks_of(texts)
    before = lm.score_blocks(w, x, y, first).sum()
    for r in range(lm.ROUNDS):
        w = lm.train_round(train, w, subwords, r)
    after = lm.score_blocks(w, x, y, first).sum()
    assert after > 0.9 * before  # log probabilities


def test_every_subword_of_the_training_texts_moves(spark, subwords):
    from pillbox.llm.common import read

    texts = read(spark, "/root/testdata/sf0.001", "documents").select("text").repartition(3)
    start = lm.initial(lm.subword_counts(lm.word_counts(texts), subwords))
    w = start
    for r in range(lm.ROUNDS):
        w = lm.train_round(texts, w, subwords, r)
    moved = np.abs(w["table"] - start["table"]).max(axis=1) > 1e-6
    held = {i for t in texts.collect() for i in lm.subword_ids((t.text or "").encode(), subwords).tolist()}
    assert len(held) > 600 and all(moved[i] for i in held)


def test_runs_are_trained_on_once(subwords):
    texts = [b"", b"one", b" ".join(b"w%d" % k for k in range(3 * lm.RUN)), b" ".join(b"v%d" % k for k in range(7 * lm.RUN + 5))]
    trained = []
    for r in range(lm.ROUNDS):
        seen = 0
        for t in texts:
            pairs, seen = lm.lesson(t, subwords, seen, r)
            trained += [i for _, targets in pairs for i in targets.tolist()]
    assert sorted(trained) == sorted(i for t in texts for i in [*lm.subword_ids(t, subwords).tolist(), lm.END])


def test_frequent_words_are_bounded(spark, monkeypatch):
    counts = spark.createDataFrame([(bytes([k]), 1 << (k // 3)) for k in range(30)], "word binary, n long")
    for most in (0, 2, 3, 10, 29, 30, 99):
        monkeypatch.setattr(lm, "FREQUENT", most)
        n = counts.where(f"n >= {lm.frequent_from(counts)}").count()
        assert n <= most and (n == 30 if most >= 30 else n > most - 3)
    assert lm.frequent_from(counts.where("n < 0")) == lm.LAST


def some_blocks(subwords, tokens):
    rng = np.random.default_rng(3)
    words = [b"".join(rng.choice([b"an", b"the", b"er", b"tion", b"x", b"ou"], 3)) for _ in range(500)]
    pairs = []
    while sum(len(t) for _, t in pairs) < tokens:
        pairs.append(lm.whole(lm.subword_ids(b" ".join(rng.choice(words, 32)), subwords)))
    return lm.blocks_of(pairs)[:3]


def test_step_moves_what_the_formula_moves(subwords):
    x, y, first = some_blocks(subwords, 300)
    w = {k: v.astype(float) for k, v in lm.initial(np.arange(lm.VOCAB + 2)).items()}
    adam = lm.Adam({k: v.copy() for k, v in w.items()})
    m, v = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
    rows = np.unique(x)
    for t in (1, 2, 3):
        g, loss = lm.gradients(w, x, y, first)
        assert adam.step(x, y, first) == pytest.approx(loss)
        for k, d in g.items():
            m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.99 * v[k] + 0.01 * d * d
            move = lm.RATE / (1 - 0.9**t) * m[k] / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-6)
            at = rows if k == "table" else ...
            w[k][at] -= move[at]
    for k in w:
        assert np.allclose(adam.w[k], w[k], rtol=1e-4, atol=1e-6)


def test_paths_are_found_once_a_worker(subwords):
    data = pickle.dumps(subwords)
    first = pickle.loads(data)
    first.word(b"foundbefore")
    assert b"foundbefore" in pickle.loads(data).cache


def test_logits_are_cut_where_they_must_be_and_looked_at_elsewhere(monkeypatch):
    rng = np.random.default_rng(5)
    k = np.array([1, 0, 4])
    for dtype in (np.float32, np.float64):
        high = rng.standard_normal((3, 5)).astype(dtype) * 100
        high[0, 1], high[2, 4] = 300, np.nan
        own, sums = lm.exps(high.copy(), k)
        cut = np.minimum(high, lm.TOP)
        assert np.array_equal(own, cut[np.arange(3), k], equal_nan=True) and np.allclose(sums, np.exp(cut).sum(axis=1), equal_nan=True)
        assert np.isfinite(own[0]) and np.isfinite(sums[0]) and np.isnan(sums[2])
        low = np.minimum(rng.standard_normal((3, 5)).astype(dtype), 1)
        with monkeypatch.context() as m:
            m.setattr(lm.np, "minimum", None)
            own, sums = lm.exps(low.copy(), k)
            assert [len(a) for a in lm.exps(low[:0].copy(), k[:0])] == [0, 0]
        assert np.array_equal(own, low[np.arange(3), k]) and np.allclose(sums, np.exp(low).sum(axis=1))


def test_gradients_of_a_step_do_not_reach_the_next(subwords):
    """The steps share the room for their gradients; here each has classes that the others have not."""
    ids = [np.arange(a, a + 3 * lm.CLASS, 3, dtype=np.int16) for a in (0, 1000, 300, 3000)]
    w = {k: v.astype(float) for k, v in lm.initial(np.arange(lm.VOCAB + 2)).items()}
    adam = lm.Adam({k: v.copy() for k, v in w.items()})
    room = adam.found.flat
    m, v = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
    for t, i in enumerate(ids, 1):
        x, y, first, _ = lm.blocks_of([lm.whole(i)])
        g, _ = lm.gradients(w, x, y, first)
        adam.step(x, y, first)
        for k, d in g.items():
            at = np.unique(x) if k == "table" else ...
            m[k][at], v[k][at] = 0.9 * m[k][at] + 0.1 * d[at], 0.99 * v[k][at] + 0.01 * d[at] ** 2
            w[k][at] -= (lm.RATE / (1 - 0.9**t) * m[k] / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-6))[at]
        for k in w:
            assert np.allclose(adam.w[k], w[k], rtol=1e-4, atol=1e-6)
    assert adam.found.flat is room
