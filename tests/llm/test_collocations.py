"""Phrase collocations and their tries against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pillbox.llm import collocations as C
from pillbox.llm.collocations import Trie, collocations, tokens


def brute(rows, least=30, covered=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            for m in range(1, 5):
                f[lang].update(tuple(ws[i : i + m]) for i in range(len(ws) - m + 1))
    out = []
    for lang, counts in f.items():
        good = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in good.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        longer[p[i:j]] = max(longer[p[i:j]], a)
        ranked = []
        for p, a in good.items():
            if longer[p] and 100 * longer[p] >= covered * a:
                continue
            score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for k, (s, a, p, l, r) in enumerate(sorted(ranked)[:top]):
            out.append((lang, k + 1, p.decode(), -a, l, r, n[lang], -s))
    return Counter(out)


def prose(seed, docs):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "a\x01", "a", "é", "É", "日本", "x", "hall", "b\x1fc", "-"]
    fixed = ["new york city hall", "of the", "a\x01 x", "x x x x", "日本 é", "New\tYork"]
    rows = []
    for k in range(docs):
        parts = [rnd.choice(fixed) if rnd.random() < 0.4 else rnd.choice(words) for _ in range(rnd.randint(0, 60))]
        text = "".join(p + rnd.choice([" ", " ", " ", "  ", ".", ", ", "\n", "\t", ";"]) for p in parts)
        rows.append((k, rnd.choice(["en", "en", "de", None, "und", ""]), None if k % 17 == 0 else text))
    return rows


def test_tokens():
    assert tokens("A b\tC.D,,e\n\rf\x0bÉ!".encode()) == [b"a", b"b", b"c", b".", b"d", b".", b".", b"e", b".", b".", b"f", b".", "É".encode(), b"."]
    assert tokens(b"") == [] and tokens(b" \t ") == []


def test_trie():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 40, 30_000).astype(np.int32) * rng.integers(1, 50_000, 1, dtype=np.int32)
    grams = [Counter(map(tuple, np.stack([ids[k : len(ids) - m + 1 + k] for k in range(m)], 1).tolist())) for m in (2, 3, 4)]
    good = [{g: n for g, n in c.items() if n >= 2 and 0 not in g} for c in grams]
    levels = [np.array(sorted(g)) for g in good]
    trie = Trie(levels)
    local, state = trie.start(ids)
    for depth, expected in enumerate(good, 1):
        state = trie.advance(state, local, depth)
        slots, n = np.unique(state[state > 0], return_counts=True)
        rows = trie.spelled(slots)
        assert {tuple(r[: depth + 1]): c for r, c in zip(rows.tolist(), n.tolist())} == expected
        assert not rows[:, depth + 1 :].any()
    # words of several digits: wide nodes, narrow ones and new slots, phrase by phrase
    pairs = np.unique(np.stack([rng.zipf(1.3, 60_000) % 5000, rng.integers(0, 5000, 60_000)], 1) * 77 + 1, axis=0)
    threes = np.unique(np.concatenate([pairs[rng.integers(0, len(pairs), 20_000)], rng.integers(0, 5000, (20_000, 1)) * 77 + 1], 1), axis=0)
    trie = Trie([pairs, threes])
    assert trie.digits == 2 and trie.size < 5 * (len(pairs) + len(threes))
    for rows in (pairs, threes):
        local, state = trie.start(np.append(rows, np.zeros((len(rows), 1), int), 1).ravel())
        for depth in range(1, rows.shape[1]):
            state = trie.advance(state, local, depth)
        slots = state[:: rows.shape[1] + 1]
        assert len(np.unique(slots)) == len(rows) and slots.all() and np.count_nonzero(state) == len(rows)
        assert (trie.spelled(slots)[:, : rows.shape[1]] == rows).all()
    # one node with very many children beside many with one
    wide = np.array([(1, w) for w in range(1, 5000)] + [(w, 1) for w in range(2, 5000)])
    trie = Trie([wide])
    local, state = trie.start(np.array([1, 77, 1, 4999, 0, 3], np.int32))
    assert (trie.advance(state, local, 1) > 0).tolist() == [True, True, True, False, False, False]
    assert Trie([]).start(np.array([1, 2], np.int32))[1].tolist() == [0, 0]


@pytest.mark.parametrize("limits", [{}, {"VOCABULARY": 30, "TRIE": 150, "HELD": 10, "PAIRS": 20, "POSITIONS": 50}])
def test_collocations(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(C, name, value)
    rows = prose(3, 300)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    assert Counter(map(tuple, collocations(docs).collect())) == brute([r[1:] for r in rows])
    assert Counter(map(tuple, collocations(docs, min_count=2, covered_percent=50, top=7).collect())) == brute([r[1:] for r in rows], 2, 50, 7)


def test_collocations_of_awkward_tables(spark, messy):
    rows = [(r.lang, r.text) for r in messy.select("lang", "text").collect()]
    got = collocations(messy)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert Counter(map(tuple, got.collect())) == brute(rows)
    assert collocations(messy.where("doc_id = -1")).collect() == []
    assert collocations(messy.where("text is null")).collect() == []
    assert collocations(messy, min_count=10**6).collect() == []


def test_texts_shorter_than_a_phrase(spark):
    rows = [("en", "a b c"), ("en", "a b"), ("en", "a"), ("de", "a b c d"), ("de", "a b c d")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert Counter(map(tuple, collocations(docs, min_count=1, covered_percent=101).collect())) == brute(rows, 1, 101)


def test_counts_beyond_64_bits_of_a_product(spark):
    """Scores are exact where 2,000,000 * a does not fit 64 bits."""
    huge = 3 * 10**15
    words = spark.createDataFrame([("en", b"a", huge + 1, 1), ("en", b"b", huge + 3, 2)], "lang string, word binary, n long, id long")
    phrases = spark.createDataFrame([(1 << 32 | 2, 0, huge)], "a long, b long, n long")
    row = C.best_phrases(phrases, words, words.drop("id"), 80, 10).first()
    assert row.score == 2_000_000 * huge // (2 * huge + 4) and (row.a, row.l, row.r, row.n) == (huge, huge + 1, huge + 3, 2 * huge + 4)
