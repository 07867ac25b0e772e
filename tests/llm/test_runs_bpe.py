"""Periodic runs against brute force, word-end BPE against the library."""

import hashlib
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pillbox.llm import bpe as B
from pillbox.llm import queries as Q
from pillbox.llm.common import read
from pillbox.llm.periodic_runs import MIN_WORDS, collapse, periodic_runs, scan_texts, split
from tests.conftest import SF_SMALL


def brute_runs(ws):
    number = {w: k for k, w in enumerate(dict.fromkeys(ws))}
    w, seen = np.array([number[x] for x in ws], np.int32), {}
    for q in range(1, len(w) // 3 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], w[:-q] == w[q:], [False]])))
        for i, j in edges.reshape(-1, 2).tolist():
            if j - i + q >= max(24, 3 * q):
                seen.setdefault((i, j - i + q), q)
    return sorted(((s, n, q) for (s, n), q in seen.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, words):
    words = Q.made_periodic(doc_id, words)
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    return (
        doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def planted(rnd):
    words = []
    kinds = rnd.choice([1, 2, 3, 5, 50])
    for _ in range(rnd.randint(0, 6)):
        base = [b"%d" % rnd.randrange(kinds) for _ in range(rnd.randint(1, rnd.choice([3, 10, 40])))]
        x = base * rnd.randint(1, 9)
        words += x[: rnd.randint(1, len(x))]
        if rnd.random() < 0.3:
            words.append(b"u%d" % rnd.randrange(3))
    return words


def test_runs_of_random_words():
    rnd = random.Random(1)
    for _ in range(400):
        docs = [planted(rnd) for _ in range(rnd.randint(1, 6))]
        assert scan_texts(docs) == [brute_runs(d) for d in docs]
    # a run whose inside is cut out for larger periods, beside and within others
    long = [b"x"] * 700 + [b"y", b"z"] * 90 + ([b"x"] * 40 + [b"y"]) * 8 + [b"q%d" % (k % 61) for k in range(400)]
    assert scan_texts([long, long[::-1]]) == [brute_runs(long), brute_runs(long[::-1])]
    assert scan_texts([]) == [] and scan_texts([[], [b"a"]]) == [[], []]


def test_rare_words_split_to_stability():
    # 9 splits; then only two 7s are left in each part and split too, and so on until nothing is left
    words = np.array(([1, 2, 7] * 2 + [9]) * 12)
    assert len(split(words, np.arange(len(words)), len(words), MIN_WORDS)) == len(words)
    assert len(split(words, np.arange(len(words)), 10, MIN_WORDS)) == 0
    once = np.concatenate([np.arange(100) % 5, [77], np.arange(20) % 4])
    assert split(once, np.arange(len(once)), len(once), MIN_WORDS).tolist() == list(range(100))


def test_collapse():
    words = [b"%d" % (k % 3) for k in range(26)] + [b"end"]
    assert collapse(words, [(0, 26, 3)]) == b"0 1 2 end" and collapse([], []) == b""


def test_periodic_query(spark, messy, texts):
    docs = read(spark, SF_SMALL, "documents")
    rows = Q.op12_periodic_runs(spark, SF_SMALL).collect()
    assert Counter(map(tuple, rows)) == Counter(brute_row(r.doc_id, (r.text or "").encode().split()) for r in docs.collect())
    assert sum(r.n_runs > 0 for r in rows) > len(rows) // 20
    got = Counter((r.doc_id, r.n_runs, tuple(tuple(x) for x in r.runs), r.collapsed) for r in periodic_runs(messy).collect())
    expected = Counter()
    for i, t in texts:
        ws = (t or "").encode().split()
        runs = brute_runs(ws)
        expected[i, len(runs), tuple(runs), collapse(ws, runs).decode()] += 1
    assert got == expected
    assert periodic_runs(messy.where("doc_id = -1")).collect() == []


@pytest.fixture(scope="module")
def bpe():
    return B.compile_vocabulary(Q.WORD_BPE)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(Q.WORD_BPE)


def same(bpe, library, texts):
    for t, ids, ref in zip(texts, bpe.encode_texts(texts), library.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert ids.tolist() == ref.ids
        assert bpe.decode(ids) == library.decode(ref.ids, skip_special_tokens=False)


def test_bpe_equals_the_library(bpe, library):
    same(bpe, library, [
        "", None, " \t", "don't it's 12ab!?'s ''d we'll I'VE", "a\x1cb\x85c d", "ΑΣ Σ. ΣΣ", "é İ Å ǅ", "a՘b \U000323b0Ᲊ",
        "<|endoftext|>x <|startoftext|>  <|endoftext|", "<|ENDOFTEXT|> <|endoftext|><|endoftext|>", "日本語" * 90, "🙂" * 300, "½²Ⅷ٣ x1y2", "\u0000�",
    ])
    for text in ("a" * 1000, "ab" * 5000, "=-" * 700, "x" * 30_000, "the" * 999, "thethen" * 300, "!" * 65, "z" * 64, "etaoin" * 11):
        same(bpe, library, [text, text + " " + text, "q" + text])


def test_joins_grow_until_both_sides_agree(bpe, library, monkeypatch):
    rnd = random.Random(8)
    monkeypatch.setattr(B, "LEAF", 5)
    monkeypatch.setattr(B, "WINDOW", 1)
    for letters in ("ab", "aei", "thean", "etaoinshr", "abcdefghijklmnopqrstuvwxyz", "éèabc日", "!?*-="):
        same(bpe, library, ["".join(rnd.choice(letters) for _ in range(rnd.choice([6, 40, 300, 2000]))) + f"{k}" for k in range(20)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=200), max_size=5))
def test_bpe_of_any_text(texts):
    from tokenizers import Tokenizer

    tools = test_bpe_of_any_text.__dict__
    if "tools" not in tools:
        tools["tools"] = B.compile_vocabulary(Q.WORD_BPE), Tokenizer.from_file(Q.WORD_BPE)
    same(*tools["tools"], texts)


def test_word_cache_starts_anew(bpe, library, monkeypatch):
    monkeypatch.setattr(B, "CACHED", 10)
    for t in ("some words here", "other words there", "some long unsplit " + "xyzzy" * 100, "words here"):
        same(bpe, library, [t, t])


def test_bpe_query(spark, messy, texts, bpe, library):
    docs = read(spark, SF_SMALL, "documents").select("doc_id", "text").collect()

    def digest(i, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        return i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    assert Counter(map(tuple, Q.op13_bpe(spark, SF_SMALL).collect())) == Counter(digest(*r) for r in docs)
    encoded = B.bpe_encode(messy, bpe, decoded=True)
    rows = encoded.collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows) == Counter(
        (i, tuple(x := library.encode(t or "", add_special_tokens=False).ids), library.decode(x, skip_special_tokens=False)) for i, t in texts
    )
    assert Counter(map(tuple, B.bpe_decode(encoded, bpe).collect())) == Counter((r.doc_id, r.decoded) for r in rows)
    nothing = encoded.select("doc_id", F.lit(None).cast("array<bigint>").alias("ids"))
    assert {r.decoded for r in B.bpe_decode(nothing, bpe).collect()} == {""}
    assert B.bpe_encode(messy.where("doc_id = -1"), bpe).collect() == []


def test_other_vocabularies_are_refused(bpe):
    for old, new in (('"dropout": null', '"dropout": 0.1'), ('"NFC"', '"NFD"'), ('"</w>"', '""')):
        changed = bpe.spec.replace(old, new, 1)
        if changed == bpe.spec:
            changed = bpe.spec.replace(old.replace(": ", ":"), new.replace(": ", ":"), 1)
        assert changed != bpe.spec
        with pytest.raises((ValueError, KeyError)):
            B.WordBpe(changed)
