"""Quality rules, licence scan, language ID, mixing and pieces against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pillbox.llm import langid, pieces
from pillbox.llm.common import read
from pillbox.llm.licenses import BASE, license_scan
from pillbox.llm.mixing import mix_rates, mix_sources, poisson_cdf
from pillbox.llm.quality import CHAR_LIMIT, distance, quality_rules
from pillbox.llm.queries import SENTENCEPIECE_MODEL
from tests.conftest import SF_SMALL


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    seen, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(k, k + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(messy, texts):
    got = Counter((r.doc_id, int(r.n_words), r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules(messy).collect())
    assert got == Counter((i, *(c := counts(t)), c[0] < 10 or 100 * c[4] > 20 * c[0]) for i, t in texts)


def test_quality_on_documents(spark):
    docs = read(spark, SF_SMALL, "documents")
    rows = quality_rules(docs).collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(r.text)
    assert any(not r.kept and not r.base_failed and r.char_distance > CHAR_LIMIT for r in rows)
    filtered = quality_rules(docs).where("kept").select("doc_id").collect()  # a filter pushed into the projection changes nothing
    assert sorted(r.doc_id for r in filtered) == sorted(r.doc_id for r in rows if r.kept)
    # the labelled good documents pass unless the fixed counts fail them
    good = {r.doc_id for r in read(spark, SF_SMALL, "labels").where("quality = 1").collect()}
    assert all(r.kept for r in rows if r.doc_id in good and not r.base_failed)


def test_quality_of_a_fifth_language(spark):
    rnd = random.Random(12)

    def clean(common, letters):
        rare = lambda: "".join(rnd.choice(letters) for _ in range(7))
        return " ".join(rnd.choice(common) if rnd.random() < 0.2 else rare() for _ in range(300)) + "."

    english = clean(["the", "of", "and", "to", "in"], "abcdefghij")
    nordic = [clean(["och", "att", "det", "som", "inte"], "klmnoprstu") for _ in range(6)]
    cyrillic = [clean(["и", "не", "на", "что", "он"], "абвгдежзик") for _ in range(6)]
    junk = "#$% 12 " * 2 + " ".join(f"{k}#$%&*|<>{k}" for k in range(120))
    docs = [(k, t, lang) for k, (t, lang) in enumerate([(english, "en")] * 6 + [(t, "sv") for t in nordic] + [(t, "x.`y") for t in cyrillic] + [(nordic[0], None), (junk, "sv"), (junk, "en")])]
    rows = quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    kept = {r.doc_id: r.kept for r in rows}
    assert not any(r.base_failed for r in rows)
    assert all(kept[k] for k in range(19)) and not kept[19] and not kept[20]


def test_jensen_shannon(spark):
    ref = [3.0, 1.0, 0.0, 4.0]
    for c in ([3.0, 1.0, 0.0, 4.0], [0.0, 0.0, 5.0, 0.0], [1.0, 1.0, 1.0, 1.0], [0.0] * 4):
        got = spark.range(1).select(distance(F.array(*map(F.lit, c)), ref).alias("d")).first().d
        if sum(c):
            p, q = [x / sum(c) for x in c], [x / 8 for x in ref]
            kl = lambda a, b: sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(a, b) if x)
            assert got == pytest.approx(math.sqrt(max(0, (kl(p, q) + kl(q, p)) / 2)), abs=1e-9)
        else:
            assert got == 0


def test_license_base(messy, texts):
    def expected(i, text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        found = [(k, b.label) for b in BASE for k in range(len(words)) if words[k : k + len(b.words)] == b.words]
        at = [k for k, _ in found]
        return i, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))

    rows = license_scan(messy).collect()
    assert Counter((r.doc_id, int(r.n_words), r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == Counter(expected(i, t) for i, t in texts)
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, str(r.labels).split(","))) and 0 <= float(r.score) <= 1


def test_license_notices(spark):
    text = {
        1: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        2: "Permission is hereby granted to any person free of charge",  # the key phrase is broken
        3: "This work is licensed under the GNU General Public License, version 3.",
        4: "general public license of the gnu version 3",  # out of order
        5: "Released under the MIT License. Apache License, Version 2.0",
        6: "version 3",
    }
    rows = {r.doc_id: r for r in license_scan(spark.createDataFrame(list(text.items()), "doc_id long, text string")).collect()}
    assert [rows[i].labels for i in range(1, 7)] == ["mit", "", "gpl-3", "", "apache-2,mit", ""]
    assert rows[3].score >= 0.9 and rows[4].score == 0
    assert [(p.label, p.word) for p in rows[5].places][:2] == [("mit", 1), ("apache-2", 5)]


def test_language_id(spark, messy, texts):
    docs = read(spark, SF_SMALL.replace("0.001", "0.01"), "documents")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = langid.language_id(docs).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    # neither language nor id of a predicted row matters
    protos = langid.prototypes(docs, "text", "lang")
    a = {r.doc_id: (r.lang_pred, round(r.score, 5)) for r in langid.predict(docs, protos).collect()}
    b = {r.doc_id: (r.lang_pred, round(r.score, 5)) for r in langid.predict(docs.withColumn("lang", F.lit("xx")), protos).collect()}
    assert a == b
    rows = langid.language_id(messy).collect()
    assert len(rows) == len(texts)
    letterless = Counter(i for i, t in texts if not any(c.isalpha() for c in t or ""))
    assert Counter(r.doc_id for r in rows if r.lang_pred == "und") == letterless
    assert {r.lang_pred for r in langid.language_id(messy.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_trigrams_of_pieces(monkeypatch):
    text = "The naïve Über 12 x, straße. " * 40
    whole = dict(zip(*(x.tolist() for x in langid.trigrams(text))))
    spelled = re.sub(r"[^a-zäöüßï]+", " ", text.lower()).strip()
    padded = f" {spelled} "
    assert whole == Counter((0 if a == " " else ord(a)) << 42 | (0 if b == " " else ord(b)) << 21 | (0 if c == " " else ord(c)) for a, b, c in zip(padded, padded[1:], padded[2:]))
    assert sum(whole.values()) == len(padded) - 2
    texts = [text, "a", "ab", " ", "..a", "a..", "12 34", "ΟΔΟΣ ΟΔΟΣ.", "a  b", "", None, "x" * 50, "a.b.c.d"]
    expected = [{k: c for k, c in zip(*(x.tolist() for x in langid.trigrams(t)))} for t in texts]
    for piece in (1, 2, 3, 7, 100):  # no cut adds or loses a trigram
        monkeypatch.setattr(langid, "PIECE", piece)
        assert [{k: c for k, c in zip(*(x.tolist() for x in langid.trigrams(t)))} for t in texts] == expected


def test_language_id_against_brute_force(spark):
    """Bundles, prototypes and cosines made letter by letter."""
    docs = read(spark, SF_SMALL, "documents").where("doc_id < 60").select("doc_id", "lang", "text").collect()
    items = {}

    def item(c):
        if c not in items:
            items[c] = np.random.default_rng([langid.SEED, c]).integers(0, 2, langid.DIMS).astype(int) * 2 - 1
        return items[c]

    def bundle(text):
        padded = " " + "".join(c if c.isalpha() else " " for c in (text or "").lower()) + " "
        padded = re.sub(" +", " ", padded)
        out = np.zeros(langid.DIMS, int)
        for gram in zip(padded, padded[1:], padded[2:]):
            a, b, c = (item(0 if x == " " else ord(x)) for x in gram)
            out += np.roll(a, 2) * np.roll(b, 1) * c
        return out

    vectors = {r.doc_id: bundle(r.text) for r in docs}
    protos = {}
    for r in docs:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            protos[r.lang] = protos.get(r.lang, 0) + vectors[r.doc_id]
    rows = {r.doc_id: r for r in langid.language_id(spark.createDataFrame(docs)).collect()}
    for r in docs:
        v = vectors[r.doc_id]
        cosines = {k: float(v @ p / np.linalg.norm(v) / np.linalg.norm(p)) for k, p in protos.items()}
        best = max(cosines.values())
        assert rows[r.doc_id].score == pytest.approx(max(0, best), abs=1e-5)
        assert cosines[rows[r.doc_id].lang_pred] == pytest.approx(best, abs=1e-6)


def test_poisson_inverse(spark):
    for rate in (0.01, 0.7, 5.0, 80.0, 3000.0):
        low, cdf = poisson_cdf(F.lit(rate))
        r = spark.range(1).select(low.alias("low"), cdf.alias("cdf")).first()
        total = 0.0
        for k, c in enumerate(r.cdf, r.low):
            total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
            assert c == pytest.approx(total, abs=1e-9)
        assert r.cdf[-1] == pytest.approx(1, abs=1e-9)


def test_mixing(spark, messy, texts):
    # rates add up to the budget; a given weight is met in the mean
    rates = mix_rates(messy, "source", None, 0.5, 3.0).collect()
    assert sum(r.n * r.rate for r in rates) == pytest.approx(3 * len(texts))
    assert {r.source: r.n * r.rate for r in rates}["a"] / {r.source: r.n * r.rate for r in rates}["b"] == pytest.approx(math.sqrt({r.source: r.n for r in rates}["a"] / {r.source: r.n for r in rates}["b"]))
    many = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("source"))
    got = Counter(r.source for r in mix_sources(many, weights={"rare": 1.0, "hot": 1.0}).collect())
    assert abs(got["rare"] - 3000) < 250 and abs(got["hot"] - 3000) < 250
    assert {r.source for r in mix_sources(many, weights={"rare": 1.0}).collect()} == {"rare"}
    out = mix_sources(messy, epochs=4.0).collect()
    assert out == mix_sources(messy, epochs=4.0).collect()
    copies = Counter((r.doc_id, r.source, r.text, r.copy) for r in out)
    rows = Counter((r.doc_id, r.source, r.text) for r in messy.collect())
    for (i, s, t, c), n in copies.items():
        assert n == rows[i, s, t] and (c == 0 or (i, s, t, c - 1) in copies)
    assert mix_sources(messy.where("doc_id = -1")).collect() == []
    assert mix_sources(messy, weights={}).collect() == []


def test_pieces_equal_the_library(spark, messy, texts):
    import sentencepiece

    ref = sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)
    machine = pieces.compile_model(SENTENCEPIECE_MODEL)
    docs = [t for _, t in texts] + [r.text for r in read(spark, SF_SMALL, "documents").collect()]
    extra = [" " * k for k in range(20)] + ["a" * 200, "\n\n\t x", "<s> <0x0A> ▁▁", "ﬁ … “q”", "don't, can't; e.g. 3.14!!", "\u0000x"]
    docs += extra
    got = machine.encode_texts(docs, {})
    for t, ids in zip(docs, got):
        assert ids.tolist() == ref.encode(t or "")
        assert machine.decode(ids.tolist()) == ref.decode(ids.tolist())
    rows = pieces.decode(pieces.encode(messy, machine), machine).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((i, tuple(ref.encode(t or ""))) for i, t in texts)
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in rows)
    assert pieces.encode(messy.where("doc_id = -1"), machine).collect() == []


def test_pieces_of_a_unigram_model():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    with open(SENTENCEPIECE_MODEL, "rb") as f:
        proto = pb.ModelProto.FromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:  # scores of a unigram model: short pieces cost about as much as long ones
        if p.type == 1:
            p.score = -8 + p.score / 8000 if p.score > -1e6 else -30.0
    model = proto.SerializeToString()
    machine, ref = pieces.Machine(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for t in ("The thing is of and to", "straße über naïve", "one two, three. four", "a" * 30):
        cost = lambda ids: sum(proto.pieces[i].score for i in ids)
        assert cost(machine.encode_texts([t], {})[0].tolist()) == pytest.approx(cost(ref.encode(t)), abs=1e-3)


def test_cache_overflow(monkeypatch):
    machine = pieces.compile_model(SENTENCEPIECE_MODEL)
    whole = [x.tolist() for x in machine.encode_texts(["the of and", "more words, then", "the end"], {})]
    monkeypatch.setattr(pieces, "CACHED", 2)
    cache = {}
    assert [machine.encode_texts([t], cache)[0].tolist() for t in ("the of and", "more words, then", "the end")] == whole


@pytest.mark.parametrize("run", [quality_rules, license_scan, langid.language_id])
def test_empty_table(messy, run):
    assert run(messy.where("doc_id = -1")).collect() == []
