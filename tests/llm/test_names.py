"""Input columns whose names clash with result columns in any case, with inner names, or hold a backtick."""

import pytest
from pyspark.sql import functions as F

from pillbox.llm import langid, pieces
from pillbox.llm.bpe import bpe_encode, compile_vocabulary
from pillbox.llm.collocations import collocations
from pillbox.llm.exact_dedup import exact_dedup
from pillbox.llm.licenses import license_scan
from pillbox.llm.mixing import mix_sources
from pillbox.llm.periodic_runs import periodic_runs
from pillbox.llm.quality import quality_rules
from pillbox.llm.queries import SENTENCEPIECE_MODEL, WORD_BPE
from pillbox.llm.simhash import simhash_dedup
from pillbox.llm.suffix_dedup import remove_repeats

CLASH = ["KEPT", "Copy", "IDS", "Labels", "SCORE", "Lang_Pred", "_s_text", "_h_text", "_Q", "_l", "_m_source", "_m_u", "_M_extra", "Same", "back`tick", "dot.ted", "Id", "RID"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", "ab"[k % 2]) for k, t in enumerate(["under the MIT license", None, "", "one two three four five six seven eight nine ten eleven", "x"])]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return base.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASH)])


OPERATORS = {
    "mixing": (lambda d: mix_sources(d, epochs=3.0), {"copy", "shuffle_key"}),
    "pieces": (lambda d: pieces.encode(d, pieces.compile_model(SENTENCEPIECE_MODEL), same_col="same"), {"ids", "same"}),
    "pieces decoded": (lambda d: pieces.decode(pieces.encode(d, pieces.compile_model(SENTENCEPIECE_MODEL)), pieces.compile_model(SENTENCEPIECE_MODEL)), {"ids", "decoded"}),
    "langid": (lambda d: langid.predict(d, langid.prototypes(d, "text", "lang")), {"lang_pred", "score"}),
    "licenses": (license_scan, {"n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"}),
    "quality": (quality_rules, {"n_words", "kept"}),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_others_stay_and_ours_replace(docs, name):
    run, own = OPERATORS[name]
    out = run(docs)
    rows = out.collect()
    assert rows and own <= set(out.columns)
    taken = {c.lower() for c in out.columns[len(out.columns) - len(set(out.columns) - set(docs.columns)) :]}
    stay = [c for c in docs.columns if c.lower() not in taken]
    assert [c for c in out.columns if c in docs.columns] == stay
    for c in (c for c in CLASH if c in stay):
        assert {r[c] for r in rows} == {CLASH.index(c)}


@pytest.mark.parametrize("run", [
    langid.language_id, exact_dedup, simhash_dedup, remove_repeats, periodic_runs, lambda d: bpe_encode(d, compile_vocabulary(WORD_BPE)),
])
def test_only_the_named_columns_are_read(docs, run):
    assert len(run(docs).collect()) == docs.count()


def test_collocations_read_two_columns(docs):
    assert collocations(docs, min_count=1, covered_percent=101).count() > 0
