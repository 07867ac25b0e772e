"""The pipeline's stages against brute force, on the documents and on the awkward table."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from pillbox.llm.common import read
from pillbox.llm.quality import quality_rules
from tests.conftest import SF_SMALL
from tests.llm.test_dedup import brute_components, fingerprint, lower


def key(r):
    return tuple(r)


@pytest.fixture(scope="module", params=["documents", "messy"])
def docs(request, spark, messy):
    return read(spark, SF_SMALL, "documents") if request.param == "documents" else messy


def test_stages(spark, docs):
    rows = [r.asDict() for r in docs.collect()]
    kept = Counter(tuple(r[c] for c in docs.columns) for r in rows)
    # 1: what the operator keeps
    one = P.quality(spark, docs, SF_SMALL)
    assert one.columns == docs.columns
    own = quality_rules(docs.select(F.col("doc_id"), F.col("text"), F.col("lang"))).where("kept").select("doc_id", "text")
    assert Counter((r.doc_id, r.text) for r in one.collect()) == Counter(map(tuple, own.collect()))
    # 2: one of equal texts, with the largest id
    two = P.exact(spark, docs, SF_SMALL)
    assert two.columns == docs.columns
    best = defaultdict(list)
    for r in rows:
        best[lower(r["text"])].append(r["doc_id"])
    got = two.collect()
    assert Counter((lower(r.text), r.doc_id) for r in got) == Counter((t, max((i for i in ids if i is not None), default=None)) for t, ids in best.items())
    assert all(key(r) in kept for r in got)
    # 3: one of each component, with the smallest id
    three = P.near(spark, docs, SF_SMALL).collect()
    fps = [fingerprint(r["text"]) for r in rows]
    parts = brute_components(list(range(len(rows))), fps)
    groups = defaultdict(list)
    for r, p in zip(rows, parts):
        groups[p].append(r["doc_id"])
    assert Counter(r.doc_id for r in three) == Counter(min((i for i in ids if i is not None), default=None) for ids in groups.values())
    assert all(key(r) in kept for r in three)
    # 4: only whole rows, replicated
    four = P.mix(spark, docs, SF_SMALL).collect()
    assert set(map(key, four)) <= set(kept)
    # 5: ids that give the text back
    five = P.encode(spark, docs.drop("ids"), SF_SMALL)
    assert [c for c in five.columns if c not in ("ids", "same_text")] == [c for c in docs.columns if c != "ids"]
    assert all(r.same_text == ("▁" not in (r.text or "")) for r in five.collect())


def test_stage_of_nothing(spark, docs):
    for _, stage in P.STAGES:
        assert stage(spark, docs.where("doc_id = -1"), SF_SMALL).collect() == []


def test_run(spark):
    out = P.run(spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in read(spark, SF_SMALL, "documents").collect()}
    assert out and all(texts[r.doc_id] == r.text and r.same_text for r in out)
    assert all(len(re.findall(r"\S+", r.text)) >= 10 for r in out)
    assert [n for n, _ in P.STAGES] == ["quality rules", "exact dedup", "SimHash near-dedup", "mixing sources to target weights", "SentencePiece encoding and decoding"]
