"""The corpus pipeline: documents through five of the operators.

Every stage takes the documents its predecessor kept and returns documents
with the same columns; the last adds the piece ids.  ``run`` writes each
stage's result as Parquet in the shared scratch folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pillbox.llm import pieces
from pillbox.llm.common import materialise, read
from pillbox.llm.exact_dedup import exact_dedup
from pillbox.llm.mixing import mix_sources
from pillbox.llm.quality import quality_rules
from pillbox.llm.queries import SENTENCEPIECE_MODEL
from pillbox.llm.simhash import simhash_dedup

ROW = "_p_row"  # a column of this name in the input is dropped


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with a row number, written once: decisions come back by it, whatever ids repeat or are null."""
    return materialise(docs.drop(ROW).withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")


def _without(rows: DataFrame, dropped: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that are not dropped.  ``dropped`` is written first, so that its true size decides on a broadcast."""
    return rows.join(materialise(dropped.select(ROW), "pipeline-dropped"), ROW, "left_anti").select(*[f"`{c}`" for c in columns if c != ROW])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    judged = quality_rules(docs.withColumn("_p_text", F.col("text")).withColumn("_p_lang", F.col("lang")).select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_p_doc"), "_p_text", "_p_lang"), "_p_text", "_p_lang")
    return judged.where("kept").select("_p_doc.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    rows = _numbered(docs)
    found = exact_dedup(rows, row_col=ROW)
    return _without(rows, found.where("not kept").select(F.col("row_id").alias(ROW)), docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id stays (of equal ids one; null ids rank last)."""
    rows = _numbered(docs)
    member = simhash_dedup(rows, id_col=ROW, shingle=3, max_bits=2).select(ROW, "component_id")
    member = materialise(member.join(rows.select(ROW, F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", ROW).alias("rank")), ROW), "pipeline-members")
    best = member.groupBy("component_id").agg(F.min("rank").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return _without(rows, member.join(best, "component_id").where(F.col(ROW) != F.col(f"best.{ROW}")), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to the square root of their sizes."""
    numbered = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_p_doc"), "doc_id", "source", "text")
    return mix_sources(numbered, alpha=0.5, epochs=1.0, seed=42).select("_p_doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text's piece ids and whether decoding gives the text back (columns ``ids`` and ``same_text`` of the input are replaced)."""
    return pieces.encode(docs, pieces.compile_model(SENTENCEPIECE_MODEL), same_col="same_text")


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]
#: SimHash, hashes of words and pieces have no SQL counterpart; tests hold the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs, "pipeline-stage")
    return docs
