"""A corpus pipeline: quality, near copies, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as
the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermolane.llm import bpe_stream, decontaminate, jaccard_join, pii, weak_quality
from thermolane.llm.registry import SURROGATE_KEY, default_tokenizer, read
from thermolane.llm.storage import small_batches, stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    scored = weak_quality.score_documents(docs)
    return scored.where("keep").select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Rows are compared by a number of their own, so of rows that repeat an id each is judged by its own
    text; rows with the id that stays are the same document and stay. Rows with a null id, and null,
    empty and blank texts, stay.
    """
    row = "row"
    while row in docs.columns:
        row += "_"
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = jaccard_join.jaccard_components(numbered, id_col=row).select(row, "component_id")
    ids = numbered.select("doc_id", row).join(groups, row)
    several = ids.groupBy("component_id").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    ids = ids.join(several.where("first != last"), "component_id").where("doc_id != first")
    gone = stage(ids.select(row), "gone")
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with surrogates for personal data; n_chars follows the new text."""
    done = pii.replace_pii(docs, SURROGATE_KEY)
    kind = docs.schema["n_chars"].dataType
    return done.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its ids' count and digest, and that of the decoded text."""
    rows = bpe_stream.digests(docs.select("doc_id", "text"), bpe_stream.load(spark, default_tokenizer()))
    with small_batches(spark):
        return stage(rows, "tokens")


STAGES = [
    ("quality_classifier", keep_good),
    ("ngram_jaccard_join", keep_one_of_each),
    ("benchmark_decontamination", drop_leaks),
    ("pii", replace_private),
    ("bpe", tokenize),
]

#: No stage but the second can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
