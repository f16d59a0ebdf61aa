"""One query per operator over its whole table, and SQL for DuckDB where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe_stream,
    decontaminate,
    divergence,
    embedding_forest,
    jaccard_join,
    packing,
    pii,
    sharding,
    spelling,
    suffix_dedup,
    url_rules,
    warc,
    weak_quality,
)

#: Key of the surrogates in the registered query; a real run passes a secret of its own.
SURROGATE_KEY = "example-key"
#: The rules of the URL query (host, path, action).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1(spark, sf_dir):
    return embedding_forest.near_duplicates(read(spark, sf_dir, "embeddings"))


def op2(spark, sf_dir):
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"))


def op3(spark, sf_dir):
    return pii.replace_pii(read(spark, sf_dir, "documents"), SURROGATE_KEY)


def op4(spark, sf_dir):
    return decontaminate.mark_contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_stream.digests(docs, bpe_stream.load(spark, default_tokenizer()))


def op6(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, action string")
    return url_rules.judge_pages(read(spark, sf_dir, "pages"), rules)


def op7(spark, sf_dir):
    pages = warc.archive_and_read(read(spark, sf_dir, "pages"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return weak_quality.score_documents(docs).select("doc_id", "n_low", "n_good", "posterior", "score", "keep")


def op9(spark, sf_dir):
    rows = sharding.shard_by_bytes(read(spark, sf_dir, "documents"), shards=8)
    return rows.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op10(spark, sf_dir):
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op11(spark, sf_dir):
    return packing.digests(packing.pack(read(spark, sf_dir, "documents"), bpe_stream.load(spark, default_tokenizer())))


def op12(spark, sf_dir):
    return spelling.group_variants(spelling.count_words(read(spark, sf_dir, "documents"), typo_every=199))


def op13(spark, sf_dir):
    return divergence.audit_sources(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_embedding_near_dedup": op1,
        "op2_ngram_jaccard_join": op2,
        "op3_pii_surrogates": op3,
        "op4_benchmark_decontamination": op4,
        "op5_bpe": op5,
        "op6_url_filter": op6,
        "op7_warc": op7,
        "op8_quality_classifier": op8,
        "op9_sharding": op9,
        "op10_suffix_dedup": op10,
        "op11_packing": op11,
        "op12_spelling_variants": op12,
        "op13_source_divergence": op13,
    }


def oracle_sql() -> dict[str, str]:
    from . import sql

    return sql.ALL
