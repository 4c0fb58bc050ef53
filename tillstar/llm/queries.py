"""One query per operator, over the whole test tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import (
    decontamination,
    divergence,
    language_id,
    line_dedup,
    mixing,
    near_duplicates,
    quality,
    search,
    secret_scan,
    sharding,
    toxicity,
    url_filter,
    vector_codes,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"))
    base_kinds = len(secret_scan.BASE_RULES)
    base = F.filter("found", lambda s: s["kind_no"] < base_kinds)
    return found.select(
        "doc_id",
        *[_count_kind(k).cast("bigint").alias(f"n_{r.kind}")
          for k, r in enumerate(secret_scan.BASE_RULES)],
        F.sha2(secret_scan.as_text(base), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("found")).alias("spans"))


def _count_kind(kind: int):
    return F.size(F.filter("found", lambda s: s["kind_no"] == kind))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(
        table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, folder, "documents"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents"))


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time that follows from the page's number."""
    minutes = (F.col("page_id") * 7919 % 525600).cast("int")
    return pages.select("page_id", "url", F.timestamp_add(
        "MINUTE", minutes, F.to_timestamp(F.lit("2024-01-01 00:00:00"))).alias("fetched_at"))


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list of the pages' own hosts: every seventh page adds or removes one."""
    number = F.col("page_id")
    return pages.filter(number % 7 == 0).select(
        F.regexp_replace(url_filter.host_of("url"), r"^(www|m|blog)\.", "").alias("domain"),
        F.element_at(F.array(F.lit("ads"), F.lit("spam"), F.lit("malware")),
                     (number % 3 + 1).cast("int")).alias("category"),
        (number % 4 != 0).alias("listed"),
        F.date_add(F.lit("2024-01-01").cast("date"), (number * 37 % 366).cast("int")).alias("day"))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.filter_captures(
        captures(pages), url_filter.validity_intervals(list_entries(pages))
    ).withColumn("valid_from", F.col("valid_from").cast("string"))


def op8_search(spark: SparkSession, folder: str) -> DataFrame:
    """The whole text of each query, all its distinct words."""
    return search.top_k(table(spark, folder, "documents"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language_id.identify(docs, language_id.learn(docs))
    return found.select(
        "doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every run of RUN_WORDS words that stands earlier in the corpus goes, whatever is around it."""
    return line_dedup.dedup_lines(table(spark, folder, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), F.col("n_lines").cast("bigint").alias("n_lines"),
        F.col("n_deleted").cast("bigint").alias("n_deleted"),
        F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(
        table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.codes(table(spark, folder, "embeddings"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    f.__name__: f for f in (
        op1_secret_scan, op2_quality, op3_near_duplicates, op4_decontamination, op5_mixing,
        op6_sharding, op7_url_filter, op8_search, op9_language_id, op10_line_dedup, op11_toxicity, op12_source_divergence,
        op13_vector_codes, pipeline)
}
