"""The corpus pipeline: five stages over documents, each written and read by the next.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of
``docs``; the last returns the shard of every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import decontamination, mixing, near_duplicates, quality, sharding
from tillstar.llm.queries import table
from tillstar.llm.tables import stored


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id.

    Of rows that share that id the first by text stays, equal rows once. Groups
    without any id keep one row as well.
    """
    return near_duplicates.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a shard's last one only as far as taken."""
    return mixing.mixed_documents(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row of the mix."""
    return sharding.place(docs)


STAGES = [
    ("quality", drop_bad),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]

#: The classifier and the fingerprints have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
