"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

The corpus is cut into blocks of BLOCK_WORDS words. Sources get blocks by the
highest quotients target / (2k + 1), and each source's blocks go to its shards
(hashed parts of ROWS_PER_BUCKET rows) by their sizes in the same way: integer
quotas. Only the quotients near a party's own share are compared, since the
method strays from the share by a known margin. A shard's documents are laid out
in a seeded order; its quota takes the blocks from the start, in whole laps first
if it exceeds the shard. No row group larger than a shard meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.tables import ROWS_PER_BUCKET, stored, word_count

BLOCK_WORDS = 16
MOST_REPEATS = 3
SEED = "mix-1"


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source of (source, size): rank, rows, source_size and target.

    Sources rank by code point, NULL last, and weigh 1, 2, 3 in turn. A target
    stops at MOST_REPEATS times the source's size; the rest is shared again by
    weight. That is one level for all others: sources are capped in the order of
    cap over weight until the level left for the next one lies below its cap.
    """
    sources = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("source_rows"), F.sum("size").alias("source_size"))
    ranked = sources.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ).select("*", ((F.col("rank") - 1) % 3 + 1).alias("weight"),
             (F.col("source_size") * MOST_REPEATS).alias("cap"))
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    in_order = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(
        Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(in_order), F.lit(0))
    levels = ranked.select(
        "*",
        ((F.sum("source_size").over(everything) - before("cap"))
         / (F.sum("weight").over(everything) - before("weight"))).alias("level"))
    # The first source in that order whose cap is not below the level sets it for all.
    holds = F.when(F.col("cap") / F.col("weight") >= F.col("level"),
                   F.struct(F.col("cap") / F.col("weight"), "rank", "level"))
    return levels.withColumn("chosen", F.min(holds).over(everything)["level"]).select(
        "source", "rank", "source_rows", "source_size",
        F.least(F.col("cap").cast("double"), F.col("chosen") * F.col("weight")).alias("target"))


def apportion(parties: DataFrame, group: list[str], party: str) -> DataFrame:
    """Seats of each party: (group, party, seats), by Sainte-Lague's highest quotients.

    ``parties`` has ``votes``, ``most`` (seats a party may have) and ``total``
    (seats of its group). A party's seats lie within n * share / 2 + 1 of its
    exact share, n being the parties of the group, so only those are ranked.
    """
    of_group = Window.partitionBy(*(group or [F.lit(0)]))
    margin = F.ceil(F.col("share") * F.count(F.lit(1)).over(of_group) / 2).cast("bigint") + 1
    shares = parties.withColumn(
        "share", F.coalesce(F.try_divide(
            F.col("votes").cast("double"), F.sum("votes").over(of_group)), F.lit(0.0))
    ).select("*", F.floor(F.col("share") * F.col("total")).alias("whole"), margin.alias("margin"))
    based = shares.withColumn(
        "base", F.least("most", F.greatest(F.lit(0), F.col("whole") - F.col("margin")))
    ).withColumn("open", F.col("total") - F.sum("base").over(of_group))
    offers = based.select(
        *group, party, "base", "open", "votes", "most",
        F.explode(F.sequence("base", F.col("whole") + F.col("margin"))).alias("k"))
    best = Window.partitionBy(*(group or [F.lit(0)])).orderBy(
        (F.col("votes") / (2 * F.col("k") + 1)).desc(), party)
    won = offers.withColumn(
        "valid", (F.col("k") < F.col("most")) & (F.col("votes") > 0)
    ).withColumn(
        "place", F.sum(F.col("valid").cast("int")).over(best)
    )
    taken = F.col("valid") & (F.col("place") <= F.col("open"))
    return won.groupBy(*group, party).agg(
        (F.max("base") + F.sum(taken.cast("bigint"))).alias("seats"))


def mix(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), doc_id, size, source_size, target, taken.

    ``taken`` is the number of a document's words in the mix, repeats counted:
    whole copies and, for one document of a shard, a beginning. NULL sources are
    one source, NULL and empty texts have size 0 and are never taken. Rows are
    ordered by a seeded hash of their id; equal ids by size, and rows equal in
    both may trade places. An empty table gives an empty mix.
    """
    rows = docs.select(
        F.struct("*").alias("row"), "doc_id", "source", word_count("text").alias("size"))
    return _mixed(rows)


def mix_sizes(docs: DataFrame) -> DataFrame:
    """As ``mix`` without ``row``: the texts are read once and only their sizes move on."""
    rows = docs.select("doc_id", "source", word_count("text").alias("size"))
    return _mixed(stored(rows, "sizes"))


def _mixed(rows: DataFrame) -> DataFrame:
    targets = stored(source_targets(rows.select("source", "size")), "source_targets")
    digest = F.md5(F.concat(F.lit(SEED + "/"), F.coalesce(F.col("doc_id").cast("string"),
                                                          F.lit("none"))))
    shards = F.ceil(F.col("source_rows") / ROWS_PER_BUCKET)
    placed = rows.withColumn("order", digest).join(
        targets.withColumnRenamed("source", "known_source"),
        F.col("source").eqNullSafe(F.col("known_source"))
    ).withColumn(
        "shard", F.conv(F.substring("order", 25, 8), 16, 10).cast("bigint") % shards
    ).withColumn("part", F.substring("order", 1, 1)).drop("known_source", "source", "source_rows")
    parts = stored(placed.groupBy("rank", "shard", "part").agg(
        F.sum("size").alias("part_size")), "part_sizes")
    sizes = parts.groupBy("rank", "shard").agg(F.sum("part_size").alias("shard_size"))

    block = F.lit(BLOCK_WORDS)
    whole = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    blocks = lambda words: F.floor(words / block).cast("bigint")
    of_source = apportion(
        targets.select("rank", F.col("target").alias("votes"),
                       blocks(F.col("source_size") * MOST_REPEATS).alias("most"),
                       blocks(whole).alias("total")), [], "rank")
    quotas = stored(apportion(
        sizes.join(of_source, "rank").select(
            "rank", "shard", F.col("shard_size").alias("votes"),
            blocks(F.col("shard_size") * MOST_REPEATS).alias("most"),
            F.col("seats").alias("total")), ["rank"], "shard"
    ).join(sizes, ["rank", "shard"]), "quotas")

    words = F.col("seats") * BLOCK_WORDS
    laps = F.coalesce(F.floor(F.try_divide(words, F.col("shard_size"))), F.lit(0))
    earlier = Window.unboundedPreceding, -1
    of_shard = Window.partitionBy("rank", "shard").orderBy("part").rowsBetween(*earlier)
    starts = stored(parts.withColumn(
        "start", F.coalesce(F.sum("part_size").over(of_shard), F.lit(0))
    ).join(quotas, ["rank", "shard"]).drop("part_size"), "part_starts")
    in_order = Window.partitionBy("rank", "shard", "part").orderBy(
        "order", "doc_id", "size").rowsBetween(*earlier)
    laid = placed.join(starts, ["rank", "shard", "part"]).withColumn(
        "before", F.col("start") + F.coalesce(F.sum("size").over(in_order), F.lit(0)))
    rest = words - laps * F.col("shard_size") - F.col("before")
    taken = laps * F.col("size") + F.greatest(F.lit(0), F.least(rest, "size"))
    row = ["row"] if "row" in rows.columns else []
    return laid.select(
        *row, "doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: a row for every whole copy and one for a beginning.

    A beginning has the words taken, separated by single blanks.
    """
    mixed = mix(docs).filter("taken > 0")
    copies = mixed.select("*", F.explode(
        F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")))).alias("copy"))
    left = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    words = F.split(F.regexp_replace("row.text", r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    start = F.array_join(F.slice(words, F.lit(1), left.cast("int")), " ")
    text = F.when(left >= F.col("size"), F.col("row.text")).otherwise(start)
    columns = {c: F.col("row").getField(c) for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(left >= F.col("size"), columns["n_chars"]).otherwise(
            F.length(start)).cast(docs.schema["n_chars"].dataType)
    return copies.select(*[value.alias(name) for name, value in columns.items()])
