"""URL filters by a temporal list join.

A list is a log of dated entries: from a day on, a host (with its subdomains) is
blocked, or no longer listed. The entries of a host become validity intervals. A
capture is looked up under its host and every parent domain, and meets the
entries active at its fetch time: an as-of join written as an equality on
(domain, month) and a range, so that a domain with any number of entries or a
third of all captures is no obstacle: each capture row meets the intervals that
touch its month only, and a plain join's hot key is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The login ends at the last @ before the path; an IPv6 address stands in brackets.
HOST = r"^\s*https?://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:@\s]+)"
#: Hosts without parent domains.
ADDRESS = r"^(\[.*\]|[0-9]+(\.[0-9]+){3})$"


def host_of(url: str | Column) -> Column:
    """Lower-case host of an http(s) URL without login, port or last dot; NULL if there is none."""
    url = F.col(url) if isinstance(url, str) else url
    host = F.regexp_extract(F.lower(url), HOST, 1)
    return F.nullif(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def domains_of(host: Column) -> Column:
    """The host and its parent domains, longest first; an address has no parents."""
    labels = F.when(host.rlike(ADDRESS), F.array(host)).otherwise(F.split(host, r"\."))
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(domain, category, valid_from, valid_to) of listed spells; valid_to is exclusive or NULL.

    ``entries`` has domain, category, listed and day. An entry holds until the
    next day with an entry of its domain. Of several entries of one day a
    delisting wins, then the first category; repeated entries count once.
    Entries without a domain or a day are ignored.
    """
    by_day = entries.filter("domain is not null and day is not null").groupBy(
        F.lower("domain").alias("domain"), "day"
    ).agg(F.min(F.struct(F.coalesce("listed", F.lit(False)).alias("listed"), "category")).alias("e"))
    following = F.lead("day").over(Window.partitionBy("domain").orderBy("day"))
    return by_day.select(
        "domain", "e.category", "e.listed", F.col("day").alias("valid_from"),
        following.alias("valid_to")).filter("listed").drop("listed")


def filter_captures(captures: DataFrame, intervals: DataFrame) -> DataFrame:
    """(page_id, host, fetched_at, verdict, domain, category, valid_from) of every capture.

    ``verdict`` is ``block`` if the host or a parent domain is listed at the fetch
    time, else ``allow``; ``invalid`` without a host or a time. The longest listed
    domain is reported. NULL ids stay; repeated rows are judged each. Hosts of any
    length and number of labels are looked up whole; NULL and malformed URLs are
    ``invalid``. Without captures the result is empty, without entries all are allowed.
    Extra columns are not read.
    """
    rows = captures.select(
        "page_id", host_of("url").alias("host"), F.col("fetched_at"),
    ).withColumn("valid", F.col("host").isNotNull() & F.col("fetched_at").isNotNull())
    # Equal captures get one verdict: the join's keys are (host, time), not rows.
    asked = rows.filter("valid").select("host", "fetched_at").distinct()
    looked_up = asked.select(
        "host", "fetched_at", F.trunc("fetched_at", "month").alias("month"),
        F.explode(domains_of(F.col("host"))).alias("domain"))
    last = F.lit(asked.agg(F.max("fetched_at")).head()[0]).cast("timestamp")
    spells = intervals.filter(F.col("valid_from") <= last).select("domain", "category", "valid_from", "valid_to", F.explode(F.sequence(
        F.trunc("valid_from", "month"),
        F.trunc(F.least(F.coalesce("valid_to", last), last).cast("date"), "month"),
        F.expr("interval 1 month"))).alias("month"))
    active = looked_up.join(spells, ["domain", "month"]).filter(
        (F.col("fetched_at") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))))
    judged = active.groupBy("host", "fetched_at").agg(F.max(F.struct(
        F.length("domain").alias("size"), "domain", "category", "valid_from")).alias("hit"))
    return rows.join(judged, ["host", "fetched_at"], "left").select(
        "page_id", "host", "fetched_at",
        F.when(~F.col("valid"), "invalid").when(F.col("hit").isNotNull(), "block")
        .otherwise("allow").alias("verdict"),
        "hit.domain", "hit.category", "hit.valid_from")
