"""Landed sheets: per-store sales files and master lists as all-text tables.

Sales lie in one folder per source, ``<root>/<sheet_name>/``, as ``.csv`` or
``.csv.gz``. All files of one source share a header, as the sheet they come from
has only one; sources may differ from each other. Cells are quoted as
spreadsheets export them: quotes are doubled, and a cell may hold line breaks.
A file is therefore one task, so large sources are to be landed as many files.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar import fixed_values as fixed

log = logging.getLogger("tillstar")

HEADER_READERS = 16
FILE_ENDINGS = (".csv", ".csv.gz")
CSV_OPTIONS = {
    "escape": '"', "multiLine": True, "pathGlobFilter": "*.{csv,csv.gz}",
}

SALES_COLUMNS = ("timestamp", "store_id", "staff_name", "receipt_no", "customer_phone",
                 "product_sold", "quantity", "payment_method", "source_sheet")


@dataclass(frozen=True)
class Source:
    """A sales source: the sheet name is also its folder."""

    store_id: str
    sheet_name: str


def default_sources() -> list[Source]:
    return [Source(f"S{n:03d}", f"SalesLog_S{n:03d}") for n in range(1, fixed.STORE_COUNT + 1)]


def normalise_headers(headers: Sequence[str]) -> list[str]:
    """Known headers by the dictionary, others in lower case with underscores."""
    names = [h.strip() for h in headers]
    return [fixed.SALES_HEADERS.get(n) or n.lower().replace(" ", "_") for n in names]


def registry_frame(spark: SparkSession, sources: Sequence[Source]) -> DataFrame:
    return spark.createDataFrame(
        [(s.store_id, s.sheet_name) for s in sources], "store_id string, sheet_name string"
    )


def fill_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns`` as text: absent columns and empty cells become ''."""
    present = set(df.columns)
    return df.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in present
        else F.lit("").alias(c)
        for c in columns
    ])


def stamp_source(df: DataFrame, registry: DataFrame, path: str = "source_path") -> DataFrame:
    """Store id and sheet name from the registry, by the folder a row was read from.

    ``path`` is a file's path as Spark reports it, with encoded blanks and the
    like. A store id in the sheet itself is ignored. The registry has one row per
    source; a row from a folder that it lacks stops the load.
    """
    encoded = F.element_at(F.split(path, "/"), -2)
    folder = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    names = registry.select(F.col("store_id"), F.col("sheet_name").alias("source_sheet"))
    unknown = F.raise_error(F.concat(F.lit("no source is registered for folder "), "source_sheet"))
    return (
        df.drop("store_id").withColumn("source_sheet", folder)
        .join(names, "source_sheet", "left")
        .withColumn("store_id", F.coalesce("store_id", unknown.cast("string"))).drop(path)
    )


def source_row_counts(sales: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows per registered source; a source without data counts 0."""
    counts = sales.groupBy("source_sheet").agg(F.count(F.lit(1)).alias("loaded"))
    return registry.join(
        counts, F.col("sheet_name") == F.col("source_sheet"), "left"
    ).select("store_id", "sheet_name", F.coalesce("loaded", F.lit(0)).alias("row_count"))


def _first_files(
    spark: SparkSession, paths: str | list[str], known: set[str] | None = None
) -> dict[str, str]:
    """One file per folder, None without a readable one. Only the listing is read.

    A file of another type in one of the ``known`` folders (None: any) stops the
    load, since its lines would be missing without a word.
    """
    files = spark.read.format("binaryFile").load(paths).select(
        "path", F.element_at(F.split("path", "/"), -2).alias("folder"), "length")
    read = F.lit(False)
    for ending in FILE_ENDINGS:
        read = read | F.endswith("path", F.lit(ending))
    found = files.groupBy("folder").agg(
        F.coalesce(F.min(F.when(read & (F.col("length") > 0), F.col("path"))),
                   F.min(F.when(read, F.col("path")))).alias("path"),
        F.min(F.when(~read, F.col("path"))).alias("unread")).collect()
    unread = [r["unread"] for r in found
              if r["unread"] and (known is None or r["folder"] in known)]
    if unread:
        raise ValueError(f"files of another type than {FILE_ENDINGS}: {sorted(unread)[:5]}")
    return {r["folder"]: r["path"] for r in found}


def _header(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """The first record of a file as cells; None for an empty file."""
    first = spark.read.options(**CSV_OPTIONS).csv(path, header=False).head(1)
    return tuple(cell or "" for cell in first[0]) if first else None


def read_sales(spark: SparkSession, root: str, sources: Sequence[Source]) -> DataFrame:
    """All registered sources as one raw sales table.

    A multi-file CSV read applies its schema by position, so sources are grouped
    by their header and each group is one read. The reader compares the header
    of every file with the group's, so a file that differs stops the load
    instead of putting cells in wrong columns. The driver sees one header per
    source, no data.
    """
    known = {s.sheet_name for s in sources}
    landed = _first_files(spark, f"{root}/*", known)
    for name in sorted(landed.keys() - known):
        log.warning("folder %s has no registered source and is not read", name)
    files = {name: path for name, path in landed.items() if name in known}
    for name in sorted(known - files.keys()):
        log.warning("source %s delivered no file", name)
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = dict(zip(files, pool.map(lambda p: _header(spark, p), files.values())))
    groups: dict[tuple[str, ...], list[str]] = {}
    for folder, header in headers.items():
        if header is not None:
            groups.setdefault(header, []).append(folder)

    wanted = [*fixed.SALES_SHEET_COLUMNS, "source_path"]
    parts = [
        fill_missing(_read_group(spark, [f"{root}/{f}" for f in folders], header), wanted)
        for header, folders in groups.items()
    ]
    if not parts:
        empty = T.StructType([T.StructField(c, T.StringType()) for c in wanted])
        parts = [spark.createDataFrame([], empty)]
    everything = reduce(DataFrame.unionByName, parts)
    return stamp_source(everything, registry_frame(spark, sources)).select(*SALES_COLUMNS)


def _read_group(
    spark: SparkSession, folders: list[str], header: tuple[str, ...],
    names: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of all files of ``folders`` under ``names``, stopping at another header."""
    names = names or normalise_headers(header)
    # A repeated or empty header cannot name a column, so the reader cannot compare it.
    nameable = all(header) and len({h.lower() for h in header}) == len(header)
    cells = list(header) if nameable else [f"cell_{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cells])
    reader = spark.read.options(**CSV_OPTIONS).schema(schema)
    if not nameable:
        _compare_headers(reader.csv(folders), header)
    rows = reader.options(header=True, enforceSchema=not nameable).csv(folders)
    position = {name: i for i, name in enumerate(names)}  # a repeated header: the last wins
    return rows.select(
        *[rows[f"`{cells[i]}`"].alias(name) for name, i in position.items()],
        F.col("_metadata.file_path").alias("source_path"),
    )


def _compare_headers(rows: DataFrame, header: tuple[str, ...]) -> None:
    """Stop unless ``header`` is the first record of every file; one scan of these files.

    A file is one task that reads its records in order, so its first record has the
    lowest of the ids that rise within a task.
    """
    cells = F.array(*[F.coalesce(rows[c], F.lit("")) for c in rows.columns])
    firsts = rows.select(
        F.col("_metadata.file_path").alias("path"), cells.alias("cells"),
        F.monotonically_increasing_id().alias("record"),
    ).groupBy("path").agg(F.min_by("cells", "record").alias("first"))
    differing = firsts.filter(F.col("first") != F.array(*[F.lit(h) for h in header])).head(1)
    if differing:
        raise ValueError(f"another header than {header} in {differing[0]['path']}")


def read_sales_json(spark: SparkSession, root: str, sources: Sequence[Source]) -> DataFrame:
    """Sales landed as JSON lines under normalised names, one folder per source."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in fixed.SALES_SHEET_COLUMNS])
    rows = spark.read.schema(schema).json([f"{root}/{s.sheet_name}/*.json" for s in sources])
    stamped = rows.select("*", F.col("_metadata.file_path").alias("source_path"))
    filled = fill_missing(stamped, [*fixed.SALES_SHEET_COLUMNS, "source_path"])
    return stamp_source(filled, registry_frame(spark, sources)).select(*SALES_COLUMNS)


def read_master(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A master list by its header names; cells stay the text they were.

    A file whose header differs from that of the others stops the load. A list
    without a file or a header is empty.
    """
    columns = fixed.MASTER_COLUMNS[name]
    first = next(iter(_first_files(spark, path).values()), None)
    header = _header(spark, first) if first else None
    if header is None:
        empty = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        return spark.createDataFrame([], empty)
    return fill_missing(_read_group(spark, [path], header, list(header)), columns)


def read_masters(spark: SparkSession, root: str) -> Mapping[str, DataFrame]:
    return {
        name: read_master(spark, f"{root}/{name}", name) for name in fixed.MASTER_COLUMNS
    }
