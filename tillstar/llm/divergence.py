"""How far the sources of a language differ in their words.

Terms are counted by sorting pointers. A shard is a run of texts in one Arrow buffer,
laid out by (lang, source). Pointers to the starts of its terms are sorted by the
bytes they point at, with multikey quicksort whose characters are eight bytes wide: a
slice is split into less, equal and greater by one character, the equal part goes on
to the next character, and slices of SMALL pointers are finished together by sorting
all their next characters at once. Equal pointers keep the order of the buffer, so
within a run of equal terms documents and groups stand together, and the run's breaks
give its document frequency and its counts by source.

Spark adds up the shards' runs, keeps the terms of enough documents, and compares
the sources of a language in tiles of BLOCK x BLOCK sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm import text_blocks as tb
from tillstar.llm.tables import stored

LEAST_DOCUMENTS, SMOOTHING, WHOLE, TOP_TERMS = 30, 5, 1_000_000_000, 50
#: Bytes of text whose pointers are sorted together; one longer text is a shard of its own.
SHARD_BYTES = 16 << 20
#: Slices up to this size are finished together.
SMALL = 1 << 15
#: Sources on one side of a tile.
BLOCK = 64
#: Terms compared at a time in a tile.
STEP = 64

#: Letters of ASCII and every byte of a character beyond ASCII.
_TERM_BYTES = np.zeros(256, bool)
_TERM_BYTES[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_SHARD = "lang string, source string, term string, n bigint, docs bigint"
_TILE = "lang string, a int, b int, i int, j int, value bigint"


def _characters(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Eight bytes from ``at``, big-endian; bytes beyond the term's ``left`` ones are zero.

    No term holds a zero byte, so a zero in the last place says that the term ends here.
    ``data`` has eight more bytes than the text.
    """
    wide = np.ndarray(len(data) - 7, ">u8", data, strides=(1,))[at].astype(np.uint64)
    beyond = (8 * np.clip(8 - left, 0, 8)).astype(np.uint64)
    cut = np.where(beyond < 64, beyond, 0)
    return np.where(beyond < 64, wide >> cut << cut, np.uint64(0))


def sort_pointers(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, small: int = SMALL
) -> tuple[np.ndarray, np.ndarray]:
    """The terms in the order of their bytes, equal ones as they stand, and where runs begin."""
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    order, first = np.arange(len(starts)), np.zeros(len(starts), bool)

    def next_characters(pointers: np.ndarray, depth: int) -> np.ndarray:
        at = starts[pointers] + depth
        return _characters(data, np.minimum(at, len(data) - 8), ends[pointers] - at)

    slices = [(0, len(starts), 0)] if len(starts) else []
    while slices:
        low, high, depth = slices.pop()
        pointers = order[low:high]
        if len(pointers) <= small:
            order[low:high], first[low:high] = _finished(pointers, depth, next_characters)
            continue
        key = next_characters(pointers, depth)
        sample = np.sort(key[:: len(key) // 101 + 1])
        pivot = sample[len(sample) // 2]
        less, equal = key < pivot, key == pivot
        parts = [pointers[less], pointers[equal], pointers[~(less | equal)]]
        order[low:high] = np.concatenate(parts)
        middle, upper = low + len(parts[0]), high - len(parts[2])
        if parts[0].size:
            slices.append((low, middle, depth))
        if parts[2].size:
            slices.append((upper, high, depth))
        if pivot & np.uint64(255):
            slices.append((middle, upper, depth + 8))
        else:
            first[middle] = True
    return order, first


def _finished(pointers: np.ndarray, depth: int, next_characters) -> tuple[np.ndarray, np.ndarray]:
    """A slice sorted to the end, one character of all its open runs at a time."""
    pointers = pointers.copy()
    first = np.zeros(len(pointers), bool)
    run, at = np.zeros(len(pointers), np.int64), np.arange(len(pointers))
    while len(at):
        mine, of_run = pointers[at], run[at]
        key = next_characters(mine, depth)
        by = np.argsort(key, kind="stable")
        if of_run[0] != of_run[-1]:
            by = by[np.argsort(of_run[by], kind="stable")]
        mine, key = mine[by], key[by]
        begins = np.ones(len(at), bool)
        begins[1:] = (key[1:] != key[:-1]) | (of_run[1:] != of_run[:-1])
        pointers[at] = mine
        first[at[begins]] = True
        run[at] = at[np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))]
        at = at[(key & np.uint64(255)) != 0]
        depth += 8
    return pointers, first


def count_runs(
    groups: np.ndarray, texts: pa.Array, small: int = SMALL
) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(term, group, count, documents) of every term and group of one shard.

    ``groups`` is the number of each text's group, in ascending order.
    """
    data, offsets = tb.raw_bytes(texts)
    data = _LOWER[data]
    starts, ends, bounds = tb.word_bounds(data, offsets, _TERM_BYTES)
    order, new_term = sort_pointers(data, starts, ends, small)
    document = np.repeat(np.arange(len(texts)), np.diff(bounds))[order]
    group = groups[document]
    new_group = new_term.copy()
    new_group[1:] |= group[1:] != group[:-1]
    new_document = new_group.copy()
    new_document[1:] |= document[1:] != document[:-1]
    at = np.flatnonzero(new_group)
    if not len(at):
        none = np.zeros(0, np.int64)
        return pa.array([], pa.large_string()), none, none, none
    counts = np.diff(np.append(at, len(order)))
    documents = np.add.reduceat(new_document.astype(np.int64), at)
    first, last = starts[order[at]], ends[order[at]]
    ends_out = np.concatenate([[0], np.cumsum(last - first)])
    picked = data[np.repeat(first - ends_out[:-1], last - first) + np.arange(ends_out[-1])]
    terms = pa.LargeStringArray.from_buffers(
        len(at), pa.py_buffer(ends_out.astype(np.int64)), pa.py_buffer(picked))
    return terms, group[at], counts, documents


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop, texts in tb.blocks(batch.column(2), SHARD_BYTES):
            keys = list(zip(*[batch.column(c).slice(start, stop - start).to_pylist()
                              for c in (0, 1)], strict=True))
            names = sorted(set(keys))
            number = {name: k for k, name in enumerate(names)}
            groups = np.array([number[k] for k in keys])
            order = np.argsort(groups, kind="stable")
            terms, group, counts, documents = count_runs(groups[order], texts.take(order))
            picked = pa.array(group)
            yield pa.RecordBatch.from_arrays(
                [pa.array([n[0] for n in names], pa.string()).take(picked),
                 pa.array([n[1] for n in names], pa.string()).take(picked),
                 terms.cast(pa.string()), pa.array(counts), pa.array(documents)],
                ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over all texts; NULL lang, source and text are ''."""
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return rows.mapInArrow(_counted, _SHARD).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, total, at): terms of ``least`` documents with their counts by source."""
    return counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"),
        F.collect_list(F.struct("source", "n")).alias("at"),
    ).filter(F.col("docs") >= least).select("lang", "term", "total", "at")


def _share(count: str, size: str) -> Column:
    """1 + floor(WHOLE * (count + SMOOTHING) / size), exact beyond 64 bits."""
    return F.expr(
        f"1 + (cast({WHOLE} as decimal(10,0)) * cast({count} + {SMOOTHING} as decimal(20,0)))"
        f" div cast({size} as decimal(20,0))")


def source_groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, no, size, lang_size, absent) of every occurring (lang, source).

    ``size`` is N + SMOOTHING * V, NULL where no term is kept; ``absent`` is the share of
    a term that the group lacks; ``no`` numbers the sources of a language.
    """
    occurring = docs.select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    of_lang = kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_n"))
    of_group = kept.select("lang", F.explode("at").alias("at")).groupBy(
        "lang", F.col("at.source").alias("source")).agg(F.sum("at.n").alias("n"))
    sized = (
        occurring.join(of_lang, "lang", "left").join(of_group, ["lang", "source"], "left")
        .select("lang", "source",
                (F.coalesce("n", F.lit(0)) + SMOOTHING * F.col("terms")).alias("size"),
                (F.col("lang_n") + SMOOTHING * F.col("terms")).alias("lang_size"))
    )
    in_lang = Window.partitionBy("lang").orderBy("source")
    return sized.select(
        "lang", "source", (F.row_number().over(in_lang) - 1).alias("no"), "size", "lang_size",
        _share("0", "size").alias("absent"))


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of |p - q| over the terms of a tile, for runs of rows of the same tile."""
    def whole(key, total) -> pa.RecordBatch:
        i, j = (v.ravel() for v in np.indices(total.shape))
        lang, a, b = key
        same = [pa.array([v] * total.size, t) for v, t in
                ((lang, pa.string()), (a, pa.int32()), (b, pa.int32()))]
        return pa.RecordBatch.from_arrays(
            [*same, pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
             pa.array(total.ravel())], ["lang", "a", "b", "i", "j", "value"])

    key, total = None, None
    for batch in batches:
        keys = list(zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True))
        start = 0
        while start < len(keys):
            stop = start + 1
            while stop < len(keys) and stop - start < STEP and keys[stop] == keys[start]:
                stop += 1
            left, right = (
                batch.column(c).slice(start, stop - start).flatten().to_numpy()
                .reshape(stop - start, -1) for c in (3, 4))
            if key != keys[start]:
                if key is not None:
                    yield whole(key, total)
                key = keys[start]
                total = np.zeros((left.shape[1], right.shape[1]), np.int64)
            total += np.abs(left[:, :, None] - right[:, None, :]).sum(axis=0)
            start = stop
    if key is not None:
        yield whole(key, total)


def pair_divergence(kept: DataFrame, groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lang, source, item, value) of every pair of different sources of a language.

    A term's shares stand in arrays of ``block`` sources, absent ones filled in; a row
    is sent to each pair of its arrays, so that work grows with terms x sources x
    sources / block and a task holds one tile.
    """
    placed = groups.withColumn("block", F.floor(F.col("no") / block).cast("int")).withColumn(
        "place", (F.col("no") % block).cast("int"))
    blocks = placed.groupBy("lang", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "absent"))),
                    lambda s: s["absent"]).alias("absent"))
    present = kept.select("lang", "term", F.explode("at").alias("at")).select(
        "lang", "term", F.col("at.source").alias("source"), F.col("at.n").alias("n")
    ).join(placed, ["lang", "source"]).groupBy("lang", "term", "block").agg(
        F.map_from_entries(F.collect_list(F.struct("place", _share("n", "size").alias("p"))))
        .alias("present"))
    shares = kept.select("lang", "term").join(blocks, "lang").join(
        present, ["lang", "term", "block"], "left"
    ).select("lang", "term", "block", F.transform(
        "absent", lambda z, k: F.coalesce(F.element_at("present", k), z)).alias("shares"))
    per_term = shares.groupBy("lang", "term").agg(
        F.collect_list(F.struct("block", "shares")).alias("blocks"))
    tiles = per_term.select("lang", "blocks", F.explode("blocks").alias("x")).select(
        "lang", "x", F.explode(F.filter("blocks", lambda y: y["block"] >= F.col("x.block")))
        .alias("y")
    ).select("lang", F.col("x.block").alias("a"), F.col("y.block").alias("b"),
             F.col("x.shares").alias("left"), F.col("y.shares").alias("right"))
    summed = tiles.sortWithinPartitions("lang", "a", "b").mapInArrow(_tiles, _TILE).groupBy(
        "lang", "a", "b", "i", "j").agg(F.sum("value").alias("value"))
    ordered = summed.select(
        "lang", (F.col("a") * block + F.col("i")).alias("no"),
        (F.col("b") * block + F.col("j")).alias("other"), "value").filter("no < other")
    both = ordered.unionByName(
        ordered.select("lang", F.col("other").alias("no"), F.col("no").alias("other"), "value"))
    one = groups.select("lang", "no", "source")
    other = groups.select("lang", F.col("no").alias("other"), F.col("source").alias("item"))
    return one.join(other, "lang").filter("no <> other").join(
        both, ["lang", "no", "other"], "left").select(
        "lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))


def term_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every term that a source uses more than its language."""
    at = kept.select("lang", "term", "total", F.explode("at").alias("at")).select(
        "lang", "term", "total", F.col("at.source").alias("source"), F.col("at.n").alias("n"))
    return at.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        (_share("n", "size") - _share("total", "lang_size")).alias("value")
    ).filter("value > 0")


def _ranked(df: DataFrame, part: str, top: int | None = None) -> DataFrame:
    best_first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = df.withColumn("rank", F.row_number().over(best_first))
    if top:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): the distances of each source and its terms.

    NULL lang, source and text count as ''. A document of any length is sorted whole.
    Repeated rows count each. A language whose terms are all rare has pairs of value 0
    and no terms; a language with one source has no pairs; without documents the result
    is empty. Equal values are ranked by the item's bytes. Extra columns are not read.
    """
    kept = stored(kept_terms(term_counts(docs)), "kept_terms")
    groups = stored(source_groups(docs, kept), "source_groups")
    return _ranked(pair_divergence(kept, groups), "pair").unionByName(
        _ranked(term_divergence(kept, groups), "term", TOP_TERMS))
