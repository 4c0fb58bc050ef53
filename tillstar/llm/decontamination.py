"""Benchmark decontamination: rare n-gram seeds, then local alignment of passages.

Word trigrams of the test items are seeds. The corpus is scanned once; every
trigram of every document is looked up among the seeds, a join whose small side
is broadcast only while the planner's size of it allows. The hits are stored and
counted per seed over the whole corpus. An item's rare seeds are the rarer half of
those that occur. One rare seed opens a passage: a stretch of a document around hits on
neighbouring diagonals. Common seeds open one only together, two and one for each
``SUPPORT`` words of the item: an edited copy whose rare seeds are all gone is a
candidate, a phrase in common is not. A passage that shares too few words with its item to reach the
threshold is dropped unaligned, which loses nothing. Smith-Waterman on words scores the
others, so edits, insertions and gaps lower the score only a little.

A copy that keeps no seed is not found (every third word changed in turn), nor one that
keeps a few common seeds only. README gives the share found by words changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm import text_blocks as tb
from tillstar.llm.tables import stored

GRAM = 3
#: Hits whose diagonals differ by less than this may share a passage.
BAND = 64
MATCH, MISMATCH, GAP = 2.0, -1.0, -1.0
#: Score of the alignment over that of the whole item: a third of the words may be exchanged.
THRESHOLD = 0.5

#: Share of an item's occurring seeds that are rare.
RARE = 0.5
#: Common seeds open a passage if it holds at least two, and one for each so many words of the item.
SUPPORT = 8

_HASH_FIELDS = "doc_id bigint, text_key bigint, at int, seed bigint"


def _item_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = tb.raw_bytes(texts)
    starts, ends, words = tb.word_bounds(data, offsets)
    return tb.word_hashes(data, starts, ends), words


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every trigram of every text: its hash and the number of its first word."""
    for batch in batches:
        for start, stop, texts in tb.blocks(batch.column(2)):
            hashes, words = _item_words(texts)
            grams = tb.gram_hashes(hashes, GRAM)
            row = np.repeat(np.arange(stop - start), np.diff(words))
            at = np.arange(len(hashes)) - words[row]
            whole = np.flatnonzero(row[:len(grams)] == row[GRAM - 1:][:len(grams)])
            where = pa.array(row[whole])
            part = batch.slice(start, stop - start)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(where), part.column(1).take(where),
                 pa.array(at[whole].astype(np.int32)), pa.array(grams[whole].view(np.int64))],
                ["doc_id", "text_key", "at", "seed"])


def seeds_of(df: DataFrame) -> DataFrame:
    """(doc_id, text_key, at, seed) of a frame (doc_id, text_key, text)."""
    lowered = df.select("doc_id", "text_key", F.lower("text").alias("text"))
    return lowered.mapInArrow(_grams, _HASH_FIELDS)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: its score over that of the whole item, and its words in the passage.

    One row of the matrix at a time; gaps along the row are a running maximum.
    """
    steps = np.arange(len(passage) + 1)
    above = np.zeros(len(passage) + 1)
    origin = steps.copy()  # where in the passage the alignment that ends here began
    best, end, begin = 0.0, 0, 0
    for word in item:
        diagonal = above[:-1] + np.where(passage == word, MATCH, MISMATCH)
        score = np.zeros(len(passage) + 1)
        score[1:] = np.maximum(diagonal, above[1:] + GAP)
        came = steps.copy()
        came[1:] = np.where(diagonal >= above[1:] + GAP, origin[:-1], origin[1:])
        low = score <= 0
        score[low], came[low] = 0.0, steps[low]
        flat = score - GAP * steps
        reach = np.maximum.accumulate(flat)
        source = np.maximum.accumulate(np.where(flat >= reach, steps, 0))
        above, origin = reach + GAP * steps, came[source]
        low = above <= 0
        above[low], origin[low] = 0.0, steps[low]
        top = int(above.argmax())
        if above[top] > best:
            best, end, begin = float(above[top]), top, int(origin[top])
    return best / (MATCH * max(1, len(item))), begin, end


def most_score(item: np.ndarray, passage: np.ndarray) -> float:
    """No alignment scores more: every word of the item that the passage has, as often as both."""
    found, counts = np.unique(item, return_counts=True)
    place = np.minimum(np.searchsorted(found, passage), len(found) - 1)
    hit = place[found[place] == passage]
    return np.minimum(counts, np.bincount(hit, minlength=len(found))).sum() / len(item)


_STRETCH_FIELDS = ("doc_id bigint, text_key bigint, item_id bigint, item_key bigint,"
                   " low int, words array<bigint>")


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text_key, text, passages) to the word hashes of each passage."""
    names = ["doc_id", "text_key", "item_id", "item_key", "low", "words"]
    for batch in batches:
        for start, stop, texts in tb.blocks(batch.column(2)):
            hashes, words = _item_words(texts)
            found: dict[str, list] = {name: [] for name in names}
            ids, keys, passages = (
                batch.column(c).slice(start, stop - start).to_pylist() for c in (0, 1, 3))
            for k, doc_id in enumerate(ids):
                doc = hashes[words[k]:words[k + 1]]
                for p in passages[k]:
                    low = max(0, p["low"])
                    stretch = doc[low:max(low, p["high"])]
                    if len(stretch):
                        row = (doc_id, keys[k], p["item_id"], p["item_key"], low, stretch.view(np.int64))
                        for name, value in zip(names, row, strict=True):
                            found[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(found[c], pa.int64()) for c in names[:4]],
                 pa.array(found["low"], pa.int32()), pa.array(found["words"], pa.list_(pa.int64()))],
                names)


def _aligned(threshold: float):
    """Rows (doc_id, text_key, item_id, item_key, low, words, item) to those that score ``threshold``."""
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[int, np.ndarray] = {}
            kept, scores, starts, ends = [], [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("item_key", "low", "item")), strict=True)
            flat = batch.column("words").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            bounds = batch.column("words").offsets.to_numpy()
            bounds = bounds - bounds[0]
            for k, (item_key, low, text) in enumerate(rows):
                passage = flat[bounds[k]:bounds[k + 1]]
                if item_key not in known:
                    known[item_key], _ = _item_words(pa.array([text], pa.large_string()))
                item = known[item_key]
                if most_score(item, passage) < threshold:
                    continue
                score, begin, end = align(item, passage)
                if score >= threshold:
                    for found, value in zip(
                            (kept, scores, starts, ends), (k, score, low + begin, low + end), strict=True):
                        found.append(value)
            where = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(where) for c in ("doc_id", "text_key", "item_id")],
                 pa.array(scores, pa.float64()), pa.array(starts, pa.int32()),
                 pa.array(ends, pa.int32())],
                ["doc_id", "text_key", "item_id", "score", "start", "end"])

    return aligned


def _items(items: DataFrame) -> DataFrame:
    return items.filter(F.col("text").isNotNull()).select(
        F.col("item_id").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, item_key, low, high): stretches of documents to align."""
    texts = _items(items)
    seeds = stored(
        seeds_of(texts).select(
            F.col("doc_id").alias("item_id"), F.col("text_key").alias("item_key"),
            F.col("at").alias("item_at"), "seed"), "seeds")
    grams = seeds_of(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"))
    hits = stored(grams.join(seeds.select("seed").distinct(), "seed"), "seed_hits")
    # A window holds the words of one item; equal texts count once.
    item = Window.partitionBy("item_key")
    occurring = seeds.select("item_key", "item_at", "seed").distinct().join(
        hits.groupBy("seed").agg(F.count(F.lit(1)).alias("found")), "seed")
    rare = stored(occurring.select(
        "item_key", "item_at",
        (F.row_number().over(item.orderBy("found", "item_at"))
         <= F.ceil(F.count(F.lit(1)).over(item) * RARE)).alias("rare"),
    ).join(seeds.groupBy("item_key").agg((F.max("item_at") + GRAM).alias("item_words")), "item_key"),
        "rare_seeds")
    pair = ["doc_id", "text_key", "item_id", "item_key", "item_words"]
    bands = hits.join(seeds, "seed").join(rare, ["item_key", "item_at"]).groupBy(
        *pair, F.floor((F.col("at") - F.col("item_at")) / BAND).alias("band"), "item_at",
    ).agg(F.max("rare").alias("rare")).groupBy(*pair, "band").agg(
        F.count(F.lit(1)).alias("seeds"), F.max("rare").alias("rare"))
    near = Window.partitionBy(*pair).orderBy("band").rangeBetween(-1, 1)
    needed = F.greatest(F.lit(2), F.floor(F.col("item_words") / SUPPORT))
    return bands.withColumn("near", F.sum("seeds").over(near)).filter(
        F.col("rare") | (F.col("near") >= needed)
    ).select(
        "doc_id", "text_key", "item_id", "item_key",
        (F.col("band") * BAND - F.col("item_words")).cast("int").alias("low"),
        (F.col("band") * BAND + BAND + 2 * F.col("item_words")).cast("int").alias("high"))


def leaked_passages(docs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, text_key, item_id, score, start, end) of passages that score ``threshold``."""
    found = passages(docs, items).groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("item_id", "item_key", "low", "high")).alias("passages"))
    found = stored(found, "passages").withColumnsRenamed(
        {"doc_id": "found_id", "text_key": "found_key"})
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").join(
        found, F.col("doc_id").eqNullSafe(F.col("found_id"))
        & (F.col("text_key") == F.col("found_key")))
    cut = texts.select("doc_id", "text_key", F.lower("text").alias("text"), "passages").mapInArrow(
        _stretches, _STRETCH_FIELDS)
    words = _items(items).select(
        F.col("text_key").alias("item_key"), F.lower("text").alias("item")).distinct()
    return cut.join(words, "item_key").mapInArrow(
        _aligned(threshold), "doc_id bigint, text_key bigint, item_id bigint,"
        " score double, start int, end int")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word) of every leaked item of a document.

    One row per pair, that of its best passage; of passages of one score the first.
    Items of fewer words than a seed, NULL and empty texts have no seed and are never
    found; NULL ids are ids like others. Rows of one doc_id count as one document. Texts
    of any length are read whole; of extra columns nothing is read; without documents
    or items nothing is found.
    """
    scored = leaked_passages(docs, items, threshold)
    best = scored.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("score", -F.col("start"), -F.col("end"))).alias("best"))
    return best.select(
        "doc_id", "item_id", F.round("best.score", 6).alias("score"),
        (-F.col("best.col2")).alias("start_word"), (-F.col("best.col3")).alias("end_word"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no leaked item.

    A row goes if a row of its id and text leaks: other texts of the same id stay, and
    so do clean texts without an id beside a leaked one without an id.
    """
    leaked = stored(leaked_passages(docs, items, THRESHOLD).select(
        F.col("doc_id").alias("_leaked_id"), F.col("text_key").alias("_leaked_key")).distinct(),
        "leaked")
    return docs.join(
        leaked, (F.xxhash64(docs["text"]) == leaked["_leaked_key"])
        & docs["doc_id"].eqNullSafe(leaked["_leaked_id"]), "left_anti")
