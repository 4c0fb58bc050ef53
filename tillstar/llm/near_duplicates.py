"""Near-duplicate texts by SimHash fingerprints and a segment-popcount grid join.

A 64-bit fingerprint is embedded as 32 counts, the set bits of its 2-bit
segments, packed into one long. Every bit flip changes one count by one, so the
Manhattan distance of two embeddings is a lower bound of the Hamming distance.
The counts are dealt into GROUPS groups. Within a distance of 4 at most four
groups differ, so two linked fingerprints agree on GROUPS - 4 groups at least:
each fingerprint is put into one grid cell for every such choice of groups, and
a range join within cells keeps pairs whose Manhattan distance is 4 or less and
verifies them on the bits. More groups make more but finer cells; 6 groups make
15 cells with about 2**15 equally filled values, 8 groups 70 cells with 2**23.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.components import components
from tillstar.llm.tables import stored

DISTANCE = 4
GROUPS = 6
SHINGLE = 4
SEED = 42
_LANES = 0x5555555555555555
_CHUNK = 255  # bits summed in one byte


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text; 0 without words."""
    words = text.lower().split()  # bytes: A-Z and the ASCII blanks only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    hashed = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], np.uint64)
    bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // _CHUNK * _CHUNK
    ones = bits[whole:].sum(axis=0, dtype=np.uint8).astype(np.int64)
    if whole:
        ones += bits[:whole].reshape(-1, _CHUNK, 64).sum(axis=1, dtype=np.uint8).sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(bits), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        found = np.fromiter(
            (fingerprint(text.as_py() or b"") for text in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(found.view(np.int64))],
            ["doc_id", "text_key", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp) of every row; the fingerprint's 64 bits as a signed long."""
    return docs.select(
        "doc_id", F.encode("text", "UTF-8").alias("bytes"), F.xxhash64("text").alias("text_key")
    ).mapInArrow(_fingerprints, "doc_id bigint, text_key bigint, fp bigint")


def embedding(fp: Column) -> Column:
    """Set bits of each 2-bit segment, side by side in a long."""
    low = fp.bitwiseAND(F.lit(_LANES))
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_LANES))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def manhattan(x: Column, y: Column) -> Column:
    """Sum of the differences of two embeddings, whose counts are 0, 1 or 2."""
    diff = x.bitwiseXOR(y)
    low = diff.bitwiseAND(F.lit(_LANES))
    high = F.shiftrightunsigned(diff, 1).bitwiseAND(F.lit(_LANES))
    return F.bit_count(low) + 2 * F.bit_count(high.bitwiseAND(F.bitwise_not(low)))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _group_masks(groups: int) -> list[int]:
    bounds = [round(32 * g / groups) for g in range(groups + 1)]
    return [sum(3 << 2 * lane for lane in range(bounds[g], bounds[g + 1])) for g in range(groups)]


def links_between(prints: DataFrame, groups: int = GROUPS, distance: int = DISTANCE) -> DataFrame:
    """Pairs a < b of distinct fingerprints that differ in ``distance`` bits or fewer, once each.

    A pair may share several cells; it is kept in the one made of the first
    groups on which it agrees.
    """
    if groups <= distance:
        raise ValueError("more groups than the distance are needed")
    masks = _group_masks(groups)
    cells = [
        F.struct(
            F.lit(number).alias("cell"),
            F.lit(_signed(sum(masks[g] for g in chosen))).alias("mask"),
            F.lit(sum(1 << g for g in chosen)).alias("chosen"),
            F.lit((2 << max(chosen)) - 1).alias("upto"),
        )
        for number, chosen in enumerate(combinations(range(groups), groups - distance))
    ]
    placed = prints.select(
        "fp", embedding(F.col("fp")).alias("counts"), F.explode(F.array(*cells)).alias("at")
    ).select(
        "fp", "counts", "at.cell", "at.chosen", "at.upto",
        F.col("counts").bitwiseAND(F.col("at.mask")).alias("key"))
    x, y = placed.alias("x"), placed.alias("y")
    differs = F.col("x.counts").bitwiseXOR(F.col("y.counts"))
    agree = sum(
        (F.when(differs.bitwiseAND(F.lit(_signed(m))) == 0, 1 << g).otherwise(0)
         for g, m in enumerate(masks)), F.lit(0))
    return x.join(
        y,
        (F.col("x.cell") == F.col("y.cell")) & (F.col("x.key") == F.col("y.key"))
        & (F.col("x.fp") < F.col("y.fp"))
        & (manhattan(F.col("x.counts"), F.col("y.counts")) <= distance)
        & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= distance)
        # No other group up to the last chosen one agrees.
        & (agree.bitwiseAND(F.col("x.upto")) == F.col("x.chosen")),
    ).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))


def near_duplicates(docs: DataFrame, groups: int = GROUPS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id that can be reached over links.
    Equal fingerprints form one class first; links join classes only, so copies
    are never expanded. NULL and empty texts have fingerprint 0 and are linked
    like any other. NULL ids are never the smallest unless a component has no
    other. Repeated rows stay, with the same component.
    """
    return _components(docs, groups).select("doc_id", "fp", "component_id")


def _components(docs: DataFrame, groups: int) -> DataFrame:
    """(doc_id, text_key, fp, component, component_id); ``component`` is the smallest
    fingerprint of a component and names it even where no row has an id."""
    rows = stored(fingerprints(docs), "fingerprints")
    classes = stored(
        rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint_classes")
    links = stored(links_between(classes.select("fp"), groups), "fingerprint_links")
    members = components(links).join(classes, F.col("node") == F.col("fp"))
    members = stored(members.select("fp", "label", "first_id"), "linked_classes")
    smallest = stored(
        members.groupBy("label").agg(F.min("first_id").alias("component_id")), "component_ids")
    linked = members.join(smallest, "label").select("fp", "label", "component_id")
    resolved = stored(
        classes.join(linked, "fp", "left").select(
            "fp", F.coalesce("label", "fp").alias("component"),
            F.coalesce("component_id", "first_id").alias("component_id")),
        "resolved_classes")
    return rows.join(resolved, "fp")


def keep_one(docs: DataFrame, groups: int = GROUPS) -> DataFrame:
    """The rows of ``docs``, all columns, one of each component.

    It is the row with the smallest doc_id, NULL last; of several such rows the
    one with the smallest text hash, and of rows equal in both any one.
    """
    best = stored(
        _components(docs, groups).groupBy("component").agg(F.min(F.struct(
            F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("best")
        ).select(F.col("best.doc_id").alias("_id"), F.col("best.text_key").alias("_key")),
        "kept")
    rows = docs.select(
        F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_key"))
    kept = rows.join(
        best, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")),
        "left_semi")
    return kept.dropDuplicates(["doc_id", "text_key"]).select("row.*")
