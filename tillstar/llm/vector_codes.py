"""Compression of vectors to one codebook entry per part.

The nearest entry is found by slicing and intersecting: in every dimension of a part
the entries are sorted by their coordinate, and prefix masks (one bit per entry) tell
which entries lie below each place. A radius cuts a range out of every dimension; the
range's mask is the difference of two prefix masks, and the masks of all dimensions
are ANDed as uint64 words. What is left are exactly the entries within the radius in
every dimension, and only those are measured. An entry that is measured within the
radius is the nearest one. Otherwise the radius becomes the distance measured, or is
doubled if no entry was left, and the search is repeated for these parts.

Spark spreads the vectors over tasks. A task holds one batch, the codebooks
(PARTS x ENTRIES x part length) and as many sums. A round sends one number per
codebook component and task through the shuffle, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.tables import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components count as at most so much, which keeps all distances exact in 64 bits
#: for up to 4,096 dimensions.
LARGEST = 1 << 24
#: Parts searched at a time: they meet at most so many times ENTRIES candidates.
SEARCHED = 1024
#: The first radius, as a multiple of the mean deviation of the entries' coordinates.
FIRST_RADIUS = 1.5
_WORDS = ENTRIES // 64


class PartIndex:
    """Sorted coordinates of one part's entries with their prefix masks."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        count, width = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.coordinates = np.take_along_axis(entries, order, axis=0).T.copy()
        bits = np.zeros((count, _WORDS), np.uint64)
        numbers = np.arange(count)
        bits[numbers, numbers // 64] = np.uint64(1) << (numbers % 64).astype(np.uint64)
        self.prefixes = np.zeros((width, count + 1, _WORDS), np.uint64)
        for d in range(width):
            self.prefixes[d, 1:] = np.bitwise_or.accumulate(bits[order[:, d]], axis=0)
        self.every = np.bitwise_or.reduce(bits, axis=0)
        deviation = np.abs(entries - entries.mean(axis=0)).mean() if entries.size else 0
        self.first_radius = max(1, int(FIRST_RADIUS * deviation))

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The mask of the entries within ``radius`` of each row in every dimension."""
        masks = np.broadcast_to(self.every, (len(x), _WORDS)).copy()
        for d, (sorted_d, prefix) in enumerate(zip(self.coordinates, self.prefixes, strict=True)):
            low = np.searchsorted(sorted_d, x[:, d] - radius, "left")
            high = np.searchsorted(sorted_d, x[:, d] + radius, "right")
            masks &= prefix[high] ^ prefix[low]
        return masks

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row, the lowest one of equals, and its squared distance."""
        entry, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        for start in range(0, len(x), SEARCHED):
            stop = min(start + SEARCHED, len(x))
            open_rows = np.arange(start, stop)
            radius = np.full(stop - start, self.first_radius, np.int64)
            while len(open_rows):
                best, squared = self._measured(x[open_rows], radius)
                done = (best >= 0) & (squared <= radius**2)
                entry[open_rows[done]], distance[open_rows[done]] = best[done], squared[done]
                # One more than the root, as the root is rounded.
                radius = np.where(best < 0, 2 * radius, np.sqrt(squared).astype(np.int64) + 1)
                open_rows, radius = open_rows[~done], radius[~done]
        return entry, distance

    def _measured(self, x: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best candidate of each row, or -1 without one, and its squared distance."""
        masks = self.candidates(x, radius).astype("<u8", copy=False).view(np.uint8)
        rows, entries = np.nonzero(np.unpackbits(masks, axis=1, bitorder="little"))
        best, squared = np.full(len(x), -1, np.int64), np.zeros(len(x), np.int64)
        if len(rows):
            apart = x[rows] - self.entries[entries]
            measured = np.einsum("ij,ij->i", apart, apart)
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            squared[rows[first]] = np.minimum.reduceat(measured, first)
            ties = np.flatnonzero(measured == squared[rows])
            ties = ties[np.diff(rows[ties], prepend=-1) != 0]
            best[rows[ties]] = entries[ties]
        return best, squared


def integer_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, label, ints) of the rows whose vector is whole: floor(1024 * x) of each x."""
    whole = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    scaled = F.transform(column, lambda x: F.floor(F.greatest(F.lit(float(-LARGEST)), F.least(
        F.lit(float(LARGEST)), x.cast("double") * SCALE))).cast("int"))
    return vectors.filter(F.col(column).isNotNull() & whole).select(
        "vec_id", "label", scaled.alias("ints"))


def _parts(column: pa.Array, width: int) -> np.ndarray:
    """Rows x PARTS x ``width``, shorter vectors filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), PARTS * width), np.int64)
    out[np.arange(PARTS * width) < lengths[:, None]] = column.flatten().to_numpy()
    return out.reshape(len(column), PARTS, width)


def _sums(books: np.ndarray):
    """Per task: of every (part, entry) the count and the sums of its parts' components."""
    width = books.shape[2]

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [PartIndex(book) for book in books]
        total = np.zeros((*books.shape[:2], width + 1), np.int64)
        for batch in batches:
            x = _parts(batch.column(0), width)
            for p, index in enumerate(indexes):
                entry, _ = index.nearest(x[:, p])
                total[p, :, 0] += np.bincount(entry, minlength=books.shape[1])
                np.add.at(total[p, :, 1:], entry, x[:, p])
        flat = total.ravel()
        slots = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots), pa.array(flat[slots])], ["slot", "amount"])

    return sum_up


def _coded(books: np.ndarray):
    width = books.shape[2]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [PartIndex(book) for book in books]
        for batch in batches:
            x = _parts(batch.column(2), width)
            found = [index.nearest(x[:, p]) for p, index in enumerate(indexes)]
            entries = np.column_stack([entry for entry, _ in found]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([row.tobytes().hex() for row in entries], pa.string()),
                 pa.array(sum(distance for _, distance in found))],
                ["vec_id", "label", "code", "error"])

    return code


def learn_codebooks(ints: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """PARTS x entries x part length, from the written table of ``integer_vectors``.

    The start is taken from the ENTRIES smallest ids (NULL ids last, equal ids by
    their components). It and the sums of a round are all that the driver sees; their
    size depends on the codebook alone.
    """
    longest = ints.agg(F.coalesce(F.max(F.size("ints")), F.lit(0)).alias("n")).head()["n"]
    width = -(-longest // PARTS)
    first = stored(
        ints.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(ENTRIES), "first_vectors")
    rows = [r["ints"] for r in first.orderBy(F.col("vec_id").asc_nulls_last(), "ints").collect()]
    starts = np.zeros((len(rows), PARTS * width), np.int64)
    for k, row in enumerate(rows):
        starts[k, :len(row)] = row
    books = starts.reshape(len(rows), PARTS, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(rows) else 0):
        summed = ints.select("ints").mapInArrow(_sums(books), "slot bigint, amount bigint")
        total = np.zeros((PARTS, len(rows), width + 1), np.int64)
        for r in summed.groupBy("slot").agg(F.sum("amount").alias("amount")).collect():
            total.ravel()[r["slot"]] = r["amount"]
        used = total[:, :, 0] > 0
        books[used] = total[used][:, 1:] // total[used][:, :1]
    return books


def codebooks_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.ravel()))


def compress(vectors: DataFrame, column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every whole vector, and the codebooks.

    Rows whose vector is NULL or holds NULL, NaN or an infinite value are left out.
    Repeated rows count and are coded each. All vectors count as long as the longest
    one, rounded up to a multiple of PARTS; shorter ones are filled up with zeros.
    Components beyond LARGEST / SCALE count as that. An empty vector has the code of
    zeros. Without whole vectors the result is empty. Extra columns are not read.
    """
    ints = stored(integer_vectors(vectors, column), "integer_vectors")
    books = learn_codebooks(ints)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    label_type = vectors.schema["label"].dataType.simpleString()
    coded = ints.mapInArrow(
        _coded(books), f"vec_id {id_type}, label {label_type}, code string, error bigint")
    return coded, books


def codes(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``compress`` with the error of each label and the digest of the codebooks.

    The coded rows are written once; errors are summed per label before the join, so
    a hot label adds one row per task, and the planner knows both sides' sizes.
    """
    coded, books = compress(vectors, column)
    coded = stored(coded, "vector_codes")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(
        F.sum("error").alias("label_error"))
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
