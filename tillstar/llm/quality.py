"""Text quality by histogram gradient-boosted trees over document statistics.

The trees are fitted in numpy on the statistics of a bounded sample of labelled rows
(``SAMPLE_ROWS``, thinned out by hashes), which are a few MB. The fitted trees are
complete binary trees in flat arrays, a few KB; every task walks all of its rows
down one tree at a time, one array operation per level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm import text_blocks as tb
from tillstar.llm.tables import held_out, stored

#: About so many labelled rows are fitted at most; learning needs no more for so few statistics.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS = 60, 3, 32
RATE, L2, LEAST_WEIGHT = 0.2, 1.0, 1.0
#: Scores of this and more are predicted good.
CUT = 0.7
FOLDS, TEST_FOLD = 4, 2

STATISTICS = (
    "log_words", "word_bytes", "long_words", "short_words", "letters", "digits", "blanks",
    "symbols", "capitals", "pipes", "ends", "commas", "distinct_words", "top_word",
    "repeats_before", "lone_symbols", "log_lines", "words_a_line", "distinct_lines",
    "symbol_words",
)

_KINDS = np.zeros(256, np.uint8)  # letter 1, capital 2, digit 3, blank 4, symbol 5
_KINDS[33:127] = 5
_KINDS[[*range(97, 123), *range(128, 256)]] = 1
_KINDS[65:91], _KINDS[48:58] = 2, 3
_KINDS[[9, 10, 11, 12, 13, 32]] = 4
_NOT_BLANK = _KINDS != 4


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: different values, and how often the most frequent one occurs."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, rows))
    same_row, value = rows[order], hashes[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (same_row[1:] != same_row[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(value)))
    most = np.zeros(len(bounds) - 1)
    np.maximum.at(most, same_row[at], runs)
    return np.bincount(same_row[at], minlength=len(bounds) - 1).astype(np.float64), most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; all zeros for an empty one."""
    data, offsets = tb.raw_bytes(texts)
    starts, ends, words = tb.word_bounds(data, offsets, _NOT_BLANK)
    lines_at, lines_end, lines = tb.word_bounds(data, offsets, np.arange(256) != 10)
    kinds = _KINDS[data]
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    count = np.diff(words).astype(np.float64)
    n, n_lines = np.maximum(count, 1), np.maximum(np.diff(lines), 1).astype(np.float64)
    length = (ends - starts).astype(np.float64)
    hashes = tb.word_hashes(data, starts, ends)
    distinct, most = _distinct(hashes, words)
    whole_lines, _ = _distinct(tb.word_hashes(data, lines_at, lines_end), lines)
    again = np.zeros(len(hashes))
    again[1:] = hashes[1:] == hashes[:-1]
    again[words[:-1][np.diff(words) > 0]] = 0
    symbols = np.zeros(len(data) + 1)
    np.cumsum(kinds == 5, out=symbols[1:])
    in_word = symbols[ends] - symbols[starts]
    last = data[ends - 1] if len(ends) else data
    share = lambda mask: _sums(mask, offsets) / size
    of_words = lambda mask: _sums(mask, words) / n
    return np.column_stack([
        np.log1p(count), of_words(length), of_words(length > 12), of_words(length <= 2),
        share((kinds == 1) | (kinds == 2)), share(kinds == 3), share(kinds == 4),
        share(kinds == 5), share(kinds == 2), share(data == 124),
        of_words(np.isin(last, [33, 46, 63])), of_words(last == 44), distinct / n, most / n,
        of_words(again), of_words((in_word == length) & (length > 0)), np.log1p(n_lines),
        np.log1p(count / n_lines), whole_lines / n_lines, of_words(in_word >= 2),
    ]).astype(np.float32)


def _all_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the text last; the statistics take its place."""
    for batch in batches:
        for start, stop, texts in tb.blocks(batch.column(batch.num_columns - 1)):
            values = statistics(texts)
            kept = batch.slice(start, stop - start).columns[:-1]
            flat = pa.FixedSizeListArray.from_arrays(
                pa.array(values.ravel()), len(STATISTICS)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*kept, flat], ["key", "good", "stats"])


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: node k has the children 2k+1 and 2k+2."""

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # the row goes right if its value is greater
    leaf: np.ndarray  # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for the logistic loss on values binned at their quantiles.

    Without rows the score is 1, so that nothing is rejected without evidence;
    with one label only, the smoothed rate of that label.
    """
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    if not len(y):
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)),
                     np.zeros((0, leaves)), np.inf)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    n_features = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))
             for f in range(n_features)]
    bins = np.column_stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)])
    cells = bins + np.arange(n_features) * BINS
    features, cuts, values = [], [], []
    margin = np.full(len(y), base)
    for _ in range(TREES if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (n_features * BINS) + cells).ravel()
            shape = (width, n_features, BINS)
            g, h = (np.bincount(at, np.repeat(v, n_features), width * n_features * BINS)
                    .reshape(shape).cumsum(axis=2) for v in (grad, hess))
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + L2) + (all_g - g)**2 / (all_h - h + L2) - all_g**2 / (all_h + L2)
            gain[(h < LEAST_WEIGHT) | (all_h - h < LEAST_WEIGHT)] = 0
            for f, e in enumerate(edges):
                gain[:, f, len(e):] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-9:
                    feature[first + k], cut[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        place = node - inner
        leaf = -RATE * np.bincount(place, grad, leaves) / (np.bincount(place, hess, leaves) + L2)
        margin += leaf[place]
        features.append(feature)
        cuts.append(cut)
        values.append(leaf)
    return Trees(np.array(features, np.int64).reshape(-1, inner),
                 np.array(cuts).reshape(-1, inner), np.array(values).reshape(-1, leaves), base)


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(key, good, stats) of about ``rows`` labelled texts outside the test fold, at most.

    Each (id, text) counts once. Several labels of one id count by their majority, a tie
    as good; NULL labels and NULL ids do not count. Hashes of the id thin out the labels
    before the join, so that only the sample's texts are looked at, and hashes of id
    and text the joined rows, should many texts share an id.
    """
    verdicts = stored(
        labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(
            (F.avg("quality") >= 0.5).cast("int").alias("good")
        ).filter(~held_out("doc_id", FOLDS, TEST_FOLD)), "quality_labels")
    found = docs.select("doc_id", "text").join(
        verdicts.filter(_taken("doc_id", rows / max(1, verdicts.count()))), "doc_id"
    ).groupBy(F.xxhash64("doc_id", "text").alias("key")).agg(
        F.max("good").alias("good"), F.first("text").alias("text"))
    found = stored(found.mapInArrow(
        _all_statistics, "key bigint, good int, stats array<float>"), "quality_sample")
    return found.filter(_taken("key", rows / max(1, found.count())))


def _taken(column: str, share: float) -> Column:
    """True for ``share`` of the values, by their hashes."""
    return F.pmod(F.xxhash64(column), F.lit(1 << 30)) < min(1 << 30, int(share * (1 << 30)))


def training_rows(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of ``sample``."""
    rows = sample(docs, labels).toArrow().sort_by("key")
    if not rows.num_rows:
        return np.zeros((0, len(STATISTICS)), np.float32), np.zeros(0)
    stats = rows.column("stats").combine_chunks().flatten().to_numpy()
    return stats.reshape(-1, len(STATISTICS)), rows.column("good").to_numpy().astype(np.float64)


def _scored(trees: Trees):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in tb.blocks(batch.column(2)):
                mine = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [mine.column(0), mine.column(1), pa.array(trees.score(statistics(texts)))],
                    ["doc_id", "held_out", "score"])

    return score


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    ``score`` is the fitted probability of label 1, ``predicted`` 1 from CUT on.
    NULL and empty texts have statistics of zero and get a score like any other. Texts
    of any length are read whole. Repeated rows are scored alike. Without documents the
    result is empty; see ``fit`` for tables without labels. Extra columns are not read.
    """
    trees = fit(*training_rows(docs, labels))
    return docs.select(
        "doc_id", held_out("doc_id", FOLDS, TEST_FOLD).alias("held_out"), "text"
    ).mapInArrow(
        _scored(trees), "doc_id bigint, held_out boolean, score double"
    ).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is predicted good."""
    trees = fit(*training_rows(docs, labels))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in tb.blocks(batch.column("text")):
                good = trees.score(statistics(texts)) >= CUT
                yield batch.slice(start, stop - start).filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
