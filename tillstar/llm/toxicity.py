"""Toxicity by a convolutional text classifier.

A word has an embedding of EMBEDDING numbers for the whole word and for its first
characters (PREFIXES), each from a table of BUCKETS rows that is addressed by a hash;
inflected forms share the latter, and words that meet in one table hardly meet in
all. Filters of several widths slide over the words, the greatest
answer of each filter over the whole text is kept, and a logistic unit adds them up.
All of it is trained in numpy with minibatches; only the words under a filter's
greatest answer get a gradient, so a step costs little more than its forward pass.

Every labelled row outside the test fold is learned from. Where the labels meet the texts,
the rows are cut into shards of a bounded size, written once as word numbers. In each of
ROUNDS every shard trains the network of the round before on all of its rows, PASSES
times, and the shards' networks are averaged by their rows (an embedding over the shards
that moved it), first those of a task, then those of all tasks. A round is one Spark job, as
many tasks as cores send one network each, and the driver holds one network of a fixed size.
Every task applies the last one to its texts in blocks. Thresholds per language are set on the
rows of the shards that are not trained on, all of them.

A text is shuffled to meet its label only if a bitmap of the labelled ids may hold its id.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm import text_blocks as tb
from tillstar.llm.tables import held_out, stored
from tillstar.operators.lookups import maybe_among

#: Most labelled rows of a shard and bytes of their texts.
SHARD_ROWS, SHARD_BYTES = 4_000, 12 << 20
BUCKETS, EMBEDDING, PREFIXES = 1 << 15, 8, (6, 4)
WIDTHS, FILTERS = (1, 2, 3), 8
ROUNDS, PASSES, BATCH, RATE, SEED = 4, 2, 64, 0.1, 1
#: A round has as many tasks as the session has cores, and no fewer, if there are shards.
LEAST_TASKS = 4
#: A minibatch ends before it has more words, unless one text alone has.
BATCH_WORDS = 1 << 19
#: Scores of this and more are predicted toxic.
CUT = 0.3
FOLDS, TEST_FOLD = 4, 2
#: One of so many labelled rows sets thresholds instead of training.
CALIBRATION = 5
#: Steps between scores 0 and 1 that thresholds tell apart.
GRID = 1 << 16
#: A language with fewer toxic or other rows there takes the threshold of all languages.
LEAST_CALIBRATED = 10

_PADS, _TABLES = max(WIDTHS), 1 + len(PREFIXES)
_TAPS = [(w, k) for w in WIDTHS for k in range(w)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tables x words: each word's row in every table; and for each text the words before it."""
    data, offsets = tb.raw_bytes(texts)
    data = _LOWER[data]
    starts, ends, bounds = tb.word_bounds(data, offsets)
    begins_character = (data & 0xC0) != 0x80
    characters = np.flatnonzero(begins_character)
    first = (np.cumsum(begins_character) - 1)[starts]
    numbers = np.empty((_TABLES, len(starts)), np.uint16)
    for t, length in enumerate((None, *PREFIXES)):
        stops = ends
        if length:
            after = first + length
            inside = after < len(characters)
            stops = np.where(inside, characters[np.where(inside, after, 0)], len(data))
            stops = np.minimum(stops, ends)
        hashes = tb.word_hashes(data, starts, stops)
        numbers[t] = (hashes >> np.uint64(12 * t)) % np.uint64(BUCKETS)
    return numbers, bounds


def padded(numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers with empty places after each text, so that every filter fits in it."""
    texts, words = len(bounds) - 1, numbers.shape[1]
    begin = bounds + _PADS * np.arange(texts + 1)
    at = np.arange(words) + _PADS * np.repeat(np.arange(texts), np.diff(bounds))
    out = np.full((_TABLES, words + _PADS * texts), BUCKETS, np.int32)
    out[:, at] = numbers
    return out, begin


@dataclass
class Network:
    """Embeddings, filters and the last unit; row BUCKETS of a table is the empty place."""

    tables: list[np.ndarray]
    filters: np.ndarray  # taps x all embeddings x FILTERS
    shift: np.ndarray  # of each filter
    weight: np.ndarray
    base: float
    squares: dict[str, np.ndarray] = field(default_factory=dict)  # sums of squared gradients

    @staticmethod
    def new(rate: float, seed: int = SEED) -> Network:
        draw = np.random.default_rng(seed)
        normal = lambda scale, *shape: draw.normal(0, scale, shape).astype(np.float32)
        tables = [normal(0.1, BUCKETS + 1, EMBEDDING) for _ in range(_TABLES)]
        for t in tables:
            t[BUCKETS] = 0
        outputs = FILTERS * len(WIDTHS)
        return Network(tables, normal(0.3, len(_TAPS), _TABLES * EMBEDDING, FILTERS),
                       np.zeros(outputs, np.float32), normal(0.3, outputs),
                       float(np.log(rate / (1 - rate))))

    def embedded(self, numbers: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [t[n] for t, n in zip(self.tables, numbers, strict=True)], axis=1)

    def answers(self, numbers: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
        """Of each width: places x FILTERS; places where a filter leaves its text are -inf."""
        # Rounded from doubles: a product of floats may depend on a word's place among others.
        y = (self.embedded(numbers).astype(np.float64) @ self.filters.transpose(1, 0, 2).reshape(
            _TABLES * EMBEDDING, -1).astype(np.float64)).astype(np.float32)
        out, tap = [], 0
        for width in WIDTHS:
            total = y[:, tap * FILTERS:(tap + 1) * FILTERS].copy()
            for k in range(1, width):
                total[:-k] += y[k:, (tap + k) * FILTERS:(tap + k + 1) * FILTERS]
            for k in range(1, width):
                total[begin[1:] - k] = -np.inf
            out.append(total)
            tap += width
        return out

    def pooled(self, answers: list[np.ndarray], begin: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [np.maximum.reduceat(a, begin[:-1], axis=0) for a in answers], axis=1)

    def probability(self, numbers: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each text."""
        top = self.pooled(self.answers(numbers, begin), begin) + self.shift
        # Summed row by row: a matrix product may round a text by its place among others.
        return _sigmoid((np.maximum(top, 0) * self.weight).sum(axis=1) + self.base)

    def step(self, numbers: np.ndarray, begin: np.ndarray, y: np.ndarray) -> None:
        """One minibatch of the logistic loss."""
        answers = self.answers(numbers, begin)
        top = self.pooled(answers, begin)
        held = np.maximum(top + self.shift, 0)
        error = ((_sigmoid(held @ self.weight + self.base) - y) / len(y)).astype(np.float32)
        back = error[:, None] * self.weight * (held > 0)
        filters = np.zeros_like(self.filters)
        touched: list[tuple[np.ndarray, np.ndarray]] = []
        lengths, tap = np.diff(begin), 0
        for w, width in enumerate(WIDTHS):
            part = slice(w * FILTERS, (w + 1) * FILTERS)
            place, unit = np.nonzero(answers[w] == np.repeat(top[:, part], lengths, axis=0))
            text = np.searchsorted(begin, place, "right") - 1
            _, once = np.unique(text * FILTERS + unit, return_index=True)
            place, unit, text = place[once], unit[once], text[once]
            d = back[:, part][text, unit]
            place, unit, d = place[d != 0], unit[d != 0], d[d != 0]
            for k in range(width):
                at = place + k
                x = self.embedded(numbers[:, at])
                np.add.at(filters[tap + k].T, unit, d[:, None] * x)
                touched.append((at, d[:, None] * self.filters[tap + k].T[unit]))
            tap += width
        self._move("filters", self.filters, filters)
        self._move("shift", self.shift, back.sum(axis=0))
        self._move("weight", self.weight, error @ held)
        self.base -= RATE * float(error.sum())
        places = np.concatenate([a for a, _ in touched])
        grads = np.concatenate([g for _, g in touched])
        for t, table in enumerate(self.tables):
            rows, of = np.unique(numbers[t, places], return_inverse=True)
            grad = np.zeros((len(rows), EMBEDDING), np.float32)
            np.add.at(grad, of, grads[:, t * EMBEDDING:(t + 1) * EMBEDDING])
            grad[rows == BUCKETS] = 0
            self._move(f"table{t}", table, grad, rows)

    def _move(self, name: str, values: np.ndarray, grad: np.ndarray, rows=...) -> None:
        """Against the gradient, by steps that shrink with the squares met so far."""
        if name not in self.squares:
            self.squares[name] = np.zeros_like(values)
        self.squares[name][rows] += grad**2
        values[rows] -= RATE * grad / (np.sqrt(self.squares[name][rows]) + 1e-6)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass(frozen=True)
class Sample:
    """Word numbers of whole texts one after the other, their labels and languages."""

    numbers: np.ndarray
    bounds: np.ndarray
    toxic: np.ndarray
    lang: list[str | None]

    def take(self, rows: np.ndarray) -> Sample:
        sizes = np.diff(self.bounds)[rows]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.bounds[rows] - bounds[:-1], sizes) + np.arange(bounds[-1])
        return Sample(self.numbers[:, at], bounds, self.toxic[rows],
                      [self.lang[r] for r in rows])


def minibatches(sizes: np.ndarray, order: np.ndarray) -> Iterator[np.ndarray]:
    """``order`` in runs of BATCH rows, or fewer with BATCH_WORDS words in all."""
    start = words = 0
    for end, size in enumerate(sizes[order]):
        if end > start and (end - start == BATCH or words + size > BATCH_WORDS):
            yield order[start:end]
            start, words = end, 0
        words += size
    if len(order):
        yield order[start:]


def best_threshold(
    scores: np.ndarray, toxic: np.ndarray, rows: np.ndarray | None = None
) -> float:
    """The cut with the highest F1, in the middle between two neighbouring scores.

    ``toxic`` are the toxic ones of the ``rows`` (one each) that have a score.
    """
    order = np.argsort(-scores, kind="stable")
    rows = np.ones(len(scores)) if rows is None else rows
    scores, hits, found = scores[order], np.cumsum(toxic[order]), np.cumsum(rows[order])
    f1 = 2 * hits / (found + toxic.sum())
    f1[:-1][scores[:-1] == scores[1:]] = -1  # equal scores fall on one side
    k = int(np.argmax(f1))
    return float(scores[k] + (scores[k + 1] if k + 1 < len(scores) else 0)) / 2


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, toxic, lang, text) of the labelled texts outside the test fold, each (id, text) once.

    Several labels of an id count by their majority, a tie as toxic. NULL labels and NULL
    ids do not count. Rows of an id are in one partition, since labels and texts meet by id.
    """
    verdicts = stored(labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        (F.avg("toxic") >= 0.5).cast("int").alias("toxic")), "toxic_labels")
    labelled = verdicts.filter(~held_out("doc_id", FOLDS, TEST_FOLD))
    # As text, so that ids of two integer types have one hash.
    hashed = F.xxhash64(F.col("doc_id").cast("string"))
    texts = maybe_among(docs.select("doc_id", "lang", "text"), hashed, labelled.select(hashed))
    return texts.join(labelled, "doc_id").groupBy(
        "doc_id", F.xxhash64("doc_id", "text").alias("key")).agg(
        F.max("toxic").alias("toxic"), F.min("lang").alias("lang"), F.first("text").alias("text")
    ).select("key", "toxic", "lang", "text")


def _sample(rows: pa.Table) -> Sample:
    rows = rows.sort_by("key")
    numbers, sizes = [np.zeros((_TABLES, 0), np.uint16)], [np.zeros(0, np.int64)]
    for batch in rows.select(["text"]).to_batches():
        for _, _, texts in tb.blocks(batch.column(0)):
            part, bounds = word_numbers(texts)
            numbers.append(part)
            sizes.append(np.diff(bounds))
    return Sample(np.concatenate(numbers, axis=1),
                  np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64),
                  rows.column("toxic").to_numpy().astype(np.float32),
                  rows.column("lang").to_pylist())


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = 10_000) -> Sample:
    """About ``rows`` of the labelled rows on the driver, to look at; learning reads them all."""
    every = labelled_rows(docs, labels)
    part = min(1.0, rows / max(1, every.count()))
    return _sample(every.filter(
        F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(part * (1 << 30))).toArrow())


_SHARD = ("shard bigint, train_rows bigint, train_toxic bigint, numbers binary, sizes binary,"
          " toxic binary, calibrating binary, lang array<string>")


def _packed(rows: pa.Table) -> pa.RecordBatch:
    """One row with the word numbers and labels of a shard's rows, ordered by key."""
    sample = _sample(rows)
    keys = np.sort(rows.column("key").to_numpy())
    calibrating = tb.mixed(keys.view(np.uint64)) % np.uint64(CALIBRATION) == 0
    training = sample.toxic[~calibrating]
    return pa.RecordBatch.from_pydict({
        "shard": pa.array(keys[:1], pa.int64()),
        "train_rows": [len(training)], "train_toxic": [int(training.sum())],
        "numbers": [sample.numbers.T.tobytes()], "sizes": [np.diff(sample.bounds).tobytes()],
        "toxic": [sample.toxic.tobytes()], "calibrating": [calibrating.tobytes()],
        "lang": pa.array([sample.lang], pa.list_(pa.string())),
    })


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition in runs of SHARD_ROWS and SHARD_BYTES at most; longer texts alone."""
    held, rows, size = [], 0, 0
    for batch in batches:
        for start, stop, texts in tb.blocks(batch.column(3), SHARD_BYTES // 4):
            for at in range(start, stop, SHARD_ROWS):
                part = batch.slice(at, min(SHARD_ROWS, stop - at))
                grown = texts.slice(at - start, part.num_rows).nbytes
                if held and (rows + part.num_rows > SHARD_ROWS or size + grown > SHARD_BYTES):
                    yield _packed(pa.Table.from_batches(held))
                    held, rows, size = [], 0, 0
                held.append(part)
                rows, size = rows + part.num_rows, size + grown
    if held:
        yield _packed(pa.Table.from_batches(held))


def _unpacked(row: pa.RecordBatch) -> tuple[Sample, np.ndarray]:
    """The rows of a shard, and which of them set thresholds instead of training."""
    of = lambda name, kind: np.frombuffer(row.column(name)[0].as_buffer(), kind)
    return Sample(of("numbers", np.uint16).reshape(-1, _TABLES).T,
                  np.concatenate([[0], np.cumsum(of("sizes", np.int64))]),
                  of("toxic", np.float32), row.column("lang")[0].as_py()), of("calibrating", bool)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1)


_DENSE = ("filters", "shift", "weight")


class Sums:
    """Weighted sums of one part's rows over the networks that have them."""

    def __init__(self) -> None:
        self.total: np.ndarray | None = None
        self.times = np.zeros(0)

    def add(self, part: int, at: np.ndarray, values: np.ndarray, weights: np.ndarray | int) -> None:
        if not len(at):
            return
        if self.total is None:
            self.total = np.zeros((BUCKETS + 1 if part else 1, values.shape[1]))
            self.times = np.zeros(len(self.total))
        self.total[at] += np.reshape(weights, (-1, 1)) * values.astype(np.float64)
        self.times[at] += weights

    def means(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rows that some network has, their means and the weights behind these."""
        at = np.flatnonzero(self.times)
        if not len(at):
            return at.astype(np.int32), np.zeros(0, np.float32), at
        return (at.astype(np.int32), (self.total[at] / self.times[at, None]).astype(np.float32),
                self.times[at].astype(np.int64))


def _changed(start: Network, network: Network) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All dense parameters, then the rows moved of each table, with their sums of squares."""
    squares = lambda name, like: network.squares.get(name, np.zeros_like(like))
    dense = [v for name in _DENSE for v in (
        getattr(network, name), squares(name, getattr(network, name)))]
    yield np.zeros(1, np.int32), np.concatenate(
        [*[v.ravel() for v in dense], [network.base]]).astype(np.float32)[None]
    for t, table in enumerate(network.tables):
        moved = np.flatnonzero((table != start.tables[t]).any(axis=1)).astype(np.int32)
        yield moved, np.hstack([table, squares(f"table{t}", table)])[moved]


_PARTS = "task bigint, part int, at binary, numbers binary, weights binary"


def _trained(start: Network, epoch: int):
    """The mean of a task's shards after PASSES over the rows of each, weighted by these rows."""
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sums = None, [Sums() for _ in range(1 + _TABLES)]
        for row in _rows_of(batches):
            sample, calibrating = _unpacked(row)
            training, shard = np.flatnonzero(~calibrating), row.column("shard")[0].as_py()
            if not len(training):
                continue
            network = copy.deepcopy(start)
            draw = np.random.default_rng([SEED, epoch, shard % (1 << 63)])
            for order in [draw.permutation(training) for _ in range(PASSES)]:
                for part in map(sample.take, minibatches(np.diff(sample.bounds), order)):
                    network.step(*padded(part.numbers, part.bounds), part.toxic)
            task = shard if task is None else task
            for part, (at, values) in enumerate(_changed(start, network)):
                sums[part].add(part, at, values, len(training))
        if task is None:
            return
        out = [s.means() for s in sums]
        yield pa.RecordBatch.from_arrays(
            [pa.array([task] * len(out), pa.int64()), pa.array(range(len(out)), pa.int32()),
             *[pa.array([arrays[k].tobytes() for arrays in out], pa.binary()) for k in range(3)]],
            ["task", "part", "at", "numbers", "weights"])

    return train


def _mean(parts: pa.Table) -> pa.Table:
    """The mean of each row of one part over the tasks that have it, by their weights."""
    number, sums = parts.column("part")[0].as_py(), Sums()
    for part in parts.sort_by("task").to_pylist():
        at = np.frombuffer(part["at"], np.int32)
        values = np.frombuffer(part["numbers"], np.float32).reshape(len(at), -1) if len(at) else at
        sums.add(number, at, values, np.frombuffer(part["weights"], np.int64))
    at, means, _ = sums.means()
    return pa.table({"part": pa.array([number], pa.int32()),
                     "at": [at.tobytes()], "numbers": [means.tobytes()]})


def _moved(start: Network, means: list[dict]) -> Network:
    """``start`` with the averaged parameters in their places."""
    network = copy.deepcopy(start)
    for mean in means:
        at = np.frombuffer(mean["at"], np.int32)
        values = np.frombuffer(mean["numbers"], np.float32)
        if mean["part"]:
            t, name = mean["part"] - 1, f"table{mean['part'] - 1}"
            values = values.reshape(len(at), 2 * EMBEDDING) if len(at) else np.zeros((0, 2 * EMBEDDING))
            network.squares.setdefault(name, np.zeros_like(network.tables[t]))
            network.tables[t][at] = values[:, :EMBEDDING]
            network.squares[name][at] = values[:, EMBEDDING:]
            continue
        for name in _DENSE:
            like = getattr(network, name)
            setattr(network, name, values[:like.size].reshape(like.shape).copy())
            network.squares[name] = values[like.size:2 * like.size].reshape(like.shape).copy()
            values = values[2 * like.size:]
        network.base = float(values[0])
    return network


def fit(shards: DataFrame, rounds: int = ROUNDS) -> Network | float:
    """The trained network; a constant score where the rows hold one label or none."""
    size = shards.agg(F.sum("train_rows").alias("n"), F.sum("train_toxic").alias("toxic")).head()
    if not size["n"]:
        return 0.0
    rate = (size["toxic"] + 0.5) / (size["n"] + 1)
    if size["toxic"] in (0, size["n"]):
        return float(rate)
    network = Network.new(rate)
    tasks = max(LEAST_TASKS, shards.sparkSession.sparkContext.defaultParallelism)
    for epoch in range(rounds):
        means = shards.coalesce(tasks).mapInArrow(_trained(network, epoch), _PARTS).groupBy("part").applyInArrow(
            _mean, "part int, at binary, numbers binary")
        network = _moved(network, means.toArrow().sort_by("part").to_pylist())
    network.squares.clear()
    return network


def _score_counts(network: Network):
    """Rows and toxic rows of each language and score of GRID, among those not trained on."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            sample, calibrating = _unpacked(row)
            order = np.flatnonzero(calibrating)
            scores = [np.zeros(0)]
            for part in map(sample.take, minibatches(np.diff(sample.bounds), order)):
                scores.append(network.probability(*padded(part.numbers, part.bounds)))
            step = np.rint(np.concatenate(scores) * GRID).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([sample.lang[r] for r in order], pa.string()), pa.array(step),
                 pa.array(sample.toxic[order].astype(np.int64))], ["lang", "step", "toxic"])

    return count


def _threshold(counts: pa.Table) -> pa.Table:
    """The threshold of one language, from one row per score."""
    counts = counts.sort_by("step")
    step, rows, toxic = (counts.column(c).to_numpy() for c in ("step", "rows", "toxic"))
    return pa.table({
        "every": counts.column("every").slice(0, 1), "lang": counts.column("lang").slice(0, 1),
        "rows": [int(rows.sum())], "toxic": [int(toxic.sum())],
        "threshold": [best_threshold(step / GRID, toxic, rows)]})


def thresholds_by_language(
    model: Network | float, shards: DataFrame
) -> tuple[float, dict[str, float]]:
    """The threshold of all languages, CUT without rows of both labels, and those of each."""
    if isinstance(model, float):
        return CUT, {}
    counts = shards.mapInArrow(_score_counts(model), "lang string, step bigint, toxic bigint")
    counts = counts.groupBy("lang", "step").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("toxic").alias("toxic"))
    counts = counts.select(F.explode(F.array(F.lit(True), F.lit(False))).alias("every"),
                           "lang", "step", "rows", "toxic")
    counts = counts.filter("every or lang is not null").groupBy(
        "every", F.expr("if(every, null, lang)").alias("lang"), "step").agg(
        F.sum("rows").alias("rows"), F.sum("toxic").alias("toxic"))
    found = counts.groupBy("every", "lang").applyInArrow(
        _threshold, "every boolean, lang string, rows bigint, toxic bigint, threshold double"
    ).filter(F.least("toxic", F.col("rows") - F.col("toxic"))
             >= F.when(F.col("every"), 1).otherwise(LEAST_CALIBRATED)).collect()
    every = [r["threshold"] for r in found if r["every"]]
    return (every[0] if every else CUT), (
        {r["lang"]: r["threshold"] for r in found if not r["every"]} if every else {})


@dataclass(frozen=True)
class Classifier:
    model: Network | float
    threshold: float
    by_lang: dict[str, float]


def training_shards(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All ``labelled_rows`` as word numbers, one row per shard."""
    return stored(labelled_rows(docs, labels).mapInArrow(_shards, _SHARD), "toxic_shards")


def learn(docs: DataFrame, labels: DataFrame) -> Classifier:
    """The network and the thresholds, from all labelled rows outside the test fold."""
    shards = training_shards(docs, labels)
    model = fit(shards)
    return Classifier(model, *thresholds_by_language(model, shards))


def _scored(c: Classifier):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in tb.blocks(batch.column(3)):
                mine = batch.slice(start, stop - start)
                scores = (np.full(len(texts), c.model) if isinstance(c.model, float)
                          else c.model.probability(*padded(*word_numbers(texts))))
                cuts = [c.by_lang.get(v, c.threshold) for v in mine.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [mine.column(0), mine.column(1), pa.array(scores, pa.float64()),
                     pa.array(cuts, pa.float64())],
                    ["doc_id", "held_out", "score", "threshold"])

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, threshold, flagged) of every row of ``docs``.

    ``score`` comes from the text alone; ``predicted`` is 1 from CUT on, ``flagged`` 1 from
    the calibrated ``threshold`` of the row's language on (NULL and rare languages: that of
    all). NULL and empty texts are scored as texts without words. Texts of any
    length are scored whole. Repeated rows are scored alike. Without labels all scores are
    0, with one label only its smoothed rate. Extra columns are not read.
    """
    rows = docs.select(
        "doc_id", held_out("doc_id", FOLDS, TEST_FOLD).alias("held_out"), "lang", "text")
    return rows.mapInArrow(
        _scored(learn(docs, labels)),
        "doc_id bigint, held_out boolean, score double, threshold double",
    ).select("doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"),
             "threshold", (F.col("score") >= F.col("threshold")).cast("int").alias("flagged"))
