"""Language identification of mixed text: script ranges, word scores and Viterbi.

Character trigrams of every training row are counted per language into
``BUCKETS`` hashed cells, a bounded model that all data feed. A word's score is
the sum of the logarithms of its trigrams' shares. The script of its letters
narrows its languages to those that use the script in training. Viterbi then
labels the words of a text, a change of language costing ``SWITCH``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm import text_blocks as tb
from tillstar.llm.tables import held_out

#: Cells of the model for each language.
BUCKETS = 1 << 18
SWITCH = 20.0
SMOOTHING = 0.5
#: A language uses a script if it has at least this share of its letters.
SCRIPT_SHARE = 0.01
FOLDS, TEST_FOLD = 3, 1
UNKNOWN = "und"

#: First code points of Unicode ranges and their scripts.
SCRIPT_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"),
    (0x0980, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"),
    (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
    (0x30000, "other"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_RANGES))


@cache
def _letter_scripts() -> np.ndarray:
    """Script number + 1 of every letter's code point, 0 for anything else."""
    points = np.arange(0x110000)
    starts = np.array([first for first, _ in SCRIPT_RANGES])
    numbers = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES], np.uint8)
    letters = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
    return np.where(letters, numbers[np.searchsorted(starts, points, "right") - 1] + 1, 0).astype(
        np.uint8)


def letter_words(texts: pa.Array):
    """Of the words (runs of letters) of many texts: trigram cells, their bounds, scripts, places.

    Returns cells (one per letter), starts, ends, the number of words before each
    text, the script of each word's first letter, and the words' place in their text.
    """
    joined = "\n".join(pc.utf8_lower(texts).to_pylist())
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = pc.utf8_length(pc.utf8_lower(texts)).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    script = _letter_scripts()[points]
    inside = np.concatenate([[False], script > 0, [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = change[::2], change[1::2]
    # The trigram ending at each letter, with 0 for what lies before the word, and its end.
    c = np.where(script > 0, points, 0).astype(np.uint64)
    before = np.concatenate([[np.uint64(0)], c[:-1]])
    after = np.concatenate([c[1:], [np.uint64(0)]])[:len(c)]
    mix = tb.mixed((before * np.uint64(0x1000003) + c) * np.uint64(0x1F123BB5) + after)
    cells = (mix >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)
    words = np.searchsorted(starts, begin)
    first_script = script[starts].astype(np.int64) - 1
    place = np.repeat(begin[:-1], np.diff(words))
    return cells, starts, ends, words, first_script, place


def _blocks(batch: pa.RecordBatch, column: int):
    for start, stop, texts in tb.blocks(batch.column(column)):
        yield batch.slice(start, stop - start), texts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of cells and, behind them, of words by script; one row per language and cell."""
    totals: dict[str, np.ndarray] = {}
    width = BUCKETS + len(SCRIPTS)
    for batch in batches:
        for rows, texts in _blocks(batch, 1):
            cells, starts, ends, words, script, _ = letter_words(texts)
            langs = rows.column(0).to_pylist()
            of_word = np.repeat(np.arange(len(langs)), np.diff(words))
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            lang = number[of_word]
            sums = np.zeros(len(cells) + 1, np.int64)  # letters of words, by language
            sums[starts] += lang + 1
            sums[ends] -= lang + 1
            at = np.cumsum(sums[:-1]) - 1
            letters = at >= 0
            flat = np.bincount(
                at[letters] * width + cells[letters], minlength=len(names) * width)
            flat += np.bincount(lang * width + BUCKETS + script, minlength=len(names) * width)
            for k, name in enumerate(names):
                totals[name] = totals.get(name, 0) + flat[k * width:(k + 1) * width]
    for name, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at)), pa.array(at), pa.array(counts[at])],
            ["lang", "cell", "n"])


class Model:
    """Scores of cells by language and the scripts each language uses."""

    def __init__(self, counts) -> None:
        self.langs = sorted(counts["lang"].unique())
        table = np.zeros((len(self.langs), BUCKETS + len(SCRIPTS)))
        number = {name: k for k, name in enumerate(self.langs)}
        np.add.at(table, (counts["lang"].map(number).to_numpy(int), counts["cell"].to_numpy(int)),
                  counts["n"].to_numpy(float))
        cells, scripts = table[:, :BUCKETS], table[:, BUCKETS:]
        used = max(1, int((cells.sum(axis=0) > 0).sum()))
        total = cells.sum(axis=1, keepdims=True) + SMOOTHING * used
        self.scores = np.log((cells + SMOOTHING) / total).astype(np.float32).T.copy()
        uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        uses |= ~uses.any(axis=0)  # a script nobody uses narrows nothing
        self.out_of_script = np.where(uses.T, 0.0, -1e3).astype(np.float32)

    def word_scores(self, cells, starts, ends, script) -> np.ndarray:
        """Words x languages, relative to the best language of each word."""
        out = np.empty((len(starts), len(self.langs)), np.float32)
        for k in range(len(self.langs)):
            sums = np.zeros(len(cells) + 1)
            np.cumsum(self.scores[cells, k], out=sums[1:])
            out[:, k] = sums[ends] - sums[starts]
        out += self.out_of_script[script]
        return out - out.max(axis=1, keepdims=True, initial=-np.inf)


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The labels of the best path. One label throughout is best for certain if no
    run of words gains more than one switch by leaving it; only else is the path
    searched word by word. Ties go to the smaller number."""
    whole = int(scores.sum(axis=0).argmax())
    others = np.delete(scores, whole, axis=1).max(axis=1, initial=-np.inf)
    sums = np.concatenate([[0.0], np.cumsum(others - scores[:, whole], dtype=np.float64)])
    if (sums - np.minimum.accumulate(sums)).max() <= switch:
        return np.full(len(scores), whole)
    return _search(scores, switch)


def _search(scores: np.ndarray, switch: float) -> np.ndarray:
    value = [0.0] * scores.shape[1]
    back = []  # for each word: the best label before it, and the labels entered from that as bits
    for word in scores.tolist():
        top = max(value)
        best, entered = value.index(top), 0
        for k, score in enumerate(word):
            if value[k] < top - switch:
                value[k] = top - switch
                entered |= 1 << k
            value[k] += score
        back.append((best, entered))
    path = np.empty(len(scores), np.int64)
    state = value.index(max(value))
    for t in range(len(scores) - 1, -1, -1):
        path[t] = state
        best, entered = back[t]
        if entered >> state & 1:
            state = best
    return path


def _predict(model: Model):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in _blocks(batch, rows_text := batch.num_columns - 1):
                cells, starts, ends, words, script, place = letter_words(texts)
                langs, sure, spans = [], [], []
                scores = model.word_scores(cells, starts, ends, script) if model.langs else None
                for a, b in zip(words[:-1], words[1:], strict=True):
                    if a == b or scores is None:
                        langs.append(UNKNOWN)
                        sure.append(0.0)
                        spans.append([])
                        continue
                    path = viterbi(scores[a:b])
                    letters = np.bincount(path, ends[a:b] - starts[a:b], len(model.langs))
                    langs.append(model.langs[int(letters.argmax())])
                    sure.append(float(letters.max() / letters.sum()))
                    cut = np.flatnonzero(np.diff(path)) + 1
                    spans.append([
                        {"start": int(starts[a + x] - place[a]),
                         "end": int(ends[a + y - 1] - place[a]), "lang": model.langs[path[x]]}
                        for x, y in zip([0, *cut], [*cut, b - a], strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:rows_text], pa.array(langs, pa.string()),
                     pa.array(sure, pa.float64()), pa.array(spans, _SPANS)],
                    ["doc_id", "held_out", "lang_pred", "score", "spans"])

    return label


_SPANS = pa.list_(pa.struct(
    [("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def learn(docs: DataFrame) -> Model:
    """A model of all rows with a language outside the test fold."""
    known = docs.filter(F.col("lang").isNotNull() & ~held_out("doc_id", FOLDS, TEST_FOLD))
    counts = known.select("lang", "text").mapInArrow(_count, "lang string, cell bigint, n bigint")
    return Model(counts.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans) of every row.

    ``lang_pred`` has most letters of the labelled spans (ties: first by name),
    ``score`` is its share of them. ``spans`` are code points of the lower-cased
    text, end exclusive. NULL texts and texts without a letter are ``und`` with
    score 0 and no span, as is everything if no row has a language.
    """
    return docs.select(
        "doc_id", held_out("doc_id", FOLDS, TEST_FOLD).alias("held_out"), "text"
    ).mapInArrow(
        _predict(model),
        "doc_id bigint, held_out boolean, lang_pred string, score double,"
        " spans array<struct<start: int, end: int, lang: string>>")
