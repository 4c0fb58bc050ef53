"""Repeated runs of lines, found by winnowing over line hashes.

A run is a sequence of lines that stands at an earlier place of the corpus too and has
RUN_WORDS words or more; one long line is a run, a few short ones are none, and blank lines
do not count. Of each repeated run the first place stays and the later ones go; a blank
line goes if it lies inside a window that goes, others stay and keep paragraphs apart.

Windows hold as few lines as reach RUN_WORDS words. Each line that is not blank begins
one and ends one, so every run is covered by windows inside it, to its first and
last line. Of each window the smallest line hash is selected (winnowing), so equal windows
always select the same line, and neighbouring windows mostly share one. The selected
fingerprints are counted over the corpus: a window whose fingerprint occurs at one place
only cannot repeat and goes no further, which drops nearly all of a fresh text. The
positions of the others are joined by the hash of the whole window, which extends the match
from the selected line both ways over the window; overlapping windows extend it on to
both ends of the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.tables import stored, word_count

#: Words of the shortest run that counts.
RUN_WORDS = 6


def _words_up_to(line: Column, most: int) -> Column:
    """The words of a line, or ``most`` if there are as many, which reads its beginning only."""
    blank, word = r"[\x20\x09-\x0D]*+", r"[^\x20\x09-\x0D]++"
    begins = line.rlike(rf"\A(?:{blank}{word}){{{most}}}")
    return F.when(begins, F.lit(most).cast("bigint")).otherwise(word_count(line))


def _filled(lines: Column, words: int) -> Column:
    """How many of the lines reach ``words`` words together; NULL if all do not."""
    counted = F.aggregate(
        lines, F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).alias("lines")),
        lambda sum_, line: F.when(sum_["words"] >= words, sum_).otherwise(F.struct(
            (sum_["words"] + line["words"]).alias("words"), (sum_["lines"] + 1).alias("lines"))))
    return F.when(counted["words"] >= words, counted["lines"])


def _windows(lines: Column, words: int) -> Column:
    """(line, last, smallest, whole) of each window of an array of (line, hash, words).

    No line is blank, so a window has ``words`` lines at most.
    """
    def window(first: Column, size: Column) -> Column:
        part = F.slice(lines, first, size)
        hashes = F.transform(part, lambda x: x["hash"])
        return F.when(size.isNotNull(), F.struct(
            part[0]["line"].alias("line"), F.element_at(part, -1)["line"].alias("last"),
            F.array_min(hashes).alias("smallest"), F.xxhash64(hashes, size).alias("whole")))

    def beginning(k: Column) -> Column:
        return window(k, _filled(F.slice(lines, k, F.lit(words)), words))

    def ending(k: Column) -> Column:
        low = F.greatest(k - words + 1, F.lit(1))
        size = _filled(F.reverse(F.slice(lines, low, k - low + 1)), words)
        return window(k - size + 1, size)

    places = F.sequence(F.lit(1), F.size(lines))
    both = F.concat(F.transform(places, beginning), F.transform(places, ending))
    return F.when(F.size(lines) > 0, F.array_distinct(F.filter(both, lambda w: w.isNotNull())))


def repeated_lines(docs: DataFrame, words: int = RUN_WORDS) -> DataFrame:
    """(doc_id, text_key, doomed): the numbers of the lines to delete, from 0, sorted.

    The order of the corpus is that of doc_id (NULL first), then of the text's
    hash, then of the line; within a text later repetitions go too. Rows equal in
    id and text are one place of the corpus and are treated alike.
    """
    texts = docs.filter(F.col("text") != "").select(
        "doc_id", F.xxhash64("text").alias("text_key"),
        F.filter(F.transform(F.split("text", "\n"), lambda line, k: F.struct(
            k.alias("line"), F.xxhash64(line).alias("hash"), _words_up_to(line, words).alias("words"))),
            lambda line: line["words"] > 0).alias("lines"))
    all_windows = stored(texts.select(
        "doc_id", "text_key", F.explode(_windows(F.col("lines"), words)).alias("w")
    ).select("doc_id", "text_key", "w.line", "w.last", "w.smallest", "w.whole"), "windows")
    place = F.struct("doc_id", "text_key", "line")
    # Two windows around one selected line differ in content; the fingerprint of a
    # window that repeats is met at two first lines at least.
    twice = stored(all_windows.groupBy("smallest").agg(
        F.min(place).alias("first"), F.max(place).alias("last")
    ).filter("first <> last").select("smallest"), "repeated_fingerprints")
    open_windows = stored(all_windows.join(twice, "smallest", "left_semi"), "open_windows")
    firsts = stored(open_windows.groupBy("whole").agg(
        F.min(place).alias("first"), F.max(place).alias("last")
    ).filter("first <> last").select("whole", "first"), "first_places")
    # Equal rows have equal windows, which count once before they are gathered.
    later = open_windows.join(firsts, "whole").filter(place > F.col("first")).select(
        "doc_id", "text_key", "line", F.col("last")).distinct()
    return later.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(
            F.sequence("line", "last"))))).alias("doomed"))


def dedup_lines(docs: DataFrame, words: int = RUN_WORDS) -> DataFrame:
    """All columns of ``docs`` in ``row``, with text, n_lines and n_deleted beside it.

    ``text`` keeps the other lines in order, joined by line breaks. NULL stays
    NULL and an empty text empty, both with no lines. A very long text is one row
    of its windows' hashes, never all of them in one group with other texts. Without
    documents the result is empty. Extra columns are kept in ``row`` whatever their names.
    """
    doomed = stored(repeated_lines(docs, words), "doomed_lines").withColumnsRenamed(
        {"doc_id": "_id", "text_key": "_key"})
    rows = docs.select(
        F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_key"), "text")
    # The list grows with the corpus, so it is merged at every size and never broadcast.
    joined = rows.join(
        doomed.hint("merge"), (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")),
        "left")
    lines = F.split("text", "\n")
    gone = F.coalesce("doomed", F.array().cast("array<int>"))
    kept = F.filter(lines, lambda _, k: ~F.array_contains(gone, k))
    n_lines = F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(F.size(lines))
    return joined.select(
        "row", n_lines.alias("n_lines"),
        F.size(F.filter(gone, lambda k: k < n_lines)).alias("n_deleted"),
        F.when(F.col("doomed").isNull(), F.col("text")).otherwise(
            F.array_join(kept, "\n")).alias("text"))
