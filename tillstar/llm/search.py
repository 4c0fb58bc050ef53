"""Exact top-k search by BM25: an inverted index per shard and block maxima.

Documents are dealt into shards of about SHARD_BYTES of text. The statistics of
BM25, the number of documents, the mean length and the document frequencies, are
those of the whole corpus, so scores of different shards compare. One task per
shard builds the postings of the terms that queries use, once, and then reads the
queries in packs and answers every one.

Documents of a shard that share common words, and of those documents of like length,
stand in one block of at most BLOCK documents. Every block has its own lists and knows
the largest score of each. Queries are put together in the same way, so that many queries
meet a block at once:

- A block whose lists' largest scores together stay below a query's k-th score is set
  aside: none of its documents can be an answer.
- In the other blocks the lists are added up, in single floats. A word that many of the
  queries and documents have is a column of a matrix product; of the other words the
  postings are added one by one. Per word that is taken which is less work.
- A sum bounds the score from above once the rounding of single floats is allowed for. Only
  documents whose bound reaches the k-th score are looked up by document, and get their whole
  score in double floats.

A k-th score known early skips more. Shards are searched in three waves: each wave
starts from the k-th scores that the shards before it found, and its shards answer
with rows that reach them only. The answers are merged by score.

Of documents with one and the same text in a shard only the first k by id can be answers, since
ties go to the smaller id; the others stay out of the shard's lists.

Queries refer to their words by number; a shard gets each word once, and words and queries
come in packed rows.

A query is a text of the corpus. With ``n_terms`` None all its distinct words are
its terms, each counted once however often the query has it; this is what the
registered query asks. With a number only those with the highest frequency * idf
are, words that no other text has last: a smaller query with other answers.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.tables import stored
from tillstar.operators.keys import with_dense_key
from tillstar.session import scratch_path

K1, B = 1.2, 0.75
TOP_K = 10
#: Queries are the rows whose id is divisible by this.
EVERY = 50
SHARD_BYTES = 48 << 20
#: Queries and their terms in one packed row, and words in one.
PACK_QUERIES, PACK_TERMS, PACK_WORDS = 8_192, 2_000_000, 50_000
#: Documents of a block, and queries that meet it at once.
BLOCK, QUERIES = 4_096, 1_024
#: Groups of alike documents at most, rounds to find them, and the share of a sample that one has.
GROUPS, ROUNDS, LEAST_SHARE = 8, 5, 64
#: Documents of that sample, and the most frequent words that it is grouped by.
SAMPLE, COMMON = 2_500, 1_024
#: Adding a posting takes as long as so many steps of a matrix product.
POSTING = 450
#: Queries whose postings are added at a time, and postings looked up at a time.
STRIP, LOOK_UP = 16, 1 << 18
#: Words counted in a task before their counts are handed on, and texts taken from a batch at a time.
COUNTED, TEXTS = 300_000, 512
DIGITS = 6
#: A score may differ from its bound by rounding only; ties are judged after rounding.
SLACK = 10.0**-DIGITS

#: Rows that a shard gets, in this order.
WORD_ROWS, TEXT_ROWS, QUERY_ROWS = 0, 1, 2

_BYTES = bytes(
    b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def split_bytes(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8: runs of ASCII letters, digits and characters beyond ASCII, a-z for A-Z."""
    return text.translate(_BYTES).split()


def split_words(text: str) -> list[str]:
    return [w.decode() for w in split_bytes(text.encode())]


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    n = high - low
    ends = np.cumsum(n)
    numbers = np.repeat(high - ends, n)
    numbers += _upto(len(numbers))
    return numbers


_counted_up = [np.arange(1 << 16)]


def _upto(n: int) -> np.ndarray:
    """The numbers below ``n``, kept for short runs."""
    if n > 1 << 20:
        return np.arange(n)
    if n > len(_counted_up[0]):
        _counted_up[0] = np.arange(1 << (n - 1).bit_length())
    return _counted_up[0][:n]


def _from_sizes(sizes: np.ndarray) -> np.ndarray:
    """Where runs of these sizes begin; the last entry is the end."""
    return np.concatenate([[0], np.cumsum(sizes)])


def _laid_out(groups: np.ndarray, sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts by group and size, and the cuts of blocks of one group and ``most`` texts at most."""
    standing, cuts = np.lexsort((sizes, groups)), [0]
    for n in np.bincount(groups).tolist():
        parts, start = -(-n // most), cuts[-1]
        cuts += [start + n * (part + 1) // parts for part in range(parts)]
    return standing, np.array(cuts)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=-1, keepdims=True)), 1e-9)


def _centres(rows: np.ndarray) -> np.ndarray:
    """Centres of GROUPS groups of alike rows at most, by spherical k-means; small groups go."""
    rows = _unit(rows)
    full = (rows > 0).sum(axis=1)
    firm = rows[full >= np.median(full)]
    centres = _unit(rows.sum(axis=0))[None]
    for _ in range(GROUPS - 1):
        farthest = (firm @ centres.T).max(axis=1).argmin()
        centres = np.concatenate([centres, firm[farthest][None]])
    for _ in range(ROUNDS):
        group = (rows @ centres.T).argmax(axis=1)
        sizes = np.bincount(group, minlength=len(centres))
        kept = np.flatnonzero(sizes * LEAST_SHARE >= len(rows))
        centres = _unit(np.stack([rows[group == g].sum(axis=0) for g in kept]))
    return centres


class Shard:
    """Postings of a shard by block of documents and by document.

    ``terms``, ``docs`` and ``scores`` are postings; ``order`` ranks the documents for ties.
    Documents that share common words, and of those documents of like length, stand in one
    block. Each block has its own lists, and of each list the largest score.
    """

    def __init__(
        self, terms: np.ndarray, docs: np.ndarray, scores: np.ndarray, order: np.ndarray, k: int
    ) -> None:
        self.order, self.k = np.asarray(order), k
        n_docs, self.n_terms = len(self.order), int(terms.max(initial=0)) + 1
        same = docs[1:] == docs[:-1]
        if ((docs[1:] < docs[:-1]) | same & (terms[1:] < terms[:-1])).any():
            at = np.lexsort((terms, docs))
            docs, terms, scores = docs[at], terms[at], scores[at]
        del same
        self.terms, self.scores = terms, scores
        per_doc = np.bincount(docs, minlength=n_docs)
        self.of_doc = _from_sizes(per_doc)
        sizes = np.bincount(self.terms, minlength=self.n_terms)
        self.centres = self._grouped(docs, np.argsort(-sizes, kind="stable")[:COMMON], sizes)
        group = self._group_of(self.terms, docs, n_docs)
        self.standing, self.cuts = _laid_out(group, per_doc, BLOCK)
        place = np.empty(n_docs, np.int64)
        place[self.standing] = np.arange(n_docs)
        block = np.repeat(np.arange(len(self.cuts) - 1), np.diff(self.cuts))
        in_block = (place - self.cuts[block[place]]).astype(np.int32)
        lists = block[place][docs] * self.n_terms
        lists += self.terms
        sizes = np.bincount(lists, minlength=(len(self.cuts) - 1) * self.n_terms)
        by_list = np.argsort(lists)
        del lists
        self.docs = in_block[docs[by_list]]
        self.weights = self.scores.astype(np.float32)[by_list]
        del by_list
        self.of_list = _from_sizes(sizes)
        self.best = np.zeros(len(sizes), np.float32)
        known = sizes > 0
        self.best[known] = np.maximum.reduceat(self.weights, self.of_list[:-1][known])
        self.best = np.ascontiguousarray(self.best.reshape(-1, self.n_terms).T)

    def _grouped(self, docs: np.ndarray, common: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What a term says for each group of alike documents, from the common terms of a sample."""
        weight = np.log(1 + len(self.order) / np.maximum(sizes[common], 1)).astype(np.float32)
        column = np.full(self.n_terms, -1, np.int64)
        column[common] = np.arange(len(common))
        step = max(1, -(-len(self.order) // SAMPLE))
        seen = (docs % step == 0) & (column[self.terms] >= 0)
        has = np.zeros((-(-len(self.order) // step), len(common)), np.float32)
        has[docs[seen] // step, column[self.terms[seen]]] = 1
        centres = _centres(has * weight) if has.size else np.zeros((1, len(common)), np.float32)
        says = np.zeros((len(centres), self.n_terms), np.float32)
        says[:, common] = centres * weight
        return says

    def _group_of(self, terms: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(of, says[terms], n) for says in self.centres]).argmax(axis=0)

    def search(self, terms: np.ndarray, least: float = -math.inf) -> list[tuple[float, int]]:
        """The best k (score, document) for the terms: by rounded score, then by ``order``.

        Scores below ``least`` are not wanted.
        """
        _, docs, scores = self.search_all(np.sort(terms), np.array([len(terms)]), np.array([least]))
        return list(zip(scores.tolist(), docs.tolist(), strict=True))

    def search_all(
        self, terms: np.ndarray, sizes: np.ndarray, least: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, documents and scores of the answers to many queries, as ``search`` gives them.

        ``terms`` has the terms of all queries one after the other, in order within a query.
        """
        first = _from_sizes(sizes)
        group = self._group_of(terms, np.repeat(np.arange(len(sizes)), sizes), len(sizes))
        asking = np.flatnonzero(sizes)
        standing, cuts = _laid_out(group[asking], sizes[asking], QUERIES)
        standing = asking[standing]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for low, high in zip(cuts, cuts[1:]):
            asked = standing[low:high]
            of, docs, scores = self._of_alike(
                terms[_ranges(first[asked], first[asked + 1])], sizes[asked], least[asked])
            found.append((asked[of], docs, scores))
        return tuple(map(np.concatenate, zip(*found)))

    def _of_alike(self, terms: np.ndarray, sizes: np.ndarray, least: np.ndarray):
        n = len(sizes)
        of = np.repeat(np.arange(n), sizes)
        number = np.full(self.n_terms, -1)
        number[terms] = 0
        words = np.flatnonzero(number == 0)
        number[words] = np.arange(len(words))
        at, least = number[terms], least.astype(float)
        has = np.zeros((n, len(words)), bool)
        has[of, at] = True
        # A sum of single floats is off by so much at most: all its parts are positive.
        exact = 1 + (sizes + 4) * 2.0**-22
        # Every query has terms here, so that each is one run of them.
        bound = np.add.reduceat(self.best[words][at], _from_sizes(sizes)[:-1], dtype=float).T * exact
        found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for block in range(len(self.cuts) - 1):
            reach = np.flatnonzero((bound[block] > 0) & (bound[block] + SLACK >= least))
            if not len(reach):
                continue
            totals = self._added(block, words, of, at, reach)
            asked, docs = self._best_of(totals, least[reach], exact[reach])
            asked, docs = reach[asked], self.standing[self.cuts[block] + docs]
            scores = np.round(self._looked_up(docs, asked, has, number), DIGITS)
            wanted = scores >= least[asked]
            found = [np.concatenate(x) for x in zip(
                found, (asked[wanted], docs[wanted], scores[wanted]))]
            found, rank = self._ranked(*found)
            last = found[0][rank == self.k - 1], found[2][rank == self.k - 1]
            least[last[0]] = np.maximum(least[last[0]], last[1])
        return found

    def _ranked(self, asked: np.ndarray, docs: np.ndarray, scores: np.ndarray):
        """The best k of each query in order, and their ranks from 0."""
        by = np.lexsort((self.order[docs], -scores, asked))
        asked, docs, scores = asked[by], docs[by], scores[by]
        rank = np.arange(len(asked)) - np.searchsorted(asked, asked)
        kept = rank < self.k
        return (asked[kept], docs[kept], scores[kept]), rank[kept]

    def _added(
        self, block: int, words: np.ndarray, of: np.ndarray, at: np.ndarray, reach: np.ndarray
    ) -> np.ndarray:
        """The summed scores of a block's documents, by query of ``reach``.

        Words that many of these queries and documents have go through a matrix product,
        the others' postings are added one by one, whichever is less work for a word.
        """
        n_docs = int(self.cuts[block + 1] - self.cuts[block])
        lists = block * self.n_terms + words
        low, high = self.of_list[lists], self.of_list[lists + 1]
        row = np.full(int(of[-1]) + 1, -1)
        row[reach] = np.arange(len(reach))
        here = (row[of] >= 0) & (high > low)[at]
        of, at = row[of[here]], at[here]
        asked = np.bincount(at, minlength=len(words))
        shared = asked * (high - low) * POSTING > len(reach) * n_docs
        columns = np.cumsum(shared) - 1
        rows = _ranges(low[shared], high[shared])
        table = np.zeros((int(shared.sum()), n_docs), np.float32)
        places = np.repeat(np.arange(len(table)) * n_docs, (high - low)[shared])
        places += self.docs.take(rows)
        table.reshape(-1)[places] = self.weights.take(rows)
        common = shared[at]
        has = np.zeros((len(reach), len(table)), np.float32)
        has.reshape(-1)[of[common] * len(table) + columns[at[common]]] = 1
        totals = has @ table
        of, at = of[~common], at[~common]
        cells = totals.reshape(-1)
        cuts = np.searchsorted(of, np.arange(0, len(reach) + STRIP, STRIP))
        for start, end in zip(cuts, cuts[1:]):
            begin, stop = low[at[start:end]], high[at[start:end]]
            rows = _ranges(begin, stop)
            places = np.repeat(of[start:end] * n_docs, stop - begin)
            places += self.docs.take(rows)
            np.add.at(cells, places, self.weights.take(rows))
        return totals

    def _best_of(self, totals: np.ndarray, least: np.ndarray, exact: np.ndarray):
        """(query, document) whose sum may reach the query's least score and the best k sums."""
        limit = np.maximum((least - SLACK) / exact * (1 - 2.0**-22), np.finfo(np.float32).tiny)
        limit = limit.astype(np.float32)
        reach = totals >= limit[:, None]
        many = np.flatnonzero(np.count_nonzero(reach, axis=1) > 4 * self.k)
        if len(many):
            place = totals.shape[1] - self.k
            kth = np.partition(totals[many], place, axis=1)[:, place]
            limit = np.maximum(limit[many], (kth - 2 * SLACK) / exact[many]**2 * (1 - 2.0**-22))
            reach[many] = totals[many] >= limit[:, None].astype(np.float32)
        return np.divmod(np.flatnonzero(reach), totals.shape[1])

    def _looked_up(
        self, docs: np.ndarray, asked: np.ndarray, has: np.ndarray, number: np.ndarray
    ) -> np.ndarray:
        """The whole scores of documents for queries; ``has`` are the queries' words by number."""
        scores = np.zeros(len(docs))
        n = self.of_doc[docs + 1] - self.of_doc[docs]
        runs = np.cumsum(n) // LOOK_UP
        for run in range(int(runs.max(initial=-1)) + 1):
            part = slice(*np.searchsorted(runs, [run, run + 1]))
            rows = _ranges(self.of_doc[docs[part]], self.of_doc[docs[part] + 1])
            of, words = np.repeat(np.arange(part.stop - part.start), n[part]), number[self.terms[rows]]
            hit = np.flatnonzero(words >= 0)
            hit = hit[has[asked[part][of[hit]], words[hit]]]
            scores[part] = np.bincount(of[hit], self.scores[rows[hit]], part.stop - part.start)
        return scores


class Postings:
    """Texts of a shard as they come, and the postings of the words that are asked."""

    def __init__(self, k: int, n_docs: int, mean_length: float) -> None:
        self.k, self.n_docs, self.mean_length = k, n_docs, mean_length
        self.numbers: dict[bytes, int] = {}
        self.dfs: list[tuple[int, np.ndarray]] = []
        self.ids: list[int | None] = []
        self.digests: list[bytes] = []
        self.lengths = array("i")
        self.parts: list[np.ndarray] = []

    def learn(self, first: int, pack: bytes) -> None:
        """Words with the numbers from ``first`` on and their document frequencies."""
        words, dfs = pickle.loads(zlib.decompress(pack))
        self.numbers.update(zip(words.split(b" "), range(first, first + len(dfs))))
        self.dfs.append((first, dfs))

    def add(self, ids: list[int | None], texts: list[bytes]) -> None:
        found, sizes, get = array("i"), array("i"), self.numbers.get
        for text in texts:
            words = split_bytes(text)
            sizes.append(len(words))
            found.extend(map(get, words, repeat(-1)))
            self.digests.append(hashlib.blake2b(text, digest_size=16).digest())
        docs = np.repeat(np.arange(len(texts)) + len(self.ids), sizes)
        keys = docs << 32 | np.asarray(found)
        keys = np.sort(keys[np.asarray(found) >= 0])
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
        tf = np.diff(np.append(new, len(keys)))
        self.parts.append(np.stack(
            [keys[new] >> 32, keys[new] & 0xFFFFFFFF, tf]).astype(np.int32))
        self.ids += ids
        self.lengths.extend(sizes)

    def shard(self) -> tuple[Shard, np.ndarray]:
        """The shard, and the terms' places in it by number (-1: none)."""
        standing = sorted(range(len(self.ids)), key=lambda d: (self.ids[d] is None, self.ids[d] or 0))
        order, copies = np.empty(len(self.ids), np.int64), Counter()
        order[standing] = np.arange(len(self.ids))
        surplus = np.zeros(len(self.ids), bool)
        for doc in standing:
            copies[self.digests[doc]] += 1
            surplus[doc] = copies[self.digests[doc]] > self.k
        parts, self.parts, self.numbers = self.parts, [], {}
        docs, terms, tf = np.concatenate([np.zeros((3, 0), np.int32), *parts], axis=1)
        del parts
        if surplus.any():
            docs, terms, tf = (x[~surplus[docs]] for x in (docs, terms, tf))
        df = np.ones(max((first + len(dfs) for first, dfs in self.dfs), default=0))
        for first, dfs in self.dfs:
            df[first:first + len(dfs)] = dfs
        idf = np.log(1 + (self.n_docs - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * np.asarray(self.lengths) / self.mean_length)
        scores, divisor = idf[terms], norm[docs]
        scores *= tf
        scores *= K1 + 1
        divisor += tf
        scores /= divisor
        del tf, divisor
        places = np.full(len(idf), -1, np.int64)
        places[terms] = 0
        places[places == 0] = np.arange((places == 0).sum())
        return Shard(places[terms].astype(np.int32), docs, scores, order, self.k), places


def _planes(values: np.ndarray) -> bytes:
    """The bytes of integers, those of the same place together: they take less room when packed."""
    return values.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    """Queries in one row: their ids, least scores, sizes and the steps from number to number."""
    sizes = rows["numbers"].map(len).to_numpy()
    steps = np.diff(np.concatenate(rows["numbers"].tolist()), prepend=0)
    pack = pickle.dumps((rows["query_id"].to_numpy(), rows["least"].to_numpy(),
                         _planes(sizes), _planes(steps)))
    return pd.DataFrame({"doc_id": [0], "data": [zlib.compress(pack, 1)]})


def _packed_words(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("number")
    pack = pickle.dumps((b" ".join(rows["term"]), rows["df"].to_numpy()))
    return pd.DataFrame({"doc_id": [rows["number"].iloc[0]], "data": [zlib.compress(pack, 1)]})


def _answers(pack: bytes, shard: Shard, places: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    query_ids, least, sizes, steps = pickle.loads(zlib.decompress(pack))
    terms = places[np.cumsum(_from_planes(steps), dtype=np.int64)]
    known = terms >= 0
    of = np.repeat(np.arange(len(query_ids)), _from_planes(sizes))
    asked, docs, scores = shard.search_all(
        terms[known], np.bincount(of[known], minlength=len(query_ids)), least)
    return pa.RecordBatch.from_arrays(
        [pa.array(query_ids[asked], pa.int64()), pa.array(ids[docs].tolist(), pa.int64()),
         pa.array(scores, pa.float64())], ["query_id", "doc_id", "score"])


def _shard_answers(k: int, n_docs: int, mean_length: float):
    """For rows by shard and kind: the words, then the texts of a shard, then the queries."""
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, texts, built = None, None, None
        for batch in batches:
            shards, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            changes = np.flatnonzero((np.diff(shards) != 0) | (np.diff(kinds) != 0)) + 1
            cuts = [0, *changes.tolist(), len(shards)] if len(shards) else [0]
            for low, high in zip(cuts, cuts[1:]):
                if shards[low] != current:
                    current, texts, built = shards[low], Postings(k, n_docs, mean_length), None
                step = TEXTS if kinds[low] == TEXT_ROWS else 1
                for start in range(low, high, step):
                    rows = batch.slice(start, min(step, high - start))
                    ids, data = (rows.column(c).to_pylist() for c in ("doc_id", "data"))
                    if kinds[low] == WORD_ROWS:
                        texts.learn(ids[0], data[0])
                    elif kinds[low] == TEXT_ROWS:
                        texts.add(ids, data)
                    elif texts.ids:
                        if built is None:
                            built = *texts.shard(), np.array(texts.ids, object)
                        yield _answers(data[0], *built)

    return answer


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df): words and in how many texts they are; no word: texts, with their words and bytes."""
    df, n_docs, length, size = Counter(), 0, 0, 0

    def counts() -> pa.RecordBatch:
        rest = [0] * len(df)
        return pa.RecordBatch.from_arrays([
            pa.array([None, *df], pa.binary()), pa.array([n_docs, *df.values()], pa.int64()),
            pa.array([length, *rest], pa.int64()), pa.array([size, *rest], pa.int64())],
            ["term", "df", "length", "size"])

    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS):
            for text in batch.column(0).slice(start, TEXTS).to_pylist():
                words = split_bytes(text or b"")
                df.update(set(words))
                n_docs, length, size = n_docs + 1, length + len(words), size + len(text or b"")
            if len(df) > COUNTED:
                yield counts()
                df, n_docs, length, size = Counter(), 0, 0, 0
    if n_docs:
        yield counts()


def _words_of_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS):
            rows, ids, terms, tfs = batch.slice(start, TEXTS), array("q"), [], array("q")
            for query_id, text in zip(*(rows.column(c).to_pylist() for c in (0, 1))):
                found = Counter(split_bytes(text or b""))
                ids.extend(repeat(query_id, len(found)))
                terms += found.keys()
                tfs.extend(found.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.int64())],
                ["query_id", "term", "tf"])


def query_terms(docs: DataFrame, every: int = EVERY, n_terms: int | None = None):
    """(query_id, numbers) of all queries, their words in packs of PACK_WORDS, the number of
    documents, their mean length and the bytes of all texts."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    known = stored(
        texts.select("text").mapInArrow(_counted, "term binary, df bigint, length bigint, size bigint")
        .groupBy("term").agg(*[F.sum(c).alias(c) for c in ("df", "length", "size")]),
        "document_frequencies")
    total, length, size = known.filter("term is null").select("df", "length", "size").head() or (0,) * 3
    asked = stored(
        texts.filter(F.col("doc_id") % every == 0)
        .mapInArrow(_words_of_queries, "query_id bigint, term binary, tf bigint")
        .groupBy("query_id", "term").agg(F.sum("tf").alias("tf")), "query_words")
    found = stored(known.select("term", "df").join(
        asked.select("term").distinct(), "term", "left_semi"), "found_words")
    # Words of like frequency have near numbers: their lists stand together, their steps are small.
    numbered = with_dense_key(
        found.withColumn("often", -F.col("df")), "number",
        scratch_path(docs.sparkSession, "asked_words"), ["often", "term"])
    words = stored(numbered.select((F.col("number") - 1).cast("int").alias("number"), "term", "df"),
                   "numbered_words")
    terms = asked.join(words, "term")
    if n_terms is not None:
        idf = F.log(1 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5))
        best = Window.partitionBy("query_id").orderBy(
            F.col("df") == 1, F.col("weight").desc(), "term")
        terms = terms.withColumn("weight", F.round(F.col("tf") * idf, DIGITS)).withColumn(
            "place", F.row_number().over(best)).filter(F.col("place") <= n_terms)
    # Scores are added up in the order of the numbers, the same in every shard.
    by_query = stored(terms.groupBy("query_id").agg(
        F.array_sort(F.collect_list("number")).alias("numbers")), "query_terms")
    packs = stored(words.groupBy(F.floor(F.col("number") / PACK_WORDS)).applyInPandas(
        _packed_words, "doc_id bigint, data binary"), "word_packs")
    return by_query, packs, total, float(length / max(total, 1) or 1.0), size


def top_k(
    docs: DataFrame, k: int = TOP_K, every: int = EVERY, n_terms: int | None = None
) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of each query, itself included.

    Scores are rounded to DIGITS digits; ties go to the smaller doc_id, NULL ids
    last. Only documents with a query term are found, so a query may have fewer
    than k rows; texts without words are never found and ask nothing. Rows that
    share an id are documents of their own, and as queries one.
    """
    terms, words, total, mean_length, size = query_terms(docs, every, n_terms)
    shards = max(1, -(-size // SHARD_BYTES))
    queries, n_terms = terms.agg(F.count(F.lit(1)), F.sum(F.size("numbers"))).head()
    packs = max(1, -(-queries // PACK_QUERIES), -(-(n_terms or 0) // PACK_TERMS))
    texts = docs.filter("text is not null").select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).alias("shard"),
        F.lit(TEXT_ROWS).alias("kind"), F.col("doc_id").cast("bigint"),
        F.col("text").cast("binary").alias("data"))
    place = Window.partitionBy("query_id").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    asked, best = terms.withColumn("least", F.lit(-math.inf)), None
    cuts = sorted({math.ceil(shards ** (n / 3)) for n in (1, 2)} | {shards})
    for low, high in zip([0, *cuts], cuts):
        packed = asked.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(packs))).applyInPandas(
            _packed, "doc_id bigint, data binary")
        rows = texts.filter((F.col("shard") >= low) & (F.col("shard") < high))
        for kind, sent in ((WORD_ROWS, words), (QUERY_ROWS, packed)):
            rows = rows.unionByName(sent.select(
                _each(low, high).alias("shard"), F.lit(kind).alias("kind"), "doc_id", "data"))
        answers = rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(
            _shard_answers(k, total, mean_length), "query_id bigint, doc_id bigint, score double")
        best = (answers if best is None else best.drop("rank").unionByName(answers)).withColumn(
            "rank", F.row_number().over(place)).filter(F.col("rank") <= k)
        if high < shards:
            best = stored(best, "best_so_far")
            least = best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
            asked = terms.join(least, "query_id", "left").fillna(-math.inf, ["least"])
    return best.select("query_id", "rank", "doc_id", "score")


def _each(low: int, high: int) -> Column:
    return F.explode(F.sequence(F.lit(low).cast("bigint"), F.lit(high - 1).cast("bigint")))
