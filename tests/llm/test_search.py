"""Search answers many queries at once, and reads a shard's texts once for all of them."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillstar.llm import search


@pytest.mark.parametrize("posting", [0, 20, 10**9])
def test_many_queries_at_once_equal_scoring_everything(monkeypatch, posting):
    monkeypatch.setattr(search, "POSTING", posting)
    monkeypatch.setattr(search, "BLOCK", 60)
    monkeypatch.setattr(search, "QUERIES", 25)
    draw = np.random.default_rng(11)
    looked_up = []
    look_up = search.Shard._looked_up
    monkeypatch.setattr(search.Shard, "_looked_up", lambda self, docs, *rest: (
        looked_up.append(len(docs)), look_up(self, docs, *rest))[1])
    n_docs, n_terms, k = 700, 500, 10
    side = draw.random(n_docs) < 0.3
    often = np.minimum(0.9, 4 / np.arange(1, n_terms + 1))
    has = draw.random((n_docs, n_terms)) < np.where(
        side[:, None] == (np.arange(n_terms) % 3 == 0), often, 0.002)
    docs, terms = np.nonzero(has)
    scores = draw.random(len(docs)) * 9 + 0.1
    order = draw.permutation(n_docs)
    shard = search.Shard(terms.astype(np.int32), docs.astype(np.int32), scores, order, k)
    table = np.zeros((n_docs, n_terms))
    table[docs, terms] = scores
    asked = [np.flatnonzero(row) for row in has[::4]]
    asked[3] = asked[3][:0]
    whole = np.stack([table[:, a].sum(axis=1) for a in asked])
    expected = [[(-s, d) for s, _, d in sorted(
        (-round(s, 6), order[d], d) for d, s in enumerate(row.tolist()) if s)[:k]] for row in whole]
    first = np.array([row[-1][0] if row else -math.inf for row in expected])
    for least in (np.full(len(asked), -math.inf), first, first * 0.9, first + 1e-6):
        looked_up.clear()
        of, found, scores = shard.search_all(
            np.concatenate(asked), np.array([len(a) for a in asked]), least)
        got = [[] for _ in asked]
        for q, d, s in zip(of.tolist(), found.tolist(), scores.tolist(), strict=True):
            got[q].append((s, d))
        assert got == [[(s, d) for s, d in row if s >= low]
                       for row, low in zip(expected, least, strict=True)]
        if least is first:
            assert 0 < sum(looked_up) <= 1.2 * k * len(asked)


def test_a_shard_is_read_once_for_all_queries(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(k if k % 41 else None, " ".join(f"w{int(draw.paretovariate(0.7)) % 300}"
             for _ in range(draw.randint(5, 60)))) for k in range(240)]
    rows += [(400 + k, rows[8][1]) for k in range(30)] + [(8, rows[8][1]), (9, None), (12, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(search, "PACK_QUERIES", 7)
    monkeypatch.setattr(search, "PACK_WORDS", 50)
    made = []
    answers = search._shard_answers

    def kept(*args):
        made.append(answers(*args))
        return made[-1]

    monkeypatch.setattr(search, "_shard_answers", kept)
    got = sorted(map(tuple, search.top_k(docs, 3, 4).collect()))
    counts = [Counter(search.split_words(t or "")) for _, t in rows]
    mean, n = sum(c.total() for c in counts) / len(counts), len(counts)
    df = Counter(t for c in counts for t in c)
    idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
    asked = {}
    for (i, _), c in zip(rows, counts, strict=True):
        if i is not None and i % 4 == 0 and c:
            asked.setdefault(i, set()).update(c)
    expected = []
    for query, terms in asked.items():
        scored = [(-round(math.fsum(
            idf[t] * d[t] * 2.2 / (d[t] + 1.2 * (0.25 + 0.75 * d.total() / mean))
            for t in terms if t in d), 6), math.inf if i is None else i)
            for (i, _), d in zip(rows, counts, strict=True) if terms & d.keys()]
        expected += [(query, rank, None if i == math.inf else i, -s)
                     for rank, (s, i) in enumerate(sorted(scored)[:3], 1)]
    assert got == sorted(expected) and len(asked) > 50
    # Ten packs of queries, one reading of the texts.
    words = search._packed_words(pa.table({"number": [0, 1], "term": pa.array([b"a", b"b"]), "df": [2, 1]})
                                 .to_pandas())["data"][0]
    pack = search._packed(pa.table({"query_id": [1], "numbers": [[0, 1]], "least": [-math.inf]})
                          .to_pandas())["data"][0]
    texts, split = [], search.split_bytes
    monkeypatch.setattr(search, "split_bytes", lambda text: texts.append(text) or split(text))
    batch = pa.RecordBatch.from_pydict({
        "shard": [5] * 13, "kind": [0, 1, 1] + [2] * 10, "doc_id": [0, 7, 8] + [0] * 10,
        "data": pa.array([words, b"A b", b"a"] + [pack] * 10, pa.binary())})
    out = list(made[0](iter([batch])))
    assert len(out) == 10 and all(b.column("doc_id").to_pylist() == [7, 8] for b in out)
    assert texts == [b"A b", b"a"]
