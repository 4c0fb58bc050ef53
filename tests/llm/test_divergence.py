"""Source divergence: pointer sort and the whole audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tillstar.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
COLUMNS = ("doc_id bigint, text string, lang string, source string, n bigint, docs bigint,"
           " term string, at string, value bigint, block int, no int")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def terms_of(text):
    return TERM.findall(lowered(text or ""))


def words(draw, n):
    letters = ["a", "b", "Z", "é", "漢", "😀", "abcdefgh", "abcdefgA"]
    return ["".join(draw.choice(letters) for _ in range(draw.choice([1, 1, 2, 3, 9])))
            for _ in range(n)]


@pytest.mark.parametrize("small", [1, 3, 1 << 15])
def test_pointer_sort_counts_runs(small):
    draw = random.Random(small)
    texts = [" -1_".join(words(draw, draw.randint(0, 60))) for _ in range(40)]
    texts += ["", "x" * 5000 + " " + "x" * 5000 + " " + "x" * 4999, "12 34"]
    groups = np.sort(np.array([draw.randrange(5) for _ in texts]))
    found = divergence.count_runs(groups, pa.array(texts, pa.large_string()), small)
    counts, docs = Counter(), Counter()
    for group, text in zip(groups, texts):
        here = terms_of(text)
        counts.update((t, group) for t in here)
        docs.update((t, group) for t in set(here))
    got = [(t.as_py(), g, n, d) for t, g, n, d in zip(*found)]
    assert got == sorted(got, key=lambda r: (r[0].encode(), r[1]))
    assert {(t, g): (n, d) for t, g, n, d in got} == {k: (counts[k], docs[k]) for k in counts}
    assert len(got) == len(counts)


def brute_force(rows):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        counts[lang, source].update(terms_of(text))
        docs[lang].update(set(terms_of(text)))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= divergence.LEAST_DOCUMENTS]

        def shares(count):
            size = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // size for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o)
                     for o in sources - {s}]
            over = [(whole[t] - p[s][t], t.encode(), t) for t in kept
                    if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(over)[:50])):
                out |= {(lang, s, part, i, -v, k) for k, (v, _, i) in enumerate(items, 1)}
    return out


def rows_of(draw):
    common = words(draw, 300)
    rows = []
    for k in range(500):
        lang = draw.choice(["de", "de", "en", None])
        source = draw.choice(["a", "a", "a", "b", "ü", None, "c"])
        text = " ".join(draw.choices(common, k=draw.choice([0, 40, 150])))
        rows.append((None if k % 50 == 0 else text, lang, source))
    rows += [("only rare words", "xx", "a"), (None, "xx", "b"), ("", "yy", "z")]
    return rows + [rows[3]] * 40 + [(" ".join(common * 300), "de", "b")]


def test_audit_equals_counting(spark):
    rows = rows_of(random.Random(5))
    docs = spark.createDataFrame(
        [(k, *r, 1, 2, "t", "a", 3, 4, 5) for k, r in enumerate(rows)], COLUMNS)
    found = [tuple(r) for r in divergence.audit(docs).collect()]
    expected = brute_force(rows)
    assert len(found) == len(set(found)) and set(found) == expected
    assert {r[2] for r in found} == {"pair", "term"} and max(r[5] for r in found) == 50
    assert ("xx", "a", "pair", "b", 0, 1) in expected


def test_many_sources_are_compared_in_tiles(spark):
    draw = random.Random(9)
    rows = [(" ".join(draw.choices("abcdefgh", k=9)), "l", f"s{k % 13}") for k in range(390)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    kept = divergence.kept_terms(divergence.term_counts(docs))
    groups = divergence.source_groups(docs, kept)
    expected = {(r[0], r[1], r[3], r[4]) for r in brute_force(rows) if r[2] == "pair"}
    for block in (1, 4, 64):
        found = divergence.pair_divergence(kept, groups, block).collect()
        assert len(found) == 13 * 12 and set(map(tuple, found)) == expected


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], COLUMNS)).collect() == []
