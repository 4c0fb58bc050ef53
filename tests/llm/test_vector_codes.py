"""Vector codes: the masks' search and the whole compression against plain searching."""

import hashlib
import math
import random

import numpy as np
import pytest

from tillstar.llm import vector_codes

COLUMNS = ("vec_id bigint, embedding array<float>, label int, ints string, code string,"
           " error int, of_label int, slot int")


def plain(entries, x):
    scored = [(sum((a - b)**2 for a, b in zip(e, x)), k) for k, e in enumerate(entries)]
    return min(scored)


@pytest.mark.parametrize("spread", [1, 40, 1 << 24])
def test_nearest_equals_measuring_all(spread):
    draw = np.random.default_rng(spread)
    for count, width in ((1, 3), (7, 1), (256, 4), (200, 16), (5, 0)):
        entries = draw.integers(-spread, spread + 1, (count, width))
        entries[count // 2] = entries[0]  # an equal entry never wins
        x = np.concatenate([draw.integers(-spread, spread + 1, (60, width)), entries[:9]])
        entry, distance = vector_codes.PartIndex(entries).nearest(x)
        expected = [plain(entries.tolist(), row) for row in x.tolist()]
        assert list(zip(distance.tolist(), entry.tolist())) == expected


def test_masks_hold_exactly_the_entries_in_the_box():
    draw = np.random.default_rng(2)
    entries = draw.integers(-9, 9, (130, 3))
    x, radius = draw.integers(-9, 9, (50, 3)), draw.integers(0, 9, 50)
    masks = vector_codes.PartIndex(entries).candidates(x, radius)
    for row, r, mask in zip(x, radius, masks):
        inside = (np.abs(entries - row) <= r).all(axis=1)
        bits = sum(int(w) << (64 * k) for k, w in enumerate(mask))
        assert bits == sum(1 << int(k) for k in np.flatnonzero(inside))


def brute_force(rows):
    whole = [(v, [math.floor(1024 * x) for x in e], lab) for v, e, lab in rows
             if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    width = max(len(e) for _, e, _ in whole) // 4
    part = lambda e, p: tuple(e[p * width:(p + 1) * width])
    first = sorted(whole, key=lambda r: (r[0], r[1]))[:256]
    books = [[part(e, p) for _, e, _ in first] for p in range(4)]
    for _ in range(4):
        for p in range(4):
            taken = [[] for _ in books[p]]
            for _, e, _ in whole:
                taken[plain(books[p], part(e, p))[1]].append(part(e, p))
            books[p] = [tuple(sum(c) // len(t) for c in zip(*t)) if t else b
                        for t, b in zip(taken, books[p])]
    coded = []
    for v, e, lab in whole:
        found = [plain(books[p], part(e, p)) for p in range(4)]
        coded.append((v, bytes(k for _, k in found).hex(), sum(d for d, _ in found), lab))
    total = {}
    for *_, error, lab in coded:
        total[lab] = total.get(lab, 0) + error
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted((v, c, error, total[lab], sha) for v, c, error, lab in coded)


def test_compression_equals_the_plain_one(spark):
    draw = random.Random(4)
    centres = [[draw.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = []
    for k in range(420):
        e = [float(np.float32(c + draw.gauss(0, 0.2))) for c in draw.choice(centres)]
        rows.append((k * 3 % 419, e, draw.choice([1, 1, 1, 2, None])))
    bad = [None, [], [1.0] * 7 + [None], [float("nan")] * 8, [1.0] * 7 + [float("-inf")]]
    rows += [rows[5]] * 30
    all_rows = rows + [(k, e, 1) for k, e in enumerate(bad) if e != []]
    df = spark.createDataFrame(
        [(*r, "i", "c", 1, 2, 3) for r in all_rows], COLUMNS).repartition(7)
    found = sorted(tuple(r) for r in vector_codes.codes(df).collect())
    assert found == brute_force(all_rows)
    assert len(found) == 450


def test_short_empty_and_huge_vectors_have_a_result(spark):
    rows = [(1, [], None), (2, [1.0], 5), (None, [3e38, -3e38, 0.0], 5), (4, [1.0, 0.0, 0.0], 5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    found = {r.vec_id: r for r in vector_codes.codes(df).collect()}
    assert set(found) == {1, 2, 4, None} and all(r.error == 0 for r in found.values())
    assert found[2].code == found[4].code == "01000000" and found[None].code == "03030000"
    only_empty = vector_codes.codes(df.filter("vec_id = 1")).collect()
    assert [(r.code, r.error, r.label_error) for r in only_empty] == [("00000000", 0, 0)]


def test_without_whole_vectors_the_result_is_empty(spark):
    df = spark.createDataFrame([(1, None, 2)], "vec_id bigint, embedding array<float>, label int")
    for some in (df, df.limit(0)):
        assert vector_codes.codes(some).collect() == []
