"""Rare seeds and support: which passages open, and what share of edited copies is found."""

import random
from collections import Counter

import numpy as np

from tillstar.llm import decontamination


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id bigint, text string"),
            spark.createDataFrame(items, "item_id bigint, text string"))


def test_a_common_phrase_opens_no_passage_but_rare_seeds_do(spark):
    items = [(1, "which of the following is true of " + " ".join(f"a{k}" for k in range(40)))]
    phrase = [(k, f"x{k} which of the y{k}") for k in range(2, 40)]
    docs, items = frames(spark, [(1, items[0][1]), *phrase], items)
    assert {r.doc_id for r in decontamination.passages(docs, items).collect()} == {1}
    assert [(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()] == [(1, 1)]


def test_an_item_of_one_seed_is_found(spark):
    docs, items = frames(
        spark, [(1, "a b one two three c"), (2, "one two"), (3, "one two three")], [(7, "One two three")])
    assert {r.doc_id for r in decontamination.contaminated(docs, items).collect()} == {1, 3}


def test_share_of_edited_copies_found_against_aligning_all(spark):
    draw = random.Random(11)
    words = [f"v{k}" for k in range(400)]
    code = {w: k for k, w in enumerate(words)}
    items = [[draw.choice(words[:80] if draw.random() < 0.5 else words)
              for _ in range(draw.randint(10, 45))] for _ in range(60)]
    docs, origin = [], {}
    for i, item in enumerate(items):
        for share in (0, 0.1, 0.2, 0.3):
            copy = list(item)
            for at in draw.sample(range(len(copy)), round(share * len(copy))):
                copy[at] = draw.choice(words)
            around = [draw.choice(words) for _ in range(draw.randint(0, 150))]
            origin[len(docs)] = i, share
            docs.append((len(docs), " ".join([*around, *copy, *around[::-1]])))
    coded = lambda text: np.array([code[w] for w in text], np.uint64)
    leaked = {(k, origin[k][0]) for k, text in docs if decontamination.align(
        coded(items[origin[k][0]]), coded(text.split()))[0] >= decontamination.THRESHOLD}
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(*frames(
        spark, docs, [(i, " ".join(item)) for i, item in enumerate(items)])).collect()}
    whole = Counter(origin[k][1] for k, _ in leaked)
    hit = Counter(origin[k][1] for k, _ in leaked & found)
    assert found <= leaked
    assert all(hit[s] == whole[s] for s in (0, 0.1, 0.2)) and hit[0.3] >= 0.9 * whole[0.3]
