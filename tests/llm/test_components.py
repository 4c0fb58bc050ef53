"""Components of chains, dense groups and random links."""

import random

from tillstar.llm.components import components


def found(spark, links):
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    return {r.node: r.label for r in components(frame).collect()}


def by_hand(links):
    label = {n: n for pair in links for n in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(label[a], label[b])
            if label[a] != least or label[b] != least:
                label[a] = label[b] = least
                changed = True
    return label


def test_a_long_chain_in_order_and_shuffled(spark):
    links = [(k, k + 1) for k in range(200)]
    assert found(spark, links) == {k: 0 for k in range(201)}


def test_dense_group_and_pairs(spark):
    links = [(a, b) for a in range(-5, 15) for b in range(a + 1, 15)] + [(100, 101), (-50, 101)]
    assert found(spark, links) == by_hand(links)


def test_random_links(spark):
    draw = random.Random(3)
    links = [tuple(sorted(draw.sample(range(300), 2))) for _ in range(200)]
    assert found(spark, links) == by_hand(links)


def test_no_links(spark):
    assert found(spark, []) == {}
