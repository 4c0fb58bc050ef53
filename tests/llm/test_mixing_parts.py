"""The mix lays out a shard part by part, with the sums of one run through it."""

import hashlib
import io
from collections import defaultdict
from contextlib import redirect_stdout

from tillstar.llm import mixing


def test_parts_of_a_shard_continue_each_other(spark):
    rows = [(k, "w " * (k * 7 % 40 + 1), "abc"[k % 3]) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    mixed = mixing.mix(docs)
    with redirect_stdout(io.StringIO()) as out:
        mixed.explain()
    held = [line for line in out.getvalue().splitlines() if "Window [" in line and "order" in line]
    assert held and all("part" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in held)
    by_source = defaultdict(list)
    for r in mixed.collect():
        by_source[r.row.source].append(r)
    for found in by_source.values():  # one shard each
        found.sort(key=lambda r: hashlib.md5(f"{mixing.SEED}/{r.doc_id}".encode()).hexdigest())
        whole, left = divmod(sum(r.taken for r in found), found[0].source_size)
        for r in found:
            extra = min(r.size, left)
            assert r.taken == whole * r.size + extra
            left -= extra
