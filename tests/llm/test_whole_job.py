"""The registered queries do the whole job: no query is cut, no repeat is left."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from pyspark.sql import functions as F

from tillstar.llm import (
    decontamination,
    quality,
    queries,
    search,
    secret_scan,
    sharding,
    url_filter,
)


def folder_of(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_search_uses_all_words_of_a_query(spark, tmp_path):
    draw = random.Random(7)
    rows = [(k, " ".join(f"w{int(draw.paretovariate(0.6)) % 400}"
                         for _ in range(draw.randint(20, 90)))) for k in range(150)]
    got = sorted(map(tuple, queries.op8_search(spark, folder_of(spark, tmp_path, rows)).collect()))
    counts = [Counter(search.split_words(t)) for _, t in rows]
    mean, n = sum(c.total() for c in counts) / len(counts), len(counts)
    df = Counter(t for c in counts for t in c)
    idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
    expected = []
    for query in (0, 50, 100):
        assert len(counts[query]) > 8
        scored = []
        for i, d in enumerate(counts):
            hit = [idf[t] * d[t] * 2.2 / (d[t] + 1.2 * (0.25 + 0.75 * d.total() / mean))
                   for t in counts[query] if t in d]
            if hit:
                scored.append((-round(math.fsum(hit), 6), i))
        expected += [(query, k, i, -s) for k, (s, i) in enumerate(sorted(scored)[:10], 1)]
    assert got == expected


def test_single_lines_that_repeat_go(spark, tmp_path):
    line = " ".join(f"word{k}" for k in range(60))
    rows = [(1, f"a\n{line}\nb\nc"), (2, f"d\ne\n{line}\nf"), (3, line), (4, f"{line}\ng"),
            (5, f"h\nh\n{line}"), (6, "i\nj"), (7, None), (8, "")]
    found = queries.op10_line_dedup(spark, folder_of(spark, tmp_path, rows)).collect()
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert {r.doc_id: (r.n_lines, r.n_deleted, r.text_md5) for r in found} == {
        1: (4, 0, md5(rows[0][1])), 2: (4, 1, md5("d\ne\nf")), 3: (1, 1, md5("")),
        4: (2, 1, md5("g")), 5: (3, 1, md5("h\nh")), 6: (2, 0, md5("i\nj")), 7: (0, 0, md5("")),
        8: (0, 0, md5(""))}


def test_edited_copies_are_found_beside_exact_ones(spark):
    draw = random.Random(11)
    item = [f"i{k}" for k in range(38)]
    edited = [w if k % 5 else f"x{k}" for k, w in enumerate(item, 1)]
    texts = [item, item, edited]
    for share in (0.10, 0.15, 0.21, 0.27, 0.33):
        for _ in range(12):
            changed = set(draw.sample(range(38), round(share * 38)))
            texts.append([f"y{k}" if k in changed else w for k, w in enumerate(item)])
    fill = lambda n: [f"f{draw.randrange(10**6)}" for _ in range(n)]
    rows = [(k, " ".join(fill(30) + t + fill(draw.randrange(90)))) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for least in (0, 2):  # with and without exact copies elsewhere
        items = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
        found = {r.doc_id for r in decontamination.contaminated(
            docs.filter(docs.doc_id >= least), items).collect()}
        numbers = {w: n for n, w in enumerate({w for _, t in rows for w in t.split()})}
        coded = lambda words: np.array([numbers[w] for w in words])
        score = {k: decontamination.align(coded(item), coded(t.split()))[0]
                 for k, t in rows if k >= least}
        grams = lambda ws: set(zip(ws, ws[1:], ws[2:], strict=False))
        assert found == {k for k, s in score.items() if s >= decontamination.THRESHOLD
                         and grams(item) & grams(rows[k][1].split())}
        assert 2 in found and len(found) > 40


def test_groups_of_copies_stay_whole_without_other_rows(spark):
    texts = [f"t{k}" for k in range(400) for _ in range(2 + k % 39)]
    random.Random(1).shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = sharding.place(docs).collect()
    shards, sizes = defaultdict(set), Counter(r.shard for r in rows)
    for r in rows:
        shards[r.text_crc32].add(r.shard)
    assert len(rows) == len(texts) and max(sizes.values()) - min(sizes.values()) <= 1
    assert sum(len(s) > 1 for s in shards.values()) < sharding.SHARDS


def test_packing_fills_quotas_and_splits_fewer_hubs_than_shards():
    draw = random.Random(5)
    for _ in range(300):
        shards = draw.randint(1, 8)
        sizes = {draw.randint(2, 60): draw.randint(1, 30) for _ in range(draw.randint(1, 12))}
        total = sum(n * c for n, c in sizes.items()) + draw.choice([0, 0, 5, 400])
        quotas = [total // shards + (s < total % shards) for s in range(shards)]
        for even in (True, False):
            pieces = sharding.packed(list(sizes.items()), quotas, even)
            copies, used, torn = Counter(), Counter(), set()
            for n, rank, hubs, shard, cnt in pieces:
                used[shard] += hubs * cnt
                copies.update({(n, k): cnt for k in range(rank, rank + hubs)})
                torn |= {(n, rank)} if cnt < n else set()
            assert copies == {(n, k): n for n, c in sizes.items() for k in range(c)}
            assert all(used[s] <= q for s, q in enumerate(quotas))
            assert len(torn) < max(shards, 2) and (shards > 1 or not torn)


def test_an_edited_copy_with_few_trigrams_left_is_found(spark):
    item = [f"i{k}" for k in range(38)]
    edited = " ".join(w if k % 5 else f"x{k}" for k, w in enumerate(item, 1))
    docs = spark.createDataFrame([(1, " ".join(item)), (2, edited)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    for some, found in ((docs.filter("doc_id = 2"), {2}), (docs, {1, 2})):
        assert {r.doc_id for r in decontamination.contaminated(some, items).collect()} == found


def test_clean_rows_stay_beside_a_leak_with_their_id(spark):
    item = "the quick onyx goblin jumps over a lazy dwarf while seven wizards judge"
    rows = [(None, f"here {item} there"), (None, "clean without an id"), (7, item),
            (7, "clean with the id of a leak"), (8, None), (7, item)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    kept = decontamination.drop_contaminated(docs, items).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)


def test_hosts_of_odd_urls(spark):
    urls = {"http://user:p@ss@evil.com/x@y": "evil.com", "http://[2001:db8::1]:80/": "[2001:db8::1]",
            "HTTPS://1.2.3.4:8080?q=@z": "1.2.3.4", "http://a.b.co.": "a.b.co", "http://": None,
            "http://x/a@b": "x", "http://" + "a." * 300 + "org": "a." * 300 + "org", "ftp://x": None}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    found = df.select("url", url_filter.host_of("url").alias("h")).collect()
    assert {r.url: r.h for r in found} == urls
    hosts = spark.createDataFrame([("1.2.3.4",), ("[::1]",), ("a.b.co",)], "h string")
    parents = {r.h: r.d for r in hosts.select("h", url_filter.domains_of(hosts.h).alias("d")).collect()}
    assert parents == {"1.2.3.4": ["1.2.3.4"], "[::1]": ["[::1]"], "a.b.co": ["a.b.co", "b.co", "co"]}


def test_long_logins_are_found(spark):
    url = f"ftp://{'u' * 90}:{'p' * 70}@host"
    docs = spark.createDataFrame([(1, f"see {url}")], "doc_id bigint, text string")
    spans = secret_scan.find_secrets(docs).select(secret_scan.as_text(F.col("found"))).head()[0]
    assert spans == f"url_login:4:{4 + len(url) - 4}"


def test_quality_learns_each_text_once_from_about_the_sample(spark):
    rows = [(k, f"text number {k % 300}") for k in range(400)] + [(1, f"other {k}") for k in range(600)]
    docs = spark.createDataFrame(rows * 2, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id bigint, quality int")
    known = {r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2}
    x, y = quality.training_rows(docs, labels)
    assert len(x) == len(y) == len(known)
    assert quality.sample(docs, labels, 40).count() < 90


def test_flat_trees_equal_walking_node_by_node():
    draw = np.random.default_rng(8)
    x = draw.normal(size=(400, len(quality.STATISTICS))).astype(np.float32)
    trees = quality.fit(x, (x[:, 3] + x[:, 5] > 0).astype(float))
    total = np.full(len(x), trees.base)
    for k, row in enumerate(x):
        for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
            total[k] += leaf[node - len(feature)]
    assert np.allclose(trees.score(x), 1 / (1 + np.exp(-total)))
