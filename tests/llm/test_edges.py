"""Every operator and stage on NULLs, empty and long texts, ties, repeated rows,
empty tables and extra columns whose names the operators use themselves."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tillstar.llm import (
    decontamination,
    language_id,
    line_dedup,
    mixing,
    near_duplicates,
    quality,
    search,
    secret_scan,
    sharding,
    url_filter,
)

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, rank int,"
          " shard int, size bigint, fp bigint, score double, row string, line int, _id int")
ITEM = "the quick onyx goblin jumps over a lazy dwarf while seven wizards judge"
LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30000))
TEXTS = [None, "", " \t\n", "one", "a b c d", "a b c d", "A B c d", "x\ny\nz\nv", "q\nx\ny\nz",
         f"before that {ITEM} and after that", "password=abcdef123 AKIA" + "B" * 20, LONG,
         "token=token:abcdefgh", "été ÜBER straße 漢字 слово", "😀 password: \"s3cr3t99\" 😀"]
ROWS = [(k % 12 if k != 3 else None, t, ["en", None, "de"][k % 3], [None, "a", "b"][k % 3], 1,
         k, k, k, k, 0.5, "r", k, k) for k, t in enumerate([*TEXTS, TEXTS[4], TEXTS[9]])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "labels": spark.createDataFrame(
            [(0, 1, 0), (4, 1, 0), (5, 0, 0), (5, 0, 0), (None, 1, 0), (7, None, 0)],
            "doc_id bigint, quality int, toxic int"),
        "benchmark": spark.createDataFrame(
            [(1, ITEM), (2, None), (3, ""), (4, "two words"), (None, "no id at all here")],
            "item_id bigint, text string"),
    }


def base_spans(text):
    text = text or ""
    assign = (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
              r"""([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A)
             if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text)
              if len(m[0]) >= 24]
    return sorted(found)


def test_secrets(docs, none):
    rows = secret_scan.find_secrets(docs).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        got = [(s.start, s.kind_no, s.end) for s in r.found if s.kind_no < 3]
        assert got == base_spans(r.text)
    assert secret_scan.find_secrets(none).count() == 0


def test_trigram_queries():
    query = secret_scan.trigram_query
    assert query("[0-9a-f]{24,}") == []
    assert query("AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert query("abcd|xyz") == [frozenset({"abc", "bcd"}), frozenset({"xyz"})]
    assert query("ab.cd") == []


def test_quality(docs, none, tables):
    rows = quality.score_quality(docs, tables["labels"]).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
    assert quality.score_quality(none, tables["labels"]).count() == 0
    unlabelled = quality.score_quality(docs, tables["labels"].limit(0)).collect()
    assert {r.predicted for r in unlabelled} == {1}
    assert quality.keep_good(docs, tables["labels"].limit(0)).columns == docs.columns


def test_trees_learn_a_rule():
    draw = np.random.default_rng(1)
    x = draw.random((3000, 4)).astype(np.float32)
    y = ((x[:, 1] > 0.3) & (x[:, 2] < 0.8)).astype(float)
    wrong = (quality.fit(x[:2000], y[:2000]).score(x[2000:]) >= 0.5) != y[2000:]
    assert wrong.mean() < 0.02


def test_near_duplicates(docs, none):
    rows = near_duplicates.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    assert near_duplicates.near_duplicates(none).count() == 0
    for text in TEXTS:
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        ones = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
        expected = sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))
        assert near_duplicates.fingerprint((text or "").encode()) == expected
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({near_duplicates.fingerprint((t or "").encode()) for t in TEXTS})


def test_links_equal_brute_force(spark):
    draw = np.random.default_rng(5)
    centres = draw.integers(-2**63, 2**63 - 1, 40)
    prints = {0, -1, 1, 3, -2**63}
    for c in centres.tolist():
        for _ in range(8):
            flips = draw.choice(64, draw.integers(0, 6), replace=False)
            value = c & (2**64 - 1)
            for b in flips.tolist():
                value ^= 1 << b
            prints.add(value - 2**64 if value >> 63 else value)
    found = near_duplicates.links_between(
        spark.createDataFrame([(p,) for p in prints], "fp bigint")).collect()
    near = {(a, b) for a in prints for b in prints
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert len(found) == len(near) and {(r.a, r.b) for r in found} == near


def test_decontamination(docs, none, tables):
    found = {(r.doc_id, r.item_id): r for r in
             decontamination.contaminated(docs, tables["benchmark"]).collect()}
    assert set(found) == {(9, 1), (4, 1)} and found[9, 1].score == 1.0
    assert (found[9, 1].start_word, found[9, 1].end_word) == (2, 15)
    assert decontamination.contaminated(none, tables["benchmark"]).count() == 0
    assert decontamination.contaminated(docs, tables["benchmark"].limit(0)).count() == 0
    kept = decontamination.drop_contaminated(docs, tables["benchmark"])
    assert kept.columns == docs.columns
    assert kept.count() == sum(ITEM not in (r[1] or "") for r in ROWS) == len(ROWS) - 2


def test_alignment_equals_the_full_matrix():
    draw = np.random.default_rng(2)
    for _ in range(40):
        item, passage = draw.integers(0, 5, draw.integers(1, 9)), draw.integers(0, 5, 14)
        table = np.zeros((len(item) + 1, len(passage) + 1))
        for i, a in enumerate(item, 1):
            for j, b in enumerate(passage, 1):
                table[i, j] = max(0, table[i - 1, j - 1] + (2 if a == b else -1),
                                  table[i - 1, j] - 1, table[i, j - 1] - 1)
        score, begin, end = decontamination.align(item, passage)
        assert math.isclose(score, table.max() / (2 * len(item)))
        assert 0 <= begin <= end <= len(passage)


def test_mixing(docs, none):
    rows = mixing.mix_sizes(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    total = sum(r.size for r in rows)
    assert total - 16 <= sum(r.taken for r in rows) <= total
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.mix_sizes(docs).collect()))
    assert mixing.mix_sizes(none).count() == 0
    documents = mixing.mixed_documents(docs)
    assert documents.columns == docs.columns
    words = sum(len(r.text.split()) for r in documents.select("text").collect())
    assert words == sum(r.taken for r in rows)


def test_targets_equal_repeated_sharing(spark):
    sizes = {"a": 1, "b": 2, "c": 1000, None: 50, "d": 7}
    frame = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    order = sorted((s for s in sizes if s), key=str.encode) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(sizes, 0.0), float(sum(sizes.values())), set(sizes)
    while left > 1e-9 and open_:
        total, share, left = sum(weight[s] for s in open_), left, 0.0
        for s in list(open_):
            target[s] += share * weight[s] / total
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.remove(s)
    assert got == pytest.approx(target)


def test_apportion_equals_highest_quotients(spark):
    votes = {k: v for k, v in enumerate([1000, 3, 77, 412, 0, 77, 5000])}
    frame = spark.createDataFrame(
        [(p, v, 10**6, 97) for p, v in votes.items()],
        "party int, votes bigint, most bigint, total bigint")
    got = {r.party: r.seats for r in mixing.apportion(frame, [], "party").collect()}
    seats = dict.fromkeys(votes, 0)
    for _ in range(97):
        seats[max(votes, key=lambda p: (votes[p] / (2 * seats[p] + 1), -p))] += 1
    assert got == seats


def test_sharding(spark, docs, none):
    rows = sharding.place(docs, 3).collect()
    check_shards(rows, 3, len(ROWS))
    assert sharding.place(none).count() == 0
    texts = ["hot"] * 200 + ["pair"] * 2 + [f"t{k}" for k in range(198)]
    many = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = sharding.place(many).collect()
    check_shards(rows, 8, 400)
    shards = defaultdict(set)
    for r in rows:
        shards[r.text_crc32].add(r.shard)
    widths = sorted(map(len, shards.values()))
    # 200 copies need four shards of 50; the pair may take places in one of them.
    assert widths[-1] <= 5 and widths[-2] == 1


def check_shards(rows, shards, total):
    assert len(rows) == total
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert len(slots) == shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_urls(spark):
    pages = spark.createDataFrame([
        (1, "http://Ads.Example.com:80/x", "2024-01-05"), (2, "https://u@ads.example.com./", "2024-02-05"),
        (3, None, "2024-01-05"), (4, "not a url", "2024-01-05"), (5, "http://example.com", None),
        (6, "http://example.com/a?b=http://ads.example.com", "2024-01-05"),
        (6, "http://example.com/a?b=http://ads.example.com", "2024-01-05"),
    ], "page_id bigint, url string, day string").selectExpr(
        "page_id", "url", "cast(day as timestamp) as fetched_at", "'x' as domain", "1 as month")
    entries = spark.createDataFrame([
        ("ads.example.com", "ads", True, "2024-01-01"), ("ads.example.com", None, False, "2024-02-01"),
        ("ads.example.com", "ads", True, "2024-01-01"), ("com", "all", True, "2025-01-01"),
        (None, "ads", True, "2024-01-01"), ("example.org", "ads", True, None),
    ], "domain string, category string, listed boolean, day string").selectExpr(
        "domain", "category", "listed", "cast(day as date) as day")
    spells = url_filter.validity_intervals(entries)
    rows = url_filter.filter_captures(pages, spells).collect()
    assert sorted((r.page_id, r.verdict) for r in rows) == [
        (1, "block"), (2, "allow"), (3, "invalid"), (4, "invalid"), (5, "invalid"),
        (6, "allow"), (6, "allow")]
    assert url_filter.filter_captures(pages.limit(0), spells).count() == 0
    assert url_filter.filter_captures(pages, spells.limit(0)).count() == 7


def test_search_equals_brute_force(spark, docs, none, monkeypatch):
    monkeypatch.setattr(search, "SHARD_BYTES", 40_000)
    got = sorted(map(tuple, search.top_k(docs, 3, 4, 8).collect()), key=str)
    words = [search.split_words(r[1] or "") for r in ROWS]
    counts = [Counter(w) for w in words]
    mean, n = sum(map(len, words)) / len(words), len(words)
    df = Counter(t for c in counts for t in c)
    idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
    asked = defaultdict(Counter)
    for r, c in zip(ROWS, counts, strict=True):
        if r[0] is not None and r[0] % 4 == 0:
            asked[r[0]] += c
    expected = []
    for query, c in asked.items():
        terms = sorted((df[t] == 1, -round(f * idf[t], 6), t) for t, f in c.items())
        terms = [t for _, _, t in terms[:8]]
        scored = []
        for r, d in zip(ROWS, counts, strict=True):
            hit = [idf[t] * d[t] * 2.2 / (d[t] + 1.2 * (0.25 + 0.75 * sum(d.values()) / mean))
                   for t in terms if t in d]
            if hit:
                scored.append((-round(math.fsum(hit), 6), math.inf if r[0] is None else r[0]))
        expected += [(query, k, None if i == math.inf else i, -s)
                     for k, (s, i) in enumerate(sorted(scored)[:3], 1)]
    assert got == sorted(expected, key=str)
    assert search.top_k(none).count() == 0


def test_wand_equals_scoring_everything(monkeypatch):
    draw = np.random.default_rng(9)
    looked_up = []
    look_up = search.Shard._looked_up
    monkeypatch.setattr(search.Shard, "_looked_up", lambda self, docs, *rest: (
        looked_up.append(len(docs)), look_up(self, docs, *rest))[1])
    for trial in range(120):
        n_docs, n_terms, k = int(draw.integers(1, 900)), int(draw.integers(1, 60)), 10
        has = draw.random((n_docs, n_terms)) < draw.choice([0.01, 0.1, 0.6], n_terms)
        docs, terms = np.nonzero(has)
        scores = np.round(draw.random(len(docs)) * draw.choice([1, 5, 30], n_terms)[terms], 1) + 0.1
        order = draw.permutation(n_docs)
        shard = search.Shard(terms.astype(np.int32), docs.astype(np.int32), scores, order, k)
        asked = draw.permutation(len(shard.best))[:int(draw.integers(1, 50))]
        total = defaultdict(float)
        for d, t, s in zip(docs, terms, scores, strict=True):
            if t in asked:
                total[int(d)] += s
        ranked = sorted((-round(s, 6), order[d], d) for d, s in total.items())
        for least in (-math.inf, -ranked[len(ranked) // 2][0] if ranked else 1.0, 1e9):
            expected = [(-s, d) for s, _, d in ranked[:k] if -s >= least]
            assert shard.search(asked, least) == expected
    assert len(looked_up) > 20 and sum(looked_up) > 0


def test_languages(spark, docs, none):
    model = language_id.learn(docs)
    rows = language_id.identify(docs, model).collect()
    assert len(rows) == len(ROWS) and {r.lang_pred for r in rows} <= {"en", "de", "und"}
    assert all((r.lang_pred == "und") == (r.score == 0) for r in rows)
    assert {r.lang_pred for r in language_id.identify(docs, language_id.learn(none)).collect()} == {"und"}
    assert language_id.identify(none, model).count() == 0
    known = spark.createDataFrame(
        [(k, "the thing that other with this there", "en") for k in range(30)]
        + [(k, "слово привет мир этот", "ru") for k in range(30)]
        + [(k, "le chat noir dans une maison rouge", "fr") for k in range(30)],
        "doc_id bigint, text string, lang string")
    mixed = spark.createDataFrame(
        [(1, "the other thing with that this there the thing 5 слово мир привет этот слово. "
             "dans la maison le chat rouge noir une maison dans")], "doc_id bigint, text string")
    row = language_id.identify(mixed, language_id.learn(known)).head()
    assert [s.lang for s in row.spans] == ["en", "ru", "fr"]


def test_viterbi_equals_all_paths():
    from itertools import product
    draw = np.random.default_rng(4)
    for _ in range(60):
        scores = (draw.random((6, 3)) * -9).astype(np.float32)
        scores -= scores.max(axis=1, keepdims=True)
        worth = lambda p: sum(float(scores[t, k]) for t, k in enumerate(p)) - 5.0 * sum(
            a != b for a, b in zip(p, p[1:]))  # noqa: B905
        best = max(map(worth, product(range(3), repeat=6)))
        assert math.isclose(worth(language_id.viterbi(scores, 5.0)), best, abs_tol=1e-4)


def test_lines(docs, none):
    rows = {(r.id, r.text): r for r in line_dedup.dedup_lines(docs, 3).selectExpr(
        "row.doc_id as id", "row.text as before", "text", "n_lines", "n_deleted").collect()}
    assert len(line_dedup.dedup_lines(docs).collect()) == len(ROWS)
    assert rows[8, "q"].n_deleted == 3  # x, y, z stand in document 7 already
    assert (0, None) in rows and rows[0, None].n_lines == 0 and rows[1, ""].n_lines == 0
    assert line_dedup.dedup_lines(none).count() == 0


def test_pipeline_stages(spark, docs, tables, tmp_path, monkeypatch):
    for name, frame in tables.items():
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    current = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_shards(rows, 8, len(rows))
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0



def test_line_runs_equal_the_longest_repeats(spark):
    """Every maximal run of enough words that stands earlier is deleted, and nothing else."""
    draw = np.random.default_rng(12)
    some = ["", " ", "a", "b c", "d", "e f g h i j", "k l m n", "}", "o p q r s t u v"]
    rows = [(int(k), "\n".join(draw.choice(some, int(draw.integers(1, 9))))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for least in (1, 4, 6, 11):
        found = {r.row.doc_id: r.text for r in line_dedup.dedup_lines(docs, least).collect()}
        earlier = []
        for doc_id, text in rows:
            lines = text.split("\n")
            solid = [(k, x) for k, x in enumerate(lines) if x.strip()]
            gone = set()
            for i in range(len(solid)):
                for j in range(i, len(solid)):
                    run = [x for _, x in solid[i:j + 1]]
                    size = [len(x.split()) for x in run]
                    if sum(size) < least:
                        continue
                    before = [s[a:a + len(run)] for s in earlier for a in range(len(s))]
                    before += [[x for _, x in solid[a:a + len(run)]] for a in range(i)]
                    if run in before:
                        gone |= {k for k, _ in solid[i:j + 1]}
                        if min(sum(size[1:]), sum(size[:-1])) < least:  # blank lines inside
                            gone |= set(range(solid[i][0], solid[j][0] + 1))
            earlier.append([x for _, x in solid])
            assert found[doc_id] == "\n".join(x for k, x in enumerate(lines) if k not in gone)


def test_blank_lines_and_short_lines_stay(spark):
    text = "intro\n\nbody one\n\n}\nend"
    docs = spark.createDataFrame([(k, text if k < 2 else text + str(k)) for k in range(4)],
                                 "doc_id bigint, text string")
    rows = {r.row.doc_id: (r.text, r.n_deleted) for r in line_dedup.dedup_lines(docs).collect()}
    assert {k: n for k, (_, n) in rows.items()} == {0: 0, 1: 0, 2: 0, 3: 0}
    rows = {r.row.doc_id: r.text for r in line_dedup.dedup_lines(docs, 4).collect()}
    assert rows == {0: text, 1: "", 2: "end2", 3: "end3"}
