import math
import random

import pytest
from pyspark.sql import functions as F

from corpuslink.llm import resharding, topk, url_rules
from corpuslink.session import shared_folder


def _brute_top(rows, is_query, k):
    usable = [
        (i, [math.floor(1024 * x) for x in v]) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in usable:
        if is_query(q):
            scored = [(sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q]
            scored.sort(key=lambda s: (-s[0], s[1]))
            out += [(q, rank, i, s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) * rng.choice([0.01, 1, 3]) for _ in range(12)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(500, None), (501, []), (502, [1.0, None]), (503, [math.nan] * 12), (504, [math.inf] * 12)]
    return rows + [(505, [0.0] * 12), (506, [1.0, 2.0]), (510, [0.5] * 12)]


def test_top_k_equals_brute_force(spark, vectors, monkeypatch):
    for name, size in (("SLAB", 64), ("RUN", 16), ("QUERY_BLOCK", 8)):
        monkeypatch.setattr(topk, name, size)
    table = spark.createDataFrame(vectors, "vec_id long, e array<double>").withColumn("norm", F.lit("x")).repartition(3)
    got = topk.top_k(topk.integer_vectors(table, "vec_id", "e"), F.col("vec_id") % 10 == 0, k=10)
    assert sorted(map(tuple, got.collect())) == _brute_top(vectors, lambda i: i % 10 == 0, 10)


def test_top_k_of_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0]), (10, [2.0]), (3, [-1.0])], "vec_id long, e array<float>")
    vectors = topk.integer_vectors(few, "vec_id", "e")
    got = topk.top_k(vectors, F.col("vec_id") % 10 == 0, k=10).collect()
    assert sorted(map(tuple, got)) == [
        (0, 1, 10, 2 << 20), (0, 2, 3, -(1 << 20)), (10, 1, 0, 2 << 20), (10, 2, 3, -(2 << 20)),
    ]
    assert topk.top_k(vectors.where("vec_id < 0"), F.lit(True)).count() == 0


def test_pruning_leaves_work_out(vectors):
    import numpy as np

    rng = np.random.default_rng(1)
    x = np.rint(rng.normal(size=(2000, 16)) * 100).astype(np.int64)
    x[100:] //= 20
    seen = []
    searcher = topk.Searcher(np.eye(16), 5, 4)
    original = np.einsum
    try:
        topk.np.einsum = lambda *a: seen.append(len(a[1])) or original(*a)
        a, b, score = searcher.search(np.arange(10), x[:10], np.full(10, -np.inf), np.arange(2000), x)
    finally:
        topk.np.einsum = original
    assert sum(seen) < 0.5 * 10 * 2000
    exact = x[:10] @ x.T
    exact[np.arange(10), np.arange(10)] = -(10**9)
    for q in range(10):
        assert sorted(score[a == q]) == sorted(np.sort(exact[q])[-5:])


RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("a.example.net", "/", "block"), ("a.example.net", "/en/x", "allow"), ("a-b.net", "", "allow"), ("Example.ORG", "/", "block"),
]


def _brute_judge(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [
        (len(h) + len(p), len(h), h.lower() + p, v) for h, p, v in RULES
        if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_url_rules_equal_brute_force(spark):
    rng = random.Random(8)
    hosts = ["net", "example.net", "A.example.net", "b.a.example.net", "xample.net", "anet", "a-b.net", "example.com",
             "w.example.com", "example.org", "org", "x.org", "net.", "example.net:80", "", "ü.net", ".net", "a..net"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/en/xy/z", "/de/", "/de/1", "/fr/", "/fr/a b", "//", "/EN/"]
    tails = ["", "?q=/en/", "#t", "?a://b", "\n"]
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{h}{p}{t}" for h in hosts for p in paths for t in tails]
    urls += [None, "", "net/en/", "x:/net/", "http://example.net/en/1"] + ["http://w.example.net/en/hot"] * 300
    rows = list(enumerate(urls))
    pages = spark.createDataFrame(rows, "id long, url string").withColumn("key", F.lit("x")).withColumn("rule", F.lit(1))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r[0]: tuple(r[1:]) for r in url_rules.judge_urls(pages.repartition(7), rules).collect()}
    assert got == {i: _brute_judge(u) for i, u in rows}


def test_url_rules_without_rules_or_urls(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/")], "id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    got = [tuple(r) for r in url_rules.judge_urls(pages, none, "block").collect()]
    assert got == [(1, "a.net", "/", None, "block")] * 2
    rules = spark.createDataFrame(RULES, none.schema)
    assert url_rules.judge_urls(pages.where("id > 1"), rules).count() == 0


def test_minimum_cost_flow_moves_the_fewest_bytes():
    rng = random.Random(3)
    for _ in range(30):
        old = [rng.randint(0, 50) for _ in range(rng.randint(1, 6))]
        m = rng.randint(1, 7)
        new = [sum(old) // m + (j < sum(old) % m) for j in range(m)]
        flow = resharding.minimum_cost_flow(old, new, lambda i, j: int(i != j))
        assert [sum(f for (i, _), f in flow.items() if i == k) for k in range(len(old))] == old
        assert all(sum(f for (_, j), f in flow.items() if j == k) <= new[k] for k in range(m))
        moved = sum(f for (i, j), f in flow.items() if i != j)
        stays = sum(min(a, b) for a, b in zip(old, new))
        assert moved == sum(old) - stays
    with pytest.raises(ValueError):
        resharding.minimum_cost_flow([5], [4], lambda i, j: 0)


def test_resharding(spark, frame):
    import zlib

    rng = random.Random(6)
    rows = [(i, "é" * rng.randint(0, 300)) for i in range(900)] + [(900 + i, "hot " * 50) for i in range(500)]
    rows += [(2000, None), (2001, ""), (2002, "x" * 9000), (5, "again"), (5, "again")]
    got = resharding.reshard_documents(frame(rows).repartition(4), 5, 8).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    load = [sum(r.size for r in got if r.shard == j) for j in range(8)]
    assert max(load) - min(load) <= 0.03 * sum(load) / 8
    for j in range(8):
        assert sorted(r.slot for r in got if r.shard == j) == list(range(sum(r.shard == j for r in got)))
    assert resharding.reshard_documents(frame([]), 5, 8).count() == 0


def test_equal_texts_share_a_shard_while_they_fit(frame):
    rows = [(i, f"text {i % 40} " * 5) for i in range(800)]
    got = resharding.reshard_documents(frame(rows), 3, 4).collect()
    assert len({(r.shard, rows[r.doc_id][1]) for r in got}) == 40


def _held(layout, docs):
    """Rows of the files, with their slots checked to be gapless, and sizes by shard."""
    rows = layout.read(docs.schema).join(layout.slots().withColumnRenamed("shard", "said"), "row_key").collect()
    assert all(r.shard == r.said for r in rows)
    for j in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == j) == list(range(sum(r.shard == j for r in rows)))
    load = {}
    for r in rows:
        load[r.shard] = load.get(r.shard, 0) + len((r.text or "").encode()) + 1
    return sorted(((r.doc_id, r.text) for r in rows), key=repr), load


@pytest.mark.parametrize("old,new", [(5, 4), (3, 8), (6, 1), (1, 3)])
def test_layouts_keep_every_row(spark, frame, old, new):
    rng = random.Random(old * 10 + new)
    rows = [(i, "w" * rng.randint(0, 90) + str(i)) for i in range(400)]
    rows += [(None, "no id"), (None, "no id"), (None, None), (7, "again"), (7, "again"), (8, None), (9, "")]
    docs = frame(rows).drop("shard", "slot")
    folder = shared_folder(spark, "layout")
    layout = resharding.Layout(spark, folder)
    layout.write(docs.repartition(3), old)
    assert _held(layout, docs)[0] == sorted(rows, key=repr)
    layout.reshard(docs.schema, new)
    held, load = _held(layout, docs)
    assert held == sorted(rows, key=repr) and set(load) == set(range(new))
    assert max(load.values()) - min(load.values()) <= 0.2 * sum(load.values()) / new
    # Nothing but live files is left.
    names = resharding.list_folders(spark, folder)
    live = layout.live()
    assert sorted(n for n in names if n.startswith("live")) == [f"live={max(layout._versions('live'))}"]
    for version in set(live.values()):
        assert {int(n[6:]) for n in resharding.list_folders(spark, f"{folder}/files={version}")} == {s for s, v in live.items() if v == version}


def test_unaffected_shards_keep_their_files(spark, frame):
    """From one shard more than needed back: shards whose rows stay are neither read nor written."""
    docs = frame([(i, "t" * 50 + str(i % 7)) for i in range(64)], extra=False)
    layout = resharding.Layout(spark, shared_folder(spark, "layout"))
    layout.write(docs, 3)
    before, slots = layout.live(), {r.row_key: r.slot for r in layout.slots().collect()}
    affected = layout.reshard(docs.schema, 3)
    after = layout.live()
    assert {s for s in after if after[s] != before.get(s)} <= set(affected)
    for r in layout.slots().collect():
        if r.shard not in affected:
            assert slots[r.row_key] == r.slot


def test_a_resharding_cut_off_changes_nothing(spark, frame, monkeypatch):
    rows = [(i, f"text {i}") for i in range(200)]
    docs = frame(rows, extra=False)
    layout = resharding.Layout(spark, shared_folder(spark, "layout"))
    layout.write(docs, 5)

    def stop(*_):
        raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        m.setattr(resharding.Layout, "_commit", stop)
        with pytest.raises(RuntimeError):
            layout.reshard(docs.schema, 4)
    held, load = _held(layout, docs)
    assert held == sorted(rows, key=repr) and len(load) == 5
    layout.reshard(docs.schema, 4)  # again
    held, load = _held(layout, docs)
    assert held == sorted(rows, key=repr) and len(load) == 4


def test_layouts_of_nothing(spark, frame):
    docs = frame([], extra=False)
    layout = resharding.Layout(spark, shared_folder(spark, "layout"))
    layout.write(docs, 5)
    assert layout.reshard(docs.schema, 4) == [] and layout.read(docs.schema).count() == 0
