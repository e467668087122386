import random

import pytest
from pyspark.sql import functions as F

from corpuslink.operators import postings as P
from corpuslink.operators import prefix_intervals as intervals
from corpuslink.operators.ordering import numbered, rank_among
from tests.conftest import rows


def index_of(spark, pairs):
    return spark.createDataFrame(pairs, "word string, course_id long, first_id long, n string").drop("first_id", "n")


def table(spark, pairs):
    return index_of(spark, [(w, i, 0, "x") for w, i in pairs])


def brute(pairs, terms):
    held = {}
    for w, i in pairs:
        held.setdefault(w, set()).add(i)
    return sorted((i,) for i in set.intersection(*[held.get(t, set()) for t in set(terms)]))


@pytest.fixture(scope="module")
def pairs():
    r = random.Random(4)
    out = [(r.choice("abcdef"), r.randrange(-50, 400)) for _ in range(1500)]
    out += [("everywhere", i) for i in range(-60, 1000)] + [("rare", 3), ("rare", 3), ("rare", 999), ("far", 10**15)]
    return out


@pytest.mark.parametrize("size", [1, 7, 256])
def test_chunks_hold_the_index(spark, pairs, size):
    chunks = P.posting_chunks(table(spark, pairs), size=size)
    held = chunks.collect()
    assert rows(P.unnested(chunks).select("word", "course_id")) == sorted(pairs, key=repr)
    by_word = {}
    for r in held:
        ids = [r.first_id + d for d in r.deltas]
        assert ids == sorted(ids) and r.n == len(ids) <= size and (r.first_id, r.last_id) == (ids[0], ids[-1])
        by_word.setdefault(r.word, []).append(r)
    for chunked in by_word.values():
        chunked.sort(key=lambda r: r.chunk_no)
        assert [r.chunk_no for r in chunked] == list(range(len(chunked)))
        assert all(a.last_id <= b.first_id for a, b in zip(chunked, chunked[1:]))


@pytest.mark.parametrize("size", [3, 64])
def test_all_terms(spark, pairs, size):
    chunks = P.posting_chunks(table(spark, pairs), size=size).cache()
    for terms in (["a"], ["a", "b"], ["everywhere", "a", "a", "c"], ["rare", "everywhere"], list("abcdef"), ["far", "a"], ["a", "none"], ["rare"]):
        assert rows(P.holding_all(chunks, terms)) == sorted(brute(pairs, terms), key=repr)
    with pytest.raises(ValueError):
        P.holding_all(chunks, [])


def test_chunks_that_do_not_overlap_never_meet(spark):
    pairs = [("one", i) for i in range(2000)] + [("two", i) for i in range(1990, 2200)]
    chunks = P.posting_chunks(table(spark, pairs), size=10)
    met = P._common(P._ids(chunks.where("word = 'one'")), P._ids(chunks.where("word = 'two'")), 0, 10)
    assert sorted(i for r in met.collect() for i in r.ids) == list(range(1990, 2000))
    assert met.count() <= 3


def test_empty_rows_and_tables(spark):
    chunks = P.posting_chunks(table(spark, [(None, 1), ("a", None), ("a", 2)]))
    assert rows(P.unnested(chunks)) == [(2, "a")]
    empty = P.posting_chunks(table(spark, []))
    assert empty.count() == 0 and P.holding_all(empty, ["a"]).count() == 0


def test_numbers_and_ranks(spark):
    r = random.Random(7)
    words = list({"".join(r.choices("aé😀z", k=r.randint(0, 6))) for _ in range(300)})
    got = numbered(spark.createDataFrame([(w,) for w in words], "word string").repartition(5), "word")
    assert [x.word for x in got.orderBy("pos").collect()] == sorted(words, key=str.encode)
    assert [x.pos for x in got.orderBy("pos").collect()] == list(range(len(words)))
    bounds = ["", "a", "é", "zz", "😀😀", "zzzzzzzzz"]
    asked = spark.createDataFrame([(b,) for b in bounds], "b string").select(F.col("b").cast("binary").alias("bound"))
    keys = got.select(F.col("word").cast("binary").alias("key"))
    ranks = {bytes(x.bound).decode(): x["rank"] for x in rank_among(asked, keys).collect()}
    assert ranks == {b: sum(w.encode() <= b.encode() for w in words) for b in bounds}


def test_numbers_over_several_partitions(spark):
    """The runtime merges small partitions; here it may not."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        r = random.Random(3)
        words = sorted({"".join(r.choices("abcd", k=r.randint(1, 6))) for _ in range(400)})
        frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(3)
        got = numbered(frame, "word")
        assert [(x.pos, x.word) for x in got.orderBy("pos").collect()] == list(enumerate(words))
        asked = spark.createDataFrame([(p,) for p in ("", "a", "b", "ca", "dd", "e")], "prefix string")
        index = intervals.number_words(frame)
        want = {p: sum(w.startswith(p) for w in words) for p in ("", "a", "b", "ca", "dd")}
        for given in (frame, index):
            placed, spans = intervals.words_and_spans(given, asked)
            assert {x.prefix: x.n_words for x in spans.collect()} == want
            assert intervals.covered(placed, spans).count() == sum(want.values())
    finally:
        spark.conf.unset(key)
