import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslink.llm import hard_negatives as hn

SCHEMA = "vec_id long, lab int, emb array<double>, a string, place string, g string, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, y, v, "x", "x", "x", "x") for i, y, v in rows], SCHEMA)


def prepared(spark, rows, scale=8):
    return hn.labelled_vectors(table(spark, rows), "vec_id", "emb", F.col("lab"), scale)


def brute(rows, scale=8, n_pos=5, n_neg=5, percent=80, anchor=lambda i: i % 10 == 0):
    usable = []
    for i, y, v in rows:
        if i is None or y is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        usable.append((i, y, [int(np.floor(scale * x)) for x in v]))
    width = max((len(v) for _, _, v in usable), default=0)
    usable = [(i, y, v + [0] * (width - len(v))) for i, y, v in usable]
    out = []
    for i, y, v in usable:
        if not anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in usable if j != i]
        for p, j, _ in sorted(s for s in scored if s[2] == y)[:n_pos]:
            fit = sorted((s, m) for s, m, z in scored if z != y and 100 * -s >= percent * -p and -s <= -p)
            out += [(i, j, r + 1, m, -p, -s) for r, (s, m) in enumerate(fit[:n_neg])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def vectors(n, seed, labels=3, ids=None):
    random = np.random.default_rng(seed)
    ids = range(n) if ids is None else ids
    # Few distinct values, so scores tie often.
    return [(int(i), int(random.integers(labels)), (random.integers(-3, 6, 4) / 4).tolist()) for i in ids]


@pytest.mark.parametrize("group_rows,wide_rows", [(1 << 16, 4096), (7, 3), (25, 10)])
def test_equals_brute_force(spark, group_rows, wide_rows):
    rows = vectors(90, 1)
    got = hn.hard_negatives(prepared(spark, rows), F.col("vec_id") % 10 == 0, group_rows=group_rows, wide_rows=wide_rows)
    assert found(got) == brute(rows) != []


def test_rows_that_take_no_part(spark):
    rows = vectors(40, 2) + [
        (100, None, [1.0, 1.0, 1.0, 1.0]),
        (110, 1, None),
        (120, 1, []),
        (130, 1, [1.0, None, 1.0, 1.0]),
        (140, 1, [1.0, float("nan"), 1.0, 1.0]),
        (150, 1, [1.0, float("-inf"), 1.0, 1.0]),
        (None, 1, [1.0, 1.0, 1.0, 1.0]),
        (160, 1, [1.0, 1.0]),  # filled up with zeros
    ]
    assert found(hn.hard_negatives(prepared(spark, rows), F.col("vec_id") % 10 == 0)) == brute(rows)


def test_repeated_rows_each_count(spark):
    rows = vectors(30, 3) + vectors(30, 3)[5:9] * 6
    got = hn.hard_negatives(prepared(spark, rows), F.col("vec_id") % 10 == 0, group_rows=16)
    assert found(got) == brute(rows)


def test_one_label_holds_most_rows(spark):
    rows = [(i, 0 if i % 9 else 1, v) for i, _, v in vectors(120, 4)]
    got = hn.hard_negatives(prepared(spark, rows), F.col("vec_id") % 10 == 0, group_rows=20)
    assert found(got) == brute(rows) != []


def test_other_numbers_of_rows_and_share(spark):
    rows = vectors(60, 5)
    got = hn.hard_negatives(prepared(spark, rows), F.col("vec_id") % 10 == 0, n_positives=2, n_negatives=7, percent=50)
    assert found(got) == brute(rows, n_pos=2, n_neg=7, percent=50)


@pytest.mark.parametrize("rows", [[], [(10, 1, [1.0])], [(1, 1, [1.0]), (2, 2, [1.0])], [(10, 1, [1.0]), (2, 2, [1.0])]])
def test_nothing_to_find(spark, rows):
    assert found(hn.hard_negatives(prepared(spark, rows), F.col("vec_id") % 10 == 0)) == []


def test_fields_of_eight_bytes(spark):
    rows = vectors(60, 6)
    got = hn.hard_negatives(prepared(spark, rows, scale=100_000), F.col("vec_id") % 10 == 0, wide_rows=11)
    assert found(got) == brute(rows, scale=100_000)


def test_scores_beyond_63_bits_are_refused(spark):
    with pytest.raises(ValueError):
        hn.hard_negatives(prepared(spark, [(10, 1, [1e30]), (2, 1, [1.0])]), F.col("vec_id") % 10 == 0)


def test_fields_hold_the_largest_and_smallest_sums():
    for low, high in ((-5, 7), (0, 3), (-9, 0), (-(1 << 14), 1 << 14), (-(1 << 26), 1 << 26)):
        v = np.array([[low] * 6, [high] * 6, [low, high] * 3, [0] * 6], np.int64)
        packed = hn.Packed(np.arange(4), v, low, high, wide_rows=3)
        for a in v:
            assert packed.scores(a).tolist() == (v @ a).tolist()
