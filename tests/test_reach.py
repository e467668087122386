import math
import random

import pytest
from pyspark.sql import functions as F

from corpuslink.operators import search as S


def minutes(a, b):
    (lon1, lat1), (lon2, lat2) = [tuple(map(math.radians, p)) for p in (a, b)]
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * math.asin(math.sqrt(min(1.0, h))) * 6367 * 1000 / (1.1 * 60)


def points(seed):
    r = random.Random(seed)
    out = [(f"c{i}", -87.6 + r.gauss(0, 0.02), 41.8 + r.gauss(0, 0.02)) for i in range(60)]
    out += [(f"p{i}", r.uniform(-180, 180), 90 - abs(r.gauss(0, 0.05))) for i in range(25)]  # round the pole
    out += [(f"s{i}", r.uniform(-180, 180), -90 + abs(r.gauss(0, 3))) for i in range(25)]
    out += [(f"d{i}", r.choice([-180, 180]) + r.gauss(0, 0.03), r.gauss(0, 0.02)) for i in range(40)]  # date line
    out += [(f"w{i}", r.uniform(-180, 180), r.uniform(-90, 90)) for i in range(30)]
    return out + [("n", 0.0, 90.0), ("z", 0.0, -90.0), ("c0", -87.6, 41.8), ("same", -87.6, 41.8), ("east", 180.0, 0.0), ("west", -180.0, 0.0)]


@pytest.mark.parametrize("limit", [0, 1, 20, 400, 10_000, 100_000, 400_000])
def test_all_pairs_within_reach(spark, limit):
    given = points(limit)
    gps = spark.createDataFrame([*given, ("null", None, 1.0), ("none", 1.0, None)], "building_code string, lon double, lat double")
    got = sorted((r.from_building, r.to_building, round(r.walking_time, 4)) for r in S.buildings_within_reach(gps, limit).collect())
    sure, maybe = [], []
    for a in given:
        for b in given:
            if a[0] != b[0]:
                m = minutes(a[1:], b[1:])
                row = (a[0], b[0], round(m, 4))
                if m <= limit - 1e-6 or m == 0:
                    sure.append(row)
                elif m <= limit + 1e-6:
                    maybe.append(row)
    if limit < 300_000:  # nearly opposite points: the formula itself loses digits there
        assert [r for r in got if r not in maybe] == sorted(sure)
    else:
        assert len(got) >= len(sure)
    with pytest.raises(ValueError):
        S.buildings_within_reach(gps, -1)


def test_no_nested_loop_and_other_side(spark):
    gps = spark.createDataFrame([(f"b{i}", -87.6 + 0.001 * i, 41.8) for i in range(30)], "building_code string, lon double, lat double")
    found = S.buildings_within_reach(gps, 5, gps.where("building_code = 'b3'"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r.to_building for r in found.collect()} == {"b3"}
    assert {r.from_building for r in found.collect()} == {"b0", "b1", "b2", "b4", "b5", "b6"}


@pytest.mark.parametrize("most", [3, 2048])
def test_a_dense_cell_is_compared_in_squares(spark, monkeypatch, most):
    monkeypatch.setattr(S, "REACH_ROWS", most)
    r = random.Random(8)
    given = [(f"b{i}", -87.6 + r.gauss(0, 0.0005), 41.8 + r.gauss(0, 0.0005)) for i in range(70)]
    gps = spark.createDataFrame(given, "building_code string, lon double, lat double").repartition(3)
    found = S.buildings_within_reach(gps, 1)
    got = sorted((r.from_building, r.to_building) for r in found.collect())
    assert got == sorted((a[0], b[0]) for a in given for b in given if a[0] != b[0] and minutes(a[1:], b[1:]) <= 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    assert found.groupBy(F.spark_partition_id()).count().count() > 4
