import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuslink.functions import grams as G
from corpuslink.operators import textmodel as M
from corpuslink.sources.textfiles import read_text_samples
from tests.conftest import rows


def grams(text, k):
    prev, out = text[-k:], []
    for char in text:
        out.append(prev + char)
        prev = (prev + char)[1:]
    return out


def test_fixture(spark):
    samples = spark.createDataFrame([("A", "abab"), ("B", "aabb")], "label string, text string")
    model = M.train(samples, 1, ["A", "B"])
    assert rows(model.grams.where("label = 'A'")) == [("A", "ab", 2), ("A", "ba", 2)]
    assert rows(model.contexts.where("label = 'B'")) == [("B", "a", 2), ("B", "b", 2)]
    assert rows(model.alphabet) == [("A", 2), ("B", 2)]
    texts = spark.createDataFrame([(1, "ab"), (2, ""), (3, None)], "doc_id int, text string")
    scores = {r.label: r.score for r in M.score(model, texts).collect()}
    assert math.isclose(scores["A"], math.log(0.75)) and math.isclose(scores["B"], math.log(0.5))
    assert rows(M.attribute(model, texts).select("doc_id", "best_label")) == [(1, "A")]
    assert rows(M.best_labels(M.score(model, texts)).select("doc_id", "best_label")) == [(1, "A")]
    assert rows(M.too_short(texts, 1).select("doc_id")) == [(2,), (3,)]


@pytest.mark.parametrize("most", [0, 1000])
def test_scores_shuffle_no_grams_of_a_model_that_fits(spark, monkeypatch, most):
    monkeypatch.setattr(M, "MODEL_GRAMS", most)
    samples = spark.createDataFrame([("A", "abab"), ("B", "aabbc")], "label string, text string")
    texts = spark.createDataFrame([(1, "abab"), (2, "bcd"), (2, "cab"), (3, "xyz")], "doc_id int, text string")
    found = M.score(M.train(samples, 1, ["A", "B", "C"]), texts)
    got = {(r.doc_id, r.label): r.log_prob for r in found.collect()}
    assert math.isclose(got[1, "A"], 4 * math.log(0.75)) and math.isclose(got[3, "B"], 3 * math.log(1 / 3))
    assert got[1, "C"] is None and len(got) == 9
    exchanges = re.findall(r"hashpartitioning\(doc_id#\d+, gram", found._jdf.queryExecution().executedPlan().toString())
    assert bool(exchanges) == (most == 0)


def test_tie_goes_to_the_later_label(spark):
    samples = spark.createDataFrame([("A", "abab"), ("B", "abab")], "label string, text string")
    texts = spark.createDataFrame([(1, "abba")], "doc_id int, text string")
    assert M.identify(samples, texts, 2, ["A", "B"]).first().best_label == "B"
    assert M.identify(samples, texts, 2, ["B", "A"]).first().best_label == "A"


@pytest.mark.parametrize("k", [1, 2, 4])
def test_scores_match_brute_force(spark, k):
    train = {"A": "the cat\nsat on the mat 😀 again", "B": "un été à la mer, où çà?"}
    tests = {1: "the sea", 2: "à la 😀", 3: "zzzzz", 4: "abcd"}
    samples = spark.createDataFrame(list(train.items()), "label string, text string")
    texts = spark.createDataFrame(list(tests.items()), "doc_id int, text string")
    got = {(r.doc_id, r.label): r.log_prob for r in M.score(M.train(samples, k, ["A", "B"]), texts).collect()}
    for label, text in train.items():
        seq = Counter(grams(text, k))
        ctx = Counter(g[:k] for g in grams(text, k))
        counted = {r.gram: r.n for r in M.gram_counts(samples.where(samples.label == label), k).collect()}
        assert counted == dict(seq) and sum(counted.values()) == len(text)
        for doc, probe in tests.items():
            want = sum(math.log((seq[g] + 1) / (ctx[g[:k]] + len(set(text)))) for g in grams(probe, k))
            assert math.isclose(got[doc, label], want, rel_tol=1e-9)


def test_bad_arguments(spark):
    samples = spark.createDataFrame([("A", "abab")], "label string, text string")
    for call in (lambda: M.train(samples, 0, ["A"]), lambda: M.train(samples, 1, []), lambda: M.train(samples, 1, ["A", "A"])):
        with pytest.raises(ValueError):
            call()


def test_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\r\ntwo\rthree\n")
    samples = read_text_samples(spark, {"A": str(tmp_path / "a.txt")})
    assert rows(samples) == [("A", "one\ntwo\nthree\n")]


def test_grams_do_not_depend_on_pieces_or_parts(spark, monkeypatch):

    rng = random.Random(5)
    texts = ["".join(rng.choice("abcé😀\n ") for _ in range(n)) for n in (0, 1, 2, 3, 4, 9, 40, 333)]
    table = spark.createDataFrame([("x", i, t) for i, t in enumerate(texts)], "label string, text_id int, text string")
    for k in (1, 2, 3):
        want = {}
        for t in texts:
            if len(t) >= k and t:
                ring = t[-k:] + t
                for i in range(len(t)):
                    want[ring[i : i + k + 1]] = want.get(ring[i : i + k + 1], 0) + 1
        for piece in (k, 5, 100):
            cut = table.select("label", F.explode(G.circular_pieces(F.col("text"), k, piece)).alias("piece"))
            assert {r.gram: r.n for r in M._counted(cut, k, ("label",)).collect()} == want
        parts = [
            ("x", i, n, t[at : at + 7]) for i, t in enumerate(texts) for n, at in enumerate(range(0, len(t), 7))
        ]
        table_of_parts = spark.createDataFrame(parts, "label string, text_id int, part_no int, text string")
        assert {r.gram: r.n for r in M.gram_counts_of_parts(table_of_parts, k).collect()} == want
