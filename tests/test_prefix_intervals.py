import random

import pytest

from corpuslink.functions.text import NEARBY_KEYS
from corpuslink.operators import prefix as P
from corpuslink.operators import prefix_intervals as I
from tests.conftest import rows


@pytest.fixture(scope="module")
def words():
    r = random.Random(11)
    made = ["".join(r.choices("abcé😀z", k=r.randint(1, 7))) for _ in range(900)]
    return list(dict.fromkeys([*made, "\U0010ffff", "a\U0010ffffb", "q"]))


@pytest.fixture(scope="module")
def asked(words):
    starts = {w[:n] for w in words[:200] for n in range(len(w) + 1)}
    return sorted(starts | {"zzzzzzzzzz", "~", "A", "\U0010ffff\U0010ffff"})


def tables(spark, words, asked):
    known = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, line_no int")
    return known.repartition(3), spark.createDataFrame([(a,) for a in [*asked, *asked, None]], "prefix string")


def test_intervals_and_counts(spark, words, asked):
    known, prefixes = tables(spark, words, asked)
    ordered = sorted(words, key=str.encode)
    want = {}
    for a in asked:
        inside = [i for i, w in enumerate(ordered) if w.startswith(a)]
        if inside:
            want[a] = (inside[0], inside[-1] + 1)
    index = I.number_words(known)
    assert {r.prefix: (r.low, r.high) for r in I.intervals(index, prefixes).collect()} == want
    for given in (known, index):
        placed, spans = I.words_and_spans(given, prefixes)
        assert {r.prefix: r.n_words for r in spans.collect()} == {a: b - c for a, (c, b) in want.items()}
        pairs = sorted((a, w) for a in asked for w in words if w.startswith(a))
        assert rows(I.covered(placed, spans).select("prefix", "word")) == sorted(pairs, key=repr)
        assert rows(P.completions(given, prefixes).select("prefix", "word")) == sorted(pairs, key=repr)


def test_nothing_is_repeated_for_its_prefixes(spark, words, asked):
    """The plans of lookups hold no generator over the letters of the dictionary's words."""
    known, prefixes = tables(spark, words, asked)
    for found in (P.completions(known, prefixes), P.ordered_completions(P.tree_words(known), prefixes)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "sequence(0, char_length(word" not in plan and "sequence(1, char_length(word" not in plan.split("passed")[0]


def test_a_tree_numbered_once_serves_all(spark, words, asked):
    known, prefixes = tables(spark, words, asked)
    tree = P.tree_words(known)
    assert rows(P.ordered_completions(tree, prefixes)) == rows(P.ordered_completions(known, prefixes))
    every = P.ordered_completions(tree, spark.createDataFrame([("",)], "prefix string"))
    assert sorted(r.position for r in every.collect()) == list(range(len(words)))


def test_empty_dictionary(spark, asked):
    known, prefixes = tables(spark, [], asked)
    for found in (P.completions(known, prefixes), P.ordered_completions(known, prefixes), P.decision_table(known, prefixes)):
        assert found.count() == 0
    none = prefixes.where("prefix is null")
    some = tables(spark, ["a"], asked)[0]
    assert P.completions(some, none).count() == 0 and P.ordered_completions(some, none).count() == 0


def apart(a, b):
    """Places in which two words differ, or None if some are no neighbouring keys."""
    if len(a) != len(b):
        return None
    out = [(x, y) for x, y in zip(a, b) if x != y]
    return len(out) if all(y in NEARBY_KEYS.get(x, []) for x, y in out) else None


def test_suggestions_at_two_keys(spark):
    r = random.Random(2)
    make = lambda n: list({"".join(r.choices("asdwq1Ω", k=r.randint(1, 5))) for _ in range(n)})
    known, typed = make(300), make(120) + ["", "1", "a1", "11"]
    frame = lambda ws: spark.createDataFrame([(w,) for w in ws], "word string")
    want = []
    for t in typed:
        found = sorted(w for w in set(known) if apart(t, w) in (1, 2))
        if 1 <= len(found) <= 20:
            want.append((t, found))
    got = P.keyboard_suggestions_two(frame(typed + typed), frame(known + known))
    assert rows(got) == sorted(want, key=repr) and any(len(f) > 1 for _, f in want)


def test_two_keys_hold_the_words_at_one_key(spark):
    known = spark.createDataFrame([("sad",), ("sas",), ("wad",), ("was",)], "word string")
    typed = spark.createDataFrame([("aad",)], "word string")
    one = P.keyboard_suggestions(typed, known).first().suggestions
    two = P.keyboard_suggestions_two(typed, known).first().suggestions
    assert set(one) < set(two)
