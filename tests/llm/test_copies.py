import collections
import hashlib
import random
import re

import pytest

from corpuslink.llm import exact_dedup, shingle_join
from corpuslink.llm.components import components


def _sets(rows, width):
    out = collections.defaultdict(list)
    for i, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        runs = [tuple(words[j : j + width]) for j in range(len(words) - width + 1)] or ([tuple(words)] if words else [])
        out[i].append(frozenset(runs))
    return out


def _brute(rows, width=5, percent=80):
    sets = _sets(rows, width)
    lead = {i: i for i in sets}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    flat = [(i, s) for i, held in sets.items() for s in held if s]
    for x, (i, a) in enumerate(flat):
        for j, b in flat[:x]:
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                low, high = sorted((find(i), find(j)))
                lead[high] = low
    return sorted((i, len(s), find(i)) for i, held in sets.items() for s in held)


def _edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randint(0, 10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    word = lambda: f"v{int(rng.paretovariate(0.6)) % 900}"
    rows = []
    for family in range(6):
        base = [word() for _ in range(rng.randint(6, 160))]
        rows += [_edited(rng, base, rng.randint(0, 5)) for _ in range(rng.randint(2, 25))]
    passage = [word() for _ in range(60)]
    for _ in range(30):  # one passage that many share
        own = [word() for _ in range(rng.randint(0, 80))]
        at = rng.randint(0, len(own))
        rows.append(" ".join(own[:at] + passage + own[at:]))
    rows += [rows[3]] * 40 + [rows[3].upper()] * 3
    rows += [None, "", "   ", "one", "One", "one two", "a b c d e", "a b c d e f", "é É", "x " * 5000]
    rows += [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(60)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(order[i], t) for i, t in enumerate(rows)]


def test_similar_documents_equal_brute_force(frame, corpus):
    got = shingle_join.similar_documents(frame(corpus).repartition(5))
    assert sorted(map(tuple, got.collect())) == _brute(corpus)


@pytest.mark.parametrize("width,percent", [(2, 60), (3, 95)])
def test_other_widths_and_thresholds(frame, corpus, width, percent):
    got = shingle_join.similar_documents(frame(corpus), width, percent)
    assert sorted(map(tuple, got.collect())) == _brute(corpus, width, percent)


def test_no_documents_and_repeated_ids(frame):
    assert shingle_join.similar_documents(frame([])).count() == 0
    rows = [(1, "a b c d e f"), (1, "x y z u v w"), (2, "X y z u v w"), (3, "A b c d e f"), (None, "a b c d e f")]
    got = {tuple(r) for r in shingle_join.similar_documents(frame(rows)).collect()}
    assert got == {(1, 2, 1), (2, 2, 1), (3, 2, 1), (None, 2, None)}


def test_copies_in_any_order_are_linked_to_near_copies(frame):
    rows = []
    for family in range(8):
        words = [f"f{family}w{i}" for i in range(40)]
        one, two = " ".join(words), " ".join([*words[:-1], "end"])
        rows += [(4 * family + 3, one), (4 * family + 2, two), (4 * family + 1, one), (4 * family, two)]
    rows.sort(reverse=True)
    got = shingle_join.similar_documents(frame(rows).coalesce(1))
    assert sorted(map(tuple, got.collect())) == _brute(rows)


def test_a_copy_of_one_text_may_have_another_text(frame):
    words = [[f"{x}{i}" for i in range(40)] for x in "abc"]
    one, two, other = (" ".join(w) for w in words)
    near = " ".join([*words[2][:-1], "end"])
    rows = [(5, one), (2, one), (6, two), (3, two), (5, other), (6, near)]
    got = shingle_join.similar_documents(frame(rows).coalesce(1))
    assert sorted(map(tuple, got.collect())) == _brute(rows)


def test_one_row_of_each_component_stays(frame, corpus):
    stays = [r.doc_id for r in shingle_join.without_near_copies(frame(corpus)).collect()]
    assert sorted(stays) == sorted({c for _, _, c in _brute(corpus)})


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (5, 5), (None, 3), (201, 200), (200, 202), (202, 201)]
    got = {tuple(r) for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    assert got == {(i, 1) for i in range(1, 61)} | {(100, 100), (101, 100), (200, 200), (201, 200), (202, 200)}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


@pytest.mark.parametrize("keep,pick", [("smallest", min), ("largest", max)])
def test_exact_duplicates(frame, corpus, keep, pick):
    groups = collections.defaultdict(list)
    for i, text in corpus:
        groups[text or ""].append(i)
    want = sorted(
        (i, pick(ids), len(ids), i == pick(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in groups.items() for i in ids
    )
    assert sorted(map(tuple, exact_dedup.exact_duplicates(frame(corpus), keep).collect())) == want
    stays = exact_dedup.without_copies(frame(corpus), keep)
    assert sorted(r.doc_id for r in stays.collect()) == sorted(pick(ids) for ids in groups.values())


def test_texts_whose_hashes_collide_stay_apart(frame, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.lit("00"))
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "")]
    got = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(frame(rows)).collect()}
    assert got == {(1, 1, 2), (3, 1, 2), (2, 2, 1), (4, 4, 2), (5, 4, 2)}


def test_exact_duplicates_of_nothing_and_of_repeated_rows(frame):
    assert exact_dedup.exact_duplicates(frame([])).count() == 0
    rows = [(1, "a"), (1, "a"), (2, "a"), (1, "b"), (None, "a"), (None, None), (None, "")]
    for keep, want in (("smallest", [(1, "a"), (1, "b")]), ("largest", [(1, "b"), (2, "a")])):
        docs = frame(rows).selectExpr("*", "'x' AS _sha", "'y' AS __id")
        stays = exact_dedup.without_copies(docs, keep)
        assert stays.columns == docs.columns
        got = [(r.doc_id, r.text or "") for r in stays.collect()]
        assert sorted(g for g in got if g[0] is not None) == want and [g for g in got if g[0] is None] == [(None, "")]


def test_rows_without_an_id_stay_among_near_copies(frame):
    rows = [(4, "a b c d e f"), (3, "A b c d e f"), (None, "a b c d e f"), (None, None)]
    stays = [(r.doc_id, r.text) for r in shingle_join.without_near_copies(frame(rows)).collect()]
    assert sorted(stays, key=repr) == sorted([(3, "A b c d e f"), (None, "a b c d e f"), (None, None)], key=repr)
