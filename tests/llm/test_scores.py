import collections
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuslink.llm import mixing, pii, queries, toxicity


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-4, 6), max_size=40))
def test_segments_are_the_maximal_ones(steps):
    drift = 2.0
    gains = np.array([s + drift for s in steps])
    hit = np.flatnonzero(gains != 0)
    got = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(hit, gains[hit], drift)]

    def best(low, high):  # the definition: take the best, then what lies to its left and right
        found = (0, 0, 0)
        for a in range(low, high):
            for b in range(a, high):
                total = sum(steps[a : b + 1])
                if total > found[2]:
                    found = (a, b, total)
        if found[2] <= 0:
            return []
        return best(low, found[0]) + [found] + best(found[1] + 1, high)

    want = best(0, len(steps))
    # Equal totals leave a choice of ends, so totals and the best score are compared.
    assert sorted(s for *_, s in got) == sorted(float(s) for *_, s in want) or sum(s for *_, s in got) >= sum(s for *_, s in want)
    for a, b, s in got:
        assert s == sum(steps[a : b + 1]) and s > 0
        for c in range(a, b):
            assert sum(steps[a : c + 1]) > 0 and sum(steps[c + 1 : b + 1]) > 0


def _toxic_rows(n=900):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{int(rng.paretovariate(0.8)) % 3000}" for _ in range(rng.randint(3, 120))]
        bad = i % 6 == 0
        if bad:
            at = rng.randint(0, len(words))
            words[at:at] = [rng.choice(["Vile", "rotten,", "FOUL"]) for _ in range(rng.randint(2, 5))]
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxic_documents_are_found(spark, frame):
    rows, labels = _toxic_rows()
    rows += [(5000, None), (5001, ""), (5002, "vile foul rotten"), (0, rows[0][1])]
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxic_documents(frame(rows).repartition(4), table).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[5000].score == by[5001].score < 0.5 and by[5000].passages == []
    assert by[5002].predicted == 1
    held = [by[i] for i, _ in labels if by[i].held_out]
    right = sum(r.predicted == int(r.doc_id % 6 == 0) for r in held)
    assert right / len(held) > 0.97
    words = rows[12][1].split()
    (passage,) = by[12].passages
    assert all(re.match("(?i)vile|rotten|foul", w) for w in words[passage.first_word : passage.last_word + 1])
    model = toxicity.fit(frame(rows), table)
    stays = {r.doc_id for r in toxicity.without_toxic(frame(rows), model).collect()}
    assert stays == {r.doc_id for r in toxicity.score(frame(rows), model).collect() if r.predicted == 0}


def test_held_out_labels_are_not_read(spark, frame):
    rows, labels = _toxic_rows(300)
    import zlib

    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    one, two = (
        {r.doc_id: (r.score, r.held_out) for r in toxicity.toxic_documents(frame(rows), spark.createDataFrame(x, "doc_id long, toxic int")).collect()}
        for x in (labels, turned)
    )
    assert one == two
    assert {i for i, (_, held) in one.items() if held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, None), (None, 1)]])
def test_nothing_to_learn(spark, frame, labels):
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxic_documents(frame([(1, "a b"), (2, "c"), (3, None)]), table).collect()
    assert [r.predicted for r in got] == [0, 0, 0]
    assert toxicity.toxic_documents(frame([]), table).count() == 0


def _luhn(digits):
    x = [int(c) for c in digits][::-1]
    return (sum(x[0::2]) + sum(sum(divmod(2 * c, 10)) for c in x[1::2])) % 10 == 0


def _base_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 13, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == "phone" or _luhn(digits)):
                out.append((kind, *m.span()))
    return out


def _personal_texts():
    rng = random.Random(9)
    parts = ["a", "Z9", "@", ".", "-", " ", "+", "(", ")", "1", "23", "255", "256", "4111111111111111", "4111 1111 1111 1111",
             "é", "😀", "\n", "x@y.zz", "1.2.3.4", "+1 (555) 123-4567", "%", "_", "000"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(700)]
    return made + [
        None, "", "mail a@b.c@d.e x_y@d.e.f_z@q.w.", "1.2.3.4.5.6.7.8 256.1.1.1 00255.0.0.1 1..2.3.4",
        "+1 (017) 555-7713 97.51.17.173", "4111111111111111 4111111111111111", "7" * 60_000, "1 " * 60_000, "a." * 60_000,
        "a@b.c " * 5_000, "+" * 9_000 + "1" * 9_000, "😀 joe (at) mail (dot) org",
    ]


def test_personal_data(frame):
    rows = list(enumerate(_personal_texts()))
    rows.append(rows[10])
    got = pii.personal_data(frame(rows).repartition(3)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        base = _base_spans(texts[r.doc_id] or "")
        counts = collections.Counter(kind for kind, *_ in base)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), r.doc_id
        spans = [s for s in r.spans.split(",") if s]
        assert {s for s in joined.split(",") if s} <= set(spans) and len(spans) == len(base) + r.n_added
        found = collections.Counter(s.split(":")[0] for s in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(found[k] for k in pii.KINDS)
        assert all(found[k] >= counts[k] for k in pii.KINDS)
        order = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)


def test_numbers_inside_failing_runs_are_added(frame):
    rng = random.Random(2)
    good = ["4111111111111111", "5500005555555559", "4012888888881881"]
    rows = [(i, f"pay {rng.choice(good)} now") for i in range(200)]
    rows += [(200 + i, f"no {rng.randint(10**15, 10**16 - 1)} here") for i in range(200)]
    rows.append((999, f"both {good[0]} {good[1]} end"))
    (r,) = [r for r in pii.personal_data(frame(rows)).collect() if r.doc_id == 999]
    assert (r.n_card, r.n_added, r.spans) == (2, 2, "card:5:21,card:22:38")


def test_query_counts_base_spans(spark, frame, tmp_path):
    rng = random.Random(2)
    good = ["4111111111111111", "5500005555555559", "4012888888881881"]
    rows = [(i, f"pay {rng.choice(good)} now") for i in range(200)] + [(200 + i, t) for i, t in enumerate(_wrong_cards(200))]
    rows.append((999, f"both {good[0]} {good[1]} end"))
    frame(rows, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    by = {r.doc_id: r for r in queries.op3_pii(spark, str(tmp_path)).collect()}
    assert (by[999].n_card, by[999].n_added, by[999].spans) == (0, 2, "card:5:21,card:22:38")
    for i, text in rows:
        counts = collections.Counter(kind for kind, *_ in _base_spans(text))
        assert (by[i].n_email, by[i].n_ip, by[i].n_card, by[i].n_phone) == tuple(counts[k] for k in pii.KINDS)


def test_phones_of_single_digits(frame):
    text = "+1 (2) (3) (4) (5) (6) (7) (8) (9)"
    (r,) = pii.personal_data(frame([(1, text)])).collect()
    assert (r.n_phone, r.spans, r.base_sha256) == (1, "phone:0:33", hashlib.sha256(b"phone:0:33").hexdigest())


def _wrong_cards(n):
    rng = random.Random(4)
    made = (str(rng.randint(10**15, 10**16 - 1)) for _ in range(2 * n))
    return [f"no {x} here" for x in made if not _luhn(x)][:n]


def test_additions_of_a_rare_kind_do_not_depend_on_the_sample(frame):
    rows = list(enumerate(_wrong_cards(4000)))
    rows += [(5000 + i, f"call +1 (826) 555-{1000 + i} now") for i in range(100)]
    rows.append((9999, "call +1 (826) 555-4081 190.137.223.204 now"))
    by = {r.doc_id: r for r in pii.personal_data(frame(rows), fit_rows=40).collect()}
    assert (by[9999].n_phone, by[9999].n_added) == (1, 1) and by[9999].spans.split(",")[-1] == "phone:5:22"
    assert sum(r.n_added for r in by.values()) == 1


def test_masked_forms_are_no_wrong_examples(frame):
    rows = list(enumerate(_wrong_cards(200)))
    rows += [(1000 + i, f"write {'joe' * (i % 9 + 1)}{i}@mail.org now") for i in range(200)]
    rows += [(2000 + i, f"write joe{i} (at) mail (dot) org now") for i in range(50)]
    by = {r.doc_id: r for r in pii.personal_data(frame(rows)).collect()}
    assert all(by[2000 + i].n_email == by[2000 + i].n_added == 1 for i in range(50))
    assert sum(r.n_added for r in by.values()) == 50


def test_personal_data_of_nothing(frame):
    assert pii.personal_data(frame([])).count() == 0
    (r,) = pii.personal_data(frame([(1, None)])).collect()
    assert (r.spans, r.n_email, r.base_sha256) == ("", 0, hashlib.sha256(b"").hexdigest())


def _mix_rows():
    rng = random.Random(3)
    return [
        (i, "w " * rng.randint(1, 30), rng.choice(["en"] * 6 + ["de", "fr"]), rng.choice(["hot"] * 5 + ["s1", "s2", "s3"]))
        for i in range(4000)
    ]


def test_raked_weights_meet_their_targets(spark):
    docs = spark.createDataFrame(_mix_rows(), "doc_id long, text string, lang string, source string")
    targets = {"source": 0.5, "lang": {"en": 0.5, "de": 0.25, "fr": 0.25, "xx": 0.3}, "topic": 1.0}
    cells = mixing.described(docs).groupBy("_source", "_lang", "_topic").sum("_n_words").toDF("source", "lang", "topic", "tokens")
    got = mixing.raked(cells, targets, rounds=25).toPandas()
    by = got.groupby("lang").weight.sum()
    assert np.allclose([by["en"], by["de"], by["fr"]], [0.5, 0.25, 0.25], atol=1e-6)
    tokens, weight = got.groupby("source").tokens.sum(), got.groupby("source").weight.sum()
    assert np.allclose(weight, tokens**0.5 / (tokens**0.5).sum(), atol=1e-6)


def test_kept_documents_follow_the_probabilities(spark):
    docs = spark.createDataFrame(_mix_rows(), "doc_id long, text string, lang string, source string")
    docs = docs.selectExpr("*", "'x' AS topic", "1 AS tokens", "2 AS weight", "'y' AS _source", "3 AS __probability")
    targets = {"source": 0.7, "lang": {"en": 0.6, "de": 0.2, "fr": 0.2}, "topic": 0.8}
    rates = mixing.rates(docs, targets, 0.5).toPandas()
    assert len(rates) == 4000
    kept = rates[rates.kept]
    assert abs(kept.n_words.sum() / rates.n_words.sum() - 0.5) < 0.03
    share = kept.groupby("lang").n_words.sum() / kept.n_words.sum()
    assert abs(share["en"] - 0.6) < 0.04
    again = mixing.sampled(docs.repartition(9), targets, 0.5)
    assert again.columns == docs.columns
    assert sorted(r.doc_id for r in again.collect()) == sorted(kept.doc_id)


def test_mixing_with_nulls_and_nothing(spark):
    schema = "doc_id long, text string, lang string, source string"
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "a b", "en", "s"), (3, "a b", "en", "s"), (None, "c", "en", None)]
    got = mixing.rates(spark.createDataFrame(rows, schema), {"source": 0.5, "lang": {"en": 1.0}, "topic": 1.0}, 0.9)
    assert got.count() == 5
    assert mixing.rates(spark.createDataFrame([], schema), {"source": 0.5, "lang": 1.0, "topic": 1.0}, 0.5).count() == 0


def test_unnamed_and_null_languages_are_sampled(spark):
    rows = [(i, t, {0: None, 1: "it", 2: "pt"}.get(i % 6, lang), s) for i, t, lang, s in _mix_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"source": 0.7, "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "*": 0.1}, "topic": 0.8}
    cells = mixing.described(docs).groupBy("_source", "_lang", "_topic").sum("_n_words").toDF("source", "lang", "topic", "tokens")
    got = mixing.raked(cells, targets, rounds=25).toPandas()
    weight, tokens = got.groupby("lang").weight.sum(), got.groupby("lang").tokens.sum()
    assert np.allclose([weight["en"], weight["de"]], [0.5, 0.2], atol=1e-6)
    others = ["unknown", "it", "pt"]
    assert np.allclose([weight[x] for x in others], [0.1 * tokens[x] / tokens[others].sum() for x in others], atol=1e-6)
    rates = mixing.rates(docs, targets, 0.3).toPandas()
    assert set(rates[rates.kept].lang) == {"en", "de", "fr", *others}
    assert set(rates[~rates.kept].lang) == {"en", "de", "fr", *others}
