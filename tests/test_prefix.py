import json
import random

import pytest

from corpuslink.functions.text import NEARBY_KEYS
from corpuslink.operators import prefix as P
from corpuslink.sources.wordlist import read_word_list
from corpuslink.streaming import prefix_stream
from corpuslink.streaming.prefix_stream import decide_stream, read_typed_prefixes
from tests.conftest import rows

LINES = ["ant", "and", "an", "apple", "app", "", "an"]


def listing(words, start):
    """Brute force: words one letter longer first, then each letter's deeper words in turn."""
    letters = []
    for w in words:
        if w.startswith(start) and len(w) > len(start) and w[len(start)] not in letters:
            letters.append(w[len(start)])
    out = [start + c for c in letters if start + c in words]
    for c in letters:
        out += [w for w in listing(words, start + c) if w != start + c]
    return ([start] if start in words else []) + out


def dictionary(spark, words):
    return spark.createDataFrame(list(zip(words, range(len(words)))), "word string, line_no int")


def test_fixture(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text("\n".join("　" + line + " \t" for line in LINES))
    words = read_word_list(spark, str(path))
    assert rows(words.select("word")) == [("an",), ("and",), ("ant",), ("app",), ("apple",)]
    assert rows(read_word_list(spark, str(path), with_order=False)) == rows(words.select("word"))
    typed = spark.createDataFrame([("",), ("a",), ("an",), ("appl",), ("b",)], "prefix string")
    found = {r.prefix: r for r in P.decide(typed, words).collect()}
    assert (found[""].n, found[""].status) == (5, "list")
    assert found[""].candidates == ["an", "ant", "and", "app", "apple"]
    assert found["an"].candidates == ["an", "ant", "and"]
    assert (found["appl"].status, found["appl"].resolved_word, found["appl"].candidates) == ("accepted", "apple", None)
    assert (found["b"].n, found["b"].status) == (0, "misspelled")


def test_order_and_counts_match_brute_force(spark):
    rng = random.Random(5)
    for _ in range(3):
        words = list(dict.fromkeys("".join(rng.choices("abcé", k=rng.randint(1, 5))) for _ in range(60)))
        rng.shuffle(words)
        starts = sorted({w[:n] for w in words for n in range(len(w) + 1)} | {"zz"})
        asked = spark.createDataFrame([(s,) for s in starts], "prefix string")
        table = dictionary(spark, words)
        got = {}
        for r in P.ordered_completions(table, asked).collect():
            got.setdefault(r.prefix, {})[r.position] = r.word
            assert r.prefix + r.suffix == r.word
        for start in starts:
            want = listing(words, start)
            assert [got.get(start, {}).get(i) for i in range(len(want))] == want
            assert len(got.get(start, {})) == len(want)
        index = {r.prefix: r for r in P.prefix_index(table).collect()}
        assert index[""].n_words == len(words) and not index[""].is_word
        decisions = {r.prefix: r for r in P.decide(asked, table).collect()}
        for start in starts:
            n = sum(w.startswith(start) for w in words)
            assert decisions[start].n == n
            if 2 <= n <= 10:
                assert decisions[start].candidates == listing(words, start)
            if n > 10:
                assert decisions[start].status == "count_only" and decisions[start].candidates is None


def test_membership_messages_and_suggestions(spark):
    words = dictionary(spark, ["an", "apple", "and", "sad"])
    typed = spark.createDataFrame([("an",), ("",), ("An",)], "word string")
    assert rows(P.membership(typed, words)) == [("", False), ("An", False), ("an", True)]
    lines = spark.createDataFrame([(1, "an apple foo and an"), (2, "?"), (3, None)], "id int, text string")
    assert rows(P.accepted_messages(lines, words, ["id"])) == [(1, "an apple and an", 1), (2, "", 0), (3, "", 0)]
    wrong = spark.createDataFrame([("abd",), ("ssd",), ("Xnd",), ("",)], "word string")
    assert rows(P.keyboard_suggestions(wrong, words)) == [("abd", ["and"]), ("ssd", ["sad"])]


def test_long_suggestion_lists_are_not_shown(spark):
    variants = P.keyboard_variants(spark.createDataFrame([("ssssss",)], "word string"))
    words = variants.selectExpr("suggestion AS word", "1 AS line_no")
    assert variants.count() == 30
    assert P.keyboard_suggestions(spark.createDataFrame([("ssssss",)], "word string"), words).count() == 0


def test_stream(spark, tmp_path):
    source = tmp_path / "typed"
    source.mkdir()
    (source / "a.json").write_text("\n".join(json.dumps({"prefix": p}) for p in ["an", "b", "an"]))
    decisions = P.decision_table(dictionary(spark, ["ant", "and", "an"])).cache()
    query = (
        decide_stream(read_typed_prefixes(spark, str(source)), decisions)
        .writeStream.format("memory").queryName("decided").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(60)
    got = [(r.prefix, r.n, r.status) for r in spark.table("decided").collect()]
    assert sorted(got) == [("an", 3, "list"), ("an", 3, "list"), ("b", 0, "misspelled")]


def test_stream_over_a_file_and_over_a_folder(spark, tmp_path):
    table = spark.createDataFrame([(i, f"word{i}") for i in range(40)], "item_id bigint, text string")
    table.repartition(4).write.parquet(str(tmp_path / "folder" / "t.parquet"))
    (tmp_path / "file").mkdir()
    table.coalesce(1).write.parquet(str(tmp_path / "one"))
    (part,) = (tmp_path / "one").glob("part-*.parquet")
    part.rename(tmp_path / "file" / "t.parquet")
    want = sorted(map(tuple, table.collect()))
    for layout in ("file", "folder"):
        stream = prefix_stream.stream_table(spark, str(tmp_path / layout / "t.parquet"))
        again = str(tmp_path / "runs" / layout)
        for _ in range(2):  # the second run has nothing left to do
            assert sorted(map(tuple, prefix_stream.run_available(stream, again).collect())) == want
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        prefix_stream.stream_table(spark, str(tmp_path / "none.parquet"))


def test_two_keys_away_without_a_broadcast(spark):
    rng = random.Random(5)
    vocabulary = sorted({"".join(rng.choice("asdqwe1") for _ in range(rng.randint(1, 4))) for _ in range(150)})
    typed = vocabulary[::3]
    near = lambda a, b: b in NEARBY_KEYS.get(a, [])
    expected = {}
    for w in typed:
        hits = []
        for v in vocabulary:
            changed = [(a, b) for a, b in zip(w, v) if a != b]
            if len(w) == len(v) and 1 <= len(changed) <= 2 and all(near(a, b) for a, b in changed):
                hits.append(v)
        if 1 <= len(hits) <= P.MAX_SUGGESTED:
            expected[w] = hits
    as_words = lambda values: spark.createDataFrame([(v,) for v in values], "word string")
    found = P.keyboard_suggestions_two(as_words(typed), as_words(vocabulary))
    assert {r.word: r.suggestions for r in found.collect()} == expected and expected
    # The keys of a small table need not be small: no side may be gathered on the driver.
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
