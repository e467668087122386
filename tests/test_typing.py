import random

import pytest

from corpuslink.operators.prefix import accepted_messages
from corpuslink.streaming import typing as T

WORDS = ["an", "apple", "and", "sad", "x1"]
TURNS = [
    (1, "an apple foo and an"), (2, "?"), (3, None), (4, ""), (5, "sad"), (6, "x1 x2 an\nand\tsad--apple 9an an9"), (7, "foo bar  "),
    (8, "An AN an" * 20),
]


def pieces(turns, size):
    out = []
    for i, text in turns:
        whole = (text or "") + "\n"
        out += [(i, n, whole[a : a + size]) for n, a in enumerate(range(0, len(whole), size))]
    return out


def run(spark, tmp_path, batches, folder):
    source = tmp_path / "in"
    source.mkdir(exist_ok=True)
    for k, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "session int, seq int, chars string")
        frame.coalesce(1).write.mode("overwrite").json(str(source / f"b{k:03d}"))
    stream = spark.readStream.schema("session int, seq int, chars string").option("maxFilesPerTrigger", 1)
    stream = stream.option("recursiveFileLookup", True).json(str(source))
    known = spark.createDataFrame([(w,) for w in WORDS], "word string")
    found = T.typed_messages(stream, known, ["session"], str(tmp_path / folder))
    return sorted((r.session, r.message, r.n_unknown) for r in found.collect())


@pytest.fixture
def want(spark):
    lines = spark.createDataFrame(TURNS, "session int, text string")
    known = spark.createDataFrame([(w,) for w in WORDS], "word string")
    return sorted(tuple(r) for r in accepted_messages(lines, known, ["session"]).collect())


def test_one_batch(spark, tmp_path, want):
    assert run(spark, tmp_path, [pieces(TURNS, 1000)], "a") == want


def test_several_batches_in_any_order_with_repeats_and_a_restart(spark, tmp_path, want):
    r = random.Random(1)
    given = pieces(TURNS, 3)
    given += r.sample(given, 20)
    r.shuffle(given)
    batches = [given[i::4] for i in range(4)]
    run(spark, tmp_path, batches[:2], "b")  # stops half-way
    assert run(spark, tmp_path, batches, "b") == want  # goes on in the same folder
    assert run(spark, tmp_path, batches, "b") == want  # nothing left to do


def test_single_characters_keys_and_resets():
    def typed(text, size):
        word, out = "", []
        for i in range(0, len(text), size):
            found, word = T.read_piece(word, text[i : i + size])
            out += found
        return out, word

    for size in (1, 2, 5, 100):
        assert typed("ab1 2c, d", size) == (["ab1", "c"], "d")
        assert typed("abx\x7f \x7fq ", size) == (["ab", "q"], "")
        assert typed("one two\x04three four", size) == (["one", None, "three"], "four")
        assert typed("\x7f\x7fa\x7f\x7f ", size) == ([], "")


def test_state_after_the_last_word(spark, tmp_path):
    found = T.typed_messages(
        stream_of(spark, tmp_path, [(1, 0, "an foo "), (2, 0, "an foo an "), (3, 0, "foo \x04an ap")]),
        spark.createDataFrame([(w,) for w in WORDS], "word string"), ["session"], str(tmp_path / "out"),
    )
    assert sorted(map(tuple, found.collect())) == [(1, "an", 1, True), (2, "an an", 1, False), (3, "an", 0, False)]


def stream_of(spark, tmp_path, rows):
    spark.createDataFrame(rows, "session int, seq int, chars string").write.json(str(tmp_path / "typed"))
    return spark.readStream.schema("session int, seq int, chars string").json(str(tmp_path / "typed"))


def test_sessions_are_rows_and_states_are_compacted(spark, tmp_path, want, monkeypatch):
    monkeypatch.setattr(T, "COMPACT_EVERY", 2)
    given = [(i if i != 5 else None, n, c) for i, n, c in pieces(TURNS, 7)]
    batches = [given[i::3] for i in range(3)]
    found = run_unsorted(spark, tmp_path, batches, "c")
    assert found == {(i if i != 5 else None, m, n) for i, m, n in want}
    stored = sorted(p.name for p in (tmp_path / "c" / "messages").iterdir() if p.name[0] != ".")
    assert stored == ["base=1", "batch=2"]
    empty = T._States(spark, str(tmp_path / "none"), "`session` int").before()
    new = spark.createDataFrame(given, "session int, seq int, chars string")
    plan = T.ended_words(new, empty, ["session"])._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "FlatMapGroups" not in plan


def run_unsorted(spark, tmp_path, batches, folder):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "session int, seq int, chars string").coalesce(1).write.json(str(tmp_path / f"in/b{k}"))
    stream = spark.readStream.schema("session int, seq int, chars string").option("maxFilesPerTrigger", 1)
    known = spark.createDataFrame([(w,) for w in WORDS], "word string")
    found = T.typed_messages(stream.option("recursiveFileLookup", True).json(str(tmp_path / "in")), known, ["session"], str(tmp_path / folder))
    return {(r.session, r.message, r.n_unknown) for r in found.collect()}
