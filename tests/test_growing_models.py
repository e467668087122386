import pytest

from corpuslink.operators import textmodel as M
from corpuslink.session import list_folders
from corpuslink.sources.textfiles import read_text_parts, read_text_samples
from corpuslink.streaming.modelstore import ModelStore
from tests.conftest import rows

BATCHES = [[("a", "abab"), ("b", "aabb")], [("a", "xyz"), ("a", "q"), (None, "abc")], [("b", "é😀é"), ("c", None)], [("a", "abab")]]


def frame(spark, given):
    return spark.createDataFrame(given, "label string, text string")


@pytest.mark.parametrize("compact_every", [2, 100])
def test_batches_and_repeats(spark, tmp_path, compact_every):
    store = ModelStore(spark, str(tmp_path / "m"), 2, compact_every)
    assert store.gram_counts().count() == 0
    for number, batch in enumerate(BATCHES):
        store.add(frame(spark, batch), number)
        store.add(frame(spark, batch), number)  # comes again
        whole = frame(spark, [r for b in BATCHES[: number + 1] for r in b if r[0] is not None])
        assert rows(store.gram_counts()) == rows(M.gram_counts(whole, 2))
    store.add(frame(spark, BATCHES[3]), 3)
    assert rows(store.gram_counts()) == rows(M.gram_counts(whole, 2))
    assert len(list_folders(spark, str(tmp_path / "m"))) <= compact_every + 1
    again = ModelStore(spark, str(tmp_path / "m"), 2, compact_every)
    texts = spark.createDataFrame([(1, "abab"), (2, "bbaa")], "doc_id int, text string")
    trained = M.train(whole, 2, ["a", "b"])
    assert rows(M.score(again.model(["a", "b"]), texts)) == rows(M.score(trained, texts))


def test_a_write_cut_off_does_not_count(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "m"), 1)
    store.add(frame(spark, BATCHES[0]), 0)
    before = rows(store.gram_counts())
    (tmp_path / "m" / "batch=1").mkdir()
    frame(spark, BATCHES[1]).write.parquet(str(tmp_path / "other"))
    assert rows(store.gram_counts()) == before
    store.add(frame(spark, BATCHES[1]), 1)
    assert len(rows(store.gram_counts())) > len(before)


def test_a_stream_of_samples(spark, tmp_path):
    for n, batch in enumerate(BATCHES):
        frame(spark, batch).coalesce(1).write.json(str(tmp_path / "in" / f"f{n}"))
    stream = spark.readStream.schema("label string, text string").option("maxFilesPerTrigger", 1)
    stream = stream.option("recursiveFileLookup", True).json(str(tmp_path / "in"))
    store = ModelStore(spark, str(tmp_path / "m"), 2, 3)
    store.follow(stream)
    whole = frame(spark, [r for b in BATCHES for r in b if r[0] is not None])
    assert rows(store.gram_counts()) == rows(M.gram_counts(whole, 2))
    assert store.base() == 2
    frame(spark, [("a", "newer")]).coalesce(1).write.json(str(tmp_path / "in" / "f9"))
    store.follow(stream)
    assert rows(store.gram_counts()) == rows(M.gram_counts(whole.unionByName(frame(spark, [("a", "newer")])), 2))


FILES = {
    "plain": b"one\ntwo\n\n\nthree\n",
    "open": b"one\ntwo",
    "windows": b"one\r\ntwo\r\n\r\nx\r\n",
    "old": b"one\rtwo\r\rx\r",
    "mixed": "é😀\r\n\rq\n\n\r".encode(),
    "marked": b"\xef\xbb\xbfone\ntwo\n",
    "marked_open": b"\xef\xbb\xbfone\r",
    "breaks": b"\n\n\n\n\n",
    "long": b"abc def\n" * 3000 + b"end",
    "short": b"a",
    "empty": b"",
}


@pytest.mark.parametrize("split", [None, 3, 1000])
def test_files_in_parts(spark, tmp_path, split):
    for name, data in FILES.items():
        (tmp_path / f"{name}.txt").write_bytes(data if split != 3 else data[:200])
    whole = read_text_samples(spark, {"x": str(tmp_path)})
    key = "spark.sql.files.maxPartitionBytes"
    if split:
        spark.conf.set(key, split)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        parts = read_text_parts(spark, {"x": str(tmp_path)}, part_chars=50)
        held = {}
        for r in parts.orderBy("text_id", "part_no").collect():
            held[r.text_id] = held.get(r.text_id, "") + r.text
        for k in (1, 2, 5):
            assert rows(M.gram_counts_of_parts(parts, k)) == rows(M.gram_counts(whole, k))
    finally:
        spark.conf.unset(key)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(held.values()) == sorted(r.text for r in whole.collect() if r.text)


def test_parts_shorter_than_the_order(spark):
    parts = [("t", i, c) for i, c in enumerate(["a", "", "b", "cd", "e", "f", "", "g"])] + [("u", 0, "a"), ("u", 1, "b"), ("v", 0, "xyz")]
    table = spark.createDataFrame([("l", *p) for p in parts], "label string, text_id string, part_no int, text string")
    whole = spark.createDataFrame([("l", "abcdefg"), ("l", "ab"), ("l", "xyz")], "label string, text string")
    for k in (1, 2, 3, 5):
        assert rows(M.gram_counts_of_parts(table, k)) == rows(M.gram_counts(whole, k))
