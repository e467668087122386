import pytest

from corpuslink.plans import source_queries

from .conftest import rows


@pytest.fixture
def sizes(monkeypatch):
    """Rows a file may hold, and a list of the rows that files read whole had."""
    seen = []
    monkeypatch.setattr(source_queries, "FILE_ROWS", 10, raising=False)

    def watch(module, name, split):
        read = getattr(module, name)

        def watched(spark, paths):
            for path in paths.values() if isinstance(paths, dict) else [paths]:
                seen.extend(r.value.count(split) for r in spark.read.text(path, wholetext=True).collect())
            return read(spark, paths)

        monkeypatch.setattr(module, name, watched)

    watch(source_queries.textfiles, "read_text_samples", "\n")
    watch(source_queries.pages, "read_code_map", ":")
    return seen


def test_text_samples_come_in_bounded_files(spark, sizes, tmp_path):
    turns = [(i, 0, ("user", "assistant")[i % 2], "" if i % 4 < 2 else f"turn {i}\nand more") for i in range(200)]
    table = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    table.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = rows(source_queries.text_samples(spark, str(tmp_path)))
    assert got == [(r, 100, sum(len(t) for *_, role, t in turns if role == r)) for r in ("assistant", "user")]
    assert sum(sizes) == 200 and max(sizes) <= 10


def test_code_map_comes_in_bounded_files(spark, sizes, tmp_path):
    spark.range(200).toDF("p_partkey").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    got = rows(source_queries.code_map_json(spark, str(tmp_path)))
    assert got == sorted([(f"CODE {i}", i) for i in range(200)], key=repr)
    assert sum(sizes) == 200 and max(sizes) <= 10
