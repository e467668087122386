import pytest


@pytest.fixture(scope="module")
def frame(spark):
    """Rows as documents with columns whose names clash with those the operators use inside."""

    def build(rows, extra=True):
        docs = spark.createDataFrame(
            [(i, t) for i, t in rows], "doc_id long, text string"
        )
        if extra:
            for name in ("n", "hash", "row", "kind", "token", "size", "score", "shard", "part", "component", "_n"):
                docs = docs.selectExpr("*", f"'x' AS {name}")
        return docs

    return build
