import os

import pytest

import corpus_pipeline
from corpuslink.llm import mixing, toxicity
from corpuslink.llm.queries import MIX_KEEP, MIX_TARGETS
from tests.llm.test_copies import _brute

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held = {r.doc_id: r for r in docs.collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out(labels["doc_id"])))
    scores = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    clean = {i for i in held if not scores[i]}
    first = {}
    for i in sorted(clean):
        first.setdefault(held[i].text or "", i)
    single = set(first.values())
    near = {c for _, _, c in _brute([(i, held[i].text) for i in single])}
    kept_docs = docs.where(docs.doc_id.isin(sorted(near)))
    mixed = {r.doc_id for r in mixing.rates(kept_docs, MIX_TARGETS, MIX_KEEP).collect() if r.kept}
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in packed} == mixed
    assert len(clean) < len(held) and len(single) < len(clean) and len(mixed) < len(near)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    empty = docs.where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, SF_DIR).columns == docs.columns
    assert len(corpus_pipeline.STAGES) == 5
