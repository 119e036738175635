"""The pipeline against plain versions of its stages, and the registry."""

import os

import pytest

import __spark_entry__
import corpus_pipeline
from seriesloom.llm import decontam, pii, toxicity
from seriesloom.llm.common import id_remainder
from tests.llm.test_operators import plain_kept

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter(id_remainder("doc_id", 5) != 0)
    model = toxicity.train(docs, labels)
    kept = {k for k, r in rows.items() if toxicity.probability(model, r["text"]) < 0.5}
    kept = {k for _, k in plain_kept([(k, rows[k]["text"]) for k in kept])}
    index = decontam.build_index([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    kept = {k for k in kept if not decontam.find_regions(rows[k]["text"], index)}
    texts = {k: pii.mask_text(rows[k]["text"], pii.find_all(rows[k]["text"])[1]) for k in kept}
    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, SF)
        assert step.columns == docs.columns, name
    assert {r["doc_id"]: r["text"] for r in step.collect()} == texts
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} == kept
    assert sum(r["length"] for r in out) == sum({r["doc_id"]: r["doc_tokens"] for r in out}.values())
