"""The pipeline's stages on their own input and together."""

import corpus_pipeline
import pytest

from rastermill.llm import quality
from rastermill.llm.shared import table

from . import brute

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, FOLDER, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), "test")
        out.append((before.collect(), docs.collect(), before.columns, docs.columns))
    return out


def test_stages(spark, steps):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, FOLDER, "labels").collect()}
    before, after, columns, kept = steps[0]
    assert columns == kept
    ids = {r["doc_id"] for r in after}
    known = [(r["doc_id"] in ids, labels[r["doc_id"]]) for r in before if r["doc_id"] in labels]
    assert sum(k == bool(y) for k, y in known) > 0.9 * len(known)
    before, after, columns, kept = steps[1]
    assert columns == kept
    classes = brute.near_classes([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"] for r in after} == set(classes.values())
    before, after, columns, kept = steps[2]
    items = [(r["item_id"], r["text"]) for r in table(spark, FOLDER, "benchmark").collect()]
    clean = {c[0] for c in brute.contamination([(r["doc_id"], r["text"]) for r in before], items) if not c[5]}
    assert columns == kept and {r["doc_id"] for r in after} == clean
    before, after, columns, kept = steps[3]
    assert columns == kept and len(before) == len(after)
    texts = {r["doc_id"]: r["text"] for r in after}
    for r in before:
        assert not brute.pii_spans(texts[r["doc_id"]])
        if not brute.pii_spans(r["text"]):
            assert texts[r["doc_id"]] == r["text"]
    before, after, _, _ = steps[4]
    assert len(before) == len(after) and all(r["round_trip"] for r in after)


def test_run_is_the_stages(spark, steps):
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, FOLDER).collect()} == {r["doc_id"] for r in steps[-1][1]}


def test_empty(spark):
    docs = table(spark, FOLDER, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0 and quality.ACCEPT == 0.7
