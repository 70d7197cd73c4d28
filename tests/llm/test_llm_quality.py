"""Held-out accuracy, calibration and odd inputs of the quality classifier."""

import zlib

import numpy as np
import pytest
from llm_fixtures import documents, odd_rows

from claimloom.llm import quality_model as m
from claimloom.llm.queries import op4_quality_model

SF = "/root/testdata/sf0.01"


def held_out(id_):
    return zlib.crc32(str("" if id_ is None else id_).encode()) % 5 == 0


@pytest.fixture(scope="module")
def scored(spark):
    return op4_quality_model(spark, SF).collect()


def test_every_document_is_scored(spark, scored):
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in scored} == ids and len(scored) == len(ids)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)
    assert all(r.held_out == held_out(r.doc_id) for r in scored)


def test_held_out_quality(spark, scored):
    labels = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect())
    rows = [(r.score, labels[r.doc_id]) for r in scored if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, y in rows if y == k] for k in (1, 0))
    order = np.mean([[(a > b) + 0.5 * (a == b) for b in bad] for a in good])
    assert order > 0.9
    score, y = map(np.array, zip(*rows))
    assert ((score - y) ** 2).mean() < y.mean() * (1 - y.mean())


def test_held_out_labels_have_no_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    small = m.Settings(buckets=512, size=16, epochs=3)
    turned = labels.withColumn("quality", m.F.when(m.fold(m.F.col("doc_id")) == 0, 1 - labels.quality).otherwise(labels.quality))
    one, two = ({r.doc_id: r.score for r in m.score_quality(docs, x, settings=small).collect()} for x in (labels, turned))
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 5))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    network = m.train(x, y, m.Settings(epochs=20))
    fresh = rng.standard_normal((4000, 5))
    truth = 1 / (1 + np.exp(-2 * fresh[:, 0]))
    assert np.abs(network.scores(fresh) - truth).mean() < 0.08 and 0.05 < network.temperature < 20


def test_odd_documents_and_labels(spark):
    docs = documents(spark, odd_rows())
    small = m.Settings(buckets=64, size=8, epochs=1)
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 1), (None, 1), (8, None), (99, 0), (9, 7)], "doc_id long, quality int"
    )
    for given in (labels, labels.limit(0)):
        rows = m.score_quality(docs, given, settings=small).collect()
        assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
        assert all(r.held_out == held_out(r.doc_id) for r in rows)
    assert m.score_quality(docs.limit(0), labels, settings=small).count() == 0


def test_tokens_and_shapes():
    buckets = m.Buckets(1 << 14)
    assert len(buckets.ids("one two ###")) == 5 and len(buckets.ids("ONE")) == 2
    assert buckets.ids("ONE")[1] == buckets.ids("one")[0] and len(buckets.ids(None)) == 0
