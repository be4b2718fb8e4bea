"""Quality scores: held-out accuracy, no look at held-out labels, isotonic fit, edge cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wiremere.llm import quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def scores(tables):
    return {r.doc_id: r for r in quality.classify(*tables).collect()}


def test_held_out_accuracy(tables, scores):
    docs, labels = tables
    known = [(scores[r.doc_id], r.quality) for r in labels.collect()]
    held = [(s, y) for s, y in known if s.held_out]
    assert len(scores) == docs.count()
    assert np.mean([s.predicted == y for s, y in held]) >= 0.95
    good, bad = ([s.score for s, y in held if y == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def test_rows(scores):
    for i, row in scores.items():
        assert row.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= row.score <= 1
        assert row.predicted == int(row.score >= 0.3)


def test_held_out_labels_change_nothing(tables, scores):
    docs, labels = tables
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.classify(docs, flipped).collect()
    assert {r.doc_id: r.score for r in again} == pytest.approx({i: r.score for i, r in scores.items()}, abs=1e-9)


def test_isotonic_equals_brute_force():
    rng = np.random.default_rng(3)
    x, y, w = np.arange(12.0), rng.random(12), rng.integers(1, 5, 12).astype(float)
    at, level = quality.isotonic(x, y, w)
    assert (np.diff(level) > 0).all()

    def mean(a, b):
        return (y[a:b] * w[a:b]).sum() / w[a:b].sum()

    # The min-max formula of the isotonic fit.
    fit = [max(min(mean(a, b) for b in range(i + 1, 13)) for a in range(i + 1)) for i in range(12)]
    steps = sorted(set(np.round(fit, 12)))
    assert np.allclose(steps, level)
    assert len(at) == len(level)


def test_statistics_of_odd_texts():
    texts = pa.array([None, "", " ", "!!!", "a", "A B\n\nA B\n", "x" * 100_000])
    found = quality.statistics(texts)
    assert found.shape == (7, len(quality.STATISTICS))
    assert np.isfinite(found).all()
    alone = np.vstack([quality.statistics(texts.slice(i, 1)) for i in range(7)])
    assert np.allclose(found, alone)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 1), (2, None)], [(1, 0), (1, 0)]])
def test_few_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b", 9), (2, None, 9), (None, "", 9), (1, "a b", 9)], "doc_id long, text string, score int")
    rows = quality.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(rows) == 4
    assert all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int")).count() == 0
