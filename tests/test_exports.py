"""Exports: one read of Silver, and frames from the cube that equal those from the signals."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wiremere import constants as C
from wiremere import schemas
from wiremere.operators import cube, gold
from wiremere.operators import signals as sig
from wiremere.plans import exports


@pytest.fixture
def silver(spark, tmp_path):
    """A stored Silver table with every kind of cell, null ones included, in several files."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        at = rng.choice([None, *[datetime(2024, 12, 28) + timedelta(hours=7 * n) for n in range(20)]])
        category = rng.choice([None, "OTHER", *C.CATEGORIES])
        rows.append(
            (str(i), str(i), "s", rng.choice([None, "http://x"]), f"t{i % 9}", category, "sum", rng.choice(['["A", "B"]', "[]", None]),
             rng.choice([None, "ODD", *C.SENTIMENTS]), rng.choice([None, 0.85, 0.1, 1.0]), rng.choice([None, True, False]), at, "m", "{}")
        )
    path = str(tmp_path / "silver")
    spark.createDataFrame(rows, schemas.SILVER).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def plain(df):
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()]


def same(a, b, ordered):
    """Equal columns and rows; where the order has ties, in any order."""
    assert a.dtypes == b.dtypes
    one, two = plain(a), plain(b)
    return one == two if ordered else sorted(one, key=str) == sorted(two, key=str)


def test_the_cube_has_one_row_per_cell(silver):
    cells = cube.cube(silver)
    keys = [r[:4] for r in plain(cells.select(*cube.AXES, "signals"))]
    assert len(keys) == len(set(keys)) and cells.agg(F.sum("signals")).first()[0] == 400


def test_frames_of_the_cube_equal_those_of_the_signals(silver):
    for signals in (silver, silver.filter("false"), silver.filter("confidence_score is null"), silver.filter("extracted_at is null")):
        cells, enriched = exports.cells_of(signals), sig.enrich(signals)
        counts, summed = gold.signal_counts(signals), cube.signal_counts(cells)
        assert same(summed, counts, ordered=False)
        assert same(gold.report_of(summed), gold.report(signals), ordered=False)
        assert same(gold.grand_total_of(summed), gold.grand_total(signals), ordered=False)
        assert same(gold.kpi_cards_of(summed), gold.kpi_cards(signals), ordered=True)
        assert same(cube.sentiment_distribution(cells), gold.sentiment_distribution(signals), ordered=True)
        assert same(cube.action_breakdown(cells), gold.action_breakdown(signals), ordered=True)
        assert same(cube.category_sentiment(cells), gold.category_sentiment(enriched), ordered=False)
        assert same(cube.sentiment_trend(cells), gold.sentiment_trend(enriched), ordered=True)
        assert same(cube.dashboard_header(cells), gold.dashboard_header(signals), ordered=True)


def test_an_export_reads_silver_once(silver, tmp_path, monkeypatch):
    own = set(silver.inputFiles())
    store, write, reads, frames = exports.materialise, exports.write_frames, [], {}

    def stored(df):
        reads.append(bool(own & set(df.inputFiles())))
        return store(df)

    def written(found, folder):
        frames.update(found)
        return write(found, folder)

    monkeypatch.setattr(exports, "materialise", stored)
    monkeypatch.setattr(exports, "write_frames", written)
    names = exports.export_all(silver, str(tmp_path / "out"), date(2024, 12, 30))
    assert reads.count(True) == 1 and sorted(names) == sorted(frames) and len(frames) == 21
    assert not any(own & set(frame.inputFiles()) for frame in frames.values())


def test_counts_read_the_cube_and_no_signals(silver):
    shown = exports.snapshot(silver)
    cells = exports.cells_of(shown)
    frames = {**exports.report_frames(shown, cells), **exports.dashboard_frames(shown, date(2024, 12, 30), cells)}
    small = {n for n, f in frames.items() if set(f.inputFiles()) <= set(cells.inputFiles())}
    assert small == {"gold_report", "gold_grand_total", "kpi_cards", "sentiment_share", "action_share", "header", "category_sentiment", "sentiment_trend"}
    assert "raw_llm_response" not in shown.columns


def test_an_export_without_signals(silver, tmp_path):
    out = str(tmp_path / "out")
    names = exports.export_all(silver.filter("false"), out, date(2024, 12, 30))
    assert names == list(exports.report_frames(silver.filter("false")))
    assert exports.export_dashboard(silver.filter("false"), out, date(2024, 12, 30)) == []
