"""Insert-or-ignore, reports and single inserts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wiremere import schemas
from wiremere.operators import bronze, feeds
from wiremere.plans import job
from wiremere.plans.lake import Lake

AT = datetime(2024, 1, 2)
ROWS = [
    (1, "a", " http://x ", "one"),
    (2, "b", "http://x", "two"),
    (3, "c", None, "three"),
    (4, "d", "", " three "),
    (5, "e", None, None),
]


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.create()
    return lake


@pytest.fixture
def batch(frame):
    df = frame("seq int, title string, source_url string, raw_text string", ROWS)
    return bronze.with_hash(df.withColumns({"source_name": F.lit("s"), "raw_metadata": F.lit(None)}))


def test_first_row_per_hash_wins(batch):
    good = feeds.accepted(batch)
    fresh = bronze.new_rows(good, good.limit(0), [F.col("seq")])
    assert sorted(r["title"] for r in fresh.collect()) == ["a", "c"]
    last = bronze.new_rows(good, good.limit(0), [-F.col("seq")])
    assert sorted(r["title"] for r in last.collect()) == ["b", "d"]


@pytest.mark.parametrize("probe", [False, True])
def test_stored_hashes_are_skipped(batch, probe):
    good = feeds.accepted(batch)
    stored = good.filter("seq = 2")
    fresh = bronze.new_rows(good, stored, [F.col("seq")], probe)
    assert [r["title"] for r in fresh.collect()] == ["c"]


def test_report(batch):
    good = feeds.accepted(batch)
    report = bronze.dedup_report(good, good.filter("seq = 2")).first().asDict()
    assert report == {"batch_rows": 4, "inserted": 1, "hashes_stored_before": 1, "duplicates": 3}
    nothing = bronze.dedup_report(good.limit(0), good).first().asDict()
    assert nothing == {"batch_rows": 0, "inserted": 0, "hashes_stored_before": 0, "duplicates": 0}


def test_rejects_keep_their_reason(batch):
    rows = feeds.rejected(batch).collect()
    assert [(r["title"], r["reject_reason"]) for r in rows] == [("e", "raw_text is empty")]


def test_second_store_adds_nothing(lake, batch):
    good = feeds.accepted(batch).drop("seq")
    assert job.store(lake, good, AT) == (4, 2, 2)
    assert job.store(lake, good, AT) == (4, 0, 4)
    assert lake.bronze().count() == 2
    assert lake.bronze().filter("raw_metadata = '{}'").count() == 2


def test_empty_batch_is_a_no_op(lake, spark):
    nothing = bronze.with_hash(schemas.empty(spark, schemas.ARTICLE))
    assert job.store(lake, nothing, AT) == (0, 0, 0)
    assert lake.bronze().count() == 0


def test_single_insert(lake):
    first = lake.insert_one("s", "text", "http://x", at=AT)
    assert first and lake.insert_one("s", "other text", " http://x ", at=AT) is None
    assert lake.insert_one("s", "text", at=AT) not in (None, first)
    assert {r["id"] for r in lake.bronze().collect()} >= {first}


def test_create_is_idempotent(lake):
    lake.insert_one("s", "text", at=AT)
    lake.create()
    assert lake.bronze().count() == 1
    assert lake.spark.sql("SELECT * FROM gold_signal_summary").count() == 0
    assert lake.spark.sql("SELECT * FROM gold_dead_letter_queue").count() == 0
    assert lake.bronze().schema.names == [*schemas.BRONZE.names, "ingest_date"]
