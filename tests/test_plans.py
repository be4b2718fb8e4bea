"""Physical plans: what must and must not be in them."""

import re

import pytest
from pyspark.sql import functions as F

from wiremere import schemas
from wiremere.functions import times
from wiremere.operators import bronze, extraction, status
from wiremere.operators.ranking import first_per_key, top_per_key
from wiremere.plans.lake import Lake
from wiremere.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
WRITING = {"stream_gold", "stream_ingest", "whole_run", "feed_files", "competitor_activity_files"}
WITH_PYTHON = {"extract_model"}


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert ("Python" in text or "ArrowEval" in text) == (name in WITH_PYTHON)
    assert "CartesianProduct" not in text
    assert "NestedLoop" not in text


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanged(text):
    """Columns that go into each shuffle."""
    return re.findall(r"\n\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)


@pytest.fixture
def texts(spark, tmp_path):
    """A stored table with long texts."""
    path = str(tmp_path / "texts")
    rows = [(f"k{i % 50}", f"h{i % 50}", str(i), i, f"text {i}" * 9, i) for i in range(4000)]
    ddl = "k string, content_hash string, id string, v int, raw_text string, ingested_at int"
    spark.createDataFrame(rows, ddl).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def lake(spark, tmp_path):
    """A lake with a row in Bronze and one in Silver."""
    from datetime import datetime

    lake = Lake(spark, str(tmp_path / "lake"))
    lake.create()
    lake.insert_one("s", "text")
    columns = {"bronze_id": "1", "signal_category": "Emerging_Risks"}
    silver = spark.range(1).select(
        *[F.lit(columns.get(f.name)).cast(f.dataType).alias(f.name) for f in schemas.SILVER if f.name != "extracted_at"],
        times.instant(datetime(2024, 12, 31)).alias("extracted_at"),
    )
    lake.append("silver", silver)
    return lake


@pytest.mark.parametrize("n", [1, 20, 5000])
def test_caps_and_firsts_leave_texts_where_they_lie(texts, n):
    for cut in (top_per_key(texts, ["k"], "v", n), first_per_key(texts, ["k"], [F.col("v")])):
        assert not any("raw_text" in columns for columns in exchanged(plan(cut).split("(1)")[1])[:-1])
        joins = re.findall(r"BroadcastHashJoin|SortMergeJoin", plan(cut))
        assert set(joins) == {"BroadcastHashJoin"}


def test_a_salt_spreads_a_hot_key(frame):
    from wiremere.operators import ranking

    seen = []
    keep, ranking.materialise = ranking.materialise, lambda df: seen.append(plan(df)) or df
    try:
        top_per_key(frame("k string, v int, raw_text string", []), ["k"], "v", 5000)
    finally:
        ranking.materialise = keep
    shuffles = re.findall(r"hashpartitioning\(([^)]*), 8\)", seen[0])
    assert any("_salt" in s for s in shuffles)
    assert "raw_text" not in "".join(exchanged(seen[0]))


def test_only_new_rows_move_their_texts(texts):
    """The anti-join sees hashes; texts are joined to the few new keys where they lie."""
    from wiremere.operators import ranking

    seen = []
    keep, ranking.materialise = ranking.materialise, lambda df: (seen.append(plan(df)), keep(df))[1]
    try:
        fresh = bronze.new_rows(texts, texts.limit(5), [F.col("v")])
    finally:
        ranking.materialise = keep
    assert "LeftAnti" in seen[0] and "raw_text" not in "".join(exchanged(seen[0]))
    assert "SortMergeJoin" not in plan(fresh)


def test_stored_periods_leave_out_partitions(lake):
    from datetime import date

    from wiremere.operators import signals as sig
    from wiremere.sources import archive

    for period in sig.PERIODS:
        found = plan(sig.timeline(lake.silver(), period, date(2024, 12, 31)).select("id"))
        assert re.search(r"PartitionFilters: \[.*extracted_date", found)
    today = str(lake.bronze().first()["ingest_date"])
    scanned = plan(archive.scan(lake.bronze(), date_from=today, date_to=today).select("id"))
    assert re.search(r"PartitionFilters: \[.*ingest_date", scanned)


def test_dead_letters_move_previews_only(spark, tmp_path, no_broadcast):
    lake = Lake(spark, str(tmp_path))
    lake.create()
    moved = exchanged(plan(status.dead_letters(lake.bronze(), lake.status())))
    assert any("raw_text_preview" in columns for columns in moved)
    assert not any(re.search(r"raw_text#", columns) for columns in moved)


def test_queue_of_some_articles_spreads_over_tasks(spark, tmp_path):
    rows = [(str(i), f"t{i}", i) for i in range(5000)]
    path = str(tmp_path / "bronze")
    stored = spark.createDataFrame(rows, "id string, raw_text string, ingested_at int")
    stored.repartition(8).write.parquet(path)
    log = spark.createDataFrame([], "bronze_id string, status string, error string, logged_at timestamp, run_id string")
    queue = status.work_queue(spark.read.parquet(path), log, 1000)
    assert sum("raw_text" in s for s in re.findall(r"ReadSchema: struct<[^>]*>", plan(queue))) == 1
    assert queue.rdd.getNumPartitions() > 1
    assert queue.count() == 1000


def test_search_results_stay_where_they_lie(texts):
    from wiremere.sources import archive

    found = archive.scan(texts.withColumn("title", F.col("id")), "text 1", max_results=100)
    top = re.search(r"TakeOrderedAndProject\nInput \[\d+\]: \[([^\]]*)\]", plan(found)).group(1)
    assert "raw_text" not in top and "Exchange hashpartitioning" not in plan(found)
    assert found.rdd.getNumPartitions() > 1
    expected = sorted((r["ingested_at"], r["id"]) for r in texts.collect() if "text 1" in f"{r['id']} {r['raw_text']}".lower())
    assert sorted((r["ingested_at"], r["id"]) for r in found.collect()) == expected[:100]


def test_period_and_category_filters_reach_the_scan(lake):
    from datetime import date

    from wiremere.operators import signals as sig

    month = plan(sig.timeline(lake.silver(), "month", date(2024, 12, 30)).select("id"))
    pushed = re.search(r"PushedFilters: \[(.*)\]", month).group(1)
    assert "GreaterThanOrEqual(extracted_at" in pushed and "LessThan(extracted_at" in pushed
    assert re.search(r"ReadSchema: struct<id:string,extracted_at:timestamp>", month)
    risks = plan(sig.latest_in_category(lake.silver(), "Emerging_Risks", 10))
    assert "EqualTo(signal_category,Emerging_Risks)" in risks and "TakeOrderedAndProject" in risks


def test_counting_reads_few_columns(spark):
    text = plan(QUERIES["gold_signal_summary"](spark, SF))
    assert re.search(r"ReadSchema: struct<[^>]*>", text).group(0).count(":") == 4


def test_small_batch_leaves_bronze_unshuffled(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.create()
    batch = spark.range(10).select(F.col("id").cast("string").alias("content_hash"))
    text = plan(bronze.existing_hashes(batch, lake.bronze()))
    assert "BroadcastHashJoin LeftSemi BuildRight" in text
    assert "ReadSchema: struct<content_hash:string>" in text


def test_large_sides_are_not_broadcast(spark):
    """With nothing under the broadcast threshold, joins shuffle both sides by key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bronze_insert_ignore", "backlog", "competitor_activity_star", "lineage"):
            text = plan(QUERIES[name](spark, SF))
            assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_queue_finds_keys_before_it_reads_texts(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.create()
    lake.insert_one("s", "text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (
            status.work_queue(lake.bronze(), lake.status(), 50, lake.silver()),
            status.dead_letter_page(lake.bronze(), lake.status(), 50),
        ):
            text = plan(df)
            assert "dynamicpruning" in text, "only the partitions of the chosen keys are read"
            scans = re.findall(r"ReadSchema: struct<[^>]*>", text)
            assert sum("raw_text" in s for s in scans) == 1
            assert "struct<id:string,ingested_at:timestamp>" in "".join(scans)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filter_on_outcome_does_not_repeat_the_parsing(spark, frame):
    df = frame("bronze_id string, payload string", [("1", "{}")])
    text = plan(extraction.route(df).filter(F.col("outcome") == status.SILVER).select("bronze_id"))
    assert text.count("from_json(") <= 2
