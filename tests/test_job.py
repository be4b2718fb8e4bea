"""Whole runs."""

import json
from datetime import date, datetime

import pytest

from wiremere.operators import extraction
from wiremere.plans.job import JobOptions, run_job
from wiremere.plans.lake import Lake

ITEM = "<item><title>{0}</title><link>http://n/{1}</link><description>{2}</description></item>"
ITEMS = [
    ("Downgrade", "Swiss Re downgraded by Fitch"),
    ("Cup final", "Football results"),
    ("Broker", "Aon grows"),
    ("Blank", "&#160;"),
]


@pytest.fixture
def feed(tmp_path):
    items = "".join(ITEM.format(t, i, d) for i, (t, d) in enumerate(ITEMS))
    path = tmp_path / "feed.xml"
    path.write_text(f"<rss><channel><title>Wire</title>{items}</channel></rss>")
    return str(path)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def options(feed, **more):
    return JobOptions(source="wire", source_options={"path": feed}, **more)


def test_two_runs(lake, feed, tmp_path):
    out = str(tmp_path / "out")
    at = datetime(2024, 1, 3)
    first = run_job(lake, options(feed, export_to=out, as_of=date(2024, 1, 3)), run_at=at)
    assert (first.ingested, first.inserted, first.duplicates) == (3, 3, 0)
    assert first.outcomes == {"silver": 2, "noise": 1}
    assert (first.bronze_total, first.silver_total, first.dlq_total) == (3, 2, 0)

    second = run_job(lake, options(feed), run_at=datetime(2024, 1, 4))
    assert (second.ingested, second.inserted, second.duplicates) == (3, 0, 3)
    assert second.outcomes == {} and second.silver_total == 2

    joined = lake.silver().join(lake.bronze().withColumnRenamed("id", "bronze_id"), "bronze_id")
    assert joined.count() == 2
    read = lambda name: lake.spark.read.parquet(f"{out}/{name}")
    assert read("dashboard/star/fact_signals").count() == 2
    assert {r["entity_name"] for r in read("dashboard/star/dim_entities").collect()} == {"Swiss Re", "Aon"}
    assert read("report/gold_grand_total").count() == 3
    assert read("dashboard/pages/timeline_day").count() == 2
    assert lake.spark.sql("SELECT sum(total_signals) FROM gold_signal_summary").first()[0] == 2


def test_dry_run_stops_after_bronze(lake, feed):
    result = run_job(lake, options(feed, dry_run=True, query="re"))
    assert (result.inserted, result.outcomes, result.silver_total) == (2, {}, 0)


def test_batch_size_bounds_a_run_and_the_backlog_follows(lake, feed):
    assert sum(run_job(lake, options(feed, batch_size=2)).outcomes.values()) == 2
    assert sum(run_job(lake, options(feed, batch_size=2)).outcomes.values()) == 1
    assert run_job(lake, options(feed, batch_size=None)).outcomes == {}


def test_failures_go_to_the_dead_letters_and_back(lake, feed, frame):
    def broken(articles):
        return extraction.model_payloads(articles, lambda: lambda prompts: ["oops"] * len(prompts), "m")

    def mended(articles):
        good = json.dumps({"is_relevant": True, "signal_category": "Broker_Dynamics", "summary": "s"})
        return extraction.model_payloads(articles, lambda: lambda prompts: [good] * len(prompts), "m")

    result = run_job(lake, options(feed), broken)
    assert result.outcomes == {"failed": 3} and result.dlq_total == 3
    letters = lake.spark.sql("SELECT * FROM gold_dead_letter_queue")
    assert {r["processing_error"] for r in letters.collect()} == {
        "Signal extraction failed: payload is not a JSON object"
    }
    assert run_job(lake, options(feed), mended).outcomes == {}, "failures wait for a retry"
    lake.retry(letters.selectExpr("id AS bronze_id").limit(2))
    result = run_job(lake, options(feed), mended)
    assert result.outcomes == {"silver": 2} and (result.silver_total, result.dlq_total) == (2, 1)


def test_crash_between_signals_and_status_repairs_itself(lake, feed, spark):
    run_job(lake, options(feed))
    lake.status().limit(0).drop("log_date").write.mode("overwrite").parquet(lake.path("status"))
    result = run_job(lake, options(feed))
    assert result.silver_total == 2, "signals are not stored twice"
    assert result.outcomes == {"noise": 1}


def test_unreadable_source_leaves_the_backlog_to_be_processed(lake, feed):
    run_job(lake, options(feed, dry_run=True))
    result = run_job(lake, options(feed + ".missing"))
    assert (result.ingested, result.outcomes) == (0, {"silver": 2, "noise": 1})


def test_rejected_rows_are_stored_and_counted(lake, feed, tmp_path):
    broken = tmp_path / "broken.xml"
    broken.write_text("<rss><channel><title>B</title><item><title>cut off</ti")
    paths = [feed, str(tmp_path / "missing.xml"), str(broken)]
    result = run_job(lake, JobOptions(source="rss", source_options={"paths": paths}))
    assert (result.ingested, result.inserted, result.rejected) == (3, 3, 2)
    reasons = sorted(r["reject_reason"] for r in lake.rejects().collect())
    assert reasons == ["entry is not well-formed", "raw_text is empty"]


def test_a_run_leaves_no_scratch_behind(lake, feed, tmp_path, monkeypatch):
    from wiremere import session

    shared = tmp_path / "shared"
    shared.mkdir()
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(shared))
    result = run_job(lake, options(feed, export_to=str(tmp_path / "out")))
    assert result.inserted == 3
    assert session.scratch(lake.spark, "x").startswith(str(shared))
    assert list(shared.iterdir()) == []


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as Space

    from wiremere import session

    for master in ("yarn", "spark://host", "local-cluster[2,1,1024]"):
        away = Space(conf=Space(get=lambda key, default: default), sparkContext=Space(master=master))
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_dir(away)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_a_time_without_zone_is_utc_wherever_the_driver_runs(spark, zone, monkeypatch):
    import time

    from wiremere.functions import times

    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        shown = spark.range(1).select(times.instant(datetime(2024, 2, 1, 3, 4, 5, 6)).cast("string")).first()[0]
    finally:
        monkeypatch.undo()
        time.tzset()
    assert shown == "2024-02-01 03:04:05.000006"


def test_unknown_source(lake):
    with pytest.raises(KeyError):
        run_job(lake, JobOptions(source="nowhere"))
