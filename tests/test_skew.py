"""One key with a third of all rows, against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wiremere.operators import bronze, entities, feeds, gold, status
from wiremere.operators.ranking import first_per_key, top_per_key

N = 9000


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    order = list(range(N))
    rng.shuffle(order)
    return [("hot" if i % 3 == 0 else f"k{rng.randrange(500)}", v) for i, v in enumerate(order)]


@pytest.fixture
def skewed(frame, rows):
    return frame("k string, v int", rows).repartition(8)


def brute(rows, n):
    best = {}
    for k, v in sorted(rows, key=lambda r: r[1]):
        best.setdefault(k, []).append(v)
    return sorted((k, v) for k, vs in best.items() for v in vs[:n])


@pytest.mark.parametrize("n", [1, 20, 1001, 5000])
def test_top_per_key(skewed, rows, n):
    got = sorted(tuple(r) for r in top_per_key(skewed, ["k"], "v", n).collect())
    assert got == brute(rows, n)


def test_first_per_key(skewed, rows):
    got = sorted(tuple(r) for r in first_per_key(skewed, ["k"], [F.col("v")]).collect())
    assert got == brute(rows, 1)


def test_copies_of_one_article(skewed, rows):
    batch = bronze.with_hash(
        skewed.select(F.col("k").alias("source_url"), F.lit("t").alias("raw_text"), "v")
    )
    fresh = bronze.new_rows(batch, batch.limit(0), [F.col("v")])
    assert fresh.count() == len({k for k, _ in rows})
    report = bronze.dedup_report(batch, fresh).first()
    assert (report["batch_rows"], report["inserted"]) == (N, 0)


def test_one_feed_with_a_third_of_the_entries(skewed, rows):
    entries = skewed.select(F.col("k").alias("feed_url"), F.col("v").cast("bigint").alias("pos"))
    assert feeds.cap_entries(entries, 20).count() == len(brute(rows, 20))
    assert feeds.cap_entries(entries).count() == N


def test_one_article_with_a_third_of_the_status_rows(skewed, rows):
    start = datetime(2024, 1, 1)
    log = skewed.select(
        F.col("k").alias("bronze_id"),
        F.concat(F.lit("s"), "v").alias("status"),
        F.lit(None).cast("string").alias("error"),
        (F.lit(start) + F.make_dt_interval(secs=F.col("v"))).alias("logged_at"),
    )
    latest = {}
    for k, v in rows:
        latest[k] = max(v, latest.get(k, -1))
    got = {r["bronze_id"]: (r["status"], r["logged_at"]) for r in status.current(log).collect()}
    assert got == {k: (f"s{v}", start + timedelta(seconds=v)) for k, v in latest.items()}


def test_one_entity_with_a_third_of_the_mentions(skewed, rows):
    signals = skewed.select(
        F.col("v").cast("string").alias("id"),
        F.to_json(F.array("k")).alias("key_entities"),
        F.lit("Competitor_Strategy").alias("signal_category"),
    )
    counts = entities.competitor_activity(entities.mentions(signals, "signal_category"))
    got = {r["entity_name"]: r["count"] for r in counts.collect()}
    assert got["hot"] == N // 3 and sum(got.values()) == N
    assert len(got) == len({k for k, _ in rows})


def test_one_sentiment_with_a_third_of_the_signals(skewed):
    counts = gold.sentiment_distribution(skewed.withColumnRenamed("k", "sentiment"))
    top = gold.with_share(counts).orderBy(F.col("count").desc()).first()
    assert (top["sentiment"], top["count"], round(top["share_pct"], 6)) == ("hot", 3000, 33.333333)
