"""Streams give what batches give, also when replayed."""

from pyspark.sql import functions as F

from wiremere.functions import text
from wiremere.operators import gold
from wiremere.plans.bindings import bind
from wiremere.plans.lake import Lake
from wiremere.streaming import gold as gold_stream
from wiremere.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_ingest_of_several_files_and_a_replay(spark, tmp_path):
    landed = str(tmp_path / "landed")
    news = bind(spark, SF, "news")
    news.repartition(4).write.parquet(landed)
    lake = Lake(spark, str(tmp_path / "lake"))
    stream = lambda: spark.readStream.schema(news.schema).option("maxFilesPerTrigger", 1).parquet(landed)

    def run(checkpoint):
        ingest.ingest(stream(), lake, str(tmp_path / checkpoint), ["seq"]).awaitTermination()
        return lake.bronze().count()

    good = news.filter(F.length(text.strip(F.col("raw_text"))) > 0)
    hashes = good.select(text.content_hash(F.col("source_url"), F.col("raw_text"))).distinct().count()
    assert run("one") == hashes
    assert run("one") == hashes, "nothing new has landed"
    assert run("two") == hashes, "a replay from scratch adds nothing"
    bronze = lake.bronze()
    assert bronze.select("content_hash").distinct().count() == hashes
    assert bronze.select("id").distinct().count() == hashes

    new = {"source_url": F.lit("http://new"), "raw_text": F.lit("text"), "seq": F.lit(-1).cast("bigint")}
    more = news.limit(1).withColumns(new)
    more.write.mode("append").parquet(landed)
    assert run("one") == hashes + 1


def test_a_backlog_takes_several_bounded_batches(spark, tmp_path):
    folder = str(tmp_path / "landed")
    news = bind(spark, SF, "news")
    news.repartition(6).write.parquet(folder)
    size = max(f.stat().st_size for f in (tmp_path / "landed").glob("*.parquet"))
    whole = None
    for n, (limit, batches) in enumerate([({"max_files": 2}, 3), ({"max_bytes": size}, 6), ({}, 1), ({"max_bytes": 1}, 6)]):
        lake = Lake(spark, str(tmp_path / f"lake-{n}"))
        stream = ingest.landed(spark, news.schema, folder, **limit)
        query = ingest.ingest(stream, lake, str(tmp_path / f"checkpoint-{n}"), ["seq"])
        query.awaitTermination()
        assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == batches
        found = {r.content_hash for r in lake.bronze().select("content_hash").collect()}
        whole = whole or found
        assert found == whole and found


def test_live_summary_equals_batch(spark, tmp_path):
    landed = str(tmp_path / "signals")
    signals = bind(spark, SF, "signals")
    signals.repartition(3).write.parquet(landed)
    source = spark.readStream.schema(signals.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    out = str(tmp_path / "out")
    gold_stream.live_summary(source, out, str(tmp_path / "checkpoint")).awaitTermination()

    def rows(df):
        return sorted(tuple(r) for r in df.withColumn("avg_confidence", F.round("avg_confidence", 9)).collect())

    assert len(spark.read.parquet(out).select("batch").distinct().collect()) == 3
    assert rows(gold_stream.latest_summary(spark, out)) == rows(gold.signal_counts(signals))
