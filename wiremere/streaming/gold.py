"""Live Gold counts over arriving signals."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wiremere.operators import gold


def live_summary(signals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the category summary of a signal stream; every trigger writes it anew.

    State and output are one row per category. Each batch writes a folder of its own, so a reader
    never sees a half-written summary and a replay overwrites only its own batch.
    """
    def write(summary: DataFrame, batch_id: int) -> None:
        summary.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        gold.signal_counts(signals)
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_summary(spark: SparkSession, path: str) -> DataFrame:
    """The summary of the last batch."""
    batches = spark.read.parquet(path)
    last = batches.agg({"batch": "max"}).first()[0]
    return batches.filter(batches["batch"] == last).drop("batch")
