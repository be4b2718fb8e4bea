"""Incremental ingest: a stream of articles into Bronze, without dedup state in the stream."""

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wiremere.operators import bronze, feeds
from wiremere.plans.lake import Lake
from wiremere.session import materialise, run_folder

BATCH_BYTES = 64 << 30


def landed(
    spark: SparkSession, schema: StructType, path: str, max_bytes: int | None = BATCH_BYTES, max_files: int | None = None
) -> DataFrame:
    """A stream of the Parquet files that land in a folder, in batches of bounded size.

    A batch takes files until it holds `max_bytes` of them, or `max_files` where that is given instead; a
    single larger file is a batch of its own. A backlog of any size is worked off batch by batch.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def bronze_writer(
    lake: Lake, arrival: list[str], clock: Callable[[], datetime] = lambda: datetime.now(UTC)
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function. Ids come from the content hash and stored hashes are skipped, so a
    replayed batch adds nothing. The batch is stored once, so a lost executor costs no second read. While another writer's commit is open, the batch fails and is replayed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        with run_folder(batch.sparkSession):
            hashed = materialise(bronze.with_hash(feeds.accepted(batch)))
            order = [F.col(c) for c in arrival]
            with lake.commit() as commit:
                fresh = bronze.new_rows(hashed, lake.known_hashes(hashed), order)
                commit.append("bronze", bronze.stamp(fresh, clock()))

    return write


def ingest(
    articles: DataFrame, lake: Lake, checkpoint: str, arrival: list[str]
) -> StreamingQuery:
    """Ingest what has landed since the last run, then stop."""
    lake.create()
    return (
        articles.writeStream.foreachBatch(bronze_writer(lake, arrival))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
