"""Bronze: append-only article store with insert-or-ignore on the content hash."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremere.functions import text, times
from wiremere.operators.ranking import first_keys, pick

HASH = "content_hash"
PREFIX, PREFIX_CHARS = "prefix", 1  # folders of the hash index


def prefix() -> Column:
    """The beginning of a row's hash, the same share of all hashes for each value."""
    return F.left(HASH, F.lit(PREFIX_CHARS)).alias(PREFIX)


def with_hash(articles: DataFrame) -> DataFrame:
    return articles.withColumn(HASH, text.content_hash(F.col("source_url"), F.col("raw_text")))


def existing_hashes(batch: DataFrame, bronze: DataFrame) -> DataFrame:
    """Hashes of the batch that Bronze holds.

    The batch is the build side. Where it is below the broadcast threshold, the large table's hash
    column is only streamed, never shuffled. Copies in the batch are merged before they travel.
    """
    return bronze.select(HASH).join(batch.select(HASH).distinct(), HASH, "left_semi")


def new_rows(
    batch: DataFrame, bronze: DataFrame, arrival: list[Column], probe: bool = False, unique: bool = False
) -> DataFrame:
    """Insert-or-ignore: the first row per hash by arrival order, minus hashes Bronze holds.

    Hashes and arrival decide alone; texts are read for the new rows only. Rows that tie in arrival
    must be equal; where no two rows of the batch do, `unique` spares the look for ties. With `probe`,
    for a stored batch that is small next to Bronze, Bronze is first reduced to the batch's hashes.
    """
    first = first_keys(batch, [HASH], arrival)
    stored = existing_hashes(batch, bronze) if probe else bronze.select(HASH)
    return pick(batch, first.join(stored, HASH, "left_anti"), [HASH], arrival, unique)


def stamp(articles: DataFrame, run_at: datetime) -> DataFrame:
    """Bronze rows of hashed articles: id from the hash, one timestamp for the whole run."""
    return articles.select(
        text.derived_id("bronze", F.col(HASH)).alias("id"),
        HASH,
        "source_name",
        "source_url",
        "title",
        "raw_text",
        F.coalesce("raw_metadata", F.lit("{}")).alias("raw_metadata"),
        times.instant(run_at).alias("ingested_at"),
    )


def dedup_report(batch: DataFrame, bronze: DataFrame) -> DataFrame:
    """One row: batch size, rows that are new, duplicates inside the batch and of Bronze."""
    per_hash = batch.groupBy(HASH).agg(F.count("*").alias("rows"))
    stored = existing_hashes(batch, bronze).distinct().withColumn("stored", F.lit(1))
    return (
        per_hash.join(stored, HASH, "left")
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("batch_rows"),
            F.count_if(F.col("stored").isNull()).alias("inserted"),
            F.count("stored").alias("hashes_stored_before"),
        )
        .withColumn("duplicates", F.col("batch_rows") - F.col("inserted"))
    )
