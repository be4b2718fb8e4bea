"""A document archive: filtered scan and the mapping of search documents to articles."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wiremere.functions import documents, text
from wiremere.operators import feeds
from wiremere.schemas import ARCHIVE_DOCUMENT

ARCHIVE_NAME = "archive"


def scan(
    articles: DataFrame,
    query: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    sources: Sequence[str] | None = None,
    max_results: int | None = None,
    date_column: str = "ingested_at",
    source_column: str = "source_name",
    tiebreak: str = "id",
) -> DataFrame:
    """Articles in a date range (both days included), of some sources, holding a phrase.

    Date and source tests reach the Parquet scan. `max_results`, where given, keeps the oldest, in no
    order: they are chosen by time and `tiebreak`, which is unique, and their texts stay where they lie.
    """
    found = articles
    if date_from is not None:
        found = found.filter(F.col(date_column) >= F.lit(date_from).cast("timestamp_ntz"))
    if date_to is not None:
        end = F.lit(date_to).cast("date") + F.expr("INTERVAL 1 DAY")
        found = found.filter(F.col(date_column) < end.cast("timestamp_ntz"))
    if "ingest_date" in found.columns and date_column == "ingested_at":  # whole partitions of a stored table
        if date_from is not None:
            found = found.filter(F.col("ingest_date") >= F.lit(date_from).cast("date"))
        if date_to is not None:
            found = found.filter(F.col("ingest_date") <= F.lit(date_to).cast("date"))
    if sources is not None:
        found = found.filter(F.col(source_column).isin(list(sources)))
    if query:
        found = found.filter(text.keyword_match(query, F.col("title"), F.col("raw_text")))
    if max_results is None:
        return found
    oldest = [F.col(date_column).asc_nulls_last(), F.col(tiebreak).asc()]
    keys = found.orderBy(*oldest).limit(max_results).select(F.col(tiebreak).alias("_key"))
    return found.join(keys, F.col(tiebreak) == F.col("_key"), "left_semi")


def normalise(found: DataFrame, source_name: str = ARCHIVE_NAME) -> DataFrame:
    """Search documents as articles, with the reason to reject them, if any."""
    metadata = documents.archive_metadata(
        F.col("Source.Id"), F.col("Source.Name"), F.col("Date"), F.col("DocumentType")
    )
    return feeds.check_contract(
        found.select(
            F.lit(source_name).alias("source_name"),
            F.col("ResultUrl").alias("source_url"),
            F.col("Title").alias("title"),
            F.coalesce("Document.Content", F.lit("")).alias("raw_text"),
            metadata.alias("raw_metadata"),
            F.struct("Date", "ResultUrl").alias("arrival"),
        )
    )


def read_archive(
    spark: SparkSession,
    paths: str | list[str],
    query: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    sources: Sequence[str] | None = None,
    max_results: int | None = None,
) -> DataFrame:
    """Articles of landed search replies, one JSON document a line.

    Dates compare as ISO texts, sources by their id.
    """
    found = spark.read.schema(ARCHIVE_DOCUMENT).json(paths)
    if date_from is not None:
        found = found.filter(F.col("Date") >= date_from)
    if date_to is not None:
        found = found.filter(F.left("Date", F.lit(len(date_to))) <= date_to)
    if sources is not None:
        found = found.filter(F.col("Source.Id").isin(list(sources)))
    if query:
        found = found.filter(text.keyword_match(query, F.col("Title"), F.col("Document.Content")))
    if max_results is not None:
        found = found.orderBy(F.col("Date").asc_nulls_last(), F.col("ResultUrl").asc_nulls_last())
        found = found.limit(max_results)
    return normalise(found)
