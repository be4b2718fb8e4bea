"""A small cube of Silver, from which all counts and means of an export derive.

A cell holds the signals of one category, sentiment, action flag and day (UTC), NULL being a value of
each. Cells add up: counts and sums are kept instead of means. The number of cells grows with the days,
not with the signals, and the frames made of them equal those that `gold` makes of the signals.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiremere.functions import labels
from wiremere.operators import gold

AXES = ["signal_category", "sentiment", "action_required", "extracted_date"]


def cube(signals: DataFrame) -> DataFrame:
    """One row per cell: signals, rated signals, their summed confidence, latest signal."""
    confidence = F.col("confidence_score").cast("double")
    return signals.withColumn("extracted_date", F.to_date("extracted_at")).groupBy(*AXES).agg(
        F.count("*").alias("signals"),
        F.count("confidence_score").alias("rated"),
        F.sum(confidence).alias("confidence"),
        F.max("extracted_at").alias("latest"),
    )


def _counts(cells: DataFrame, *keys: str) -> DataFrame:
    return cells.groupBy(*keys).agg(F.sum("signals").alias("count"))


def signal_counts(cells: DataFrame) -> DataFrame:
    return cells.groupBy("signal_category").agg(
        F.sum("signals").alias("total_signals"),
        F.sum(F.when(F.col("action_required"), F.col("signals")).otherwise(0)).alias("action_items"),
        F.try_divide(F.sum("confidence"), F.sum("rated")).alias("avg_confidence"),
        F.max("latest").alias("latest_signal_at"),
    )


def sentiment_distribution(cells: DataFrame) -> DataFrame:
    return gold.ordered_sentiments(_counts(cells, "sentiment"))


def action_breakdown(cells: DataFrame) -> DataFrame:
    return gold.labelled_actions(_counts(cells, "action_required"))


def _labelled(cells: DataFrame) -> DataFrame:
    return cells.withColumn("category_label", labels.category_label(F.col("signal_category")))


def category_sentiment(cells: DataFrame) -> DataFrame:
    keys = ["category_label", "sentiment"]
    return _counts(_labelled(cells).dropna(subset=keys), *keys)


def sentiment_trend(cells: DataFrame) -> DataFrame:
    """Mean sentiment per day and category, in date order."""
    keys = ["day", "category_label"]
    rows = _labelled(cells).withColumns(
        {
            "day": F.date_format("extracted_date", "yyyy-MM-dd"),
            "score": labels.sentiment_score(F.col("sentiment")) * F.col("signals"),
        }
    )
    mean = (F.sum("score") / F.sum("signals")).alias("avg_sentiment")
    return rows.dropna(subset=keys).groupBy(*keys).agg(mean).orderBy(*keys)


def dashboard_header(cells: DataFrame) -> DataFrame:
    """One row: number of signals and of categories."""
    per_category = _counts(cells, "signal_category")
    return per_category.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("signals"),
        F.count("signal_category").alias("categories"),
    )
