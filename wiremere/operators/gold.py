"""Gold: KPIs and distributions over Silver signals."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wiremere.functions import labels, times
from wiremere.operators import status


def _actions() -> Column:
    return F.count_if("action_required")


def _confidence() -> Column:
    return F.avg(F.col("confidence_score").cast("double"))


def signal_summary(signals: DataFrame) -> DataFrame:
    """Per category: signals, action items, mean confidence, latest signal."""
    return ordered_summary(signal_counts(signals))


def ordered_summary(per_category: DataFrame) -> DataFrame:
    return per_category.orderBy(F.col("total_signals").desc(), F.col("signal_category").asc_nulls_last())


def signal_counts(signals: DataFrame) -> DataFrame:
    """The summary without its order, as a stream in complete mode can run it."""
    return signals.groupBy("signal_category").agg(
        F.count("*").alias("total_signals"),
        _actions().alias("action_items"),
        _confidence().alias("avg_confidence"),
        F.max("extracted_at").alias("latest_signal_at"),
    )


def report(signals: DataFrame) -> DataFrame:
    """The summary as the dashboard sheet shows it, with an attention flag."""
    return report_of(signal_counts(signals))


def report_of(per_category: DataFrame) -> DataFrame:
    return ordered_summary(per_category).select(
        labels.category_label(F.col("signal_category")).alias("category"),
        "total_signals",
        "action_items",
        F.round(F.col("avg_confidence") * 100, 1).alias("avg_confidence_pct"),
        times.minute(F.col("latest_signal_at")).alias("latest_signal"),
        (F.col("action_items") > 0).alias("attention"),
    )


def grand_total(signals: DataFrame) -> DataFrame:
    """The report with a total row.

    The total's confidence is the plain mean of the rounded category means, rounded half to even;
    `weighted_avg_confidence_pct` is the mean over all signals.
    """
    return grand_total_of(signal_counts(signals))


def grand_total_of(per_category: DataFrame) -> DataFrame:
    per_category = per_category.withColumns(
        {
            "category": labels.category_label(F.col("signal_category")),
            "avg_confidence_pct": F.round(F.col("avg_confidence") * 100, 1),
            "rated": F.col("avg_confidence") * F.col("total_signals"),
        }
    )
    total = per_category.agg(
        F.sum("total_signals").alias("total_signals"),
        F.sum("action_items").alias("action_items"),
        F.bround(F.avg("avg_confidence_pct"), 1).alias("avg_confidence_pct"),
        F.round(F.try_divide(F.sum("rated"), F.sum("total_signals")) * 100, 1).alias(
            "weighted_avg_confidence_pct"
        ),
    ).filter(F.col("total_signals").isNotNull())
    columns = [
        "category", "total_signals", "action_items", "avg_confidence_pct",
        "weighted_avg_confidence_pct",
    ]
    rows = per_category.withColumn("weighted_avg_confidence_pct", F.col("avg_confidence_pct"))
    return rows.select(columns).unionByName(
        total.withColumn("category", F.lit("GRAND TOTAL")).select(columns)
    )


def kpi_cards(signals: DataFrame) -> DataFrame:
    """One row: total signals, action items, mean of category confidences; zeros without signals."""
    return kpi_cards_of(signal_counts(signals))


def kpi_cards_of(per_category: DataFrame) -> DataFrame:
    per_category = per_category.withColumn("pct", F.round(F.col("avg_confidence") * 100, 1))
    return per_category.agg(
        F.coalesce(F.sum("total_signals"), F.lit(0)).alias("total_signals"),
        F.coalesce(F.sum("action_items"), F.lit(0)).alias("action_items"),
        F.coalesce(F.bround(F.avg("pct"), 1), F.lit(0.0)).alias("avg_confidence_pct"),
    )


def sentiment_distribution(signals: DataFrame) -> DataFrame:
    return ordered_sentiments(signals.groupBy("sentiment").agg(F.count("*").alias("count")))


def ordered_sentiments(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.col("count").desc(), F.col("sentiment").asc_nulls_last())


def action_breakdown(signals: DataFrame) -> DataFrame:
    """Counts per action flag. NULL and FALSE are two groups that share the label Monitor."""
    return labelled_actions(signals.groupBy("action_required").agg(F.count("*").alias("count")))


def labelled_actions(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.col("action_required").desc_nulls_last()).select(
        "action_required", labels.action_label(F.col("action_required")).alias("status"), "count"
    )


def with_share(counts: DataFrame) -> DataFrame:
    """Add each row's share of the total in percent. Wants counts per value of a closed set."""
    # One window over the few counted rows; a second aggregate would scan the signals again.
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share_pct", F.col("count") * 100.0 / total)


def category_sentiment(enriched: DataFrame) -> DataFrame:
    keys = ["category_label", "sentiment"]
    return enriched.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("count"))


def sentiment_trend(enriched: DataFrame) -> DataFrame:
    """Mean sentiment per day and category, in date order."""
    keys = ["day", "category_label"]
    trend = enriched.dropna(subset=keys).groupBy(*keys).agg(
        F.avg("sentiment_score").alias("avg_sentiment")
    )
    return trend.orderBy(*keys)


def dashboard_header(signals: DataFrame) -> DataFrame:
    """One row: number of signals and of categories. Counted per category first."""
    per_category = signals.groupBy("signal_category").agg(F.count("*").alias("n"))
    return per_category.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("signals"),
        F.count("signal_category").alias("categories"),
    )


def lake_stats(bronze: DataFrame, silver: DataFrame, log: DataFrame) -> DataFrame:
    """One row: articles, signals, dead letters (all of them, not a page)."""
    return stats_of(bronze, silver, status.current(log).filter(F.col("status") == status.FAILED))


def stats_of(bronze: DataFrame, silver: DataFrame, failed: DataFrame) -> DataFrame:
    """One row: rows of each."""
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        for name, df in {"bronze": bronze, "silver": silver, "dlq": failed}.items()
    ]

    def of(name: str) -> Column:
        return F.sum(F.when(F.col("table") == name, F.col("n")).otherwise(0)).alias(f"{name}_total")

    stacked = counts[0].unionByName(counts[1]).unionByName(counts[2])
    return stacked.agg(of("bronze"), of("silver"), of("dlq"))


def lake_gold(silver: DataFrame) -> DataFrame:
    """The summary with confidence to three places."""
    confidence = F.round(F.coalesce("avg_confidence", F.lit(0.0)), 3)
    return signal_summary(silver).select(
        "signal_category", "total_signals", "action_items", confidence.alias("avg_confidence")
    )
