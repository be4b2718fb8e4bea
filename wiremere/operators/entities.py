"""Entity mentions and the charts built on them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremere import constants as C
from wiremere.functions import documents, labels, text
from wiremere.operators import signals as sig


def mentions(signals: DataFrame, *carry: str) -> DataFrame:
    """One row per entity mention, repeats kept.

    `carry` names signal columns to keep beside the mention, which saves the join back to signals.
    """
    return signals.select(
        F.col("id").alias("signal_id"),
        F.explode(documents.entity_list(F.col("key_entities"))).alias("entity_name"),
        labels.entity_type(F.col("signal_category")).alias("entity_type"),
        F.col("signal_category").alias("category"),
        *carry,
    )


def with_signals(entities: DataFrame, signals: DataFrame, *columns: str) -> DataFrame:
    """Mentions of a stored star schema joined to their signals."""
    facts = signals.select(F.col("id").alias("signal_id"), *columns)
    return entities.join(facts, "signal_id")


def of_type(entities: DataFrame, kind: str) -> DataFrame:
    return entities.filter((F.col("entity_type") == kind) & F.col("entity_name").isNotNull())


def competitor_activity(joined: DataFrame) -> DataFrame:
    """Mentions per competitor and category. Wants signal_category beside the mention."""
    return (
        of_type(joined, "Competitor")
        .filter(F.col("signal_category").isNotNull())
        .groupBy("entity_name", "signal_category")
        .agg(F.count("*").alias("count"))
    )


def risk_week(joined: DataFrame) -> DataFrame:
    """Mentions and mean sentiment per risk and week. Wants year_week and sentiment_score."""
    return (
        of_type(joined, "Risk")
        .filter((F.col("signal_category") == C.RISK) & F.col("year_week").isNotNull())
        .groupBy("entity_name", "year_week")
        .agg(F.count("*").alias("count"), F.avg("sentiment_score").alias("avg_sent"))
    )


def title_week(risk_signals: DataFrame) -> DataFrame:
    """The stand-in for `risk_week` where signals name no entities: counts per title."""
    keys = ["title", "year_week"]
    return (
        sig.in_category(risk_signals, C.RISK)
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count("*").alias("count"))
    )


def weeks_of(counts: DataFrame) -> list[str]:
    """The weeks of a heat map, at most some fifty a year."""
    return [r[0] for r in counts.select("year_week").distinct().orderBy("year_week").collect()]


def heat_map(counts: DataFrame, row: str, weeks: list[str] | None = None) -> DataFrame:
    """One row per entity or title, one column per week, 0 where there is no mention."""
    weeks = weeks_of(counts) if weeks is None else weeks
    return counts.groupBy(row).pivot("year_week", weeks).agg(F.sum("count")).na.fill(0)


def _matrix(rows: DataFrame, entity: Column) -> DataFrame:
    return (
        rows.withColumn("entity", entity)
        .filter(F.col("entity").isNotNull())
        .groupBy("entity")
        .agg(
            F.count("*").alias("count"),
            F.avg("sentiment_score").alias("avg_sent"),
            F.count_if("action_required").alias("actions"),
        )
        .withColumn("bubble_size", (F.col("actions") + 1) * 15)
    )


def broker_matrix(joined: DataFrame) -> DataFrame:
    """Mentions, mean sentiment, actions and bubble size per broker."""
    mine = of_type(joined, "Broker").filter(F.col("signal_category") == C.BROKER)
    return _matrix(mine, F.col("entity_name"))


def broker_matrix_by_title(enriched: DataFrame, title_chars: int | None = None) -> DataFrame:
    """The stand-in for `broker_matrix` where signals name no entities: one point per title.

    With `title_chars`, titles that begin alike share a point.
    """
    title = F.col("title")
    point = title if title_chars is None else text.preview(title, title_chars)
    return _matrix(sig.in_category(enriched, C.BROKER), point)
