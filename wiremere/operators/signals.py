"""Row-level views of Silver signals: enrichment, feeds, lists, periods."""

from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremere.functions import labels, text, times
from wiremere.schemas import FACT_SIGNALS


def newest_first() -> list[Column]:
    """Newest first; the id makes the order, and thus every top-k, unique."""
    return [F.col("extracted_at").desc_nulls_last(), F.col("id").asc()]


def enrich(signals: DataFrame) -> DataFrame:
    """Add label, sentiment score, date, month, week and day."""
    at = F.col("extracted_at")
    return signals.withColumns(
        {
            "category_label": labels.category_label(F.col("signal_category")),
            "sentiment_score": labels.sentiment_score(F.col("sentiment")),
            "extracted_date": F.to_date(at),
            "year_month": times.year_month(at),
            "year_week": times.year_week(at),
            "day": times.day(at),
        }
    )


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """The wanted columns that the frame has."""
    return df.select([c for c in columns if c in df.columns])


def fact_signals(enriched: DataFrame) -> DataFrame:
    return present(enriched, FACT_SIGNALS.names)


def in_category(signals: DataFrame, category: str) -> DataFrame:
    return signals.filter(F.col("signal_category") == category)


def category_feed(signals: DataFrame, category: str) -> DataFrame:
    return in_category(signals, category).orderBy(*newest_first())


def latest_in_category(signals: DataFrame, category: str, limit: int) -> DataFrame:
    return (
        category_feed(signals, category)
        .limit(limit)
        .select("id", "title", "summary", "confidence_score", "extracted_at")
    )


def action_items(signals: DataFrame) -> DataFrame:
    return (
        signals.filter("action_required")
        .orderBy(*newest_first())
        .select("id", "title", "signal_category", "summary", "source_url")
    )


def intelligence_feed(signals: DataFrame) -> DataFrame:
    """Every signal for the analyst's sheet, action items first, then newest."""
    ordered = signals.orderBy(F.col("action_required").desc_nulls_last(), *newest_first())
    return ordered.select(
        "id",
        F.to_date("extracted_at").alias("date"),
        labels.category_label(F.col("signal_category")).alias("category"),
        "summary",
        labels.shown_sentiment(F.col("sentiment")).alias("sentiment"),
        F.round(F.col("confidence_score").cast("double") * 100, 1).alias("confidence_pct"),
        "action_required",
        "title",
        "source_url",
        text.is_link(F.col("source_url")).alias("has_link"),
    )


def news_rows(enriched: DataFrame) -> DataFrame:
    """The columns of a news table."""
    return enriched.select(
        "id",
        "day",
        "category_label",
        "title",
        text.preview(F.col("summary")).alias("summary"),
        "sentiment",
        F.coalesce("action_required", F.lit(False)).alias("action"),
        "source_url",
    )


def news_table(enriched: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Signals newest first, shaped for a news table; the newest `max_rows` where that is given."""
    ordered = enriched.orderBy(*newest_first())
    return news_rows(ordered if max_rows is None else ordered.limit(max_rows))


# The period filters give the scan a range on extracted_at, which Parquet statistics can use, and on a
# stored table one on its day column, which leaves out whole partitions.

def _between(signals: DataFrame, *ranges: tuple[date, date]) -> DataFrame:
    """Signals of some ranges of days, the end excluded."""
    at, days = F.col("extracted_at"), [F.col("extracted_date")] if "extracted_date" in signals.columns else []
    tests = []
    for start, end in ranges:
        first, after = (F.lit(d.isoformat()).cast("timestamp_ntz") for d in (start, end))
        tests.append((at >= first) & (at < after))
    found = signals.filter(reduce(or_, tests))
    for day in days:
        found = found.filter(reduce(or_, [(day >= F.lit(s)) & (day < F.lit(e)) for s, e in ranges]))
    return found


def of_month(signals: DataFrame, as_of: date) -> DataFrame:
    start = as_of.replace(day=1)
    return _between(signals, (start, (start + timedelta(days=32)).replace(day=1)))


def week_ranges(as_of: date) -> list[tuple[date, date]]:
    """The days of the calendar year with the same ISO week number, as the week string compares.

    That is one week, or two parts of weeks at the two ends of the year.
    """
    days = [date(as_of.year, 1, 1) + timedelta(days=n) for n in range(366)]
    days = [d for d in days if d.year == as_of.year and d.isocalendar().week == as_of.isocalendar().week]
    starts = [d for d in days if d - timedelta(days=1) not in days]
    ends = [d + timedelta(days=1) for d in days if d + timedelta(days=1) not in days]
    return list(zip(starts, ends, strict=True))


def of_week(signals: DataFrame, as_of: date) -> DataFrame:
    return _between(signals, *week_ranges(as_of))


def of_day(signals: DataFrame, as_of: date) -> DataFrame:
    return _between(signals, (as_of, as_of + timedelta(days=1)))


PERIODS = {"month": of_month, "week": of_week, "day": of_day}


def timeline(signals: DataFrame, period: str, as_of: date) -> DataFrame:
    """Signals of the month, week or day that holds `as_of`, newest first."""
    return PERIODS[period](signals, as_of).orderBy(*newest_first())
