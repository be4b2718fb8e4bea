"""Report, dashboard and star-schema datasets as Parquet.

An export stores two tables first: the columns of Silver that it shows, without the replies of models, and
the cube of their counts. All frames read one of the two, so Silver is read once, whatever their number.
"""

from datetime import date

from pyspark.sql import DataFrame

from wiremere import constants as C
from wiremere.operators import cube, entities, gold
from wiremere.operators import signals as sig
from wiremere.session import materialise

# What the frames show of Silver.
SHOWN = [
    "id",
    "signal_category",
    "title",
    "summary",
    "key_entities",
    "sentiment",
    "confidence_score",
    "action_required",
    "source_url",
    "source_name",
    "extracted_at",
]


def snapshot(signals: DataFrame) -> DataFrame:
    """The shown columns of Silver, stored: the one read of Silver that an export makes."""
    return materialise(sig.present(signals, SHOWN))


def cells_of(signals: DataFrame) -> DataFrame:
    """The stored cube."""
    return materialise(cube.cube(signals))


def star_frames(signals: DataFrame) -> dict[str, DataFrame]:
    return {
        "fact_signals": sig.fact_signals(sig.enrich(signals)),
        "dim_entities": entities.mentions(signals),
    }


def report_frames(signals: DataFrame, cells: DataFrame | None = None) -> dict[str, DataFrame]:
    """The two sheets of the workbook: executive dashboard and intelligence feed."""
    cells = cells_of(signals) if cells is None else cells
    per_category = cube.signal_counts(cells)
    return {
        "gold_report": gold.report_of(per_category),
        "gold_grand_total": gold.grand_total_of(per_category),
        "kpi_cards": gold.kpi_cards_of(per_category),
        "sentiment_share": gold.with_share(cube.sentiment_distribution(cells)),
        "action_share": gold.with_share(cube.action_breakdown(cells)),
        "intelligence_feed": sig.intelligence_feed(signals),
    }


def risk_counts(enriched: DataFrame) -> tuple[DataFrame, str]:
    """Heat map counts and their row key: entities, or titles where no risk has an entity.

    The counts are stored: the test, the list of weeks, the long and the wide form all read them.
    """
    joined = entities.mentions(enriched, "signal_category", "year_week", "sentiment_score")
    by_entity = materialise(entities.risk_week(joined))
    if by_entity.isEmpty():
        return materialise(entities.title_week(enriched)), "title"
    return by_entity, "entity_name"


def broker_points(enriched: DataFrame) -> DataFrame:
    """Broker matrix by entity, or by title where no broker signal has an entity."""
    joined = entities.mentions(enriched, "signal_category", "sentiment_score", "action_required")
    if entities.of_type(joined, "Broker").isEmpty():
        return entities.broker_matrix_by_title(enriched)
    return entities.broker_matrix(joined)


def dashboard_frames(signals: DataFrame, as_of: date, cells: DataFrame | None = None) -> dict[str, DataFrame]:
    """The datasets of the five dashboard pages. Each reads only the columns it needs."""
    cells = cells_of(signals) if cells is None else cells
    enriched = sig.enrich(signals)
    competitors = entities.mentions(enriched, "signal_category")
    risks, row = risk_counts(enriched)
    frames = {
        "header": cube.dashboard_header(cells),
        "competitor_activity": entities.competitor_activity(competitors),
        "risk_week": risks,
        "risk_heat_map": entities.heat_map(risks, row),
        "broker_matrix": broker_points(enriched),
        "category_sentiment": cube.category_sentiment(cells),
        "sentiment_trend": cube.sentiment_trend(cells),
    }
    for name, category in {"competitor": C.COMPETITOR, "risk": C.RISK, "broker": C.BROKER}.items():
        frames[f"{name}_news"] = sig.news_table(sig.in_category(enriched, category))
    for period, select in sig.PERIODS.items():
        frames[f"timeline_{period}"] = sig.news_table(select(enriched, as_of))
    return frames


def write_frames(frames: dict[str, DataFrame], folder: str) -> list[str]:
    """Write every frame to its own folder, replacing what is there."""
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")
    return list(frames)


def export_star(signals: DataFrame, folder: str) -> list[str]:
    return write_frames(star_frames(signals), folder)


def export_report(signals: DataFrame, folder: str) -> list[str]:
    return _report(*_stored(signals), folder)


def export_dashboard(signals: DataFrame, folder: str, as_of: date) -> list[str]:
    """Write star schema and dashboard pages; nothing where there are no signals."""
    return _dashboard(*_stored(signals), folder, as_of)


def export_all(signals: DataFrame, folder: str, as_of: date) -> list[str]:
    """Write the report and the dashboard from one read of Silver."""
    shown, cells = _stored(signals)
    return _report(shown, cells, f"{folder}/report") + _dashboard(shown, cells, f"{folder}/dashboard", as_of)


def _stored(signals: DataFrame) -> tuple[DataFrame, DataFrame]:
    shown = snapshot(signals)
    return shown, cells_of(shown)


def _report(shown: DataFrame, cells: DataFrame, folder: str) -> list[str]:
    return write_frames(report_frames(shown, cells), folder)


def _dashboard(shown: DataFrame, cells: DataFrame, folder: str, as_of: date) -> list[str]:
    if cells.isEmpty():
        return []
    return export_star(shown, f"{folder}/star") + write_frames(
        dashboard_frames(shown, as_of, cells), f"{folder}/pages"
    )
