"""Gold, entity and list operators on rows where the exact rules show."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wiremere import constants as C
from wiremere import schemas
from wiremere.operators import entities, gold
from wiremere.operators import signals as sig
from wiremere.plans import exports

NOW = datetime(2024, 1, 3, 10, 30)


@pytest.fixture
def signals(frame):
    def make(*rows):
        """Rows of (category, entities, sentiment, confidence, action[, title[, time]])."""
        full = []
        for i, row in enumerate(rows):
            category, names, sentiment, confidence, action, *rest = row
            title = rest[0] if rest else f"t{i}"
            at = rest[1] if len(rest) > 1 else NOW
            full.append((str(i), str(i), "s", "http://x", title, category, "sum", names, sentiment,
                         confidence, action, at, "m", "{}"))
        return frame(schemas.SILVER.simpleString().removeprefix("struct<").removesuffix(">"), full)

    return make


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_total_confidence_is_the_mean_of_category_means(signals):
    df = signals(
        (C.RISK, "[]", "MIXED", 0.5, True),
        (C.RISK, "[]", "MIXED", 0.5, None),
        (C.RISK, "[]", "MIXED", 0.5, False),
        (C.BROKER, "[]", None, 1.0, False),
    )
    total = gold.grand_total(df).filter("category = 'GRAND TOTAL'").first()
    assert (total["total_signals"], total["action_items"]) == (4, 1)
    assert (total["avg_confidence_pct"], total["weighted_avg_confidence_pct"]) == (75.0, 62.5)
    assert gold.kpi_cards(df).first()["avg_confidence_pct"] == 75.0


def test_kpis_of_nothing_are_zero(signals, spark):
    nothing = schemas.empty(spark, schemas.SILVER)
    assert tuple(gold.kpi_cards(nothing).first()) == (0, 0, 0.0)
    assert gold.grand_total(nothing).isEmpty()
    assert tuple(gold.dashboard_header(nothing).first()) == (0, 0)


def test_null_action_is_a_second_monitor_row(signals):
    df = signals(*[(C.RISK, "[]", None, 0.1, a) for a in (True, False, None, None)])
    got = rows(gold.action_breakdown(df), "action_required", "status", "count")
    assert got == [(True, "Action Required", 1), (False, "Monitor", 1), (None, "Monitor", 2)]
    shares = rows(gold.with_share(gold.action_breakdown(df)), "share_pct")
    assert sorted(s for (s,) in shares) == [25.0, 25.0, 50.0]


def test_null_groups_stay_in_sql_counts_and_leave_frame_counts(signals):
    df = signals((C.RISK, "[]", None, 0.1, True), (C.RISK, "[]", "MIXED", 0.1, True), (None, "[]", "MIXED", 0.1, True))
    assert rows(gold.sentiment_distribution(df), "sentiment", "count") == [("MIXED", 2), (None, 1)]
    assert rows(gold.category_sentiment(sig.enrich(df)), "category_label", "sentiment", "count") == [
        ("Emerging Risks", "MIXED", 1)
    ]
    assert tuple(gold.dashboard_header(df).first()) == (3, 1)


def test_feed_puts_actions_first_and_nulls_last(signals):
    df = signals(
        (C.RISK, "[]", "mixed", 0.12345, None),
        (C.RISK, "[]", None, 0.5, False),
        (C.RISK, "[]", None, 0.5, True, "x", datetime(2020, 1, 1)),
        (C.RISK, "[]", None, 0.5, True),
    )
    got = rows(sig.intelligence_feed(df), "id", "sentiment", "confidence_pct")
    assert got == [("3", "NEUTRAL", 50.0), ("2", "NEUTRAL", 50.0), ("1", "NEUTRAL", 50.0), ("0", "MIXED", 12.3)]


def test_mentions(signals):
    df = signals(
        (C.COMPETITOR, '["A","A"]', None, 0.1, True),
        (C.BROKER, "bad", None, 0.1, True),
        (C.RISK, '{"a":1}', None, 0.1, True),
        (C.BROKER, None, None, 0.1, True),
        ("Other", '["B"]', None, 0.1, True),
    )
    got = rows(entities.mentions(df), *schemas.DIM_ENTITIES.names)
    assert got == [("0", "A", "Competitor", C.COMPETITOR)] * 2 + [("4", "B", "Risk", "Other")]


def test_carried_and_joined_mentions_agree(signals):
    df = signals(
        (C.COMPETITOR, '["A","A","B"]', None, 0.1, True),
        (C.COMPETITOR, '["A"]', None, 0.1, True),
        (C.BROKER, '["A"]', None, 0.1, True),
    )
    carried = entities.competitor_activity(entities.mentions(df, "signal_category"))
    joined = entities.competitor_activity(
        entities.with_signals(entities.mentions(df), df, "signal_category")
    )
    want = [("A", C.COMPETITOR, 3), ("B", C.COMPETITOR, 1)]
    assert sorted(map(tuple, carried.collect())) == sorted(map(tuple, joined.collect())) == want


def test_heat_map_fills_gaps(signals):
    df = signals(
        (C.RISK, '["Flood"]', "POSITIVE", 0.1, True, "t", datetime(2024, 1, 3)),
        (C.RISK, '["Flood","Cyber"]', "NEGATIVE", 0.1, True, "t", datetime(2024, 1, 10)),
        (C.RISK, '["Flood"]', "NEGATIVE", 0.1, True, "t", datetime(2024, 1, 11)),
    )
    counts, row = exports.risk_counts(sig.enrich(df))
    assert row == "entity_name"
    flood = counts.filter("entity_name = 'Flood' AND year_week = '2024-W02'").first()
    assert (flood["count"], flood["avg_sent"]) == (2, -1.0)
    heat = entities.heat_map(counts, row)
    assert heat.columns == ["entity_name", "2024-W01", "2024-W02"]
    assert sorted(map(tuple, heat.collect())) == [("Cyber", 0, 1), ("Flood", 1, 2)]


def test_pages_fall_back_to_titles(signals):
    df = sig.enrich(signals(
        (C.RISK, "[]", "MIXED", 0.1, True, "storm"),
        (C.RISK, "bad", "MIXED", 0.1, True, None),
        (C.BROKER, "[]", "POSITIVE", 0.1, True, "x" * 40),
        (C.BROKER, "[]", "NEGATIVE", 0.1, None, "x" * 35),
    ))
    counts, row = exports.risk_counts(df)
    assert (row, rows(counts, "title", "count")) == ("title", [("storm", 1)])
    whole = sorted(tuple(p) for p in exports.broker_points(df).collect())
    assert whole == [("x" * 35, 1, -1.0, 0, 15), ("x" * 40, 1, 1.0, 1, 30)]
    point = entities.broker_matrix_by_title(df, 30).collect()
    assert [tuple(p) for p in point] == [("x" * 30, 2, 0.0, 1, 30)]


def test_periods(signals):
    times = [
        datetime(2024, 1, 1), datetime(2024, 1, 7, 23, 59), datetime(2024, 1, 8),
        datetime(2024, 12, 30), datetime(2024, 2, 1), datetime(2023, 1, 3),
    ]
    df = signals(*[(C.RISK, "[]", None, 0.1, True, "t", t) for t in times])
    pick = lambda period, day: sorted(r["id"] for r in sig.timeline(df, period, day).collect())
    assert pick("month", date(2024, 1, 31)) == ["0", "1", "2"]
    assert pick("month", date(2024, 12, 1)) == ["3"]
    assert pick("week", date(2024, 1, 3)) == ["0", "1", "3"], "the year stays the calendar's"
    assert pick("day", date(2024, 1, 7)) == ["1"]
    by_string = [i for i, t in enumerate(times) if t.strftime("%Y-W%V") == "2024-W01"]
    assert by_string == [0, 1, 3]


def test_lists(signals):
    df = signals(
        (C.RISK, "[]", None, 0.1, True, "old", datetime(2024, 1, 1)),
        (C.RISK, "[]", None, 0.1, None, "new", datetime(2024, 1, 2)),
        (C.BROKER, "[]", None, 0.1, False, "b", datetime(2024, 1, 3)),
    )
    assert rows(sig.latest_in_category(df, C.RISK, 1), "title") == [("new",)]
    assert rows(sig.action_items(df), "title") == [("old",)]
    assert rows(sig.category_feed(df, C.RISK), "title") == [("new",), ("old",)]
    news = sig.news_table(sig.enrich(df), 2)
    assert rows(news, "title", "day", "action") == [("b", "2024-01-03", False), ("new", "2024-01-02", False)]


def test_star_columns(signals, spark):
    df = signals((C.RISK, '["A"]', "MIXED", 0.25, True))
    fact = sig.fact_signals(sig.enrich(df))
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in schemas.FACT_SIGNALS]
    assert sig.present(fact, ["id", "absent"]).columns == ["id"]
    mentions = entities.mentions(df)
    assert [(f.name, f.dataType) for f in mentions.schema] == [(f.name, f.dataType) for f in schemas.DIM_ENTITIES]


def test_empty_inputs_keep_their_columns(spark):
    nothing = schemas.empty(spark, schemas.SILVER)
    frames = {**exports.star_frames(nothing), **exports.report_frames(nothing)}
    frames |= exports.dashboard_frames(nothing, date(2024, 1, 1))
    for name, df in frames.items():
        assert df.columns, name
        if name not in ("kpi_cards", "header"):
            assert df.isEmpty(), name


def test_counts_add_up(signals):
    df = signals(*[(C.CATEGORIES[i % 3], "[]", C.SENTIMENTS[i % 4], 0.1, i % 2 == 0) for i in range(25)])
    for counts in (gold.sentiment_distribution(df), gold.action_breakdown(df), gold.category_sentiment(sig.enrich(df))):
        assert counts.agg(F.sum("count")).first()[0] == 25
