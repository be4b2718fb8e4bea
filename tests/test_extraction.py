"""Extraction, routing and Silver rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wiremere.operators import extraction
from wiremere.operators import status

AT = datetime(2024, 1, 2)


@pytest.fixture
def articles(frame):
    def make(*texts):
        return frame(
            "id string, source_name string, source_url string, title string, raw_text string",
            [(str(i), "s", f"http://{i}", f"title {i}", t) for i, t in enumerate(texts)],
        )

    return make


def by_id(df):
    return {r["bronze_id"]: r for r in df.collect()}


@pytest.fixture
def make_model():
    def make():
        def reply(prompt):
            if "crash" in prompt:
                raise ValueError("model crashed" + "!" * 600)
            if "garbage" in prompt:
                return "garbage"
            relevant = "news" in prompt
            return json.dumps(
                {"is_relevant": relevant, "signal_category": "Broker_Dynamics", "summary": "s"}
            )

        return lambda prompts: [reply(p) for p in prompts]

    return make


def test_routing_of_a_plugged_in_model(articles, make_model):
    batch = articles("news", "chatter", "garbage", "crash", None)
    routed = extraction.route(extraction.model_payloads(batch, make_model, "m-1", tasks=1))
    rows = by_id(routed)
    assert [rows[str(i)]["outcome"] for i in range(5)] == ["silver", "noise", "failed", "failed", "failed"]
    assert rows["2"]["error"] == "Signal extraction failed: payload is not a JSON object"
    assert rows["3"]["error"].startswith("Signal extraction failed: model crashed!") and len(rows["3"]["error"]) > 500, "whole"
    assert rows["4"]["error"] == "Unexpected: raw_text is null"
    counts = {r["outcome"]: r["records"] for r in extraction.batch_outcome(routed).collect()}
    assert counts == {"silver": 1, "noise": 1, "failed": 3}


def test_short_reply_fails_row_by_row(articles):
    def make_lossy():
        return lambda prompts: ['{"is_relevant": false}'] * min(1, len(prompts))

    rows = by_id(extraction.route(extraction.model_payloads(articles("a", "b"), make_lossy, "m", tasks=1)))
    assert {r["outcome"] for r in rows.values()} == {"noise"}


def test_silver_defaults_and_lineage(articles):
    payload = '{"is_relevant": true, "signal_category": "Emerging_Risks", "summary": "s", "odd": 1}'
    df = articles("x").select(
        F.col("id").alias("bronze_id"), "source_name", "source_url", "title",
        F.lit(payload).alias("payload"), F.lit("m-1").alias("llm_model"),
    )
    row = extraction.silver_rows(extraction.route(df), AT).first()
    assert (row["key_entities"], row["sentiment"], row["confidence_score"]) == ("[]", "NEUTRAL", 0.0)
    assert row["action_required"] is False and row["raw_llm_response"] == payload
    assert (row["bronze_id"], row["title"], row["llm_model"]) == ("0", "title 0", "m-1")
    again = extraction.silver_rows(extraction.route(df), datetime(2025, 1, 1)).first()
    assert again["id"] == row["id"], "a retry must not make a second signal"


def test_replayed_signals_are_not_stored_twice(frame):
    batch = frame("bronze_id string, id string", [("1", "a"), ("2", "b")])
    silver = frame("bronze_id string", [("1",), ("7",)])
    assert [r["id"] for r in extraction.not_yet_stored(batch, silver).collect()] == ["b"]


def test_lexicon(articles):
    texts = [
        "Swiss Re and Aon discuss capacity changes",
        "Munich Re, Marsh",
        "Football",
        "Cyber cyber cyber losses at Munich Re and Swiss Re",
    ]
    rows = by_id(extraction.classify(articles(*texts)).withColumnRenamed("id", "bronze_id"))
    got = [(rows[str(i)]["signal_category"], round(rows[str(i)]["confidence"], 3)) for i in range(4)]
    assert got == [
        ("Broker_Dynamics", 0.667),
        ("Broker_Dynamics", 0.5),
        (None, 0.0),
        ("Competitor_Strategy", 0.667),
    ]
    assert rows["3"]["hits"] == ["Munich Re", "Swiss Re", "cyber"]


def test_lexicon_reads_whole_texts(articles):
    late = "word " * 50_000 + "Swiss Re"
    assert extraction.classify(articles(late)).first()["signal_category"] == "Competitor_Strategy"


def test_lexicon_payloads_are_valid(articles):
    batch = articles("Swiss Re downgraded by Fitch", "Football", "Aon at Munich Re downgraded by Fitch", None)
    rows = by_id(extraction.route(extraction.lexicon_payloads(batch)))
    assert [rows[str(i)]["outcome"] for i in range(4)] == ["silver", "noise", "silver", "failed"]
    assert rows["0"]["action_required"] is True and rows["0"]["key_entities"] == ["Swiss Re"]
    assert rows["2"]["action_required"] is False, "the gate holds back actions below 0.70"
    assert rows["0"]["summary"] == "title 0"


def test_signal_to_noise(frame):
    df = frame("relevant boolean, predicted boolean", [(True, True)] * 3 + [(True, False)] + [(False, True)] + [(False, False)] * 5)
    row = extraction.signal_to_noise(df).first()
    assert (row["articles"], row["relevant"], row["predicted"]) == (10, 4, 4)
    assert (row["precision"], row["recall"], row["sn_before"]) == (0.75, 0.75, 0.4)
    assert row["sn_after"] == pytest.approx(0.75 * 4 / (0.75 * 4 + 0.25 * 6))
    empty = extraction.signal_to_noise(df.limit(0)).first()
    assert (empty["articles"], empty["precision"], empty["sn_before"]) == (0, 0.0, None)


def test_status_rows_carry_outcome_and_error(frame):
    routed = frame("bronze_id string, outcome string, error string", [("1", "failed", "e"), ("2", "noise", None)])
    rows = extraction.status_rows(routed, AT, "run").collect()
    assert [(r["status"], r["error"], r["run_id"]) for r in rows] == [("failed", "e", "run"), ("noise", None, "run")]
    assert status.DONE == ["silver", "noise", "failed"]
