"""Expressions on hand-written edge rows."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wiremere import constants as C
from wiremere.functions import documents, labels, payloads, rules, text, times


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


STRINGS = [" \tab \n", "\x1cab\x1f", "  ", "", "a b", " x　", "\x85y\xa0", "z​ ", " ", None]


def test_strip_is_python_strip(frame):
    df = frame("s string", [(s,) for s in STRINGS])
    assert values(df, text.strip(F.col("s"))) == [None if s is None else s.strip() for s in STRINGS]


def test_strip_of_long_inner_white_space_is_linear(frame):
    long = "a" + " " * 400_000 + "b  "
    assert values(frame("s string", [(long,)]), F.length(text.strip(F.col("s")))) == [400_002]


def test_content_hash_prefers_the_url(frame):
    rows = [(" http://x ", "t"), ("  ", " t "), (None, "t"), ("", "é ")]
    expected = [
        hashlib.sha256(((u or "").strip() or t.strip()).encode()).hexdigest() for u, t in rows
    ]
    df = frame("u string, t string", rows)
    assert values(df, text.content_hash(F.col("u"), F.col("t"))) == expected
    assert expected[1] == expected[2]


def test_url_parameters_count(frame):
    df = frame("u string", [("http://x?utm=1",), ("http://x",)])
    assert len(set(values(df, text.content_hash(F.col("u"), F.lit("t"))))) == 2


def test_preview_counts_characters(frame):
    df = frame("s string", [("漢" * 300,), ("ab",), (None,)])
    assert values(df, text.preview(F.col("s"))) == ["漢" * 200, "ab", None]


def test_resolve_text(frame):
    rows = [("full ", "sum", "t"), ("", " sum", "t"), (None, "", "t"), (None, None, None)]
    df = frame("c string, s string, t string", rows)
    got = values(df, text.resolve_text(F.col("c"), F.col("s"), F.col("t")))
    assert got == ["full", "sum", "t", "Untitled"]


def test_keyword_spans_title_and_summary(frame):
    rows = [("Cat", "Bond news"), ("Catbond", "x"), (None, "a"), ("x", None)]
    df = frame("t string, s string", rows)
    match = lambda q: values(df, text.keyword_match(q, F.col("t"), F.col("s")))
    assert match("CAT BOND") == [True, False, False, False]
    assert match("untitled a") == [False, False, True, False]


def test_model_input(frame):
    rows = [("body", "Head", "http://u"), ("b" * 4000, None, ""), (None, "Head", None)]
    df = frame("b string, t string, u string", rows)
    got = values(df, text.model_input(F.col("b"), F.col("t"), F.col("u"), 3072))
    assert got[0] == "HEADLINE: Head\n\nSOURCE URL: http://u\n\nARTICLE TEXT:\nbody"
    assert got[1] == "ARTICLE TEXT:\n" + "b" * 3072
    assert got[2] is None
    whole = values(df, text.model_input(F.col("b"), F.col("t"), F.col("u")))
    assert whole[1] == "ARTICLE TEXT:\n" + "b" * 4000


def test_links(frame):
    df = frame("u string", [("http://a",), ("https://a",), ("ftp://a",), (None,), ("",)])
    assert values(df, text.is_link(F.col("u"))) == [True, True, False, False, False]


@pytest.mark.parametrize(
    ("stamp", "week"),
    [
        (datetime(2024, 12, 30), "2024-W01"),
        (datetime(2021, 1, 1), "2021-W53"),
        (datetime(2023, 5, 3), "2023-W18"),
    ],
)
def test_year_week_keeps_the_calendar_year(frame, stamp, week):
    df = frame("t timestamp_ntz", [(stamp,)])
    assert values(df, times.year_week(F.col("t"))) == [week] == [stamp.strftime("%Y-W%V")]


def test_lookups(frame):
    df = frame("c string, s string", [(C.RISK, "MIXED"), ("Other", "odd"), (None, None)])
    assert values(df, labels.category_label(F.col("c"))) == ["Emerging Risks", "Other", None]
    assert values(df, labels.sentiment_score(F.col("s"))) == [0.5, 0.0, 0.0]
    assert values(df, labels.entity_type(F.col("c"))) == ["Risk", "Risk", "Risk"]
    assert values(df, labels.shown_sentiment(F.lower("s"))) == ["MIXED", "ODD", "NEUTRAL"]


def test_rounding(frame):
    df = frame("x double", [(2.25,)])
    assert values(df, F.round("x", 1)) == [2.3]
    assert values(df, F.bround("x", 1)) == [2.2]


def test_entity_list(frame):
    rows = ['["A","B"]', '["A","A"]', "bad", '{"a":1}', '"text"', "[]", None]
    df = frame("e string", [(r,) for r in rows])
    got = values(df, documents.entity_list(F.col("e")))
    assert got == [["A", "B"], ["A", "A"], [], [], [], [], []]


def test_feed_metadata_keeps_nulls_and_drops_empty_tags(frame):
    df = frame(
        "t string, u string, p string, g array<string>, a array<string>",
        [(None, "http://f", None, ["x", "", None], None)],
    )
    got = values(df, documents.feed_metadata(*[F.col(c) for c in "tupga"]))[0]
    assert json.loads(got) == {
        "feed_title": "http://f", "feed_url": "http://f", "published": None, "tags": ["x"], "authors": [],
    }


# ---- rules ----

HEADLINES = {
    "Munich Re acquires a life insurer for $6.4 billion": True,
    "Hannover Re downgraded to A by Moody's": True,
    "Hurricane nears Florida, modellers put insured loss at $18bn": True,
    "Lloyd's of London suspends the licence of a syndicate": True,
    "Munich Re expected to report record profits": False,
    "Swiss Re outlook changed to Negative by S&P": False,
    "Flooding in Germany causes significant losses": False,
    "Aon acquires an insurtech for an undisclosed sum": False,
    "Reportedly, Swiss Re to merge with a rival for $9 billion": False,
    "Floods cost $999 million": False,
    "Gen Re merges units in a $500m deal": True,
    "New ideas emerge at Gen Re for $900 million": False,
    "Earthquake bill of $1 billion": True,
    "Earthquake bill of $1 billionaire": False,
    "Acme Retail downgraded by Fitch": False,
    "BaFin intervention in a bank": False,
    "Fitch kept the rating; analysts downgrade their hopes": False,
    "FINMA revokes the licence of a reinsurer": True,
    "Rates may fall. Aon buys nothing.\nFitch downgraded Aon by a notch. More could follow.": True,
    "Fitch may have downgraded Aon. Others agree.": False,
    "A flood struck; the state declared a national emergency": True,
    "A flood struck. A national emergency is feared": False,
    "Aon was named. Fitch downgraded a retailer.": False,
    None: None,
}


def test_action_rules(frame):
    from wiremere.operators.extraction import flag_actions

    df = frame("raw_text string", [(h,) for h in HEADLINES])
    assert values(flag_actions(df), "action_required") == list(HEADLINES.values())


def test_top_usd_takes_the_largest(frame):
    df = frame("s string", [("$5 million then $1.5bn, $20 of cash",), ("$7",), ("5 million",)])
    assert values(df, rules.top_usd(F.lower("s"))) == [1.5e9, 0.0, 0.0]


def test_keywords_need_word_borders(frame):
    words = ["ils", "aon", "nat-cat", "cat bond", "m&a"]
    rows = ["ILS and Aon", "fails, baon, aon_x", "nat-cat bond", "M&A!", "éaon aoné", ""]
    df = frame("s string", [(r,) for r in rows])
    got = values(df, rules.keyword_hits(F.lower("s"), words))
    assert got == [["ils", "aon"], [], ["nat-cat", "cat bond"], ["m&a"], [], []]


def test_gate(frame):
    df = frame("f boolean, c double", [(True, 0.69), (True, 0.70), (False, 0.9), (True, None)])
    assert values(df, rules.gate_action(F.col("f"), F.col("c"))) == [False, True, False, True]


# ---- payloads ----

GOOD = {
    "is_relevant": True,
    "signal_category": "Emerging_Risks",
    "summary": "s",
    "key_entities": ["A"],
    "sentiment": "MIXED",
    "confidence_score": 0.5,
    "action_required": True,
}


def read(frame, payload, lenient=False):
    payload = payload if isinstance(payload, str) or payload is None else json.dumps(payload)
    return payloads.read_payload(frame("payload string", [(payload,)]), lenient=lenient).first()


@pytest.mark.parametrize(
    ("change", "violation"),
    [
        ({"is_relevant": None}, "is_relevant is not a boolean"),
        ({"is_relevant": "yes"}, "is_relevant is not a boolean"),
        ({"is_relevant": 1}, "is_relevant is not a boolean"),
        ({"signal_category": "emerging_risks"}, "signal_category is not a known category"),
        ({"signal_category": 3}, "signal_category is not a known category"),
        ({"signal_category": None}, "signal_category is required when relevant"),
        ({"summary": ""}, "summary is required when relevant"),
        ({"summary": None}, "summary is required when relevant"),
        ({"summary": 7}, "summary is not a text"),
        ({"summary": "é" * 1001}, "summary is over 1000 characters"),
        ({"key_entities": None}, "key_entities is not a list of texts"),
        ({"key_entities": ["A", 1]}, "key_entities is not a list of texts"),
        ({"key_entities": ["A", None]}, "key_entities is not a list of texts"),
        ({"key_entities": "A"}, "key_entities is not a list of texts"),
        ({"sentiment": "GOOD"}, "sentiment is not a known sentiment"),
        ({"confidence_score": 1.01}, "confidence_score is outside 0..1"),
        ({"confidence_score": -0.1}, "confidence_score is outside 0..1"),
        ({"confidence_score": "0.5"}, "confidence_score is not a number"),
        ({"confidence_score": None}, "confidence_score is not a number"),
        ({"action_required": 0}, "action_required is not a boolean"),
    ],
)
def test_violations(frame, change, violation):
    assert violation in read(frame, {**GOOD, **change})["violations"]


def test_good_payload(frame):
    row = read(frame, {**GOOD, "unknown": {"x": 1}})
    assert row["violations"] == []
    assert {k: row[k] for k in GOOD} == GOOD
    assert read(frame, {**GOOD, "summary": "é" * 1000})["violations"] == []
    assert read(frame, {**GOOD, "confidence_score": 1})["confidence_score"] == 1.0


def test_defaults(frame):
    row = read(frame, {"is_relevant": False})
    assert row["violations"] == []
    assert (row["key_entities"], row["confidence_score"], row["action_required"]) == ([], 0.0, False)


@pytest.mark.parametrize("payload", ["not json", "", "[1]", "5", "null", '{"is_relevant": tru', '["{"]'])
def test_not_an_object(frame, payload):
    assert read(frame, payload)["violations"] == ["payload is not a JSON object"]


def test_missing_payload(frame):
    assert read(frame, None)["violations"] == ["payload is missing"]
    assert read(frame, {})["violations"] == ["is_relevant is missing"]


@pytest.mark.parametrize(
    ("word", "meaning"), [("yes", True), (1, True), ("on", True), ("F", False), (0, False), (2, None), ("", None)]
)
def test_lenient_booleans(frame, word, meaning):
    row = read(frame, {**GOOD, "action_required": word, "confidence_score": "0.5"}, lenient=True)
    assert row["confidence_score"] == 0.5
    assert ("action_required is not a boolean" in row["violations"]) == (meaning is None)
    if meaning is not None:
        assert row["action_required"] is meaning
