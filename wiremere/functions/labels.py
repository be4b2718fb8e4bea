"""Lookups from closed value sets, as CASE expressions that stay in generated code."""

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from wiremere import constants as C


def lookup(key: Column, table: Mapping[str, Any], default: Column) -> Column:
    """The table's value for the key; the default for unknown keys and NULL."""
    items = list(table.items())
    first = F.when(key == items[0][0], F.lit(items[0][1]))
    cases = reduce(lambda case, kv: case.when(key == kv[0], F.lit(kv[1])), items[1:], first)
    return cases.otherwise(default)


def category_label(category: Column) -> Column:
    return lookup(category, C.CATEGORY_LABELS, category)


def sentiment_score(sentiment: Column) -> Column:
    return lookup(sentiment, C.SENTIMENT_SCORES, F.lit(0.0))


def entity_type(category: Column) -> Column:
    return lookup(category, C.ENTITY_TYPES, F.lit(C.OTHER_ENTITY_TYPE))


def action_label(flag: Column) -> Column:
    return F.when(flag, F.lit("Action Required")).otherwise(F.lit("Monitor"))


def shown_sentiment(sentiment: Column) -> Column:
    return F.upper(F.coalesce(sentiment, F.lit("NEUTRAL")))
