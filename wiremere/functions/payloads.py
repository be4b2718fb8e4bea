"""Extraction payloads: typed reading and validation of a model's JSON reply."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremere import constants as C
from wiremere.functions.documents import present

FIELDS = [
    "is_relevant",
    "signal_category",
    "summary",
    "key_entities",
    "sentiment",
    "confidence_score",
    "action_required",
]
NUMBER = r"^(DECIMAL|DOUBLE|FLOAT|BIGINT|INT|SMALLINT|TINYINT)"
LIST_OF_TEXT = ["ARRAY<STRING>", "ARRAY<VOID>"]

# Texts and numbers a lenient reader takes for a boolean.
TRUE_WORDS = ["true", "t", "yes", "y", "on", "1", "1.0"]
FALSE_WORDS = ["false", "f", "no", "n", "off", "0", "0.0"]


# One parse per payload: every field as a variant, which keeps its JSON type, and malformed text apart.
SHAPE = ", ".join(f"{name} variant" for name in FIELDS) + ", _malformed string"


def _kind(field: str) -> Column:
    """The JSON type of a field; VOID for a JSON null, NULL for an absent field."""
    return F.col(f"_{field}_type")


def _get(name: str, kind: str) -> Column:
    return F.try_variant_get(f"_json.{name}", "$", kind)


def _text(name: str) -> Column:
    return F.when(_kind(name) == "STRING", _get(name, "string"))


def _boolean(name: str, lenient: bool) -> Column:
    strict = F.when(_kind(name) == "BOOLEAN", _get(name, "boolean"))
    if not lenient:
        return strict
    word = F.lower(_get(name, "string"))
    scalar = (_kind(name) == "STRING") | F.rlike(_kind(name), F.lit(NUMBER))
    return F.coalesce(
        strict,
        F.when(scalar & word.isin(TRUE_WORDS), True).when(scalar & word.isin(FALSE_WORDS), False),
    )


def _number(name: str, lenient: bool) -> Column:
    allowed = F.rlike(_kind(name), F.lit(NUMBER))
    if lenient:
        allowed = allowed | (_kind(name) == "STRING")
    return F.when(allowed, _get(name, "double"))


def read_payload(df: DataFrame, payload: str = "payload", lenient: bool = False) -> DataFrame:
    """Add the typed fields of a JSON payload and the list of rules it breaks.

    Absent optional fields take their defaults. JSON types are taken at their word; `lenient` also
    reads booleans and numbers written as text. Unknown keys are ignored.
    """
    options = {"columnNameOfCorruptRecord": "_malformed"}
    parsed = df.withColumn("_json", F.from_json(payload, SHAPE, options))
    parsed = parsed.withColumns(
        {f"_{name}_type": F.schema_of_variant(f"_json.{name}") for name in FIELDS}
    )
    entities = F.when(_kind("key_entities").isin(LIST_OF_TEXT), _get("key_entities", "array<string>"))
    parsed = parsed.withColumns(
        {
            "is_relevant": _boolean("is_relevant", lenient),
            "signal_category": _text("signal_category"),
            "summary": _text("summary"),
            "_entities": entities,
            "sentiment": _text("sentiment"),
            "_confidence": _number("confidence_score", lenient),
            "_action": _boolean("action_required", lenient),
        }
    )
    parsed = parsed.withColumns(
        {
            "key_entities": F.coalesce("_entities", F.array().cast("array<string>")),
            "confidence_score": F.coalesce("_confidence", F.lit(0.0)),
            "action_required": F.coalesce("_action", F.lit(False)),
            "violations": _violations(F.col(payload)),
        }
    )
    # A generator of one row: filters on the fields stop here. Pushed below, they would repeat the
    # parsing and the checks once per mention.
    fields = F.inline(F.array(F.struct(*FIELDS, "violations")))
    return parsed.select(*[F.col(c) for c in df.columns], fields)


def _violations(payload: Column) -> Column:
    is_object = F.startswith(F.ltrim(payload), F.lit("{")) & F.col("_json._malformed").isNull()

    def given(name: str) -> Column:
        return _kind(name).isNotNull()

    def absent(name: str) -> Column:
        return _kind(name).isNull()

    def null(name: str) -> Column:
        return F.coalesce(_kind(name) == "VOID", F.lit(False))

    def not_text(name: str) -> Column:
        return given(name) & ~null(name) & (_kind(name) != "STRING")

    relevant = F.coalesce(F.col("is_relevant"), F.lit(False))
    category, summary = F.col("signal_category"), F.col("summary")
    sentiment, confidence = F.col("sentiment"), F.col("_confidence")
    in_range = F.coalesce((confidence >= 0.0) & (confidence <= 1.0), F.lit(False))
    entities = F.col("_entities")
    entities_ok = entities.isNotNull() & ~F.exists(entities, lambda e: e.isNull())

    in_object = [
        (absent("is_relevant"), "is_relevant is missing"),
        (given("is_relevant") & F.col("is_relevant").isNull(), "is_relevant is not a boolean"),
        (
            not_text("signal_category") | (category.isNotNull() & ~category.isin(C.CATEGORIES)),
            "signal_category is not a known category",
        ),
        (not_text("summary"), "summary is not a text"),
        (F.length(summary) > C.MAX_SUMMARY_CHARS, f"summary is over {C.MAX_SUMMARY_CHARS} characters"),
        (given("key_entities") & ~entities_ok, "key_entities is not a list of texts"),
        (
            not_text("sentiment") | (sentiment.isNotNull() & ~sentiment.isin(C.SENTIMENTS)),
            "sentiment is not a known sentiment",
        ),
        (given("confidence_score") & confidence.isNull(), "confidence_score is not a number"),
        (confidence.isNotNull() & ~in_range, "confidence_score is outside 0..1"),
        (given("action_required") & F.col("_action").isNull(), "action_required is not a boolean"),
        (
            relevant & (absent("signal_category") | null("signal_category")),
            "signal_category is required when relevant",
        ),
        (
            relevant & (absent("summary") | null("summary") | (summary == "")),
            "summary is required when relevant",
        ),
    ]
    broken = present([F.when(test, F.lit(text)) for test, text in in_object])
    return (
        F.when(payload.isNull(), F.array(F.lit("payload is missing")))
        .when(~is_object, F.array(F.lit("payload is not a JSON object")))
        .otherwise(broken)
    )
