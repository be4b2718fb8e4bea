"""Extraction: article text to payloads, payloads to validated signals."""

from collections.abc import Callable, Iterator, Mapping
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremere import constants as C
from wiremere.functions import payloads, rules, text, times
from wiremere.operators import status
from wiremere.session import ship_package

BatchModel = Callable[[list[str]], list[str]]
LEXICON_MODEL = "lexicon-1"

# How errors of the model or of its reply begin, and all others.
FAILED_PREFIX = "Signal extraction failed: "
UNEXPECTED_PREFIX = "Unexpected: "


# ---- the offline default: column expressions only ----

def _keywords(lexicon: Mapping[str, list[str]]) -> list[str]:
    return [w for words in lexicon.values() for w in words]


def _scanned(articles: DataFrame, column: str, pattern: str) -> DataFrame:
    """Add what a pattern finds in the lower-cased text, in a column of its own: all rules share it."""
    return articles.withColumn("_found", rules.scan(F.lower(F.col(column)), pattern))


def _with_actions(scanned: DataFrame) -> DataFrame:
    found = F.col("_found")
    return scanned.withColumns(
        {"usd": rules.largest_usd(found), "action_required": rules.action_rule(found), "mood": rules.sentiment(found)}
    )


def flag_actions(articles: DataFrame, column: str = "raw_text") -> DataFrame:
    """Add the largest dollar amount, whether the text calls for action, and its sentiment as `mood`."""
    return _with_actions(_scanned(articles, column, rules.action_pattern())).drop("_found")


def classify(
    articles: DataFrame, column: str = "raw_text", lexicon: Mapping[str, list[str]] = C.LEXICON
) -> DataFrame:
    """Add keyword hits, score per category, winning category, relevance and confidence.

    A category scores one per keyword found; ties go to the first category name.
    """
    return _with_category(_scanned(articles, column, rules.keyword_pattern(_keywords(lexicon))), lexicon).drop("_found")


def _with_category(scanned: DataFrame, lexicon: Mapping[str, list[str]]) -> DataFrame:
    hit = scanned.withColumn("hits", rules.keywords_among(F.col("_found"), _keywords(lexicon)))
    scores = {f"score_{c}": s for c, s in rules.category_scores(F.col("hits"), lexicon).items()}
    scored = hit.withColumns(scores)
    top = F.greatest(*[F.col(c) for c in scores])
    total = sum((F.col(c) for c in scores), F.lit(0))
    winner = F.coalesce(
        *[F.when((F.col(f"score_{c}") == top) & (top > 0), F.lit(c)) for c in sorted(lexicon)]
    )
    return scored.withColumns(
        {
            "signal_category": winner,
            "is_relevant": top > 0,
            "confidence": F.when(total > 0, top / total).otherwise(F.lit(0.0)),
        }
    )


def _names_found(hits: Column) -> Column:
    names = C.COMPETITOR_NAMES + C.BROKER_NAMES
    return F.array_intersect(hits, F.array(*[F.lit(n) for n in names]))


def lexicon_payloads(articles: DataFrame) -> DataFrame:
    """Payloads of the offline rules: the headline (else the text's start) serves as summary."""
    scanned = _scanned(articles, "raw_text", rules.action_pattern(_keywords(C.LEXICON)))
    scored = _with_category(_with_actions(scanned), C.LEXICON)
    action = rules.gate_action(F.col("action_required"), F.col("confidence"))
    summary = F.left(
        F.coalesce(text.filled(F.col("title")), F.col("raw_text")), F.lit(C.MAX_SUMMARY_CHARS)
    )
    payload = F.to_json(
        F.struct(
            "is_relevant",
            "signal_category",
            F.when(F.col("is_relevant"), summary).alias("summary"),
            _names_found(F.col("hits")).alias("key_entities"),
            F.when(F.col("is_relevant"), F.col("mood")).alias("sentiment"),
            F.col("confidence").alias("confidence_score"),
            (F.col("is_relevant") & action).alias("action_required"),
        ),
        {"ignoreNullFields": "false"},
    )
    return _extractions(
        scored.withColumns(
            {
                "payload": F.when(F.col("raw_text").isNotNull(), payload),
                "model_error": F.lit(None).cast("string"),
            }
        ),
        LEXICON_MODEL,
    )


# ---- a plugged-in model ----

def model_payloads(
    articles: DataFrame,
    make_model: Callable[[], BatchModel],
    model_name: str,
    max_chars: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Payloads of a batch model: list of texts in, list of JSON replies out.

    `make_model` runs once per task. Only the model's input crosses to Python. `tasks` bounds how
    many calls run side by side; by default as many as there are shuffle partitions. Where a batch fails, its rows are tried one by one, so that only
    the bad ones fail. Store the result before using it twice: models may answer differently.
    """
    ship_package(articles.sparkSession)

    @F.pandas_udf("payload string, model_error string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for batch in batches:
            yield pd.DataFrame(_replies(model, batch.tolist()), columns=["payload", "model_error"])

    # A model call costs far more than moving its text, so the calls are spread evenly.
    tasks = tasks or int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = articles.repartition(tasks)
    prompt = text.model_input(F.col("raw_text"), F.col("title"), F.col("source_url"), max_chars)
    asked = source.withColumn("reply", ask.asNondeterministic()(prompt))
    return _extractions(asked.select("*", "reply.payload", "reply.model_error"), model_name)


def _replies(model: BatchModel, prompts: list[str | None]) -> list[tuple[str | None, str | None]]:
    asked = [p for p in prompts if p is not None]
    try:
        answers = list(zip(model(asked), [None] * len(asked), strict=True)) if asked else []
    except Exception:
        answers = [_reply(model, p) for p in asked]
    rest = iter(answers)
    return [(None, None) if p is None else next(rest) for p in prompts]


def _reply(model: BatchModel, prompt: str) -> tuple[str | None, str | None]:
    try:
        return model([prompt])[0], None
    except Exception as error:
        return None, str(error) or type(error).__name__


def _extractions(df: DataFrame, model_name: str) -> DataFrame:
    return df.select(
        F.col("id").alias("bronze_id"),
        "source_name",
        "source_url",
        "title",
        F.col("raw_text").isNull().alias("text_missing"),
        "payload",
        "model_error",
        F.lit(model_name).alias("llm_model"),
    )


# ---- routing ----

def route(extractions: DataFrame, lenient: bool = False) -> DataFrame:
    """Add typed fields, violations, outcome (silver, noise, failed) and error text."""
    read = payloads.read_payload(extractions, "payload", lenient)
    missing = F.col("text_missing") if "text_missing" in extractions.columns else F.lit(False)
    crashed = F.col("model_error") if "model_error" in extractions.columns else F.lit(None)
    reason = (
        F.when(missing, F.lit(UNEXPECTED_PREFIX + "raw_text is null"))
        .when(crashed.isNotNull(), F.concat(F.lit(FAILED_PREFIX), crashed.cast("string")))
        .when(F.size("violations") > 0, F.concat(F.lit(FAILED_PREFIX), F.array_join("violations", "; ")))
    )
    return read.withColumn("error", reason).withColumn(
        "outcome",
        F.when(F.col("error").isNotNull(), F.lit(status.FAILED))
        .when(F.col("is_relevant"), F.lit(status.SILVER))
        .otherwise(F.lit(status.NOISE)),
    )


def silver_rows(routed: DataFrame, run_at: datetime) -> DataFrame:
    """Silver rows of the relevant, valid extractions; one id per article, whatever the retry."""
    return routed.filter(F.col("outcome") == status.SILVER).select(
        text.derived_id("silver", F.col("bronze_id").cast("string")).alias("id"),
        F.col("bronze_id").cast("string").alias("bronze_id"),
        "source_name",
        "source_url",
        "title",
        "signal_category",
        "summary",
        F.coalesce(F.to_json("key_entities"), F.lit("[]")).alias("key_entities"),
        F.coalesce("sentiment", F.lit("NEUTRAL")).alias("sentiment"),
        F.col("confidence_score").cast("float").alias("confidence_score"),
        F.coalesce("action_required", F.lit(False)).alias("action_required"),
        times.instant(run_at).alias("extracted_at"),
        "llm_model",
        F.coalesce("payload", F.lit("{}")).alias("raw_llm_response"),
    )


def not_yet_stored(silver_batch: DataFrame, silver: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Signals whose article Silver does not hold yet; a replay after a crash adds nothing.

    `among` (column bronze_id) names the articles that Silver can hold at all; without any, Silver is not read.
    """
    asked = silver_batch.select("bronze_id")
    if among is not None:
        asked = asked.join(among.select("bronze_id"), "bronze_id", "left_semi")
    known = silver.select("bronze_id").join(asked, "bronze_id", "left_semi")
    return silver_batch.join(known, "bronze_id", "left_anti")


def lineage(silver: DataFrame, bronze: DataFrame) -> DataFrame:
    """Each signal with what it came from: model, reply, and its article's digest and time of arrival.

    Texts are read for their digest where they lie and do not travel.
    """
    source = bronze.select(
        F.col("id").alias("bronze_id"), F.md5("raw_text").alias("text_md5"), "ingested_at"
    )
    return silver.join(source, "bronze_id").select(
        "bronze_id", "signal_category", "llm_model", "raw_llm_response", "text_md5", "ingested_at"
    )


def status_rows(routed: DataFrame, run_at: datetime, run_id: str) -> DataFrame:
    outcomes = routed.withColumn("status", F.col("outcome"))
    return status.entries(outcomes, run_at, run_id)


def batch_outcome(routed: DataFrame) -> DataFrame:
    """Rows per outcome."""
    return routed.groupBy("outcome").agg(F.count("*").alias("records"))


def signal_to_noise(scored: DataFrame) -> DataFrame:
    """Precision, recall and signal-to-noise before and after filtering.

    Wants booleans `relevant` (label) and `predicted`. One row.
    """
    relevant, predicted = F.col("relevant"), F.col("predicted")
    counts = scored.agg(
        F.count("*").alias("n"),
        F.count_if(relevant).alias("r"),
        F.count_if(predicted).alias("kept"),
        F.count_if(relevant & predicted).alias("hit"),
    )
    n, r = F.col("n"), F.col("r")
    p = F.coalesce(F.try_divide("hit", "kept"), F.lit(0.0))
    return (
        counts.withColumn("precision", p)
        .withColumn("recall", F.coalesce(F.try_divide("hit", "r"), F.lit(0.0)))
        .withColumn("sn_before", F.try_divide(r, n))
        .withColumn(
            "sn_after",
            F.try_divide(
                F.col("precision") * r,
                F.col("precision") * r + (1 - F.col("precision")) * (n - r),
            ),
        )
        .select(
            n.alias("articles"), r.alias("relevant"), F.col("kept").alias("predicted"),
            "precision", "recall", "sn_before", "sn_after",
        )
    )
