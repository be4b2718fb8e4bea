"""Every operator as a named query over the test tables."""

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wiremere import constants as C
from wiremere.functions import documents, labels, payloads, rules, text, times
from wiremere.operators import bronze, entities, extraction, feeds, gold, status
from wiremere.operators import signals as sig
from wiremere.plans import exports
from wiremere.plans.bindings import bind, table
from wiremere.plans.job import JobOptions, run_job
from wiremere.plans.lake import Lake
from wiremere.session import scratch
from wiremere.sources import archive, registry
from wiremere.sources import feeds as feed_source
from wiremere.streaming import gold as gold_stream
from wiremere.streaming import ingest as ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries.
TIMELINE_OF = date(1996, 12, 30)  # its week has days at both ends of the year
WEEKS = ["2024-W01", "2024-W02", "2024-W03", "2024-W04", "2024-W05"]
RUN_AT = datetime(2024, 2, 1)
STORED_BEFORE = "1998-01-01"
LOGGED_BEFORE = "2024-01-16"  # about the middle of the status log
ARCHIVE_FROM, ARCHIVE_TO = "1996-01-01", "1996-12-31"
ARCHIVE_SOURCES = ["rss::feed1", "rss::feed3"]
# Everyday words of the four languages in the documents, as a lexicon of its own.
TEST_LEXICON = {
    "de": ["der", "und", "das"],
    "en": ["the", "and", "of"],
    "es": ["el", "los", "que"],
    "fr": ["le", "un", "elle"],
}

QUERIES: dict[str, Query] = {}


def over(*names: str, key: str | None = None):
    """Register a query over bindings; the function takes one frame per binding."""
    def add(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[key or fn.__name__] = lambda spark, sf: fn(*[bind(spark, sf, n) for n in names])
        return fn

    return add


def six(df: DataFrame, *columns: str) -> DataFrame:
    """Round means whose last digits depend on the order of summing."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def naive(df: DataFrame, column: str) -> DataFrame:
    """A point in time as UTC clock time, which does not change with the reader's zone."""
    local = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(column).cast("timestamp_ntz"))
    return df.withColumn(column, local)


# ---- feeds and sources ----

@over("feed_entries")
def feed_cap(entries):
    return feeds.cap_entries(entries, C.USUAL_FEED_ENTRIES).select("feed_url", "pos", "title")


@over("feed_entries")
def feed_cap_large(entries):
    return feeds.cap_entries(entries, 2000).select("feed_url", "pos")


@over("feed_entries")
def resolve_text(entries):
    return feeds.with_text(entries).select("feed_url", "pos", "title", "raw_text")


@over("feed_entries")
def feed_metadata(entries):
    return feeds.with_source(entries).select("feed_url", "pos", "source_name", "raw_metadata")


@over("feed_entries")
def feed_dedup(entries):
    return feeds.drop_repeats(entries).select("feed_url", "pos", "dedup_key")


@over("feed_entries")
def keyword_filter(entries):
    return feeds.match_keyword(entries, "MUNICH re").select("feed_url", "pos")


@over("feed_entries")
def feed_articles(entries):
    return feeds.accepted(feeds.to_articles(entries, "news 1", 500)).drop("arrival")


@over("feed_entries")
def feed_articles_all(entries):
    return feeds.accepted(feeds.to_articles(entries)).drop("arrival")


@over("feed_entries")
def feed_rejects(entries):
    """Entries that are empty, malformed or without text."""
    broken = F.when(F.col("pos") % 37 == 0, F.concat(F.lit("<item>"), "title"))
    rejected = feeds.rejected(feeds.to_articles(entries.withColumn("malformed", broken)))
    return rejected.select("source_name", F.col("arrival.pos").alias("pos"), "raw_text", "reject_reason")


@over("news")
def feed_files(news):
    """News written as XML feed files by Spark and read back as feed entries."""
    folder = scratch(news.sparkSession, "feeds")
    items = news.select(
        F.coalesce("source_url", F.lit("-")).alias("link"),
        "title",
        F.col("raw_text").alias("description"),
        F.date_format("ingested_at", "yyyy-MM-dd").alias("pubDate"),
        F.split("title", " news ").alias("category"),
    )
    items.write.format("xml").options(rowTag="item", rootTag="channel").save(folder)
    entries = feed_source.read_entries(news.sparkSession, folder)
    return entries.select(
        text.strip(F.col("link")).alias("link"),
        "title",
        text.strip(F.coalesce("summary", F.lit(""))).alias("summary"),
        "published",
        F.array_join("tags", "|").alias("tags"),
        "feed_title",
    )


@over("news")
def article_contract(news):
    return feeds.check_contract(news).select("seq", "source_name", "reject_reason")


@over("news")
def archive_scan(news):
    found = archive.scan(
        news, "re", ARCHIVE_FROM, ARCHIVE_TO, ARCHIVE_SOURCES, C.USUAL_RESULTS, tiebreak="seq"
    )
    return found.select("seq", "source_name", "title", "raw_text", "ingested_at")


@over("news")
def archive_scan_all(news):
    found = archive.scan(news, "re", ARCHIVE_FROM, ARCHIVE_TO, ARCHIVE_SOURCES)
    return found.select("seq", "source_name", "title", "raw_text", "ingested_at")


@over("document_articles")
def archive_documents(articles):
    found = articles.select(
        F.concat(F.lit("https://archive.example.com/"), F.col("seq")).alias("ResultUrl"),
        F.col("title").alias("Title"),
        F.lit("2024-01-30").alias("Date"),
        F.lit("Report").alias("DocumentType"),
        F.struct(
            F.col("source_name").alias("Id"), F.upper("source_name").alias("Name")
        ).alias("Source"),
        F.struct(F.col("raw_text").alias("Content")).alias("Document"),
    )
    return feeds.accepted(archive.normalise(found)).select(
        "source_name", "source_url", "title", F.md5("raw_text").alias("text_md5"), "raw_metadata"
    )


@over("document_articles", "page_articles")
def union_sources(docs, pages):
    return feeds.union_sources(docs, pages).select(
        "seq",
        "source_name",
        "source_url",
        "title",
        F.md5("raw_text").alias("text_md5"),
        F.length("raw_text").cast("bigint").alias("chars"),
    )


# ---- text functions ----

@over("news")
def strip_text(news):
    return news.select(
        "seq", text.strip(F.col("source_url")).alias("url"), text.strip(F.col("raw_text")).alias("text")
    )


@over("news")
def content_hash(news):
    return bronze.with_hash(news).select("seq", "content_hash")


@over("document_articles", "page_articles")
def content_hash_articles(docs, pages):
    return bronze.with_hash(feeds.union_sources(docs, pages)).select("seq", "content_hash")


@over("document_articles")
def text_preview(docs):
    return docs.select("seq", text.preview(F.col("raw_text")).alias("preview"))


@over("document_articles", "page_articles")
def model_input(docs, pages):
    columns = [F.col(c) for c in ("raw_text", "title", "source_url")]
    prompt = text.model_input(*columns, C.USUAL_INPUT_CHARS)
    return feeds.union_sources(docs, pages).select("seq", prompt.alias("model_input"))


@over("document_articles", "page_articles")
def model_input_whole(docs, pages):
    prompt = text.model_input(F.col("raw_text"), F.col("title"), F.col("source_url"))
    return feeds.union_sources(docs, pages).select("seq", F.md5(prompt).alias("model_input_md5"))


@over("signals")
def date_buckets(signals):
    return _dates(signals, F.col("id"), F.col("extracted_at"))


@over("news")
def date_buckets_news(news):
    return _dates(news, F.col("seq"), F.col("ingested_at"))


def _dates(df: DataFrame, key: Column, at: Column) -> DataFrame:
    return df.select(
        key.alias("id"),
        F.to_date(at).alias("date"),
        times.year_month(at).alias("year_month"),
        times.year_week(at).alias("year_week"),
        times.day(at).alias("day"),
        times.minute(at).alias("minute"),
    )


@over("signals")
def parse_entities(signals):
    found = documents.entity_list(F.col("key_entities"))
    return signals.select(
        "id",
        F.size(found).cast("bigint").alias("entities"),
        F.array_join(found, "|").alias("names"),
    )


@over("signals")
def sentiment_lookup(signals):
    return signals.select(
        "id",
        labels.sentiment_score(F.col("sentiment")).alias("sentiment_score"),
        labels.category_label(F.col("signal_category")).alias("category_label"),
        labels.entity_type(F.col("signal_category")).alias("entity_type"),
    )


# ---- Bronze ----

def _stored_and_batch(news: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bronze after the runs up to a date, and a poll that brings every article again."""
    batch = bronze.with_hash(feeds.accepted(news))
    earlier = batch.filter(F.col("ingested_at") < F.lit(STORED_BEFORE).cast("timestamp_ntz"))
    nothing = earlier.limit(0)
    return bronze.new_rows(earlier, nothing, [F.col("seq")], unique=True), batch


@over("news")
def bronze_insert_ignore(news):
    stored, batch = _stored_and_batch(news)
    fresh = bronze.new_rows(batch, stored, [F.col("seq")], unique=True)
    return naive(bronze.stamp(fresh, RUN_AT).drop("raw_metadata"), "ingested_at")


@over("news")
def bronze_insert_probe(news):
    stored, batch = _stored_and_batch(news)
    return bronze.new_rows(batch, stored, [F.col("seq")], probe=True, unique=True).select("seq", "content_hash")


@over("document_articles", "page_articles")
def articles_dedup(docs, pages):
    batch = bronze.with_hash(feeds.accepted(feeds.union_sources(docs, pages)))
    fresh = bronze.new_rows(batch, batch.limit(0), [F.col("seq")], unique=True)
    return fresh.select("seq", "source_name", "content_hash")


@over("news")
def bronze_dedup_report(news):
    stored, batch = _stored_and_batch(news)
    return bronze.dedup_report(batch, stored)


@over("news")
def existing_hashes(news):
    stored, batch = _stored_and_batch(news)
    return bronze.existing_hashes(batch, stored)


def _stored_lake(spark: SparkSession, rows: DataFrame) -> Lake:
    lake = Lake(spark, scratch(spark, "lake"))
    lake.create()
    lake.append("bronze", rows)
    return lake


@over("news")
def hash_lookup(news):
    """The poll's hashes that a stored lake holds, by its hash index, part of which is compacted."""
    stored, batch = _stored_and_batch(news)
    lake = _stored_lake(news.sparkSession, bronze.stamp(stored.filter("seq % 2 = 0"), RUN_AT))
    lake.compact(hashes_after=1)
    lake.append("bronze", bronze.stamp(stored.filter("seq % 2 = 1"), RUN_AT))
    return lake.known_hashes(batch)


# ---- status ----

@over("news", "status_log")
def open_articles(news, log):
    """Open articles of a stored lake: compacted in the middle of its log, and carried on from there."""
    log = log.withColumns({"logged_at": F.col("logged_at").cast("timestamp"), "run_id": F.lit("-")})
    middle = F.col("logged_at") < F.lit(LOGGED_BEFORE).cast("timestamp")
    rows = bronze.with_hash(news).withColumn("ingested_at", times.instant(RUN_AT))  # one run, so one day
    lake = _stored_lake(news.sparkSession, rows)
    lake.append("status", log.filter(middle))
    lake.compact(open_after=1)
    lake.append("status", log.filter(~middle))
    return lake.open_articles().select("id", "status", "error")


@over("status_log")
def status_current(log):
    return status.current(log)


@over("news", "status_log")
def work_queue(news, log):
    queue = status.work_queue(news, log, C.USUAL_BATCH)
    return queue.select("id", "source_name", "title", "ingested_at")


@over("news", "status_log")
def backlog(news, log):
    return status.work_queue(news, log).select("id", "ingested_at")


@over("news", "status_log")
def dead_letter_queue(news, log):
    return status.dead_letters(news, log)


@over("news", "status_log")
def dead_letter_page(news, log):
    page = status.dead_letter_page(news, log, C.USUAL_PAGE)
    return page.select("id", "title", "processing_error")


@over("news", "status_log")
def dlq_retry(news, log):
    wanted = news.filter(F.col("source_name") == "rss::feed2").select(F.col("id").alias("bronze_id"))
    return naive(status.retry(log, wanted, RUN_AT), "logged_at")


@over("news", "status_log")
def backlog_after_retry(news, log):
    ids = news.select(F.col("id").alias("bronze_id"))
    after = feeds.union_sources(
        log.withColumns({"logged_at": F.col("logged_at").cast("timestamp"), "run_id": F.lit("-")}),
        status.retry(log, ids, RUN_AT),
    )
    return status.work_queue(news, after).select("id")


# ---- extraction ----

@over("news")
def lexicon_classify(news):
    scored = extraction.classify(news)
    return _classified(scored)


@over("document_articles", "page_articles")
def lexicon_classify_articles(docs, pages):
    articles = feeds.union_sources(docs, pages)
    return _classified(extraction.classify(articles, lexicon=TEST_LEXICON))


def _classified(scored: DataFrame) -> DataFrame:
    return scored.select(
        "seq",
        "is_relevant",
        "signal_category",
        F.round("confidence", 6).alias("confidence"),
        F.size("hits").cast("bigint").alias("hits"),
    )


@over("news")
def action_rules(news):
    return extraction.flag_actions(news).select("seq", "usd", "action_required")


@over("payloads")
def action_gate(replies):
    read = payloads.read_payload(replies)
    gated = rules.gate_action(F.col("action_required"), F.col("confidence_score"))
    return read.select("bronze_id", gated.alias("action_required"))


@over("payloads")
def parse_payload(replies):
    return payloads.read_payload(replies).select(
        "bronze_id",
        "is_relevant",
        "signal_category",
        F.length("summary").cast("bigint").alias("summary_chars"),
        F.array_join("key_entities", "|").alias("key_entities"),
        "sentiment",
        "confidence_score",
        "action_required",
    )


@over("payloads")
def validate_signals(replies):
    return payloads.read_payload(replies).select(
        "bronze_id", F.array_join("violations", "; ").alias("violations")
    )


@over("payloads")
def route_outcomes(replies):
    return extraction.route(replies).select("bronze_id", "outcome", "error")


@over("payloads")
def batch_outcome(replies):
    return extraction.batch_outcome(extraction.route(replies))


def _extracted(news: DataFrame, replies: DataFrame) -> DataFrame:
    source = news.select(F.col("id").alias("bronze_id"), "source_name", "source_url", "title")
    joined = replies.join(source, "bronze_id").withColumn("llm_model", F.lit("replay"))
    return extraction.route(joined)


@over("news", "payloads")
def silver_rows(news, replies):
    return naive(extraction.silver_rows(_extracted(news, replies), RUN_AT), "extracted_at")


@over("payloads")
def noise_records(replies):
    routed = extraction.route(replies)
    relevant = routed.filter(F.col("outcome") == status.SILVER)
    failed = routed.filter(F.col("outcome") == status.FAILED)
    return status.noise(replies, relevant, failed)


@over("news", "payloads")
def lineage(news, replies):
    silver = extraction.silver_rows(_extracted(news, replies), RUN_AT)
    return extraction.lineage(silver, news)


@over("news")
def extract_lexicon(news):
    routed = extraction.route(extraction.lexicon_payloads(news))
    return routed.select(
        "bronze_id",
        "outcome",
        "signal_category",
        "summary",
        F.array_join("key_entities", "|").alias("key_entities"),
        "sentiment",
        "action_required",
    )


def _headline_model() -> extraction.BatchModel:
    """A small batch model: relevant where the prompt names a storm; breaks on licence news."""
    import json

    def reply(prompt: str) -> str:
        if "licence" in prompt:
            raise ValueError("no answer")
        storm = "Hurricane" in prompt
        return json.dumps(
            {
                "is_relevant": storm,
                "signal_category": "Emerging_Risks" if storm else None,
                "summary": "storm" if storm else None,
                "key_entities": ["Hurricane"] if storm else [],
                "confidence_score": 0.9,
                "action_required": False,
            }
        )

    return lambda prompts: [reply(p) for p in prompts]


@over("news")
def extract_model(news):
    replies = extraction.model_payloads(news, _headline_model, "headline-1")
    return extraction.route(replies).select("bronze_id", "outcome", "error", "signal_category")


def signal_to_noise(spark: SparkSession, sf: str) -> DataFrame:
    """How well the keyword classifier finds the documents that are labelled good."""
    docs = table(spark, sf, "documents").withColumnRenamed("text", "raw_text")
    found = extraction.classify(docs, lexicon=TEST_LEXICON)
    scored = found.join(table(spark, sf, "labels"), "doc_id").select(
        (F.col("quality") == 1).alias("relevant"), F.col("is_relevant").alias("predicted")
    )
    columns = ["precision", "recall", "sn_before", "sn_after"]
    return six(extraction.signal_to_noise(scored), *columns)


QUERIES["signal_to_noise"] = signal_to_noise


# ---- Gold ----

@over("signals")
def gold_signal_summary(signals):
    return six(gold.signal_summary(signals), "avg_confidence")


@over("signals")
def gold_report(signals):
    return gold.report(signals)


@over("signals")
def gold_grand_total(signals):
    return gold.grand_total(signals)


@over("signals")
def kpi_cards(signals):
    return gold.kpi_cards(signals)


@over("signals")
def sentiment_distribution(signals):
    return gold.sentiment_distribution(signals)


@over("signals")
def action_breakdown(signals):
    return gold.action_breakdown(signals)


@over("signals")
def sentiment_share(signals):
    return six(gold.with_share(gold.sentiment_distribution(signals)), "share_pct")


@over("signals")
def action_share(signals):
    return six(gold.with_share(gold.action_breakdown(signals)), "share_pct")


@over("signals")
def category_sentiment(signals):
    return gold.category_sentiment(sig.enrich(signals))


@over("signals")
def sentiment_trend(signals):
    return six(gold.sentiment_trend(sig.enrich(signals)), "avg_sentiment")


@over("signals")
def dashboard_header(signals):
    return gold.dashboard_header(signals)


@over("news", "signals", "status_log")
def lake_stats(news, signals, log):
    return gold.lake_stats(news, signals, log)


@over("signals")
def lake_gold(signals):
    return gold.lake_gold(signals)


# ---- entities ----

@over("signals")
def competitor_activity(signals):
    return entities.competitor_activity(entities.mentions(signals, "signal_category"))


@over("signals")
def competitor_activity_star(signals):
    star = entities.with_signals(entities.mentions(signals), signals, "signal_category")
    return entities.competitor_activity(star)


@over("signals")
def competitor_activity_files(signals):
    """The same from an exported star schema."""
    spark, folder = signals.sparkSession, scratch(signals.sparkSession, "star")
    exports.export_star(signals, folder)
    facts, dims = (
        spark.read.parquet(f"{folder}/{name}") for name in ("fact_signals", "dim_entities")
    )
    return entities.competitor_activity(entities.with_signals(dims, facts, "signal_category"))


def _risk_mentions(signals: DataFrame) -> DataFrame:
    return entities.mentions(
        sig.enrich(signals), "signal_category", "year_week", "sentiment_score"
    )


@over("signals")
def risk_week(signals):
    return six(entities.risk_week(_risk_mentions(signals)), "avg_sent")


@over("signals")
def risk_week_star(signals):
    facts = sig.enrich(signals)
    columns = ["signal_category", "year_week", "sentiment_score"]
    star = entities.with_signals(entities.mentions(signals), facts, *columns)
    return six(entities.risk_week(star), "avg_sent")


@over("signals")
def risk_heatmap(signals):
    return entities.heat_map(entities.risk_week(_risk_mentions(signals)), "entity_name", WEEKS)


@over("signals")
def risk_heatmap_by_title(signals):
    return entities.heat_map(entities.title_week(sig.enrich(signals)), "title", WEEKS)


@over("signals")
def broker_matrix(signals):
    joined = entities.mentions(
        sig.enrich(signals), "signal_category", "sentiment_score", "action_required"
    )
    return six(entities.broker_matrix(joined), "avg_sent")


@over("signals")
def broker_matrix_star(signals):
    columns = ["signal_category", "sentiment_score", "action_required"]
    star = entities.with_signals(entities.mentions(signals), sig.enrich(signals), *columns)
    return six(entities.broker_matrix(star), "avg_sent")


@over("signals")
def broker_matrix_by_title(signals):
    return six(entities.broker_matrix_by_title(sig.enrich(signals), C.USUAL_TITLE_CHARS), "avg_sent")


@over("signals")
def broker_matrix_by_whole_title(signals):
    return six(entities.broker_matrix_by_title(sig.enrich(signals)), "avg_sent")


@over("signals")
def dim_entities(signals):
    return entities.mentions(signals)


# ---- signal lists ----

@over("signals")
def signals_enriched(signals):
    return sig.enrich(signals).select(
        "id", "category_label", "sentiment_score", "extracted_date", "year_month", "year_week", "day"
    )


@over("signals")
def fact_signals(signals):
    return sig.fact_signals(sig.enrich(signals))


@over("signals")
def intelligence_feed(signals):
    return sig.intelligence_feed(signals)


@over("signals")
def news_table(signals):
    return sig.news_table(sig.enrich(signals), C.USUAL_PAGE)


@over("signals")
def category_feed(signals):
    return sig.category_feed(signals, C.BROKER).select("id", "title", "sentiment", "extracted_at")


@over("signals")
def latest_risks(signals):
    return sig.latest_in_category(signals, C.RISK, C.USUAL_LATEST)


@over("signals")
def action_items(signals):
    return sig.action_items(signals)


def _period(name: str) -> None:
    @over("news", key=f"timeline_{name}")
    def run(news):
        signals = news.select(
            "id",
            "title",
            "source_url",
            F.lit(C.RISK).alias("signal_category"),
            F.col("raw_text").alias("summary"),
            F.lit("NEUTRAL").alias("sentiment"),
            (F.col("seq") % 2 == 0).alias("action_required"),
            F.col("ingested_at").alias("extracted_at"),
            F.to_date("ingested_at").alias("extracted_date"),
        )
        return sig.news_rows(sig.enrich(sig.timeline(signals, name, TIMELINE_OF)))


for _name in sig.PERIODS:
    _period(_name)


# ---- whole runs ----

@over("news")
def whole_run(news):
    """Silver after one run over all news: ingest, dedup, extraction, routing, status."""
    spark = news.sparkSession
    lake = Lake(spark, scratch(spark, "lake"))
    name = f"news-{lake.root}"
    registry.register(name, lambda spark: news.withColumn("arrival", F.col("seq")))
    try:
        run_job(lake, JobOptions(source=name), run_at=RUN_AT)
    finally:
        registry.SOURCES.pop(name.lower())
    return lake.silver().select(
        "id", "bronze_id", "source_name", "source_url", "title", "signal_category", "summary",
        "key_entities", "sentiment", "action_required", "llm_model",
    )


# ---- streams ----

def stream_gold(spark: SparkSession, sf: str) -> DataFrame:
    """The live summary, after the stream has read the whole event table."""
    out = scratch(spark, "stream-gold")
    events = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/events*.parquet")
    signals = events.select(
        F.when(F.col("event_type").isin("click", "view"), C.COMPETITOR)
        .when(F.col("event_type").isin("purchase", "signup"), C.BROKER)
        .otherwise(C.RISK)
        .alias("signal_category"),
        (F.least(F.col("value"), F.lit(500.0)) / 500).cast("float").alias("confidence_score"),
        (F.col("value") > 100).alias("action_required"),
        F.col("ts").alias("extracted_at"),
    )
    gold_stream.live_summary(signals, f"{out}/summary", f"{out}/checkpoint").awaitTermination()
    return six(gold_stream.latest_summary(spark, f"{out}/summary"), "avg_confidence")


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze hashes after a stream of all documents has been ingested, and ingested again."""
    out = scratch(spark, "stream-ingest")
    lake = Lake(spark, f"{out}/lake")
    schema = table(spark, sf, "documents").schema
    for attempt in ("first", "replay"):
        docs = ingest_stream.landed(spark, schema, f"{sf}/documents*.parquet")
        articles = docs.select(
            F.col("source").alias("source_name"),
            F.lit(None).cast("string").alias("source_url"),
            F.concat_ws(" ", "source", "doc_id").alias("title"),
            F.col("text").alias("raw_text"),
            F.lit("{}").alias("raw_metadata"),
            "doc_id",
        )
        checkpoint = f"{out}/checkpoint-{attempt}"
        ingest_stream.ingest(articles, lake, checkpoint, ["doc_id"]).awaitTermination()
    return lake.bronze().select("content_hash", "source_name", "title")


QUERIES["stream_gold"] = stream_gold
QUERIES["stream_ingest"] = stream_ingest
