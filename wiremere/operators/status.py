"""Processing state as an append-only log; the latest row per article is its state."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremere import constants as C
from wiremere.functions import text, times

SILVER, NOISE, FAILED, RETRY = "silver", "noise", "failed", "retry"
NEW = "new"  # in no log: an article that no run has taken up
DONE = [SILVER, NOISE, FAILED]

def current(log: DataFrame) -> DataFrame:
    """Latest status and error per article. Map tasks reduce an article's rows before the shuffle."""
    fields = [c for c in log.columns if c not in ("bronze_id", "logged_at")]
    latest = F.max(F.struct("logged_at", *fields)).alias("latest")
    return log.groupBy("bronze_id").agg(latest).select(
        "bronze_id", *[F.col(f"latest.{c}").alias(c) for c in (*fields, "logged_at")]
    )


def queue_order() -> list[Column]:
    return [F.col("ingested_at").asc_nulls_last(), F.col("id").asc()]


def _key(bronze: DataFrame) -> list[str]:
    """The id and, on a stored table, the partition it lies in."""
    return [c for c in ("id", "ingest_date") if c in bronze.columns]


def backlog(bronze: DataFrame, log: DataFrame, silver: DataFrame | None = None) -> DataFrame:
    """Keys and times of the articles still to be processed; no text is read.

    An article that reached Silver is done even if a crash kept its status row from being written,
    unless a retry was asked for.
    """
    state = current(log).select("bronze_id", "status")
    done = state.filter(F.col("status").isin(DONE)).select(F.col("bronze_id").alias("id"))
    todo = bronze.select(*_key(bronze), "ingested_at").join(done, "id", "left_anti")
    if silver is None:
        return todo
    retried = state.filter(F.col("status") == RETRY).select("bronze_id")
    stored = silver.select("bronze_id").join(retried, "bronze_id", "left_anti")
    return todo.join(stored.withColumnRenamed("bronze_id", "id"), "id", "left_anti")


def work_queue(
    bronze: DataFrame, log: DataFrame, limit: int | None = None, silver: DataFrame | None = None
) -> DataFrame:
    """Articles still to be processed, in no order: all of them, or the `limit` oldest.

    The choice is made on keys. Texts are then read for the chosen ones, where they lie if the keys
    are few enough for Spark to send them there, and moved once if not.
    """
    todo = backlog(bronze, log, silver)
    return _rows(bronze, todo if limit is None else todo.orderBy(*queue_order()).limit(limit))


def _rows(bronze: DataFrame, keys: DataFrame) -> DataFrame:
    return bronze.join(keys.select(*_key(bronze)), _key(bronze), "left_semi")


# ---- open articles: what is not done yet, carried from compaction to compaction ----

def open_state(bronze: DataFrame, log: DataFrame, silver: DataFrame | None = None) -> DataFrame:
    """Articles that are new, failed or to be retried, from the whole history.

    With `silver`, an article that it holds is done though the log does not speak of it.
    """
    opened = _still_open(_new(bronze), current(log))
    if silver is None:
        return opened
    held = silver.select(F.col("bronze_id").alias("id"), F.lit(NEW).alias("status"))
    return opened.join(held, ["id", "status"], "left_anti").select(opened.columns)


def advance(opened: DataFrame, fresh: DataFrame, log: DataFrame) -> DataFrame:
    """Open articles after new ones (`fresh`, of Bronze) and new status rows have come in."""
    return _still_open(opened.unionByName(_new(fresh)), current(log))


def strays(opened: DataFrame, fresh: DataFrame, log: DataFrame) -> DataFrame:
    """Ids that new status rows put back though they were done."""
    back = log.filter(F.col("status").isin(FAILED, RETRY)).select(F.col("bronze_id").alias("id")).distinct()
    return back.join(opened.select("id"), "id", "left_anti").join(fresh.select("id"), "id", "left_anti")


def _new(bronze: DataFrame) -> DataFrame:
    day = F.col("ingest_date") if "ingest_date" in bronze.columns else F.to_date("ingested_at")
    none = {"status": F.lit(NEW), "error": F.lit(None).cast("string"), "logged_at": F.lit(None).cast("timestamp")}
    return bronze.select("id", "ingested_at", day.alias("ingest_date")).withColumns(none)


def _still_open(articles: DataFrame, state: DataFrame) -> DataFrame:
    """Articles with the later of their own state and the given one, without those that are done."""
    latest = state.select(
        F.col("bronze_id").alias("id"), *[F.col(c).alias(f"_{c}") for c in ("status", "error", "logged_at")]
    )
    joined = articles.join(latest, "id", "left")
    later = F.col("_status").isNotNull() & (F.col("logged_at").isNull() | (F.col("_logged_at") >= F.col("logged_at")))
    now = {c: F.when(later, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("status", "error", "logged_at")}
    return joined.select("id", "ingested_at", "ingest_date", *[v.alias(c) for c, v in now.items()]).filter(
        F.col("status").isin(NEW, FAILED, RETRY)
    )


def open_queue(bronze: DataFrame, opened: DataFrame, limit: int | None = None) -> DataFrame:
    """The work queue from open articles: no log and no Silver is read, texts for the chosen ones only."""
    todo = opened.filter(F.col("status").isin(NEW, RETRY))
    return _rows(bronze, todo if limit is None else todo.orderBy(*queue_order()).limit(limit))


def failures(opened: DataFrame) -> DataFrame:
    """Ids and errors of the failed ones among open articles."""
    return opened.filter(F.col("status") == FAILED).select("id", F.col("error").alias("processing_error"))


def retry_open(opened: DataFrame, ids: DataFrame, at: datetime, run_id: str = "manual") -> DataFrame:
    """As `retry`, from open articles."""
    wanted = failures(opened).select(F.col("id").alias("bronze_id")).join(ids.select("bronze_id"), "bronze_id", "left_semi")
    return entries(wanted.withColumns({"status": F.lit(RETRY), "error": F.lit(None)}), at, run_id)


def _failures(log: DataFrame) -> DataFrame:
    failed = current(log).filter(F.col("status") == FAILED)
    return failed.select(F.col("bronze_id").alias("id"), F.col("error").alias("processing_error"))


def dead_letters(bronze: DataFrame, log: DataFrame, preview_chars: int = C.PREVIEW_CHARS) -> DataFrame:
    """Articles whose latest status is a failure, with a short preview of the text."""
    return letters(bronze, _failures(log), preview_chars)


def letters(bronze: DataFrame, failed: DataFrame, preview_chars: int = C.PREVIEW_CHARS) -> DataFrame:
    """The articles of failures (id, processing_error), with a short preview of the text.

    The preview is cut before the join, so whole texts do not travel.
    """
    shown = bronze.select(
        "id",
        "source_name",
        "source_url",
        "title",
        text.preview(F.col("raw_text"), preview_chars).alias("raw_text_preview"),
        "ingested_at",
    )
    return shown.join(failed, "id")


def dead_letter_page(bronze: DataFrame, log: DataFrame, limit: int) -> DataFrame:
    """The newest dead letters, newest first."""
    newest = [F.col("ingested_at").desc_nulls_last(), F.col("id").asc()]
    keys = bronze.select(*_key(bronze), "ingested_at").join(_failures(log), "id", "left_semi")
    page = _rows(bronze, keys.orderBy(*newest).limit(limit))
    return dead_letters(page, log).orderBy(*newest)


def retry(log: DataFrame, ids: DataFrame, at: datetime, run_id: str = "manual") -> DataFrame:
    """Rows to append so that the failed ones among `ids` (column bronze_id) re-enter the queue."""
    failed = current(log).filter(F.col("status") == FAILED).select("bronze_id")
    wanted = failed.join(ids.select("bronze_id"), "bronze_id", "left_semi")
    return entries(wanted.withColumns({"status": F.lit(RETRY), "error": F.lit(None)}), at, run_id)


def entries(outcomes: DataFrame, at: datetime, run_id: str) -> DataFrame:
    """Status rows of outcomes (bronze_id, status, error)."""
    return outcomes.select(
        "bronze_id",
        F.col("status").cast("string").alias("status"),
        F.col("error").cast("string").alias("error"),
        times.instant(at).alias("logged_at"),
        F.lit(run_id).alias("run_id"),
    )


def noise(batch: DataFrame, silver: DataFrame, failed: DataFrame) -> DataFrame:
    """Batch articles with neither a signal nor a failure (key bronze_id in all three)."""
    return (
        batch.select("bronze_id")
        .distinct()
        .join(silver.select("bronze_id"), "bronze_id", "left_anti")
        .join(failed.select("bronze_id"), "bronze_id", "left_anti")
    )
