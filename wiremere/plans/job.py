"""One run: ingest, Bronze, extraction, Silver and status, statistics, exports."""

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiremere.functions import times
from wiremere.operators import bronze, extraction, feeds, status
from wiremere.plans import exports
from wiremere.plans.lake import Commit, Lake
from wiremere.schemas import ARTICLE
from wiremere.session import materialise, run_folder
from wiremere.sources import registry

log = logging.getLogger(__name__)

Extractor = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class JobOptions:
    """Parameters of a run. `batch_size` None works off the whole backlog."""

    source: str = "rss"
    source_options: dict = field(default_factory=dict)
    query: str | None = None
    dry_run: bool = False
    batch_size: int | None = None
    lenient: bool = False
    as_of: date | None = None
    export_to: str | None = None


@dataclass(frozen=True)
class RunResult:
    run_id: str
    ingested: int
    inserted: int
    duplicates: int
    outcomes: dict[str, int]
    bronze_total: int
    silver_total: int
    dlq_total: int
    rejected: int = 0


def fetch(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Read a source once and keep what it gave: articles with their content hash, and rejected rows."""
    # Numbered as stored, so that rows of equal arrival have an order too.
    given = materialise(feeds.check_contract(articles).withColumn("row_number", F.monotonically_increasing_id()))
    good = given.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return bronze.with_hash(good), given.filter(F.col("reject_reason").isNotNull())


def store(lake: Lake, batch: DataFrame, run_at: datetime) -> tuple[int, int, int]:
    """Store the batch's new articles in a commit; batch rows, inserted rows, duplicates."""
    with lake.commit() as commit:
        return _insert(commit, batch, run_at)


def _insert(commit: Commit, batch: DataFrame, run_at: datetime) -> tuple[int, int, int]:
    """The rows are worked out while they are written, and counted there."""
    lake = commit.lake
    # Sources that know the order of arrival give it; otherwise any fixed order will do.
    whole = F.sha2(F.to_json(F.struct(*ARTICLE.names)), 256)
    order = F.col("arrival") if "arrival" in batch.columns else whole
    numbered = "row_number" in batch.columns
    orders = [order, F.col("row_number")] if numbered else [order]
    fresh = bronze.new_rows(batch, lake.known_hashes(batch), orders, unique=numbered)
    inserted, ingested = commit.append("bronze", bronze.stamp(fresh, run_at)), batch.count()
    return ingested, inserted, ingested - inserted


def _reject(commit: Commit, rows: DataFrame, run_at: datetime) -> int:
    """Store what the contract kept out, with the reason; the number of rows."""
    count = commit.append("rejects", rows.withColumn("rejected_at", times.instant(run_at)))
    if count:
        log.warning("%d rows rejected, see the table rejects", count)
    return count


def process(
    lake: Lake,
    extract: Extractor,
    batch_size: int | None,
    run_at: datetime,
    run_id: str,
    lenient: bool = False,
) -> dict[str, int]:
    """Extract the queue's head and store signals and states in one commit; records per outcome.

    The commit is open from the choice of articles on, so no other run works on the same ones. The
    replies are stored before they are routed, so both writes see the same ones.
    """
    with lake.commit() as commit:
        opened = materialise(lake.open_articles())
        queue = status.open_queue(lake.bronze(), opened, batch_size)
        routed = materialise(extraction.route(extract(queue), lenient))
        outcomes = {r["outcome"]: r["records"] for r in extraction.batch_outcome(routed).collect()}
        if outcomes:
            # Once the open articles are compacted, only one that was taken up before can be in Silver.
            before = opened.filter(F.col("status") == status.RETRY).select(F.col("id").alias("bronze_id"))
            before = before if lake.snapshot().compacted else None
            signals = extraction.silver_rows(routed, run_at)
            commit.append("silver", extraction.not_yet_stored(signals, lake.silver(), before))
            commit.append("status", extraction.status_rows(routed, run_at, run_id))
    return outcomes


def run_job(
    lake: Lake,
    options: JobOptions | None = None,
    extract: Extractor = extraction.lexicon_payloads,
    run_at: datetime | None = None,
) -> RunResult:
    """Run once. A source that fails is logged, and the backlog is processed all the same."""
    with run_folder(lake.spark):
        return _run(lake, options or JobOptions(), extract, run_at)


def _run(lake: Lake, options: JobOptions, extract: Extractor, run_at: datetime | None) -> RunResult:
    run_at = run_at or datetime.now(UTC)
    run_id = uuid.uuid4().hex
    lake.create()
    wanted = dict(options.source_options, **({"query": options.query} if options.query else {}))
    read = registry.find(options.source)
    counts, rejected = (0, 0, 0), 0
    try:
        batch, bad = fetch(read(lake.spark, **wanted))
    except Exception as error:  # a source is a caller's code: whatever it raises, the backlog waits
        log.error("reading %s failed: %s", options.source, error)
    else:
        with lake.commit() as commit:
            counts, rejected = _insert(commit, batch, run_at), _reject(commit, bad, run_at)
    outcomes = {}
    if not options.dry_run:
        outcomes = process(lake, extract, options.batch_size, run_at, run_id, options.lenient)
    if options.export_to:
        as_of = options.as_of or run_at.date()
        exports.export_all(lake.silver(), options.export_to, as_of)
    lake.compact()
    lake.views()
    stats = lake.stats().first()
    return RunResult(run_id, *counts, outcomes, *stats, rejected)
