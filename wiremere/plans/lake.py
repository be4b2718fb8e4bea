"""The lake: Parquet tables under one root, written in numbered commits, and views on them."""

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wiremere import schemas
from wiremere.operators import bronze as bronze_ops
from wiremere.operators import gold, status
from wiremere.plans.commits import COMMIT, CommitLog, Snapshot

# Per table: contract, day column to partition by, timestamp the day comes from.
TABLES = {
    "bronze": (schemas.BRONZE, "ingest_date", "ingested_at"),
    "silver": (schemas.SILVER, "extracted_date", "extracted_at"),
    "status": (schemas.STATUS, "log_date", "logged_at"),
    "rejects": (schemas.REJECT, "reject_date", "rejected_at"),
}
# Tables derived from them: contract, partition column.
DERIVED = {"open": (schemas.OPEN, "status"), "hashes": (schemas.HASHES, bronze_ops.PREFIX)}
# Commits after which a compaction is due: of the open articles, of the hash index.
COMPACT_OPEN, COMPACT_HASHES = 8, 64
# Hashes that are looked up as literals, where the statistics of row groups apply.
LITERAL_HASHES = 1000


@dataclass(frozen=True)
class Lake:
    """A lake as of now, or as of a snapshot where one is given."""

    spark: SparkSession
    root: str
    pinned: Snapshot | None = None

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.path("_commits"))

    def snapshot(self) -> Snapshot:
        return self.pinned or self.log.snapshot()

    def at(self, snapshot: Snapshot) -> "Lake":
        return replace(self, pinned=snapshot)

    def create(self) -> None:
        """Create missing tables and (re)create the views; safe on every start."""
        for table in (*TABLES, *DERIVED):
            # An empty file of commit 0, so that days and commits are folders from the start.
            first, commit = self._folders(table)
            nothing = schemas.empty(self.spark, self._stored(table)).drop(first, commit)
            nothing.write.mode("ignore").parquet(f"{self.path(table)}/{first}=__HIVE_DEFAULT_PARTITION__/{commit}=0")
        self.views()

    @staticmethod
    def _folders(table: str) -> list[str]:
        return [TABLES[table][1] if table in TABLES else DERIVED[table][1], COMMIT]

    def _stored(self, table: str) -> T.StructType:
        schema = (TABLES.get(table) or DERIVED[table])[0]
        day = [T.StructField(TABLES[table][1], T.DateType())] if table in TABLES else []
        return T.StructType([*schema.fields, *day, T.StructField(COMMIT, T.LongType())])

    def _files(self, table: str, shown: Column) -> DataFrame:
        """The given schema spares a look into the files; the commits are folders, so others are not read."""
        stored = self.spark.read.schema(self._stored(table)).parquet(self.path(table))
        return stored.filter(shown).drop(COMMIT)

    def read(self, table: str, after: int = 0) -> DataFrame:
        """A table with its day column, or what the commits after a number brought."""
        return self._files(table, self.snapshot().shows(after))

    def _derived(self, table: str) -> DataFrame:
        """A derived table: its last compaction."""
        return self._files(table, F.col(COMMIT) == self.snapshot().compacted.get(table, 0))

    def bronze(self) -> DataFrame:
        return self.read("bronze")

    def silver(self) -> DataFrame:
        return self.read("silver")

    def status(self) -> DataFrame:
        return self.read("status")

    def rejects(self) -> DataFrame:
        return self.read("rejects")

    # ---- what does not grow with the history ----

    def open_articles(self) -> DataFrame:
        """Articles that are new, failed or to be retried: the last compaction and what came since.

        Articles that are done are in neither, so their history is not read. Only where a commit speaks of
        an article that was done are its rows looked up in the whole log.
        """
        lake = self.at(self.snapshot())
        since = lake.pinned.compacted.get("open", 0)
        if not since:
            return status.open_state(lake.bronze(), lake.status(), lake.silver())
        opened, fresh, log = lake._derived("open"), lake.read("bronze", since), lake.read("status", since)
        strays = status.strays(opened, fresh, log)
        if strays.isEmpty():
            return status.advance(opened, fresh, log)
        again = status.open_state(
            lake.bronze().join(strays, "id", "left_semi"),
            lake.status().join(strays.withColumnRenamed("id", "bronze_id"), "bronze_id", "left_semi"),
        )
        return status.advance(opened, fresh, log).unionByName(again)

    def known_hashes(self, batch: DataFrame) -> DataFrame:
        """Hashes of a stored batch that Bronze holds, from the hash index.

        Only the folders of the batch's prefixes are read. A small batch is looked up by its hashes, so
        row groups that cannot hold one are skipped; a larger one is joined.
        """
        wanted = [r[0] for r in batch.select(bronze_ops.HASH).distinct().limit(LITERAL_HASHES + 1).collect()]
        few = len(wanted) <= LITERAL_HASHES
        if few:
            prefixes = sorted({h[: bronze_ops.PREFIX_CHARS] for h in wanted})
        else:
            prefixes = [r[0] for r in batch.select(bronze_ops.prefix()).distinct().collect()]  # 16 at most
        lake = self.at(self.snapshot())
        since = lake.pinned.compacted.get("hashes", 0)
        shown = lake.pinned.shows(since) | (F.col(COMMIT) == since)
        index = lake._files("hashes", shown).filter(F.col(bronze_ops.PREFIX).isin(prefixes))
        index = index.select(bronze_ops.HASH)
        return index.filter(F.col(bronze_ops.HASH).isin(wanted)) if few else bronze_ops.existing_hashes(batch, index)

    def compact(self, open_after: int = COMPACT_OPEN, hashes_after: int = COMPACT_HASHES) -> list[str]:
        """Rewrite derived tables whose last compaction is so many commits ago; their names."""
        seen = self.snapshot()
        limits = {"open": open_after, "hashes": hashes_after}
        due = [t for t, n in limits.items() if seen.number - seen.compacted.get(t, 0) >= n]
        if due:
            with self.commit() as commit:
                if "open" in due:
                    commit.compact("open", self.open_articles())
                if "hashes" in due:
                    since = seen.compacted.get("hashes", 0)
                    commit.compact("hashes", self._files("hashes", seen.shows(since) | (F.col(COMMIT) == since)))
        return due

    def vacuum(self, older_than: timedelta = timedelta(days=1)) -> int:
        """Delete folders that no reader of now needs: of void commits and of superseded compactions.

        Younger ones stay, for readers that hold an older snapshot and writers that were declared void.
        """
        seen, until, removed = self.snapshot(), time.time() - older_than.total_seconds(), 0
        for table in (*TABLES, *DERIVED):
            since = seen.compacted.get(table, 0) if table in DERIVED else 0
            pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/*/{COMMIT}=*")
            files = pattern.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
            for folder in files.globStatus(pattern):
                number = int(folder.getPath().getName().split("=")[1])
                if (number in seen.void or 0 < number < since) and folder.getModificationTime() / 1000 <= until:
                    removed += bool(files.delete(folder.getPath(), True))
        return removed

    # ---- writing ----

    @contextmanager
    def commit(self) -> Iterator["Commit"]:
        """Appends inside become visible together at the end, or not at all."""
        number = self.log.begin()
        commit = Commit(self, number, {})
        try:
            yield commit
        except BaseException:
            self.log.cancel(number)
            raise
        self.log.end(number, commit.compacted)

    def append(self, table: str, rows: DataFrame) -> int:
        """Append rows of the table's contract in a commit of their own; their number."""
        with self.commit() as commit:
            return commit.append(table, rows)

    def insert_one(
        self,
        source_name: str,
        raw_text: str,
        source_url: str | None = None,
        title: str | None = None,
        raw_metadata: str | None = None,
        at: datetime | None = None,
    ) -> str | None:
        """Insert one article; its id, or None where Bronze holds it already."""
        row = [(source_name, source_url, title, raw_text, raw_metadata)]
        article = bronze_ops.with_hash(self.spark.createDataFrame(row, schemas.ARTICLE))
        stamped = bronze_ops.stamp(article, at or datetime.now(UTC))
        with self.commit() as commit:
            if not self.known_hashes(article).isEmpty():
                return None
            commit.append("bronze", stamped)
        return stamped.first()["id"]

    def retry(self, ids: DataFrame, at: datetime | None = None) -> None:
        """Put failed articles (column bronze_id) back into the queue."""
        with self.commit() as commit:
            commit.append("status", status.retry_open(self.open_articles(), ids, at or datetime.now(UTC)))

    def views(self) -> None:
        lake = self.at(self.snapshot())
        lake.bronze().createOrReplaceTempView("bronze_articles")
        lake.silver().createOrReplaceTempView("silver_signals")
        lake.status().createOrReplaceTempView("bronze_status")
        gold.signal_summary(lake.silver()).createOrReplaceTempView("gold_signal_summary")
        letters = status.letters(lake.bronze(), status.failures(lake.open_articles()))
        letters.createOrReplaceTempView("gold_dead_letter_queue")

    def stats(self) -> DataFrame:
        lake = self.at(self.snapshot())
        return gold.stats_of(lake.bronze(), lake.silver(), status.failures(lake.open_articles()))


@dataclass(frozen=True)
class Commit:
    """An open commit of a lake."""

    lake: Lake
    number: int
    compacted: dict[str, int]

    def append(self, table: str, rows: DataFrame) -> int:
        """Append rows of the table's contract, in one folder per day; their number.

        Bronze gets Parquet bloom filters on the hash, and its hashes go into the index, read back from
        what was written.
        """
        schema, day, at = TABLES[table]
        seen = Observation()
        counted = rows.select(*schema.names, F.to_date(at).alias(day)).observe(seen, F.count(F.lit(1)).alias("rows"))
        self._write(table, counted)
        count = seen.get.get("rows", 0)
        if table == "bronze" and count:
            own = self.lake._files("bronze", F.col(COMMIT) == self.number)
            self._index(own.select(bronze_ops.HASH, bronze_ops.prefix()))
        return count

    def compact(self, table: str, rows: DataFrame) -> None:
        """The derived table as of this commit."""
        self._index(rows) if table == "hashes" else self._write(table, rows.select(*DERIVED[table][0].names))
        self.compacted[table] = self.number

    def _index(self, hashes: DataFrame) -> None:
        """Sorted files, one per prefix: the statistics of their row groups tell which can hold a hash."""
        hashes = hashes.repartition(bronze_ops.PREFIX).sortWithinPartitions(bronze_ops.PREFIX, bronze_ops.HASH)
        self._write("hashes", hashes)

    def _write(self, table: str, rows: DataFrame) -> None:
        writer = rows.withColumn(COMMIT, F.lit(self.number)).write.mode("append")
        if table == "bronze":
            writer = writer.option(f"parquet.bloom.filter.enabled#{bronze_ops.HASH}", "true")
        writer.partitionBy(*self.lake._folders(table)).parquet(self.lake.path(table))
