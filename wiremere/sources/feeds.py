"""Landed RSS and Atom files as feed entries, read with Spark's XML source."""

import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wiremere.functions import text
from wiremere.operators import feeds
from wiremere.schemas import FEED_ENTRY

log = logging.getLogger(__name__)

# The element of an entry and of its feed, with the fields read from each.
LAYOUTS = {
    "rss": {
        "entry": "item",
        "entry_schema": (
            "link string, title string, description string, `content:encoded` string, "
            "pubDate string, category array<string>, author array<string>, "
            "`dc:creator` array<string>"
        ),
        "feed": "channel",
    },
    "atom": {
        "entry": "entry",
        "entry_schema": (
            "link array<struct<_href: string, _rel: string>>, title string, summary string, "
            "content string, published string, category array<struct<_term: string>>, "
            "author array<struct<name: string>>"
        ),
        "feed": "feed",
    },
}


def _elements(spark: SparkSession, paths: list[str], tag: str, schema: str) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", tag).schema(f"{schema}, _corrupt_record string")
    return reader.load(paths).withColumn("feed_url", F.col("_metadata.file_path"))


def _rss(raw: DataFrame) -> DataFrame:
    return raw.select(
        "feed_url",
        "link",
        "title",
        F.col("description").alias("summary"),
        F.col("`content:encoded`").alias("content"),
        F.col("pubDate").alias("published"),
        F.col("category").alias("tags"),
        F.coalesce("`dc:creator`", "author").alias("authors"),
        F.col("_corrupt_record").alias("malformed"),
    )


def _atom(raw: DataFrame) -> DataFrame:
    links = F.filter("link", lambda x: x["_rel"].isNull() | (x["_rel"] == "alternate"))
    return raw.select(
        "feed_url",
        F.get(links, 0)["_href"].alias("link"),
        "title",
        "summary",
        "content",
        "published",
        F.col("category._term").alias("tags"),
        F.col("author.name").alias("authors"),
        F.col("_corrupt_record").alias("malformed"),
    )


def _found(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that lead to something. A missing feed is logged and costs the others nothing."""
    conf, found = spark._jsparkSession.sessionState().newHadoopConf(), []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(conf).globStatus(place):
            found.append(path)
        else:
            log.error("no feed at %s", path)
    return found


def _rank(spark: SparkSession, paths: list[str]):
    """Which of the given paths a file belongs to, the first one first."""
    conf, starts = spark._jsparkSession.sessionState().newHadoopConf(), []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        whole = place.getFileSystem(conf).makeQualified(place).toString()
        starts.append(re.sub("^file:/+", "file:/", re.split(r"[*?\[{]", whole)[0]))
    known = F.array(*[F.lit(s) for s in starts])
    url = F.regexp_replace("feed_url", "^file:/+", "file:/")
    return F.array_position(F.transform(known, lambda s: F.startswith(url, s)), True).cast("int")


def read_entries(spark: SparkSession, paths: str | list[str], kind: str = "rss") -> DataFrame:
    """Entries of feed files with their feed's title and their place in the file.

    A file is read by one task from top to bottom, so the row id of the scan grows with the place.
    The feed's title is read apart and joined by file; a feed without one keeps NULL. `feed_rank` is
    the place of the feed's path among those given, `malformed` the text of an entry that is not
    well-formed. Paths that do not exist are left out and logged.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    paths = _found(spark, given)
    extra = "feed_rank int, malformed string"
    if not paths:
        names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FEED_ENTRY.fields)
        return spark.createDataFrame([], f"{names}, {extra}")
    layout = LAYOUTS[kind.lower()]
    raw = _elements(spark, paths, layout["entry"], layout["entry_schema"])
    entries = (_rss if kind.lower() == "rss" else _atom)(raw).withColumns(
        {"pos": F.monotonically_increasing_id(), "feed_rank": _rank(spark, given)}
    )
    titles = (
        _elements(spark, paths, layout["feed"], "title string")
        .groupBy("feed_url")
        .agg(F.min(text.filled(F.col("title"))).alias("feed_title"))
    )
    return entries.join(titles, "feed_url", "left").select(*FEED_ENTRY.names, "feed_rank", "malformed")


def read_feed(
    spark: SparkSession,
    paths: str | list[str],
    kind: str = "rss",
    query: str | None = None,
    max_entries: int | None = None,
) -> DataFrame:
    """Articles of feed files, with the reason to reject them, if any."""
    return feeds.to_articles(read_entries(spark, paths, kind), query, max_entries)


def read_wire(
    spark: SparkSession, path: str | list[str], query: str | None = None, max_entries: int | None = None
) -> DataFrame:
    """The same of files that may be RSS or Atom, by the same reader."""
    both = [read_entries(spark, path, kind) for kind in LAYOUTS]
    return feeds.to_articles(both[0].unionByName(both[1]), query, max_entries)
