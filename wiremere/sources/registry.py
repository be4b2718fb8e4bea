"""Article sources by name."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource

from wiremere.operators import feeds
from wiremere.session import ship_package
from wiremere.sources.archive import read_archive
from wiremere.sources.feeds import read_feed, read_wire

Source = Callable[..., DataFrame]

SOURCES: dict[str, Source] = {"rss": read_feed, "wire": read_wire, "archive": read_archive}


def register(name: str, source: Source | type[DataSource]) -> None:
    """Add a source: a function (spark, **options) -> articles, or a Python data source."""
    if isinstance(source, type):
        SOURCES[name.lower()] = lambda spark, **options: load(spark, source, **options)
    else:
        SOURCES[name.lower()] = source


def load(spark: SparkSession, source: type[DataSource], **options: str) -> DataFrame:
    """Read a Python data source."""
    ship_package(spark)
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(**options).load()


def find(name: str) -> Source:
    """The source registered under a name, in any case."""
    reader = SOURCES.get(name.lower())
    if reader is None:
        raise KeyError(f"unknown source {name!r}, available: {sorted(SOURCES)}")
    return reader


def source(spark: SparkSession, name: str, **options) -> DataFrame:
    """The articles of a registered source that keep the contract."""
    return feeds.accepted(find(name)(spark, **options))
