"""JSON and array expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def entity_list(raw: Column) -> Column:
    """The array in a JSON text; empty for NULL, malformed text and anything but an array."""
    return F.coalesce(F.from_json(raw, "array<string>"), F.array().cast("array<string>"))


def present(texts: list[Column]) -> Column:
    """An array of the distinct texts that are not NULL; unlike a lambda, it is generated code."""
    return F.array_except(F.array(*texts), F.array(F.lit(None).cast("string")))


def truthy(items: Column) -> Column:
    """An array without its NULL and empty elements; empty for a NULL array."""
    kept = F.filter(items, lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(kept, F.array().cast("array<string>"))


def feed_metadata(
    feed_title: Column, feed_url: Column, published: Column, tags: Column, authors: Column
) -> Column:
    """The metadata blob of a feed entry."""
    return F.to_json(
        F.struct(
            F.coalesce(feed_title, feed_url).alias("feed_title"),
            feed_url.alias("feed_url"),
            published.alias("published"),
            truthy(tags).alias("tags"),
            truthy(authors).alias("authors"),
        ),
        {"ignoreNullFields": "false"},
    )


def archive_metadata(source_id: Column, source_name: Column, date: Column, kind: Column) -> Column:
    """The metadata blob of an archive document."""
    return F.to_json(
        F.struct(
            source_id.alias("source_id"),
            source_name.alias("source_name"),
            date.alias("published_date"),
            kind.alias("document_type"),
        ),
        {"ignoreNullFields": "false"},
    )
