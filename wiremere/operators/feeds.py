"""Feed entries to articles: cap, text, dedup, keyword filter, metadata, contract."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremere.functions import documents, text
from wiremere.operators.ranking import first_per_key, top_per_key

MALFORMED = "entry is not well-formed"
EMPTY = "entry has no link, title or text"


def entry_order(entries: DataFrame) -> list[Column]:
    """Feeds in the order they were given where that is known, entries as they stand in the feed."""
    return [F.col(c) for c in ("feed_rank", "feed_url", "pos") if c in entries.columns]


def cap_entries(entries: DataFrame, max_entries: int | None = None) -> DataFrame:
    """The first entries of every feed; all of them without a number."""
    return entries if max_entries is None else top_per_key(entries, ["feed_url"], "pos", max_entries)


def with_text(entries: DataFrame) -> DataFrame:
    """Fill in the default title and the article text."""
    return entries.withColumns(
        {
            "title": text.entry_title(F.col("title")),
            "raw_text": text.resolve_text(F.col("content"), F.col("summary"), F.col("title")),
        }
    )


def drop_repeats(entries: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Keep the first entry per link (else title), minus keys in `seen` (column dedup_key)."""
    keyed = entries.withColumn(
        "dedup_key", F.coalesce(text.filled(F.col("link")), text.entry_title(F.col("title")))
    )
    # A feed's entries have places of their own, so no two entries tie.
    first = first_per_key(keyed, ["dedup_key"], entry_order(entries), unique=True)
    return first if seen is None else first.join(seen.select("dedup_key"), "dedup_key", "left_anti")


def match_keyword(entries: DataFrame, query: str | None) -> DataFrame:
    """Entries whose title or summary holds the query, in any case; all where there is none."""
    if not query:
        return entries
    return entries.filter(text.keyword_match(query, F.col("title"), F.col("summary")))


def with_source(entries: DataFrame) -> DataFrame:
    """Add the source tag and the metadata blob."""
    return entries.withColumns(
        {
            "source_name": F.concat(F.lit("rss::"), F.coalesce("feed_title", "feed_url")),
            "raw_metadata": documents.feed_metadata(
                *[F.col(c) for c in ("feed_title", "feed_url", "published", "tags", "authors")]
            ),
        }
    )


def reject_reason(source_name: Column, raw_text: Column) -> Column:
    """Why a row breaks the article contract; NULL for a good row."""
    blank = text.filled(text.strip(raw_text)).isNull()
    return F.when(text.filled(source_name).isNull(), F.lit("source_name is empty")).when(
        blank, F.lit("raw_text is empty")
    )


def check_contract(articles: DataFrame) -> DataFrame:
    """Add `reject_reason`; a reason that the source gave stays."""
    reason = reject_reason(F.col("source_name"), F.col("raw_text"))
    given = [F.col("reject_reason")] if "reject_reason" in articles.columns else []
    return articles.withColumn("reject_reason", F.coalesce(*given, reason))


def accepted(articles: DataFrame) -> DataFrame:
    return check_contract(articles).filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(articles: DataFrame) -> DataFrame:
    return check_contract(articles).filter(F.col("reject_reason").isNotNull())


def to_articles(
    entries: DataFrame,
    query: str | None = None,
    max_entries: int | None = None,
) -> DataFrame:
    """The whole chain, to articles with their order of arrival and the reason to reject them, if any.

    An entry the keyword drops still counts as seen, so dedup comes before the filter. Entries that
    are malformed (column `malformed`, the text of the entry) or empty are rejected, never filled in.
    """
    capped = cap_entries(entries, max_entries)
    if "malformed" not in capped.columns:
        capped = capped.withColumn("malformed", F.lit(None).cast("string"))
    said = F.coalesce(*[text.filled(F.col(c)) for c in ("link", "title", "summary", "content")])
    reason = F.when(F.col("malformed").isNotNull(), F.lit(MALFORMED)).when(said.isNull(), F.lit(EMPTY))
    bad = capped.withColumn("reject_reason", reason).filter("reject_reason is not null")
    good = capped.filter(F.col("malformed").isNull() & said.isNotNull())
    kept = match_keyword(drop_repeats(with_text(good)), query)
    kept = kept.withColumn("reject_reason", F.lit(None).cast("string"))
    found = kept.unionByName(bad.withColumn("raw_text", F.col("malformed")), allowMissingColumns=True)
    return check_contract(with_source(found)).select(
        "source_name",
        F.col("link").alias("source_url"),
        "title",
        "raw_text",
        "raw_metadata",
        F.struct(*entry_order(entries)).alias("arrival"),
        "reject_reason",
    )


def union_sources(*sources: DataFrame) -> DataFrame:
    """Articles of several sources as one table, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), sources)
