"""Text expressions: stripping, fallbacks, hashing, previews, keyword tests."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wiremere import constants as C


def strip(text: Column) -> Column:
    """Remove white space, not only blanks, at both ends; one linear pass, no regex."""
    return F.btrim(text, F.lit(C.WHITE_SPACE))


def filled(text: Column) -> Column:
    """NULL for an empty string."""
    return F.nullif(text, F.lit(""))


def content_hash(url: Column, text: Column) -> Column:
    """Dedup key: SHA-256 of the stripped URL, or of the stripped text where there is no URL.

    Never NULL, so that a join on it needs no NULL test, which would hash every row twice. Rows
    with neither URL nor text share a key; the article contract keeps them out.
    """
    return F.sha2(F.coalesce(filled(strip(url)), strip(text), F.lit("")), 256)


def derived_id(kind: str, key: Column) -> Column:
    """A row id that every retry of a task computes alike."""
    return F.left(F.sha2(F.concat_ws("|", F.lit(kind), key), 256), F.lit(32))


def preview(text: Column, chars: int = C.PREVIEW_CHARS) -> Column:
    return F.left(text, F.lit(chars))


def entry_title(title: Column) -> Column:
    return F.coalesce(title, F.lit(C.DEFAULT_TITLE))


def resolve_text(content: Column, summary: Column, title: Column) -> Column:
    """Full content, else summary, else title, stripped."""
    return strip(F.coalesce(filled(content), filled(summary), entry_title(title)))


def keyword_match(query: str, title: Column, summary: Column) -> Column:
    """Case-insensitive substring test on title and summary."""
    haystack = F.concat(entry_title(title), F.lit(" "), F.coalesce(summary, F.lit("")))
    return F.contains(F.lower(haystack), F.lit(query.lower()))


def model_input(
    text: Column, title: Column, url: Column, max_chars: int | None = None
) -> Column:
    """What an extraction model reads: headline and URL where there are any, then the text.

    A caller whose model has a limited context passes `max_chars`, which cuts the text.
    """
    def block(label: str, value: Column) -> Column:
        return F.when(filled(value).isNotNull(), F.concat(F.lit(label), value, F.lit("\n\n")))

    return F.concat(
        F.coalesce(block(C.HEADLINE_LABEL, title), F.lit("")),
        F.coalesce(block(C.URL_LABEL, url), F.lit("")),
        F.lit(C.TEXT_LABEL),
        text if max_chars is None else F.left(text, F.lit(max_chars)),
    )


def is_link(url: Column) -> Column:
    return F.coalesce(F.startswith(url, F.lit("http")), F.lit(False))
