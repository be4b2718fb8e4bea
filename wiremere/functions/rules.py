"""Deterministic text rules: category lexicon, dollar amounts, action flag.

They stand in for a language model where none is plugged in; they are not its equal. A lower-cased text
is read once, by one pattern over all words and stems, dollar amounts and ends of sentences, whatever their
number. What it finds, in the order of the text, is a short array of hits; every rule works on those.
"""

import re
from collections.abc import Iterable, Mapping
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from wiremere import constants as C

# Word borders spelled out, since \b treats accented letters differently from one Java to the next.
WORD_CHAR = r"[\p{L}\p{N}_]"
WORD_END = f"(?!{WORD_CHAR})"
DOLLARS = r"\$[0-9]+(?:\.[0-9]+)? ?(?:billion|bn|million|m)" + WORD_END

# A sentence ends at a mark before white space, or with its line. "$6.4 billion" stays whole.
SENTENCE_END = r"(?<=[.!?])\s|[\r\n]"

COMPANIES = C.COMPETITOR_NAMES + C.BROKER_NAMES
ACTION_STEMS = C.DEAL_STEMS + C.PERIL_STEMS + C.SANCTION_STEMS + C.DECLARED_STEMS
ACTION_WORDS = [
    *COMPANIES, *C.REGULATORS, *C.SANCTION_TARGETS, *C.EMERGENCY_PHRASES, *C.DOWNGRADE_WORDS, *C.RATING_AGENCIES,
    *C.SPECULATIVE_WORDS, *C.POSITIVE_WORDS, *C.NEGATIVE_WORDS,
]


def _pattern(words: Iterable[str], stems: Iterable[str] = (), facts: bool = False) -> str:
    """Group 1 at every place where something is found, without moving on over it, so hits may overlap.

    At one place the longest word is taken; a stem that is no word there, with one more character. Words
    and stems are sorted by their first character, which decides quickly at most places.
    """
    stems = sorted({s.lower() for s in stems})
    if any(re.search(r"\W", s) for s in stems):
        raise ValueError("stems are parts of single words")
    # A stem that ends where the word ends is a word.
    words = sorted({w.lower() for w in words} | set(stems))
    branches = []
    for first, group in groupby(sorted({*words, *stems}), key=lambda x: x[0]):
        own = [*group]
        whole = [re.escape(w[1:]) for w in sorted(own, key=len, reverse=True) if w in words]
        begun = [re.escape(w[1:]) for w in sorted(own, key=len, reverse=True) if w in stems]
        ends = [f"(?:{'|'.join(whole)}){WORD_END}"] + [f"(?:{'|'.join(begun)}){WORD_CHAR}"] * bool(begun)
        branches.append(f"{re.escape(first)}(?:{'|'.join(ends)})")
    starts = "".join(re.escape(c) for c in sorted({x[0] for x in words}))
    found = [f"(?<!{WORD_CHAR})(?:{'|'.join(branches)})"] + [DOLLARS, SENTENCE_END] * facts
    return f"(?=[{starts}{r'$' if facts else ''}{r'\s' if facts else ''}])(?=({'|'.join(found)}))"


def keyword_pattern(keywords: Iterable[str]) -> str:
    return _pattern(keywords)


def action_pattern(keywords: Iterable[str] = ()) -> str:
    """Everything the action rules and the sentiment look for, and more keywords if given."""
    return _pattern([*ACTION_WORDS, *keywords], ACTION_STEMS, facts=True)


def scan(lowered: Column, pattern: str) -> Column:
    """What a pattern finds in a lower-cased text, in order; NULL for NULL."""
    return F.regexp_extract_all(lowered, F.lit(pattern), F.lit(1))


def _texts(texts: Iterable[str]) -> Column:
    return F.array(*[F.lit(t.lower()) for t in texts])


def has_word(hits: Column, words: Iterable[str]) -> Column:
    """Whether one of the words is among the hits.

    None of the rules' own words begins with another one and a blank; `keyword_hits` can tell those.
    """
    return F.arrays_overlap(hits, _texts(words))


def has_stem(hits: Column, stems: Iterable[str]) -> Column:
    """Whether a hit starts with one of the stems."""
    begun = f"^(?:{'|'.join(re.escape(s.lower()) for s in stems)})"
    return F.exists(hits, lambda h: F.rlike(h, F.lit(begun)))


def keywords_among(hits: Column, keywords: Iterable[str]) -> Column:
    """The keywords among the hits, in the order given. One that begins a longer hit is there too."""
    keywords = list(dict.fromkeys(keywords))
    longer = {
        w: [k.lower() for k in keywords if re.match(re.escape(w.lower()) + r"\W", k.lower())] for w in keywords
    }
    begun = {w: more for w, more in longer.items() if more}
    for w, more in begun.items():
        hits = F.when(F.arrays_overlap(hits, _texts(more)), F.array_append(hits, F.lit(w.lower()))).otherwise(hits)
    lowered = list(dict.fromkeys(w.lower() for w in keywords))
    given = F.create_map(*[x for low in lowered for x in (F.lit(low), F.array(*[F.lit(w) for w in keywords if w.lower() == low]))])
    # The hits stand outside of the lambda, where they would be worked out for each keyword.
    found = F.transform(F.array_intersect(_texts(lowered), hits), lambda k: F.element_at(given, k))
    return F.coalesce(F.flatten(found), F.array().cast("array<string>"))


def keyword_hits(lowered: Column, keywords: Iterable[str]) -> Column:
    """The keywords that a lower-cased text holds as whole words, in the order given."""
    keywords = list(keywords)
    return keywords_among(scan(lowered, keyword_pattern(keywords)), keywords)


def category_scores(hits: Column, lexicon: Mapping[str, list[str]] = C.LEXICON) -> dict[str, Column]:
    """Number of a category's keywords among the hits, in category name order."""
    return {
        category: F.size(F.array_intersect(hits, F.array(*[F.lit(w) for w in lexicon[category]])))
        for category in sorted(lexicon)
    }


def sentiment(hits: Column) -> Column:
    """By words of praise and of trouble: both are MIXED, none is NEUTRAL."""
    good, bad = has_word(hits, C.POSITIVE_WORDS), has_word(hits, C.NEGATIVE_WORDS)
    return (
        F.when(good & bad, F.lit("MIXED"))
        .when(good, F.lit("POSITIVE"))
        .when(bad, F.lit("NEGATIVE"))
        .otherwise(F.lit("NEUTRAL"))
    )


def largest_usd(hits: Column) -> Column:
    """The largest dollar amount among the hits, 0 if there is none."""
    amounts = F.transform(
        F.filter(hits, lambda h: F.startswith(h, F.lit("$"))),
        lambda h: F.regexp_extract(h, r"[0-9]+(?:\.[0-9]+)?", 0).cast("double") * F.when(F.contains(h, F.lit("b")), 1e9).otherwise(1e6),
    )
    return F.coalesce(F.array_max(amounts), F.lit(0.0))


def top_usd(lowered: Column) -> Column:
    """The largest dollar amount with a unit in a lower-cased text, 0 if there is none."""
    return largest_usd(F.regexp_extract_all(lowered, F.lit(DOLLARS), F.lit(0)))


def action_rule(hits: Column) -> Column:
    """Whether a sentence reports, as a fact, a large deal, a catastrophe, a sanction or a downgrade.

    Deals and downgrades need a named company, sanctions a named company or a reinsurer. Speculation
    counts in the sentence of the event only. Few texts hold the words of an event at all; only their
    hits are dealt out to sentences.
    """
    # Ends of sentences are hits of white space, which no other hit consists of.
    line = F.array_join(F.transform(hits, lambda h: F.when(F.rlike(h, F.lit(r"^\s$")), F.lit("\n")).otherwise(h)), "\t")
    sentences = F.transform(F.split(line, "\n"), lambda s: F.split(s, "\t"))
    found = F.exists(sentences, lambda s: _event(s) & ~has_word(s, C.SPECULATIVE_WORDS))
    return F.when(_event(hits, large=F.lit(True)), found).when(hits.isNotNull(), F.lit(False))


def _event(hits: Column, large: Column | None = None) -> Column:
    """The words of an event; `large` takes the place of the amounts' test."""
    at_least = lambda limit: largest_usd(hits) >= limit if large is None else large
    deal = has_stem(hits, C.DEAL_STEMS) & has_word(hits, COMPANIES) & at_least(C.DEAL_USD)
    emergency = has_word(hits, C.EMERGENCY_PHRASES) & has_stem(hits, C.DECLARED_STEMS)
    catastrophe = has_stem(hits, C.PERIL_STEMS) & (at_least(C.PERIL_USD) | emergency)
    sanction = (
        has_word(hits, C.REGULATORS) & has_stem(hits, C.SANCTION_STEMS) & has_word(hits, COMPANIES + C.SANCTION_TARGETS)
    )
    downgrade = has_word(hits, C.DOWNGRADE_WORDS) & has_word(hits, C.RATING_AGENCIES) & has_word(hits, COMPANIES)
    return deal | catastrophe | sanction | downgrade


def gate_action(flag: Column, confidence: Column, threshold: float = C.ACTION_CONFIDENCE) -> Column:
    """No action below the confidence threshold."""
    return F.when(confidence.cast("double") < threshold, F.lit(False)).otherwise(flag)
