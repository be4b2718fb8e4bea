"""Licence scan by a positional index of rare words.

Templates are short licence passages. Words get an inverse document frequency from all documents. The
index posts (template, place) for the RARE rarest words of each template's mandatory key phrases. A file
looks its licence words up from the highest frequency weight down; each occurrence gives the start that the
template would have, the word's place in the file minus its place in the template, and the starts of one
template's words are intersected, so only those stay where its rarest words stand at their places
relative to each other. There the key phrases are verified word for word. A match must hold them, so
looking up no other words loses none. Its score is the share of the template's weight that is found in place.

Base phrases are templates of their own whose key phrase is the whole text, so all their places come
out of the same index, at any number.

Nulls: a null text is empty: no words, no labels, score 0. Repeated rows give repeated results.
"""

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiremere.llm import words
from wiremere.llm.tables import prepare

RARE = 3  # words of a template that are looked up and intersected


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]  # phrases that must stand at their place
    base: bool = False


# The base phrases and their labels.
BASE = [
    Template("cc-by", "cc by", ("cc by",), True),
    Template("gpl", "general public license", ("general public license",), True),
    Template("reserved", "all rights reserved", ("all rights reserved",), True),
]

# Usual notices of public licences.
NOTICES = [
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    Template("cc-by-sa", "licensed under cc by sa", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd", ("cc by nd",)),
    Template("cc-by", "creative commons attribution license", ("creative commons attribution",)),
]
TEMPLATES = BASE + NOTICES


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of texts, number of words before each text, and text of each word.

    Words are runs of a-z, 0-9 and all beyond ASCII, A-Z lower-cased.
    """
    data, offsets = words.utf8(texts)
    starts, ends, before = words.spans(words.ALNUM[data], offsets)
    found = words.hashes(words.LOWER[data], starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return found, before, np.repeat(np.arange(len(offsets) - 1), np.diff(before))


def vocabulary(templates: list[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.text.split()})


class Index:
    """The templates' words, with postings of the rarest words of each one's key phrases."""

    def __init__(self, templates: list[Template], idf: dict[str, float]):
        self.templates = templates
        names = vocabulary(templates)
        hashes = np.array([words.hash_word(w) for w in names], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        number = {names[n]: i for i, n in enumerate(order)}
        self.weight = np.array([idf[names[n]] for n in order])
        self.words = [[number[w] for w in t.text.split()] for t in templates]
        self.total = [self.weight[ws].sum() for ws in self.words]
        # Places of all words by falling weight, the order in which files look them up.
        self.rank = np.empty(len(order), np.int64)
        self.rank[np.lexsort((np.arange(len(order)), -self.weight))] = np.arange(len(order))
        self.key_places, self.lookups = [], []
        self.postings: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for t, template in enumerate(templates):
            text, places = template.text.split(), []
            for key in template.keys:
                phrase = key.split()
                at = next(i for i in range(len(text)) if text[i : i + len(phrase)] == phrase)
                places += range(at, at + len(phrase))
            self.key_places.append(sorted(set(places)))
            rare = sorted(self.key_places[-1], key=lambda p: (self.rank[self.words[t][p]], p))[:RARE]
            self.lookups.append(len(rare))
            for turn, place in enumerate(rare):
                self.postings[self.words[t][place]].append((t, place, turn))
        # A template's rarest word: without any of these a file matches nothing.
        self.leads = sorted(w for w, posts in self.postings.items() if any(turn == 0 for _, _, turn in posts))

    def starts(self, places: np.ndarray, tokens: np.ndarray) -> dict[int, np.ndarray]:
        """Where each template can start: the intersected votes of its rarest words."""
        order = np.argsort(tokens, kind="stable")
        found, begins = np.unique(tokens[order], return_index=True)
        occurrences = dict(zip(found.tolist(), np.split(places[order], begins[1:])))
        starts: dict[int, np.ndarray] = {}
        looked_up = dict.fromkeys(range(len(self.templates)), 0)
        for token in sorted(occurrences.keys() & self.postings.keys(), key=lambda w: self.rank[w]):
            for t, place, turn in self.postings[token]:
                # A rarer word that is missing, or never stands at its place, has ruled the template out.
                if turn == looked_up[t] and (turn == 0 or len(starts[t])):
                    votes = occurrences[token] - place
                    starts[t] = votes if turn == 0 else np.intersect1d(starts[t], votes, assume_unique=True)
                    looked_up[t] += 1
        return {t: s for t, s in starts.items() if looked_up[t] == self.lookups[t] and len(s)}

    def matches(self, places: np.ndarray, tokens: np.ndarray) -> list[tuple[int, int, float]]:
        """(template, start of its key phrase, score) from a file's licence words and their places, ascending."""
        found = []
        for t, starts in self.starts(places, tokens).items():
            for p in self.key_places[t]:
                starts = starts[self._stands(places, tokens, starts + p, self.words[t][p])]
            weight = np.zeros(len(starts))
            for p, w in enumerate(self.words[t]):
                weight += self.weight[w] * self._stands(places, tokens, starts + p, w)
            score = weight / self.total[t] if self.total[t] else np.ones(len(starts))
            found += [(t, s, c) for s, c in zip((starts + self.key_places[t][0]).tolist(), score.tolist())]
        return found

    @staticmethod
    def _stands(places: np.ndarray, tokens: np.ndarray, at: np.ndarray, word: int) -> np.ndarray:
        """Whether a word stands at some places of a file."""
        i = np.minimum(np.searchsorted(places, at), len(places) - 1)
        return (places[i] == at) & (tokens[i] == word)


def _counted(names: list[str]):
    """Documents per template word and partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = np.array([words.hash_word(w) for w in names], np.uint64)
        order = np.argsort(hashes)
        counts, documents = np.zeros(len(names), np.int64), 0
        for batch in batches:
            for start, end in words.slices(batch.column(0)):
                found, _, row = text_words(batch.column(0).slice(start, end - start))
                at = np.minimum(np.searchsorted(hashes[order], found), len(names) - 1)
                known = hashes[order][at] == found
                pairs = np.unique(row[known] * len(names) + order[at[known]])
                counts += np.bincount(pairs % len(names), minlength=len(names))
                documents += end - start
        yield pa.RecordBatch.from_arrays([pa.array([*names, ""]), pa.array([*counts, documents], pa.int64())], ["word", "documents"])

    return run


def inverse_frequencies(docs: DataFrame, templates: list[Template]) -> dict[str, float]:
    """IDF of the templates' words over all documents; as many numbers as templates have words."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(_counted(vocabulary(templates)), "word string, documents long")
    counts = {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("documents").alias("n")).collect()}
    total = counts.get("", 0)
    return {w: float(np.log((1 + total) / (1 + counts.get(w, 0))) + 1) for w in vocabulary(templates)}


MATCHES = "array<struct<label:string,word:long,score:double,base:boolean>>"
_MATCHES = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))


def scan(docs: DataFrame, templates: list[Template] | None = None, idf: dict[str, float] | None = None) -> DataFrame:
    """docs with n_words and matches (label, first word of its key phrase, score, base), by place."""
    prepare(docs.sparkSession)
    templates = templates or TEMPLATES
    index = Index(templates, idf or inverse_frequencies(docs, templates))
    kept = [c for c in docs.columns if c not in ("n_words", "matches")]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept) + f", n_words long, matches {MATCHES}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept))
            for start, end in words.slices(texts):
                found, before, row = text_words(texts.slice(start, end - start))
                at = np.minimum(np.searchsorted(index.hashes, found), len(index.hashes) - 1)
                known = np.flatnonzero(index.hashes[at] == found)
                anchored = np.isin(at[known], index.leads)
                rows = [[] for _ in range(end - start)]
                cuts = np.searchsorted(known, before)
                for r in np.unique(row[known[anchored]]):
                    some = known[cuts[r] : cuts[r + 1]]
                    hits = index.matches(some - before[r], at[some])
                    rows[r] = sorted(
                        [{"label": templates[t].label, "word": w, "score": s, "base": templates[t].base} for t, w, s in hits],
                        key=lambda m: (m["word"], m["label"], not m["base"]),
                    )
                columns = [batch.column(i).slice(start, end - start) for i in range(len(kept))]
                columns += [pa.array(np.diff(before)), pa.array(rows, _MATCHES)]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "n_words", "matches"])

    inputs = [*[F.col(f"`{c}`") for c in kept], F.col("text").cast("string").alias("_text")]
    return docs.select(inputs).mapInArrow(run, schema)
