"""Token ids and decoded texts against the tokenizers library, merges against a plain loop."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wiremere.llm import bpe

PATH = bpe.vocabulary_path()
TEXTS = [
    "",
    " \n ",
    None,
    "Hello  wörld's <|endoftext|>ab 12　x  İΣΑΣ ﬁ !!&& don't I'D 'll",
    "a\x1cb \x1d c\x85d\x0be \xa0\xa0z \x00\x01 ǅ ß ẞ K Å ́a ́",
    "<|startoftext|><|end",
    "a</w> b",
    "日本語テキスト 한국어 été,naïve²",
    "x" * 700 + "é" * 90,
    "the" * 400,
    "ab " * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(library, texts, rows):
    for text, (ids, decoded) in zip(texts, rows):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert decoded == library.decode(expected, skip_special_tokens=False)


def test_texts_equal_the_library(library):
    rows = [r for _, _, ids, texts in bpe._round_trip(PATH, pa.array(TEXTS)) for r in zip(ids, texts)]
    check(library, TEXTS, rows)


def test_random_texts_equal_the_library(library):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abTHE in'śé ñß1!? \n\x1f|<>́ ") for _ in range(rng.randrange(90))) for _ in range(400)]
    check(library, texts, list(bpe.Codec(PATH).encode(texts)))


def test_trees_merge_as_a_plain_loop_does():
    codec, rng = bpe.Codec.of(PATH), random.Random(5)
    tokens = list({"".join(rng.choice("theinga") for _ in range(rng.randrange(1, 64))) for _ in range(300)})
    merged = codec.merge(tokens)
    ids, offsets = codec.symbols(tokens)
    for n, token in enumerate(tokens):
        row = ids[offsets[n] : offsets[n + 1]].tolist()
        assert codec.merge_long(row[:]) == np.frombuffer(merged[token][0], "<u4").tolist()
        while True:
            ranks = [codec.ranks.get(a * codec.width + b, 1 << 60) for a, b in zip(row, row[1:])]
            if not ranks or min(ranks) == 1 << 60:
                break
            at = ranks.index(min(ranks))
            row[at : at + 2] = [int(codec.merged[ranks[at]])]
        assert row == np.frombuffer(merged[token][0], "<u4").tolist()


def test_a_full_table_of_words_is_started_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 5)
    codec = bpe.Codec(PATH)
    texts = [f"word{i} other{i} the of and" for i in range(30)]
    check(library, texts, [r for t in texts for r in codec.encode([t])])


def test_long_words_do_not_pile_up(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_SIZE", 150_000)
    codec = bpe.Codec(PATH)
    texts = [f"{i}," + f"ab{i}é" * 2_000 for i in range(12)]
    found, held = [], []
    for text in texts:
        found += codec.encode([text])
        held.append(codec.held)
        assert held[-1] == bpe._size(codec.words) + bpe._size(codec.parts)
    check(library, texts, found)
    # Never more than the bound and what one call adds.
    assert max(held) <= 150_000 + max(held[0], max(b - a for a, b in zip(held, held[1:])))
    assert sum(held[i] > held[i + 1] for i in range(11)) >= 2 and len(codec.words) < 5


def test_frames(spark, library):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids int, decoded string")
    rows = bpe.encode(docs, decoded=True).orderBy("doc_id").collect()
    check(library, TEXTS, [(bytes(r.ids), r.decoded) for r in rows])
    again = bpe.decode(bpe.encode(docs)).orderBy("doc_id").collect()
    assert [r.decoded for r in again] == [r.decoded for r in rows]
    assert bpe.encode(docs.limit(0)).count() == 0
