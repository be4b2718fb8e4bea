"""Token alignment against a plain version that tokenises every whole text."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from wiremere.llm import alignment

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute_force(rows):
    """Expected rows for (doc_id, text): tokens as byte ranges, all overlaps, counts over all rows."""
    aligner = alignment.Aligner.of(*alignment.vocabulary_paths())
    found = []
    for _, text in rows:
        tokens = [[], []]
        raw = (" " + (text or "")).encode()
        if text:
            ids = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
            tables = aligner.bytes_a, aligner.bytes_b
            if all(b"".join(t[i] for i in own) == raw for own, t in zip(ids, tables)):
                for side, own, table in zip(tokens, ids, tables):
                    at = 0
                    for i in own:
                        side.append((i, at, at + len(table[i])))
                        at += len(table[i])
        links = [(a, b) for a, s, e in tokens[0] for b, t, f in tokens[1] if s < f and t < e]
        ends = [{t[2] for t in side} for side in tokens]
        groups, last = [], 0
        for cut in sorted(ends[0] & ends[1]):
            groups.append("|".join(",".join(str(i) for i, s, e in side if last <= s and e <= cut) for side in tokens))
            last = cut
        found.append((tokens, links, groups))
    count = Counter(pair for _, links, _ in found for pair in set(links))
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    out = []
    for (doc_id, _), (tokens, links, groups) in zip(rows, found):
        best = sum(count[p] == highest[p[0]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc_id, len(tokens[0]), len(tokens[1]), len(groups), len(links), best, sum(count[p] for p in links), digest))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, block string, n_a int")
    result = alignment.align(docs)
    assert result.columns == COLUMNS
    got = sorted(map(tuple, result.collect()), key=repr)
    assert got == sorted(brute_force(rows), key=repr)
    return got


ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\nb", "a \n b", "a\n b", "x\u00a0 y", "x\u00a0y z", "tab\tand more\t", "\n", "\x1c y z",
    "<|endoftext|> is text", "<s> </s> <unk> <0x41>", "▁ stands for a space", "a▁b c", "naïve Ünïcode ﬁ \u3000wide", "漢字 かな 한국", "emoji 👩‍👩‍👧 👍🏽",
    "\x00 null \x01", "e\u0301 combining", "don't we'll I'M", "1234567890 12 3", "-----=====-----", "word " * 40, "x" * 3000, "ab" * 500 + " c",
]


def test_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a b c"), (None, None), (3, None), (1, "twice"), (1, "twice")]
    got = check(spark, rows)
    assert sum(r[7] == "" for r in got) >= 5


def test_copies_count_as_documents(spark):
    rows = [(i, "the same words here") for i in range(60)] + [(100 + i, f"the {w} words") for i, w in enumerate("abcdefgh")]
    check(spark, rows)


def test_table_and_blocks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60)
    rows = [tuple(r) for r in docs.collect()]
    rows = [(i, t[:2500] if t else t) for i, t in rows]
    whole = check(spark, rows)
    # Small blocks, and few pairs a row, give the same.
    aligner = alignment.Aligner.of(*alignment.vocabulary_paths())
    texts = sorted({t for _, t in rows if t})
    one = alignment.align_block(aligner, texts, np.ones(len(texts), np.int64))
    apart = [alignment.align_block(aligner, [t], np.ones(1, np.int64)) for t in texts]
    for m in alignment.MEASURES:
        assert one[0][m].tolist() == [a[0][m][0] for a in apart]
    assert one[1] == [a[1][0] for a in apart]
    assert whole


def test_words_apart_equal_whole_texts():
    aligner = alignment.Aligner.of(*alignment.vocabulary_paths())
    assert aligner.by_words
    texts = [t for t in ODD if t]
    one = alignment.align_block(aligner, texts, np.ones(len(texts), np.int64))
    aligner.by_words = False
    try:
        whole = alignment.align_block(aligner, texts, np.ones(len(texts), np.int64))
    finally:
        aligner.by_words = True
    assert one[1] == whole[1]
    for a, b in zip(one[3], whole[3]):
        assert a.tolist() == b.tolist()


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "")]])
def test_tables_without_tokens(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [tuple(r) for r in alignment.align(docs).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")] * len(rows)


def test_packing():
    values = np.array([0, 1, 255, 256, 70_000, 2**31])
    assert alignment._values(alignment._planes(values)).tolist() == values.tolist()
    assert alignment._values(alignment._planes(values[:0])).tolist() == []
