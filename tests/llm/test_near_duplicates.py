"""Near-duplicate groups against all pairs of full shingle sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wiremere.llm import minhash, tables, words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def brute_force(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def result(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, shared = [], [rng.choice(vocabulary) for _ in range(60)]
    base = [rng.choice(vocabulary) for _ in range(140)]
    for i in range(90):  # one large group, edited more and more, so that copies of copies drift apart
        edited = base[:]
        for _ in range(rng.choice([0, 1, 3, 6, 9])):
            edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
        rows.append(" ".join(edited))
    for i in range(40):  # a passage in many documents
        rows.append(" ".join(shared + [rng.choice(vocabulary) for _ in range(rng.choice([10, 20, 60]))]))
    rows += ["one two", "ONE  two", "three", "", None, "   ", "a b c d e", "A B C D E", "é x y z ü"]
    rows += [" ".join(rng.choice(vocabulary) for _ in range(50)) for _ in range(20)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(1000 + 7 * n, rows[i]) for n, i in enumerate(order)]


def test_groups_equal_brute_force(spark):
    rows = corpus()
    got = result(spark, rows)
    assert {i: v[:2] for i, v in got.items()} == brute_force(rows)
    assert all(kept == (i == component) for i, (_, component, kept) in got.items())
    assert len({v[1] for v in got.values()}) < len(rows) - 50


def test_links_at_the_threshold(spark):
    # 24 and 32 shingles, the smaller inside the larger: exactly three quarters.
    long = " ".join(f"a{i}" for i in range(36))
    short = " ".join(f"a{i}" for i in range(28))
    shorter = " ".join(f"b{i}" for i in range(27)) + " x"
    longer = " ".join(f"b{i}" for i in range(36))
    got = result(spark, [(1, long), (2, short), (3, longer), (4, shorter)])
    assert got == {1: (32, 1, True), 2: (24, 1, False), 3: (32, 3, True), 4: (24, 4, True)}


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(None, "p q r s t u"), (5, "p q r s t u"), (5, "p q r s t u"), (9, "p q r s t u"), (7, None)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, component_id int, bands int")
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == [(0, None, True), (5, 5, True), (5, 5, True), (7, 7, True), (9, 5, False)]


def test_texts_of_one_doc_id_go_by_themselves(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(6), t) for _, t in corpus() for _ in range(rng.choice([1, 1, 2]))]
    # The expected groups are those of rows with ids of their own.
    groups = brute_force(list(enumerate(t for _, t in rows)))
    least, heads = {}, set()
    for n, (_, component) in groups.items():
        least[component] = min(least.get(component, rows[n][0]), rows[n][0])
    want = sorted((rows[n][0], rows[n][1] or "", least[c], rows[n][0] == least[c]) for n, (_, c) in groups.items())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs, rows=True).join(
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").distinct(), ["doc_id", "text_hash"]
    )
    found = found.collect()
    assert sorted((r.doc_id, r.text or "", r.component_id, r.kept) for r in found) == want
    # One text of one doc_id of every group stays.
    of = {row: c for row, (_, c) in zip(rows, (groups[n] for n in range(len(rows)))) if shingles(row[1])}
    for r in found:
        if r.stays and shingles(r.text):
            heads.add((of[(r.doc_id, r.text)], r.doc_id, r.text))
    assert sorted(c for c, _, _ in heads) == sorted(set(of.values()))


def test_empty_table(spark):
    assert result(spark, []) == {}


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(100, 100)]
    got = {r.node: r.component for r in tables.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)}


def test_hashes_of_a_long_buffer_equal_those_of_its_parts():
    text = " ".join(f"word{i % 5000} {'x' * (i % 90)}" for i in range(90_000)) + " " + "y" * 5_000_000
    long, short = (words.shingle_sets(pa.array([t]), 1)[0] for t in (text, " ".join(sorted(set(text.split())))))
    assert long.tolist() == short.tolist()


@pytest.mark.parametrize("width", [1, 3, 5])
def test_shingles_of_arrow_slices(width):
    texts = pa.array(["x", None, "", "A b\tC d e f\x0bg h", "a b c\x1fd e f g h", "é" * 9000])
    values, offsets = words.shingle_sets(texts.slice(1), width)
    alone = [words.shingle_sets(texts.slice(i, 1), width)[0] for i in range(1, 6)]
    assert [values[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [a.tolist() for a in alone]
    lengths = [max(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) - width + 1, bool((t or "").strip())) for t in texts[1:].to_pylist()]
    assert np.diff(offsets).tolist() == lengths
