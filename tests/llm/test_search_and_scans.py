"""Top-k search, spot signatures and licence scans against plain loops."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from wiremere.llm import licences, queries, spots, topk, words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def best(rows, every=100, k=10):
    usable = {}
    out = set()
    kept = [(i, [int(np.floor(1024 * np.float32(x).astype(float))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    usable = kept
    for q, a in usable:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    return out


def vectors(n, seed=1, hot=0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.2, 6)]) for i in rng.permutation(n)]
    same = rows[0][1]
    return [(i, same if m < hot else v) for m, (i, v) in enumerate(rows)]


@pytest.mark.parametrize("rows", [vectors(700), vectors(900, 2, hot=300), vectors(5), [(0, [1.0])], []])
def test_top_k_equals_all_scores(spark, monkeypatch, rows):
    monkeypatch.setattr(topk, "RANGE_ROWS", 200)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "CHUNK_ROWS", 3)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {tuple(r) for r in topk.top_k(frame).collect()} == best(rows)


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, []), (100, [0.5, -0.25]), (7, [0.0, 0.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, score int, rank int")
    assert {tuple(r) for r in topk.top_k(frame).collect()} == best(rows)


def test_blocks_are_pruned_and_exact():
    rng = np.random.default_rng(5)
    blocks = []
    for b in range(8):
        m = rng.integers(-20, 20, (30, 5)) + b * 10
        blocks.append((np.arange(30) + 30 * b, m, m.min(axis=0), m.max(axis=0)))
    asked = rng.integers(0, 30, (4, 5))
    ((ids, vec, score),) = topk.search(np.array([-1, -2, -3, -4]), asked, blocks, 3)
    every = np.vstack([b[1] for b in blocks])
    for n, q in enumerate(asked):
        expected = sorted((-int(s), i) for i, s in enumerate(every @ q))[:3]
        assert [(-s, i) for s, i in zip(score[ids == -n - 1].tolist(), vec[ids == -n - 1].tolist())] == expected
    # Beyond doubles and beyond 64 bits the scores stay exact.
    for big in (1 << 30, 1 << 40):
        m = np.array([[big + 1, 1], [big, 2]])
        ((_, vec, score),) = topk.search(np.array([9]), np.array([[big, 1]]), [(np.arange(2), m, m.min(axis=0), m.max(axis=0))], 1)
        assert (vec.tolist(), score.tolist()) == ([0], [min(big * (big + 1) + 1, topk.MOST)])


def test_top_k_of_several_lengths_and_large_components(spark, monkeypatch):
    """One short vector at the smallest id changes nothing for the others; nothing finite is left out."""
    monkeypatch.setattr(topk, "RANGE_ROWS", 50)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    rng = np.random.default_rng(5)
    rows = [(i, rng.uniform(-1, 1, 3 if i % 7 else 5).tolist()) for i in range(1, 300)] + [(0, [0.5])]
    rows += [(400, [1e14, 0.25, -1.0]), (500, [-1e14, 1e14, 2.0]), (401, [3e38, 1.0, 0.0]), (600, [2.0**60, 1.0, 1.0])]
    terms = {i: [int(1024 * int(x)) if abs(x) > 2**43 else int(np.floor(1024 * x)) for x in v] for i, v in rows}
    expected = set()
    for q in terms:
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(terms[q], t)), i) for i, t in terms.items() if i != q and len(t) == len(terms[q]))
            expected |= {(q, n + 1, i, min(max(-s, topk.LEAST), topk.MOST)) for n, (s, i) in enumerate(scores[:10])}
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.top_k(frame).collect()} == expected
    assert {q for q, *_ in expected} == {100, 200, 400, 500, 600}


def plain_spots(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    content = [i for i, w in enumerate(found) if w not in spots.ANCHORS]
    out = set()
    for i, w in enumerate(found):
        chain = [found[c] for c in content if c > i][: spots.CHAIN]
        if w in spots.ANCHORS and len(chain) == spots.CHAIN:
            out.add((w, *chain))
    if found:
        out.add(("", *([found[c] for c in content[: spots.CHAIN]] or found)))
    return out


TEXTS = ["", None, "the", "the of and", "word", "The cat, the dog and a bird of prey sat on the mat", "der Hund ist groß und die Katze klein", " ", "x the y", "the end the"]


def test_spots_equal_plain_ones():
    texts = TEXTS + ["a b c the d e f " * 30, "é ü the ö ä ß of å"]
    sets = spots.spot_sets(pa.array(texts))
    plain = [plain_spots(t) for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i, a in enumerate(plain):
        for j, b in enumerate(plain):
            expected = len(a & b) / len(a | b) if a | b else 1.0
            assert spots.likeness(sets[i], sets[j]) == expected


@pytest.mark.parametrize("n", [0, 1, 2, 37])
def test_neighbours(spark, n):
    texts = [TEXTS[i % len(TEXTS)] if i % 3 else f"the {i} of words é\U0001f600 " * (i % 7) for i in range(n)]
    docs = spark.createDataFrame([(i * 3, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, h int")
    learned = spots.frequent(docs)
    got = {r.doc_id: r for r in spots.with_neighbours(docs).collect()}
    assert sorted(got) == [3 * i for i in range(n)]
    for i in range(n):
        own, after = texts[i] or "", texts[i - 1] or ""
        k = len(own) // 3
        edited = own[: len(own) - k] + after[:k]
        sets = spots.spot_sets(pa.array([own, edited, after]), learned=learned)
        row = got[3 * i]
        assert (row.n_chars, row.edited_text) == (len(own), edited)
        assert (row.fingerprint, row.edited_fingerprint) == (spots.written(sets[0]), spots.written(sets[1]))
        assert (row.near_edited, row.near_next) == (spots.likeness(sets[0], sets[1]), spots.likeness(sets[0], sets[2]))


def test_neighbours_of_repeats_and_null_ids(spark):
    rows = [(1, "the a b c"), (1, "the a b c"), (1, "x"), (None, "last"), (2, None)]
    got = spots.with_neighbours(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == sorted((i or 0, len(t or "")) for i, t in rows)
    assert {r.edited_text for r in got if r.doc_id is None} == {"las"}  # the first, document 2, is empty


def test_similar_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = ["the " + " of ".join(f"w{x}" for x in rng.integers(0, 60, 60)) for _ in range(4)]
    rows = []
    for i in range(60):
        found = base[i % 4].split()
        for _ in range(int(rng.integers(0, 4))):
            found[rng.integers(len(found))] = f"z{i}"
        rows.append((i, " ".join(found)))
    rows += [(100, ""), (101, None), (102, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    members, pairs = spots.similar_pairs(docs)
    classes = {r.doc_id: r.class_id for r in members.collect()}
    sets = dict(zip([i for i, _ in rows], spots.spot_sets(pa.array([t for _, t in rows]), learned=spots.frequent(docs))))
    heads = sorted({c for i, c in classes.items() if len(sets[i])})
    expected = {(a, b) for n, a in enumerate(heads) for b in heads[n + 1 :] if spots.likeness(sets[a], sets[b]) >= 0.75}
    assert {(r.u, r.v) for r in pairs.collect()} == expected
    assert expected and classes[102] == classes[0] and classes[101] == 100


ANCHORLESS = [f"w{i}" for i in range(300)]


def test_spots_cover_texts_without_anchors():
    whole, edited = "|".join(ANCHORLESS), "|".join(ANCHORLESS[:200] + [f"z{i}" for i in range(100)])
    one = "|".join(["new", *ANCHORLESS])
    sets = spots.spot_sets(pa.array([whole, edited, one, "a b c d e f g", "a b c d e f h"]))
    assert 0.4 < spots.likeness(sets[0], sets[1]) < 0.6
    assert spots.likeness(sets[0], sets[2]) > 0.9  # chains do not shift with a word before them
    assert spots.likeness(sets[3], sets[4]) < 1
    # Any word changes the fingerprint; so it does among common words alone.
    for text in (ANCHORLESS[:30], ["the", *ANCHORLESS[:30]], spots.ANCHORS[:30], [*ANCHORLESS[:2], *spots.ANCHORS[:30], "x"]):
        changed = [" ".join([*text[:i], "von", *text[i + 1 :]]) for i in range(len(text))]
        own, *others = spots.spot_sets(pa.array([" ".join(text), *changed]))
        assert all(spots.likeness(own, other) < 1 for other, w in zip(others, text) if w != "von")


def test_words_of_most_documents_are_anchors(spark):
    rows = [(i, f"qua {i} qua b{i} c{i} d{i} e{i} " + "rare" * (i < 152 // spots.SHARE)) for i in range(150)]
    docs = spark.createDataFrame([*rows, (150, None), (151, "")], "doc_id long, text string")
    learned = spots.frequent(docs)
    assert learned.tolist() == [words.hash_word("qua")]
    got = {r.doc_id: r for r in spots.with_neighbours(docs).collect()}
    for i, text in rows:
        assert got[i].fingerprint == spots.written(spots.spot_sets(pa.array([text]), learned=learned)[0])
    assert got[9].fingerprint != spots.written(spots.spot_sets(pa.array([rows[9][1]]))[0])


@pytest.mark.parametrize("n", [1, 2, 49, 51, 99, 101])
def test_fingerprints_do_not_change_with_the_size_of_a_table(spark, n):
    """Each row three times over: every word stands in the same share of the documents."""
    texts = [f"qua {i} qua b{i} c{i % 9} d{i % 50} e{i} " * (1 + i % 3) for i in range(n)]
    found = []
    for times in (1, 3):
        docs = spark.createDataFrame([(i + n * k, t) for i, t in enumerate(texts) for k in range(times)], "doc_id long, text string")
        found.append({(r.text, r.fingerprint) for r in spots.fingerprints(docs).collect()})
    assert found[0] == found[1] and len(found[0]) == n


def test_replaced_third_of_an_anchorless_text_lowers_near_edited(spark):
    docs = spark.createDataFrame([(2, "|".join(ANCHORLESS)), (1, "|".join(f"z{i}" for i in range(300)))], "doc_id long, text string")
    assert all(0.3 < r.near_edited < 0.7 for r in spots.with_neighbours(docs).collect())


BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def plain_scan(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for phrase, label in BASE.items() for i in range(len(found)) if found[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(found), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_licences(spark, tmp_path):
    texts = [
        "This work is licensed under the GNU General Public License, version 3.",
        "x CC-BY cc by CC BY-NC 4.0, All Rights\nReserved all rights all rights reserved",
        "Released under the MIT License.",
        "Licensed under the Apache License, Version 2.0.",
        "general public licence; rights reserved; cc, b y; mitlicense",
        "all rights reservedé all rights reserved",
        "cc " * 500 + "by " * 500,
        "",
        None,
        "the of and 2 0",
    ]
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, label string, matches int").write.parquet(f"{path}/documents.parquet")
    rows = sorted(queries.QUERIES["op7_licence_scan"](spark, path).collect())
    for row, text in zip(rows, texts):
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == plain_scan(text)
        assert 0 <= row.score <= 1
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
    assert [r.labels for r in rows] == ["gpl,gpl-3.0", "cc-by,cc-by-nc,reserved", "mit", "apache-2.0", "", "reserved", "cc-by", "", "", ""]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licences.scan(empty).count() == 0


def plain_matches(found, idf):
    """Every template at every start, word for word."""
    out = []
    for t, template in enumerate(licences.TEMPLATES):
        text = template.text.split()
        keys = set()
        for key in template.keys:
            at = next(i for i in range(len(text)) if text[i : i + len(key.split())] == key.split())
            keys |= set(range(at, at + len(key.split())))
        for start in range(-len(text), len(found)):
            here = [0 <= start + p < len(found) and found[start + p] == w for p, w in enumerate(text)]
            if all(here[p] for p in keys):
                out.append((t, start + min(keys), round(sum(idf[w] for w, x in zip(text, here) if x) / sum(idf[w] for w in text), 9)))
    return sorted(out)


@pytest.mark.parametrize("rare", [1, 2, 3, 50])
def test_matches_equal_all_templates_at_all_places(monkeypatch, rare):
    monkeypatch.setattr(licences, "RARE", rare)
    rng = np.random.default_rng(rare)
    names = licences.vocabulary(licences.TEMPLATES)
    # Weights with many ties, so that the order of lookups has to break them.
    idf = {w: float(rng.integers(1, 6)) for w in names}
    index = licences.Index(licences.TEMPLATES, idf)
    number = {w: int(np.flatnonzero(index.hashes == np.uint64(words.hash_word(w)))[0]) for w in names}
    total = 0
    for _ in range(60):
        found = []
        for _ in range(int(rng.integers(1, 12))):
            text = licences.TEMPLATES[rng.integers(len(licences.TEMPLATES))].text.split()
            cut = int(rng.integers(0, len(text))) if rng.random() < 0.4 else 0
            found += text[cut:] if rng.random() < 0.5 else text[: len(text) - cut]
            if rng.random() < 0.3:
                found[int(rng.integers(len(found)))] = str(rng.choice([*names, "other"]))
        known = [(i, number[w]) for i, w in enumerate(found) if w in number]
        places, tokens = (np.array(x, np.int64) for x in zip(*known))
        got = sorted((t, s, round(c, 9)) for t, s, c in index.matches(places, tokens))
        assert got == plain_matches(found, idf)
        total += len(got)
    assert total > 100


def test_starts_are_those_where_all_looked_up_words_agree():
    """Words that all occur, but never at their places relative to each other, leave no start."""
    idf = dict.fromkeys(licences.vocabulary(licences.TEMPLATES), 1.0)
    index = licences.Index(licences.TEMPLATES, idf)
    number = {w: int(np.flatnonzero(index.hashes == np.uint64(words.hash_word(w)))[0]) for w in ("all", "rights", "reserved")}
    reserved = [t.label for t in licences.TEMPLATES].index("reserved")
    apart = ["all"] * 300 + ["reserved"] * 300 + ["rights"] * 300
    for text, starts in ((apart, None), (apart + ["all", "rights", "reserved"], [900])):
        got = index.starts(np.arange(len(text)), np.array([number[w] for w in text]))
        assert (got[reserved].tolist() if reserved in got else None) == starts


def test_every_place_on_real_texts(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    for row in queries.QUERIES["op7_licence_scan"](spark, sf).collect():
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == plain_scan(texts[row.doc_id])


def test_edited_digests(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    order = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in queries.QUERIES["op4_spot_signatures"](spark, sf).collect()}
    for n, i in enumerate(order):
        own, after = texts[i], texts[order[(n + 1) % len(order)]]
        edited = own[: len(own) - len(own) // 3] + after[: len(own) // 3]
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
