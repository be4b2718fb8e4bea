"""Personal data: strict segments against the patterns, the field's programs against enumeration."""

import functools
import itertools
import random
import re
import time

import numpy as np
import pytest

from wiremere.llm import pii

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
CARDS = "4111111111111111 5500005555555559"


def strict(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            checks = [
                True,
                kind != 1 or all(int(p) <= 255 for p in m.group().split(".")),
                14 <= len(digits) <= 19 and sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0,
                10 <= len(digits) <= 15,
            ]
            if checks[kind]:
                found.append((m.start(), m.end(), kind))
    return sorted(found, key=lambda s: (s[0], s[2]))


def test_strict_segments_equal_the_patterns():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab12345678901234567890@@..+ -()é_%") for _ in range(rng.randrange(60))) for _ in range(20_000)]
    texts += ["a.b@c.d.e@f.g @x.y a@b c@d-.e", "+1 (123) 456-7890 1.2.3.4.5.6.7.8 001.02.003.4 256.1.1.1 4111 1111-1111 1111x", CARDS]
    assert any(strict(t) for t in texts)
    for text in texts:
        assert pii.base_segments(text) == strict(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + " ", "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 100_000, "1 " * 150_000):
        pii.base_segments(text)


def overlap(a, b):
    return a[0] < b[1] and b[0] < a[1]


@pytest.mark.parametrize("seed", range(6))
def test_programs_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    starts = rng.integers(0, 12, 7)
    segments = sorted({(int(s), int(s + rng.integers(1, 6)), 0) for s in starts})
    scores = rng.normal(0, 2, len(segments))
    sets = [
        c
        for n in range(len(segments) + 1)
        for c in itertools.combinations(range(len(segments)), n)
        if not any(overlap(segments[a], segments[b]) for a, b in itertools.combinations(c, 2))
    ]
    value = {c: scores[list(c)].sum() for c in sets}
    assert value[tuple(sorted(pii.best(segments, scores)))] == pytest.approx(max(value.values()))
    weight = {c: np.exp(v) for c, v in value.items()}
    expected = [sum(w for c, w in weight.items() if i in c) / sum(weight.values()) for i in range(len(segments))]
    assert pii.marginals(segments, scores) == pytest.approx(expected)


SAMPLE = [f"word{i} some.one{i}@mail{i}.example.com then +1 ({200 + i}) 555-{1000 + i} and 10.{i}.7.9 end 4111111111111111 x" for i in range(40)]


def test_model_adds_loose_spellings_and_keeps_strict_ones():
    weights = pii.train(SAMPLE)
    text = "mail ann [at] host.org or call (369) 555-1339; visa 4111_1111_1111_1111, host 10[.]0[.]0[.]1, b@c.de"
    found = pii.segments(text, weights)
    assert [(text[s:e], pii.KINDS[k], base) for s, e, k, base in found] == [
        ("ann [at] host.org", "email", False),
        ("(369) 555-1339", "phone", False),
        ("4111_1111_1111_1111", "card", False),
        ("10[.]0[.]0[.]1", "ip", False),
        ("b@c.de", "email", True),
    ]
    glued = "x 4111111111111111 5500005555555559 y"  # one run of digits for the strict pattern
    assert [(glued[s:e], base) for s, e, _, base in pii.segments(glued, weights)] == [(c, False) for c in CARDS.split()]
    for clean in ("on 2024-01-02 at 12:30", "nr 1234.5678.1234.5678", "version 1.2.3", "a (at) b", "1234567890123456", "look (at) this"):
        assert pii.segments(clean, weights) == []


@functools.cache
def field():
    return pii.train(SAMPLE)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("x 4111 1111 1111 1111 12/27 y", ["4111 1111 1111 1111"]),
        ("x 4111-1111-1111-1111 123 y", ["4111-1111-1111-1111"]),
        ("4111 1111 1111 1111 5500 0055 5555 5559", ["4111 1111 1111 1111", "5500 0055 5555 5559"]),
        ("3782 822463 10005 3782-822463-10005", ["3782 822463 10005", "3782-822463-10005"]),
        ("7 3782 822463 10005 12/27", ["3782 822463 10005"]),
        ("3782_822463_10005", ["3782_822463_10005"]),
        ("+49 30 12345678 10.0.0.1", ["+49 30 12345678", "10.0.0.1"]),
        ("+44 20 7946 0958 4111111111111111", ["+44 20 7946 0958", "4111111111111111"]),
        ("ask " + "long" * 30 + ".name [at] host.org now", ["long" * 30 + ".name [at] host.org"]),
        ("x [at] " + "l" * 39 + ".example.com y", ["x [at] " + "l" * 39 + ".example.com"]),
        (
            "joe[at]firstsubdomainnameislong.averyveryverylongsecondlevelname.com, or",
            ["joe[at]firstsubdomainnameislong.averyveryverylongsecondlevelname.com"],
        ),
        ("a(at)b.c.d.e.f.g.example.org.", ["a(at)b.c.d.e.f.g.example.org"]),
        ("see " + "1 2 3 " * 20 + "and 17 23 " * 9 + "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", []),
    ],
)
def test_glued_numbers_and_long_local_parts(text, expected):
    assert [text[s:e] for s, e, _, _ in pii.segments(text, field())] == expected


def test_long_runs_of_candidates_take_linear_time():
    for text in ("1 " * 50_000, "1234 " * 20_000, "+1 " + "1.1-" * 50_000, "a[at" * 50_000, "a(at)b.c " * 20_000, "a" * 300_000 + "(at)"):
        pii.loose_segments(text)


@pytest.mark.parametrize("part", ["(369) 555-1339, ", "a@b.example.com and c(at)d.example.org, "])
def test_segments_take_linear_time(part):
    """Thousands of candidates, among as many strict segments: twice the text takes about twice the time."""

    def seconds(n):
        spent = []
        for _ in range(3):
            began = time.process_time()
            pii.segments(part * n, field())
            spent.append(time.process_time() - began)
        return min(spent)

    seconds(100)
    assert seconds(8000) <= 3 * seconds(4000)


def test_frames(spark):
    rows = [(1, "a b@c.de f", 1), (2, None, 1), (None, "", 1), (4, "é +1 (369) 555-1339\U0001f600 1.2.3.4", 1), (1, "a b@c.de f", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    found = {r.doc_id: r for r in pii.find(docs, redacted=True).collect()}
    assert [tuple(s) for s in found[1].spans] == [("email", 2, 8, True)]
    assert found[1].text == "a [EMAIL] f"
    assert (found[2].spans, found[2].text, found[None].text) == ([], None, "")
    assert [tuple(s) for s in found[4].spans] == [("phone", 2, 19, True), ("ip", 21, 28, True)]
    assert found[4].text == "é [PHONE]\U0001f600 [IP]"
    assert pii.find(docs.limit(0)).count() == 0


def test_query_equals_the_patterns(spark):
    import hashlib

    from wiremere.llm import queries

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.QUERIES["op9_personal_data"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        base = strict(texts[row.doc_id])
        written = [f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in base]
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(k == n for _, _, k in base) for n in range(4))
        assert row.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(filter(None, row.spans.split(",")))


def test_overlapping_spans_are_redacted_once():
    text = "+10.1.2.3456789 x"
    assert [k for _, _, k, _ in pii.segments(text, pii.train([]))] == [3]
    assert pii.redact("abcdef", [(1, 4, 0, True), (2, 5, 3, True)]) == "a[EMAIL]f"
