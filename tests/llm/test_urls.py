"""URL filter against a plain tree, and on hosts whose blocked part is known."""

import re
from collections import Counter, defaultdict

import pytest

from wiremere.llm import urls

SF = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.fullmatch(r"(?s)([^/?#]*)([^?#]*).*", url.split("://", 1)[1]).groups()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def rule_of(host, path):
    fits = []
    for kind, rule in urls.RULES:
        own, start = rule.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            fits.append((len(rule), len(own), kind == "block", rule, kind))
    return max(fits)[3:] if fits else (None, None)


def brute_force(rows, labels=None, depth=urls.DEPTH):
    judged = []
    for n, (page_id, url) in enumerate(rows):
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        label = labels[n] if labels and labels[n] is not None else None if verdict is None else verdict == "block"
        marked = re.sub(f"(?i){urls.UUID[4:]}", "#", path)
        marked = re.sub(f"(?i){urls.HEXADECIMAL[4:]}", "#", marked, flags=re.A)
        marked = re.sub("[0-9]+", "#", marked)
        judged.append((page_id, host, path, rule, verdict, label, tuple(marked[1:].split("/", depth - 1)) if path else ()))
    template = {(j[1], j[6]): () for j in judged}
    weight = Counter((j[1], j[6]) for j in judged)
    levels = max((len(k[1]) for k in template), default=0)
    for level in range(levels):
        total, own = Counter(), Counter()
        for (host, segs), t in template.items():
            if len(segs) > level:
                total[host, t] += weight[host, segs]
                own[host, t, segs[level]] += weight[host, segs]
        for (host, segs), t in list(template.items()):
            if len(segs) > level:
                n = own[host, t, segs[level]]
                literal = n >= urls.LEAST_ROWS and n >= total[host, t] * urls.SHARE
                template[host, segs] = (*t, segs[level] if literal else "?")

    def statistics(level):
        nodes = defaultdict(lambda: defaultdict(lambda: {"n": 0, "labelled": 0, "blocked": 0, "spread": Counter()}))
        for _, host, _, _, _, label, segs in judged:
            t = template[host, segs]
            if len(t) > level:
                branch = nodes[host, t[:level]][t[level]]
                branch["n"] += 1
                branch["labelled"] += label is not None
                branch["blocked"] += bool(label)
                branch["spread"][t[level + 1 :]] += 1
        return nodes

    for level in reversed(range(levels)):
        renamed = {}
        for node, branches in statistics(level).items():
            below = sorted({b for x in branches.values() for b in x["spread"]})
            rows_ = [{**x, "segment": s, "spread": [x["spread"][b] for b in below]} for s, x in branches.items()]
            renamed |= {(*node, s): name for s, name in urls.merge(rows_).items()}
        for (host, segs), t in list(template.items()):
            if len(t) > level and (host, t[:level], t[level]) in renamed:
                template[host, segs] = (*t[:level], renamed[host, t[:level], t[level]], *t[level + 1 :])
    labelled, blocked = Counter(), Counter()
    for _, host, _, _, _, label, segs in judged:
        labelled[host, template[host, segs]] += label is not None
        blocked[host, template[host, segs]] += bool(label)
    out = []
    for page_id, host, path, rule, verdict, label, segs in judged:
        key = host, template[host, segs]
        purity = (blocked[key] + urls.SMOOTH) / (labelled[key] + 2 * urls.SMOOTH)
        method = "block" if purity >= urls.PURITY and labelled[key] else "allow"
        out.append((page_id, host, path, rule, verdict or method, labelled[key], purity))
    return out


def check(spark, rows, labels=None, **options):
    table = spark.createDataFrame([(*r, labels[n] if labels else None, "x", "y") for n, r in enumerate(rows)], "page_id long, url string, bad boolean, host string, segments string")
    found = urls.judge(table, blocked="bad" if labels else None, **options).collect()
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict, r.n_labelled, r.purity) for r in found]
    expected = brute_force(rows, labels, **options)
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    return found


def test_odd_urls(spark):
    odd = [
        None, "", "no scheme", "http://", "http:///x", "http://HOST.Example.NET/es/1", "x://a://b/c", "http://com", "http://com/", "http://a.com?x=/b",
        "http://a.com#f", "https://www.example.com/en/1", "https://x.www.example.com/en/", "http://example.com/en", "http://wwwexample.com/en/1",
        "http://ÄÖ.net/fr/1", "http://net/fr/", "http://notnet/fr/", "http://u@h.net:80/es/2?q#f", "http://h.org/a//b/", "http://h.org/a\nb/c", "http://h.org//",
        "http://h.org/550e8400-e29b-41d4-a716-446655440000/deadbeef01/decade", "http://h.org/" + "/".join("abcdefghijkl"), "http://h.org/" + "x" * 5000,
    ]
    found = check(spark, list(enumerate(odd)) + [(None, "http://h.net/es/1"), (1, "http://h.net/es/1"), (1, "http://h.net/es/1")])
    by_id = {r.page_id: r for r in found}
    assert (by_id[0].host, by_id[0].path, by_id[0].rule, by_id[0].verdict) == ("", "", None, "allow")
    assert (by_id[5].host, by_id[5].rule) == ("host.example.net", "net/es/")
    assert (by_id[7].path, by_id[7].rule, by_id[8].rule) == ("", None, "com/")
    assert (by_id[11].rule, by_id[12].rule, by_id[13].rule) == ("www.example.com/en/", "www.example.com/en/", "com/")


def test_registered_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()]
    found = check(spark, rows)
    assert len(found) == len(rows) and {r.verdict for r in found} == {"allow", "block"}


def test_empty_table(spark):
    assert check(spark, []) == []


def test_unlabelled_rows_of_bad_templates_are_found(spark):
    """One host with a third of all rows; half of the rows have labels, the others are predicted."""
    rows, truth = [], []
    for i in range(600):
        host = "hot.org" if i % 3 == 0 else f"h{i % 7}.org"
        kind = ["news", "win-now", "shop", "bonus"][i // 3 % 4]
        rows.append((i, f"http://{host}/{kind}/item-{i}.html?ref={i}"))
        truth.append(kind in ("win-now", "bonus"))
    labels = [t if n // 12 % 2 else None for n, t in enumerate(truth)]
    found = {r.page_id: r for r in check(spark, rows, labels)}
    assert [found[n].verdict == "block" for n in range(600)] == truth
    assert found[3].template == "hot.org/?bonus?win-now/item-#.html"


def test_variable_segments_become_wildcards(spark):
    rows = [(i, f"http://h.org/user/{chr(97 + i % 26)}{chr(97 + i // 26)}/posts") for i in range(200)]
    found = check(spark, rows, [True] * 150 + [None] * 50)
    assert {r.template for r in found} == {"h.org/user/?/posts"}
    assert {r.verdict for r in found} == {"block"}


def test_few_labels_reject_nothing(spark):
    rows = [(i, f"http://h.org/x/{i}") for i in range(30)]
    assert {r.verdict for r in check(spark, rows, [True, True] + [None] * 28)} == {"allow"}


def test_similar_and_different_branches():
    branch = {"segment": "a", "n": 100, "labelled": 50, "blocked": 50, "spread": [100, 0]}
    assert urls.alike(branch, {**branch, "n": 40, "labelled": 10, "blocked": 10, "spread": [40, 0]})
    assert not urls.alike(branch, {**branch, "blocked": 10})
    assert not urls.alike(branch, {**branch, "labelled": 0, "blocked": 0})
    assert not urls.alike(branch, {**branch, "spread": [0, 100]})
    assert urls.alike({**branch, "labelled": 0, "blocked": 0}, {**branch, "labelled": 0, "blocked": 0})


@pytest.mark.parametrize("rule", [("deny", "com/"), ("block", "/x/")])
def test_bad_rules(spark, rule):
    with pytest.raises(ValueError):
        urls.judge(spark.createDataFrame([], "page_id long, url string"), [rule])
