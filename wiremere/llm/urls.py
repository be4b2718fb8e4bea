"""URL filter: rules for hosts and path beginnings, and a tree of path templates per host for the rest.

Every path becomes a template, level by level. Numbers, long hexadecimal ids and UUIDs inside a segment are
marks from the start, which makes few distinct paths of many. Then, below each template so far, a segment
stays literal if it has a share of SHARE and at least LEAST_ROWS of the node's rows; all others are variable
and become one wildcard, so a node has at most 1 / SHARE + 1 children whatever the host. Segments from DEPTH
on stand together as one last segment, so no part of a long path is left out.

From the deepest level up, sibling branches are merged that statistics cannot tell apart: their rows spread
alike over what lies below, and the blocked shares of their labelled rows differ neither in a test of two
proportions nor by much once smoothed. Branches without labels only merge with each other. A template is
rejected if the blocked share of its labelled rows, smoothed by SMOOTH rows of either kind, reaches PURITY;
one without labelled rows has a purity of a half and is allowed. Labels are the verdicts of the rules, or a
column of the caller's where that is not null.

The path marks ?, # never occur in a path, so wildcards (`?`), numbers (`#`) and merged segments (`?a?b`) are
not confused with text.

Nulls: a null url, or one without ://, has an empty host and path and is allowed, unless a caller's labels of
other such rows speak against it. Repeated rows count and are judged each. An empty table gives an empty
result. Of rules that fit, the longest wins, then the one with the longer host, then block. Other columns of
the input are left out.
"""

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremere.llm.tables import prepare, stored

# The rules of the registered query.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
DEPTH = 8
SHARE = 0.04
LEAST_ROWS = 5
BUCKETS = 16  # of what lies below a branch, when two branches are compared
MOST_APART = 0.3  # total variation between two spreads over the buckets
MOST_PURITY_APART = 0.25
Z = 1.96
SMOOTH = 2.0
PURITY = 0.8

UUID = "(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
HEXADECIMAL = "(?i)\\b(?=[a-f]*[0-9])[0-9a-f]{8,}\\b"


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    rest = _rest(url)
    return F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")

    def rank(entry: tuple[str, str]) -> tuple:
        return len(entry[1]), entry[1].index("/"), entry[0] == "block"

    for kind, rule in sorted(rules, key=rank):
        own, start = rule.split("/", 1)
        if kind not in ("allow", "block") or not own:
            raise ValueError(f"not a rule: {kind} {rule}")
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(f"/{start}"))
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def segments(path: Column, depth: int = DEPTH) -> Column:
    """A path's segments with marks for numbers and ids; those from `depth` on are one."""
    marked = F.regexp_replace(F.regexp_replace(F.regexp_replace(path, UUID, "#"), HEXADECIMAL, "#"), "[0-9]+", "#")
    return F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(F.substr(marked, F.lit(2)), "/", depth))


def _at(column: str, level: int) -> Column:
    return F.get(column, F.lit(level))


def _prefix(column: str, level: int) -> Column:
    return F.array_join(F.slice(column, 1, level), "/")


def _generalised(paths: DataFrame, level: int) -> DataFrame:
    """paths with one more segment of their template: the literal one, or the wildcard."""
    paths = paths.withColumns({"prefix": _prefix("template", level), "segment": _at("segments", level)})
    inner = paths.filter("segment is not null")
    nodes = inner.groupBy("host", "prefix").agg(F.sum("n").alias("total"))
    children = inner.groupBy("host", "prefix", "segment").agg(F.sum("n").alias("own")).filter(F.col("own") >= LEAST_ROWS)
    literal = children.join(nodes, ["host", "prefix"]).filter(F.col("own") >= F.col("total") * SHARE)
    literal = literal.select("host", "prefix", "segment", F.lit(True).alias("literal"))
    joined = paths.join(literal, ["host", "prefix", "segment"], "left")
    segment = F.when(F.col("literal"), F.col("segment")).otherwise(F.lit("?"))
    template = F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", F.array(segment)))
    return joined.withColumn("template", template).drop("prefix", "segment", "literal")


def alike(a: dict, b: dict) -> bool:
    """Whether statistics cannot tell two branches (n, labelled, blocked, spread) apart."""
    if sum(abs(x / a["n"] - y / b["n"]) for x, y in zip(a["spread"], b["spread"])) / 2 > MOST_APART:
        return False
    if not a["labelled"] or not b["labelled"]:
        return not a["labelled"] and not b["labelled"]
    both = a["labelled"] + b["labelled"]
    share = (a["blocked"] + b["blocked"]) / both
    error = math.sqrt(share * (1 - share) * (1 / a["labelled"] + 1 / b["labelled"]))
    apart = abs(a["blocked"] / a["labelled"] - b["blocked"] / b["labelled"])
    smoothed = [(x["blocked"] + SMOOTH) / (x["labelled"] + 2 * SMOOTH) for x in (a, b)]
    return apart <= Z * error + 1e-12 and abs(smoothed[0] - smoothed[1]) <= MOST_PURITY_APART


def merge(branches: list[dict]) -> dict[str, str]:
    """New names of the siblings that are merged: each joins the first group whose sums it resembles."""
    groups: list[dict] = []
    for branch in sorted(branches, key=lambda x: x["segment"]):
        group = next((g for g in groups if alike(g, branch)), None)
        if group is None:
            groups.append({"members": [branch["segment"]], **{k: branch[k] for k in ("n", "labelled", "blocked", "spread")}})
            continue
        group["members"].append(branch["segment"])
        group["spread"] = [x + y for x, y in zip(group["spread"], branch["spread"])]
        for k in ("n", "labelled", "blocked"):
            group[k] += branch[k]
    merged = [g["members"] for g in groups if len(g["members"]) > 1]
    return {m: "?" + "?".join(s.strip("?") for s in members) for members in merged for m in members}


def _renamed(branches: Column) -> Column:
    renamed = F.udf(lambda rows: list(merge([r.asDict() for r in rows]).items()), "array<struct<segment string, renamed string>>")
    return renamed(branches)


def _merged(paths: DataFrame, level: int) -> DataFrame:
    """paths with alike siblings at a level under one name. A node's children are few by construction."""
    paths = paths.withColumns({"prefix": _prefix("template", level), "segment": _at("template", level)})
    below = F.pmod(F.xxhash64(F.array_join(F.expr(f"slice(template, {level + 2}, 1000000)"), "/")), F.lit(BUCKETS))
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    spread = [F.sum(F.when(below == b, F.col("n")).otherwise(F.lit(0))).alias(f"b{b}") for b in range(BUCKETS)]
    branches = paths.filter("segment is not null").groupBy("host", "prefix", "segment").agg(*sums, *spread)
    branch = F.struct("segment", "n", "labelled", "blocked", F.array(*[f"b{b}" for b in range(BUCKETS)]).alias("spread"))
    nodes = branches.groupBy("host", "prefix").agg(F.collect_list(branch).alias("branches")).filter(F.size("branches") > 1)
    names = nodes.select("host", "prefix", F.explode(_renamed(F.col("branches"))).alias("name")).select("host", "prefix", "name.*")
    joined = paths.join(names, ["host", "prefix", "segment"], "left")
    renamed = F.transform("template", lambda s, i: F.when((i == level) & F.col("renamed").isNotNull(), F.col("renamed")).otherwise(s))
    return joined.withColumn("template", renamed).drop("prefix", "segment", "renamed")


def judge(pages: DataFrame, rules: list[tuple[str, str]] | None = None, blocked: str | None = None, depth: int = DEPTH) -> DataFrame:
    """page_id, host, path, rule, verdict, template, n_labelled and purity per row of pages (page_id, url).

    `blocked` names a boolean column of pages with labels that stand before the rules' verdicts.
    """
    prepare(pages.sparkSession)
    url = F.col("url").cast("string")
    host, path = host_of(url), path_of(url)
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), (F.col(blocked) if blocked else F.lit(None)).cast("boolean").alias("label"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), RULES if rules is None else rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict, "segments": segments(F.col("path"), depth)})
    rows = stored(rows.withColumn("label", F.coalesce("label", F.col("ruled") == "block")))

    paths = rows.groupBy("host", "segments").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"), F.count_if("label").alias("blocked")
    )
    paths = stored(paths.withColumn("template", F.array().cast("array<string>")))
    levels = paths.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(levels):
        paths = stored(_generalised(paths, level))
    for level in reversed(range(levels)):
        paths = stored(_merged(paths, level))

    purity = (F.col("blocked") + SMOOTH) / (F.col("n_labelled") + 2 * SMOOTH)
    templates = paths.groupBy("host", "template").agg(F.sum("labelled").alias("n_labelled"), F.sum("blocked").alias("blocked"))
    templates = templates.select("host", "template", "n_labelled", purity.alias("purity"))
    known = stored(paths.select("host", "segments", "template").join(templates, ["host", "template"]))
    judged = rows.join(known, ["host", "segments"], "left")
    method = F.when((F.col("purity") >= PURITY) & (F.col("n_labelled") > 0), F.lit("block")).otherwise(F.lit("allow"))
    shown = F.concat("host", F.array_join(F.transform("template", lambda s: F.concat(F.lit("/"), s)), ""))
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), shown.alias("template"), "n_labelled", "purity"
    )
