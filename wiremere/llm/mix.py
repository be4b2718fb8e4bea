"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Per source, documents are taken in key order up to an exact
budget of words: whole epochs first, then the part of one more epoch that lies before the cut. The cut
comes from distributed prefix sums: rows are range-sorted by (source, key), each partition is summed,
the sums are added up per source, and only the one partition that holds a source's cut is looked at
row by row. A source with a third of all rows spreads over as many partitions as its rows need.

Targets: sources take weights in turn, by code point and null last, and share `ratio` times all words;
none gets more than `epochs` times its own words, and the excess goes to the others by weight.

Nulls: a null text has size 0, a null source is a source of its own, a null doc_id hashes as one value.
Rows with equal keys (the same doc_id and size) share the cut evenly. Sources without words get
target 0. An empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wiremere.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
RATIO = (3, 2)  # numerator and denominator: 150 percent
EPOCHS = 2
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(seed: str, *parts: Column) -> Column:
    """A hash of a row's identity, evenly spread and the same in every run."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def targets(sizes: DataFrame, weights=WEIGHTS, ratio=RATIO, epochs: int = EPOCHS) -> DataFrame:
    """Target words per source, from (source, source_size).

    Sources in order of limit / weight are full one after the other; the first that is not full fixes
    the words per unit of weight for itself and all after it.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    filling = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    all_words = F.sum("source_size").over(everything) * F.lit(ratio[0]) / F.lit(float(ratio[1]))
    limit = F.col("limit").cast("double")
    level = (F.col("all_words") - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(rest)
    return (
        sizes.withColumns(
            {
                "weight": F.element_at(F.array(*[F.lit(w) for w in weights]), turn).cast("long"),
                "limit": F.col("source_size") * epochs,
                "all_words": all_words,
            }
        )
        .withColumn("level", level)
        .withColumn("open", F.max(F.when(F.col("limit") / F.col("weight") > F.col("level"), F.col("level"))).over(everything))
        .select(
            "source",
            "source_size",
            F.least(limit, F.coalesce(F.col("weight") * F.col("open"), limit)).alias("target"),
        )
    )


def plan(rows: DataFrame, weights=WEIGHTS, ratio=RATIO, epochs: int = EPOCHS) -> DataFrame:
    """Per source: size, target, whole epochs, and key and words of the cut in the last epoch.

    Takes (source, size, key). One row per source, stored.
    """
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, ratio, epochs)
    budget = F.floor("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    goals = stored(goals.withColumn("full", full).withColumn("left", budget - F.col("full") * F.col("source_size")))

    # Copies with one key are one step of the prefix sums.
    narrow = rows.groupBy("source", "key").agg(F.sum("size").alias("size"), F.count("*").alias("copies"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = narrow.repartitionByRange(parts, "source", "key").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged)
    sums = ranged.groupBy("source", "part").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    cut_parts = sums.join(goals, same(sums, goals)).filter(
        (F.col("before") < F.col("left")) & (F.col("left") <= F.col("before") + F.col("words"))
    )
    cut_parts = stored(cut_parts.select(sums["source"], "part", "before", "left"))
    inside = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    near = ranged.join(cut_parts, (ranged["part"] == cut_parts["part"]) & same(ranged, cut_parts))
    near = near.select(ranged["source"], "key", "size", "copies", "before", "left").withColumn(
        "start", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    cuts = near.filter((F.col("start") < F.col("left")) & (F.col("left") <= F.col("start") + F.col("size")))
    share = F.floor((F.col("left") - F.col("start")) / F.col("copies")).cast("long")
    cuts = cuts.select("source", F.col("key").alias("cut"), share.alias("cut_words"))
    joined = goals.join(cuts, same(goals, cuts), "left")
    return stored(joined.select(goals["source"], "source_size", "target", "full", "cut", "cut_words"))


def mix(docs: DataFrame, weights=WEIGHTS, ratio=RATIO, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """docs with size, source_size, target, taken (words, repeats counted) and copies.

    `copies` is in how many epochs a document begins: a reader of whole documents repeats it so often.
    The columns added replace ones of the same name.
    """
    added = ["size", "source_size", "target", "taken", "copies"]
    docs = docs.drop(*added)
    sized = docs.withColumn("size", n_words(F.col("text")))
    sized = sized.withColumn("_key", random_key(seed, F.col("doc_id"), F.col("size")))
    goals = plan(sized.select("source", "size", F.col("_key").alias("key")), weights, ratio, epochs)
    goals = goals.select(
        "source_size",
        "target",
        *[F.col(c).alias(f"_{c}") for c in ("source", "full", "cut", "cut_words")],
    )
    joined = sized.join(goals, sized["source"].eqNullSafe(goals["_source"]))
    part = F.when(F.col("_key") < F.col("_cut"), F.col("size")).when(F.col("_key") == F.col("_cut"), F.col("_cut_words"))
    taken = F.col("_full") * F.col("size") + F.coalesce(part, F.lit(0))
    copies = F.col("_full") + F.coalesce((F.col("_key") <= F.col("_cut")).cast("long"), F.lit(0))
    return joined.withColumns({"taken": taken.cast("long"), "copies": copies}).select(*docs.columns, *added)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: whole documents, each repeated as often as it is taken.

    The last document of a source may pass the budget, by less than its own size.
    """
    repeats = F.array_repeat(F.lit(1), F.col("copies").cast("int"))
    return mix(docs, **options).withColumn("_copy", F.explode(repeats)).select(docs.columns)


# DuckDB check of the whole result, from plain windows.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
    2 * source_size AS cap, (sum(source_size) OVER ())::BIGINT * 3 / 2.0::DOUBLE AS all_words FROM s
), l AS (
  SELECT *, (all_words - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / (sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level FROM w
), t AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(weight * (max(CASE WHEN cap / weight > level THEN level END) OVER ()), cap::DOUBLE)) AS target FROM l
), b AS (
  SELECT *, floor(target)::BIGINT AS budget, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS full_epochs FROM t
), k AS (
  SELECT *, md5(concat_ws(':', 'mix-1', coalesce(doc_id::VARCHAR, ''), size::VARCHAR)) AS key FROM d
), g AS (
  SELECT source, key, sum(size)::BIGINT AS step, count(*) AS n FROM k GROUP BY source, key
), p AS (
  SELECT *, coalesce(sum(step) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM g
)
SELECT k.doc_id, k.size, b.source_size, b.target,
  b.full_epochs * k.size + CASE WHEN p.start + p.step < r.rest THEN k.size WHEN p.start < r.rest THEN (r.rest - p.start) // p.n ELSE 0 END AS taken
FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source JOIN p ON p.source IS NOT DISTINCT FROM k.source AND p.key = k.key,
  LATERAL (SELECT b.budget - b.full_epochs * b.source_size AS rest) r
"""
