"""Stored intermediate tables, Python settings and connected components, shared by the operators."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wiremere.session import materialise, ship_package

# Rows of an Arrow batch. Texts may be long, and a batch is held whole on both sides.
BATCH_ROWS = "1000"
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """Send the package to the executors and keep Arrow batches small, unless they are smaller already."""
    ship_package(spark)
    now = int(spark.conf.get(BATCH_SETTING))
    if not 0 < now <= int(BATCH_ROWS):
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and go on from there: cuts lineage, survives executors."""
    return materialise(df)


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges u > v, hung on each node's smallest neighbour.

    The minimum per node is aggregated in the map tasks first; the join back to the edges has one
    row per node on one side, so a node with very many edges can be split.
    """
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        # Neighbours v larger than u get an edge to u's minimum.
        moved = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u")
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """Alternating large-star and small-star over links (u, v) until nothing changes.

    Returns (node, component) for every linked node; the component is its smallest node. Each round
    is written to the shared folder.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(edges.filter("u <> v").distinct())
    state = _state(edges)
    while state[0]:
        edges = stored(_stars(_stars(edges, large=True), large=False))
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
