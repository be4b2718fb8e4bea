"""Centroid clustering of vectors with exact integer arithmetic, in Spark's own expressions.

A component x becomes the integer floor(scale * x). Every round's centroids are literal arrays in the plan:
zip_with and aggregate give a vector's squared distance to each, array_min over structs of distance and
number chooses the nearest, ties to the smaller number. One sum per component and cluster, aggregated in the
map tasks first, gives the next centroids as the floor of the mean; a cluster without vectors stays where it
is. The driver sees one row of sums per cluster and round. Vectors are never shuffled, so a cluster may hold
any part of them.

Seeds are the vectors with the smallest hash of their id; equal hashes are ordered by components.

Vectors that are null, of another width, or hold null or non-finite components take no part. A vector without
id is clustered but is no seed. Repeated rows are vectors of their own. With fewer vectors than `k` there are
fewer clusters; an empty table gives an empty result. Sizes below 2**27 (131,072 at the default scale) are
computed in long integers, sizes below 2**57 in exact decimals of 38 digits; a distance or inertia beyond a
long is given as the largest long. A finite component of 2**57 or more raises an error. Other columns of the
input, whatever their names, are left out.
"""

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremere.llm.tables import stored

SCALE = 1024
WIDTH = 64
K = 8
ROUNDS = 10
SEED = "3"
LARGEST = (1 << 63) - 1
LONG_BITS, DECIMAL_BITS = 27, 57
SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def terms(vectors: DataFrame, column: str = "embedding", width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the components of usable vectors as doubles floor(scale * x)."""
    x = F.transform(F.col(column), lambda v: F.floor(v.cast("double") * scale).cast("double"))
    finite = F.forall(F.col(column), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    usable = vectors.filter((F.size(column) == width) & F.coalesce(finite, F.lit(False)))
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def nearest(centroids: list[list[int]], exact: str) -> Column:
    """struct(distance, cluster) of the nearest of the literal centroids, in arithmetic of type `exact`."""

    def distance(number: int) -> str:
        centre = f"cast(split('{','.join(map(str, centroids[number]))}', ',') as array<{exact}>)"  # folded to a literal
        squares = f"zip_with(terms, {centre}, (a, b) -> cast((a - b) * (a - b) as {exact}))"
        total = f"aggregate({squares}, cast(0 as {exact}), (s, d) -> cast(s + d as {exact}))"
        return f"struct({total} AS distance, {number} AS cluster)"

    return F.expr(f"array_min(array({', '.join(map(distance, range(len(centroids))))}))")


def _whole(value: Column) -> Column:
    return F.least(value, F.lit(LARGEST).cast("decimal(38,0)")).cast("long")


def cluster(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: str = SEED
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable vector."""
    spark = vectors.sparkSession
    floats = terms(vectors, width=width, scale=scale)
    size = F.array_max(F.transform("x", F.abs))
    # Where nothing reaches 2**57, all doubles are whole numbers that a long holds exactly.
    checked = floats.withColumn(
        "terms",
        F.when(size < float(1 << DECIMAL_BITS), F.transform("x", lambda v: v.cast("long"))).otherwise(
            F.raise_error(F.lit(f"a component beyond 2**{DECIMAL_BITS} has no exact distance"))
        ),
    )
    table = stored(checked.select("vec_id", "terms"))
    most = table.agg(F.max(F.greatest(F.array_max("terms"), -F.array_min("terms")))).first()[0]
    if most is None:
        return spark.createDataFrame([], SCHEMA)
    exact = "long" if most < 1 << LONG_BITS else "decimal(38,0)"
    table = table.withColumn("terms", F.transform("terms", lambda v: v.cast(exact)))

    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    seeds = table.filter("vec_id is not null").orderBy(order, "terms").limit(k)
    centroids = [[int(c) for c in r["terms"]] for r in seeds.collect()]
    if not centroids:
        return spark.createDataFrame([], SCHEMA)

    sums = [F.sum(F.col("terms")[i].cast("long" if exact == "long" else exact)).alias(f"s{i}") for i in range(width)]
    for _ in range(rounds):
        placed = table.withColumn("cluster", nearest(centroids, exact)["cluster"])
        for row in placed.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():  # k rows at most
            centroids[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]

    placed = stored(table.select("vec_id", nearest(centroids, exact).alias("at")).select("vec_id", "at.*"))
    total = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    own = {r["cluster"]: int(r["inertia"]) for r in total}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    at = F.col("cluster") + 1
    return placed.select(
        "vec_id",
        F.col("cluster").cast("int").alias("cluster"),
        _whole(F.col("distance").cast("decimal(38,0)")).alias("distance"),
        F.element_at(F.array(*[F.lit(min(own.get(c, 0), LARGEST)).cast("long") for c in range(len(centroids))]), at).alias("cluster_inertia"),
        F.lit(min(sum(own.values()), LARGEST)).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, digests)), at).alias("centroid_sha256"),
    )


def sql(k: int = K, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: str = SEED) -> str:
    """DuckDB check: the same rounds as one chain of common table expressions."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT n, vec_id, x, min_by(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM (
    SELECT n, vec_id, x, cluster, list_sum(list_transform(list_zip(x, c), lambda p: ((p[1] - p[2]) * (p[1] - p[2]))::HUGEINT)) AS distance
    FROM kept CROSS JOIN c{r}
  ) GROUP BY n, vec_id, x
)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (
  SELECT cluster, i, sum(v) AS s, count(*) AS n
  FROM (SELECT cluster, unnest(x)::HUGEINT AS v, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY cluster, i
), u{r} AS (
  SELECT cluster, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY i) AS c FROM m{r} GROUP BY cluster
), c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(u{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN u{r} USING (cluster))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda v: floor({scale} * v::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, x) - 1)::INTEGER AS cluster, x AS c
  FROM (SELECT sha256('{seed}:' || vec_id::VARCHAR) AS h, x FROM kept WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT {k})
),{",".join(steps)},
inertia AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance::BIGINT AS distance, cluster_inertia,
  (SELECT sum(cluster_inertia) FROM inertia)::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster) JOIN inertia USING (cluster)
"""
