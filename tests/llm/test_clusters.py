"""Centroid clustering against a plain loop over Python integers."""

import hashlib
import math
import random

import pytest

from wiremere.llm import clusters

DDL = "vec_id long, embedding array<double>, cluster string, terms int, x int"


def brute_force(rows, k, rounds, width):
    kept = [
        (i, [math.floor(1024 * v) for v in x])
        for i, x in rows
        if x is not None and len(x) == width and all(v is not None and math.isfinite(v) for v in x)
    ]
    seeds = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    centroids = [list(x) for _, x in seeds[:k]]
    if not centroids:
        return []

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        placed = [nearest(x)[1] for _, x in kept]
        for n in set(placed):
            own = [x for (_, x), p in zip(kept, placed) if p == n]
            centroids[n] = [sum(column) // len(own) for column in zip(*own)]
    placed = [nearest(x) for _, x in kept]
    own = {n: sum(d for d, m in placed if m == n) for n in range(len(centroids))}
    cap = (1 << 63) - 1
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, min(d, cap), min(own[n], cap), min(sum(own.values()), cap), digest[n]) for (i, _), (d, n) in zip(kept, placed)]


def check(spark, rows, k=4, rounds=3, width=3):
    vectors = spark.createDataFrame([(*r, "a", 1, 2) for r in rows], DDL)
    got = clusters.cluster(vectors, k=k, rounds=rounds, width=width)
    assert got.schema.simpleString() == (
        "struct<vec_id:bigint,cluster:int,distance:bigint,cluster_inertia:bigint,inertia:bigint,centroid_sha256:string>"
    )
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == sorted(brute_force(rows, k, rounds, width), key=repr)
    return got


def vectors(n, width=3, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.uniform(-2, 2) for _ in range(width)]) for i in range(n)]


def test_plain(spark):
    check(spark, vectors(200))
    check(spark, vectors(60, width=5), k=3, rounds=1, width=5)


def test_ties_repeats_and_empty_clusters(spark):
    # Equal seeds: the later ones never win a vector and stay where they are.
    got = check(spark, [(i % 5, [0.5, 0.5, -0.5]) for i in range(30)])
    assert {r[1] for r in got} == {0}


def test_a_third_of_the_rows_are_one_vector(spark):
    check(spark, vectors(100) + [(1000 + i, [0.25, 0.0, 0.0]) for i in range(60)])


def test_odd_vectors(spark):
    rows = vectors(20)
    rows += [(50, None), (51, []), (52, [1.0, 2.0]), (53, [1.0] * 4), (54, [1.0, None, 2.0]), (55, [math.nan, 0.0, 0.0]), (56, [math.inf, 0.0, 0.0])]
    rows += [(57, [-math.inf, 0.0, 0.0]), (None, [0.1, 0.2, 0.3]), (58, [-0.0, 1e-300, -1e-300])]
    assert len(check(spark, rows)) == 22


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, [1.0, 2.0, 3.0])], [(7, [1.0, 2.0, 3.0])]])
def test_few_rows(spark, rows):
    check(spark, rows)


@pytest.mark.parametrize("size", [2.0**16, 2.0**18, 1e9, 2.0**46])
def test_large_components_are_exact(spark, size):
    got = check(spark, vectors(12) + [(99, [size, -size, 0.5]), (98, [size, size, 0.5])])
    assert len(got) == 14


def test_beyond_exact_sizes_is_an_error(spark):
    rows = spark.createDataFrame([(1, [1e30, 0.0, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="has no exact distance"):
        clusters.cluster(rows, width=3)


def test_rounds_scan_without_shuffling_vectors(spark):
    table = spark.createDataFrame([(1, [1, 2, 3])], "vec_id long, terms array<long>")
    placed = table.select(clusters.nearest([[1, 2, 3], [4, 5, 6]], "long")["cluster"].alias("c"))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
