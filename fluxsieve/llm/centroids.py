"""Centroid clustering by integer distances in JVM expressions (operator 11).

Vectors become whole numbers, floor(``SCALE`` * x). The centroids travel as array literals; ``zip_with`` and
``aggregate`` give the squared distance to each, ``array_min`` over (distance, number) picks the cluster, ties
going to the smaller number. A round adds up every component per cluster on the map side and divides exactly, so
neither the order of rows nor the partitioning can change a centroid. Only centroids and sums per cluster, ``k``
times the vector's size, reach the driver. There is no Python in any task.

The whole numbers are written once to the shared folder; each round reads them again and keeps nothing else.

Defined results: vectors that are null, of another length, or hold a null, NaN or infinite component do not take
part and come out in no row; components beyond +-``LARGEST`` / ``SCALE`` count as that bound, which keeps every
distance in a long and every sum up to 2**36 rows; an inertia beyond a long is null; rows repeated, and ids repeated
or null, each take part (a null id is written as an empty text where ids are hashed, equal hashes go by their
vectors); with fewer vectors than ``k`` there are as many centroids as vectors; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from fluxsieve.llm.common import stored

DIMENSIONS, SCALE, LARGEST = 64, 256, 1 << 27
CLUSTERS, ROUNDS, SEED = 40, 5, 2


def whole(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """id, q (array of long) of every vector that has the length and only finite components."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))
                      & ~F.coalesce(F.isnan(x), F.lit(True)))
    bounded = lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(SCALE * x.cast("double"))))
    return vectors.where((F.size("embedding") == dimensions) & finite).select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda x: bounded(x).cast("long")).alias("q"))


def starts(rows: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The first centroids: vectors in the order of their ids' hashes."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [r["q"] for r in rows.select("q", name.alias("name")).orderBy("name", "q").limit(k).collect()]


def distance(q: str, centroid: list[int]) -> str:
    """Squared Euclidean distance to a literal centroid, as SQL; the split text folds into an array literal."""
    literal = f"cast(split('{','.join(map(str, centroid))}', ',') AS array<bigint>)"
    return f"aggregate(zip_with({q}, {literal}, (a, b) -> (a - b) * (a - b)), 0L, (total, x) -> total + x)"


def nearest(q: str, centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid. One SQL text: a lambda of its own costs each Python call dear."""
    each = (f"named_struct('distance', {distance(q, c)}, 'cluster', {i})" for i, c in enumerate(centroids))
    return F.expr(f"array_min(array({', '.join(each)}))")


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid's floor of the mean of its vectors; those without vectors stay."""
    if not centroids:
        return []
    size = len(centroids[0])
    sums = rows.select("q", nearest("q", centroids)["cluster"].alias("cluster")).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("q")[i]).alias(f"s{i}") for i in range(size)])
    out = list(centroids)
    for r in sums.collect():  # one row a cluster
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(size)]
    return out


def clusters(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
             dimensions: int = DIMENSIONS) -> tuple[DataFrame, list[list[int]]]:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector, and the centroids."""
    rows = stored(whole(vectors, dimensions), "vectors")
    centroids = starts(rows, k, seed)
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    if not centroids:
        return rows.select("id", F.lit(0).alias("cluster"), *[
            F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256")), centroids
    found = stored(rows.select("id", nearest("q", centroids).alias("near")).select(
        "id", "near.cluster", "near.distance"), "assigned")
    own = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.try_sum("distance").alias("s")).collect()}
    total = None if None in own.values() else sum(own.values())
    by_cluster = F.array(*[F.lit(own.get(i)).cast("long") for i in range(len(centroids))])
    return found.select(
        "id", "cluster", "distance", F.get(by_cluster, F.col("cluster")).alias("cluster_inertia"),
        F.lit(total if total is not None and total < 1 << 63 else None).cast("long").alias("inertia"),
        F.get(F.array(*map(F.lit, names)), F.col("cluster")).alias("centroid_sha256")), centroids
