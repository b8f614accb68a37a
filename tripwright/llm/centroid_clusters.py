"""Centroid clustering of vectors in whole numbers, with JVM expressions only.

Each component ``x`` becomes ``floor(scale * x)``. The first centroids are the vectors whose hashed id is smallest. A
round puts each vector to its nearest centroid: the centroids are one literal array, ``zip_with`` and ``aggregate``
give the squared distance to each of them, and ``array_min`` of structs (distance, number) chooses, so that ties go to
the smaller number. The new centroids come from one aggregate with a sum for each component and a count; it is
combined before its shuffle and leaves one row for each cluster, which alone reaches the driver. Vectors are written
once as whole numbers, and once more with their cluster; no vector is shuffled.

Defined cases: a null vector, one of another length, and one with a null or non-finite component take no part; whole
numbers beyond 2 ** 27 either way are held at that bound, so that every squared distance fits in a long (components
below 524,288 with the usual scale are exact); a null id counts as an empty text in the hash and stays null; repeated
rows are vectors of their own, rows with one id are told apart by their components; with fewer vectors than clusters
each vector starts one; an empty table gives an empty table; extra columns are ignored. A sum of distances above a
long is null.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import written

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
SEED = 2
BOUND = 1 << 27


def whole_numbers(vectors: DataFrame, id_col: str, vec_col: str, dimensions: int, scale: int) -> DataFrame:
    """(id, v) of the vectors that take part."""
    raw = F.col(f"`{vec_col}`").cast("array<double>")

    def fits(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    def scaled(x: Column) -> Column:
        product = F.floor(F.greatest(F.lit(-float(BOUND)), F.least(F.lit(float(BOUND)), x * float(scale))))
        return product.cast("long")

    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), raw.alias("raw"))
    return rows.where((F.size("raw") == dimensions) & F.forall("raw", fits)).select("id", F.transform("raw", scaled).alias("v"))


def first_centroids(rows: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids; as many rows as clusters are read."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    return [list(r.v) for r in rows.orderBy(F.sha2(text, 256), "v").limit(clusters).select("v").collect()]


def nearest(centroids: list[list[int]]) -> Column:
    """struct(distance, cluster) of the nearest centroid to ``v``."""
    literal = F.from_json(F.lit(json.dumps(centroids)), "array<array<bigint>>")

    def to(centroid: Column, k: Column) -> Column:
        steps = F.zip_with("v", centroid, lambda x, c: x - c)
        return F.struct(F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x * x).alias("distance"), k.alias("cluster"))

    return F.array_min(F.transform(literal, to))


def moved(rows: DataFrame, centroids: list[list[int]], dimensions: int) -> list[list[int]]:
    """Each centroid at the floor of the mean of its vectors; one without vectors stays."""
    chosen = rows.select(nearest(centroids).getField("cluster").alias("cluster"), "v")
    sums = [F.sum(F.get("v", F.lit(d))).alias(f"s{d}") for d in range(dimensions)]
    out = list(centroids)
    for row in chosen.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        out[row["cluster"]] = [row[f"s{d}"] // row["n"] for d in range(dimensions)]
    return out


def clusters_of(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of each vector that takes part, and the centroids."""
    rows = written(whole_numbers(vectors, id_col, vec_col, dimensions, scale), "vectors")
    centroids = first_centroids(rows, clusters, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(rows, centroids, dimensions)
    best = nearest(centroids or [[0] * dimensions])
    return rows.select("id", best.alias("best")).select("id", "best.cluster", "best.distance"), centroids


def summary(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", **options: int) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that takes part."""
    chosen, centroids = clusters_of(vectors, id_col, vec_col, **options)
    chosen = written(chosen, "clusters")
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids] or [""]

    def total(column: str) -> Column:
        return F.sum(F.col(column).cast("decimal(38,0)"))

    inertia = chosen.groupBy("cluster").agg(total("distance").alias("of_cluster"))
    whole = inertia.agg(total("of_cluster").alias("of_all"))
    # a row for each cluster
    known = F.broadcast(inertia.crossJoin(whole))
    return chosen.join(known, "cluster").select(
        F.col("id").alias(id_col), F.col("cluster").cast("int").alias("cluster"), "distance",
        F.col("of_cluster").try_cast("long").alias("cluster_inertia"), F.col("of_all").try_cast("long").alias("inertia"),
        F.get(F.lit(hashes), F.col("cluster")).alias("centroid_sha256"),
    )
