"""How well points sit in their clusters: two silhouette variants.

``simple`` takes the distance to the own centroid against that to the next nearest centroid. It
is one pass without a shuffle, and the form for large data. ``pairwise`` takes the mean distance
to the other points of the cluster, which no algorithm gets without comparing all of them; its
work is quadratic in the distinct points of a cluster and is done in tiles.

A point alone in its cluster scores 1, and with a single cluster the other distance is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinset.functions.vectors import Features, as_vector, silhouette_score
from skeinset.operators import tiles
from skeinset.operators.nearest import Centroids, with_nearest
from skeinset.session import cut_lineage


def silhouette(
    points: DataFrame,
    centroids: DataFrame,
    features: Features,
    method: str = "simple",
    by: str = "point",
) -> DataFrame:
    """``by='point'``: points with ``cid, s``; ``'cluster'``: ``cid, s, n``; ``'all'``: one row ``s, n``."""
    if by not in ("point", "cluster", "all"):
        raise ValueError(f"unknown grouping {by!r}")
    centres = Centroids.of(centroids)
    if method == "simple":
        scored = _simple(points, centres, features)
        return scored if by == "point" else _mean(scored, by, F.lit(1))
    if method != "pairwise":
        raise ValueError(f"unknown method {method!r}")
    scored = _pairwise(points, centres, features)
    if by != "point":
        return _mean(scored, by, F.col("n"))
    keyed = points.withColumn("__v", as_vector(features))
    return keyed.join(scored.select("__v", "cid", "s"), "__v").drop("__v")


def _mean(scored: DataFrame, by: str, weight) -> DataFrame:
    grouped = scored.groupBy("cid") if by == "cluster" else scored.groupBy()
    return grouped.agg(
        (F.sum(F.col("s") * weight) / F.sum(weight)).alias("s"), F.sum(weight).cast("bigint").alias("n")
    )


def _simple(points: DataFrame, centres: Centroids, features: Features) -> DataFrame:
    near = with_nearest(points, centres, features, second=True)
    score = silhouette_score(F.col("dist"), F.coalesce("second", F.lit(0.0)))
    return near.select(*[F.col(f"`{c}`") for c in points.columns], "cid", score.alias("s"))


def _pairwise(points: DataFrame, centres: Centroids, features: Features) -> DataFrame:
    """``__v, cid, n, s``: one row per distinct point.

    Equal points do not count as neighbours of one another, so a point's mean is the weighted sum
    over distinct points divided by the weight of the others. Collapsing equal points first is
    exact, and takes away any point value that holds a large share of the rows. The distinct
    points are read for block sizes, blocks and weights, so they are written out once.
    """
    distinct = points.select(as_vector(features).alias("__v")).groupBy("__v").agg(F.count(F.lit(1)).alias("n"))
    near = with_nearest(distinct, _by_value(centres), "__v", second=True).select(
        "__v", F.col("n").cast("double").alias("n"), "cid", F.coalesce("second", F.lit(0.0)).alias("b")
    )
    near = cut_lineage(near)
    few = centres.rows is not None
    blocks = tiles.pack(near, "cid", "__v", "__v", ["__v", "n", "b"], tiles.block_rows(centres.size), few)
    sums = tiles.weighted_distance_sums(tiles.own_tiles(blocks, "cid", ["n"]), centres.size)
    listed = blocks.select(
        F.col("cid").alias("g"), "blk", F.posexplode(F.arrays_zip("__v", "n", "b")).alias("pos", "item")
    ).select("g", "blk", "pos", "item.*")
    weights = near.groupBy("cid").agg(F.sum("n").alias("weight")).withColumnRenamed("cid", "g")
    others = F.col("weight") - F.col("n")
    a = F.when(others > 0, F.col("total") / others).otherwise(F.lit(0.0))
    return (
        listed.join(sums, ["g", "blk", "pos"])
        .join(F.broadcast(weights) if few else weights, "g")
        .select("__v", F.col("g").alias("cid"), F.col("n"), silhouette_score(a, F.col("b")).alias("s"))
    )


def _by_value(centres: Centroids) -> Centroids:
    """Centroids with each value once, under its lowest cid: equal ones are no 'other' cluster."""
    if centres.rows is None:
        lowest = centres.df.groupBy("c").agg(F.min("cid").alias("cid")).select("cid", "c")
        return Centroids(lowest, centres.size, None)
    first = {}
    for cid, c in centres.rows:
        first.setdefault(tuple(c), cid)
    return Centroids.local(centres.df.sparkSession, [(cid, list(c)) for c, cid in first.items()])
