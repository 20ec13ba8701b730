"""Nearest-centroid assignment: the inner loop of every clustering job here.

Three ways, one result. Few centroids become arithmetic on primitive columns inside whole-stage
code generation. More of them go to an Arrow-batched numpy kernel. Beyond ``LOCAL_DOUBLES`` the
centroids are no longer fit to be held whole: they are cut into blocks, along their distance to a pivot and
then by their coordinates, and sent in slices of some blocks. A task reads its points once; a group of them asks
one slice after the other, those that bounds of coordinates and the triangle inequality on pivots leave, and
holds one at a time. None of the three ways shuffles points or writes them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinset.functions.kernels import distances, nearest_in_slices, packed_centroids, strips
from skeinset.functions.vectors import Features, as_vector, coordinates
from skeinset.session import cut_lineage

INLINE_DOUBLES = 64
LOCAL_DOUBLES = 1_000_000
BLOCKS_PER_PASS = 8
PIVOTS = 4

CENTROID_SCHEMA = pa.schema([("cid", pa.int64()), ("c", pa.list_(pa.float64()))])


def local_table(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """A few driver rows as a table the optimizer knows the size of."""
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=schema))


@dataclass
class Centroids:
    """A centroid table ``cid, c``; ``rows`` holds it in the driver too when it is small.

    ``block_doubles`` bounds the numbers in a block of a table that is not, ``LOCAL_DOUBLES`` if not given.
    """

    df: DataFrame
    size: int
    rows: list[tuple[int, list[float]]] | None
    block_doubles: int | None = None

    @staticmethod
    def of(df: DataFrame, local_doubles: int | None = None) -> Centroids:
        """Look at the table, and take it to the driver only if it is within the bound."""
        bound = LOCAL_DOUBLES if local_doubles is None else local_doubles
        plain = df.select(F.col("cid").cast("bigint").alias("cid"), F.col("c").cast("array<double>").alias("c"))
        broken = "c is null or exists(c, x -> x is null or isnan(x))"
        seen = plain.agg(F.min(F.size("c")).alias("low"), F.max(F.size("c")).alias("size"), F.max(F.expr(broken)).alias("broken")).head()
        if seen["size"] is None:
            raise ValueError("no centroids given")
        if seen["broken"] or seen["low"] != seen["size"]:
            raise ValueError("centroids must have coordinates of one number, none missing")
        most = bound // max(seen["size"], 1)
        rows = plain.limit(most + 1).collect()
        if len(rows) > most:
            return Centroids(plain, seen["size"], None, bound)
        return Centroids.local(df.sparkSession, [(r["cid"], r["c"]) for r in rows])

    @staticmethod
    def local(spark, rows: list[tuple[int, list[float]]]) -> Centroids:
        rows = sorted((cid, list(c)) for cid, c in rows)
        return Centroids(local_table(spark, rows, CENTROID_SCHEMA), len(rows[0][1]), rows)


def assign(points: DataFrame, centroids: DataFrame, features: Features, p: float = 2) -> DataFrame:
    """``points`` with ``cid`` and ``dist`` of the nearest centroid; equal distances take the lowest cid.

    ``p`` is the order of the distance, 2 being the Euclidean one.
    """
    return with_nearest(points, Centroids.of(centroids), features, p=p)


def with_nearest(
    points: DataFrame, centroids: Centroids, features: Features, second: bool = False, p: float = 2
) -> DataFrame:
    """``points`` with ``cid, dist`` and, if asked, ``second``: the distance to the next nearest centroid.

    ``second`` is null where there is only one centroid. Points must have all coordinates and no
    more than the centroids; a short, long or null vector, and a null or NaN coordinate, is an error,
    the same one however many centroids there are.
    """
    taken = {"cid", "dist", "second"}.intersection(points.columns)
    if taken:
        raise ValueError(f"points already have columns named {sorted(taken)}")
    few = centroids.rows is not None and len(centroids.rows) * centroids.size <= INLINE_DOUBLES
    if few and not isinstance(features, str):
        if len(features) != centroids.size:
            raise ValueError("points and centroids differ in their number of coordinates")
        return _inline(points, centroids, features, second, p)  # tests null and NaN itself
    checked = points.withColumn("__point", whole_vectors(as_vector(features), centroids.size))
    way = _by_blocks if centroids.rows is None else _inline if few else _batched
    return way(checked, centroids, "__point", second, p).drop("__point")


def whole_vectors(vector: Column, size: int) -> Column:
    """``vector`` if it has ``size`` coordinates, none null or NaN; else an error."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x))
    good = vector.isNotNull() & (F.size(vector) == size) & ~broken
    return F.when(good, vector).otherwise(F.raise_error(F.lit("a point lacks a coordinate or has too many")).cast("array<double>"))


def _inline(
    points: DataFrame, centroids: Centroids, features: Features, second: bool, p: float
) -> DataFrame:
    # The coordinates come as a scalar subquery over a local table and not as literals: the code
    # generated for a round is then the same text as for the one before, and is compiled once.
    # NaN in place of null keeps the arithmetic free of null tests; it is caught at the end.
    # Expressions are SQL text, since building them call by call takes longer than a small round.
    size = centroids.size
    flat = [v for _, c in centroids.rows for v in c]
    table = local_table(points.sparkSession, [(flat,)], pa.schema([("m", pa.list_(pa.float64()))])).scalar()
    lifted = [f"coalesce({c}, double('NaN')) as __f{i}" for i, c in enumerate(coordinates(features, size))]
    found = []
    for j in range(len(centroids.rows)):
        gaps = [f"(__f{i} - coalesce(get(__m, {j * size + i}), double('NaN')))" for i in range(size)]
        if p == 2:
            found.append(f"sqrt({' + '.join(f'{g} * {g}' for g in gaps)})")
        else:
            powers = " + ".join(f"power(abs{g}, {float(p)!r}D)" for g in gaps)
            found.append(f"power({powers}, {1.0 / p!r}D)")
    cids = [cid for cid, _ in centroids.rows]
    cid = "array_position(__d, __near) - 1"
    if cids != list(range(len(cids))):
        cid = f"element_at(array({', '.join(f'{c}L' for c in cids)}), cast(array_position(__d, __near) as int))"
    checked = "if(isnan(__near), cast(raise_error('a point lacks a coordinate') as double), __near) as dist"
    extra = ["get(sort_array(__d), 1) as second"] if second else []
    return (
        points.withColumn("__m", table)
        .selectExpr("*", *lifted)
        .selectExpr("*", f"array({', '.join(found)}) as __d")
        .selectExpr("*", "array_min(__d) as __near")
        .selectExpr(*[f"`{c}`" for c in points.columns], _never_null(cid), checked, *extra)
    )


def _never_null(cid: str) -> str:
    """The assigned cid, typed as never null: a join on it then adds no null test on the points."""
    return f"coalesce({cid}, -1L) as cid"


def _batched(
    points: DataFrame, centroids: Centroids, features: Features, second: bool, p: float
) -> DataFrame:
    cids = np.array([cid for cid, _ in centroids.rows], dtype="int64")
    table = np.array([c for _, c in centroids.rows], dtype="float64")
    size = centroids.size

    @F.arrow_udf("struct<cid: bigint, dist: double, second: double>")
    def nearest(vectors: pa.Array) -> pa.Array:
        flat = vectors.flatten()
        if vectors.null_count or flat.null_count or len(flat) != size * len(vectors):
            raise ValueError("a point lacks a coordinate")
        x = flat.to_numpy().reshape(-1, size)
        cid = np.empty(len(x), dtype="int64")
        near, after = np.empty(len(x)), np.full(len(x), np.inf)
        for s in strips(x, len(table)):
            d = distances(x[s], table, p)
            at, best = np.arange(len(d)), d.argmin(axis=1)
            cid[s], near[s] = cids[best], d[at, best]
            if second and len(table) > 1:
                d[at, best] = np.inf
                after[s] = d.min(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(cid), pa.array(near), pa.array(after, mask=~np.isfinite(after))],
            names=["cid", "dist", "second"],
        )

    return points.withColumn("__n", nearest(as_vector(features))).selectExpr(
        *[f"`{c}`" for c in points.columns],
        _never_null("__n.cid"),
        "__n.dist as dist",
        *(["__n.second as second"] if second else []),
    )


def _by_blocks(
    points: DataFrame, centroids: Centroids, features: Features, second: bool, p: float
) -> DataFrame:
    size, context = centroids.size, points.sparkSession.sparkContext
    bound = LOCAL_DOUBLES if centroids.block_doubles is None else centroids.block_doubles
    blocks, pivots = _blocks(centroids, max(16, bound // max(size, 1)), p)
    slices, boxes, held = [], [], []

    def send() -> None:
        low, high = ([getattr(t, m)(axis=0) for _, t, *_ in held] for m in ("min", "max"))
        ring_low, ring_high = ([block[k] for block in held] for k in (2, 3))
        boxes.append((np.min(low, axis=0), np.max(high, axis=0), np.min(ring_low, axis=0), np.max(ring_high, axis=0)))
        slices.append(context.broadcast(list(held)))
        held.clear()

    for row in blocks.toLocalIterator():
        cids, flat, low, high = (np.array(row[c]) for c in ("cids", "flat", "low", "high"))
        held.append((cids, flat.reshape(-1, size), low, high))
        if len(held) == BLOCKS_PER_PASS:
            send()
    if held:
        send()
    found = F.arrow_udf(nearest_in_slices(slices, boxes, np.array(pivots), p, second), "struct<cid: bigint, dist: double, second: double>")
    return points.withColumn("__n", found(as_vector(features))).selectExpr(
        *[f"`{c}`" for c in points.columns],
        _never_null("__n.cid"),
        "__n.dist as dist",
        *(["__n.second as second"] if second else []),
    )


def _blocks(centroids: Centroids, rows: int, p: float) -> tuple[DataFrame, list[list[float]]]:
    """The centroids as blocks ``cids, flat, low, high`` of at most ``rows``, and the pivots.

    ``low`` and ``high`` are the bounds of the block's distances to each pivot. Pivots are far from each other
    among a few centroids; blocks follow the distance to the first, and of what a task holds the coordinates.
    """
    few = [r["c"] for r in centroids.df.orderBy(F.xxhash64("cid"), "cid").limit(16 * PIVOTS).collect()]
    pivots = few[:1]
    while len(pivots) < min(PIVOTS, len(few)):
        pivots.append(few[int(distances(np.array(few), np.array(pivots), p).min(axis=1).argmax())])
    table = np.array(pivots)

    @F.arrow_udf("double")
    def away(c: pa.Array) -> pa.Array:
        return pa.array(distances(c.flatten().to_numpy().reshape(-1, table.shape[1]), table[:1], p)[:, 0])

    ordered = centroids.df.withColumn("__r", away("c")).orderBy("__r", "cid").select("cid", "c")
    schema = "cids array<bigint>, flat array<double>, low array<double>, high array<double>"
    return cut_lineage(ordered.mapInArrow(packed_centroids(rows, table, p), schema)), pivots
