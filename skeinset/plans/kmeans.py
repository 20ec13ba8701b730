"""K-means from given or random seeds.

A round is one Spark job: scan, nearest centroid, partial sums per task, one shuffle of at most
``k`` rows per task, means, and the shift of each mean. Only the ``k`` new centroids come back to
the driver, which also ends the lineage of the round. With more centroids than may be held there,
they stay a table and each round ends in a checkpoint.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from skeinset.functions.kernels import distances, strips
from skeinset.functions.vectors import Features, as_vector, coordinates, minkowski
from skeinset.operators import nearest
from skeinset.operators.nearest import Centroids, local_table, whole_vectors, with_nearest
from skeinset.operators.ranks import number_rows
from skeinset.plans.bounds import BoundedRounds
from skeinset.plans.draws import race, race_table
from skeinset.session import cut_lineage
from skeinset.sources.folders import Folder, commit

CHUNK = 100_000  # equal points that one task numbers at once

_VECTOR = pa.list_(pa.float64())
_HISTORY = pa.schema(
    [
        ("iteration", pa.int32()),
        ("cid", pa.int64()),
        ("shift", pa.float64()),
        ("c", _VECTOR),
        ("prev", _VECTOR),
        ("n", pa.int64()),
    ]
)


@dataclass
class KMeansResult:
    """``centroids``: ``cid, c, n, converged``; ``history``: one row per round and centroid.

    ``n`` is the number of points the centroid is the mean of. ``work`` is there of runs with bounds:
    ``iteration, points, compared, distances`` of the rounds this run has made itself.
    """

    points: DataFrame
    features: Features
    centroids: DataFrame
    history: DataFrame
    n_iter: int
    converged: bool
    p: float = 2
    work: DataFrame | None = None

    @property
    def assignments(self) -> DataFrame:
        """All points with the ``cid`` and ``dist`` of their centroid."""
        return with_nearest(self.points, Centroids.of(self.centroids), self.features, p=self.p)

    @property
    def report(self) -> DataFrame:
        """``cid, c, state``: the centroids and whether the run converged, in words."""
        state = "Convergence reached" if self.converged else "Convergence not reached"
        return self.centroids.select("cid", "c", F.lit(state).alias("state"))


def random_seeds(
    points: DataFrame, k: int, id_col: str | None, features: Features, seed: int = 0, draw: str = "race"
) -> DataFrame:
    """``cid, c``: ``k`` points drawn uniformly by a hash of their id, numbered in id order.

    Each task keeps its ``k`` lowest hashes; nothing is shuffled but those. Only a ``k`` too large for the
    driver takes a sort of all points. Without an id, points are drawn by their value and a number among
    equal ones, and numbered in that order: by ``draw="race"`` in three scans (``plans/draws.py``), by
    ``"copies"`` with a hash of each point, for which all values are counted. Either way the draw does not
    depend on how the points are laid out.
    """
    if draw not in ("race", "copies"):
        raise ValueError(f"no draw {draw!r}")
    size = points.select(F.size(as_vector(features)).alias("size")).head()
    large = size is not None and k * (size["size"] or 0) > nearest.LOCAL_DOUBLES
    if id_col is None and draw == "race":
        return _raced(points, k, features, seed, large)
    if id_col is None:
        pool = _without_ids(points, features, seed)
    else:
        hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
        pool = points.select(F.col(id_col).alias("__id"), as_vector(features).alias("c"), hashed.alias("__draw"))
    if large:
        drawn = number_rows(pool, ["__draw", "__id"], "__rank").filter(F.col("__rank") < k)
        _enough(drawn.count(), k)
        return number_rows(drawn.select("__id", "c"), ["__id"], "cid").select("cid", "c")
    rows = sorted(pool.orderBy("__draw", "__id").limit(k).collect(), key=lambda r: r["__id"])
    _enough(len(rows), k)
    return Centroids.local(points.sparkSession, [(i, r["c"]) for i, r in enumerate(rows)]).df


def _enough(found: int, k: int) -> None:
    if found < k:
        raise ValueError(f"{k} seeds asked of {found} points")


def _raced(points: DataFrame, k: int, features: Features, seed: int, large: bool) -> DataFrame:
    if large:
        drawn = cut_lineage(race_table(points, k, features, seed))
        _enough(drawn.count(), k)
        return number_rows(drawn, ["c", "j"], "cid").select("cid", "c")
    rows = sorted(race(points, k, features, seed))
    _enough(len(rows), k)
    return Centroids.local(points.sparkSession, [(i, c) for i, (c, _) in enumerate(rows)]).df


def _without_ids(points: DataFrame, features: Features, seed: int) -> DataFrame:
    """``__id, c, __draw`` of each point; equal ones are numbered in chunks, so that no task has all of them."""
    counted = points.select(as_vector(features).alias("c")).groupBy("c").agg(F.count("*").alias("n"))
    chunks = counted.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (n - 1) div {CHUNK})")))
    spread = chunks.repartition("c", "chunk")
    each = f"explode(sequence(chunk * {CHUNK} + 1, least(n, (chunk + 1) * {CHUNK}))) as i"
    text = F.concat_ws(":", F.lit(str(seed)), F.array_join(F.col("c").cast("array<string>"), ","), F.col("i").cast("string"))
    return spread.select("c", F.expr(each)).select(F.struct("c", "i").alias("__id"), "c", F.md5(text).alias("__draw"))


def cluster_means(
    points: DataFrame, centroids: Centroids, features: Features, weight: str | None = None, p: float = 2
) -> DataFrame:
    """``cid, c, n``: the mean of the points nearest to each centroid that has any."""
    if centroids.rows is not None and len(centroids.rows) * centroids.size > nearest.INLINE_DOUBLES:
        return _means_of_sums(points, centroids, features, weight, p)
    near = with_nearest(points, centroids, features, p=p)
    heft = "1" if weight is None else f"`{weight}`"
    each = coordinates(features, centroids.size)
    means = ", ".join(f"sum({c if weight is None else f'{c} * {heft}'}) / sum({heft})" for c in each)
    return near.groupBy("cid").agg(F.expr(f"array({means}) as c"), F.expr(f"cast(sum({heft}) as bigint) as n"))


def _means_of_sums(points: DataFrame, centroids: Centroids, features: Features, weight: str | None, p: float) -> DataFrame:
    """As ``cluster_means``; the kernel that finds the nearest centroid also sums, one row per centroid and task."""
    cids = np.array([cid for cid, _ in centroids.rows], dtype="int64")
    table = np.array([c for _, c in centroids.rows], dtype="float64")
    size = centroids.size
    if not isinstance(features, str) and len(features) != size:
        raise ValueError("points and centroids differ in their number of coordinates")

    def run(batches):
        sums, hefts = np.zeros(table.shape), np.zeros(len(table))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            w = batch.column(1).to_numpy(zero_copy_only=False)
            for s in strips(x, len(table)):
                best = distances(x[s], table, p).argmin(axis=1)
                order = np.argsort(best, kind="stable")
                at, first = np.unique(best[order], return_index=True)
                sums[at] += np.add.reduceat(x[s][order] * w[s][order, None], first, axis=0)
                hefts[at] += np.add.reduceat(w[s][order], first)
        for i in np.flatnonzero(hefts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(cids[i : i + 1]), pa.array(hefts[i : i + 1]), pa.array([sums[i]], _VECTOR)], names=["cid", "n", "sums"]
            )

    heft = F.lit(1.0) if weight is None else F.coalesce(F.col(weight).cast("double"), F.lit(0.0))
    used = points.select(whole_vectors(as_vector(features), size).alias("v"), heft.alias("w"))
    parts = used.mapInArrow(run, "cid bigint, n double, sums array<double>")
    means = (
        parts.select("cid", "n", F.posexplode("sums").alias("pos", "part"))
        .groupBy("cid", "pos")
        .agg((F.sum("part") / F.sum("n")).alias("c"), F.sum("n").alias("n"))
    )
    return means.groupBy("cid").agg(
        F.expr("transform(array_sort(collect_list(struct(pos, c))), x -> x.c) as c"), F.expr("cast(max(n) as bigint) as n")
    )


def kmeans_step(
    points: DataFrame, centroids: DataFrame, features: Features, empty: str = "drop", p: float = 2
) -> DataFrame:
    """One round: ``cid, c, n``."""
    centres = Centroids.of(centroids)
    return _round(points, centres, features, None, empty, p).select("cid", "c", "n")


def _round(
    points: DataFrame, old: Centroids, features: Features, stop: str | None, empty: str, p: float = 2
) -> DataFrame:
    """``cid, c, n, prev, shift``. The shift is taken from the nearest old centroid or the own one."""
    _check_rules(stop, empty)
    means = cluster_means(points, old, features, p=p)
    before = old.df.withColumnRenamed("c", "prev")
    if empty == "keep":
        moved = before.join(means, "cid", "left").selectExpr(
            "cid", "coalesce(c, prev) as c", "coalesce(n, 0L) as n", "prev"
        )
    else:
        moved = means.join(before, "cid")
    if stop == "nearest":
        return with_nearest(moved.withColumnRenamed("cid", "__cid"), old, "c", p=p).selectExpr(
            "__cid as cid", "c", "n", "prev", "dist as shift"
        )
    return moved.withColumn("shift", minkowski("c", "prev", p))


def _check_rules(stop: str | None, empty: str) -> None:
    if empty not in ("drop", "keep"):
        raise ValueError(f"unknown treatment of empty clusters {empty!r}")
    if stop not in ("nearest", "aligned", None):
        raise ValueError(f"unknown stop rule {stop!r}")


def _collected_round(points: DataFrame, old: Centroids, features: Features, stop: str | None, empty: str, p: float) -> list[tuple]:
    """``cid, shift, c, prev, n`` of a round with its centroids on the driver, which has the former ones too."""
    if stop == "nearest":
        rows = _round(points, old, features, stop, empty, p).collect()
        return [(r["cid"], r["shift"], r["c"], r["prev"], r["n"]) for r in rows]
    _check_rules(stop, empty)
    means = {r["cid"]: (r["c"], r["n"]) for r in cluster_means(points, old, features, p=p).collect()}
    return _aligned(means, old, empty, p)


def _bounded_round(rounds: BoundedRounds, iteration: int, old: Centroids, stop: str | None, empty: str, p: float) -> list[tuple]:
    """As ``_collected_round``, of points that carry bounds."""
    _check_rules(stop, empty)
    means = rounds.means(old, iteration)
    rows = _aligned(means, old, empty, p) if means else []
    if stop != "nearest" or not rows:
        return rows
    moved = local_table(old.df.sparkSession, [(cid, c) for cid, _, c, _, _ in rows], nearest.CENTROID_SCHEMA)
    shifts = with_nearest(moved.withColumnRenamed("cid", "__cid"), old, "c", p=p).select("__cid", "dist").collect()
    shift = {r["__cid"]: r["dist"] for r in shifts}
    return [(cid, shift[cid], c, prev, n) for cid, _, c, prev, n in rows]


def _aligned(means: dict[int, tuple[list[float], int]], old: Centroids, empty: str, p: float) -> list[tuple]:
    """``cid, shift, c, prev, n``, the shift being that from the own predecessor."""
    out = []
    for cid, prev in old.rows:
        if cid in means or empty == "keep":
            c, n = means.get(cid, (prev, 0))
            shift = float(distances(np.array([c], dtype=float), np.array([prev], dtype=float), p)[0, 0])
            out.append((cid, shift, c, prev, n))
    return out


def kmeans(
    points: DataFrame,
    seeds: DataFrame,
    features: Features,
    max_iter: int = 5,
    threshold: float = 2000.0,
    stop: str | None = "nearest",
    empty: str = "drop",
    cache: bool = False,
    local_doubles: int | None = None,
    p: float = 2,
    rounds_to: str | None = None,
    bounds: bool = False,
) -> KMeansResult:
    """Rounds until every shift is at most ``threshold``, ``max_iter`` at most.

    ``stop='nearest'`` measures a centroid against the nearest of the former ones, ``'aligned'``
    against its own predecessor, ``None`` runs all rounds. ``empty='drop'`` lets a centroid
    without points go, ``'keep'`` leaves it in place. ``p`` is the order of the distance. A round re-reads the feature columns only;
    ``cache=True`` pays off where the points are costly to derive.

    ``rounds_to`` names a folder that takes each round as it ends, in ``iteration=0`` and so on. A run that finds
    rounds there goes on after the last one; the folder must be of a run of the same seeds and rules, over which
    only ``max_iter`` may differ. ``history`` then reads from it.

    ``bounds=True`` is for many rounds or many centroids: points are written with bounds of their distances
    (``plans.bounds``), and only those that may change their centroid are compared. The result is the same, but for
    the order of sums. Centroids that are too many for the driver have bounds of their own and take no notice.
    """
    if max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    spark = points.sparkSession
    current = Centroids.of(seeds, local_doubles)
    done = _Rounds(spark, rounds_to, seeds, dict(features=features, threshold=threshold, stop=stop, empty=empty, p=p))
    used = points.select(features if isinstance(features, str) else list(features))
    if cache:
        used = used.persist(StorageLevel.MEMORY_AND_DISK)
    records, tables = [], []
    converged = False
    bounded = BoundedRounds(used, features, current.size, p) if bounds and current.rows is not None else None
    try:
        for iteration in range(max_iter):
            if iteration < done.count:
                last = done.read(iteration)
                largest = last.agg(F.max("shift")).head()[0]
                current = Centroids.of(last.select("cid", "c"), local_doubles)
            elif current.rows is not None:
                if bounded is not None:
                    rows = _bounded_round(bounded, iteration, current, stop, empty, p)
                else:
                    rows = _collected_round(used, current, features, stop, empty, p)
                largest = max((shift for _, shift, *_ in rows), default=0.0)
                records += [(iteration, *r) for r in rows]
                last = local_table(spark, [r for r in records if r[0] == iteration], _HISTORY)
                if not rows:
                    raise ValueError("no points given")
                current = Centroids.local(spark, [(cid, c) for cid, _, c, _, _ in rows])
            else:
                moved = _round(used, current, features, stop, empty, p)
                last = cut_lineage(moved.select(F.lit(iteration).alias("iteration"), "cid", "shift", "c", "prev", "n"))
                largest = last.agg(F.max("shift")).head()[0]
                if largest is None:
                    raise ValueError("no points given")
                tables.append(last)
                current = Centroids(last.select("cid", "c"), current.size, None)
            if iteration >= done.count:
                done.write(iteration, last)
            if stop is not None and largest <= threshold:
                converged = True
                break
    finally:
        if cache:
            used.unpersist()
        if bounded is not None:
            bounded.close()
    if rounds_to is not None:
        history = reduce(DataFrame.unionByName, [done.read(i) for i in range(iteration + 1)])
    else:
        history = reduce(DataFrame.unionByName, tables) if tables else local_table(spark, records, _HISTORY)
    centroids = last.select("cid", "c", "n", F.lit(converged).alias("converged"))
    work = None if bounded is None else bounded.work_table()
    return KMeansResult(points, features, centroids, history, iteration + 1, converged, p, work)


class _Rounds:
    """Rounds committed to a folder, each whole or not at all."""

    def __init__(self, spark, path: str | None, seeds: DataFrame, rules: dict):
        self.spark, self.path, self.count = spark, path, 0
        if path is None:
            return
        each = F.xxhash64(F.col("cid").cast("bigint"), F.col("c").cast("array<double>"))
        rules["features"] = rules["features"] if isinstance(rules["features"], str) else list(rules["features"])
        rules["seeds"] = [str(v) for v in seeds.agg(F.count("*"), F.sum(each.cast("decimal(38,0)"))).head()]
        told, at = json.dumps(rules, sort_keys=True), f"{path}/_rules"
        if not Folder(spark, at).exists():
            line = spark.createDataFrame([(told,)], "value string").coalesce(1)
            commit(spark, at, lambda to: line.write.text(to))
        elif [r.value for r in spark.read.text(at).collect()] != [told]:
            raise ValueError(f"{path} holds the rounds of another run")
        there = set(Folder(spark, path).names())
        while f"iteration={self.count}" in there:
            self.count += 1

    def read(self, iteration: int) -> DataFrame:
        rows = self.spark.read.schema("cid bigint, shift double, c array<double>, prev array<double>, n bigint")
        found = rows.parquet(f"{self.path}/iteration={iteration}")
        return found.select(F.lit(iteration).alias("iteration"), "cid", "shift", "c", "prev", "n")

    def write(self, iteration: int, last: DataFrame) -> None:
        if self.path is not None:
            rows = last.select("cid", "shift", "c", "prev", "n")
            commit(self.spark, f"{self.path}/iteration={iteration}", lambda to: rows.write.parquet(to), overwrite=True)


def lloyd(
    points: DataFrame,
    features: Features,
    id_col: str | None = None,
    k: int = 3,
    threshold: float = 0.0001,
    max_iter: int = 30,
    seed: int = 0,
    p: float = 2,
    bounds: bool = False,
) -> KMeansResult:
    """K-means from random seeds until no centroid moves by more than ``threshold``."""
    seeds = random_seeds(points, k, id_col, features, seed)
    return kmeans(points, seeds, features, max_iter, threshold, stop="aligned", p=p, bounds=bounds)
