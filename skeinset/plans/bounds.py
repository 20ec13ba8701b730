"""Rounds of k-means that remember, per point, how far it is from changing its centroid.

The points lie in a table with their centroid, an upper bound of the distance to it and a lower bound of
the distance to any other. Centroids that have moved since the table was written widen the bounds by the
way they have gone (triangle inequality); as long as the bounds don't meet, the point is summed without a
distance taken. Rounds only read the table, and sum in the same pass. It is written anew when the last
round took more distances than writing is worth.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinset.functions.kernels import bounded_owners, distances, row_distances, strips, summed_owners
from skeinset.functions.vectors import Features, as_vector
from skeinset.operators.nearest import Centroids, local_table, whole_vectors
from skeinset.sources.folders import Folder, scratch_folder

WRITE_COST = 2.0  # distances a point that writing it anew is worth
MOST_GAPS = 2048  # centroids whose distances to one another are taken in each round

_STATE = "v array<double>, cid bigint, upper double, lower double, work int"
_SUMS = "cid bigint, n bigint, sums array<double>"
_WORK = pa.schema([("iteration", pa.int32()), ("points", pa.int64()), ("compared", pa.int64()), ("distances", pa.int64())])


class BoundedRounds:
    """The points of a run and their bounds, in the shared checkpoint folder until ``close``.

    ``work`` has a tuple per round: its number, points, points compared with all centroids, distances taken.
    """

    def __init__(self, points: DataFrame, features: Features, size: int, p: float = 2):
        if p < 1:
            raise ValueError("orders of distance below 1 have no bounds")
        self._points = points.select(whole_vectors(as_vector(features), size).alias("v"))
        self._spark, self._size, self._p = points.sparkSession, size, p
        self._base: tuple[np.ndarray, np.ndarray] | None = None
        self._folder: str | None = None
        self._written = 0
        self._dear = True
        self.work: list[tuple] = []

    def means(self, centroids: Centroids, iteration: int) -> dict[int, tuple[list[float], int]]:
        """The mean and the number of the points nearest to each centroid that has any."""
        now = np.array([cid for cid, _ in centroids.rows], dtype="int64"), np.array([c for _, c in centroids.rows], dtype="float64")
        if self._dear:
            self._write(now)
            found = self._state().mapInArrow(summed_owners(now[0], self._size), _SUMS)
        else:
            found = self._state().mapInArrow(bounded_owners(now, self._moves(now), self._p, sums=True), _SUMS)
        spread = found.select("cid", "n", F.posexplode("sums").alias("pos", "part"))
        sums = spread.groupBy("cid", "pos").agg(F.sum("part").alias("part"), F.sum("n").alias("n"))
        listed = F.sort_array(F.collect_list(F.struct("pos", "part")))
        out, compared, taken = {}, 0, 0
        for row in sums.groupBy("cid").agg(listed.alias("listed"), F.max("n").alias("n")).collect():
            parts = [part["part"] for part in row["listed"]]
            if row["cid"] is None:  # what the tasks have counted
                compared, taken = map(int, parts)
            else:
                out[row["cid"]] = [part / row["n"] for part in parts], row["n"]
        points = sum(n for _, n in out.values())
        self.work.append((iteration, points, compared, taken))
        self._dear = taken > WRITE_COST * points
        return out

    def work_table(self) -> DataFrame:
        """``iteration, points, compared, distances``."""
        return local_table(self._spark, self.work, _WORK)

    def close(self) -> None:
        if self._folder is not None:
            Folder(self._spark, self._folder).remove()
            self._folder = None

    def _state(self) -> DataFrame:
        return self._spark.read.schema(_STATE).parquet(f"{self._folder}/{self._written}")

    def _write(self, now: tuple[np.ndarray, np.ndarray]) -> None:
        if self._base is None:
            self._folder = scratch_folder(self._spark, "bounds")
            self._base = now
            unknown = f"{now[0][0]}L as cid, double('Infinity') as upper, double('-Infinity') as lower, 0 as work"
            state = self._points.selectExpr("v", *unknown.split(", "))
        else:
            state = self._state()
        bounded = state.mapInArrow(bounded_owners(now, self._moves(now), self._p, sums=False), _STATE)
        bounded.write.parquet(f"{self._folder}/{self._written + 1}")
        if self._written:
            Folder(self._spark, f"{self._folder}/{self._written}").remove()
        self._written += 1
        self._base = now

    def _moves(self, now: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
        """Per centroid at the time of writing: number, place now, way gone, way of the others; per centroid now: least gap."""
        (cids, table), (old, before) = now, self._base
        place = np.minimum(np.searchsorted(cids, old), len(cids) - 1)
        there = cids[place] == old
        moved = np.full(len(old), np.inf)  # a centroid that is gone tells its points nothing
        moved[there] = row_distances(before[there], table[place[there]], self._p)
        ways = np.sort(np.append(moved[there], [0.0, 0.0]))
        first = np.argmax(np.where(there, moved, -1.0))
        others = np.full(len(old), ways[-1])
        others[first] = ways[-2]
        least = np.zeros(len(cids))
        if 1 < len(cids) <= MOST_GAPS:
            for s in strips(table, len(table)):
                gaps = distances(table[s], table, self._p)
                gaps[np.arange(len(gaps)), np.arange(len(gaps)) + s.start] = np.inf
                least[s] = gaps.min(axis=1)
        return old, place, moved, others, least
