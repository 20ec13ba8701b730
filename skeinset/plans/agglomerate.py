"""Agglomerative clustering by closest centroids.

Each distinct point starts as a cluster. A round assigns all points to their nearest centroid,
takes the means, and replaces the two closest means by their mid-point; it goes on until
``target_k`` are left. A last pass takes the means once more.

Equal points are collapsed to one weighted point first, which gives the same means. The number of
rounds is the number of clusters to merge away, each round needing the one before. With centroids
within the bound of ``nearest.LOCAL_DOUBLES``, a round only does what the last merge can have changed:

- The driver keeps the centroids, the nearest later neighbour of each, and a heap of those pairs. A merge
  looks anew at the pairs of centroids that have moved or lost their neighbour.
- Points stay in a table of blocks, with owner and distance. A round looks at points that lost their owner
  or from which it moved away, and asks of all others only if a moved centroid is nearer than the owner.
- The driver runs ahead: it takes it that the points of two merged clusters go to the new one and no others
  move, and logs some merges. One job replays the log on the blocks and reports the first merge at which points
  went elsewhere, with their exact sums. Merges up to there hold, the rest is undone. From time to time the
  replayed blocks are written as the new base; until then a job starts from the old one, so nothing is
  lost with an executor.

Beyond the bound the centroids stay a table, and each round is a job over all points that ends in a checkpoint.
"""

from __future__ import annotations

import heapq
from copy import deepcopy
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from skeinset.functions.kernels import distances, strips, values
from skeinset.functions.replay import Step, one_row, replay
from skeinset.functions.vectors import Features, as_vector, midpoint
from skeinset.operators import tiles
from skeinset.operators.nearest import CENTROID_SCHEMA, LOCAL_DOUBLES, Centroids, local_table
from skeinset.operators.ranks import number_rows
from skeinset.plans.kmeans import cluster_means
from skeinset.session import cut_lineage

BLOCK_POINTS = 20_000
MOST_AHEAD = 64
REBASE = 64  # steps that are replayed at most before the blocks are written anew

_MERGES = pa.schema(
    [
        ("round", pa.int32()),
        ("n_before", pa.int64()),
        ("i", pa.int64()),
        ("j", pa.int64()),
        ("distance", pa.float64()),
        ("merged", pa.list_(pa.float64())),
    ]
)
_MEANS = pa.schema([*CENTROID_SCHEMA, ("n", pa.int64())])


@dataclass
class AgglomerateResult:
    """``merges``: one row per round; ``last_midpoints``: ``cid, c`` after the last merge;
    ``centroids``: ``cid, c, n`` means of the final pass."""

    merges: DataFrame
    last_midpoints: DataFrame
    centroids: DataFrame
    n_rounds: int


def closest_pair(centroids: DataFrame, local_doubles: int = LOCAL_DOUBLES) -> DataFrame:
    """One row ``distance, i, j`` of the two closest centroids of ``cid, c``; none if there is one only."""
    return _closest(Centroids.of(centroids, local_doubles))


def _closest(centres: Centroids) -> DataFrame:
    if centres.rows is None:
        table = centres.df.select(F.lit(0).cast("bigint").alias("g"), "cid", "c")
        blocks = tiles.pack(table, "g", "c", "cid", ["cid"], tiles.block_rows(centres.size))
        return tiles.closest_pair(tiles.own_tiles(blocks, "g", ["cid"]), centres.size)
    best = F.min(F.struct("later.distance", F.col("cid").alias("i"), "later.j")).alias("best")
    return (
        _with_nearest_later(centres)
        .filter(F.col("later.distance").isNotNull())
        .agg(best)
        .filter(F.col("best").isNotNull())
        .select("best.*")
    )


def _with_nearest_later(centres: Centroids) -> DataFrame:
    """The centroids with ``later``: distance and number of the nearest of higher number, the first of equally near."""
    cids = np.array([cid for cid, _ in centres.rows], dtype="int64")
    table = np.array([c for _, c in centres.rows])

    @F.arrow_udf("struct<distance: double, j: bigint>")
    def nearest_later(cid: pa.Array, c: pa.Array) -> pa.Array:
        own = np.searchsorted(cids, cid.to_numpy())
        x = c.flatten().to_numpy().reshape(-1, table.shape[1])
        low, at = np.full(len(x), np.inf), np.zeros(len(x), dtype="int64")
        for s in strips(x, len(table)):
            d = distances(x[s], table)
            d[np.arange(len(table))[None, :] <= own[s][:, None]] = np.inf
            best = d.argmin(axis=1)
            low[s], at[s] = d[np.arange(len(d)), best], cids[best]
        return pa.StructArray.from_arrays(
            [pa.array(low, mask=~np.isfinite(low)), pa.array(at)], names=["distance", "j"]
        )

    return centres.df.withColumn("later", nearest_later("cid", "c"))


def agglomerate(
    points: DataFrame,
    features: Features,
    target_k: int = 1,
    max_rounds: int | None = None,
    local_doubles: int = LOCAL_DOUBLES,
) -> AgglomerateResult:
    """Merge until ``target_k`` clusters are left, or for ``max_rounds``.

    Clusters start numbered in the order of their coordinates, and a merged one takes the next
    number. The lowest numbers win on equal distances.
    """
    if target_k < 1:
        raise ValueError("target_k must be at least 1")
    vectors = points.select(as_vector(features).alias("c"))
    weighted = vectors.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    weighted = weighted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _merge_rounds(weighted, target_k, max_rounds, local_doubles)
    finally:
        weighted.unpersist()


@dataclass
class _Clusters:
    """Centroids by number, with the nearest later one of each and a heap of those pairs."""

    place: np.ndarray  # by number; rows of clusters to come are unused
    alive: np.ndarray
    weight: list[int]
    sums: dict[int, list[Fraction]]  # of clusters of more than one point
    near: np.ndarray
    far: np.ndarray  # distance to ``near``
    heap: list[tuple[float, int, int]]
    fresh: int
    left: int
    moved: set[int] = field(default_factory=set)
    gone: list[int] = field(default_factory=list)
    touched: set[int] = field(default_factory=set)

    @staticmethod
    def of(points: np.ndarray, weight: list[int], near: np.ndarray, far: np.ndarray) -> _Clusters:
        n = len(points)
        more = np.zeros((n, points.shape[1]))
        heap = [(float(far[i]), i, int(near[i])) for i in range(n) if near[i] >= 0]
        heapq.heapify(heap)
        late = np.full(n, -1, dtype=np.int64), np.full(n, np.inf)
        return _Clusters(
            np.vstack([points, more]), np.arange(2 * n) < n, weight + [0] * n, {},
            np.concatenate([near, late[0]]), np.concatenate([far, late[1]]), heap, n, n,
        )

    def sum_of(self, cid: int) -> list[Fraction]:
        return self.sums.get(cid) or [Fraction(v) * self.weight[cid] for v in self.place[cid].tolist()]

    def _search(self, cid: int) -> None:
        """The nearest of the later centroids, the first one of equally near."""
        self.near[cid], self.far[cid] = -1, np.inf
        later = cid + 1 + np.flatnonzero(self.alive[cid + 1 : self.fresh])
        if len(later):
            d = distances(self.place[cid : cid + 1], self.place[later])[0]
            at = int(d.argmin())
            self.near[cid], self.far[cid] = later[at], d[at]
            heapq.heappush(self.heap, (float(d[at]), cid, int(later[at])))

    def refresh(self, changed: set[int]) -> None:
        """Neighbours again, where centroids in ``changed`` moved, appeared or went."""
        if not changed:
            return
        lost = np.flatnonzero(self.alive[: self.fresh] & np.isin(self.near[: self.fresh], list(changed)))
        again = {int(c) for c in lost} | {c for c in changed if self.alive[c]}
        for cid in sorted(again):
            self._search(cid)
        for c in sorted(c for c in changed if self.alive[c]):
            before = np.flatnonzero(self.alive[:c])
            if not len(before):
                continue
            d = distances(self.place[before], self.place[c : c + 1])[:, 0]
            better = (d < self.far[before]) | ((d == self.far[before]) & (c < self.near[before]))
            for i, v in zip(before[better].tolist(), d[better].tolist()):
                self.near[i], self.far[i] = c, v
                heapq.heappush(self.heap, (v, i, c))

    def closest(self) -> tuple[float, int, int] | None:
        while self.heap:
            d, i, j = self.heap[0]
            if self.alive[i] and self.near[i] == j and self.far[i] == d:
                return self.heap[0]
            heapq.heappop(self.heap)
        return None

    def merge(self) -> tuple[tuple, Step]:
        """Merge the closest pair, its points taken along; the row of the report, and what points must know."""
        d, i, j = self.closest()
        m, before = self.fresh, self.left
        self.place[m] = (self.place[i] + self.place[j]) / 2.0
        self.weight[m] = self.weight[i] + self.weight[j]
        self.sums[m] = [a + b for a, b in zip(self.sum_of(i), self.sum_of(j))]
        for c in (i, j):
            self.alive[c] = False
            self.sums.pop(c, None)
        self.alive[m] = True
        self.fresh, self.left = m + 1, before - 1
        step = Step([*self.gone, i, j], {c: self.place[c].tolist() for c in self.moved - {i, j}} | {m: self.place[m].tolist()}, (i, j), m)
        self.touched = {i, j, m}
        self.moved, self.gone = set(), []
        return (before, i, j, d, self.place[m].tolist()), step

    def settle(self, changes: list[tuple[int, int, list[Fraction]]] = ()) -> None:
        """Means of clusters whose points changed; ``changes``: weights and sums to add, beyond the merge itself."""
        changed = {c for c, *_ in changes} | {max(self.touched)} if self.touched else set()
        for c, weight, sums in changes:
            self.sums[c] = [a + b for a, b in zip(self.sum_of(c), sums)]
            self.weight[c] += weight
        for c in changed:
            if self.weight[c] == 0:
                self.alive[c] = False
                self.gone.append(c)
                self.left -= 1
                continue
            mean = [float(s / self.weight[c]) for s in self.sums[c]]
            if mean != self.place[c].tolist():
                self.place[c] = mean
                self.moved.add(c)
        self.refresh(changed | self.touched)
        self.touched = set()


_BLOCKS = "x array<double>, n array<bigint>, owner array<bigint>, far array<double>"


class _Blocks:
    """The points with owner and distance as of the last written base, and the steps since."""

    def __init__(self, weighted: DataFrame, size: int, n: int):
        numbered = number_rows(weighted, ["c"], "cid")

        def pack(batches):
            for batch in batches:
                if batch.num_rows:
                    yield one_row(batch.column("c").flatten(), batch.column("n"), batch.column("cid"), np.zeros(batch.num_rows))

        parts = min(int(weighted.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + n // BLOCK_POINTS)
        self.base = cut_lineage(numbered.select("c", "n", "cid").repartition(parts, "cid").mapInArrow(pack, _BLOCKS))
        self.size, self.steps = size, []

    def start(self, place: np.ndarray, alive: np.ndarray) -> None:
        self.place, self.alive, self.steps = place.copy(), alive.copy(), []

    def _opened(self, steps: list[Step]):
        size, place, alive = self.size, self.place, self.alive

        def opened(batches):
            for batch in batches:
                for r in range(batch.num_rows):
                    x = values(batch, "x", r).reshape(-1, size)
                    w, owner, far = (values(batch, c, r).copy() for c in ("n", "owner", "far"))
                    yield x, w, owner, far, replay(x, w, owner, far, place.copy(), alive.copy(), steps)

        return opened

    def first_surprise(self, steps: list[Step]) -> tuple[int, list[tuple[int, int, list[Fraction]]]]:
        """The first of ``steps`` after which points are not where they were expected, and by cluster what it
        gained; the number of steps if there is none."""
        opened, skip = self._opened([*self.steps, *steps]), len(self.steps)

        def run(batches):
            for x, w, _, _, states in opened(batches):
                for at, (expected, owner) in enumerate(states):
                    other = np.flatnonzero(expected != owner) if at >= skip else ()
                    if len(other):
                        gain: dict[int, list] = {}
                        for p in other.tolist():
                            part = [Fraction(v) * int(w[p]) for v in x[p].tolist()]
                            for c, sign in ((int(owner[p]), 1), (int(expected[p]), -1)):
                                weight, sums = gain.get(c, (0, [Fraction(0)] * len(part)))
                                gain[c] = weight + sign * int(w[p]), [a + sign * b for a, b in zip(sums, part)]
                        yield pa.RecordBatch.from_pydict(
                            {
                                "step": pa.array([at - skip] * len(gain), pa.int64()),
                                "cid": pa.array(list(gain), pa.int64()),
                                "n": pa.array([g[0] for g in gain.values()], pa.int64()),
                                "sums": pa.array([[str(v) for v in g[1]] for g in gain.values()], pa.list_(pa.string())),
                            }
                        )
                        break

        rows = self.base.mapInArrow(run, "step bigint, cid bigint, n bigint, sums array<string>").collect()
        first = min((r["step"] for r in rows), default=len(steps))
        return first, [(r["cid"], r["n"], [Fraction(v) for v in r["sums"]]) for r in rows if r["step"] == first]

    def accept(self, steps: list[Step]) -> None:
        self.steps += steps
        if len(self.steps) < REBASE:
            return
        opened = self._opened(self.steps)

        def run(batches):
            for x, w, owner, far, states in opened(batches):
                for _ in states:
                    pass
                yield one_row(x.ravel(), w, owner, far)

        self.base = cut_lineage(self.base.mapInArrow(run, _BLOCKS))
        for step in self.steps:
            self.alive[step.gone] = False
            for c, at in step.moved.items():
                self.place[c], self.alive[c] = at, True
        self.steps = []


def _nearest_later(centres: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid, by number from 0, the nearest later one (-1 for none) and its distance."""
    near, far = np.full(len(centres.rows), -1, dtype=np.int64), np.full(len(centres.rows), np.inf)
    for r in _with_nearest_later(centres).select("cid", "later.*").filter("distance is not null").collect():
        near[r["cid"]], far[r["cid"]] = r["j"], r["distance"]
    return near, far


def _merge_ahead(weighted: DataFrame, n: int, size: int, target_k: int, max_rounds: int | None) -> AgglomerateResult:
    """The whole run with centroids on the driver and points in blocks."""
    spark = weighted.sparkSession
    start = sorted((list(r["c"]), r["n"]) for r in weighted.select("c", "n").collect())
    near, far = _nearest_later(Centroids.local(spark, [(i, c) for i, (c, _) in enumerate(start)]))
    points = np.array([c for c, _ in start], dtype=float).reshape(n, size)
    clusters = _Clusters.of(points, [w for _, w in start], near, far)
    blocks = _Blocks(weighted, size, n)
    blocks.start(clusters.place, clusters.alive)
    merges, most, last = [], n if max_rounds is None else max_rounds, None
    ahead = 8
    while clusters.left > target_k and len(merges) < most and clusters.closest() is not None:
        before, rows, steps = deepcopy(clusters), [], []
        while len(steps) < ahead and clusters.left > target_k and len(merges) + len(rows) < most and clusters.closest() is not None:
            row, step = clusters.merge()
            last = clusters.place.copy(), clusters.alive.copy()
            rows.append(row)
            steps.append(step)
            clusters.settle()
        held, changes = blocks.first_surprise(steps)
        ahead = min(2 * ahead, MOST_AHEAD) if held == len(steps) else max(1, min(held + 1, ahead))
        if held < len(steps):  # again from where the run ahead began, up to the surprise
            clusters, rows, steps = before, rows[: held + 1], steps[: held + 1]
            for at in range(held + 1):
                clusters.merge()
                last = clusters.place.copy(), clusters.alive.copy()
                clusters.settle(changes if at == held else ())
        blocks.accept(steps)
        merges += rows
    if last is None:
        last = clusters.place, clusters.alive
    midpoints = [(int(c), last[0][c].tolist()) for c in np.flatnonzero(last[1])]
    means = [(int(c), clusters.place[c].tolist(), clusters.weight[c]) for c in np.flatnonzero(clusters.alive)]
    report = [(at, *row) for at, row in enumerate(merges)]
    return AgglomerateResult(local_table(spark, report, _MERGES), Centroids.local(spark, midpoints).df, local_table(spark, means, _MEANS), len(merges))


def _merge_rounds(
    weighted: DataFrame, target_k: int, max_rounds: int | None, local_doubles: int
) -> AgglomerateResult:
    spark = weighted.sparkSession
    n, size = weighted.agg(F.count(F.lit(1)), F.max(F.size("c"))).head()
    if not n:
        raise ValueError("no points given")
    if n * size <= local_doubles:
        return _merge_ahead(weighted, n, size, target_k, max_rounds)
    centres = Centroids(number_rows(weighted.select("c"), ["c"], "cid").select("cid", "c"), size, None)
    merges, left, fresh = [], n, n
    while left > target_k and (max_rounds is None or len(merges) < max_rounds):
        centres, left = _means(weighted, centres, left, local_doubles)
        pair = _closest(centres).head() if left > target_k else None
        if pair is None:
            break
        distance, i, j = pair
        centres, merged = _replace(centres, i, j, fresh)
        merges.append((len(merges), left, i, j, distance, merged))
        left, fresh = left - 1, fresh + 1
    final = cluster_means(weighted, centres, "c", "n")
    if left * size <= local_doubles:
        final = local_table(spark, [tuple(r) for r in final.collect()], _MEANS)
    else:
        final = cut_lineage(final)
    return AgglomerateResult(local_table(spark, merges, _MERGES), centres.df, final, len(merges))


def _means(
    weighted: DataFrame, centres: Centroids, most: int, local_doubles: int
) -> tuple[Centroids, int]:
    """The means of the clusters that have points, and how many there are."""
    means = cluster_means(weighted, centres, "c", "n").select("cid", "c")
    if most * centres.size <= local_doubles:
        rows = [(r["cid"], r["c"]) for r in means.collect()]
        return Centroids.local(weighted.sparkSession, rows), len(rows)
    means = cut_lineage(means)
    return Centroids(means, centres.size, None), means.count()


def _replace(centres: Centroids, i: int, j: int, fresh: int) -> tuple[Centroids, list[float]]:
    """Centroids with ``i`` and ``j`` replaced by their mid-point, numbered ``fresh``."""
    spark = centres.df.sparkSession
    if centres.rows is None:
        ends = (F.max(F.when(F.col("cid") == cid, F.col("c"))) for cid in (i, j))
        pair = centres.df.filter(F.col("cid").isin(i, j)).agg(F.struct(*ends).alias("p"))
        merged = pair.select(midpoint("p.col1", "p.col2").alias("c")).head()["c"]
        one = local_table(spark, [(fresh, merged)], CENTROID_SCHEMA)
        rest = centres.df.filter(~F.col("cid").isin(i, j)).unionByName(one)
        return Centroids(rest, centres.size, None), merged
    held = dict(centres.rows)
    merged = [(x + y) / 2.0 for x, y in zip(held.pop(i), held.pop(j))]
    return Centroids.local(spark, [*held.items(), (fresh, merged)]), merged
