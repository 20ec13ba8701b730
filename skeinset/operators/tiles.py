"""All-against-all work on vectors, cut into bounded tiles.

Mean distance inside a cluster and closest pair compare each vector of a set with each other. Pairs of single rows are never produced: rows are hashed
into blocks of bounded size, each block travels as one row, and a tile (one block against one block) is
reduced to a few numbers inside the task. ``n`` rows give ``(n / block)**2`` tiles whatever the largest cluster
is. Tiles are worked off in squares of a bounded number, spread by their own hash, so that a block is
sent once for many tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinset.functions.kernels import distances, strips
from skeinset.session import cut_lineage

BLOCK_DOUBLES = 8192
SQUARE = 16  # blocks in a run
SQUARES_PER_TASK = 4  # at most, once there are more squares than partitions


def block_rows(size: int) -> int:
    """Rows per block, so that a block stays near 64 KiB for any vector size."""
    return max(16, BLOCK_DOUBLES // max(size, 1))


def pack(
    df: DataFrame,
    group: str,
    vector: str,
    order: str,
    carried: Sequence[str],
    rows: int,
    few_groups: bool = True,
) -> DataFrame:
    """One row per block: ``group, blk, n_blk``, ``x`` (vectors, flat) and one array per carried column.

    ``order`` names a column unique inside the group. Blocks list their rows in its order, so the
    position of a row in its block does not depend on how it got there. ``few_groups`` says that
    the groups are known to be few enough for one row each to be broadcast. Blocks are read more
    than once by whoever asks for them, so they are written to the checkpoint folder.
    """
    sizes = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).alias("n_blk"))
    placed = df.join(F.broadcast(sizes) if few_groups else sizes, group).withColumn(
        "blk", F.pmod(F.xxhash64(F.col(order), F.lit(71)), F.col("n_blk"))
    )
    fields = list(dict.fromkeys([order, vector, *carried]))
    listed = placed.groupBy(group, "blk", "n_blk").agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("items")
    )
    packed = listed.select(
        group,
        "blk",
        "n_blk",
        F.flatten(F.col(f"items.{vector}")).alias("x"),
        *[F.col(f"items.{c}").alias(c) for c in carried],
    )
    return cut_lineage(packed)


def own_tiles(blocks: DataFrame, group: str, carried: Sequence[str]) -> DataFrame:
    """``g, low, high, at, blk, x`` and what is carried: the blocks each square of tiles needs.

    The blocks of a group are cut into runs of up to ``SQUARE`` blocks, shorter ones where there are few tiles for the
    tasks. A square is a run against a run of the same group, each unordered pair once, a run with itself
    included. It reads its two runs, at most ``2 * SQUARE`` blocks, for up to ``SQUARE ** 2`` tiles: a block is
    sent as often as there are runs and not as there are blocks. The number of tasks follows that of the squares.
    """
    spark = blocks.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = blocks.groupBy(group).agg(F.first("n_blk").alias("n"))
    tiles = sizes.agg(F.sum("n").alias("blocks"), F.sum(F.col("n").cast("double") ** 2 / 2).alias("tiles")).head()
    run = min(SQUARE, max(1, math.isqrt(int((tiles["tiles"] or 0) / (4 * wanted)))))
    runs = f"(n_blk + {run - 1}) div {run}"
    squares = sizes.selectExpr(f"(n + {run - 1}) div {run} as r").agg(F.sum(F.expr("r * (r + 1) div 2"))).head()[0] or 0
    placed = blocks.withColumn("at", F.expr(f"blk div {run}")).select(
        F.col(group).alias("g"),
        F.explode(F.expr(f"sequence(0L, {runs} - 1)")).alias("other"),
        "at",
        "blk",
        "x",
        *carried,
    )
    low, high = F.least("at", "other").alias("low"), F.greatest("at", "other").alias("high")
    parts = max(1, min(squares, max(wanted, squares // SQUARES_PER_TASK)))
    return placed.select("g", low, high, "at", "blk", "x", *carried).repartition(parts, "g", "low", "high")


def _tiles(square: pa.Table, size: int, carried: Sequence[str]) -> Iterator[tuple]:
    """``i, j, x, y, of_x, of_y`` of each tile of a square: two blocks, their vectors and what they carry."""
    at, low, high = (square.column(c).to_numpy() for c in ("at", "low", "high"))
    blk = square.column("blk").to_numpy()
    sides = [[(int(blk[r]), r) for r in np.flatnonzero(at == run).tolist()] for run in (low[0], high[0])]
    held = {}
    for _, r in sides[0] + sides[1]:
        x = square.column("x")[r].values.to_numpy(zero_copy_only=False).reshape(-1, size)
        held[r] = x, [square.column(c)[r].values.to_numpy(zero_copy_only=False) for c in carried]
    for i, a in sides[0]:
        for j, b in sides[1]:
            if low[0] < high[0] or i <= j:
                yield i, j, held[a][0], held[b][0], held[a][1], held[b][1]


def weighted_distance_sums(tiles: DataFrame, size: int) -> DataFrame:
    """``g, blk, pos, total``: for each row of each block, the sum of ``n * distance`` to its group."""

    def run(square: pa.Table) -> pa.Table:
        totals: dict[int, np.ndarray] = {}
        for i, j, x, y, (nx,), (ny,) in _tiles(square, size, ["n"]):
            of_x, of_y = totals.setdefault(i, np.zeros(len(x))), totals.setdefault(j, np.zeros(len(y)))
            for s in strips(x, len(y)):
                d = distances(x[s], y)
                of_x[s] += d @ ny
                if i != j:
                    of_y += nx[s] @ d
        g = pa.array([square.column("g")[0].as_py()] * len(totals), pa.int64())
        lists = pa.array(list(totals.values()), pa.list_(pa.float64()))
        return pa.table([g, pa.array(list(totals), pa.int64()), lists], ["g", "blk", "totals"])

    partial = tiles.groupBy("g", "low", "high").applyInArrow(run, "g bigint, blk bigint, totals array<double>")
    return (
        partial.select("g", "blk", F.posexplode("totals").alias("pos", "part"))
        .groupBy("g", "blk", "pos")
        .agg(F.sum("part").alias("total"))
    )


def closest_pair(tiles: DataFrame, size: int) -> DataFrame:
    """One row ``distance, i, j``: the closest two rows by id ``i < j``, lowest ids on ties.

    Ids must ascend inside a block.
    """

    def run(square: pa.Table) -> pa.Table:
        best = None
        for i, j, x, y, (ids_x,), (ids_y,) in _tiles(square, size, ["cid"]):
            for s in strips(x, len(y)):
                d = distances(x[s], y)
                if i == j:
                    at = np.arange(len(d))
                    d[at, at + s.start] = np.inf
                low = d.min()
                if not np.isfinite(low):
                    continue
                a, b = np.nonzero(d == low)
                p, q = ids_x[s][a], ids_y[b]
                first, second = np.minimum(p, q), np.maximum(p, q)
                at = np.lexsort((second, first))[0]
                found = (float(low), int(first[at]), int(second[at]))
                best = found if best is None else min(best, found)
        rows = [best] if best else []
        kinds = [pa.float64(), pa.int64(), pa.int64()]
        return pa.table([pa.array([b[k] for b in rows], t) for k, t in enumerate(kinds)], ["distance", "i", "j"])

    partial = tiles.groupBy("g", "low", "high").applyInArrow(run, "distance double, i bigint, j bigint")
    return (
        partial.agg(F.min(F.struct("distance", "i", "j")).alias("best"))
        .filter(F.col("best").isNotNull())
        .select("best.*")
    )
