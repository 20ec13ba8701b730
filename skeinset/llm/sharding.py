"""Shards cut from a Hilbert curve over several metadata dimensions.

Each dimension is quantised to a few bits and a row's cell gets its place on the Hilbert curve, so rows
that are near on the curve are near in every dimension, and files of consecutive rows have narrow ranges
in all of them. Rows are ranked along the curve and the ranking is cut into runs of equal length.

Ranks need no global sort: cells are counted (a table bounded by the number of cells), large cells are
divided by a hash into parts of about ``rows_per_part`` rows, the parts are counted, and a row's rank is
that of its part plus its place within. Only this table of parts is summed up in one task: one row per
cell and per ``rows_per_part`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_CELL_BITS = 18
ROWS_PER_PART = 250_000


def log_scaled(value: Column, bits: int, top_bits: int = 24) -> Column:
    """Numbers by their logarithm, up to ``2**top_bits``; null and negative ones are the lowest."""
    steps = F.floor(F.log2(F.lit(1.0) + F.greatest(F.coalesce(value, F.lit(0)), F.lit(0))) * (2**bits / top_bits))
    return F.least(steps, F.lit(2**bits - 1)).cast("int")


def hashed(value: Column, bits: int) -> Column:
    """Categories by a hash; null is one of them."""
    return F.pmod(F.xxhash64(value), F.lit(2**bits)).cast("int")


def hilbert_index(cell: Column, dims: int, bits: int) -> Column:
    """Place on the Hilbert curve of an array of ``dims`` coordinates of ``bits`` bits each.

    The coordinates are turned into the transposed index bit plane by bit plane, Gray-decoded, and their
    bits interleaved.
    """
    planes = ", ".join(f"struct({1 << b} as q, {i} as i)" for b in range(bits - 1, 0, -1) for i in range(dims))
    turned = F.aggregate(
        F.expr(f"array({planes})") if bits > 1 else F.expr("cast(array() as array<struct<q: int, i: int>>)"),
        cell,
        lambda x, s: F.transform(x, lambda v, j: _turn(x, s, v, j)),
    )
    steps = ", ".join(str(1 << b) for b in range(bits - 1, 0, -1))
    masks = F.expr(f"array({steps})") if bits > 1 else F.expr("cast(array() as array<int>)")

    def gray(x: Column) -> Column:
        return F.transform(x, lambda v, j: F.aggregate(F.slice(x, 1, j + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b)))

    def flipped(x: Column) -> Column:
        last = x[dims - 1]
        flip = F.aggregate(masks, F.lit(0), lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        return F.transform(x, lambda v: v.bitwiseXOR(flip))

    one = F.transform(F.array(turned), gray)
    two = F.transform(one, flipped)
    woven = F.expr(f"array({', '.join(f'struct({b} as b, {i} as i)' for b in range(bits - 1, -1, -1) for i in range(dims))})")
    return F.transform(
        two,
        lambda x: F.aggregate(
            woven,
            F.lit(0).cast("bigint"),
            lambda n, s: n * 2 + F.call_function("shiftright", x[s["i"]], s["b"]).bitwiseAND(F.lit(1)),
        ),
    )[0]


def _turn(x: Column, s: Column, v: Column, j: Column) -> Column:
    low = s["q"] - 1
    swap = x[0].bitwiseXOR(x[s["i"]]).bitwiseAND(low)
    inverted = F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)
    swapped = F.when((s["i"] != 0) & ((j == 0) | (j == s["i"])), v.bitwiseXOR(swap)).otherwise(v)
    return F.when(x[s["i"]].bitwiseAND(s["q"]) != 0, inverted).otherwise(swapped)


def hilbert_shards(
    rows: DataFrame,
    cell: list[Column],
    bits: int,
    order: list[str],
    shards: int = 8,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """``rows`` with ``curve`` (place of its cell), ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0 in
    each shard, without gaps); columns of these names are replaced.

    ``cell`` holds the quantised dimensions, ``order`` the columns that order rows of one cell; rows equal
    in all of them take their slots in any order. Shards differ by one row at most. Nulls are values like
    any other. An empty table gives none.
    """
    if len(cell) * bits > MAX_CELL_BITS:
        raise ValueError(f"at most {MAX_CELL_BITS} bits for a cell")
    base = rows.drop("curve", "shard", "slot")
    quantised = base.withColumn("__cell", F.array(*cell))
    counts = quantised.groupBy("__cell").agg(F.count("*").alias("__rows"))
    cells = counts.select(
        "__cell",
        # never null, and known to be: a join would otherwise test the whole expression for null in each row
        F.coalesce(hilbert_index(F.col("__cell"), len(cell), bits), F.lit(0).cast("bigint")).alias("curve"),
        F.ceil(F.col("__rows") / F.lit(rows_per_part)).alias("__parts"),
    )
    spread = F.xxhash64(*order)
    # at most 2 ** MAX_CELL_BITS rows
    placed = quantised.join(F.broadcast(cells), "__cell").withColumn("__part", F.pmod(spread, F.col("__parts")))
    ahead = Window.orderBy("curve", "__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("curve", "__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = (
        placed.groupBy("curve", "__part")
        .agg(F.count("*").alias("__n"))
        .select(
            "curve",
            "__part",
            F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"),
            F.sum("__n").over(everything).alias("__total"),
        )
    )
    within = Window.partitionBy("curve", "__part").orderBy(spread, *order)
    ranked = placed.join(parts, ["curve", "__part"]).withColumn("__rank", F.col("__ahead") + F.row_number().over(within) - 1)
    return ranked.withColumn("shard", F.expr(f"cast(__rank * {shards} div __total as int)")).select(
        *base.columns, "curve", "shard", F.expr(f"__rank - (shard * __total + {shards - 1}) div {shards}").alias("slot")
    )


def write_shards(sharded: DataFrame, path: str, files: int) -> None:
    """One folder per shard, of files of consecutive slots: readers skip files by the ranges of any dimension."""
    dealt = sharded.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)
