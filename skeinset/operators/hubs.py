"""Joins on a key of which a few values hold a large share of the rows.

A sketch of frequent items, merged from the tasks in one pass, names the values that would fill more than a part of
a partition. Rows of these alone are spread over as many copies of their partner as their estimated number asks for;
all others join as ever. The plan does not depend on adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_TRACKED = 1_000_000  # items in a sketch


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def frequent_values(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """``__hot, __copies``: values of ``key`` that hold more rows than a quarter of a partition, and the quarters they fill.

    There are at most ``8 * parts`` such rows, as the sketch can name too many but leaves none out; the table is held by the
    driver. Null is no value.
    """
    parts = parts or partitions(df)
    tracked = min(MOST_TRACKED, max(10_000, 64 * parts))
    most = min(8 * parts, tracked)
    sketch = F.expr(f"approx_top_k(`{key}`, {most}, {tracked})")
    top = df.filter(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("n"), sketch.alias("top"))
    quarters = F.ceil(F.col("item.count") * F.lit(4 * parts) / F.col("n"))
    named = top.select("n", F.explode("top").alias("item")).select(
        F.col("item.item").alias("__hot"), F.least(quarters, F.lit(4 * parts)).cast("int").alias("__copies")
    )
    hot = named.filter("__copies > 1")
    return df.sparkSession.createDataFrame(hot.toArrow())


def join_spread(left: DataFrame, right: DataFrame, key: str, spread: Sequence[str], hot: DataFrame | None = None) -> DataFrame:
    """The inner join of both on ``key``; rows of ``left`` with a frequent value are spread by the columns ``spread``.

    ``spread`` should tell rows of one value apart; equal rows stay together. ``right`` may hold a value any number of times.
    ``hot`` is the result of ``frequent_values`` if it is there already; ``left`` is read for it if not.
    """
    hot = F.broadcast(frequent_values(left, key) if hot is None else hot)
    copies = F.coalesce("__copies", F.lit(1))
    at = F.pmod(F.xxhash64(*spread), copies).cast("int")
    placed = left.join(hot, F.col(key) == F.col("__hot"), "left").withColumn("__at", at).drop("__hot", "__copies")
    copied = right.join(hot, F.col(key) == F.col("__hot"), "left")
    copied = copied.withColumn("__at", F.explode(F.sequence(F.lit(0), copies - 1))).drop("__hot", "__copies")
    return placed.join(copied, [key, "__at"]).drop("__at")
