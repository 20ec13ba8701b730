"""A uniform draw of points that have no id, at the cost of scans.

Each point runs a race: its time is exponential, and the ``k`` earliest are drawn. Points of equal value
can't be told apart, so the times of a value's ``n`` points are made in rising order, from hashes of the
value and the place: the first is ``E1 / n``, the next adds ``E2 / (n - 1)``, and so on. A value's first
time is the earlier the more points it has, so a bound of their number bounds the time, and only values
that can still be among the ``k`` need their points counted.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinset.functions.kernels import race_times
from skeinset.functions.vectors import Features, as_vector
from skeinset.operators.nearest import local_table
from skeinset.operators.ranks import number_rows

BUCKETS = 1 << 16  # rows of the one table that is sent to tasks

_REACH = pa.schema([("bucket", pa.int64()), ("reach", pa.float64())])
_FIRST = pa.schema([("bucket", pa.int64()), ("e", pa.float64())])


def _with_times(points: DataFrame, features: Features, seed: int) -> DataFrame:
    """``c, text, e, bucket``: a value, its hashed text, the exponential of its first time and its bucket."""
    values = points.select(F.transform(as_vector(features), lambda x: x + F.lit(0.0)).alias("c"))  # no -0.0
    texts = values.withColumn("text", F.concat_ws(":", F.lit(str(seed)), F.array_join(F.col("c").cast("array<string>"), ",", "null")))
    return texts.withColumn("e", _exponential(F.col("text"))).withColumn("bucket", F.expr(f"pmod(xxhash64(text), {BUCKETS}L)"))


def _exponential(text: Column) -> Column:
    digits = F.substring(F.md5(F.concat_ws(":", text, F.lit("1"))), 1, 13)
    return -F.log((F.conv(digits, 16, 10).cast("double") + 1.0) / float(1 << 52))


def candidates(points: DataFrame, k: int, features: Features, seed: int) -> DataFrame:
    """``c, text, n, a``: the values that can be among ``k`` drawn, the number of their points and their first time.

    All ``k`` are among them. The points are scanned three times: for the number of points and the lowest
    ``E1`` by bucket of values; for the points of the ``k`` lowest of these, whose latest first time bounds
    what can be drawn; and for the points of values that may come before it. What is shuffled are buckets,
    of which there are at most ``BUCKETS``, and about ``k * (1 + values / BUCKETS)`` values a task. With
    fewer than ``k`` buckets in use all values are counted.
    """
    rows = _with_times(points, features, seed)
    spark = points.sparkSession
    table = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("e").alias("low")).toArrow()
    bucket, n, low = (table.column(i).to_numpy() for i in range(3))
    if 0 < k <= len(bucket):
        first = np.lexsort((bucket, low))[:k]
        pairs = local_table(spark, list(zip(bucket[first].tolist(), low[first].tolist())), _FIRST)
        counted = rows.join(F.broadcast(pairs), ["bucket", "e"]).groupBy("c").agg((F.first("e") / F.count("*")).alias("a"))
        bound = counted.groupBy().agg(F.max("a")).head()[0]
        reach = bound * n * (1 + 1e-9)  # rounding must not shut out an equal time
        kept = np.flatnonzero(low <= reach)
        sent = local_table(spark, list(zip(bucket[kept].tolist(), reach[kept].tolist())), _REACH)
        rows = rows.join(F.broadcast(sent), "bucket").filter("e <= reach")
    counts = rows.groupBy("c").agg(F.count("*").alias("n"), F.first("text").alias("text"), F.first("e").alias("e"))
    return counts.select("c", "text", "n", (F.col("e") / F.col("n")).alias("a"))


def _run(c: list[float], text: str, n: int) -> Iterator[tuple[float, list[float], int]]:
    return ((time, c, j) for j, time in race_times(text, n))


def race(points: DataFrame, k: int, features: Features, seed: int) -> list[tuple[list[float], int]]:
    """The ``k`` drawn points, fewer if there are no more, as value and number among equal ones."""
    # a value whose first time is not among the k earliest of first times has no point among the k
    best = candidates(points, k, features, seed).orderBy("a", "c").limit(k).collect()
    runs = [_run(r["c"], r["text"], r["n"]) for r in best]
    return [(c, j) for _, c, j in itertools.islice(heapq.merge(*runs), k)]


def race_table(points: DataFrame, k: int, features: Features, seed: int) -> DataFrame:
    """As ``race``, as a table ``c, j``, for a ``k`` that is no matter for the driver."""
    ranked = number_rows(candidates(points, k, features, seed), ["a", "c"], "rank").filter(F.col("rank") < k)
    latest = ranked.filter(F.col("rank") == k - 1).select("a").head()  # none: fewer values than k
    end = float("inf") if latest is None else latest["a"]

    def run(batches):
        for batch in batches:
            for c, text, n in zip(batch.column(0), *(batch.column(i).to_pylist() for i in (1, 2))):
                times = itertools.takewhile(lambda t: t[1] <= end, itertools.islice(race_times(text, n), k))
                while part := list(itertools.islice(times, 4096)):
                    j, a = zip(*part)
                    values = pa.array([c.as_py()] * len(part), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([values, pa.array(j, pa.int64()), pa.array(a)], names=["c", "j", "a"])

    # a first time is divided in Spark and in Python alike, so the value that sets the end is in
    runs = ranked.select("c", "text", "n").mapInArrow(run, "c array<double>, j bigint, a double")
    return number_rows(runs, ["a", "c", "j"], "rank").filter(F.col("rank") < k).select("c", "j")
