"""k-nearest-neighbour classification over mixed numeric and nominal columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from skeinset.functions.kernels import nearest_rows
from skeinset.functions.vectors import min_max
from skeinset.operators.ranks import number_rows
from skeinset.session import cut_lineage

QUERIES_PER_PASS = 50_000

# The ranges the numeric columns are scaled by when none are given.
DEFAULT_RANGES = {"age": (18.0, 77.0), "income": (5000.0, 67789.0), "children": (0.0, 5.0)}
DEFAULT_NOMINAL = ("status", "gender")


@dataclass
class KnnResult:
    """``neighbours``: ``query_id, rank, dist, label`` and the ids; ``labels``: ``query_id, label``."""

    neighbours: DataFrame

    @property
    def labels(self) -> DataFrame:
        """The label most neighbours have; equal votes go to the lowest label."""
        votes = self.neighbours.groupBy("query_id", "label").agg(F.count(F.lit(1)).alias("votes"))
        best = F.min(F.struct((-F.col("votes")).alias("order"), "label")).alias("best")
        return votes.groupBy("query_id").agg(best).select("query_id", F.col("best.label").alias("label"))


def knn_classify(
    train: DataFrame,
    queries: DataFrame,
    k: int | str,
    numeric: Mapping[str, tuple[float, float]] | None = None,
    nominal: Sequence[str] = DEFAULT_NOMINAL,
    label: str = "model",
    id_cols: Sequence[str] = ("id",),
    query_id: str = "query_id",
    one_per_distance: bool = False,
    queries_per_pass: int = QUERIES_PER_PASS,
) -> KnnResult:
    """Classify each row of ``queries`` by its ``k`` nearest rows of ``train``.

    ``k`` is a number or the name of a column of ``queries``. Distance: squared differences of the
    scaled numeric columns plus 0 or 1 per nominal column. Equal distances go by ``id_cols``, nulls
    first; ``one_per_distance`` keeps only the first of them. A numeric value that is null or NaN is
    an error, and so is a ``k`` below 1.

    Queries are sent to each task, which keeps the best rows of each while it reads ``train`` once;
    only those are shuffled. Beyond ``queries_per_pass`` queries there are further passes, each written out.
    """
    if isinstance(k, int) and k < 1:
        raise ValueError("k must be at least 1")
    numeric = DEFAULT_RANGES if numeric is None else numeric
    wanted = queries.select(
        F.col(query_id).alias("query_id"),
        (F.col(k) if isinstance(k, str) else F.lit(k)).cast("bigint").alias("k"),
        *[min_max(c, *r).alias(f"q_{c}") for c, r in numeric.items()],
        *[F.col(c).cast(train.schema[c].dataType).cast("string").alias(f"q_{c}") for c in nominal],
    )
    ids = [f"id_{i}" for i in range(len(id_cols))]
    rows = train.select(
        *[min_max(c, *r).alias(f"t_{c}") for c, r in numeric.items()],
        *[F.col(c).cast("string").alias(f"t_{c}") for c in nominal],
        *[F.col(c).alias(i) for i, c in zip(ids, id_cols)],
        F.col(label).alias("label"),
    )
    found = _in_passes(rows, wanted, len(numeric), ids, one_per_distance, queries_per_pass)
    return KnnResult(found.withColumnsRenamed(dict(zip(ids, id_cols))))


def _in_passes(
    rows: DataFrame, queries: DataFrame, n_numeric: int, ids: Sequence[str], one_per_distance: bool, size: int
) -> DataFrame:
    """One pass over ``rows`` per ``size`` queries. The driver holds the queries of one pass, whose result is
    written before those of the next are taken. A pass is a range of row numbers, so that it doesn't matter if
    query ids are null or repeat."""
    first = queries.limit(size + 1).toArrow()
    if first.num_rows <= size:
        return _nearest(rows, first, n_numeric, ids, one_per_distance)
    numbered = number_rows(queries, [], "__row")
    total, passes = numbered.count(), []
    for start in range(0, total, size):
        asked = numbered.filter(F.col("__row").between(start, start + size - 1)).drop("__row").toArrow()
        passes.append(cut_lineage(_nearest(rows, asked, n_numeric, ids, one_per_distance)))
    return reduce(DataFrame.unionByName, passes)


def _nearest(rows: DataFrame, asked: pa.Table, n_numeric: int, ids: Sequence[str], one_per_distance: bool) -> DataFrame:
    """The nearest rows of each query: the best of each task, ranked."""
    spark = rows.sparkSession
    asked = asked.combine_chunks()
    k, columns = asked.column("k"), [pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in asked.columns[2:]]
    numbers = [c.to_numpy(zero_copy_only=False) for c in columns[:n_numeric]]
    if k.null_count or any(n < 1 for n in k.to_pylist()):
        raise ValueError("k must be at least 1")
    if any(np.isnan(c.astype(float)).any() for c in numbers):
        raise ValueError("a numeric value is missing")
    search = nearest_rows(numbers, columns[n_numeric:], k.to_numpy(), one_per_distance)
    carried = rows.schema.fields[-len(ids) - 1 :]
    schema = StructType([StructField("q", LongType()), StructField("dist", DoubleType()), *carried])
    best = rows.mapInArrow(search, schema)
    by_row = [*ids, "label"]
    if one_per_distance:
        best = best.groupBy("q", "dist").agg(F.min(F.struct(*by_row)).alias("first")).select("q", "dist", "first.*")
    most = max(k.to_pylist(), default=1)
    window = Window.partitionBy("q").orderBy("dist", *by_row)
    ranked = best.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= most)
    named = pa.table({"q": pa.array(range(asked.num_rows), pa.int64()), "query_id": asked.column("query_id"), "k": k})
    known = ranked.join(F.broadcast(spark.createDataFrame(named)), "q").filter("rank <= k")
    return known.select("query_id", "rank", "dist", *ids, "label")
