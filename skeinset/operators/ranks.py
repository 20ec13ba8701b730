"""Dense row numbers without a single-partition window."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinset.operators.nearest import local_table
from skeinset.session import cut_lineage


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with numbers 0, 1, ... in ``order`` as column ``name``; in any order if that is empty.

    A range-partitioned sort gives each row a rank inside its partition; the partitions' row
    counts, one number each, turn those into overall ranks.
    """
    ranked = cut_lineage((df.orderBy(*order) if order else df).withColumn("__at", F.monotonically_increasing_id()))
    part, rank = F.shiftright("__at", 33).alias("__part"), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    starts, total = [], 0
    for row in sorted(ranked.groupBy(part).count().collect()):
        starts.append((row["__part"], total))
        total += row["count"]
    schema = pa.schema([("__part", pa.int64()), ("__start", pa.int64())])
    offsets = local_table(df.sparkSession, starts, schema)
    placed = ranked.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return placed.withColumn(name, F.col("__start") + rank).select(*df.columns, name)
