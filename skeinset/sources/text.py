"""Readers for the plain text inputs: no header, no quoting, a fixed schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinset.functions.vectors import parse_vector
from skeinset.operators.ranks import number_rows
from skeinset.sources import schemas

Schema = Sequence[tuple[str, str]]


def parse_delimited(lines: DataFrame, schema: Schema, sep: str = ",") -> DataFrame:
    """The fields of the text column ``value``.

    Every separator splits; surplus fields are dropped; missing, empty or unreadable ones are null.
    Whole numbers may be written with a fraction, which is cut off. A blank line is a row of nulls.
    """
    fields = F.split("value", f"\\Q{sep}\\E", -1)

    def field(i: int, kind: str):
        text = F.get(F.col("f"), F.lit(i))
        if kind == "string":
            return F.when(text != "", text)
        if kind in ("int", "bigint"):
            return F.coalesce(F.trim(text).try_cast(kind), F.trim(text).try_cast("double").try_cast(kind))
        return F.trim(text).try_cast(kind)

    split = lines.select(fields.alias("f"))
    return split.select(*[field(i, kind).alias(name) for i, (name, kind) in enumerate(schema)])


def read_delimited(spark: SparkSession, path: str, schema: Schema, sep: str = ",") -> DataFrame:
    """A text file or folder, one row per line; see ``parse_delimited``."""
    return parse_delimited(spark.read.text(path), schema, sep)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.PAGES)


def read_follows(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.FOLLOWS)


def read_activity(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.ACTIVITY)


def read_training(spark: SparkSession, path: str) -> DataFrame:
    """Labelled records for the nearest-neighbour classifier."""
    return read_delimited(spark, path, schemas.TRAINING)


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Records to classify: ``query_id`` in file order, ``k`` (the neighbours to ask for) and the fields."""
    line = F.concat_ws(",", F.col("at").cast("string"), "value").alias("value")
    return parse_delimited(_in_order(spark, path).select(line), (("query_id", "bigint"), *schemas.QUERY))


def _in_order(spark, path: str) -> DataFrame:
    """``value, at``: the lines of a file or folder that are not blank, numbered by file name and place.

    A split of a file is read by one task from its first line to its last, so file, start of the split and the
    count of rows in the task give the order, however many tasks read the files.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    kept = lines.withColumn("line", F.monotonically_increasing_id()).filter(F.trim("value") != "")
    numbered = number_rows(kept.withColumn("value", F.trim("value")), ["file_path", "file_block_start", "line"], "at")
    return numbered.select("value", "at")


def parse_points(lines: DataFrame) -> DataFrame:
    """``features``: one vector per line that is not blank. Text that is no number is an error."""
    kept = lines.select(F.trim("value").alias("line")).filter(F.col("line") != "")
    return kept.select(parse_vector("line").alias("features"))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Points of a text file or folder; see ``parse_points``."""
    return parse_points(spark.read.text(path))


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """``cid, c`` in the order of file names and lines, or by the id in front where lines read ``id<TAB>vector``."""
    parts = F.split("value", "\t")
    keyed = F.size(parts) > 1
    return _in_order(spark, path).select(
        F.when(keyed, parts[0].try_cast("bigint")).otherwise(F.col("at")).alias("cid"),
        parse_vector(F.element_at(parts, -1)).alias("c"),
    )
