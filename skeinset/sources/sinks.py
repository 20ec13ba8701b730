"""Writers for results. Each writes aside and takes the place of a former result only when it is whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinset.functions.vectors import format_vector
from skeinset.sources.folders import commit


def _text(df: DataFrame, column: str, sep: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    value = format_vector(column, sep) if kind == "array" else F.col(column).cast("string")
    return F.coalesce(value, F.lit(""))


def _commit(lines: DataFrame, path: str, overwrite: bool) -> None:
    commit(lines.sparkSession, path, lambda at: lines.write.text(at), overwrite)


def to_lines(df: DataFrame, sep: str = ",") -> DataFrame:
    """``value``: one line per row, no quoting; nulls are empty fields."""
    return df.select(F.concat_ws(sep, *[_text(df, c, sep) for c in df.columns]).alias("value"))


def write_delimited(df: DataFrame, path: str, sep: str = ",", overwrite: bool = False) -> None:
    """The lines of ``to_lines`` as text files, without a header."""
    _commit(to_lines(df, sep), path, overwrite)


def write_keyed(df: DataFrame, path: str, key: str, value: str | None = None, overwrite: bool = False) -> None:
    """Lines ``key`` or ``key<TAB>value``; vectors are comma-separated."""
    parts = [_text(df, key, ",")] + ([_text(df, value, ",")] if value else [])
    _commit(df.select(F.concat_ws("\t", *parts)), path, overwrite)


def write_history(history: DataFrame, path: str, overwrite: bool = False) -> None:
    """One folder per iteration."""
    commit(history.sparkSession, path, lambda at: history.write.partitionBy("iteration").parquet(at), overwrite)


def write_centroids(centroids: DataFrame, path: str, with_id: bool = False) -> None:
    """One file with the centroids in id order. Only the ``k`` centroids pass the single task."""
    ordered = centroids.orderBy("cid").coalesce(1)
    vector = format_vector("c")
    line = F.concat_ws("\t", F.col("cid").cast("string"), vector) if with_id else vector
    _commit(ordered.select(line), path, True)


def dump(df: DataFrame, n: int = 20) -> None:
    """Print the first rows."""
    df.show(n, truncate=False)
