"""What several operators of this folder share: bytes of a text column, kept tables, sorted runs."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinset.session import ensure_checkpoint_dir


BATCH_BYTES = 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``; its session sends batches of about ``BATCH_BYTES`` at most to Python from here on.

    Texts are long, and Spark's own bound of 64 MiB is a multiple of that in a worker that holds a batch,
    its texts and its results. A lower bound that is set already stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)b?", df.sparkSession.conf.get(name))
    if not now or int(now[1]) > BATCH_BYTES:
        df.sparkSession.conf.set(name, str(BATCH_BYTES))
    return df


_HELD: dict[str, Callable[[], object]] = {}


def hold(name: str, clear: Callable[[], object]) -> None:
    """Say in a task that the operator ``name`` now keeps memory that ``clear`` frees; that of others is freed.

    Python workers are used again by later stages, which would otherwise add theirs to it.
    """
    for other in [n for n in _HELD if n != name]:
        _HELD.pop(other)()
    _HELD[name] = clear


def as_bytes(texts: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null as empty."""
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def utf8(text: str | Column) -> Column:
    """The bytes of a text column; null as empty."""
    return F.encode(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "UTF-8")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder; what is there goes when the session ends."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    _at(spark, path, "mkdirs")
    _at(spark, path, "deleteOnExit")
    return path


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read on from there.

    Lost executors then cost no more than the step at hand. The files go when the session ends, or
    earlier by ``release``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def release(kept: DataFrame) -> None:
    """Remove a kept table that is read no more."""
    _at(kept.sparkSession, kept.kept_at, "delete", True)


def salted_join(many: DataFrame, few: DataFrame, key: str, spread: str, salts: int = 4) -> DataFrame:
    """``many`` joined with ``few`` (one row per ``key``), a frequent key's rows dealt out by ``spread``.

    Both sides are shuffled by key and salt, so adaptive execution may split what is still too large.
    """
    copied = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return many.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).join(copied, [key, "__salt"]).drop("__salt")


def _at(spark: SparkSession, path: str, action: str, *args) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    getattr(place.getFileSystem(spark._jsc.hadoopConfiguration()), action)(place, *args)


def sorted_runs(batches: Iterator[pa.RecordBatch], shift: int, limit: int) -> Iterator[tuple[bool, pa.Table]]:
    """Rows sorted by their first column, ``key``, cut where ``key >> shift`` changes.

    Gives ``(True, rows)`` with any number of whole runs, or ``(False, rows)`` with a part of a run
    of more than ``limit`` rows. No more than ``limit`` rows and a batch are held.
    """
    held, oversized = None, None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows]).combine_chunks()
        held = None
        run = rows.column(0).to_numpy() >> shift
        first = int(np.searchsorted(run, oversized, "right")) if oversized is not None else 0
        if first:
            yield False, rows.slice(0, first)
        if first == len(run):
            continue
        oversized = None
        last = max(first, int(np.searchsorted(run, run[-1], "left")))
        if last > first:
            yield True, rows.slice(first, last - first)
        held = rows.slice(last)
        if held.num_rows > limit:
            oversized = run[-1]
            yield False, held
            held = None
    if held is not None and held.num_rows:
        yield True, held
