"""Folders that are written as a whole or not at all, on any file system Spark can reach."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from skeinset.session import ensure_checkpoint_dir


class Folder:
    """A path and its file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._at = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._fs.exists(self._at)

    def remove(self) -> None:
        self._fs.delete(self._at, True)

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at)) if self.exists() else []

    def beside(self, mark: str) -> Folder:
        """A folder of the same parent; its name begins with ``_``, so readers of the parent pass over it."""
        parent = self._at.getParent()
        return Folder(self.spark, f"{parent}/_{mark}-{self._at.getName()}")

    def move_to(self, other: Folder) -> None:
        if not self._fs.rename(self._at, other._at):
            raise OSError(f"{self.path} could not be moved to {other.path}")


def commit(spark: SparkSession, path: str, write: Callable[[str], None], overwrite: bool = False) -> None:
    """Let ``write`` write a folder, and give it the name ``path`` when it is whole.

    With ``overwrite`` a former folder stays until then; without, one is an error. A write that fails leaves
    what was there. Should a process end between the two moves of an overwrite, the former folder lies beside
    as ``_before-...``; the next commit or ``recover`` puts it back.
    """
    target = Folder(spark, path)
    recover(spark, path)
    if target.exists() and not overwrite:
        raise AnalysisException(f"{path} is there already")
    fresh, before = Folder(spark, target.beside(f"writing-{uuid.uuid4().hex}").path), target.beside("before")
    try:
        write(fresh.path)
        if target.exists():
            target.move_to(before)
        try:
            fresh.move_to(target)
        except Exception:
            if before.exists():
                before.move_to(target)
            raise
        if before.exists():
            before.remove()
    finally:
        if fresh.exists():
            fresh.remove()


def recover(spark: SparkSession, path: str) -> None:
    """Put back, or remove, what a commit that was cut off left beside ``path``."""
    target, before = Folder(spark, path), Folder(spark, path).beside("before")
    if before.exists():
        if target.exists():
            before.remove()
        else:
            before.move_to(target)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder; its content goes when the session ends."""
    ensure_checkpoint_dir(spark)
    folder = Folder(spark, f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}")
    folder._fs.mkdirs(folder._at)
    folder._fs.deleteOnExit(folder._at)
    return folder.path
