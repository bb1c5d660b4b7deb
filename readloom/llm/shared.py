"""Folders and tables that every executor can see, used to cut lineage.

Intermediate results of the corpus operators are written as Parquet below the
folder named by ``spark.checkpoint.dir``.  A lost executor therefore never
loses them: the files belong to the shared store, not to the executor.  What was
shuffled to make a table is not needed once it is written, so Spark is asked to
remove those files at the end of the write and not whenever its driver collects
garbage.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from readloom.sources.shared import new_path, shared_dir

__all__ = ["WORD", "discard", "new_path", "read_table", "shared_dir", "stored"]

WORD = r"[^\x20\x09-\x0D]+"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an execution go at its end; the session's own setting comes back afterwards."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str, path: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder (or to ``path``) and return the reader of what was written."""
    path = path or new_path(df.sparkSession, name)
    with _shuffles_removed(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove tables of ``stored`` that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
