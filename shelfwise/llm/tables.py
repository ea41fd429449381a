"""Tables between the passes of one operator, in the session's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from shelfwise.session import ensure_checkpoint_dir


def folder(spark: SparkSession) -> str:
    """A new path in the shared folder; nothing is there yet."""
    return f"{ensure_checkpoint_dir(spark)}/passes-{uuid.uuid4().hex}"


def removed(spark: SparkSession, path: str) -> None:
    """Nothing is at ``path`` any more, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What is in a folder."""
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    found = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(there)
    return sorted(s.getPath().getName() for s in found)


@contextmanager
def written(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as a Parquet table of the shared folder: lineage cut, columns read one by one, gone at the end."""
    spark = df.sparkSession
    path = folder(spark)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        removed(spark, path)
