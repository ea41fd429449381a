"""Scans and sinks for the three layers.

Layers are directories of Parquet datasets, one per table, under a base path
(``<base>/<table>.parquet``). Writes are distributed, and become visible as
commits of :mod:`shelfwise.sources.versions`: a table, or all tables of a
layer, at once. Datasets that others have written there are read as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources.schemas import BRONZE
from shelfwise.sources.versions import Commit, Layer, NotCommitted

#: Column of staged tables that holds a CSV line with values that don't fit their types, else NULL.
MALFORMED = "_malformed_line"


def table_path(base: str, name: str, ext: str = "parquet") -> str:
    return f"{base.rstrip('/')}/{name}.{ext}"


def read_bronze_csv(spark: SparkSession, base: str, name: str,
                    null_value: str | None = None) -> DataFrame:
    """A bronze CSV with header, read with its declared schema (no inference pass).

    The header is checked against the declared column names
    (``enforceSchema`` off), so a file with reordered or renamed columns
    fails instead of being read by position. Only empty fields are NULL by
    default; pass ``null_value`` (for example ``"NA"``) when the producer
    writes missing values as a marker. A line with a value that does not fit
    its declared type keeps its other values, and is itself kept in
    ``MALFORMED``, so that it can be reported instead of vanishing.
    """
    reader = (
        spark.read.schema(T.StructType([*BRONZE[name].fields, T.StructField(MALFORMED, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
    )
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(table_path(base, name, "csv"))


def read_bronze(spark: SparkSession, base: str, null_value: str | None = None) -> dict[str, DataFrame]:
    return {name: read_bronze_csv(spark, base, name, null_value) for name in BRONZE}


def write_bronze_csv(df: DataFrame, base: str, name: str) -> None:
    """Write a table as a bronze CSV directory with a header (used to stage test input)."""
    df.write.mode("overwrite").option("header", True).csv(table_path(base, name, "csv"))


def read_layer(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A silver or gold Parquet table, as of the layer's last commit.

    A dataset without any commit is read as it lies there; folders of a
    commit that was never finished are not (``NotCommitted``).
    """
    layer = Layer(spark, base)
    manifest = layer.manifest()
    if name in manifest.tables or layer.is_versioned(name):
        return layer.read(name, manifest)
    return spark.read.parquet(table_path(base, name))


def read_if_exists(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """A Parquet table, or None when there is none."""
    try:
        return read_layer(spark, base, name)
    except NotCommitted:
        return None
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_table(df: DataFrame, base: str, name: str, partition_by: str | None = None) -> None:
    """S3: a whole Parquet table, optionally partitioned by a column, in place of the one before.

    Readers have the table before until all of the new one is written.
    """
    with Layer(df.sparkSession, base).commit() as change:
        change.write(df, name, partition_by)


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Expose tables to ``spark.sql`` under their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


@dataclass(frozen=True)
class RowReport:
    """Rows before and after cleaning a table."""

    table: str
    before: int
    after: int

    @property
    def removed(self) -> int:
        return self.before - self.after


def observed_write(raw: DataFrame, clean, change: Commit, name: str, partition_by: str | None = None,
                   write=None) -> RowReport:
    """Clean ``raw`` with ``clean`` and write it as part of a commit, counting rows in the same job.

    Two observations ride on the write plan, so the before/after counts need
    no extra pass over the data. ``write`` takes the place of writing the
    whole table.
    """
    before, after = Observation(f"{name}_before"), Observation(f"{name}_after")
    counted = raw.observe(before, F.count(F.lit(1)).alias("rows"))
    cleaned = clean(counted).observe(after, F.count(F.lit(1)).alias("rows"))
    if write:
        write(cleaned)
    else:
        change.write(cleaned, name, partition_by)
    return RowReport(name, int(before.get["rows"]), int(after.get["rows"]))
