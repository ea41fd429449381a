"""Gold quality gate (V1-V5).

Rules per table: it exists, it has rows, key columns have no NULLs, numeric
columns have no negatives (NULL passes). A missing or empty table skips its
other rules. Each table is checked by one aggregate pass; the rule rows of
all tables form one small DataFrame, and only that bounded rule table is
collected to decide the verdict.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources.schemas import GOLD_RULES

GATE_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("rule", T.StringType(), False),
    T.StructField("column_name", T.StringType(), True),
    T.StructField("n_rows", T.LongType(), True),
    T.StructField("bad_rows", T.LongType(), True),
    T.StructField("passed", T.BooleanType(), False),
])


class GateFailure(RuntimeError):
    """Raised by :func:`enforce` when any rule fails."""

    def __init__(self, failures: list[str]):
        super().__init__(f"gold gate failed ({len(failures)} issue(s)): " + "; ".join(failures))
        self.failures = failures


def _rule(rule: str, column: str | None, bad: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        F.lit(column).cast("string").alias("column_name"),
        bad.cast("long").alias("bad_rows"),
    )


def check_table(name: str, df: DataFrame, keys: list[str], numeric: list[str]) -> DataFrame:
    """Rule rows for one present table, from a single aggregate pass."""
    stats = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null__{c}") for c in keys],
        *[F.count_if(F.col(c) < 0).alias(f"neg__{c}") for c in numeric],
    )
    rules = [
        _rule("exists", None, F.lit(0)),
        _rule("not_empty", None, F.when(F.col("n_rows") == 0, 1).otherwise(0)),
        *[_rule("not_null", c, F.col(f"null__{c}")) for c in keys],
        *[_rule("non_negative", c, F.col(f"neg__{c}")) for c in numeric],
    ]
    return (
        stats.select("n_rows", F.explode(F.array(*rules)).alias("r"))
        .filter(F.col("r.rule").isin("exists", "not_empty") | (F.col("n_rows") > 0))
        .select(
            F.lit(name).alias("table_name"), "r.rule", "r.column_name", "n_rows",
            "r.bad_rows", (F.col("r.bad_rows") == 0).alias("passed"),
        )
    )


def gate(spark: SparkSession, gold: dict[str, DataFrame | None],
         rules: dict[str, tuple[list[str], list[str]]] = GOLD_RULES) -> DataFrame:
    """V1-V4: the rule table for every gold table named in ``rules``.

    ``gold`` maps a table name to its DataFrame, or to None when the table
    could not be read (V1 fails and the table's other rules are skipped).
    """
    frames = []
    missing = []
    for name, (keys, numeric) in rules.items():
        df = gold.get(name)
        if df is None:
            missing.append((name, "exists", None, None, 1, False))
        else:
            frames.append(check_table(name, df, keys, numeric))
    if missing:
        frames.append(spark.createDataFrame(missing, GATE_SCHEMA))
    return reduce(DataFrame.unionByName, frames)


def enforce(gate_rows: DataFrame) -> list[str]:
    """V5: raise :class:`GateFailure` listing failed rules; return passed rule names."""
    rows = gate_rows.collect()  # bounded: one row per rule
    failures = [
        f"{r.table_name}{'.' + r.column_name if r.column_name else ''}: {r.rule} ({r.bad_rows} bad)"
        for r in rows if not r.passed
    ]
    if failures:
        raise GateFailure(failures)
    return [f"{r.table_name}:{r.rule}:{r.column_name or ''}" for r in rows]
