"""shelfwise: a Spark-native medallion pipeline for quick-commerce retail data.

Bronze CSV -> silver Parquet -> gold metric tables -> analyst queries, with
bronze profiling and a gold quality gate. Everything is DataFrame / Spark SQL
work; see README.md for the layout.
"""

from shelfwise.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
