"""The queries of this subpackage as the driver finds them."""

import __spark_entry__ as entry
import corpus_pipeline
from shelfwise.llm.queries import ORACLE_SQL, QUERIES


def test_one_query_an_operator_and_the_pipeline():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()
