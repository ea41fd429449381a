"""The SQL form of the analyst questions returns exactly what the DataFrame form does."""

import pytest

from shelfwise.plans import analyst, analyst_sql
from shelfwise.plans.registry import gold_tables
from tests.conftest import SF_MID, SF_SMALL

ORDERED = {"q02_daily_trend", "q03_top_products", "q04_category_share", "q06_urgent_restock",
           "q07_store_delivery", "q09_top_areas", "q10_city_revenue"}


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_MID])
def test_sql_matches_dataframe(spark, sf_dir):
    gold = gold_tables(spark, sf_dir)
    frames = analyst.answer_all(gold)
    sqls = analyst_sql.ask_all(spark, gold)
    for name, df in frames.items():
        got = sqls[name]
        assert got.columns == df.columns, name
        assert dict(got.dtypes) == dict(df.dtypes), name
        a, b = got.collect(), df.collect()
        if name in ORDERED:
            assert a == b, name
        else:
            assert sorted(a) == sorted(b), name
