"""Small tables with the cases that every operator must take."""

from __future__ import annotations

import duckdb
import pandas as pd

WORDS = [f"w{i}é" if i % 7 == 0 else f"Word{i}" for i in range(400)]


def text(a: int, b: int) -> str:
    return " ".join(WORDS[a:b])


#: Null, empty, blank and very long texts, repeated rows, copies, near copies, shared passages, odd white space.
DOCS = [
    (0, None), (1, ""), (2, " \t\n "), (3, "..."), (4, "short text"), (5, "short text"),
    (6, text(0, 100)), (7, text(0, 100)), (7, text(0, 100)), (8, text(0, 97) + " other end here"),
    (9, text(150, 180) + " " + text(20, 70) + " tail"), (10, text(200, 330)), (11, text(200, 330).upper()),
    (12, text(300, 340) + " x " + text(300, 340)), (13, "a\xa0b　c  d\x1ce\x85f\r\n\r\ng " + text(340, 360)),
    (14, "the " * 3000 + text(360, 399)), (15, "x" * 50000), (None, "a row without an id " + text(100, 140)),
]


def frame(spark, rows=DOCS, extra: str = ""):
    """(doc_id, text, and columns whose names the operators use themselves)."""
    rows = [(i, t, "en" if n % 2 else None, "a", 1.0, 7, "z") for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, "
                                       "n_words int, kept_text string")


def pandas_rows(df, by: list[str]) -> list[tuple]:
    out = df.toPandas().astype(object)
    out = out.where(out.notna(), None)
    return sorted(map(tuple, out.itertuples(index=False)), key=lambda r: tuple((x is not None, str(x)) for x in r))


def by_sql(sql: str, **tables: pd.DataFrame) -> list[tuple]:
    con = duckdb.connect()
    for name, table in tables.items():
        con.register(name, table)
    return con.execute(sql)


def same_rows(spark_df, relation) -> None:
    """Equal rows, columns taken by name."""
    columns = sorted(spark_df.columns)
    assert columns == sorted(c[0] for c in relation.description)
    names = [c[0] for c in relation.description]
    left = sorted((tuple(r[c] for c in columns) for r in spark_df.collect()), key=repr)
    right = sorted((tuple(r[names.index(c)] for c in columns) for r in relation.fetchall()), key=repr)
    assert left == right
