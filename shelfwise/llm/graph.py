"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.session import ensure_checkpoint_dir


def saved(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` written to the session's shared checkpoint folder, lineage cut.

    With ``rows``, it is read back in partitions of about that many rows, so
    that a small table does not go on in as many tasks as it was made in.
    """
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    return out.coalesce(max(1, -(-out.count() // rows))) if rows else out


#: Edges in a partition, about.
EDGES = 200_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); the component is its smallest node.

    By contraction: every node takes the smallest label among itself and its
    neighbours, edges are rewritten to labels, and what is left of the graph
    goes on to the next level, until no edge is left; then the labels of all
    levels are put together. Where nodes are numbered at random, as by
    hashes, each level leaves a fraction of the nodes. The smallest node of a
    component keeps its label on every level. No edges: no rows.
    """
    ends = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    level = saved(edges.select(*ends).where("a <> b").distinct(), EDGES)
    labels: list[DataFrame] = []
    while not level.isEmpty():
        both = level.union(level.select(F.col("b").alias("a"), F.col("a").alias("b")))
        label = saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                      .select("node", F.least("node", "m").alias("label")), EDGES)
        labels.append(label)
        first = label.select(F.col("node").alias("a"), F.col("label").alias("la"))
        second = label.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        level = saved(level.join(first, "a").join(second, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
                      .select(*ends).where("a <> b").distinct(), EDGES)
    if not labels:
        return level.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = labels.pop().withColumnRenamed("label", "component")
    while labels:
        above = out.select(F.col("node").alias("label"), "component")
        out = (labels.pop().join(above, "label", "left")
               .select("node", F.coalesce("component", "label").alias("component")))
    return out
