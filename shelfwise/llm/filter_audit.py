"""How filters interact: what each removes in every order, by counting paths of the subset lattice.

A state is the set of filters already applied. A document fails some set of
filters (its mask) and is alive in a state that holds none of them, so all
that the orders need is the number alive in each of the 2^n states.

1. One row a text and id: the masks of the conditions on the text itself are
   worked out where the text is read, and only a digest of it goes on.
   Identical texts are found by aggregates on that digest, which a hot group
   of copies enters already counted.
2. Counts by part and mask become counts alive by part and state.
3. An edge applies one filter in one state. Going forward, each state has
   the number of orders that reach it; going backward, the number that leave
   it. An edge lies on (reaching its start) x (leaving its end) orders: that
   weight times what the edge removes, summed over a filter's edges, is the
   filter's removals over all orders (n! times its Shapley value).
4. Each order is a path of n edges; its steps are read from the same edges.

States, edges and steps depend on the number of filters alone.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

_WORDS = r"[\x20\x09-\x0D]+"

#: Filters on the text itself, by letter, in the order of their bits; E is for copies.
ROW_FILTERS = ("A", "B", "C", "D")
COPIES = "E"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _WORDS), "")


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions on a whole text that is not null; those on words are the fields of one struct."""
    by_words = _let(_words(text), lambda w: F.struct(
        (F.size(w) < 200).alias("A"), (100 * F.size(F.array_distinct(w)).cast("long") < 50 * F.size(w).cast("long")).alias("B")))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {"words": by_words, "C": 100 * capitals.cast("long") > 3 * F.length(text).cast("long"), "D": text.rlike(r"[#$%&*|]")}


def failure_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                  quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and the set of filters they fail, good and toxic ones among them.

    Bit k of ``mask`` is the k-th of ``ROW_FILTERS``, the next one ``COPIES``:
    the text equals that of a row with a smaller id. A row without an id is
    neither smaller nor greater, so it is no copy and makes none; rows with
    one id aren't copies of each other. Null text is empty, a null part the
    empty string. A document is good (toxic) if any of its rows in
    ``labels`` has 1 there; without such a row or an id it is neither. Other
    columns play no part. Empty tables give no rows (no labels: zeros).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    fails = text_failures(text)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.sha2(text, 256).alias("hex"), fails["words"].alias("w"), fails["C"].alias("c"), fails["D"].alias("d"))
    bits = {"A": F.col("w.A"), "B": F.col("w.B"), "C": F.col("c"), "D": F.col("d")}
    mask = sum((F.when(bits[f], 1 << k).otherwise(0) for k, f in enumerate(ROW_FILTERS)), F.lit(0))
    digest = (F.unhex("hex")).alias("digest")
    seen = (rows.select("id", "part", digest, mask.alias("mask"))
            .groupBy("digest", "id", "part", "mask").agg(F.count("*").alias("n")))
    said = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("said_of"))
            .agg(F.max((F.col(quality_col) == 1).cast("int")).alias("good"), F.max((F.col(toxic_col) == 1).cast("int")).alias("toxic"))
            .withColumn("key", F.col("said_of").cast("string")))
    # rows without an id meet no label; dealt by their text, they don't go to one task
    seen = seen.withColumn("key", F.coalesce(F.col("id").cast("string"), F.hex("digest")))
    seen = (seen.join(said, (seen["key"] == said["key"]) & (seen["id"] == said["said_of"]), "left")
            .drop("key", "said_of").fillna(0, ["good", "toxic"]))
    # of each group of equal texts and kinds: its smallest id, the rows that have it, all rows
    kinds = seen.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.min("id").alias("least"), F.min_by("n", "id").alias("at_least"), F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("without_id"))
    # a text has a row a kind here, however many copies it has
    kinds = kinds.withColumn("first", F.min("least").over(Window.partitionBy("digest")))
    own = F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0) + F.col("without_id")
    both = F.explode(F.array(F.struct(F.col("mask").alias("mask"), own.alias("n")),
                             F.struct((F.col("mask") + (1 << len(ROW_FILTERS))).alias("mask"), (F.col("n") - own).alias("n"))))
    return (kinds.select("part", "good", "toxic", both.alias("x"))
            .groupBy("part", "x.mask").agg(F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"),
                                           F.sum(F.col("x.n") * F.col("toxic")).alias("toxic")))


def path_counts(filters: int) -> tuple[list[int], list[int]]:
    """Orders that reach each state from the empty one, and that lead from it to the full one, state by state."""
    states = 1 << filters
    reaching, leaving = [1] + [0] * (states - 1), [0] * (states - 1) + [1]
    for state in range(states):  # every edge goes to a greater number
        for f in range(filters):
            if not state >> f & 1:
                reaching[state | 1 << f] += reaching[state]
    for state in reversed(range(states)):
        for f in range(filters):
            if not state >> f & 1:
                leaving[state] += leaving[state | 1 << f]
    return reaching, leaving


def interactions(masks: DataFrame, names: str = "".join(ROW_FILTERS) + COPIES) -> DataFrame:
    """One row for each part, order of the filters ``names`` and step, from counts by part and mask.

    Columns: part, filter_order, step (from 1), filter, and of documents of
    the part: kept (after the step), removed (by it), redundant (fail the
    filter, gone before), unique_fails (fail this filter alone), good_lost
    and toxic_lost (removed by the step), shapley (what the filter removes,
    summed over all orders). A part with rows of zero documents only, or
    with no failures, has its rows too, zeros included. No rows: no rows.
    """
    spark, n = masks.sparkSession, len(names)
    full = (1 << n) - 1
    reaching, leaving = path_counts(n)
    states = F.sequence(F.lit(0), F.lit(full))
    here = F.when(F.col("mask").bitwiseAND(F.col("state")) == 0, 1).otherwise(0)
    counts = ("n", "good", "toxic")
    alive = (masks.select("part", "mask", *counts, F.explode(states).alias("state"))
             .groupBy("part", "state").agg(*[F.sum(F.col(c) * here).alias(c) for c in counts]))
    by_part = alive.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("state", F.struct(*counts)))).alias("alive"))

    # n * 2^(n-1) edges; n! orders of n steps each
    edges = [(s, f, s | 1 << f, reaching[s] * leaving[s | 1 << f]) for s in range(full + 1) for f in range(n) if not s >> f & 1]
    edge_table = F.broadcast(spark.createDataFrame(edges, "start int, f int, end int, orders long"))
    moves = by_part.select("part", "alive", F.explode(states).alias("start")).join(edge_table, "start").select(
        "part", "start", "end", "f", "orders", F.col("alive")[F.col("end")]["n"].alias("kept"),
        *[(F.col("alive")[F.col("start")][c] - F.col("alive")[F.col("end")][c]).alias(name)
          for c, name in zip(counts, ("removed", "good_lost", "toxic_lost"), strict=True)])
    of_filter = Window.partitionBy("part", "f")
    moves = moves.select("*", F.sum(F.col("orders") * F.col("removed")).over(of_filter).alias("shapley"),
                         # applied first it removes all that fail it, applied last those that fail it alone
                         F.sum(F.when(F.col("start") == 0, F.col("removed"))).over(of_filter).alias("fails"),
                         F.sum(F.when(F.col("end") == full, F.col("removed"))).over(of_filter).alias("unique_fails"))
    steps = []
    for order in permutations(range(n)):
        start, title = 0, "".join(names[f] for f in order)
        for k, f in enumerate(order):
            steps.append((title, k + 1, names[f], start, f))
            start |= 1 << f
    step_table = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, filter string, start int, f int"))
    return (moves.join(step_table, ["start", "f"])
            .select("part", "filter_order", "step", "filter", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
                    "unique_fails", "good_lost", "toxic_lost", "shapley"))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return interactions(failure_masks(docs, labels)).drop("filter")


#: Every document against every step of every order, without masks or states.
OP13_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
said AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
firsts AS (SELECT coalesce(text, '') AS t, min(doc_id) AS first FROM documents GROUP BY 1),
d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, MAP {
    'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
    'C': 100 * (length(w.t) - length(regexp_replace(w.t, '[A-Z]', '', 'g'))) > 3 * length(w.t),
    'D': regexp_matches(w.t, '[#$%&*|]'), 'E': coalesce(first < w.doc_id, false)} AS fails
  FROM w JOIN firsts ON w.t = firsts.t LEFT JOIN said ON w.doc_id = said.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
n AS (
  SELECT part, good, toxic, filter_order, step, fails[filter_order[step]] AS fail,
         len(list_filter([1, 2, 3, 4, 5], lambda k: k < step AND fails[filter_order[k]])) > 0 AS gone,
         len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: fails[x])) = 1 AS one, count(*) AS n
  FROM d, steps GROUP BY ALL),
r AS (
  SELECT part, filter_order, step, filter_order[step] AS f, coalesce(sum(n) FILTER (NOT gone AND NOT fail), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND fail), 0) AS removed, coalesce(sum(n) FILTER (gone AND fail), 0) AS redundant,
         coalesce(sum(n) FILTER (fail AND one), 0) AS unique_fails,
         coalesce(sum(n) FILTER (NOT gone AND fail AND good = 1), 0) AS good_lost,
         coalesce(sum(n) FILTER (NOT gone AND fail AND toxic = 1), 0) AS toxic_lost
  FROM n GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""
