"""Benchmark decontamination: a broadcast hash set of test n-grams against all token windows.

Everything is DataFrame expressions. Texts and benchmark items are lower-cased
(A-Z only) and cut into words of digits, letters a-z and characters beyond
ASCII. A window is ``WINDOW`` consecutive words of an item; an item of fewer
words is one window. Every window of every document is hashed and looked up
in the set of the benchmark's hashes; the windows that hit are then compared
word for word, in a join with the benchmark's windows.

The set holds ``MAX_SET`` hashes at most. For a larger benchmark the look-up
is left out, and the join itself, then of all windows and without a broadcast
hint, finds the same hits. A window's items are one list, so a window that many
items share is one row of that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 10
MAX_SET = 50_000
#: Documents of which this share of words is hit go; others lose the words hit.
DROP_SHARE = 0.5

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded(text: Column) -> Column:
    """``text`` with A-Z in lower case and no other change; null is empty."""
    text = F.coalesce(text, F.lit(""))
    # lower() is the faster way, and the same where no other character has a lower case
    return (F.when(text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"), F.translate(text, _UPPER, _LOWER))
            .otherwise(F.lower(text)))


def words(text: Column) -> Column:
    return F.array_remove(F.split(folded(text), _SEPARATORS), "")


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once a row, not once an element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: F.xxhash64(w))


def _grams(tokens: Column, hashes: Column, size: int, wanted: list[int] | None) -> Column:
    """(pos, len, gram) of the windows of ``size`` words; only those whose hash, of their words' hashes, is wanted, if given."""
    last = F.size(tokens) - size + 1
    at = F.filter(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: i <= last if wanted is None else (
        (i <= last) & F.xxhash64(F.slice(hashes, i, size)).isin(wanted)))
    return F.transform(at, lambda i: F.struct(
        i.alias("pos"), F.lit(size).alias("len"), F.concat_ws(" ", F.slice(tokens, i, size)).alias("gram")))


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item, len, gram, hash) of all distinct windows; items without words have none."""
    cut = benchmark.select(F.col(item_col).alias("item"), words(F.col(text_col)).alias("w"))
    cut = cut.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(window)))
    cut = cut.withColumn("h", _hashes(F.col("w")))
    at = cut.select("item", "len", "w", "h", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)).alias("i"))
    return at.select("item", "len", F.concat_ws(" ", F.slice("w", F.col("i"), F.col("len"))).alias("gram"),
                     F.xxhash64(F.slice("h", F.col("i"), F.col("len"))).alias("hash")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  max_set: int = MAX_SET) -> DataFrame:
    """(``id_col``, key, n_words, hits, items) for every row of ``docs``.

    ``hits`` are the positions (from 1) of the words inside any occurrence
    of a window, ascending; ``items`` the distinct ids, as strings, of items
    with such a window, sorted. ``key`` is a hash of id and text.

    Null or empty text, of a document or an item: no words, no hits. A null
    item id adds hits but no item. Repeated rows give a row each. Other
    columns of ``docs`` and ``benchmark`` play no part. Empty tables are
    allowed.
    """
    grams = benchmark_windows(benchmark, item_col, item_text_col, window)
    lengths = [r["len"] for r in grams.select("len").distinct().collect()]  # at most ``window`` of them
    hashes = [r["hash"] for r in grams.select("hash").distinct().limit(max_set + 1).collect()]
    small = len(hashes) <= max_set
    none = F.array().cast("array<struct<pos:int,len:int,gram:string>>")
    look = _let(words(F.col(text_col)), lambda w: _let(_hashes(w), lambda h: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.concat(none, *[_grams(w, h, size, hashes if small else None) for size in sorted(lengths)]).alias("found"))))
    # a row's number tells it from its copies; all that is found in it comes from the one task that reads it
    spread = (docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("key"),
                          F.monotonically_increasing_id().alias("row"), look.alias("look"))
              .select("id", "key", "row", "look.n_words", F.explode_outer("look.found").alias("f"))
              .select("id", "key", "row", "n_words", "f.pos", "f.len", "f.gram"))
    right = (grams.groupBy(F.col("gram").alias("same"), F.col("len").alias("size"))
             .agg(F.collect_set(F.col("item").cast("string")).alias("named")))
    matched = spread.join(F.broadcast(right) if small else right,
                          (spread["gram"] == right["same"]) & (spread["len"] == right["size"]), "left")
    covered = F.when(F.col("size").isNotNull(), F.sequence("pos", F.col("pos") + F.col("len") - 1))
    return (matched.groupBy("id", "key", "row", "n_words")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(covered)))).alias("hits"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("named")))).alias("items"))
            .drop("row").withColumnRenamed("id", id_col))


def without_words(text: Column, hits: Column) -> Column:
    """``text`` without the words at the positions ``hits`` and the characters that follow each."""
    cut = F.struct(F.regexp_extract_all(text, F.lit(_RAW_WORD), F.lit(0)).alias("raw"),
                   F.split(text, _RAW_WORD, -1).alias("gaps"))

    def rest(c: Column) -> Column:
        kept = F.filter(F.transform(c["raw"], lambda w, i: F.struct(w.alias("word"), (i + 1).alias("pos"))),
                        lambda x: ~F.array_contains(hits, x["pos"]))
        return F.concat(F.get(c["gaps"], F.lit(0)),
                        F.array_join(F.transform(kept, lambda x: F.concat(x["word"], F.get(c["gaps"], x["pos"]))), ""))

    return _let(cut, rest)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  drop_share: float = DROP_SHARE) -> DataFrame:
    """``docs`` without what they share with the benchmark; clean rows are unchanged.

    A document of whose words at least ``drop_share`` are hit goes; others
    lose the words hit. All columns and all other rows are kept, repeated
    ones too. Cases are as in ``contamination``.
    """
    found = (contamination(docs, benchmark, id_col, text_col, item_col, item_text_col, window)
             .where(F.size("hits") > 0).select(F.col("key").alias("__key"), F.col("hits").alias("__hits"),
                                               F.col("n_words").alias("__words")).dropDuplicates(["__key"]))
    marked = docs.withColumn("__key", F.xxhash64(id_col, text_col)).join(found, "__key", "left")
    kept = marked.where(F.col("__hits").isNull() | (F.size("__hits") < drop_share * F.col("__words")))
    text = F.when(F.col("__hits").isNull(), F.col(text_col)).otherwise(without_words(F.col(text_col), F.col("__hits")))
    return kept.withColumn(text_col, text).select(*docs.columns)


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = contamination(docs, benchmark)
    return found.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("hits") > 0).alias("contaminated"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (
  SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s
        FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM items),
windows AS (
  SELECT doc_id, size, s AS pos, array_to_string(w[s:s + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS s FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, pos, windows.size, item_id FROM windows JOIN items ON windows.gram = items.gram AND windows.size = items.size),
covered AS (SELECT doc_id, count(*) AS n FROM (
  SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + size - 1)) AS pos FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS txt
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(named.txt, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
"""
