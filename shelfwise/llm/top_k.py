"""Exact top-k inner products: blocks by descending norm, pruned by Cauchy-Schwarz bounds.

Vectors are integers floor(scale * x). They are sorted by norm, longest
first, and kept as blocks. The singular vectors of all of them (from their
d x d second moments, one Spark aggregate) give a rotation that puts most of
each inner product into the first ``HEAD`` coordinates. For a query q and a
vector v,

    q . v <= head(q) . head(v) + |rest(q)| * |rest(v)|.

1. Every block of queries is scored against the block of the longest
   vectors; the k-th best score of each query is its first threshold.
2. A block of queries meets a block of vectors only if their largest norms
   allow a threshold to be reached. There, pairs under the bound go, and the
   rest get exact integer scores, of which each query keeps its k best.
3. The k best of each query's block results are its answer.

Ties go to the smaller id, so bounds only discard what is strictly lower.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfwise.llm.graph import saved

BLOCK, QUERY_BLOCK = 4096, 512
HEAD = 16
#: Products of vectors whose norms have a product up to this are added exactly in 64-bit floats; beyond, in whole numbers.
EXACT = 2.0**52
_LEAST, _MOST = -(2**63), 2**63 - 1


def _scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) as doubles, which hold such numbers of any size: from 2^53 on, all doubles are whole."""
    def one(x: Column) -> Column:
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector, one)


def _valid(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    if len(values):
        out[np.repeat(np.arange(len(sizes)), sizes),
            np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _second_moments(vectors: DataFrame, width: int) -> np.ndarray:
    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column("v"), width)
            total += m.T @ m
        at = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(total[at])],
                                         names=["i", "j", "x"])

    rows = vectors.select("v").mapInArrow(run, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    out = np.zeros((width, width))  # width * width numbers, whatever the table
    for r in rows:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["x"]
    return out


def _to_blocks(width: int, size: int):
    """One row a block: its number, ids and vectors, and its largest norm."""
    def run(batches):
        number, ids, rows = TaskContext.get().partitionId() << 32, [], []

        def block():
            nonlocal number
            m, i = np.concatenate(rows), np.concatenate(ids)
            number += 1
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([float(np.sqrt((m * m).sum(axis=1)).max())]),
                pa.array([i.tobytes()], pa.binary()), pa.array([_bytes(m)], pa.binary()),
            ], names=["block", "norm", "ids", "vectors"])

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                ids.append(part.column("id").to_numpy())
                rows.append(_matrix(part.column("v"), width))
                if sum(map(len, ids)) >= size:
                    yield block()
                    ids, rows = [], []
        if ids:
            yield block()

    return run


_BLOCK_COLUMNS = "block long, norm double, ids binary, vectors binary"


def _bytes(m: np.ndarray) -> bytes:
    """Whole numbers as 32-bit ones, or as doubles where one is larger."""
    return (m.astype(np.int32) if np.abs(m).max(initial=0) < 2.0**31 else m).tobytes()


def _read(ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, np.int64)
    kind = np.int32 if len(vectors) == 4 * len(numbers) * width else np.float64
    return numbers, np.frombuffer(vectors, kind).reshape(-1, width).astype(np.float64)


def _scores(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``v`` with ``q``, whole numbers in doubles, as longs; larger ones as the largest."""
    bound = float(np.sqrt((v * v).sum(axis=1).max(initial=0)) * np.sqrt((q * q).sum()))
    if bound < EXACT:
        return (v @ q).astype(np.int64)
    if not np.isfinite(bound) or bound >= 2.0**62 or max(np.abs(v).max(initial=0), np.abs(q).max(initial=0)) >= 2.0**62:
        whole = [int(y) for y in q]
        return np.array([min(_MOST, max(_LEAST, sum(int(x) * y for x, y in zip(row, whole, strict=True)))) for row in v.tolist()], dtype=np.int64)
    return v.astype(np.int64) @ q.astype(np.int64)


def best_of_block(q_ids, q, v_ids, v, rotation, least, k):
    """(query, id, score) rows: each query's k best of the block that reach its ``least`` score."""
    head = min(HEAD, rotation.shape[1])
    largest = max(np.abs(q).max(initial=1), np.abs(v).max(initial=1))
    if largest > 1e100:  # squares stay finite
        every = np.ones(len(v_ids), dtype=bool)
        return _best([(query, row, every & (v_ids != query)) for row, query in enumerate(q_ids)], q, v_ids, v, least, k)
    rq, rv = q @ rotation, v @ rotation
    rest_q = np.sqrt((rq[:, head:] ** 2).sum(axis=1))
    rest_v = np.sqrt((rv[:, head:] ** 2).sum(axis=1))
    bound = rq[:, :head] @ rv[:, :head].T + rest_q[:, None] * rest_v[None, :]
    bound += 1e-9 * (1 + np.sqrt((rq**2).sum(axis=1))[:, None] * np.sqrt((rv**2).sum(axis=1))[None, :])  # rounding
    return _best([(query, row, (bound[row] >= least[row]) & (v_ids != query)) for row, query in enumerate(q_ids)], q, v_ids, v, least, k)


def _best(candidates, q, v_ids, v, least, k):
    out = []
    for query, row, open_ in candidates:
        at = np.flatnonzero(open_)
        if not len(at):
            continue
        score = _scores(v[at], q[row])
        keep = np.lexsort((v_ids[at], ~score))[:k]  # ~ reverses the order of all longs
        keep = keep[score[keep] >= least[row]]
        out.append((np.full(len(keep), query), v_ids[at][keep], score[keep]))
    return tuple(np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else ((), (), ())))


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, id, score): each query's ``k`` highest integer inner products with all other vectors.

    Rows whose id is null, or whose vector is null or holds a null or a
    component that isn't finite, take no part. Components of any other size
    are exact; a score beyond the longs is given as the nearest one. Shorter
    vectors are filled up with zeros. Of rows with one id the greatest vector counts. A query
    with fewer than ``k`` others gets them all; no query, no other vector
    or only vectors without components: no rows. Other columns play no part.
    """
    usable = (vectors.where(F.col(id_col).isNotNull() & _valid(F.col(vector_col)))
              .select(F.col(id_col).cast("long").alias("id"), is_query.alias("q"), _scaled(F.col(vector_col), scale).alias("v"))
              .groupBy("id", "q").agg(F.max("v").alias("v")))
    usable = saved(usable.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
    facts = usable.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    if not facts["n"] or not facts["width"]:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    width = facts["width"]
    moments = _second_moments(usable, width)
    values, basis = np.linalg.eigh(moments if np.isfinite(moments).all() else np.eye(width))
    rotation = basis[:, np.argsort(-values)]

    parts = max(1, -(-facts["n"] // BLOCK))
    blocks = saved(usable.repartitionByRange(parts, F.desc("norm2"), F.xxhash64("id")).sortWithinPartitions(F.desc("norm2"))
                   .select("id", "v").mapInArrow(_to_blocks(width, BLOCK), _BLOCK_COLUMNS))
    query_parts = max(1, -(-facts["n"] // (100 * QUERY_BLOCK)))
    queries = (usable.where("q").repartition(query_parts, F.xxhash64("id")).select("id", "v")
               .mapInArrow(_to_blocks(width, QUERY_BLOCK), _BLOCK_COLUMNS)
               .toDF("q_block", "q_norm", "q_ids", "q_vectors"))

    def first_thresholds(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q = _read(row["q_ids"], row["q_vectors"], width)
                v_ids, v = _read(row["ids"], row["vectors"], width)
                query, _, score = best_of_block(q_ids, q, v_ids, v, rotation, np.full(len(q_ids), -np.inf), k)
                least = np.full(len(q_ids), -np.inf)
                order = {int(x): n for n, x in enumerate(q_ids)}
                for x in np.unique(query):
                    own = score[query == x]
                    if len(own) >= k:
                        least[order[int(x)]] = np.nextafter(float(own.min()), -np.inf)  # long to double may round up
                yield pa.RecordBatch.from_pylist([{"q_block": row["q_block"], "q_norm": row["q_norm"], "q_ids": row["q_ids"],
                                                   "q_vectors": row["q_vectors"], "least": least.tobytes(),
                                                   "lowest": float(least.min())}], schema=seeded_schema)

    seeded_schema = pa.schema([("q_block", pa.int64()), ("q_norm", pa.float64()), ("q_ids", pa.binary()),
                               ("q_vectors", pa.binary()), ("least", pa.binary()), ("lowest", pa.float64())])
    longest = blocks.orderBy(F.desc("norm"), "block").limit(1).select("ids", "vectors")
    seeded = saved(queries.join(longest, F.lit(True)).mapInArrow(
        first_thresholds, "q_block long, q_norm double, q_ids binary, q_vectors binary, least binary, lowest double"))

    def compare(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q = _read(row["q_ids"], row["q_vectors"], width)
                v_ids, v = _read(row["ids"], row["vectors"], width)
                query, ids, score = best_of_block(q_ids, q, v_ids, v, rotation, np.frombuffer(row["least"]), k)
                yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(ids, pa.int64()),
                                                  pa.array(score, pa.int64())], names=["query_id", "id", "score"])

    # blocks of the stated queries with blocks of vectors: by number first, then with their data
    near = (seeded.select("q_block", "q_norm", "lowest").join(
        blocks.select("block", "norm"), F.col("q_norm") * F.col("norm") * (1 + 1e-9) + 1 >= F.col("lowest"))
        .select("q_block", "block"))
    pairs = near.join(seeded.drop("q_norm", "lowest"), "q_block").join(blocks.drop("norm"), "block")
    pairs = pairs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "q_block", "block")
    found = pairs.select("q_ids", "q_vectors", "least", "ids", "vectors").mapInArrow(
        compare, "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op7_top_k(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    out = top_k(spark, vectors, F.col("vec_id") % 100 == 0)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
