"""Substring de-duplication: remove words of passages that occur elsewhere too.

Method: Rabin-Karp hashes of every window of ``window`` words are counted
over the whole corpus; the windows counted twice or more are merged into
maximal intervals, which go.

As a Spark job, in two shuffles that move each text and each hash once:

1. Rows are dealt into chunks by a hash of id and text. A task hashes all
   windows of its chunk and writes, for each hash bucket, one row with the
   chunk's 8-byte hashes of that bucket. A hash that occurs several times
   in the chunk is already known to repeat; it is sent once (and counts
   double), so a passage that a third of the corpus holds reaches a bucket
   once a chunk, not once a document.
2. A bucket counts its hashes and answers every chunk with one bit a hash.
3. The chunk's rows meet their bits; windows flagged by either side cover
   the words to remove.

Chunks and buckets number ``groups`` a shuffle partition, so their size
follows ``spark.sql.shuffle.partitions``, never the corpus.

Two different windows share a hash with probability 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfwise.llm.words import utf8, window_hashes, window_starts, word_hashes, word_spans

WINDOW = 35
GROUPS = 2

_CHUNK, _BUCKET, _KEY = "__chunk", "__bucket", "__row_key"


def _in_order(table: pa.Table) -> pa.Table:
    """Rows by key: the same order in both passes. Rows of one key are alike."""
    return table.take(pa.array(np.argsort(table.column(_KEY).to_numpy(), kind="stable")))


def _windows(texts: pa.ChunkedArray, window: int, buckets: int):
    """Hashes of a chunk's windows, where they start, their buckets, which are known to repeat."""
    words, bounds = word_hashes(*utf8(texts))
    starts = window_starts(bounds, window)
    hashes = window_hashes(words, window)[starts] if len(starts) else np.zeros(0, dtype=np.uint64)
    order = np.argsort(hashes)
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(hashes), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    alone = np.flatnonzero(~twice)
    alone = alone[np.argsort(bucket[alone], kind="stable")]
    return bounds, starts, hashes, bucket, twice, alone


def _hash_chunk(text: str, window: int, buckets: int):
    schema = pa.schema([(_BUCKET, pa.int32()), (_CHUNK, pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        chunk = table.column(_CHUNK)[0].as_py()
        _, _, hashes, bucket, twice, alone = _windows(_in_order(table).column(text), window, buckets)
        repeated = np.unique(hashes[twice])
        of = ((repeated >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        edge = np.arange(buckets + 1)
        one, two = np.searchsorted(bucket[alone], edge), np.searchsorted(of, edge)
        single = hashes[alone]
        used = np.flatnonzero((np.diff(one) > 0) | (np.diff(two) > 0))
        return pa.Table.from_arrays([
            pa.array(used, pa.int32()),
            pa.array(np.full(len(used), chunk), pa.int32()),
            pa.array([single[one[b]:one[b + 1]].tobytes() for b in used], pa.binary()),
            pa.array([repeated[two[b]:two[b + 1]].tobytes() for b in used], pa.binary()),
        ], schema=schema)

    return run


def _count_bucket(table: pa.Table) -> pa.Table:
    """One answer a chunk: a bit for each hash it sent, set where the corpus has another."""
    once = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("once")]
    twice = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("twice")]
    ranked = np.sort(np.concatenate([*once, *twice, *twice]))
    repeated = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])

    def bits(hashes: np.ndarray) -> bytes:
        if not len(repeated):
            return np.packbits(np.zeros(len(hashes), dtype=bool)).tobytes()
        at = np.minimum(np.searchsorted(repeated, hashes), len(repeated) - 1)
        return np.packbits(repeated[at] == hashes).tobytes()

    return pa.Table.from_arrays(
        [table.column(_CHUNK).combine_chunks(), table.column(_BUCKET).combine_chunks(),
         pa.array([bits(x) for x in once], pa.binary())],
        names=[_CHUNK, "bucket", "bits"])


def _remove(text: str, window: int, buckets: int, names: list[str]):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = _in_order(table)
        column = table.column(text)
        bounds, starts, hashes, bucket, flagged, alone = _windows(column, window, buckets)
        size = np.bincount(bucket[alone], minlength=buckets)
        edge = np.concatenate([[0], np.cumsum(size)])
        for b, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True):
            own = alone[edge[b]:edge[b + 1]]
            flagged[own] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=len(own)).astype(bool)
        depth = np.zeros(int(bounds[-1]) + 1, dtype=np.int64)  # windows that cover each word
        np.add.at(depth, starts[flagged], 1)
        np.add.at(depth, starts[flagged] + window, -1)
        gone = np.cumsum(depth[:-1]) > 0
        offsets, data = utf8(column)
        first, last, _ = word_spans(offsets, data)
        whole, kept = memoryview(np.ascontiguousarray(data)), []
        for row in range(len(table)):
            span = slice(bounds[row], bounds[row + 1])
            stay = ~gone[span]
            kept.append(b" ".join(
                bytes(whole[a:b]) for a, b in zip(first[span][stay].tolist(), last[span][stay].tolist(), strict=True)).decode())
        total = np.concatenate([[0], np.cumsum(gone)])
        out = {name: table.column(name) for name in names}
        out["n_words"] = pa.array(np.diff(bounds), pa.int64())
        out["n_removed"] = pa.array(total[bounds[1:]] - total[bounds[:-1]], pa.int64())
        out["kept_text"] = pa.array(kept, pa.string())
        return pa.table(out)

    return run


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                             window: int = WINDOW, groups: int = GROUPS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (kept words, one space between).

    A word goes if a window of ``window`` words that covers it also starts
    anywhere else, in the same document or another; windows are judged on
    the texts as they come in.

    Null or empty text: no words, nothing removed, empty ``kept_text``. A
    text of fewer words than the window is kept whole. Repeated rows (the
    same id and text) count as separate documents, so their windows repeat.
    Any id, null included, is allowed. Columns of ``docs`` that have one of
    the three new names are replaced; all others are kept. An empty table
    gives an empty table.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = parts * groups
    new = ["n_words", "n_removed", "kept_text"]
    names = [c for c in docs.columns if c not in new]
    key: Column = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(1))
    chunked = (docs.select(*names)
               .withColumn(_KEY, F.xxhash64(F.col(id_col), F.col(text_col)))
               .withColumn(_CHUNK, F.pmod(key, F.lit(number)).cast("int"))
               .repartition(parts, _CHUNK))
    hashes = (chunked.groupBy(_CHUNK).applyInArrow(
        _hash_chunk(text_col, window, number),
        f"{_BUCKET} int, {_CHUNK} int, once binary, twice binary"))
    answers = hashes.groupBy(_BUCKET).applyInArrow(_count_bucket, f"{_CHUNK} int, bucket int, bits binary")
    schema = T.StructType([docs.schema[c] for c in names]
                          + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                             T.StructField("kept_text", T.StringType())])
    return (chunked.groupBy(_CHUNK).cogroup(answers.groupBy(_CHUNK))
            .applyInArrow(_remove(text_col, window, number, names), schema))


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = remove_repeated_passages(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS word,
         generate_subscripts(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), 1) AS pos
  FROM documents),
d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, s AS pos, array_to_string(words[s:s + 34], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 34)) AS s FROM d WHERE len(words) >= 35)),
repeated AS (SELECT gram FROM windows GROUP BY gram HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + 34)) AS pos
  FROM windows WHERE gram IN (SELECT gram FROM repeated)),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.pos) AS txt
  FROM w ANTI JOIN gone ON w.doc_id = gone.doc_id AND w.pos = gone.pos GROUP BY w.doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.txt, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN removed ON d.doc_id = removed.doc_id
"""
