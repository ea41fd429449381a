"""Language-model scores from a weighted backoff automaton of smoothed bigrams.

The automaton has a root and a state for each token. From the state of u an
arc reads w if the training text has "u w"; its weight is the log-probability

    p(w | u) = MIX * c(u w) / c(u) + (1 - MIX) * p(w).

Any other token takes the failure arc to the root, of weight 1 - MIX, and is
read there with weight p(w); either way the state of w is next. At the root
known tokens have p(w) = (c(w) - D) / N, and what the discount D saves, D * V / N,
is for a token that training lacks, after which the traversal is at the root
(so it reads the next token without failing first). D is n1 / (n1 + 2 n2),
from the numbers of tokens seen once and twice. Each distribution sums to one
over the V known tokens and the unknown one.

Training counts come from all training texts, and no task holds them whole:

1. Rows are dealt into chunks. A task sends every hash bucket its chunk's
   distinct tokens and bigrams of that bucket, with their training counts.
2. A bucket adds the counts up and answers each chunk with the totals of the
   tokens and bigrams it sent, and with the bucket's share of N, V, n1, n2.
3. The chunk's texts meet the answers: exactly the arcs they can use. Each
   text is traversed from left to right.

A frequent token is sent once a chunk, so no bucket depends on how often it
occurs. Tokens are known by 64-bit hashes, the same for different ones with
probability 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfwise.llm.words import mix, utf8, word_hashes

#: Share of the bigram estimate where a token's state is known.
MIX = 0.5

_CHUNK, _BUCKET, _TRAIN = "__chunk", "__bucket", "__train"
_END, _START = np.uint64(0x656E64), np.uint64(0x7374617274)
_NEW = [T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType())]


def _tokens(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' tokens with one end each, the token before each one, and where each text's begin."""
    words, bounds = word_hashes(*utf8(column), fold=True)
    rows = len(bounds) - 1
    starts = bounds + np.arange(rows + 1)
    tokens = np.empty(len(words) + rows, dtype=np.uint64)
    ends = starts[1:] - 1
    inside = np.ones(len(tokens), dtype=bool)
    inside[ends] = False
    tokens[inside] = words
    tokens[ends] = _END
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts[:-1]] = _START
    return tokens, before, starts


def _bigrams(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(tokens))


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte of equal place, which compresses well where they are small."""
    size = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, size).T).tobytes()


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def _packed_rising(values: np.ndarray) -> bytes:
    return _packed(np.diff(values, prepend=np.zeros(1, dtype=np.uint64)))


def _unpacked_rising(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64)


def _edges(rising: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's share of rising hashes begins: buckets are equal ranges of hashes."""
    step = 2**64 // buckets + 1
    return np.searchsorted(rising, np.array([min(b * step, 2**64 - 1) for b in range(buckets)] , dtype=np.uint64)).tolist() + [len(rising)]


def _ask(text: str, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        tokens, before, starts = _tokens(table.column(text))
        train = np.repeat(table.column(_TRAIN).to_numpy(), np.diff(starts))
        out = []
        for values in (tokens, _bigrams(before, tokens)):
            distinct, back = np.unique(values, return_inverse=True)
            count = np.bincount(back, weights=train, minlength=len(distinct)).astype(np.uint32)
            edge = _edges(distinct, buckets)
            out.append([_packed_rising(distinct[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)])
            out.append([_packed(count[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)])
        chunk = table.column(_CHUNK)[0].as_py()
        return pa.table({_BUCKET: pa.array(range(buckets), pa.int32()), _CHUNK: pa.array([chunk] * buckets, pa.int32()),
                         "tokens": pa.array(out[0], pa.binary()), "token_counts": pa.array(out[1], pa.binary()),
                         "bigrams": pa.array(out[2], pa.binary()), "bigram_counts": pa.array(out[3], pa.binary())})

    return run


def _answer(table: pa.Table) -> pa.Table:
    def totals(names: str, counts: str) -> tuple[list[bytes], np.ndarray]:
        asked = [_unpacked_rising(x.as_py()) for x in table.column(names)]
        distinct, back = np.unique(np.concatenate(asked), return_inverse=True)
        sent = np.concatenate([_unpacked(x.as_py(), np.uint32) for x in table.column(counts)])
        total = np.bincount(back, weights=sent, minlength=len(distinct)).astype(np.uint64)
        edge = np.cumsum([0, *map(len, asked)])
        return [_packed(total[back[a:b]]) for a, b in zip(edge[:-1], edge[1:], strict=True)], total

    tokens, total = totals("tokens", "token_counts")
    bigrams, _ = totals("bigrams", "bigram_counts")
    known = [int(total.sum()), int((total > 0).sum()), int((total == 1).sum()), int((total == 2).sum())]
    rows = len(tokens)
    return pa.table({_CHUNK: table.column(_CHUNK).combine_chunks(), "bucket": table.column(_BUCKET).combine_chunks(),
                     "tokens": pa.array(tokens, pa.binary()), "bigrams": pa.array(bigrams, pa.binary()),
                     "known": pa.array([known] * rows, pa.list_(pa.int64()))})


def discount(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once and twice else 0.5


def _score(text: str, names: list[str], mixed: float):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("bucket")
        number, distinct, once, twice = (int(x) for x in np.array(answers.column("known").to_pylist()).sum(axis=0))
        tokens, before, starts = _tokens(table.column(text))
        every, place = np.unique(tokens, return_inverse=True)
        count = np.concatenate([_unpacked(x, np.uint64) for x in answers.column("tokens").to_pylist()]).astype(np.float64)
        _, arc = np.unique(_bigrams(before, tokens), return_inverse=True)
        both = np.concatenate([_unpacked(x, np.uint64) for x in answers.column("bigrams").to_pylist()]).astype(np.float64)[arc]
        own = count[place]
        base = np.log10((own + 1) / (number + distinct + 1))
        if number:
            saved = discount(once, twice)
            root = np.where(own > 0, own - saved, saved * distinct) / number
        else:
            root = np.ones(len(own))
        state = np.empty_like(own)  # c(u) of the state each token is read in; 0 is the root
        state[1:] = own[:-1]
        state[starts[:-1]] = own[starts[1:] - 1]  # the start of a text was seen as often as the end
        bigram = np.where(state > 0, mixed * both / np.maximum(state, 1) + (1 - mixed) * root, root)
        weight = np.log10(bigram)
        ends = starts[:-1]
        out = {name: table.column(name) for name in names}
        out["n_tokens"] = pa.array(np.diff(starts), pa.int64())
        out["n_known"] = pa.array(np.add.reduceat((own > 0).astype(np.int64), ends), pa.int64())
        out["train_tokens"] = pa.array(np.full(len(ends), number), pa.int64())
        out["base_score"] = pa.array(np.add.reduceat(base, ends), pa.float64())
        out["score"] = pa.array(np.add.reduceat(weight, ends), pa.float64())
        return pa.table(out)

    return run


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                mixed: float = MIX) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score (log10 of the texts' probability).

    Tokens are words between ASCII white space with A-Z lower-cased, and one
    end a text. The model is trained on the rows for which ``train`` is true
    (null is false); ``base_score`` is the add-one unigram score.

    Null and empty texts are one end token. Without training rows every
    token is unknown and has probability one. Repeated rows are scored
    alike and count each. Any id is allowed, null included. Columns of
    ``docs`` with one of the new names are replaced, all others kept. An
    empty table gives an empty table.
    """
    number = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    new = [f.name for f in _NEW]
    names = [c for c in docs.columns if c not in new]
    key = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(9))
    chunked = (docs.withColumn(_TRAIN, F.coalesce(train, F.lit(False))).select(*names, _TRAIN)
               .withColumn(_CHUNK, F.pmod(key, F.lit(number)).cast("int")).repartition(number, _CHUNK))
    asked = chunked.groupBy(_CHUNK).applyInArrow(
        _ask(text_col, number), f"{_BUCKET} int, {_CHUNK} int, tokens binary, token_counts binary, "
                                "bigrams binary, bigram_counts binary")
    answers = asked.groupBy(_BUCKET).applyInArrow(
        _answer, f"{_CHUNK} int, bucket int, tokens binary, bigrams binary, known array<long>")
    schema = T.StructType([docs.schema[c] for c in names] + _NEW)
    return chunked.groupBy(_CHUNK).cogroup(answers.groupBy(_CHUNK)).applyInArrow(_score(text_col, names, mixed), schema)


def op9_language_model(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    out = score_texts(docs, ~held)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
