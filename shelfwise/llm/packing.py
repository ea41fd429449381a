"""Packing documents into training sequences: exact complements first, best fit for the rest.

A document becomes its token ids and an end id. Documents longer than a
sequence are cut into whole sequences; the first piece takes the remainder.
Pieces then only matter by their length, of which there are ``SIZE``, so the
plan is made on the counts of each length (one small aggregate, whatever the
corpus):

1. Exact complements: sums of one, two and three lengths are indexed by
   hash. Lengths are taken from the longest down; each looks up the gap it
   leaves, and a combination that fills it exactly is used as often as the
   counts of its lengths allow.
2. What is left is packed best fit, longest first: into the open sequence
   whose gap is smallest, many equal pieces and sequences at a time.

The plan is a list of patterns (lengths in order, how many sequences).
Spark then numbers the pieces of each length and deals them to the places
that the patterns have for it.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.graph import saved
from shelfwise.llm.words import WHITE_SPACE, given_back, slices, span_hashes, utf8

SIZE = 1024
END_ID = 2
#: Word units whose ids a task remembers.
CACHE_UNITS = 400_000
#: Bytes of text encoded at once.
SLICE = 1 << 20
#: Parts in which the pieces of each length are numbered.
PARTS = 64

#: White space beyond that of words; near it, units are not looked at one by one.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

_SPACES = " \t\n\x0b\x0c\r"

_encoders: dict[str, "UnitEncoder"] = {}


def _byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class UnitEncoder:
    """Ids of whole texts with a byte-level BPE vocabulary file, word unit by word unit.

    A unit is a run of white space and the word after it. The vocabulary's
    pattern never lets a token reach over a border between units, so a
    text's ids are its units' ids. Each distinct unit of a batch is encoded
    once, and the ids of ``CACHE_UNITS`` units are kept between a task's batches.
    Units don't hold in texts that are ``apart``, which ``encode_whole`` takes.
    """

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            contents = json.load(file)
        model, added = contents["model"], [t["content"] for t in contents.get("added_tokens") or []]
        self._path, self._tokenizer = path, None
        self._added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        byte = _byte_of_character()
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()
                 if all(c in byte for c in token) and i < len(model["merges"]) + 256}
        self._encoding = tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self._bytes[i] = len(token)
        self.forget()

    def forget(self) -> None:
        self._hashes = np.zeros(0, dtype=np.uint64)
        self._starts = np.zeros(1, dtype=np.int64)
        self._ids = np.zeros(0, dtype=np.uint32)

    def _learn(self, hashes: np.ndarray, units: list[str]) -> None:
        """Add units, none known yet."""
        ids, sizes = self._encode_units(units)
        order = np.argsort(np.concatenate([self._hashes, hashes]), kind="stable")
        lengths = np.concatenate([np.diff(self._starts), sizes])
        starts = np.concatenate([self._starts[:-1], len(self._ids) + np.cumsum(sizes) - sizes])
        every = np.concatenate([self._ids, ids])
        self._hashes = np.concatenate([self._hashes, hashes])[order]
        self._ids = every[_ranges(starts[order], lengths[order])]
        self._starts = np.concatenate([[0], np.cumsum(lengths[order])])

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units in a row, and how many each has.

        Units that begin with white space and end with a word can follow one
        another in one text; where each ends, the lengths of its tokens tell.
        """
        together = [k for k, u in enumerate(units) if u[0] in _SPACES and u[-1] not in _SPACES and not _ODD_SPACE.search(u)]
        ids = self._encoding.encode_to_numpy("".join([units[k] for k in together])) if together else np.zeros(0, np.uint32)
        ends = np.cumsum([len(units[k].encode()) for k in together], dtype=np.int64)
        last = np.searchsorted(np.cumsum(self._bytes[ids]), ends) + 1 if together else np.zeros(0, np.int64)
        sizes = np.zeros(len(units), dtype=np.int64)
        sizes[together] = np.diff(last, prepend=0)
        alone = sorted(set(range(len(units))) - set(together))
        if not alone:
            return ids, sizes
        lists = [self._encoding.encode_ordinary(units[k]) for k in alone]
        sizes[alone] = [len(x) for x in lists]
        every = np.concatenate([ids, np.array([i for x in lists for i in x], dtype=np.uint32)])
        began = np.zeros(len(units), dtype=np.int64)
        placed = np.concatenate([together, alone]).astype(np.int64)
        began[placed] = np.cumsum(sizes[placed]) - sizes[placed]
        return every[_ranges(began, sizes)], sizes

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin."""
        space = WHITE_SPACE[data]
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[1:-1] = space[1:] & ~space[:-1]
        begins[offsets[:-1]] = True
        begins = begins[:-1]
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        hashes = span_hashes(data, starts, ends)
        back, distinct = pd.factorize(hashes)
        first = np.empty(len(distinct), dtype=np.int64)
        first[back[::-1]] = np.arange(len(back) - 1, -1, -1)
        if len(self._hashes) > CACHE_UNITS:
            self.forget()
        at = np.searchsorted(self._hashes, distinct)
        new = np.ones(len(distinct), dtype=bool)
        if len(self._hashes):
            new = self._hashes[np.minimum(at, len(self._hashes) - 1)] != distinct
        if new.any():
            whole = data.tobytes()
            own = first[new]
            self._learn(distinct[new], [whole[a:b].decode() for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True)])
            at = np.searchsorted(self._hashes, distinct)
        place = at[back]
        sizes = np.diff(self._starts)[place]
        ids = self._ids[_ranges(self._starts[:-1][place], sizes)]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, total[np.searchsorted(starts, offsets)]

    def apart(self, text: str) -> bool:
        """Whether a text has odd white space or one of the file's added tokens."""
        return bool(_ODD_SPACE.search(text) or self._added.search(text))

    def encode_whole(self, text: str) -> list[int]:
        if self._added.search(text):
            if self._tokenizer is None:
                from tokenizers import Tokenizer

                self._tokenizer = Tokenizer.from_file(self._path)
            return self._tokenizer.encode(text, add_special_tokens=False).ids
        return self._encoding.encode_ordinary(text)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + size) in a row."""
    total = int(sizes.sum())
    before = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.arange(total) + np.repeat(starts - before, sizes)


def _pieces(tokenizer: str, size: int, end_id: int):
    def run(batches):
        encoder = _encoders.get(tokenizer)
        if encoder is None:
            encoder = _encoders.setdefault(tokenizer, UnitEncoder(tokenizer))
        yield from given_back(encoded(encoder, batches))

    def encoded(encoder, batches):
        encoder.forget()  # units of an earlier task
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            for a, b in slices(offsets, SLICE):
                own, texts = offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]]
                ids, bounds = encoder.encode(own, texts)
                whole = texts.tobytes()
                if encoder.apart(whole.decode()):
                    lists = [np.array(encoder.encode_whole(t), dtype=np.uint32) if encoder.apart(t) else ids[x:y]
                             for t, x, y in zip((whole[x:y].decode() for x, y in zip(own[:-1].tolist(), own[1:].tolist(), strict=True)),
                                                bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                    ids = np.concatenate(lists)
                    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
                row, piece, start, length, crc = [], [], [], [], []
                for k in range(b - a):
                    doc = np.append(ids[bounds[k]:bounds[k + 1]], np.uint32(end_id)).astype("<u4")
                    at, number = 0, 0
                    while at < len(doc):
                        upto = at + ((len(doc) - 1) % size + 1 if at == 0 else size)
                        row.append(a + k)
                        piece.append(number)
                        start.append(at)
                        length.append(upto - at)
                        crc.append(zlib.crc32(doc[at:upto].tobytes()))
                        at, number = upto, number + 1
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(take), batch.column("key").take(take), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ], names=["id", "key", "piece", "start", "length", "ids_crc32"])
        encoder.forget()

    return run


def packing_plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence in order, number of such sequences) that use up all ``counts``."""
    left = {n: c for n, c in counts.items() if c > 0}
    plan: list[tuple[tuple[int, ...], int]] = []
    # a gap is filled by one, two or three shorter pieces: single lengths and pairs are indexed
    # by their sum, and a triple is a length with a pair that fills what it leaves
    by_sum: dict[int, list[tuple[int, ...]]] = defaultdict(list)
    lengths = sorted(left, reverse=True)
    for i, x in enumerate(lengths):
        by_sum[x].append((x,))
        for y in lengths[i:]:
            if x + y < size:
                by_sum[x + y].append((x, y))

    def use(parts: tuple[int, ...]) -> None:
        need = Counter(parts)
        times = min(left.get(n, 0) // k for n, k in need.items())
        if times:
            plan.append((parts, times))
            for n, k in need.items():
                left[n] -= k * times

    for n in lengths:
        gap = size - n
        if gap == 0:
            use((n,))
            continue
        for kept in by_sum.get(gap, ()):
            if not left[n]:
                break
            use((n, *kept))
        for x in lengths:  # triples: x and a pair that fills the rest
            if not left[n]:
                break
            if x >= gap or not left[x]:
                continue
            for pair in by_sum.get(gap - x, ()):
                if len(pair) == 2 and x >= pair[0]:
                    use((n, x, *pair))
                    if not left[n] or not left[x]:
                        break
    # best fit, longest first; open: gap -> patterns with that gap and how many
    open_: dict[int, list[list]] = defaultdict(list)
    for n in lengths:
        many = left[n]
        while many:
            gap = min((g for g, found in open_.items() if g >= n and found), default=None)
            if gap is None:
                fit = size // n  # a new sequence takes as many equal pieces as fit
                full, rest = divmod(many, fit)
                if full:
                    open_[size - fit * n].append([(n,) * fit, full])
                if rest:
                    open_[size - rest * n].append([(n,) * rest, 1])
                many = 0
                continue
            parts, times = open_[gap].pop()
            used = min(times, many)
            if times > used:
                open_[gap].append([parts, times - used])
            open_[gap - n].append([(*parts, n), used])
            many -= used
    plan += [(tuple(parts), times) for found in open_.values() for parts, times in found]
    return plan


def _places(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, first sequence, per sequence, offset of the first): which numbered pieces go where."""
    taken: Counter[int] = Counter()
    sequence, rows = 0, []
    for parts, times in plan:
        offset = 0
        for n, k in sorted(Counter(parts).items(), reverse=True):
            rows.append((n, taken[n], taken[n] + k * times - 1, sequence, k, offset))
            taken[n] += k * times
            offset += n * k
        sequence += times
    return rows


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """(``id_col``, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    Null and empty texts are one piece that holds only the end id. Repeated
    rows are packed each on its own. Any id is allowed, null included. Other
    columns of ``docs`` play no part. An empty table gives an empty table.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    pieces = saved(rows.mapInArrow(_pieces(tokenizer, size, end_id),
                                   "id %s, key long, piece int, start long, length long, ids_crc32 long" % id_type)
                   .withColumn("part", F.pmod(F.xxhash64("key", "piece"), F.lit(PARTS)).cast("int")))
    counts = saved(pieces.groupBy("length", "part").agg(F.count("*").alias("n")))
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # ``size`` rows at most
    places = docs.sparkSession.createDataFrame(
        _places(packing_plan(total, size)), "length long, first long, last long, sequence long, per long, at long")
    before = counts.select("length", "part", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("length", "part").orderBy("key", "piece")) - 1
    numbered = (pieces.withColumn("number", number).join(before, ["length", "part"])
                .withColumn("number", F.col("number") + F.col("before")))
    # the plan has a few rows a length, whatever the number of pieces
    placed = numbered.join(F.broadcast(places), "length").where(F.col("number").between(F.col("first"), F.col("last")))
    rank = F.col("number") - F.col("first")
    return placed.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
                         (F.col("sequence") + F.floor(rank / F.col("per"))).alias("sequence_id"),
                         (F.col("at") + rank % F.col("per") * F.col("length")).alias("offset"))


def op10_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
