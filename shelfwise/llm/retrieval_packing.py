"""Packing related documents together: a sharded BM25 index gives each seed its unused neighbours.

1. Texts are tokenised in tasks. A document's whole sequences are cut off
   from its front; what is left, less than a sequence, is its piece. Token
   ids are the terms of the index: their document frequencies, over all whole
   texts, are counted on the way (one row a task, a number a vocabulary id).
2. Pieces are put in a lexical order: by their most telling terms, the
   ``TELLING`` rarest that another document has as well, the most frequent of
   these first. Range partitions of that order are read as shards of
   ``SHARD`` pieces. The last key is the row itself, so that copies and pieces
   of one term, however many, go on over shards and tasks.
3. A shard is an inverted index of its pieces with BM25 weights from the
   statistics of the whole corpus. The first unused piece is the seed of a
   window; the index returns the unused pieces by their score for the seed's
   ``QUERY_TERMS`` heaviest terms, and they fill the window in that order. The
   one that reaches over the end is cut there, and its rest is the next
   window's seed. When nothing unused is related, the shard's next piece
   follows.
4. A shard's last window is cut into powers of two, which need no padding.

Every sequence so has exactly ``size`` tokens or a power of two of them.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelfwise.llm.graph import saved
from shelfwise.llm.packing import _byte_of_character as byte_of_character, _ranges as ranges
from shelfwise.llm.tables import written
from shelfwise.llm.words import given_back, slices, utf8

SIZE = 2048
END_ID = 1
#: Pieces in a shard, about; a shard is held by one task.
SHARD = 4096
#: Rarest terms of a piece that make its place in the order; three of them are its keys.
TELLING, KEYS = 8, 3
#: Terms of a seed that are looked up, heaviest first.
QUERY_TERMS = 8
#: BM25's saturation and length parameters.
K1, B = 1.2, 0.75
#: Words that are not plain whose ids a Python worker remembers, and words or parts encoded at once.
KNOWN_WORDS, TOGETHER = 1_000_000, 2000
#: Bytes of text looked at together: each word and part of a word is looked at once in them.
SLICE = 16 << 20

#: Ends a part of a word in the faster engine; a byte that plain words don't have.
_MARK = b"\x01"
#: Words whose normal form is their lower case, one character for one: ASCII, and Latin letters with their accents.
_PLAIN = "^[!-~\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u0148\u014a-\u017e]*$"
#: How a tokenizer file cuts words into parts if ``part_starts`` may do it.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Kinds of bytes in lower-case plain words: signs, letters, digits.
_SIGN, _LETTER, _DIGIT = range(3)
_KIND = np.full(256, _SIGN, dtype=np.uint8)
_KIND[[*range(ord("a"), ord("z") + 1), *range(0x80, 256)]] = _LETTER
_KIND[ord("0"):ord("9") + 1] = _DIGIT

_encoders: dict[str, "WordEncoder"] = {}


def part_starts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Whether a part of a word begins at each byte of lower-case plain words, and at their end, as ``_PARTS`` cuts them."""
    kind = _KIND[data]
    edge = np.zeros(len(data) + 3, dtype=bool)  # where words begin; room to look two bytes ahead
    edge[offsets] = True
    begins = edge[:len(data) + 1].copy()
    begins[1:-1] |= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    # a quote that is the first of its signs, and one of the endings behind it, are one part
    quote = np.flatnonzero((data == ord("'")) & begins[:-1])
    ahead = np.append(data, np.zeros(3, np.uint8))
    one, two = ahead[quote + 1].astype(np.int64), ahead[quote + 2].astype(np.int64)
    short = np.isin(one, [ord(c) for c in "stmd"]) & ~edge[quote + 1]
    long = np.isin(one << 8 | two, [ord(c) << 8 | ord(d) for c, d in ("re", "ve", "ll")]) & ~edge[quote + 1] & ~edge[quote + 2]
    begins[quote[short | long] + 1] = False
    begins[quote[short] + 2] = True
    begins[quote[long] + 3] = True
    return begins


class WordEncoder:
    """Token ids of whole texts, word by word, for a tokenizer file that drops white space.

    The vocabulary's pattern lets no token reach over white space, so a
    text's ids are its words' ids. Words are told apart by their bytes, and
    each is encoded once in the texts that are given together. Words of plain
    Latin letters, digits and signs are lower-cased and cut into parts on
    their bytes, and each different part goes through a faster engine with the
    file's own vocabulary; in it, a mark after a part stands for the file's
    sign of a word's end. All others are encoded by the tokenizer itself,
    several in one text, and remembered; the offsets of tokens tell where each
    begins.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        import tiktoken
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self._tokenizer.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as file:
            contents = json.load(file)
        model, end = contents["model"], contents["model"]["end_of_word_suffix"]
        self._added = [t["content"] for t in contents.get("added_tokens") or []]
        self._cut = contents["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] == _PARTS
        byte = byte_of_character()
        spelled = {}  # bytes, with the mark for a word's end, of each token but the added ones
        for token, i in model["vocab"].items():
            ends = bool(end) and token.endswith(end) and token != end
            body = token[:-len(end)] if ends else token
            if all(c in byte for c in body):
                spelled[bytes(byte[c] for c in body) + (_MARK if ends else b"")] = i
        # single bytes first, then bytes that end a word, then merges in the file's order
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        order = [bytes([b]) for b in range(256)] + [bytes([b]) + _MARK for b in range(256)]
        for token in merged:
            ends = token.endswith(end)
            order.append(bytes(byte[c] for c in (token[:-len(end)] if ends else token)) + (_MARK if ends else b""))
        ranks = {token: r for r, token in enumerate(dict.fromkeys(order))}
        self._engine = tiktoken.Encoding("words", pat_str=f"[^{_MARK.decode()}]+{_MARK.decode()}", mergeable_ranks=ranks, special_tokens={})
        self._id_of_rank = np.array([spelled.get(token, -1) for token in ranks], dtype=np.int64)
        self._ends = np.array([token.endswith(_MARK) for token in ranks])
        self.forget()

    def forget(self) -> None:
        self._number: dict[str, int] = {}
        self._starts, self._ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all plain words in a row, and where each word's begin (one more than words)."""
        offsets, data = utf8(pc.utf8_lower(words))
        begins = part_starts(offsets, data)
        starts = np.flatnonzero(begins)
        parts = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data)).dictionary_encode()
        different = parts.dictionary.to_pylist()
        found = [np.zeros(0, np.uint32)]
        for at in range(0, len(different), TOGETHER):
            found.append(self._engine.encode_to_numpy(_MARK.decode().join([*different[at:at + TOGETHER], ""])))
        ranks = np.concatenate(found)
        ends = np.append(0, np.flatnonzero(self._ends[ranks]) + 1)  # where each part's ids begin
        part = parts.indices.to_numpy()
        sizes = np.diff(ends)[part]
        ids = self._id_of_rank[ranks].astype(np.uint32)[ranges(ends[part], sizes)]
        first = np.cumsum(begins)[offsets] - 1  # the part with which each word begins
        return ids, np.append(0, np.cumsum(sizes))[first]

    def _odd(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all other words in a row, and where each word's begin (one more than words)."""
        if len(self._number) > KNOWN_WORDS:
            self.forget()
        if new := [w for w in words if w not in self._number]:
            starts, ids = [self._starts], [self._ids]
            for at in range(0, len(new), TOGETHER):
                found, ends = self._encode_odd(new[at:at + TOGETHER])
                starts.append(starts[-1][-1] + ends)
                ids.append(found)
            self._number.update(zip(new, range(len(self._number), len(self._number) + len(new)), strict=True))
            self._starts, self._ids = np.concatenate(starts), np.concatenate(ids)
        number = np.fromiter(map(self._number.__getitem__, words), np.int64, len(words))
        sizes = np.diff(self._starts)[number]
        return self._ids[ranges(self._starts[number], sizes)], np.append(0, np.cumsum(sizes))

    def _encode_odd(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        begins = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
        encoded = self._tokenizer.encode(" ".join(words), add_special_tokens=False)
        firsts = np.fromiter((a for a, _ in encoded.offsets), np.int64, len(encoded.ids))
        return np.array(encoded.ids, dtype=np.uint32), np.append(np.searchsorted(firsts, begins[1:]), len(firsts))

    def _is_plain(self, words: pa.Array) -> np.ndarray:
        if not self._cut:
            return np.zeros(len(words), dtype=bool)
        plain = pc.match_substring_regex(words, _PLAIN)
        for token in self._added:
            plain = pc.and_not(plain, pc.match_substring(words, token))
        return plain.to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (one more than texts); null is empty."""
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = lists.flatten().dictionary_encode()
        words, plain = coded.dictionary, self._is_plain(coded.dictionary)
        plain_ids, plain_starts = self._plain(words.filter(pa.array(plain)))
        odd_ids, odd_starts = self._odd(words.filter(pa.array(~plain)).to_pylist())
        # plain words first, then the others
        place = np.empty(len(words), dtype=np.int64)
        place[np.append(np.flatnonzero(plain), np.flatnonzero(~plain))] = np.arange(len(words))
        starts = np.append(plain_starts, len(plain_ids) + odd_starts[1:])
        known = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(np.append(plain_ids, odd_ids)))
        found = known.take(pa.array(place[coded.indices.to_numpy()]))
        begin = found.offsets.to_numpy()
        return found.flatten().to_numpy(), begin[lists.offsets.to_numpy() - lists.offsets[0].as_py()]


def together(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``size`` bytes or more, but the last."""
    def joined(held):
        out = held[0] if len(held) == 1 else pa.concat_batches(held)  # one is not copied
        held.clear()
        return out

    held, held_bytes = [], 0
    for batch in batches:
        held.append(batch)
        held_bytes += batch.nbytes
        if held_bytes >= size:
            yield joined(held)
            held_bytes = 0
    if held:
        yield joined(held)


def _encode(tokenizer: str, size: int, end_id: int, ids_as: str, schema: pa.Schema) -> Callable:
    """Rows of documents, and a last row a task with how many documents have each id."""
    def run(batches):
        encoder = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, WordEncoder(tokenizer))
        yield from given_back(rows(encoder, batches))

    def rows(encoder, batches):
        task = TaskContext.get().partitionId() << 33
        row, whole = task, task
        frequency = np.zeros(max(encoder.vocabulary, end_id + 1), dtype=np.int64)
        seen = np.zeros(len(frequency), dtype=np.int64)
        documents = tokens = 0
        for batch in together(batches, SLICE):
            offsets, _ = utf8(batch.column("text"))
            for first, after in slices(offsets, SLICE):
                part = batch.column("text").slice(first, after - first)
                ids, bounds = encoder.encode(part)
                out = {name: [] for name in ("row", "doc_tokens", "whole", "crcs", "tail")}
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    doc = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                    tail = len(doc) // size * size
                    out["row"].append(row)
                    out["doc_tokens"].append(len(doc))
                    out["whole"].append(whole)
                    out["crcs"].append([zlib.crc32(doc[at:at + size].tobytes()) for at in range(0, tail, size)])
                    out["tail"].append(doc[tail:].astype(ids_as).tobytes())
                    places = np.arange(len(doc))
                    seen[doc] = places  # of equal ids the last one's
                    frequency[doc[seen[doc] == places]] += 1
                    row, whole = row + 1, whole + tail // size
                    tokens += len(doc)
                documents += len(part)
                columns = [batch.column("id").slice(first, len(part)), *(pa.array(out[c], schema.field(c).type) for c in out),
                           *(pa.nulls(len(part), schema.field(c).type) for c in ("frequency", "documents", "tokens"))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        if documents:
            last = {c: pa.nulls(1, schema.field(c).type) for c in schema.names}
            last |= {"frequency": pa.array([frequency.tolist()], pa.list_(pa.int64())), "documents": pa.array([documents], pa.int64()),
                     "tokens": pa.array([tokens], pa.int64())}
            yield pa.RecordBatch.from_arrays([last[c] for c in schema.names], schema=schema)

    return run


def telling_terms(pieces: list[np.ndarray], rank: np.ndarray) -> np.ndarray:
    """Keys of the lexical order, a row a piece: of its ``TELLING`` least ranks the greatest, next and next; -1 for none.

    ``rank`` has the place of each term by document frequency, and the number
    of terms for those that no other document has.
    """
    none = len(rank)
    out = np.full((len(pieces), KEYS), -1, dtype=np.int32)
    for row, piece in enumerate(pieces):
        ranks = rank[piece]
        few = 4 * TELLING
        while True:  # mostly there are enough different ones among the least few
            least = np.unique(np.partition(ranks, few)[:few] if few < len(ranks) else ranks)
            if len(least) >= TELLING or few >= len(ranks):
                break
            few *= 4
        least = least[least < none][:TELLING][::-1][:KEYS]
        out[row, :len(least)] = least
    return out


def _placed(rank: np.ndarray, ids_as: str) -> Callable:
    """Adds the keys of the lexical order."""
    def run(batches):
        for batch in batches:
            keys = telling_terms([np.frombuffer(t, ids_as) for t in batch.column("tail").to_pylist()], rank)
            for k in range(KEYS):
                batch = batch.append_column(f"key{k}", pa.array(keys[:, k], pa.int32()))
            yield batch

    return run


class ShardIndex:
    """An inverted index over a shard's pieces; used ones are left out of answers.

    It holds the terms that any piece asks for. A piece asks for its
    heaviest terms, ties to the smaller id.
    """

    def __init__(self, pieces: list[np.ndarray], idf: np.ndarray, average: float, query_terms: int = QUERY_TERMS) -> None:
        found, self._query = [], []
        for piece in pieces:
            terms, tf = np.unique(piece, return_counts=True)
            weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(piece) / average))
            found.append((terms, weight))
            few = np.argsort(-weight, kind="stable")[:query_terms]
            self._query.append(terms[few[weight[few] > 0]])
        asked = np.zeros(len(idf), dtype=bool)
        asked[np.concatenate(self._query)] = True
        docs, terms, weights = [], [], []
        for doc, (own, weight) in enumerate(found):
            held = asked[own]
            terms.append(own[held])
            weights.append(weight[held])
            docs.append(np.full(len(terms[-1]), doc))
        term = np.concatenate(terms)
        order = np.argsort(term, kind="stable")
        self._docs, self._weights = np.concatenate(docs)[order], np.concatenate(weights)[order]
        self._bounds = np.searchsorted(term[order], np.arange(len(idf) + 1))
        self.unused = np.ones(len(pieces), dtype=bool)

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of every piece for the query of ``seed``; zero once used."""
        out = np.zeros(len(self.unused))
        for term in self._query[seed].tolist():
            a, b = self._bounds[term], self._bounds[term + 1]
            out[self._docs[a:b]] += self._weights[a:b]  # a piece is there once
        return out * self.unused


def windows(lengths: list[int], index: ShardIndex, size: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (piece, start in the piece, tokens), all of ``size`` tokens but the last."""
    out, window, room = [], [], size
    following, rest = 0, None
    unused = index.unused
    left = len(lengths)
    while left or rest:
        if rest:  # what was cut off at the last window's end
            seed, at = rest
            rest = None
        else:
            while not unused[following]:
                following += 1
            seed, at = following, 0
            unused[seed] = False
            left -= 1
        score, piece = None, seed
        while True:
            take = min(room, lengths[piece] - at)
            window.append((piece, at, take))
            room -= take
            if not room:
                out.append(window)
                window, room = [], size
                if at + take < lengths[piece]:
                    rest = (piece, at + take)
                break
            if not left:
                break
            if score is None:
                score = index.scores(seed)
            piece, at = int(score.argmax()), 0
            if not score[piece] > 0:
                break
            score[piece] = 0
            unused[piece] = False
            left -= 1
        # an open window goes on with the shard's next piece as another seed
    if window:
        out.append(window)
    return out


def in_powers_of_two(window: list[tuple[int, int, int]], size: int) -> list[list[tuple[int, int, int]]]:
    """A window cut where that leaves sequences of a power of two tokens; a full one stays."""
    total = sum(n for _, _, n in window)
    if total == size:
        return [window]
    out = []
    todo = list(reversed(window))
    for bit in reversed(range(total.bit_length())):
        room = total & 1 << bit
        own = []
        while room:
            piece, at, n = todo.pop()
            take = min(n, room)
            own.append((piece, at, take))
            room -= take
            if take < n:
                todo.append((piece, at + take, n - take))
        if own:
            out.append(own)
    return out


def _pack_shards(size: int, shard: int, idf: np.ndarray, average: float, ids_as: str, schema: pa.Schema) -> Callable:
    """Pieces of a range of the lexical order, packed ``shard`` by ``shard``."""
    def run(batches):
        yield from given_back(packed(batches))

    def packed(batches):
        sequence, rows, have = TaskContext.get().partitionId() << 40, [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, shard - have)
                rows.append(part)
                at, have = at + part.num_rows, have + part.num_rows
                if have == shard:
                    out, sequence = one(pa.Table.from_batches(rows), sequence)
                    yield out
                    rows, have = [], 0
        if rows:
            yield one(pa.Table.from_batches(rows), sequence)[0]

    def one(table: pa.Table, sequence: int) -> tuple[pa.RecordBatch, int]:
        pieces = [np.frombuffer(t, ids_as).astype("<u4") for t in table.column("tail").to_pylist()]
        before = np.array(table.column("doc_tokens").to_pylist(), dtype=np.int64) - [len(p) for p in pieces]
        found = windows([len(p) for p in pieces], ShardIndex(pieces, idf, average), size)
        found = found[:-1] + in_powers_of_two(found[-1], size)
        out = {name: [] for name in ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")}
        for window in found:
            place = 0
            for p, at, n in window:
                for name, value in zip(out, (p, int(before[p]) + at, n, zlib.crc32(pieces[p][at:at + n].tobytes()), sequence, place),
                                       strict=True):
                    out[name].append(value)
                place += n
            sequence += 1
        take = pa.array(out.pop("piece"), pa.int64())
        columns = {"id": table.column("id").take(take).combine_chunks(), "doc_tokens": table.column("doc_tokens").take(take).combine_chunks()}
        columns |= {name: pa.array(values, pa.int64()) for name, values in out.items()}
        return pa.RecordBatch.from_arrays([columns[c] if isinstance(columns[c], pa.Array) else columns[c].chunk(0) for c in schema.names],
                                          schema=schema), sequence

    return run


def pack_related(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                 end_id: int = END_ID, shard: int = SHARD) -> DataFrame:
    """(``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of every document.

    Null and empty texts, and texts without a token, are one piece that holds
    only the end id. Repeated rows are packed each on its own; equal texts are
    each other's nearest neighbours. A text of ``size`` tokens or more fills
    sequences of its own, whatever its length; only the rest has neighbours.
    Any id is allowed, null included; other columns of ``docs`` play no part.
    An empty table gives an empty table. ``size`` must be a power of two.
    """
    if size < 1 or size & size - 1:
        raise ValueError(f"size must be a power of two: {size}")
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    encoder = WordEncoder(tokenizer)
    ids_as = "<u2" if max(encoder.vocabulary, end_id + 1) <= 1 << 16 else "<u4"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    columns = (f"id {id_type.simpleString()}, row long, doc_tokens long, whole long, crcs array<long>, tail binary, "
               "frequency array<long>, documents long, tokens long")
    packed = f"id {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    encoded_schema, packed_schema = _arrow(columns), _arrow(packed)
    with written(rows.mapInArrow(_encode(tokenizer, size, end_id, ids_as, encoded_schema), columns)) as encoded:
        totals = encoded.where("documents is not null")
        facts = totals.agg(F.sum("documents").alias("n"), F.sum("tokens").alias("tokens")).first()
        n = facts["n"]
        if not n:
            return spark.createDataFrame([], packed).withColumnRenamed("id", id_col)
        # a number an id of the vocabulary, whatever the corpus
        counted = (totals.select(F.posexplode("frequency").alias("term", "n")).where("n > 0")
                   .groupBy("term").agg(F.sum("n").alias("n")).collect())
        frequency = np.zeros(max(r["term"] for r in counted) + 1)
        for r in counted:
            frequency[r["term"]] = r["n"]
        idf = np.log1p((n - frequency + 0.5) / (frequency + 0.5))
        rank = np.argsort(np.argsort(frequency, kind="stable"), kind="stable").astype(np.int32)
        rank[frequency < 2] = len(frequency)
        idf[end_id], rank[end_id] = 0.0, len(frequency)  # every document has it
        pieces = encoded.where(F.octet_length("tail") > 0).select("id", "row", "doc_tokens", "tail")
        keys = [f"key{k}" for k in range(KEYS)]
        placed = pieces.mapInArrow(_placed(rank, ids_as), ", ".join(
            [f"id {id_type.simpleString()}, row long, doc_tokens long, tail binary", *(f"{k} int" for k in keys)]))
        parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // shard))
        order = [*keys, "row"]
        related = (placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "doc_tokens", "tail")
                   .mapInArrow(_pack_shards(size, shard, idf, facts["tokens"] / n, ids_as, packed_schema), packed))
        alone = (encoded.where(F.size("crcs") > 0)
                 .select("id", "doc_tokens", "whole", F.posexplode("crcs").alias("k", "ids_crc32"))
                 .select("id", (F.col("k").cast("long") * size).alias("start"), F.lit(size).cast("long").alias("length"), "ids_crc32",
                         "doc_tokens", (-1 - F.col("whole") - F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
        return saved(related.unionByName(alone)).withColumnRenamed("id", id_col)


def _arrow(columns: str) -> pa.Schema:
    """The Arrow schema of a Spark one, as tasks see it."""
    return to_arrow_schema(StructType.fromDDL(columns))


def op12_retrieval_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_related(docs, public_tokenizers.path("word_bpe_49k.json"))
