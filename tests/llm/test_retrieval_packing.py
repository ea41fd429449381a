"""Retrieval packing: ids against the tokenizer, windows against plain BM25, sequences against their rules."""

import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from shelfwise.llm import retrieval_packing as rp
from shelfwise.llm.words import utf8
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCS, frame, text

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a b", " ", "x ́y", "é", "́ ạ́", "ΑΣ ΑΣ. ΣΑΣ", "İstanbul ẞ ﬁn", "it's we'll 'S", "日本語 テスト", "😀😀 🏳️‍🌈",
       "<|endoftext|> a<|startoftext|>b", "<|endoftext|", "12 345 ٣٤", "a\x1cb \x85 c d", "﻿bom ​ zero", "#$% … ——", "\x00 nul \x7f",
       "ǅ Ω K", "ﷺ ½ ²", "ẛ̣ 각"]


def whole_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def encoded(texts, encoder=None):
    ids, bounds = (encoder or rp.WordEncoder(PATH)).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_ids_are_the_tokenizers_own(monkeypatch):
    given = pd.read_parquet(f"{SF_SMALL}/documents.parquet")["text"].tolist()
    rng = random.Random(2)
    odd = [rng.choice([" ", "\n", "\t\t", "  ", "\r\n"]).join(rng.choices(ODD, k=rng.randint(1, 9))) for _ in range(300)]
    letters = [chr(c) for c in [*range(1, 127), *range(0xa0, 0x250)]]
    words = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(20)) for _ in range(200)]
    texts = given + [t for _, t in DOCS] + ODD + odd + words
    want = whole_ids(texts)
    assert encoded(texts) == want
    monkeypatch.setattr(rp, "KNOWN_WORDS", 50)  # words are forgotten on the way
    monkeypatch.setattr(rp, "TOGETHER", 3)
    encoder = rp.WordEncoder(PATH)
    assert [x for t in range(0, len(texts), 40) for x in encoded(texts[t:t + 40], encoder)] == want


def test_parts_are_cut_as_the_file_says():
    with open(PATH, encoding="utf-8") as file:
        split = json.load(file)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    rng = random.Random(5)
    letters = [*"stmdrevl''\"xéž70.-"]
    words = ["", "'", "'s", "''s", "'sx", "it's", "'s's", "we'll've", "x'r", "x'", "'r", "e", "'l", "l"]
    words += ["".join(rng.choices(letters, k=rng.randint(0, 7))) for _ in range(5000)]
    offsets, data = utf8(pa.array(words, pa.string()))
    starts = np.flatnonzero(rp.part_starts(offsets, data)).tolist()
    got = [data[a:b].tobytes().decode() for a, b in zip(starts[:-1], starts[1:])]
    assert got == [part for w in words for part in regex.findall(split, w)]
    assert rp.part_starts(*utf8(pa.array([], pa.string()))).tolist() == [True]


def test_each_part_is_encoded_once():
    """Words that differ in case or signs share the work of their parts; few words go to the tokenizer itself."""
    encoder, given = rp.WordEncoder(PATH), []
    engine = encoder._engine

    class Counted:
        def encode_to_numpy(self, text):
            given.append(text)
            return engine.encode_to_numpy(text)

    encoder._engine = Counted()
    texts = ["Thoundth thoundth, (THOUNDTH) thoundth's", "thoundth. Été été! 'Thoundth' <|endoftext|> 각"]
    assert encoded(texts, encoder) == whole_ids(texts)
    parts = [p for t in given for p in regex.split("[\x01 ]", t) if p]
    assert parts.count("thoundth") == parts.count("été") == 1 and len(parts) == len(set(parts))
    assert set(encoder._number) == {"<|endoftext|>", "각"}


def test_other_patterns_are_left_to_the_tokenizer(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        contents = json.load(file)
    contents["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(contents), encoding="utf-8")
    texts = ["it's 1234 a1b2, (x)", None, "été 12"]
    tokenizer = Tokenizer.from_file(str(path))
    assert encoded(texts, rp.WordEncoder(str(path))) == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_batches_together():
    batches = [pa.RecordBatch.from_pydict({"x": list(range(a, a + 10))}) for a in range(0, 70, 10)]
    got = list(rp.together(iter(batches), 3 * batches[0].nbytes))
    assert [b.num_rows for b in got] == [30, 30, 10] and [v for b in got for v in b.column("x").to_pylist()] == list(range(70))
    assert [b is c for b, c in zip(rp.together(iter(batches), 1), batches, strict=True)] == [True] * 7
    assert list(rp.together(iter([]), 10)) == []


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def hold(rows, docs, size=rp.SIZE, end_id=rp.END_ID):
    """Every id of every row lies in exactly one piece; sequences are gapless, and full or a power of two."""
    ids = [np.array([*own, end_id], dtype="<u4") for own in whole_ids([t for _, t in docs])]
    want, got = Counter(), Counter()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    total = 0
    for (i, _), own in zip(docs, ids, strict=True):
        total += len(own)
        pieces = [r for r in by_doc[i, len(own)]
                  if r["ids_crc32"] == zlib.crc32(own[r["start"]:r["start"] + r["length"]].tobytes()) and r["start"] + r["length"] <= len(own)]
        want[i, len(own)] += 1
        covered = Counter(k for r in pieces for k in range(r["start"], r["start"] + r["length"]))
        assert set(covered) == set(range(len(own))), i
        got[i, len(own)] += 1
    assert total == sum(r["length"] for r in rows) and all(r["length"] > 0 for r in rows)
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        place = 0
        for r in own:
            assert r["offset"] == place
            place += r["length"]
        assert place == size or place & place - 1 == 0 and place < size
    return by_sequence


def test_given_documents(spark):
    table = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    rows = rows_of(rp.op12_retrieval_packing(spark, SF_SMALL))
    sequences = hold(rows, list(zip(table["doc_id"].tolist(), table["text"].tolist())))
    full = -(-sum(r["length"] for r in rows) // rp.SIZE)
    assert full <= len(sequences) <= full + 11  # no more than one window short of full


def test_odd_rows(spark):
    docs = DOCS + [(50, "word " * 2047), (51, "word " * 2048), (52, "word " * 2046), (50, "word " * 2047), (53, " "), (54, "<|endoftext|>")]
    hold(rows_of(rp.pack_related(frame(spark, docs), PATH)), docs)
    hold(rows_of(rp.pack_related(frame(spark, docs), PATH, size=16, shard=3)), docs, size=16)
    hold(rows_of(rp.pack_related(frame(spark, docs), PATH, size=1)), docs, size=1)
    with pytest.raises(ValueError):
        rp.pack_related(frame(spark, docs), PATH, size=1000)


def test_empty_tables_and_other_ids(spark):
    empty = rp.pack_related(frame(spark).limit(0), PATH)
    assert empty.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and empty.collect() == []
    blank = rows_of(rp.pack_related(frame(spark, [(None, None)] * 3), PATH))
    assert sorted(r["length"] for r in blank) == [1, 1, 1] and len({(r["sequence_id"], r["offset"]) for r in blank}) == 3
    named = spark.createDataFrame([("a", text(0, 50)), ("b", text(0, 50)), (None, text(20, 60))], "doc_id string, text string")
    assert {r["doc_id"] for r in rows_of(rp.pack_related(named, PATH))} == {"a", "b", None}


def bm25_windows(pieces, idf, average, size, query_terms):
    """The same greedy filling with scores summed one by one."""
    tf = [Counter(p) for p in pieces]

    def weight(d, t):
        return idf[t] * tf[d][t] * (rp.K1 + 1) / (tf[d][t] + rp.K1 * (1 - rp.B + rp.B * len(pieces[d]) / average))

    used, out, window, room, rest = set(), [], [], size, None
    while len(used) < len(pieces) or rest:
        if rest:
            (seed, at), rest = rest, None
        else:
            seed, at = next(d for d in range(len(pieces)) if d not in used), 0
            used.add(seed)
        query = sorted((t for t in tf[seed] if weight(seed, t) > 0), key=lambda t: (-weight(seed, t), t))[:query_terms]
        piece, following = seed, None
        while True:
            take = min(room, len(pieces[piece]) - at)
            window.append((piece, at, take))
            room -= take
            if not room:
                out.append(window)
                window, room = [], size
                rest = (piece, at + take) if at + take < len(pieces[piece]) else None
                break
            if following is None:
                score = {d: sum(weight(d, t) for t in query if t in tf[d]) for d in range(len(pieces)) if d not in used}
                following = sorted((d for d in score if score[d] > 0), key=lambda d: (-round(score[d], 9), d))
            if not following:
                break
            piece, at = following.pop(0), 0
            used.add(piece)
    return out + ([window] if window else [])


@pytest.mark.parametrize("seed", range(4))
def test_windows_against_plain_bm25(seed):
    g = np.random.default_rng(seed)
    pieces = [g.zipf(1.3, size=int(n)).clip(0, 400).astype(np.uint32) for n in g.integers(1, 60, size=80)]
    df = np.zeros(401)
    for p in pieces:
        df[np.unique(p)] += 1
    idf, average = np.log1p((80 - df + 0.5) / (df + 0.5)), float(np.mean([len(p) for p in pieces]))
    got = rp.windows([len(p) for p in pieces], rp.ShardIndex(pieces, idf, average, 8), 64)
    assert got == bm25_windows([p.tolist() for p in pieces], idf, average, 64, 8)
    assert Counter(p for w in got for p, _, n in w for _ in range(n)) == Counter({k: len(p) for k, p in enumerate(pieces)})


def test_related_documents_share_a_window(spark):
    """Texts of 60 topics in random order: neighbours in a sequence are mostly of one topic."""
    rng = random.Random(7)
    vocabulary = sorted(w[:-4] for w in Tokenizer.from_file(PATH).get_vocab() if w.endswith("</w>") and w[:-4].isascii() and w[:-4].isalpha())
    words = rng.sample([w for w in vocabulary if len(w) > 4], 60 * 15 + 50)
    topics, common = [words[15 * t:15 * t + 15] for t in range(60)], words[-50:]
    docs = [(k, " ".join(rng.choices(topics[k % 60], k=12) + rng.choices(common, k=40))) for k in range(1200)]
    rng.shuffle(docs)
    shares = []
    for shard in (4096, 300):
        rows = rows_of(rp.pack_related(spark.createDataFrame(docs, "doc_id long, text string"), PATH, shard=shard))
        same = total = 0
        for own in hold(rows, docs).values():
            ids = [r["doc_id"] % 60 for r in own]
            same += sum(a == b for a, b in zip(ids, ids[1:]))
            total += len(ids) - 1
        assert total > 800
        shares.append(same / total)
    assert shares[0] > 0.7 and shares[1] > 0.6  # 1 in 60 by chance


def test_keys_of_the_lexical_order():
    rank = np.array([9, 0, 1, 2, 3, 4, 5, 6, 7, 9], dtype=np.int32)[:9]
    rank[0] = 9  # no other document has it
    pieces = [np.array([0, 5, 5, 2]), np.array([0]), np.array([8, 7, 6, 5, 4, 3, 2, 1, 1]), np.array([3])]
    assert rp.telling_terms(pieces, rank).tolist() == [[4, 1, -1], [-1, -1, -1], [7, 6, 5], [2, -1, -1]]
    many = [np.arange(1, 9)] * 2
    assert rp.telling_terms(many, np.array([20] + list(range(8)) + [0] * 11, dtype=np.int32)).tolist() == [[7, 6, 5]] * 2
    assert rp.telling_terms([], rank).shape == (0, rp.KEYS)


def test_cut_in_powers_of_two():
    assert rp.in_powers_of_two([(0, 5, 3), (1, 0, 4)], 16) == [[(0, 5, 3), (1, 0, 1)], [(1, 1, 2)], [(1, 3, 1)]]
    assert rp.in_powers_of_two([(0, 0, 16)], 16) == [[(0, 0, 16)]] and rp.in_powers_of_two([(0, 0, 8)], 16) == [[(0, 0, 8)]]


def test_copies_go_on_over_shards(spark):
    docs = [(7, "the very same text")] * 500 + [(k, f"text number {k}") for k in range(50)]
    rows = rows_of(rp.pack_related(spark.createDataFrame(docs, "doc_id long, text string"), PATH, size=32, shard=64))
    hold(rows, docs, size=32)
    assert len({r["sequence_id"] >> 40 for r in rows}) > 4  # in several tasks
