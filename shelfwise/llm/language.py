"""Language identification by cross-parsing entropy.

For each language, a suffix automaton of sample text accepts exactly the
substrings of the sample. A text is parsed against it from left to right into
the longest phrases that occur in the sample (a character that never occurs
is a phrase of its own). Text in the sample's language needs few, long
phrases; c phrases over n characters, with a sample of N characters, estimate
a cross entropy of c * log2(N) / n bits a character (Ziv and Merhav). The
language with the lowest one wins.

Training takes a bounded sample: of each language the ``SAMPLE_DOCS`` rows
with the smallest hash in as many strata, ``SAMPLE_CHARS`` characters of
each, from a place in the text that the hash draws. Every letter of the
samples, of whatever script, has a code of its own. The automata's arcs are
broadcast as sparse tables (state and character -> state), whose size goes
with the sample and not with the number of letters. Prediction reads every
text whole.

A task parses many pieces of text side by side, one character of each at a
time. Texts are cut into pieces of ``PIECE`` characters for that; a phrase
ends where its piece does.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.words import given_back

SAMPLE_DOCS, SAMPLE_CHARS = 48, 500
PIECE = 512
#: Bytes of text that are parsed side by side.
SIDE_BY_SIDE = 2 << 20
UNDETERMINED = "und"

_PAD, _GAP, _OTHER = 0, 1, 2


class _Automaton:
    """Suffix automaton of one string of small numbers."""

    def __init__(self, codes: list[int]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self._link, self._length, self._last = [-1], [0], 0
        for c in codes:
            self._add(c)

    def _add(self, c: int) -> None:
        new = len(self.next)
        self.next.append({})
        self._length.append(self._length[self._last] + 1)
        self._link.append(0)
        at, self._last = self._last, new
        while at >= 0 and c not in self.next[at]:
            self.next[at][c] = new
            at = self._link[at]
        if at < 0:
            return
        old = self.next[at][c]
        if self._length[at] + 1 == self._length[old]:
            self._link[new] = old
            return
        copy = len(self.next)
        self.next.append(dict(self.next[old]))
        self._length.append(self._length[at] + 1)
        self._link.append(self._link[old])
        while at >= 0 and self.next[at].get(c) == old:
            self.next[at][c] = copy
            at = self._link[at]
        self._link[old] = self._link[new] = copy


class ParseTable:
    """Flat table of which only the arcs are stored, each row shifted so that no two arcs share a slot.

    Reads like an array: entry [state * width + code] is (next state * width) * 2,
    plus 1 if a phrase begins.
    """

    def __init__(self, arcs: list[dict[int, int]], fresh: np.ndarray) -> None:
        self.width, self._fresh, self._base = len(fresh), fresh, np.zeros(len(arcs), dtype=np.int64)
        count = sum(map(len, arcs))
        self._owner = np.full(self.width * 2 + count, -1, dtype=np.int32)
        self._to = np.zeros(len(self._owner), dtype=np.int64)
        # rows of several arcs first, one after another; rows of one arc fill the gaps
        low = self.width
        for row in sorted((r for r, out in enumerate(arcs) if len(out) > 1), key=lambda r: (-len(arcs[r]), r)):
            low = self._place(row, arcs[row], low)
        single = [r for r, out in enumerate(arcs) if len(out) == 1]
        gaps = self.width + np.flatnonzero(self._owner[self.width:] < 0)
        if len(gaps) < len(single) + self.width:
            self._grow(len(single) + self.width - len(gaps))
            gaps = self.width + np.flatnonzero(self._owner[self.width:] < 0)
        for row, slot in zip(single, gaps.tolist(), strict=False):
            (c, to), = arcs[row].items()
            self._base[row], self._owner[slot], self._to[slot] = slot - c, row, to
        self._grow(max(0, int(self._base.max(initial=0)) + self.width - len(self._owner)))
        keep = int(self._base.max(initial=0)) + self.width
        self._owner, self._to = self._owner[:keep].copy(), self._to[:keep].copy()

    def _grow(self, by: int) -> None:
        self._owner = np.concatenate([self._owner, np.full(by, -1, dtype=np.int32)])
        self._to = np.concatenate([self._to, np.zeros(by, dtype=np.int64)])

    def _place(self, row: int, out: dict[int, int], low: int) -> int:
        """Put a row's arcs at the first base from ``low`` where all their slots are free."""
        codes = np.array(list(out), dtype=np.int64)
        while True:
            if low + 512 + self.width > len(self._owner):
                self._grow(len(self._owner) + 512)
            free = self._owner[low:low + 512 + self.width] < 0
            fits = np.logical_and.reduce([free[c:c + 512] for c in codes.tolist()])
            if fits.any():
                base = low + int(fits.argmax())
                self._base[row], self._owner[base + codes], self._to[base + codes] = base, row, list(out.values())
                return base
            low += 512

    def __len__(self) -> int:
        return len(self._base) * self.width

    def __getitem__(self, index):
        row, code = np.divmod(index, self.width)
        slot = self._base[row] + code
        entry = np.where(self._owner[slot] == row, self._to[slot], self._fresh[code])
        return np.where(code == _PAD, index * 2, entry)


def parse_table(codes: list[int], width: int) -> ParseTable:
    """The table of a sample.

    State 0 is before any phrase. A code that can't lengthen the phrase
    begins the next one; one that the sample lacks is a phrase that nothing
    lengthens, so it leads back to state 0. The pad code changes nothing.
    """
    arcs = _Automaton(codes).next  # state s of the automaton is row s + 1
    fresh = np.ones(width, dtype=np.int64)
    for c, to in arcs[0].items():
        fresh[c] = (to + 1) * width * 2 + 1
    return ParseTable([{}, {}, *[{c: (to + 1) * width * 2 for c, to in out.items()} for out in arcs[1:]]], fresh)


def _is_letter(character: int) -> bool:
    return chr(character).isalpha()


class Model:
    """Characters' codes, and for each language its table and the size of its sample."""

    def __init__(self, samples: dict[str, list[str]]) -> None:
        texts = {lang: [t.lower() for t in ts] for lang, ts in sorted(samples.items())}
        self.letters = "".join(sorted({c for ts in texts.values() for t in ts for c in t if c.isalpha()}))
        self.languages = list(texts)
        self.width = _OTHER + 1 + len(self.letters)
        self.tables, self.bits = [], []
        for lang in self.languages:
            codes: list[int] = []
            for t in texts[lang]:
                codes += [*self.codes(np.array([ord(c) for c in t], dtype=np.uint32)).tolist(), _GAP]
            self.tables.append(parse_table(codes, self.width))
            self.bits.append(np.log2(len(codes) + 1))

    def _columns(self) -> np.ndarray:
        """The code of each character of Unicode; built once a process."""
        if not hasattr(self, "_code"):
            code = np.full(sys.maxunicode + 1, _GAP, dtype=np.min_scalar_type(self.width))
            for c in range(sys.maxunicode + 1):
                if _is_letter(c):
                    code[c] = _OTHER
            for k, c in enumerate(self.letters):
                code[ord(c)] = _OTHER + 1 + k
            self._code = code
        return self._code

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_code"}

    def codes(self, characters: np.ndarray) -> np.ndarray:
        """Codes of lower-case characters; each run of others than letters is one gap."""
        code = self._columns()[characters]
        gap = code == _GAP
        if len(gap):
            gap[1:] &= gap[:-1]  # all but the first of a run ...
            gap[0] = code[0] == _GAP  # ... and a run at the front
        return code[~gap]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases needed (texts x languages), and characters parsed; no letter: no characters."""
        coded = [self.codes(np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)) for t in texts]
        sizes = np.array([len(c) if (c != _GAP).any() else 0 for c in coded], dtype=np.int64)
        per = -(-sizes // PIECE)
        side = np.full((int(per.sum()), PIECE), _PAD, dtype=np.min_scalar_type(self.width))
        at = 0
        for c, n, k in zip(coded, sizes.tolist(), per.tolist(), strict=True):
            side[at:at + k].ravel()[:n] = c[:n]
            at += k
        longest = np.full(len(side), PIECE, dtype=np.int64)
        ends = np.cumsum(per)
        longest[ends[per > 0] - 1] = (sizes - (per - 1) * PIECE)[per > 0]
        order = np.argsort(-longest, kind="stable")  # so that pieces still being parsed are the first ones
        columns = np.ascontiguousarray(side[order].T)
        active = np.searchsorted(-longest[order], -np.arange(PIECE), side="left")
        owner = np.repeat(np.arange(len(texts)), per)[order]
        out = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        for k, table in enumerate(self.tables):
            state = np.zeros(len(side), dtype=np.int64)
            count = np.zeros(len(side), dtype=np.int32)
            for step in range(PIECE):
                n = int(active[step])
                if not n:
                    break
                entry = table[state[:n] + columns[step, :n]]
                count[:n] += entry & 1
                np.right_shift(entry, 1, out=state[:n])
            out[:, k] = np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)
        return out, sizes

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text, and how clearly it wins: 1 - its entropy over the runner-up's."""
        count, sizes = self.phrases(texts)
        langs, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if self.languages:
            entropy = count * np.array(self.bits)[None, :] / np.maximum(sizes, 1)[:, None]
            best = entropy.argmin(axis=1)
            langs = [self.languages[b] if n else UNDETERMINED for b, n in zip(best.tolist(), sizes.tolist(), strict=True)]
            if len(self.languages) > 1:
                two = np.sort(entropy, axis=1)[:, :2]
                score = np.where(sizes > 0, 1 - two[:, 0] / np.maximum(two[:, 1], 1e-12), 0.0)
            else:
                score = (sizes > 0).astype(float)
        return langs, np.clip(score, 0, 1)


def training_sample(docs: DataFrame, text_col: str, lang_col: str, id_col: str,
                    sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """{language: sample texts}: of each language, the first row by hash in each of ``sample_docs`` strata.

    A text longer than ``sample_chars`` gives that many characters from a place that a hash draws.
    """
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    order = F.xxhash64(F.col(id_col), F.lit("sample"))
    chosen = (usable.select(F.col(lang_col).alias("lang"), order.alias("h"))
              .groupBy("lang", F.pmod("h", F.lit(sample_docs)).alias("stratum")).agg(F.min("h").alias("h")))
    places = F.greatest(F.length(text_col) - sample_chars, F.lit(0)) + 1
    begin = F.pmod(F.xxhash64(F.col(id_col), F.lit("place")), places).cast("int") + 1
    taken = F.substring(F.col(text_col), begin, F.lit(sample_chars))
    taken = F.when(taken.rlike(r"\p{L}"), taken).otherwise(F.regexp_extract(text_col, rf"(?s)\p{{L}}.{{0,{sample_chars - 1}}}", 0))
    rows = (usable.select(F.col(lang_col).alias("lang"), order.alias("h"), taken.alias("t"))
            .join(F.broadcast(chosen.select("lang", "h")), ["lang", "h"])  # ``sample_docs`` rows a language
            .groupBy("lang", "h").agg(F.min("t").alias("t")).orderBy("lang", "h").collect())
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r["lang"], []).append(r["t"])
    return out


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Index ranges of equal consecutive values."""
    edge = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return [(a, b) for a, b in zip(edge[:-1], edge[1:], strict=True) if b > a]


def identify(docs: DataFrame, train: DataFrame, text_col: str = "text", lang_col: str = "lang",
             id_col: str = "doc_id", once: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the text alone; ``train`` has labelled rows.

    Null text, or one without a letter: language ``und``, score 0. Ties go
    to the language first in order. Rows of ``train`` with a null language
    or no letter teach nothing; with none left, every language is ``und``.
    Columns of ``docs`` with one of the two names are replaced, all others
    kept. Repeated rows get equal results. An empty table gives an empty one.
    With ``once``, a filter on the prediction is not moved into the scan,
    where it would work out every prediction a second time.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Model(training_sample(train, text_col, lang_col, id_col)))

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from given_back(predicted(batches, shared.value))

    def predicted(batches, model):
        for batch in batches:
            texts = [t or "" for t in batch]
            edges = np.cumsum([len(t) for t in texts]) // SIDE_BY_SIDE
            parts = [model.predict(texts[a:b]) for a, b in _runs(edges)]
            yield pd.DataFrame({"lang": [x for langs, _ in parts for x in langs],
                                "score": np.concatenate([np.zeros(0), *[s for _, s in parts]])})

    if once:
        predict = predict.asNondeterministic()
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return (docs.select(*names).withColumn("__p", predict(F.col(text_col)))
            .select(*names, F.col("__p.lang").alias("lang_pred"), F.col("__p.score").alias("score")))


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether a row is kept from training: by the CRC of its id as text; a null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def keep_identified(docs: DataFrame, train: DataFrame) -> DataFrame:
    """``docs`` whose language can be told, with ``lang`` set to it; rows without a letter go."""
    out = identify(docs, train, once=True)
    return out.where(F.col("lang_pred") != UNDETERMINED).select(
        *[F.col("lang_pred").alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def op4_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = identify(docs, docs.where(~held_out()))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
