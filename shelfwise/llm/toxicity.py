"""Toxic spans from a linear-chain conditional random field, and document scores from its marginals.

Labels are of documents, so tokens get theirs by distant supervision: a token
that occurs in toxic training documents far more often than in clean ones
(``MIN_ODDS``, in ``MIN_DOCS`` documents and a share ``MIN_SHARE`` at least) is evidence, of a strength
class by its log-odds; in a toxic document evidence tokens are labelled toxic,
all others are not. On token sequences so labelled the field is fitted by
conditional likelihood: a weight for each strength class, and for each pair of
neighbouring labels.

Forward-backward gives each token's marginal. Tokens that are no evidence all
have the same potentials, so a run of k of them is the k-th power of one
2 x 2 matrix, in closed form; only evidence tokens are visited one by one, and
the marginals are those of the whole sequence. A document's expected number of
toxic evidence tokens becomes its score by a logistic regression; evidence
tokens with a marginal of one half or more are its offending offsets.

Training uses ``TRAIN_DOCS`` labelled documents of each class at most, taken by
hash; class weights restore the shares that all training labels have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.graph import saved
from shelfwise.llm.words import slices, span_hashes, utf8, word_spans

TRAIN_DOCS = 2000
#: Training documents of each class whose tokens the field is fitted on.
FIELD_DOCS = 150
#: Evidence occurs in so many, and in that share, of the toxic training documents, with such log-odds.
MIN_DOCS, MIN_SHARE, MIN_ODDS = 4, 0.02, 2.0
#: Lower ends of the strength classes of evidence, in log-odds.
STRENGTHS = (2.0, 3.0, 4.0, 5.0)

#: Token characters are ASCII letters, digits and everything beyond ASCII.
SEPARATORS = np.ones(256, dtype=bool)
SEPARATORS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


@dataclass
class Field:
    """``state[c]``: weight of label 1 for class c (0: no evidence); ``pair[y, z]``: weight of z after y."""

    state: np.ndarray
    pair: np.ndarray

    def _runs(self):
        """Powers of the matrix that one token of no evidence is, scaled to stay finite."""
        m = np.exp(self.pair) * np.exp(np.array([0.0, self.state[0]]))[None, :]
        values, vectors = np.linalg.eig(m)
        values, vectors = np.real(values), np.real(vectors)
        order = np.argsort(-values)
        values, vectors = values[order], vectors[:, order]
        return values[1] / values[0], vectors, np.linalg.inv(vectors)

    def marginals(self, length: int, positions: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Of label 1 at the evidence ``positions`` (ascending) of a sequence of ``length`` tokens."""
        if not len(positions):
            return np.zeros(0)
        ratio, right, left = self._runs()

        def run(k: int) -> tuple[float, float, float, float]:
            r = ratio**k if k else 1.0
            a, b = right[0, 0] * left[0, 0], right[0, 1] * left[1, 0]
            c, d = right[0, 0] * left[0, 1], right[0, 1] * left[1, 1]
            e, f = right[1, 0] * left[0, 0], right[1, 1] * left[1, 0]
            g, h = right[1, 0] * left[0, 1], right[1, 1] * left[1, 1]
            return a + b * r, c + d * r, e + f * r, g + h * r

        p00, p01, p10, p11 = np.exp(self.pair).ravel().tolist()
        quiet = float(np.exp(self.state[0]))
        forward = []
        x, y, at = 1.0, 1.0, -1  # before the first token both labels are open, without a pair weight
        for n, (p, c) in enumerate(zip(positions.tolist(), classes.tolist(), strict=True)):
            gap = p - at - 1
            weight = float(np.exp(self.state[c]))
            if n == 0 and gap:  # the first token has no pair weight
                x, y = 1.0, quiet
                gap -= 1
                at = 0
            if n or at == 0:
                if gap:
                    a, b, c2, d = run(gap)
                    x, y = x * a + y * c2, x * b + y * d
                x, y = x * p00 + y * p10, x * p01 + y * p11
            y *= weight
            total = x + y
            x, y, at = x / total, y / total, p
            forward.append((x, y))
        out = np.empty(len(forward))
        x, y, after = 1.0, 1.0, length
        for n in range(len(forward) - 1, -1, -1):
            p = int(positions[n])
            gap = after - p - 1
            if after < length:  # the next evidence token
                weight = float(np.exp(self.state[classes[n + 1]]))
                y *= weight
                x, y = p00 * x + p01 * y, p10 * x + p11 * y
            if gap:
                a, b, c2, d = run(gap)
                x, y = a * x + b * y, c2 * x + d * y
            total = x + y
            x, y, after = x / total, y / total, p
            u, v = forward[n][0] * x, forward[n][1] * y
            out[n] = v / (u + v)
        return out


def fit_field(sequences: list[tuple[np.ndarray, np.ndarray]], steps: int = 60) -> Field:
    """Maximum conditional likelihood from (classes, labels) of token sequences, by gradient steps."""
    number = len(STRENGTHS) + 1
    state, pair = np.zeros(number), np.zeros((2, 2))
    state[0] = -2.0
    pieces = [(c[a:a + 128], y[a:a + 128]) for c, y in sequences for a in range(0, len(c), 128)]
    if not pieces:
        return Field(state, pair)
    width = max(len(c) for c, _ in pieces)
    mask = np.zeros((len(pieces), width), dtype=bool)
    classes, labels = np.zeros((len(pieces), width), dtype=np.int64), np.zeros((len(pieces), width), dtype=np.int64)
    for n, (c, y) in enumerate(pieces):
        mask[n, :len(c)], classes[n, :len(c)], labels[n, :len(c)] = True, c, y
    both = mask[:, 1:]
    seen_state = np.bincount(classes[mask], weights=labels[mask], minlength=number)
    seen_pair = np.bincount((2 * labels[:, :-1] + labels[:, 1:])[both], minlength=4).reshape(2, 2).astype(float)
    total = mask.sum()
    rate_s, rate_p = np.full(number, 0.5), np.full((2, 2), 0.5)
    last_s, last_p = np.zeros(number), np.zeros((2, 2))
    for _ in range(steps):
        potential = np.exp(np.stack([np.zeros_like(classes, dtype=float), state[classes]], axis=2))
        step = np.exp(pair)
        alpha, beta = np.empty_like(potential), np.ones_like(potential)
        alpha[:, 0] = potential[:, 0] / potential[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, width):
            a = (alpha[:, t - 1] @ step) * potential[:, t]
            alpha[:, t] = np.where(mask[:, t, None], a / a.sum(axis=1, keepdims=True), alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            b = (beta[:, t + 1] * potential[:, t + 1]) @ step.T
            beta[:, t] = np.where(mask[:, t + 1, None], b / b.sum(axis=1, keepdims=True), beta[:, t + 1])
        gamma = alpha * beta
        gamma /= gamma.sum(axis=2, keepdims=True)
        joint = alpha[:, :-1, :, None] * step[None, None] * (potential[:, 1:] * beta[:, 1:])[:, :, None, :]
        joint /= joint.sum(axis=(2, 3), keepdims=True)
        slope_s = (seen_state - np.bincount(classes[mask], weights=gamma[..., 1][mask], minlength=number)) / total - 1e-5 * state
        slope_p = (seen_pair - joint[both].sum(axis=0)) / total - 1e-5 * pair
        for slope, last, rate, value in ((slope_s, last_s, rate_s, state), (slope_p, last_p, rate_p, pair)):
            rate *= np.where(slope * last < 0, 0.5, 1.2)  # steps by sign, longer while it lasts
            np.clip(rate, 1e-4, 1.0, out=rate)
            value += np.sign(slope) * rate
            last[...] = slope
    return Field(np.clip(state, -12, 12), np.clip(pair, -12, 12))


def features(expected: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of documents: one, and how many toxic tokens are expected, in all and of a hundred."""
    return np.stack([np.ones(len(size)), np.log1p(expected), np.log1p(100 * expected / np.maximum(size, 1))], axis=1)


def fit_logistic(design: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression, a little regularised, by Newton steps."""
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - 0.01 * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(len(beta))
        move = np.linalg.solve(curve, slope)
        beta += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return beta


@dataclass
class Model:
    hashes: np.ndarray  # evidence tokens, ascending
    classes: np.ndarray
    field: Field
    line: np.ndarray

    def evidence(self, offsets: np.ndarray, data: np.ndarray):
        """Starts and ends of all tokens, where each text's begin, and their strength classes."""
        starts, ends, bounds = word_spans(offsets, data, SEPARATORS)
        tokens = span_hashes(data, starts, ends, fold=True)
        if not len(self.hashes):
            return starts, ends, bounds, np.zeros(len(tokens), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, tokens), len(self.hashes) - 1)
        return starts, ends, bounds, np.where(self.hashes[at] == tokens, self.classes[at], 0)

    def marginals(self, bounds: np.ndarray, classes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(token indexes, marginals) of each text's evidence."""
        found = np.flatnonzero(classes)
        edge = np.searchsorted(found, bounds)
        out = []
        for row in range(len(bounds) - 1):
            own = found[edge[row]:edge[row + 1]]
            out.append((own, self.field.marginals(int(bounds[row + 1] - bounds[row]), own - bounds[row], classes[own])))
        return out

    def score(self, expected: np.ndarray, size: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(expected, size) @ self.line, -30, 30)))


def _token_rows(batches):
    """One row for each distinct token of a text, with the text's label."""
    for batch in batches:
        offsets, data = utf8(batch.column("text"))
        toxic = batch.column("toxic").to_numpy()
        starts, ends, bounds = word_spans(offsets, data, SEPARATORS)
        tokens = span_hashes(data, starts, ends, fold=True)
        lists = [np.unique(tokens[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate(lists).view(np.int64) if lists else [], pa.int64()),
            pa.array(np.repeat(toxic, [len(x) for x in lists]), pa.int32())], names=["token", "toxic"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_docs: int = TRAIN_DOCS) -> Model:
    """A model from the documents that ``labels`` (id, 0 or 1) names; other labels are ignored.

    An id with several labels counts as toxic if one of them is 1. Without
    documents of both classes every score is one half of the known share.
    """
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic")))
    known = saved(known.withColumn("h", F.xxhash64("id", F.lit("toxic"))))
    share = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = (known.groupBy("toxic", F.pmod("h", F.lit(train_docs)).alias("stratum"))
              .agg(F.min(F.struct("h", "id")).alias("first")).select("toxic", "first.id"))
    sample = saved(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                   .join(F.broadcast(chosen), "id")  # 2 * ``train_docs`` rows at most
                   .groupBy("text").agg(F.max("toxic").alias("toxic"), F.min("id").alias("id")))  # copies teach once
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    number = len(STRENGTHS) + 1
    if not size.get(0) or not size.get(1):
        total = share.get(0, 0) + share.get(1, 0)
        part = (share.get(1, 0) + 1) / (total + 2)
        return Model(np.zeros(0, np.uint64), np.zeros(0, np.int64), Field(np.zeros(number), np.zeros((2, 2))),
                     np.array([np.log(part / (1 - part)), 0.0, 0.0]))
    odds = (F.log((F.col("t") + 0.5) / (size[1] + 1.0)) - F.log((F.col("n") - F.col("t") + 0.5) / (size[0] + 1.0)))
    evidence = (sample.mapInArrow(_token_rows, "token long, toxic int").groupBy("token")
                .agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).where(
                    F.col("t") >= max(MIN_DOCS, MIN_SHARE * size[1]))
                .select("token", odds.alias("odds")).where(F.col("odds") >= MIN_ODDS).collect())  # bounded by the sample
    hashes = np.array([r["token"] for r in evidence], dtype=np.int64).view(np.uint64)
    classes = np.searchsorted(np.array(STRENGTHS), np.array([r["odds"] for r in evidence]), side="right").astype(np.int64)
    order = np.argsort(hashes)
    model = Model(hashes[order], classes[order], Field(np.zeros(number), np.zeros((2, 2))), np.zeros(3))

    def look(batches):
        for batch in batches:
            _, _, bounds, found = model.evidence(*utf8(batch.column("text")))
            rows = [(int(b - a), np.flatnonzero(found[a:b]).tolist(), found[a:b][found[a:b] > 0].tolist())
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("toxic"), pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.list_(pa.int64()))],
                names=["id", "toxic", "size", "at", "class"])

    id_type = sample.schema["id"].dataType.simpleString()
    seen = sample.mapInArrow(look, f"id {id_type}, toxic int, size long, at array<long>, class array<long>").orderBy("id").collect()
    sequences = []
    for label in (0, 1):
        for r in [r for r in seen if r["toxic"] == label][:FIELD_DOCS]:
            row = np.zeros(r["size"], dtype=np.int64)
            row[r["at"]] = r["class"]
            sequences.append((row, (row > 0).astype(np.int64) * label))
    model.field = fit_field(sequences)
    expected = np.array([model.field.marginals(r["size"], np.array(r["at"], np.int64), np.array(r["class"], np.int64)).sum()
                         for r in seen])
    y = np.array([r["toxic"] for r in seen], dtype=float)
    weight = np.where(y == 1, share[1] / size[1], share[0] / size[0])
    model.line = fit_logistic(features(expected, np.array([r["size"] for r in seen])), y, weight * len(y) / weight.sum())
    return model


def tag(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``spans`` (start, end in characters, marginal) of toxic tokens.

    Null and empty texts are scored like texts without evidence and have no
    spans. Columns of ``docs`` with one of the two names are replaced, all
    others kept. Repeated rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, spans array<struct<start:int,end:int,marginal:double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            offsets, data = utf8(pa.array(batch, pa.large_string(), from_pandas=True))
            scores, spans = [np.zeros(0)], []
            for a, b in slices(offsets):
                own, part = offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]]
                starts, ends, bounds, classes = shared.value.evidence(own, part)
                found = shared.value.marginals(bounds, classes)
                scores.append(shared.value.score(np.array([m.sum() for _, m in found]), np.diff(bounds)))
                for row, (at, marginal) in enumerate(found):
                    hit = marginal >= 0.5
                    if hit.any():
                        chars = np.cumsum((part[own[row]:own[row + 1]] & 0xC0) != 0x80)
                        spans.append([{"start": int(chars[s - own[row]] - 1), "end": int(chars[e - 1 - own[row]]), "marginal": float(m)}
                                      for s, e, m in zip(starts[at[hit]], ends[at[hit]], marginal[hit], strict=True)])
                    else:
                        spans.append([])
            yield pd.DataFrame({"score": np.concatenate(scores), "spans": spans})

    names = [c for c in docs.columns if c not in ("score", "spans")]
    return (docs.select(*names).withColumn("__t", run(F.col(text_col)))
            .select(*names, F.col("__t.score").alias("score"), F.col("__t.spans").alias("spans")))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = train(docs, labels.where(~held_out()))
    return tag(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                   (F.col("score") >= 0.5).cast("int").alias("predicted"),
                                   F.size("spans").cast("long").alias("n_spans"))
