"""Vector codes: one codebook a part of the vector, trained with adaptive distance bounds.

Components become integers floor(scale * x); vectors are cut into ``PARTS``
equal parts, each with a codebook of ``ENTRIES`` entries. Training is integer
k-means, so its result doesn't depend on how rows are dealt. What it need not
compute is found by bounds, kept with each vector from round to round, for
each of its parts:

* an upper bound of the distance to its own entry,
* its b next closest entries, each with a lower bound, ascending,
* one lower bound for all other entries.

When the entries move, bounds give way by what each entry moved. A part whose
upper bound stays below its first lower bound keeps its entry. Otherwise only
the entries whose bounds it reaches are compared, by integer distances with
ties to the lower index, and all entries only if it reaches the outer bound.
b is chosen anew for each part position after every round, from how many of
its bounds were reached.

A round is one job: it reads the vectors with their bounds, writes them with
the new ones, and in one further row a task says which sums have changed and
how many bounds were needed. The codebooks, their sums and these counts are all
that the driver sees; they have a fixed size, whatever the table.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfwise.llm.graph import saved
from shelfwise.llm.tables import folder, removed
from shelfwise.llm.words import given_back

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6

#: No entry, in a list of closest entries.
_NONE = 255
#: Bits of the numbers in which sums of any size are added up.
_LIMB = 32
_LARGEST = 2**63 - 1
#: In the counts a task reports, places before the components: rows of an entry, bounds needed.
_ROWS, _NEEDED = -1, -2


def usable(vector: Column) -> Column:
    """Whether a vector and all its components are neither null nor infinite nor NaN."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def whole(x: float, scale: int) -> int:
    """floor(scale * x), exactly; ``scale`` is a power of two."""
    return int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale)


def _root(square: int) -> float:
    """At least the square root."""
    try:
        return math.sqrt(square) * (1 + 1e-9)
    except OverflowError:
        return math.inf


def _layout(tracked: list[int]) -> np.dtype:
    """What is kept with a vector: for every part its entry and bounds, and the ``tracked`` closest entries."""
    parts, total = len(tracked), sum(tracked)
    return np.dtype([("code", "u1", (parts,)), ("upper", "<f4", (parts,)), ("outer", "<f4", (parts,)),
                     ("near", "u1", (total,)), ("lower", "<f4", (total,))])


def _below(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _above(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles, shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    if len(values):
        out[np.repeat(np.arange(len(sizes)), sizes),
            np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries; exact, as the caller keeps them under 2^53 or uses Python integers."""
    difference = x[:, None, :] - entries[None, :, :]
    return (difference * difference).sum(axis=2)


class Bounds:
    """Entries and bounds of one part position for a batch of vectors."""

    def __init__(self, code: np.ndarray, upper: np.ndarray, near: np.ndarray, lower: np.ndarray, outer: np.ndarray) -> None:
        self.code, self.upper, self.near, self.lower, self.outer = code, upper, near, lower, outer

    @classmethod
    def of_all(cls, x: np.ndarray, entries: np.ndarray, tracked: int) -> "Bounds":
        """From the distances to every entry."""
        d = distances(x, entries)
        order = np.argsort(d, axis=1, kind="stable")  # ties to the lower index
        if d.dtype == object:  # too large for floating point: no bound, all is compared next time, too
            none = np.full((len(x), tracked), -np.inf)
            return cls(order[:, 0], np.full(len(x), np.inf), order[:, 1:tracked + 1], none, np.full(len(x), -np.inf))
        root = np.sqrt(np.take_along_axis(d, order, 1))
        outer = root[:, tracked + 1] if len(entries) > tracked + 1 else np.full(len(x), np.inf)
        return cls(order[:, 0], root[:, 0], order[:, 1:tracked + 1], root[:, 1:tracked + 1], outer)

    def resized(self, tracked: int) -> "Bounds":
        """The same with another number of closest entries."""
        have = self.near.shape[1]
        if tracked <= have:
            outer = np.hstack([self.lower[:, tracked:], self.outer[:, None]]).min(axis=1)
            return Bounds(self.code, self.upper, self.near[:, :tracked].copy(), self.lower[:, :tracked].copy(), outer)
        more = (len(self.code), tracked - have)
        return Bounds(self.code, self.upper, np.hstack([self.near, np.full(more, _NONE, self.near.dtype)]),
                      np.hstack([self.lower, np.broadcast_to(self.outer[:, None], more)]), self.outer)

    def put(self, rows: np.ndarray, other: "Bounds") -> None:
        for name in ("code", "upper", "near", "lower", "outer"):
            getattr(self, name)[rows] = getattr(other, name)

    def moved(self, x: np.ndarray, entries: np.ndarray, moves: np.ndarray, tracked: int) -> tuple["Bounds", np.ndarray]:
        """The bounds once every entry has moved by ``moves``, and how many of its bounds each row needed."""
        b = self.near.shape[1]
        by = np.append(moves, np.full(256 - len(moves), moves.max()))  # as far as any, where there is no entry
        upper = self.upper + by[self.code]
        bounds = np.hstack([self.lower - by[self.near], (self.outer - moves.max())[:, None]])
        # the z-th bound holds for the z-th entry and all after it
        bounds = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]

        def needed(rows):
            reach = upper[rows] * (1 + 1e-9) + 1e-9
            return (bounds[rows] <= reach[:, None]).sum(axis=1)

        need = needed(slice(None))
        unsure = np.flatnonzero(need)
        if len(unsure):
            own = x[unsure] - entries[self.code[unsure]]
            upper[unsure] = np.sqrt((own * own).sum(axis=1))
            need[unsure] = needed(unsure)
        out = Bounds(self.code.copy(), upper, self.near.copy(), bounds[:, :b].copy(), bounds[:, b].copy())
        some = np.flatnonzero((need > 0) & (need <= b))
        if len(some):
            out.put(some, out._compared(some, x, entries, need[some]))
        out = out.resized(tracked)
        every = np.flatnonzero(need > b)
        if len(every):
            out.put(every, Bounds.of_all(x[every], entries, tracked))
        return out, need

    def _compared(self, rows: np.ndarray, x: np.ndarray, entries: np.ndarray, need: np.ndarray) -> "Bounds":
        """Rows whose own entry is compared with their ``need`` closest ones."""
        entry = np.hstack([self.code[rows][:, None], self.near[rows]]).astype(np.int64)
        open_ = np.arange(entry.shape[1])[None, :] <= need[:, None]
        difference = x[rows][:, None, :] - entries[np.where(open_, entry, 0)]
        d = np.where(open_, (difference * difference).sum(axis=2), np.inf)
        bound = np.where(open_, np.sqrt(d), np.hstack([np.zeros((len(rows), 1)), self.lower[rows]]))
        # by distance, ties to the lower index; what wasn't compared stays where it was
        order = np.lexsort((np.where(open_, entry, 256 + np.arange(entry.shape[1])), d), axis=1)
        entry, bound = np.take_along_axis(entry, order, 1), np.take_along_axis(bound, order, 1)
        return Bounds(entry[:, 0], bound[:, 0], entry[:, 1:], bound[:, 1:], self.outer[rows])


def adapted(needed: Counter, tracked: int, entries: int) -> int:
    """How many closest entries to keep, from how often so many bounds were needed.

    A bound kept costs one step a row, a row that needs more than are kept
    costs a comparison with every entry. Where too many do, twice as many
    are kept from then on.
    """
    total = sum(needed.values())
    if not total or entries < 3:
        return tracked
    cost = {b: total * b + entries * sum(n for z, n in needed.items() if z > b) for b in range(1, tracked + 1)}
    best = min(cost, key=lambda b: (cost[b], b))
    if best == tracked and entries * needed[tracked + 1] > total:
        return min(entries - 1, 2 * tracked)
    return best


class Codebooks:
    """All that a task needs to know: entries now, how far they moved, and how many closest entries are kept."""

    def __init__(self, entries: list[list[list[int]]], width: int, scale: int) -> None:
        self.entries, self.width, self.scale = entries, width, scale
        self.moves = [np.zeros(len(part)) for part in entries]
        count = len(entries[0])
        self.tracked = self.next_tracked = [min(max(1, count // 4), count - 1)] * len(entries)
        self.started = False
        #: Components up to this give squared distances under 2^53.
        self.limit = math.isqrt(2**51 // max(1, width))
        self._arrays()

    def _arrays(self) -> None:
        self.arrays = [np.array(part, dtype=np.float64 if all(abs(x) <= self.limit for e in part for x in e) else object)
                       .reshape(len(part), self.width) for part in self.entries]

    def replace(self, entries: list[list[list[int]]], needed: list[Counter]) -> None:
        """Go on with other entries, from how many bounds the last round needed."""
        self.moves = [np.array([_root(sum((a - b)**2 for a, b in zip(x, y, strict=True))) for x, y in zip(old, new, strict=True)])
                      for old, new in zip(self.entries, entries, strict=True)]
        self.entries = entries
        self.tracked = self.next_tracked
        self.next_tracked = [adapted(n, b, len(part)) for n, b, part in zip(needed, self.tracked, entries, strict=True)]
        self._arrays()

    def assign(self, raw: np.ndarray, state: np.ndarray | None) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray | None]]:
        """New state of a batch, its parts as integers, and how many bounds were needed in each part."""
        parts, w = len(self.entries), self.width
        with np.errstate(over="ignore"):
            fast = np.floor(raw * self.scale)
        out = np.zeros(len(raw), dtype=_layout(self.next_tracked))
        pieces, needs = [], []
        before, after = np.cumsum([0, *self.tracked]), np.cumsum([0, *self.next_tracked])
        for p, entries in enumerate(self.arrays):
            x, tracked, need = fast[:, p * w:(p + 1) * w], self.next_tracked[p], None
            exact = entries.dtype == object or bool((np.abs(x) > self.limit).any())
            if exact:
                x = np.array([[whole(v, self.scale) for v in row] for row in raw[:, p * w:(p + 1) * w].tolist()],
                             dtype=object).reshape(len(raw), w)
                found = Bounds.of_all(x, np.array(self.entries[p], dtype=object).reshape(len(entries), w), tracked)
            elif state is None:
                found = Bounds.of_all(x, entries, tracked)
            else:
                a, b = before[p], before[p + 1]
                kept = Bounds(state["code"][:, p].astype(np.int64), state["upper"][:, p].astype(np.float64),
                              state["near"][:, a:b].astype(np.int64), state["lower"][:, a:b].astype(np.float64),
                              state["outer"][:, p].astype(np.float64))
                found, need = kept.moved(x, entries, self.moves[p], tracked)
            a, b = after[p], after[p + 1]
            out["code"][:, p], out["upper"][:, p], out["outer"][:, p] = found.code, _above(found.upper), _below(found.outer)
            out["near"][:, a:b], out["lower"][:, a:b] = found.near, _below(found.lower)
            pieces.append(x)
            needs.append(need)
        return out, pieces, needs


def _fixed(rows: np.ndarray) -> pa.Array:
    """A numpy array of records as an Arrow column of bytes."""
    size = rows.dtype.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def _state(column: pa.Array, layout: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=layout)


def _limbs(value: int) -> list[tuple[int, int]]:
    out, k = [], 0
    while value:
        if -2**62 < value < 2**62 and k:
            out.append((k, value))
            break
        out.append((k, value & (1 << _LIMB) - 1))
        value >>= _LIMB
        k += 1
    return out


def _round(books: Codebooks, schema: pa.Schema) -> Callable:
    """Vectors with new bounds; a last row a task tells what has changed."""
    parts, w = len(books.entries), books.width

    def run(batches):
        yield from given_back(rows(batches))

    def rows(batches):
        total: Counter = Counter()
        for batch in batches:
            raw = _matrix(batch.column("v"), parts * w)
            state = _state(batch.column("state"), _layout(books.tracked)) if books.started else None
            new, pieces, needs = books.assign(raw, state)
            for p, x in enumerate(pieces):
                code, entries = new["code"][:, p].astype(np.int64), len(books.entries[p])
                old = state["code"][:, p].astype(np.int64) if state is not None else None
                changed = slice(None) if old is None else np.flatnonzero(old != code)
                for sign, codes in ((1, code), (-1, old)):
                    if codes is None:
                        continue
                    codes, own = codes[changed], x[changed]
                    for e, n in enumerate(np.bincount(codes, minlength=entries).tolist()):
                        total[p, e, _ROWS] += sign * n
                    for j in range(w):
                        if x.dtype == object:
                            for e, v in zip(codes.tolist(), own[:, j], strict=True):
                                total[p, e, j] += sign * v
                        else:  # whole numbers whose sum is one, too
                            for e, v in enumerate(np.bincount(codes, own[:, j], entries).tolist()):
                                total[p, e, j] += sign * int(v)
                if needs[p] is not None:
                    for z, n in enumerate(np.bincount(needs[p]).tolist()):
                        total[p, z, _NEEDED] += n
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("v"), _fixed(new),
                                              pa.nulls(batch.num_rows, schema.field("changes").type)], schema=schema)
        changes = [{"part": p, "entry": e, "place": j, "limb": k, "value": v}
                   for (p, e, j), value in total.items() for k, v in _limbs(value)]
        if changes:
            last = {"changes": pa.array([changes], schema.field("changes").type)}
            yield pa.RecordBatch.from_arrays([last.get(c, pa.nulls(1, schema.field(c).type)) for c in schema.names], schema=schema)

    return run


def _coded(books: Codebooks, schema: pa.Schema) -> Callable:
    """The code and error of every vector for the last codebooks."""
    parts, w = len(books.entries), books.width

    def run(batches):
        yield from given_back(rows(batches))

    def rows(batches):
        for batch in batches:
            raw = _matrix(batch.column("v"), parts * w)
            new, pieces, _ = books.assign(raw, _state(batch.column("state"), _layout(books.tracked)))
            error = np.zeros(len(raw), dtype=object)
            for p, x in enumerate(pieces):
                entries = np.array(books.entries[p], dtype=object if x.dtype == object else np.float64).reshape(len(books.entries[p]), w)
                own = x - entries[new["code"][:, p]]
                error += np.array([int(d) for d in (own * own).sum(axis=1)], dtype=object)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([c.tobytes().hex() for c in new["code"]], pa.string()),
                 pa.array([min(int(e), _LARGEST) for e in error], pa.int64())], schema=schema)

    return run


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(``id_col``, code, error, label_error, codebooks_sha256) for every usable row of ``vectors``.

    ``code`` has two hex digits a part; ``error`` is the squared distance of
    the vector to its entries, ``label_error`` its sum over rows of one label
    (rows without one together); ``codebooks_sha256`` is a digest of all
    entries, the same in every row. Codebooks start as the rows with the
    smallest ids, ascending (ties by the vector, rows without an id last).

    Rows whose vector is null or holds a null or a component that isn't
    finite are left out. Shorter vectors are filled up with zeros, and all of
    them up to a multiple of ``parts`` components. Fewer rows than entries:
    so many entries. Components of any finite size are exact; an error over
    the largest long is given as that. Repeated rows count each; any id and
    label is allowed; other columns play no part. No usable row: no rows.
    """
    spark = vectors.sparkSession
    kept = vectors.where(usable(F.col(vector_col))).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    fields = {c: kept.schema[c].dataType for c in ("id", "label", "v")}
    names = {c: t.simpleString() for c, t in fields.items()}
    result = "id {id}, label {label}, code string, error long".format(**names)
    components = kept.agg(F.max(F.size("v")).alias("n")).first()["n"]
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return (spark.createDataFrame([], result).withColumnRenamed("id", id_col).drop("label")
                .withColumns({"label_error": F.lit(0).cast("long"), "codebooks_sha256": F.lit("")}))
    w = -(-components // parts)
    start = [[whole(x, scale) for x in r["v"]] + [0] * (parts * w - len(r["v"])) for r in first]
    books = Codebooks([[v[p * w:(p + 1) * w] for v in start] for p in range(parts)], w, scale)

    change = pa.struct([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())])
    arrow = [(c, to_arrow_type(t)) for c, t in fields.items()]
    schema = pa.schema([*arrow, ("state", pa.binary()), ("changes", pa.list_(change))])
    columns = ("id {id}, label {label}, v {v}, state binary, "
               "changes array<struct<part:int,entry:int,place:int,limb:int,value:long>>").format(**names)
    sums: Counter = Counter()
    paths: list[str] = []
    table = kept
    try:
        for _ in range(rounds):
            paths.append(folder(spark))
            table.mapInArrow(_round(books, schema), columns).write.parquet(paths[-1])
            after = spark.read.schema(columns).parquet(paths[-1])
            told = (after.where("changes is not null").select(F.explode("changes").alias("c"))
                    .groupBy("c.part", "c.entry", "c.place", "c.limb").agg(F.sum("c.value").alias("value")).collect())
            needed = [Counter() for _ in range(parts)]
            for r in told:  # a number a part, entry and component, and its limbs
                if r["place"] == _NEEDED:
                    needed[r["part"]][r["entry"]] += r["value"] << _LIMB * r["limb"]
                else:
                    sums[r["part"], r["entry"], r["place"]] += r["value"] << _LIMB * r["limb"]
            books.started = True
            new = [[[sums[p, e, j] // sums[p, e, _ROWS] for j in range(w)] if sums[p, e, _ROWS] else old
                    for e, old in enumerate(part)] for p, part in enumerate(books.entries)]
            same = new == books.entries
            books.replace(new, needed)
            table = after.where("changes is null")
            if len(paths) > 1:
                removed(spark, paths.pop(0))
            if same:  # no later round would change anything
                break
        coded_schema = pa.schema([*arrow[:2], ("code", pa.string()), ("error", pa.int64())])
        coded = saved(table.mapInArrow(_coded(books, coded_schema), result))
    finally:
        for path in paths:
            removed(spark, path)
    digest = hashlib.sha256(",".join(str(x) for part in books.entries for e in part for x in e).encode()).hexdigest()
    whole_error = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LARGEST).cast("decimal(38,0)")).cast("long")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(whole_error.alias("label_error"))
    return (coded.join(by_label, coded["label"].eqNullSafe(by_label["of"]))
            .select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))


def _sql(rounds: int = ROUNDS) -> str:
    """Every distance of every round, without bounds."""
    steps, book = [], "c0"
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT row, p, min(struct_pack(d := list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))),
                                 k := c.k)) AS best
  FROM v JOIN {book} c USING (p) GROUP BY row, p)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (
  SELECT p, k, j, CAST((s - (s % n + n) % n) // n AS BIGINT) AS x
  FROM (SELECT p, best.k AS k, j, sum(e[j]) AS s, count(*) AS n
        FROM a{r} JOIN v USING (row, p), (SELECT unnest(generate_series(1, width // {PARTS})) AS j FROM size) GROUP BY ALL)),
c{r + 1} AS MATERIALIZED (
  SELECT p, k, coalesce((SELECT list(x ORDER BY j) FROM s{r} s WHERE s.p = c.p AND s.k = c.k), e) AS e FROM {book} c)""")
            book = f"c{r + 1}"
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id, embedding) AS row FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
size AS (SELECT max(len(embedding)) AS width FROM kept),
v AS MATERIALIZED (
  SELECT row, p, list_transform(embedding[p * (width // {PARTS}) + 1:(p + 1) * (width // {PARTS})],
                                lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM kept, size, (SELECT unnest(generate_series(0, {PARTS - 1})) AS p)),
c0 AS MATERIALIZED (SELECT p, row - 1 AS k, e FROM v WHERE row <= {ENTRIES}),{','.join(steps)},
codes AS (
  SELECT row, string_agg(printf('%02x', best.k), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY row),
digest AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM {book})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (row), digest
"""


OP11_SQL = _sql()
