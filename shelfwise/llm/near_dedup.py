"""Near-duplicate groups by SetSketch registers, banded, estimated by likelihood, verified.

A document is the set of its distinct word shingles. Its sketch has
``REGISTERS`` registers: each keeps the minimum of an exponential variate
over the set, on a logarithmic scale of base ``BASE`` truncated to 16 bits
(registers of a union are the larger ones, so sketches merge). Two sets
agree in a register about as often as their Jaccard similarity J.

1. Equal sets are one node from here on, so groups of exact copies, however
   large, cost one row each.
2. Four registers make a band; nodes that share a band's value share a
   bucket. A pair with J >= 0.75 shares none of the 32 bands with
   probability (1 - 0.75**4)**32 = 5e-6.
3. In every bucket each node is held against the smallest one: first the
   joint likelihood of both sketches (pairs estimated more than
   ``SLACK`` standard errors under the threshold go), then the full sets.
   The links found give components.
4. What is left are buckets whose nodes lie in different components. A node
   leaves such a bucket if too few of its shingles occur in any other node
   left, whatever its partner there. The rest of a bucket is compared in
   blocks of bounded size, skipping pairs already connected. So every pair
   that shares a bucket and is not connected yet is decided on full sets;
   there is no cap on bucket sizes and no pair table.

Shingles are 64-bit hashes; two different ones, or two different sets, are
taken for equal with probability 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.graph import components, saved
from shelfwise.llm.words import given_back, mix, slices, utf8, window_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 75  # per cent
REGISTERS, BAND = 128, 4
BASE, RATE = 1.001, 20.0
LIMIT = 65535
SLACK = 5.5
#: Nodes, and shingles of all its nodes, in a block of step 4, about.
BLOCK, BLOCK_SHINGLES = 2048, 2_000_000
#: Rows, and sets, in a partition of an intermediate table, about.
ROWS, SETS = 200_000, 10_000
#: Rounds of the support test of step 4; more only save comparisons.
SUPPORT_ROUNDS = 2

_random = np.random.Generator(np.random.PCG64(424242))
_FLIP = _random.integers(0, 2**64, size=REGISTERS, dtype=np.uint64)
_FACTOR = _random.integers(0, 2**63, size=REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(offsets: np.ndarray, data: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    words, bounds = word_hashes(offsets, data, fold=True)
    hashes = window_hashes(words, size)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(hashes[a:b - size + 1]))
        elif b > a:
            out.append(window_hashes(words[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(words[:0])
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers of non-empty sets: one row of ``REGISTERS`` 16-bit values each."""
    out = np.empty((len(sets), REGISTERS), dtype=np.uint64)
    at = 0
    while at < len(sets):  # blocks that stay in the processor's cache
        upto, size = at, 0
        while upto < len(sets) and (size == 0 or size + len(sets[upto]) <= 1 << 15):
            size += len(sets[upto])
            upto += 1
        values = np.concatenate(sets[at:upto])
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[at:upto]])[:-1]]).astype(np.int64)
        spare = np.empty_like(values)
        for k in range(REGISTERS):
            np.bitwise_xor(values, _FLIP[k], out=spare)
            np.multiply(spare, _FACTOR[k], out=spare)
            out[at:upto, k] = np.minimum.reduceat(spare, starts)
        at = upto
    uniform = (out.astype(np.float64) + 1) / 2.0**64
    minima = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(minima) / np.log(BASE)), 0, LIMIT).astype(np.uint16)


_GRID = np.linspace(0, 1, 201)


def estimated_similarity(one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketch pairs (rows) with known set sizes."""
    above = (one > other).sum(axis=-1)[:, None]
    below = (one < other).sum(axis=-1)[:, None]
    equal = one.shape[-1] - above - below
    u = (n_one / (n_one + n_other))[:, None]
    v = 1 - u
    grid = _GRID[None, :] * np.minimum(u / v, v / u)

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log(1 - np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)

    more, less = chance(u - v * grid), chance(v - u * grid)
    tiny = 1e-12
    likelihood = (above * np.log(np.maximum(more, tiny)) + below * np.log(np.maximum(less, tiny))
                  + equal * np.log(np.maximum(1 - more - less, tiny)))
    return np.take_along_axis(grid, likelihood.argmax(axis=1)[:, None], axis=1)[:, 0]


def _least_estimate(threshold: int) -> float:
    t = threshold / 100
    return t - SLACK * (t * (1 - t) / REGISTERS) ** 0.5


def _linked(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= threshold * (len(a) + len(b) - common)


def _released(run):
    return lambda batches: given_back(run(batches))


def _nodes(sets: list[np.ndarray]) -> np.ndarray:
    """A number for each set, the same for equal sets."""
    sums = np.array([mix(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
    return mix(sums + np.array([len(s) for s in sets], dtype=np.uint64)).view(np.int64)


def _sketch(size: int):
    def run(batches):
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            for a, b in slices(offsets):
                sets = shingle_sets(offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]], size)
                full = [i for i, s in enumerate(sets) if len(s)]
                regs = np.zeros((len(sets), REGISTERS), dtype=np.uint16)
                if full:
                    regs[full] = registers([sets[i] for i in full])
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(a, b - a), batch.column("key").slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(_nodes(sets), pa.int64()),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                ], names=["id", "key", "n", "node", "regs"])

    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            for a, b in slices(offsets):
                sets = shingle_sets(offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]], size)
                own = _nodes(sets) == batch.column("node").slice(a, b - a).to_numpy()  # not another text of the same id
                at = pa.array(a + np.flatnonzero(own))
                yield pa.RecordBatch.from_arrays([
                    batch.column("node").take(at), batch.column("n").take(at), batch.column("regs").take(at),
                    pa.array([s.tobytes() for s, k in zip(sets, own.tolist(), strict=True) if k], pa.binary()),
                ], names=["node", "n", "regs", "shingles"])

    return run


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)


def _verify(threshold: int):
    least = _least_estimate(threshold)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n1, n2 = batch.column("n").to_numpy(), batch.column("n2").to_numpy()
            near = estimated_similarity(_matrix(batch.column("regs")), _matrix(batch.column("regs2")), n1, n2) >= least
            one, two = batch.column("shingles"), batch.column("shingles2")
            keep = [i for i in np.flatnonzero(near).tolist()
                    if _linked(np.frombuffer(one[i].as_py(), np.uint64), np.frombuffer(two[i].as_py(), np.uint64), threshold)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(pa.array(keep, pa.int64())), batch.column("b").take(pa.array(keep, pa.int64()))],
                names=["a", "b"])

    return run


def _explode_shingles(batches):
    """One row a shingle of each set."""
    for batch in batches:
        sizes = batch.column("n").to_numpy()
        values = np.frombuffer(b"".join(batch.column("shingles").to_pylist()), dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column("node").to_numpy(), sizes), pa.int64()), pa.array(values, pa.int64())],
            names=["node", "shingle"])


def _compare_blocks(threshold: int):
    """Links between two blocks of a bucket (or within one) that join different components."""
    least = _least_estimate(threshold)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending"), ("node", "ascending")])
        band = table.column("bucket")[0].as_py() & (REGISTERS // BAND - 1)
        block = table.column("block").to_numpy()
        second = block != min(table.column("low")[0].as_py(), table.column("high")[0].as_py())
        same = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        node, comp, n = (table.column(c).to_numpy() for c in ("node", "component", "n"))
        regs = _matrix(table.column("regs"))
        bands = regs.view(np.uint64)
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        comp = comp.copy()
        links = []
        for i in range(len(node)):
            if second[i]:
                break
            other = np.arange(i + 1, len(node)) if same else np.flatnonzero(second)
            other = other[comp[other] != comp[i]]
            if not len(other):
                continue
            other = other[(bands[other] == bands[i]).argmax(axis=1) == band]  # decided in their first common band
            if not len(other):
                continue
            near = estimated_similarity(np.broadcast_to(regs[i], (len(other), REGISTERS)), regs[other],
                                        np.full(len(other), n[i]), n[other]) >= least
            for j in other[near].tolist():
                if comp[j] != comp[i] and _linked(sets[i], sets[j], threshold):
                    links.append((node[i], node[j]))
                    comp[comp == comp[j]] = comp[i]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """(``id_col``, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked if 100 * |A n B| >= threshold * |A u B| over their
    distinct shingles of ``shingle`` words (words are split at ASCII white
    space, A-Z lower-cased; a text of fewer words is one shingle).
    ``component_id`` is the smallest id that links reach, and ``kept`` says
    that it is the row's own.

    Null or empty text, or one without words: an empty set, linked with
    nothing. Repeated rows are in one component. A null id is its own
    component unless a link reaches another. Other columns of ``docs`` play
    no part. An empty table gives an empty table.
    """
    return _grouped(docs, id_col, text_col, shingle, threshold).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, threshold: int) -> DataFrame:
    """(id, key, n, component, component_id) for every row.

    ``key`` is a hash of id and text; ``component`` a number, null for a row without words.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketches = saved(rows.select("id", F.xxhash64("id", "text").alias("key"), "text").mapInArrow(
        _released(_sketch(shingle)), f"id {id_type}, key long, n long, node long, regs binary"))
    nodes = sketches.where("n > 0").groupBy("node").agg(F.min("id").alias("first"), F.min("key").alias("key"), F.max("n").alias("n"),
                                                        F.max("regs").alias("regs"))
    # a bucket is a hash of the band's registers whose lowest bits name the band; dealt once, used twice
    width, bands = 2 * BAND, REGISTERS // BAND
    banded = nodes.select("node", F.explode(F.array(*[
        F.xxhash64(F.substring("regs", 1 + k * width, width)).bitwiseAND(-bands).bitwiseOR(k) for k in range(bands)
    ])).alias("bucket")).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "bucket")
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("center")).where("size > 1")
    members = saved(banded.join(shared.drop("size"), "bucket"), ROWS)
    candidates = members.select("node").distinct().join(nodes, "node")
    # by key: an id may be null, or stand for several texts
    texts = rows.select(F.xxhash64("id", "text").alias("key"), "text").join(candidates.select("key", "node", "n", "regs"), "key")
    sets = saved(texts.select("node", "n", "regs", "text").mapInArrow(
        _released(_sets(shingle)), "node long, n long, regs binary, shingles binary").groupBy("node")
        .agg(F.max("n").alias("n"), F.max("regs").alias("regs"), F.max("shingles").alias("shingles")), SETS)

    pairs = members.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("regs").alias("regs2"),
                        F.col("shingles").alias("shingles2"))
    links = (pairs.join(sets.withColumnRenamed("node", "a"), "a").join(right, "b")
             .select("a", "b", "n", "n2", "regs", "regs2", "shingles", "shingles2")
             .mapInArrow(_verify(threshold), "a long, b long"))
    found = saved(components(links), ROWS)

    left = _open(members.select("bucket", "node").join(found, "node", "left")
                 .withColumn("component", F.coalesce("component", "node")).join(sets.select("node", "n"), "node"))
    for _ in range(SUPPORT_ROUNDS):
        left = saved(left, ROWS)
        alone = (sets.join(left.select("node").distinct(), "node").select("node", "n", "shingles")
                 .mapInArrow(_explode_shingles, "node long, shingle long")
                 .groupBy("shingle").agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1")
                 .groupBy("node").agg(F.count("*").alias("alone")))
        # |A n B| >= t/(1+t) (|A|+|B|), so a partner of a node with s shared shingles has at most (1+t)/t s - |A|
        reach = (left.join(alone, "node", "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
                 .withColumn("most", F.col("n") - F.col("alone") + (F.col("n") - F.col("alone")) * 100 / threshold - F.col("n")))
        smallest = left.groupBy("bucket").agg(F.min("n").alias("low"))
        left = _open(reach.join(smallest, "bucket").where("most >= low - 1e-6")
                     .select("bucket", "node", "component", "n"))
    left = saved(left, ROWS)
    sized = left.join(left.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("shingles")), "bucket")
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    paired = (sized.withColumn("blocks", blocks).withColumn("block", block)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                      "block", "node", "component")
              .join(sets, "node"))
    more = paired.groupBy("bucket", "low", "high").applyInArrow(_compare_blocks(threshold), "a long, b long")
    label = found.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    label2 = found.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    merged = components(more.join(label, "a", "left").join(label2, "b", "left")
                        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    group = (nodes.select("node", "first").join(found, "node", "left")
             .withColumn("component", F.coalesce("component", "node"))
             .join(merged.select(F.col("node").alias("component"), F.col("component").alias("final")), "component", "left")
             .select("node", "first", F.coalesce("final", "component").alias("component")))
    smallest_id = group.groupBy("component").agg(F.min("first").alias("component_id"))
    named = group.join(smallest_id, "component").select("node", "component", "component_id")
    return (sketches.select("id", "key", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
            .join(named, "node", "left")
            .select("id", "key", "n", "component", F.coalesce("component_id", "id").alias("component_id")))


def _open(members: DataFrame) -> DataFrame:
    """The rows of buckets whose nodes lie in more than one component."""
    mixed = (members.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
             .where("c1 <> c2").select("bucket"))
    return members.join(mixed, "bucket")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row of each near-duplicate group, of the smallest id (a null id comes last, equal ids by their hash
    with the text); of repeated rows one.

    Rows without words are in no group and stay. All columns are kept.
    """
    found = _grouped(docs, id_col, text_col, shingle, threshold)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))["key"]
    keep = (found.where(F.col("component").isNotNull()).groupBy("component").agg(first.alias("__key")).select("__key")
            .unionByName(found.where(F.col("component").isNull()).select(F.col("key").alias("__key")).distinct()))
    return (docs.withColumn("__key", F.xxhash64(id_col, text_col)).join(keep, "__key", "left_semi")
            .dropDuplicates(["__key"]).drop("__key"))


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, gram FROM (
    SELECT doc_id, array_to_string(words[s:s + 4], ' ') AS gram
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS s FROM d WHERE len(words) >= 5)
    UNION ALL
    SELECT doc_id, array_to_string(words, ' ') FROM d WHERE len(words) BETWEEN 1 AND 4)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT x, y FROM common JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
  WHERE 100 * c >= 75 * (sx.n + sy.n - c)),
edges AS MATERIALIZED (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT x AS doc_id, x AS to_id FROM edges
  UNION
  SELECT r.doc_id, e.y FROM reach r JOIN edges e ON r.to_id = e.x),
comp AS (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles,
       CAST(coalesce(comp.component_id, d.doc_id) AS BIGINT) AS component_id,
       coalesce(comp.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN sizes ON d.doc_id = sizes.doc_id LEFT JOIN comp ON d.doc_id = comp.doc_id
"""
