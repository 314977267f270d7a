"""Exact top-k search by inner product over a pivot-distance index.

Vectors x (integer components) get one more coordinate, sqrt(M^2 - |x|^2) with
M the largest norm, and queries q a zero there; then
d(q, x)^2 = |q|^2 + M^2 - 2 q.x, so the k highest scores are the k nearest.
Every vector is keyed by its nearest pivot and its distance to it; range-sorted
by that key, the index is cut into blocks, each an annulus of one pivot.
By the triangle inequality d(q, x) >= |d(q, p) - d(x, p)|, an annulus can
only hold scores up to (|q|^2 + M^2 - gap^2) / 2.

Queries go in chunks.  A chunk first visits the annuli of each query's
nearest pivot at the query's own distance, which gives every query a k-th
score; then it visits the annuli whose bound reaches that score, and no
others.  Scores are exact integers; bounds are widened by a rounding margin.

Pivots (farthest-first) are fitted on the `sample` vectors with the smallest
hash of their id; all rows are indexed.

Defined results: rows whose id or vector is NULL, or whose vector holds a NULL
or non-finite component, take no part.  Shorter vectors count as padded with
zeros.  Repeated rows are rows of their own: each is a candidate for the
other.  Ties go to the smaller id.  Fewer than k candidates: all of them.  An
empty table gives no rows.  Finite components so large that a score could leave
62 bits are refused with an error: the score column is a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import map_batches, materialize

K = 5
EVERY = 50
SCALE = 256
PIVOTS = 32
SAMPLE = 2048
BLOCK = 2048           # vectors a block
CHUNK = 512            # queries a chunk
_IDX = 12              # bits of a row number within a block
_LOW = -(1 << 62)
_KEYED = 1 << 48       # smaller scores, of either sign, leave room for a row number


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component; unusable rows left out."""
    x = F.col(vec_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return (table.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"), F.coalesce(bad, F.lit(True)).alias("bad"))
            .filter("vec_id IS NOT NULL AND x IS NOT NULL AND NOT bad")
            .select("vec_id", F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c)).alias("v")))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of a list column as int64, padded with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    n = np.diff(column.offsets.to_numpy())
    if len(n) and (n == dims).all():
        return flat.reshape(-1, dims).astype(np.int64)
    out = np.zeros((len(n), dims), np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def pivots_of(x: np.ndarray, norm2: float, n: int = PIVOTS) -> np.ndarray:
    """Farthest-first pivots among the sample, with the extra coordinate."""
    a = _lift(x, norm2)
    chosen = [0]
    gap = ((a - a[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(a)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((a - a[chosen[-1]]) ** 2).sum(axis=1))
    return a[chosen]


def _lift(x: np.ndarray, norm2: float) -> np.ndarray:
    x = x.astype(float)
    return np.column_stack([x, np.sqrt(np.maximum(norm2 - (x * x).sum(axis=1), 0))])


def _distances(a: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d2 = (a * a).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * a @ pivots.T
    return np.sqrt(np.maximum(d2, 0))


def _packed(rows: DataFrame, size: int, same_pivot: bool, dims: int) -> DataFrame:
    """Blocks of up to `size` rows of (pivot, dist, vec_id, uid, v), range-sorted
    by (pivot, dist, vec_id); within a block by vec_id."""
    keys = ["pivot", "dist", "vec_id", "uid"]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*keys, "v")

    def cut(batches):
        part, seq, held = TaskContext.get().partitionId(), 0, None

        def out(cols):
            nonlocal seq
            order = np.lexsort((cols[3], cols[2]))
            block = (part << 20) | seq
            seq += 1
            return {"block": [block], "pivot": [int(cols[0][0])], "lo": [float(cols[1].min())], "hi": [float(cols[1].max())],
                    "ids": [cols[2][order].tobytes()], "uids": [cols[3][order].tobytes()],
                    "vecs": [np.ascontiguousarray(cols[4][order]).tobytes()]}

        for b in batches:
            cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(4)] + [
                np.array([np.frombuffer(v.as_buffer(), np.int64) for v in b.column(4)]).reshape(-1, dims)]
            if held is not None:
                cols = [np.concatenate(c) for c in zip(held, cols, strict=True)]
            while len(cols[0]):
                n = min(size, len(cols[0]))
                if same_pivot:
                    n = min(n, int(np.searchsorted(cols[0], cols[0][0], "right")))
                if n == len(cols[0]) and n < size:
                    break
                yield out([c[:n] for c in cols])
                cols = [c[n:] for c in cols]
            held = cols
        if held is not None and len(held[0]):
            yield out(held)

    return map_batches(ranged, cut, "block long, pivot int, lo double, hi double, ids binary, uids binary, vecs binary")


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, n_pivots: int = PIVOTS, sample: int = SAMPLE,
          block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score for rows of integer_vectors(); queries are
    the rows whose id is divisible by `every`."""
    if not 0 < block <= 1 << _IDX:
        raise ValueError(f"a block holds 1 to {1 << _IDX} vectors")
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    sq = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    top = F.aggregate("v", F.lit(0.0), lambda s, c: F.greatest(s, F.abs(c.cast("double"))))
    stats = vectors.agg(F.max(sq).alias("norm2"), F.max(F.size("v")).alias("dims"), F.max(top).alias("top")).first()
    if stats.dims is None:
        return spark.createDataFrame([], schema)
    dims, norm2 = max(1, stats.dims), stats.norm2
    if dims * stats.top ** 2 >= 2 ** 62:
        raise ValueError(f"scores of components up to {stats.top:g} in {dims} dimensions don't fit into a long")
    exact_floats = dims * stats.top ** 2 < 2 ** 53
    few = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    fit = np.zeros((len(few), dims), np.int64)
    for i, r in enumerate(few):
        fit[i, :len(r.v)] = r.v
    shared = spark.sparkContext.broadcast(pivots_of(fit, norm2, n_pivots))   # n_pivots * (dims + 1) * 8 bytes
    slack = 1e-6 * (1 + np.sqrt(norm2))

    def keyed(batches):
        for b in batches:
            x = _matrix(b.column(1), dims)
            d = _distances(_lift(x, norm2), shared.value)
            near = d.argmin(axis=1)
            yield {"pivot": near, "dist": d[np.arange(len(x)), near], "vec_id": b.column(0), "uid": np.zeros(len(x), np.int64),
                   "v": [r.tobytes() for r in x]}

    row = "pivot int, dist double, vec_id long, uid long, v binary"
    index = materialize(_packed(map_batches(vectors, keyed, row), block, True, dims), "op3-index")

    def queries(batches):
        """The query rows of the index, keyed by their own place (q, 0)."""
        for b in batches:
            cols = {n: b.column(b.schema.get_field_index(n)) for n in ("block", "ids", "vecs")}
            for i in range(b.num_rows):
                ids = np.frombuffer(cols["ids"][i].as_buffer(), np.int64)
                mine = np.flatnonzero(ids % every == 0)
                if len(mine):
                    x = np.frombuffer(cols["vecs"][i].as_buffer(), np.int64).reshape(-1, dims)[mine]
                    d = _distances(np.column_stack([x, np.zeros(len(x))]).astype(float), shared.value)
                    near = d.argmin(axis=1)
                    yield {"pivot": near, "dist": d[np.arange(len(x)), near], "vec_id": ids[mine],
                           "uid": (cols["block"][i].as_py() << _IDX) | mine, "v": [r.tobytes() for r in x]}

    asked = _packed(map_batches(index.select("block", "ids", "vecs"), queries, row), chunk, False, dims)

    def reach(batches):
        """Per chunk, the range of its queries' distances to each pivot."""
        for b in batches:
            at = {n: b.column(b.schema.get_field_index(n)) for n in ("block", "ids", "uids", "vecs")}
            low, high, home, biggest = [], [], [], []
            for v in at["vecs"]:
                x = np.frombuffer(v.as_buffer(), np.int64).reshape(-1, dims).astype(float)
                d = _distances(np.column_stack([x, np.zeros(len(x))]), shared.value)
                near = d.argmin(axis=1)
                low.append((d.min(axis=0) - slack).tolist())
                high.append((d.max(axis=0) + slack).tolist())
                home.append([bool((near == p).any()) for p in range(d.shape[1])])
                biggest.append(float((x * x).sum(axis=1).max()))
            yield {"chunk": at["block"], "q_ids": at["ids"], "q_uids": at["uids"], "q_vecs": at["vecs"],
                   "low": low, "high": high, "home": home, "q2": biggest}

    chunks = materialize(map_batches(asked, reach, "chunk long, q_ids binary, q_uids binary, q_vecs binary, low array<double>, "
                                     "high array<double>, home array<boolean>, q2 double"), "op3-chunks")
    annuli = index.select("block", "pivot", "lo", "hi")
    sides = chunks.select("chunk", "q2", F.posexplode(F.arrays_zip("low", "high", "home")).alias("pivot", "s")).select(
        "chunk", "q2", "pivot", "s.*")
    pairs = sides.join(annuli, "pivot").withColumn(
        "gap", F.greatest(F.col("lo") - F.col("high"), F.col("low") - F.col("hi"), F.lit(0.0)))

    def visit(pairs: DataFrame, floors: DataFrame | None) -> DataFrame:
        """Top k of each query within each visited annulus, at or above its floor."""
        bounded = floors is not None
        left = pairs.select("chunk", "block").join(
            chunks.select("chunk", "q_ids", "q_uids", "q_vecs") if floors is None
            else chunks.select("chunk", "q_ids", "q_uids", "q_vecs").join(floors, "chunk"), "chunk")
        rows = left.join(index.select("block", "pivot", "lo", "hi", "ids", "uids", "vecs"), "block")
        names = ["block", "pivot", "lo", "hi", "ids", "vecs", "q_ids", "q_uids", "q_vecs"] + (["floor_uids", "floors"] if bounded else [])

        def search(batches):
            for b in batches:
                at = {n: b.column(k) for k, n in enumerate(names)}
                get = lambda n, i: np.frombuffer(at[n][i].as_buffer(), np.int64)  # noqa: B023, E731
                for i in range(b.num_rows):
                    ids, x = get("ids", i), get("vecs", i).reshape(-1, dims)
                    q_ids, q_uids, q = get("q_ids", i), get("q_uids", i), get("q_vecs", i).reshape(-1, dims)
                    floor = np.full(len(q), _LOW, np.int64)
                    if bounded:
                        known = dict(zip(at["floor_uids"][i].as_py(), at["floors"][i].as_py(), strict=True))
                        floor = np.array([known.get(u, _LOW) for u in q_uids.tolist()], np.int64)
                        d = _distances(np.column_stack([q, np.zeros(len(q))]).astype(float), shared.value)[:, at["pivot"][i].as_py()]
                        gap = np.maximum(np.maximum(at["lo"][i].as_py() - d, d - at["hi"][i].as_py()) - slack, 0)
                        bound = ((q.astype(float) ** 2).sum(axis=1) + norm2 - gap * gap) / 2
                        go = np.flatnonzero(bound + 1e-6 * (1 + norm2) >= floor)
                        q_ids, q_uids, q, floor = q_ids[go], q_uids[go], q[go], floor[go]
                    if len(q):
                        yield _best(ids, x, at["block"][i].as_py(), q_ids, q_uids, q, floor, k, exact_floats)

        return map_batches(rows.select(*names), search, "query_id long, uid long, vec_id long, score long")

    seeds = materialize(visit(pairs.filter("home AND gap = 0"), None), "op3-seeds")
    best = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    kth = seeds.withColumn("n", F.row_number().over(best)).filter(F.col("n") == k).select("uid", F.col("score").alias("floor"))
    owner = _owners(chunks)
    floors = owner.join(kth, "uid", "left").withColumn("floor", F.coalesce("floor", F.lit(_LOW))).groupBy("chunk").agg(
        F.collect_list("uid").alias("floor_uids"), F.collect_list("floor").alias("floors"))
    floors = materialize(floors, "op3-floors")
    least = floors.select("chunk", F.array_min("floors").alias("least"))
    rest = pairs.filter("NOT (home AND gap = 0)").join(least, "chunk").filter(
        (F.col("q2") + norm2 - F.col("gap") * F.col("gap")) / 2 + 1e-6 * (1 + norm2) >= F.col("least"))
    found = seeds.unionByName(visit(rest, floors))
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _owners(chunks: DataFrame) -> DataFrame:
    """(chunk, uid) of every query."""
    def run(batches):
        for b in batches:
            for c, u in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                uids = np.frombuffer(u.as_buffer(), np.int64)
                yield {"chunk": np.full(len(uids), c), "uid": uids}
    return map_batches(chunks.select("chunk", "q_uids"), run, "chunk long, uid long")


def _best(ids, x, block, q_ids, q_uids, q, floor, k, exact_floats) -> dict:
    """The k best (ties to the smaller id) of one block for each query."""
    score = (q.astype(float) @ x.T.astype(float)).astype(np.int64) if exact_floats else q @ x.T
    short = -_KEYED < score.min(initial=0) and score.max(initial=0) < _KEYED
    own = np.flatnonzero(q_uids >> _IDX == block)
    score[own, q_uids[own] & ((1 << _IDX) - 1)] = _LOW
    n = len(ids)
    if short and n > k:                  # rows ascend by id: one key holds score and place
        order = (score << _IDX) + (n - 1 - np.arange(n))
        order[own, q_uids[own] & ((1 << _IDX) - 1)] = np.iinfo(np.int64).min
        col = np.argpartition(order, n - k, axis=1)[:, n - k:]
    else:
        col = np.argsort(-score, axis=1, kind="stable")[:, :k]
    value = np.take_along_axis(score, col, axis=1)
    row, at = np.nonzero((value > _LOW) & (value >= floor[:, None]))
    return {"query_id": q_ids[row], "uid": q_uids[row], "vec_id": ids[col[row, at]], "score": value[row, at]}


def query(embeddings: DataFrame) -> DataFrame:
    return top_k(integer_vectors(embeddings))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) t
WHERE rank <= 5"""
