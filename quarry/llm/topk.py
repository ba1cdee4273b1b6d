"""Exact top-k by inner product over norm-sorted vectors.

Vectors are range-partitioned by descending length into slabs. A task meets one block of queries with one slab and walks the slab from
its longest vector on. Cauchy-Schwarz bounds end the walk for a query: |q| |x| below its k-th best score so far. In
the slab's SVD basis, where the first coordinates hold most of the length, a partial sum plus the product of what is left of both
lengths bounds every single product; what may still reach the k-th best is computed in full, in integers: pair by pair, or, where
the bounds leave many pairs of a step, as one product of matrices. The k best of the very longest vectors give every query a
bound to start with.

The slabs are walked in waves, from the longest vectors on, each wave twice as large as the one before. A query meets a slab only if the length of
both can reach its k-th best score after all waves so far; queries are put in blocks by the length of vectors that they still need, so a slab is sent to
the first blocks alone, and a wave that no query needs ends the search. A pair of a block and a slab returns k rows a query at most, none
below the query's bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, inf

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, stage

K, QUERY_MOD, SCALE = 20, 20, 64
#: Candidates of a slab, queries of a block, vectors that are looked at together, longest vectors that give the first bounds.
SLAB, BLOCK, STEP, SEEDS = 16384, 4096, 1024, 1024
#: Slabs of a wave at most.
WAVE = 1024
#: Share of a step's pairs that pass the bound from which the whole step is computed.
DENSE = 0.02
#: Inner products below this are exact in doubles.
EXACT = float(1 << 53)


def scaled_rows(scale: int):
    """mapInArrow: (vec_id, embedding) -> (vec_id, v, norm): floor(scale * x) as doubles, little-endian. Vectors that are null or empty or hold null or
    non-finite components are left out."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, vs, norms = [], [], []
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = v.values
                if vec_id is None or v is None or v.null_count or not len(v):
                    continue
                x = np.floor(v.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                if np.isfinite(x).all():
                    ids.append(vec_id)
                    vs.append(x.astype("<f8").tobytes())
                    norms.append(float(np.sqrt(x @ x)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vs, pa.binary()), pa.array(norms, pa.float64())], names=["vec_id", "v", "norm"])

    return run


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of the rows of q and x, pair by pair, as longs; beyond a long's range they stay at its ends."""
    if not len(q):
        return np.zeros(0, np.int64)
    if float((np.abs(q).max() if q.size else 0) * (np.abs(x).max() if x.size else 0)) * q.shape[1] < EXACT:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    ends = (-(1 << 63), (1 << 63) - 1)
    return np.array([min(ends[1], max(ends[0], sum(int(a) * int(b) for a, b in zip(u, v)))) for u, v in zip(q, x)], np.int64)


class Best:
    """The k best (score, id) of each query so far: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.q, self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least = np.full(n, -np.inf)

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(q):
            return
        q, ids, scores = np.concatenate([self.q, q]), np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, ~scores, q))  # ~s is -s - 1: descending without overflow
        q, ids, scores = q[order], ids[order], scores[order]
        first = np.searchsorted(q, q)
        kept = np.arange(len(q)) - first < self.k
        self.q, self.ids, self.scores = q[kept], ids[kept], scores[kept]
        last = np.arange(len(self.q)) - np.searchsorted(self.q, self.q) == self.k - 1
        self.least[self.q[last]] = np.maximum(self.least[self.q[last]], self.scores[last].astype(np.float64))


def distinct(q_ids: np.ndarray, x_ids: np.ndarray, a: np.ndarray, b: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) without the queries' own ids."""
    other = q_ids[a] != x_ids[b]
    return a[other], x_ids[b[other]], scores[other]


def search(q_ids: np.ndarray, q: np.ndarray, start: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int, step: int = STEP) -> Best:
    """x: candidates by descending length. start: a lower bound of each query's k-th score."""
    best = Best(len(q), k)
    best.least = np.maximum(best.least, start)
    if not len(x) or not len(q):
        return best
    q_norm, x_norm = np.sqrt((q * q).sum(axis=1)), np.sqrt((x * x).sum(axis=1))
    _, basis = np.linalg.eigh(x.T @ x)  # right singular vectors, by ascending singular value
    basis = basis[:, ::-1]
    head = max(1, x.shape[1] // 4)
    rq, rx = q @ basis, x @ basis
    q_rest, x_rest = np.sqrt((rq[:, head:] ** 2).sum(axis=1)), np.sqrt((rx[:, head:] ** 2).sum(axis=1))
    exact = float(np.abs(q).max() * np.abs(x).max()) * x.shape[1] < EXACT
    slack = 1e-9 * float(q_norm.max()) * float(x_norm.max()) + 1e-6
    for lo in range(0, len(x), step):
        on = np.flatnonzero(q_norm * x_norm[lo] >= best.least - slack)
        if not len(on):
            break  # all further vectors are shorter
        hi = min(len(x), lo + step)
        bound = rq[on, :head] @ rx[lo:hi, :head].T + q_rest[on, None] * x_rest[None, lo:hi]
        alive = bound >= best.least[on, None] - slack
        if exact and alive.mean() > DENSE:  # then one product of matrices is cheaper than many of vectors; all its sums are whole numbers
            full = q[on] @ x[lo:hi].T
            a, b = np.nonzero(alive & (full >= best.least[on, None]))
            best.add(*distinct(q_ids, x_ids, on[a], b + lo, full[a, b].astype(np.int64)))
            continue
        a, b = np.nonzero(alive)
        for part in range(0, len(a), 1 << 17):
            qa, xb = on[a[part : part + (1 << 17)]], b[part : part + (1 << 17)] + lo
            scores = products(q[qa], x[xb])
            able = scores.astype(np.float64) >= best.least[qa]
            best.add(*distinct(q_ids, x_ids, qa[able], xb[able], scores[able]))
    return best


def unpack(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def by_dimension(values) -> dict[int, np.ndarray]:
    """Places of the vectors by their number of bytes: vectors meet only those of their own dimension."""
    size = np.fromiter(map(len, values), np.int64, len(values))
    return {int(d): np.flatnonzero(size == d) for d in np.unique(size)}


def start_rows(seeds: list[tuple[int, bytes]], k: int):
    """mapInArrow: (vec_id, v, norm) -> (vec_id, v, norm, start): the k-th best score among the longest vectors."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seed_ids, seed_v = np.array([s for s, _ in seeds], np.int64), [v for _, v in seeds]
        groups = by_dimension(seed_v)
        for batch in batches:
            ids, vs = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            start = np.full(len(ids), -np.inf)
            for d, at in by_dimension(vs).items():
                if d in groups and len(groups[d]) > k:
                    x = unpack([seed_v[i] for i in groups[d]])
                    for lo in range(0, len(at), BLOCK):
                        part = at[lo : lo + BLOCK]
                        start[part] = search(ids[part], unpack([vs[i] for i in part]), np.full(len(part), -np.inf), seed_ids[groups[d]], x, k).least
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(start)], names=["vec_id", "v", "norm", "start"])

    return run


def meet(k: int):
    """Cogrouped Arrow function over (query rows, candidate rows) of one block and slab."""

    def run(left, right):
        import pyarrow as pa

        out: list[list] = [[], [], [], []]
        q_ids, q_key = left.column("vec_id").to_numpy(), left.column("q_key").to_numpy()
        start, qv = left.column("start").to_numpy(), left.column("v").to_pylist()
        right = right.sort_by([("norm", "descending"), ("vec_id", "ascending")])
        x_ids, xv = right.column("vec_id").to_numpy(), right.column("v").to_pylist()
        groups = by_dimension(xv)
        for d, at in by_dimension(qv).items():
            if d in groups:
                best = search(q_ids[at], unpack([qv[i] for i in at]), start[at], x_ids[groups[d]], unpack([xv[i] for i in groups[d]]), k)
                for column, v in zip(out, (q_ids[at][best.q], q_key[at][best.q], best.ids, best.scores)):
                    column.append(v)
        arrays = [pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for v in out]
        return pa.Table.from_arrays(arrays, names=["query_id", "q_key", "vec_id", "score"])

    return run


def needed() -> Column:
    """The length of a vector from which it can reach the query's bound; what rounding may hide is taken off."""
    reach = (F.col("start") - 1e-6) / F.col("norm") / (1 + 1e-9)
    return F.when((F.col("norm") == 0) | (F.col("start") == -inf), F.lit(-inf)).otherwise(reach)


def wave_rows(ready: DataFrame, slabs: DataFrame, wave: list[tuple[int, float]], k: int, block: int) -> DataFrame | None:
    """query_id, q_key, vec_id, score: what the queries find in the slabs of a wave (number, greatest length; longest first). None if no query needs any."""
    live = ready.withColumn("needed", needed()).where(F.col("needed") <= F.lit(wave[0][1]))
    n = live.count()
    if not n:
        return None
    live = live.repartitionByRange(ceil(n / block), F.col("needed"), F.col("q_key")).withColumn("block", F.spark_partition_id())
    live = stage(live, "topk-live")
    least = sorted(tuple(r) for r in live.groupBy("block").agg(F.min("needed")).collect())  # a row a block
    tops = F.array(*[F.lit(top) for _, top in wave])
    number = F.element_at(F.array(*[F.lit(int(s)) for s, _ in wave]), F.col("nth"))
    left = live.withColumn("nth", F.explode(F.sequence(F.lit(1), F.size(F.filter(tops, lambda t: t >= F.col("needed")))))).withColumn("slab", number)
    blocks = {s: [b for b, x in least if x <= top] for s, top in wave}
    last = F.create_map(*[F.lit(x) for s, bs in blocks.items() if bs for x in (int(s), max(bs))])
    right = slabs.where(F.col("slab").isin([int(s) for s, bs in blocks.items() if bs])).withColumn("block", F.explode(F.sequence(F.lit(0), F.element_at(last, F.col("slab")))))
    left = left.select("vec_id", "v", "start", "q_key", "slab", "block")
    return left.groupBy("slab", "block").cogroup(right.groupBy("slab", "block")).applyInArrow(meet(k), "query_id long, q_key long, vec_id long, score long")


def top_k(embeddings: DataFrame, k: int = K, query_mod: int = QUERY_MOD, scale: int = SCALE, slab: int = SLAB, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for each row whose vec_id is divisible by query_mod, against all other rows.

    embeddings: vec_id, embedding (array of numbers). Vectors that are null or empty or hold null or non-finite components, and rows without
    vec_id, take no part. Ties go to smaller ids. A query never meets its own id. Repeated rows are candidates as often as they stand;
    equal query rows are one query, rows with the same id and other vectors are queries of their own. Vectors of other
    dimensions don't meet. Other columns don't matter, whatever their names. Empty table: no rows."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    vectors = stage(arrow_map(rows, scaled_rows(scale), "vec_id long, v binary, norm double"), "topk-vectors")
    queries = vectors.where(F.pmod("vec_id", F.lit(query_mod)) == 0).select("vec_id", "v", "norm").distinct()
    sorted_ = vectors.repartitionByRange(max(1, ceil(vectors.count() / slab)), F.col("norm").desc(), F.col("vec_id")).withColumn("slab", F.spark_partition_id())
    sorted_ = stage(sorted_, "topk-slabs")
    seeds = [(r["vec_id"], bytes(r["v"])) for r in vectors.orderBy(F.col("norm").desc(), "vec_id").select("vec_id", "v").limit(SEEDS).collect()]
    ready = arrow_map(queries, start_rows(seeds, k), "vec_id long, v binary, norm double, start double")
    ready = stage(ready.withColumn("q_key", F.xxhash64("vec_id", "v")), "topk-queries")
    left = sorted((tuple(r) for r in sorted_.groupBy("slab").agg(F.max("norm")).collect()), key=lambda r: (-r[1], r[0]))  # a row a slab
    rank = F.row_number().over(Window.partitionBy("query_id", "q_key").orderBy(F.col("score").desc(), "vec_id"))
    best = embeddings.sparkSession.createDataFrame([], "query_id long, q_key long, vec_id long, score long, rank int")
    size = 1
    while left:
        found = wave_rows(ready, sorted_, left[:size], k, block)
        if found is None:
            break
        left, size = left[size:], min(WAVE, 2 * size)
        best = best.drop("rank").unionByName(found).withColumn("rank", rank).where(F.col("rank") <= k)
        if left:
            best = stage(best, "topk-best")
            bound = best.where(F.col("rank") == k).select(F.col("query_id").alias("b_id"), F.col("q_key").alias("b_key"), F.col("score").cast("double").alias("bound"))
            ready = ready.join(bound, (F.col("vec_id") == F.col("b_id")) & (F.col("q_key") == F.col("b_key")), "left")
            ready = stage(ready.withColumn("start", F.greatest("start", F.coalesce("bound", F.lit(-inf)))).drop("b_id", "b_key", "bound"), "topk-queries")
    return best.select("query_id", "rank", "vec_id", "score")


def oracle() -> str:
    return """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id != c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
