"""Embedding near-dedup and top-k search against brute force."""

import math
import random

import duckdb
import numpy as np
import pytest

from quarry.llm import embedding_dedup, topk


def brute_topk(rows, k=20, mod=20):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v and i is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, done = [], set()
    for i, q in ok:
        if i % mod or (i, tuple(q)) in done:
            continue
        done.add((i, tuple(q)))
        best = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in ok if j != i and len(c) == len(q))[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def test_topk_sf(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    want = brute_topk([(r.vec_id, r.embedding) for r in df.collect()])
    for slab, block in ((16384, 1024), (60, 7)):
        assert sorted(map(tuple, topk.top_k(df, slab=slab, block=block).collect())) == want


def test_topk_edges(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice((-1.0, -0.5, 0.0, 0.5, 1.0)) for _ in range(4)]) for i in range(90)]  # many ties
    rows += [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0]), (203, [math.nan, 0.0, 0.0, 0.0]), (204, [math.inf, 0.0, 0.0, 0.0]), (None, [1.0] * 4), (220, [0.0] * 4), (240, [1.0, 2.0]), (241, [3.0, 1.0]), (7, rows[7][1]), (20, rows[20][1]), (260, [1e9, -1e9, 3e8, 0.25])]
    df = spark.createDataFrame([(i, v, 5) for i, v in rows], "vec_id long, embedding array<double>, score int")
    assert sorted(map(tuple, topk.top_k(df, slab=16, block=3).collect())) == brute_topk(rows)
    assert topk.top_k(df.limit(0)).count() == 0


def test_short_slabs_are_never_met(spark, monkeypatch):
    rng = np.random.default_rng(5)
    # A few long vectors in all directions; thousands of short ones, which no query needs but those that are few in their slab.
    rows = [(i, (rng.normal(size=6) * (40 if i < 400 else 0.3)).tolist()) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    met, wave_rows = [], topk.wave_rows

    def spied(ready, slabs, wave, k, block):
        found = wave_rows(ready, slabs, wave, k, block)
        met.append((len(wave), found is not None))
        return found

    monkeypatch.setattr(topk, "wave_rows", spied)
    monkeypatch.setattr(topk, "SEEDS", 30)
    assert sorted(map(tuple, topk.top_k(df, slab=100, block=30).collect())) == brute_topk(rows)
    assert met[0] == (1, True) and not met[-1][1] and sum(n for n, on in met if on) < 10  # of 20 slabs


def test_pruned_search_is_exact():
    rng = np.random.default_rng(3)
    x = np.floor(64 * rng.normal(size=(400, 12)) * rng.exponential(size=(400, 1)) * np.linspace(2, 0.1, 12))
    x = x[np.argsort(-np.linalg.norm(x, axis=1), kind="stable")]
    q = x[::7]
    best = topk.search(np.arange(len(q)) + 10_000, q, np.full(len(q), -np.inf), np.arange(400), x, 5, step=32)
    full = (q @ x.T).astype(np.int64)
    want = {(i, j, full[i, j]) for i in range(len(q)) for j in np.lexsort((np.arange(400), -full[i]))[:5]}
    assert set(zip(best.q.tolist(), best.ids.tolist(), best.scores.tolist())) == want


def brute_links(rows, threshold=0.93):
    unit = {}
    for k, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            unit[k] = x / np.linalg.norm(x)
    keys = list(unit)
    linked = {k: {j for j in keys if j != k and rows[j][2] == rows[k][2] and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= threshold} for k in keys}
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in linked.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((i, len(linked.get(k, ())), min(rows[j][0] for j in seen) if i is not None else None))
    return out


def planted(rng, n, groups, dims=24):
    rows = [(i, rng.normal(size=dims).tolist(), int(rng.integers(0, 3))) for i in range(n)]
    i = n
    for size in groups:
        c, label = rng.normal(size=dims), int(rng.integers(0, 3))
        for _ in range(size):
            rows.append((i, (c + rng.normal(size=dims) * rng.choice((0.05, 0.25))).tolist(), label))
            i += 1
    return rows


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = planted(rng, 300, [2] * 20 + [5, 9, 60])
    rows += [(900, rows[0][1], rows[0][2]), (901, rows[0][1], (rows[0][2] + 1) % 3)]  # a copy, and one under another label
    df = spark.createDataFrame([(i, v, label, 1) for i, v, label in rows], "vec_id long, embedding array<double>, label int, node int")
    want = brute_links(rows)
    links = sum(n for _, n, _ in want)
    for options in ({}, {"per_centroid": 40}, {"per_centroid": 100, "cap": 30}):
        got = embedding_dedup.link_vectors(df, **options).collect()
        assert len(got) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got)
        exact = {i: (n, c) for i, n, c in want}
        assert all(r.n_links <= exact[r.vec_id][0] for r in got)  # none below the threshold
        assert sum(r.n_links for r in got) >= 0.97 * links
        if not options:  # one shard
            assert {r.vec_id: (r.n_links, r.component_id) for r in got} == exact
            with duckdb.connect() as c:
                embeddings = df.toArrow()
                c.register("embeddings", embeddings)
                assert {tuple(r) for r in got} == set(c.sql(embedding_dedup.oracle()).fetchall())
    found, there = embedding_dedup.audit_recall(df, embedding_dedup.link_vectors(df), queries=100_000)
    assert there > 0 and found >= 0.97 * there


def test_audit_counts_links_of_different_vectors_and_the_last_pass(spark, monkeypatch):
    near = [[1.0, 0.0], [1.0, 0.01], [1.0, 0.02]]
    rows = [(i, near[0], 0) for i in range(500)] + [(500 + k, v, 0) for k, v in enumerate(near[1:])] + [(600, [0.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    seen, audit_nodes = [], embedding_dedup.audit_nodes
    monkeypatch.setattr(embedding_dedup, "audit_nodes", lambda *a: seen.append(audit_nodes(*a)) or seen[-1])
    assert sorted({r.n_links for r in embedding_dedup.link_vectors(df).collect()}) == [0, 501]
    assert seen == [(6, 6)]  # three vectors, each with two others, whatever the copies
    seen.clear()
    assert sorted({r.n_links for r in embedding_dedup.link_vectors(df, least_recall=1.1, wider=1).collect()}) == [0, 501]
    assert seen == [(6, 6)] * 3  # once more, wider, and then by comparing all


def test_links_of_all_blocks_are_exact(spark):
    rows = planted(np.random.default_rng(9), 200, [2] * 20 + [5, 9, 60])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.link_vectors(df, cap=40, exact=True).collect()}
    assert got == {i: (n, c) for i, n, c in brute_links(rows)}


def crowd(n: int, dims: int, mean: float, seed: int) -> np.ndarray:
    """Unit vectors with the given mean cosine to each other; every eighth has companions that link with it."""
    rng = np.random.default_rng(seed)
    unit = lambda y: y / np.linalg.norm(y, axis=-1, keepdims=True)
    axis, own = unit(rng.normal(size=dims)), rng.normal(size=(n, dims))
    own[np.arange(n) % 8 == 3] = (own[np.arange(n) % 8 == 2] + 0.2 * rng.normal(size=(n, dims))[np.arange(n) % 8 == 2])[: (np.arange(n) % 8 == 3).sum()]
    own -= np.outer(own @ axis, axis)
    return unit(np.sqrt(mean) * axis + np.sqrt(1 - mean) * unit(own))


@pytest.mark.parametrize("mean", [0.0, 0.5, 0.8, 0.9])
def test_centroids_split_vectors_of_any_mean(mean):
    x = crowd(20_000, 64, mean, 4).astype(np.float32)
    assert abs(float((x[:2000] @ x[2000:4000].T).mean()) - mean) < 0.03
    m, c = embedding_dedup.choose_centroids(x, 64)
    sizes = np.bincount(embedding_dedup.nearest(x - m, c, 1)[:, 0], minlength=len(c))
    assert len(c) == 64 and sizes.max() < 8 * sizes.mean()
    tight = np.concatenate([x[:1] + 0.01 * np.random.default_rng(1).normal(size=(5000, 64)).astype(np.float32), x[:100]])
    assert len(embedding_dedup.leaders(tight / np.linalg.norm(tight, axis=1, keepdims=True), 5000, 0.93)) <= 101


def test_links_of_many_vectors_around_one_direction(spark):
    x = crowd(50_000, 64, 0.8, 6)
    links, comp = np.zeros(len(x), np.int64), np.arange(len(x))
    for lo in range(0, len(x), 2000):
        a, b = np.nonzero(x[lo : lo + 2000] @ x.T >= 0.93)
        a += lo
        links += np.bincount(a[a != b], minlength=len(x))
        np.minimum.at(comp, a, b)
    while (comp[comp] != comp).any():
        comp = comp[comp]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int").repartition(8)
    got = embedding_dedup.link_vectors(df, wider=0).orderBy("vec_id").toPandas()
    found = got.n_links.to_numpy()
    assert (found <= links).all() and found.sum() >= 0.95 * links.sum() and links.sum() > 10_000
    assert (got.component_id.to_numpy() == comp).mean() >= 0.99


def test_link_edges(spark):
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0), (7, [1.0, None], 0), (8, [math.nan, 1.0], 0), (9, [math.inf, 1.0], 0),
        (10, [1e308, 1e305], 0), (11, [1e-308, 0.0], 0), (None, [1.0, 0.0], 0), (12, [1.0, 0.0, 0.0], 0), (1, [1.0, 0.0], 0), (13, [0.0, 1.0], 5),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {(r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.link_vectors(df).collect()}
    assert got == {(i, 3, 1) for i in (1, 2, 10, 11)} | {(i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9, 12, 13)} | {(None, 0, None)}
    assert embedding_dedup.link_vectors(df.limit(0)).count() == 0
    assert embedding_dedup.link_vectors(df.where("label is null")).count() == 1
