"""Near-duplicate embeddings by range search in a robust-pruned flat graph.

Vectors go to the shards of their two nearest centroids, so shards overlap. Centroids are found in the space around the mean, so vectors that all
point one way fall into as many shards as others. In each shard a flat graph is built: candidate neighbours, those that fall into the same leaves of a few
random trees or are their neighbours, and a few far ones, are pruned so that no kept edge is made needless by a much nearer kept one. A vector's
adjacency lists from both its shards are united: where an edge leaves the shard, its far end comes along. Then every vector of
the shard is searched for, greedily from the shard's medoids and its own node, and from what is in range (or nearly) the
search expands until it finds no more. All that is found is verified in doubles, and recall is audited on a sample: where it falls short, the work
is done again with a wider search, and in the end without a graph, by comparing all blocks of a label.

Exact copies are one node. A shard with more than CAP members is dealt out as pairs of blocks, each a shard of its own. A pair of vectors
that share several shards is counted in one of them alone, so tasks return counts and a forest, never all pairs of a
group; only pairs that share no shard are put out one by one.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stage
from .components import connected_components

LOG = logging.getLogger(__name__)
THRESHOLD = 0.93
#: The search goes on from a vector that is so much less similar than the threshold; in a shard whose vectors are alike on average, by as much less.
MARGIN = 0.1
#: Vectors for each centroid; centroids at most; least and greatest size of the sample that they are chosen from (8 for each centroid between), and its bytes.
PER_CENTROID, MAX_CENTROIDS, SAMPLE, MAX_SAMPLE, SAMPLE_BYTES = 4096, 16384, 16384, 131_072, 128 << 20
#: Numbers of a matrix of similarities that is held at once.
CELLS = 1 << 23
#: Random trees, and members of a leaf at most.
TREES, LEAF = 6, 64
#: Members of a shard, or of each of a pair of blocks.
CAP = 2048
#: Out-edges, far edges among them, near candidates, pruning factor, beam, medoids.
DEGREE, FAR, NEAR, ALPHA, BEAM, MEDOIDS = 24, 4, 48, 1.2, 16, 8
#: Vectors that are compared with all others, and the share of their links that must have been found.
AUDIT, LEAST_RECALL = 256, 0.95
MEMBER = "h1 long, h2 long, label string, node long, w long, v binary, c1 int, c2 int"


def unit_rows(batches: Iterator) -> Iterator:
    """mapInArrow: (vec_id, label, embedding) -> (vec_id, label, v): unit vectors as doubles; null where the vector can't link."""
    import pyarrow as pa

    for batch in batches:
        vs = []
        for vec_id, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            v, unit = v.values, None
            if vec_id is not None and label is not None and v is not None and len(v) and not v.null_count:
                x = v.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
                    x = x / top  # no overflow or underflow of the squares
                    unit = (x / np.sqrt(x @ x)).astype("<f8").tobytes()
            vs.append(unit)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(vs, pa.binary())], names=["vec_id", "label", "v"])


def matrix(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def leaders(x: np.ndarray, k: int, apart: float) -> np.ndarray:
    """Up to k rows of x, no two nearer than `apart`, in the order of x: a tight group has one, however many vectors it has."""
    chosen = np.zeros((0, x.shape[1]), x.dtype)
    for lo in range(0, len(x), 256):
        part = x[lo : lo + 256]
        part = part[(part @ chosen.T).max(axis=1) < apart] if len(chosen) else part
        near, own = part @ part.T, []
        for i in range(len(part)):
            if not own or near[i, own].max() < apart:
                own.append(i)
        chosen = np.concatenate([chosen, part[own]])
        if len(chosen) >= k:
            break
    return chosen[:k]


def nearest(x: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """The n nearest rows of c for each row of x, nearest first; a block of rows at a time."""
    out = np.empty((len(x), n), np.int32)
    step = max(1, CELLS // len(c))
    for lo in range(0, len(x), step):
        sims = x[lo : lo + step] @ c.T
        best = np.argpartition(-sims, n - 1, axis=1)[:, :n]
        order = np.argsort(-np.take_along_axis(sims, best, axis=1), axis=1, kind="stable")
        out[lo : lo + step] = np.take_along_axis(best, order, axis=1)
    return out


def choose_centroids(x: np.ndarray, k: int, apart: float = THRESHOLD, rounds: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(mean, k unit centroids at most in the space around it), by spherical k-means from leaders; x: unit vectors."""
    start = leaders(x, k, apart)
    mean = start.mean(axis=0)
    size = lambda y: np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9).astype(y.dtype)
    y, c = x - mean, start - mean
    y, c = y / size(y), c / size(c)
    for _ in range(rounds if len(c) > 1 else 0):
        own = nearest(y, c, 1)[:, 0]
        sums = np.zeros_like(c)
        np.add.at(sums, own, y)
        c = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 1e-6, sums / size(sums), c)
    return mean, c


def assign_rows(centroids: dict[int, tuple[np.ndarray, np.ndarray]]):
    """mapInArrow: nodes -> MEMBER: the two nearest centroids of the vector's dimension (-1 without a second)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            vs = batch.column(5).to_pylist()
            size = np.fromiter(map(len, vs), np.int64, len(vs))
            c1, c2 = np.zeros(len(vs), np.int32), np.full(len(vs), -1, np.int32)
            for d in np.unique(size):
                mean, c = centroids.get(int(d), (None, ()))
                if len(c) > 1:
                    at = np.flatnonzero(size == d)
                    two = nearest((matrix([vs[i] for i in at]) - mean).astype(np.float32), c, 2)
                    c1[at], c2[at] = two[:, 0], two[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(c1), pa.array(c2)], names=[x.split()[0] for x in MEMBER.split(", ")])

    return run


def robust_prune(x: np.ndarray, candidates: np.ndarray, sims: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """candidates [n, c] with their similarities, nearest first (-1: none) -> kept [n, degree], -1 where there are fewer."""
    n, c = candidates.shape
    out = np.full((n, degree), -1, np.int64)
    for lo in range(0, n, 256):
        cand, far = candidates[lo : lo + 256], np.sqrt(np.maximum(0, 2 - 2 * sims[lo : lo + 256]))
        y = x[np.maximum(cand, 0)]
        between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nid,njd->nij", y, y, optimize=True)))
        alive, rows = cand >= 0, np.arange(len(cand))
        for slot in range(degree):
            first = alive.argmax(axis=1)
            some = alive[rows, first]
            if not some.any():
                break
            out[lo + rows[some], slot] = cand[rows[some], first[some]]
            alive &= ~((alpha * between[rows, first] <= far) & some[:, None])
            alive[rows, first] = False
    return out


def tree_leaves(x: np.ndarray, rng: np.random.Generator, leaf: int = LEAF) -> list[np.ndarray]:
    """The leaves of a random tree over x: a node is cut in halves by the direction between two of its members."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        own = todo.pop()
        if len(own) <= leaf:
            out.append(own)
            continue
        a, b = rng.choice(own, 2, replace=False)
        side = x[own] @ (x[a] - x[b])
        order = np.argsort(side + 1e-9 * rng.random(len(own)).astype(x.dtype), kind="stable")  # equal ones are cut by chance
        todo += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    return out


def best_of(x: np.ndarray, cand: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
    """The `near` nearest of each row's candidates (-1: none), nearest first, each once, with their similarities."""
    n = len(x)
    ids, sims = np.full((n, near), -1, np.int64), np.full((n, near), -9.0, np.float32)
    step = max(1, CELLS // (cand.shape[1] * x.shape[1]))
    for lo in range(0, n, step):
        c = np.sort(cand[lo : lo + step], axis=1)
        c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
        c[c == np.arange(lo, lo + len(c))[:, None]] = -1
        s = np.where(c >= 0, np.einsum("nd,nkd->nk", x[lo : lo + step], x[np.maximum(c, 0)]), np.float32(-9))
        top = np.argsort(-s, axis=1, kind="stable")[:, :near]
        ids[lo : lo + step, : top.shape[1]] = np.take_along_axis(c, top, axis=1)
        sims[lo : lo + step, : top.shape[1]] = np.take_along_axis(s, top, axis=1)
    return ids, sims


def candidates(x: np.ndarray, near: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Near candidates of each row: the best of its leaves in each tree, then of their own best ones too."""
    per = min(near, 12)
    lists = []
    for _ in range(TREES):
        found = np.full((len(x), per), -1, np.int64)
        for own in tree_leaves(x, rng):
            if len(own) > 1:
                s = x[own] @ x[own].T
                np.fill_diagonal(s, -9)
                k = min(per, len(own) - 1)
                found[own, :k] = own[np.argpartition(-s, k - 1, axis=1)[:, :k]]
        lists.append(found)
    ids, _ = best_of(x, np.concatenate(lists, axis=1), near)
    few = ids[:, : min(6, near)]
    further = np.where(few[:, :, None] >= 0, ids[np.maximum(few, 0)][:, :, :8], -1).reshape(len(x), -1)
    return best_of(x, np.concatenate([ids, further], axis=1), near)


def build_graph(x: np.ndarray, seed: int) -> np.ndarray:
    """Adjacency [n, 2 * DEGREE] of a flat graph over unit vectors x, -1 where a list is shorter."""
    n = len(x)
    rng = np.random.default_rng(seed)
    near, z = min(NEAR, n - 1), x.astype(np.float32)
    if near <= 0:
        return np.full((n, 2 * DEGREE), -1, np.int64)
    close = robust_prune(z, *candidates(z, near, rng), DEGREE - FAR, ALPHA)
    far = rng.integers(0, n, (n, FAR))
    far[far == np.arange(n)[:, None]] = -1
    out = np.concatenate([close, far], axis=1)
    # Reverse edges, as far as there is room.
    src, dst = np.nonzero(out >= 0)[0], out[out >= 0]
    back_src, back_dst = dst, src
    order = np.argsort(back_src, kind="stable")
    back_src, back_dst = back_src[order], back_dst[order]
    nth = np.arange(len(back_src)) - np.searchsorted(back_src, back_src)
    fits = nth < DEGREE
    back = np.full((n, DEGREE), -1, np.int64)
    back[back_src[fits], nth[fits]] = back_dst[fits]
    return np.concatenate([out, back], axis=1)


def scaled(margin: float, x: np.ndarray) -> float:
    """The margin in proportion to how far the mean similarity of x is from 1."""
    mean = x.mean(axis=0, dtype=np.float64)
    return margin * max(0.0, 1 - float(mean @ mean))


def medoids(x: np.ndarray, number: int) -> np.ndarray:
    """The member nearest to the mean, and those nearest to the means around a few spread members."""
    seeds = [int((x @ x.mean(axis=0)).argmax())]
    near = x @ x[seeds[0]]
    for _ in range(min(number, len(x)) - 1):
        seeds.append(int(near.argmin()))
        near = np.maximum(near, x @ x[seeds[-1]])
    own = (x @ x[seeds].T).argmax(axis=1)
    out = {seeds[0]}
    for i in range(len(seeds)):
        members = np.flatnonzero(own == i)
        if len(members):
            out.add(int(members[(x[members] @ x[members].mean(axis=0)).argmax()]))
    return np.array(sorted(out))


def range_search(x: np.ndarray, queries: int, adjacency: np.ndarray, threshold: float, margin: float = MARGIN, beam_size: int = BEAM) -> np.ndarray:
    """Which of all nodes each of the first `queries` nodes finds in range: bool [queries, n].

    All queries walk at once: a greedy beam from the medoids and the query's own node, then an expansion through every node that
    is in range or within the margin."""
    n = len(x)
    z = x.astype(np.float32)
    seen, found = np.zeros((queries, n), bool), np.zeros((queries, n), bool)
    reach = threshold - scaled(margin, x[:queries])
    starts = medoids(x[:queries], MEDOIDS)
    q = np.arange(queries)
    ids = np.concatenate([np.tile(starts, (queries, 1)), q[:, None]], axis=1)
    ids[:, :-1][ids[:, :-1] == q[:, None]] = -1
    sims = np.where(ids >= 0, np.einsum("qd,qkd->qk", z[:queries], z[np.maximum(ids, 0)]), -9.0)
    beam, beam_sims = np.full((queries, beam_size), -1, np.int64), np.full((queries, beam_size), -9.0, np.float32)
    done = np.ones((queries, beam_size), bool)
    open_pairs: list[np.ndarray] = []

    def note(rows: np.ndarray, nodes: np.ndarray, s: np.ndarray) -> None:
        """Marks nodes as seen; those near enough are where the expansion starts."""
        seen[rows, nodes] = True
        hit = s >= threshold - 1e-4
        found[rows[hit], nodes[hit]] = True
        go = s >= reach
        open_pairs.append(rows[go] * n + nodes[go])

    r, c = np.nonzero(ids >= 0)
    note(r, ids[r, c], sims[r, c])
    new_ids, new_sims, rows = ids, sims, q
    for _ in range(3 * beam_size):
        # Merge what is new into the beams, take each beam's best node that wasn't expanded, and look at its neighbours.
        all_ids = np.concatenate([beam[rows], new_ids], axis=1)
        all_sims = np.concatenate([beam_sims[rows], new_sims], axis=1)
        all_done = np.concatenate([done[rows], new_ids < 0], axis=1)
        top = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam_size]
        beam[rows], beam_sims[rows], done[rows] = (np.take_along_axis(a, top, axis=1) for a in (all_ids, all_sims, all_done))
        rows = np.flatnonzero(~done.all(axis=1))
        if not len(rows):
            break
        pick = (~done[rows]).argmax(axis=1)
        at = beam[rows, pick]
        done[rows, pick] = True
        new_ids = adjacency[at].copy()
        new_ids[np.take_along_axis(seen[rows], np.maximum(new_ids, 0), axis=1)] = -1
        new_ids.sort(axis=1)
        new_ids[:, 1:][new_ids[:, 1:] == new_ids[:, :-1]] = -1
        new_sims = np.full(new_ids.shape, -9.0, np.float32)
        r, c = np.nonzero(new_ids >= 0)
        for lo in range(0, len(r), 1 << 18):
            rr, cc = r[lo : lo + (1 << 18)], c[lo : lo + (1 << 18)]
            s = np.einsum("kd,kd->k", z[rows[rr]], z[new_ids[rr, cc]])
            new_sims[rr, cc] = s
            note(rows[rr], new_ids[rr, cc], s)
    while open_pairs:
        pairs = np.concatenate(open_pairs)
        open_pairs.clear()
        for lo in range(0, len(pairs), 1 << 16):
            part = pairs[lo : lo + (1 << 16)]
            nb = adjacency[part % n]
            codes = np.where(nb >= 0, (part // n)[:, None] * n + nb, -1).ravel()
            codes = codes[codes >= 0]
            codes = np.unique(codes[~seen.ravel()[codes]])
            if len(codes):
                rr, cc = codes // n, codes % n
                note(rr, cc, np.einsum("kd,kd->k", z[rr], z[cc]))
        open_pairs[:] = [p for p in open_pairs if len(p)]
    r, c = np.nonzero(found)
    for lo in range(0, len(r), 1 << 18):  # verify in doubles
        rr, cc = r[lo : lo + (1 << 18)], c[lo : lo + (1 << 18)]
        found[rr, cc] = np.einsum("kd,kd->k", x[rr], x[cc]) >= threshold
    return found


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Roots of n nodes after joining all pairs."""
    parent = np.arange(n)
    while len(a):
        ra, rb = parent[a], parent[b]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        open_ = parent[a] != parent[b]
        a, b = a[open_], b[open_]
    return parent


LISTS = "label string, shard int, i int, j int, src long, dsts binary, dst long, v binary, w long, c1 int, c2 int"


def build_rows(table):
    """applyInArrow over one shard (or pair of blocks): LISTS. Rows with dsts are the shard's own lists. The others carry edges to the other
    shard of their source (i and j null there), with the far end's vector, if that isn't a member there and near enough to matter."""
    import pyarrow as pa

    table = table.sort_by([("node", "ascending"), ("h1", "ascending")])
    label, shard, i, j = (table.column(k)[0].as_py() for k in ("label", "shard", "i", "j"))
    node, v = table.column("node").to_numpy(), table.column("v").to_pylist()
    w, c1, c2 = (table.column(k).to_numpy() for k in ("w", "c1", "c2"))
    rows: list[tuple] = []
    size = np.fromiter(map(len, v), np.int64, len(v))
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        x = matrix([v[k] for k in at])
        graph = build_graph(x, shard)
        lists = np.where(graph >= 0, node[at][graph], -1)
        for k, own in enumerate(at):
            rows.append((label, shard, i, j, int(node[own]), lists[k][graph[k] >= 0].astype("<i8").tobytes(), None, None, None, None, None))
        src, slot = np.nonzero(graph >= 0)
        dst = graph[src, slot]
        s, t = at[src], at[dst]
        other = np.where(c1[s] == shard, c2[s], c1[s])
        leaves = (other >= 0) & (c1[t] != other) & (c2[t] != other)
        src, dst, other = src[leaves], dst[leaves], other[leaves]
        near = np.einsum("kd,kd->k", x[src], x[dst]) >= THRESHOLD - 2 * scaled(MARGIN, x)
        for a, b, o in zip(at[src[near]], at[dst[near]], other[near]):
            rows.append((label, int(o), None, None, int(node[a]), None, int(node[b]), v[b], int(w[b]), int(c1[b]), int(c2[b])))
    types = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32())
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[x.split()[0] for x in LISTS.split(", ")])


FOUND = "kind int, a long, b long, wa long, wb long"


def compare_all(x: np.ndarray, queries: int, threshold: float) -> np.ndarray:
    """What range_search finds, without a graph: bool [queries, n]."""
    found = np.empty((queries, len(x)), bool)
    step = max(1, CELLS // len(x))
    for lo in range(0, queries, step):
        found[lo : lo + step] = x[lo : min(queries, lo + step)] @ x.T >= threshold
    found[np.arange(queries), np.arange(queries)] = True
    return found


def search_rows(threshold: float, margin: float = MARGIN, beam_size: int = BEAM, exact: bool = False):
    """Cogrouped Arrow function over (members, lists) of one shard: FOUND. kind 0: node a has b more links, with wa other nodes; 1: an edge of the forest; 2: a linked pair
    that shares no shard."""

    def run(members, lists):
        import pyarrow as pa

        out: list[np.ndarray] = []

        def put(kind: int, a, b, wa=None, wb=None) -> None:
            if len(a):
                zero = np.zeros(len(a), np.int64)
                out.append(np.stack([np.full(len(a), kind), a, b, zero if wa is None else wa, zero if wb is None else wb]).astype(np.int64))

        if members.num_rows:
            members = members.sort_by([("node", "ascending"), ("h1", "ascending")])
            shard, i, j = (members.column(k)[0].as_py() for k in ("shard", "i", "j"))
            node, v = members.column("node").to_numpy(), members.column("v").to_pylist()
            w, c1, c2, own = (members.column(k).to_numpy() for k in ("w", "c1", "c2", "own"))
            mine = {r["src"]: r["dsts"] for r in lists.select(["src", "dsts"]).to_pylist() if r["dsts"] is not None}
            guests = [r for r in lists.to_pylist() if r["dsts"] is None]
            size = np.fromiter(map(len, v), np.int64, len(v))
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                n = len(at)
                place = {int(x): k for k, x in enumerate(node[at])}
                far = {g["dst"]: g for g in guests if len(g["v"]) == d and g["src"] in place and g["dst"] not in place}
                far_ids = sorted(far)
                where = place | {x: n + k for k, x in enumerate(far_ids)}
                x = matrix([v[k] for k in at] + [far[f]["v"] for f in far_ids])
                own_lists = [[where[t] for t in np.frombuffer(mine.get(int(s), b""), "<i8").tolist() if t in where] for s in node[at]] + [[] for _ in far_ids]
                for g in guests:  # the union of the lists from both shards
                    if g["dst"] in far and g["src"] in place:
                        own_lists[place[g["src"]]].append(where[g["dst"]])
                        own_lists[where[g["dst"]]].append(place[g["src"]])
                width = max(map(len, own_lists), default=0)
                graph = np.full((len(x), max(1, width)), -1, np.int64)
                for k, list_ in enumerate(own_lists):
                    graph[k, : len(list_)] = list_
                found = compare_all(x, n, threshold) if exact else range_search(x, n, graph, threshold, margin, beam_size)
                inside, cross = found[:, :n], found[:, n:]
                inside |= inside.T.copy()
                # A pair is counted in the least shard that both are members of, in the pair of its blocks.
                a1, a2, blk = c1[at], c2[at], own[at]
                a, b = np.nonzero(np.triu(inside, 1))
                big = np.iinfo(np.int32).max
                least = np.full(len(a), big)
                for p in (a1, a2):
                    for q in (a1, a2):
                        same = (p[a] == q[b]) & (p[a] >= 0)
                        least = np.minimum(least, np.where(same, p[a], big))
                counted = (least == shard) & (np.minimum(blk[a], blk[b]) == i) & (np.maximum(blk[a], blk[b]) == j)
                ca, cb, ww = a[counted], b[counted], w[at].astype(np.float64)
                links = (np.bincount(ca, ww[cb], n) + np.bincount(cb, ww[ca], n)).astype(np.int64)
                some = links > 0
                near = np.bincount(ca, minlength=n) + np.bincount(cb, minlength=n)
                put(0, node[at][some], links[some], near[some])
                root = forest(a, b, n)
                moved = root != np.arange(n)
                put(1, node[at][moved], node[at][root[moved]])
                ca, cb = np.nonzero(cross)
                if len(ca):
                    g1, g2, gw = (np.array([far[f][k] for f in far_ids]) for k in ("c1", "c2", "w"))
                    shared = np.zeros(len(ca), bool)
                    for p in (a1, a2):
                        for q in (g1, g2):
                            shared |= (p[ca] == q[cb]) & (p[ca] >= 0)
                    ca, cb = ca[~shared], cb[~shared]
                    put(2, node[at][ca], np.array(far_ids)[cb], w[at][ca], gw[cb])
        data = np.concatenate(out, axis=1) if out else np.zeros((5, 0), np.int64)
        return pa.Table.from_arrays([pa.array(data[0].astype(np.int32)), *[pa.array(c) for c in data[1:]]], names=[x.split()[0] for x in FOUND.split(", ")])

    return run


def prepare(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: vec_id, label, h1, h2 (null: takes no part); nodes: h1, h2, label, node, w, v)."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stage(arrow_map(rows, unit_rows, "vec_id long, label string, v binary"), "emb-rows")
    on = F.col("v").isNotNull()
    rows = rows.withColumn("h1", F.when(on, F.xxhash64("label", "v"))).withColumn("h2", F.when(on, F.xxhash64("v", F.lit(1), "label")))
    nodes = rows.where("v is not null").groupBy("h1", "h2", "label", "vec_id").agg(F.first("v").alias("v"))
    nodes = nodes.groupBy("h1", "h2", "label").agg(F.min("vec_id").alias("node"), F.count("*").alias("w"), F.first("v").alias("v"))
    return rows.drop("v"), stage(nodes, "emb-nodes")


def link_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, cap: int = CAP, per_centroid: int = PER_CENTROID, margin: float = MARGIN, beam_size: int = BEAM, audit: int = AUDIT, least_recall: float = LEAST_RECALL, wider: int = 2, exact: bool = False) -> DataFrame:
    """One row per row of embeddings: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components, rows with null label, and rows without vec_id link with nothing.
    A sample of about `audit` vectors is compared with all, and the recall is logged; links between vectors that differ count, each once, however many copies.
    Below `least_recall` the work is done again with larger clusters, margin and beam, `wider` times at most, and then with `exact`: no clusters and no graph, all
    blocks of a label are compared. Rows that repeat a vec_id with the same vector and label are one vector. Labels may be any type that casts to string; other
    columns don't matter, whatever their names. Vectors of other dimensions don't link. Empty table: no rows."""
    spark = embeddings.sparkSession
    rows, nodes = prepare(embeddings)
    n, longest = nodes.agg(F.count("*"), F.max(F.length("v"))).first()
    hashed = F.pmod(F.xxhash64("h2"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    k, by_size = min(MAX_CENTROIDS, max(1, -(-n // per_centroid))), {}
    centroids = {}
    if k > 1 and not exact:
        wanted = min(MAX_SAMPLE, max(SAMPLE, 8 * k), max(1024, SAMPLE_BYTES // longest))
        sample = nodes.where(hashed < F.lit(min(1.0, wanted / max(1, n)))).orderBy("h2", "h1").select("v").toArrow().column("v")
        for v in sample:
            by_size.setdefault(len(v.as_py()), []).append(np.frombuffer(v.as_py(), "<f8").astype(np.float32))
        centroids = {d: choose_centroids(np.stack(v), k) for d, v in by_size.items()}
    members = arrow_map(nodes, assign_rows(centroids), MEMBER)
    members = members.withColumn("shard", F.explode(F.filter(F.array("c1", "c2"), lambda c: c >= 0)))
    members = stage(members, "emb-members")
    sizes = members.groupBy("label", "shard").agg(F.ceil(F.count("*") / F.lit(cap)).cast("int").alias("blocks"))
    sizes = stage(sizes, "emb-sizes")
    dealt = members.join(sizes, ["label", "shard"]).withColumn("own", F.pmod("h1", F.col("blocks").cast("long")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "blocks")
    dealt = stage(dealt, "emb-dealt")
    key = ["label", "shard", "i", "j"]
    lists = (dealt.limit(0) if exact else dealt).groupBy(*key).applyInArrow(build_rows, LISTS)
    lists = stage(lists, "emb-lists")
    guests = lists.where("dsts is null").drop("i", "j").join(sizes, ["label", "shard"]).withColumn("i", F.lit(0)).drop("blocks")
    guests = guests.join(dealt.where("i = j").select("label", "shard", F.col("node").alias("src"), F.col("i").alias("block")).distinct(), ["label", "shard", "src"])
    guests = guests.withColumn("i", F.col("block")).withColumn("j", F.col("block")).drop("block")
    lists = lists.where("dsts is not null").unionByName(guests)
    found = dealt.groupBy(*key).cogroup(lists.groupBy(*key)).applyInArrow(search_rows(threshold, margin, beam_size, exact), FOUND)
    found = stage(found, "emb-found")
    cross = found.where("kind = 2").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("wa")).otherwise(F.col("wb")).alias("wa"), F.when(F.col("a") < F.col("b"), F.col("wb")).otherwise(F.col("wa")).alias("wb")).dropDuplicates(["a", "b"])
    counts = found.where("kind = 0").select("a", F.col("b").alias("links"), F.col("wa").alias("near")).union(cross.select("a", F.col("wb"), F.lit(1))).union(cross.select("b", F.col("wa"), F.lit(1)))
    counts = counts.groupBy("a").agg(F.sum("links").alias("links"), F.sum("near").alias("near")).withColumnRenamed("a", "c_node")
    comp = connected_components(found.where("kind > 0").select("a", "b"))
    named = nodes.select("h1", "h2", "node", "w").join(counts, F.col("node") == F.col("c_node"), "left").select("h1", "h2", "node", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("near", F.lit(0)).alias("near"))
    named = named.join(comp.withColumnRenamed("node", "k_node"), F.col("node") == F.col("k_node"), "left").select("h1", "h2", "n_links", "near", F.coalesce("component", "node").alias("component_id"))
    if audit:
        named = stage(named, "emb-named")
        got, there = audit_nodes(nodes.withColumn("w", F.lit(1)), named.select("h1", F.col("near").alias("n_links")), threshold, audit)
        LOG.info("%d of %d links of sampled vectors were found%s", got, there, " by comparing all" if exact else "")
        if got < least_recall * there and not exact:
            if not wider:
                return link_vectors(embeddings, threshold, cap, audit=audit, least_recall=least_recall, wider=0, exact=True)
            return link_vectors(embeddings, threshold, cap, 2 * per_centroid, 2 * margin, 4 * beam_size, audit, least_recall, wider - 1)
    out = rows.join(named, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def audit_nodes(nodes: DataFrame, n_links: DataFrame, threshold: float, queries: int) -> tuple[int, int]:
    """(links found, links there are) of about `queries` nodes, each compared with all. n_links: h1, n_links."""
    hashed = F.pmod(F.xxhash64("h1"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = min(1.0, queries / max(1, nodes.count()))
    chosen = [(r["h1"], r["label"], bytes(r["v"])) for r in nodes.where(hashed < F.lit(share)).select("h1", "label", "v").collect()]
    places: dict[tuple[str, int], list[int]] = {}
    for k, (_, label, v) in enumerate(chosen):
        places.setdefault((label, len(v)), []).append(k)
    groups = {key: (np.array([chosen[k][0] for k in ks]), matrix([chosen[k][2] for k in ks])) for key, ks in places.items()}

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total: dict[int, int] = {}
        for batch in batches:
            for label, v, w in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                if (label, len(v)) in groups:
                    ids, q = groups[label, len(v)]
                    for i in ids[q @ np.frombuffer(v, "<f8") >= threshold].tolist():
                        total[i] = total.get(i, 0) + w
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["h1", "n"])

    there = arrow_map(nodes.select("label", "v", "w"), count, "h1 long, n long").groupBy("h1").agg((F.sum("n") - 1).alias("there"))
    got = there.join(n_links, "h1").agg(F.sum(F.least("n_links", "there")), F.sum("there")).first()
    return int(got[0] or 0), int(got[1] or 0)


def audit_recall(embeddings: DataFrame, linked: DataFrame, threshold: float = THRESHOLD, queries: int = AUDIT) -> tuple[int, int]:
    """(links found, links there are) of a sample of about `queries` vectors of a result of link_vectors."""
    rows, nodes = prepare(embeddings)
    n_links = rows.where("h1 is not null").join(linked, "vec_id").groupBy("h1").agg(F.first("n_links").alias("n_links"))
    return audit_nodes(nodes, n_links, threshold, queries)


def oracle() -> str:
    """All pairs and what they reach, in DuckDB SQL; for small tables."""
    return """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x != 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id != b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM reach r JOIN p ON r.b = p.a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a),
c AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(c.b, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(c.b, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN c ON vec_id = c.a"""
