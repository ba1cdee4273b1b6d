"""SimHash near-duplicates with pigeonring filtering.

A fingerprint is 64 bits in a ring of SEGMENTS segments. If two fingerprints differ in at most T bits, then from some
segment on, every chain of l consecutive segments differs in at most floor(l * T / SEGMENTS) bits (the ring form of
the pigeonhole principle). With 16 segments and T = 3 the first five segments of such a chain, 20 bits, are equal, so
these bits and the start make a join key; the budgets of longer chains prune a key's members before the full Hamming
check. Where there are very many fingerprints, keys take ten segments, of whose last five one bit may differ: the same links
from smaller groups.

Equal fingerprints are one node, so copies cost nothing. Within a key no pairs are put out: its links are joined to a
forest there, at most one edge a member. A key with more than BLOCK members is dealt out as pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, doc_text, split_by_keys, stage
from .components import connected_components

SEGMENTS, WIDTH, TOLERANCE, SHINGLE, SEED = 16, 4, 3, 3, 42
#: Members of a key that one task compares at once.
BLOCK = 8192
#: From so many distinct fingerprints on, keys are ten segments long: 336 rows a fingerprint instead of 16, which pays only where a short key has some
#: thousands of members. The links are the same.
LONG_KEYS_FROM = 1 << 33


def fingerprint_rows(shingle: int = SHINGLE, seed: int = SEED):
    """A mapInArrow function: _fp instead of the text, beside the other columns."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        digest = xxhash.xxh64_intdigest

        def fingerprint(text: bytes) -> int:
            words = text.lower().split()  # bytes: A-Z and ASCII white space only
            if not words:
                return 0
            if len(words) <= shingle:
                hashes = [digest(b" ".join(words), seed)]
            else:
                joined = b" ".join(words)
                lengths = np.fromiter(map(len, words), np.int64, len(words))
                starts = np.zeros(len(words), np.int64)
                np.cumsum(lengths[:-1] + 1, out=starts[1:])
                stops = (starts + lengths)[shingle - 1 :].tolist()
                hashes = [digest(joined[a:b], seed) for a, b in zip(starts.tolist(), stops)]
            votes, n = np.zeros(64, np.int64), len(hashes)
            for lo in range(0, n, 65536):
                part = np.array(hashes[lo : lo + 65536], "<u8")
                votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little", signed=True)

        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).cast(pa.binary())
            fps = [fingerprint(texts[k].as_py() or b"") for k in range(len(texts))]
            others = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in others], pa.array(fps, pa.int64())], names=[*[batch.schema.names[i] for i in others], "_fp"])

    return run


def ring_keys(chain: int, segments: int = SEGMENTS, width: int = WIDTH, tolerance: int = TOLERANCE):
    """A mapInArrow function: fp -> (start, key, fp), the keys of a fingerprint for each start of the ring. The first bits of a
    chain, in which nothing may differ, are in the key as they are; of those that follow, every variant with one bit changed
    is a key too."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        exact = max(n for n in range(1, segments + 1) if n * tolerance // segments == 0)
        bits, total = width * chain, np.uint64(width * segments)
        mask = np.uint64((1 << bits) - 1)
        flips = [np.uint64(0)] + [np.uint64(1 << b) for b in range(width * exact, bits)]
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for start in range(segments):
                shift = np.uint64(start * width)
                turned = (fps >> shift) | (fps << ((total - shift) % total)) if start else fps
                keys = np.concatenate([(turned & mask) ^ flip for flip in flips])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), start, np.int32)), pa.array(keys.view(np.int64)), pa.array(np.tile(fps.view(np.int64), len(flips)))], names=["start", "key", "fp"]
                )

    return run


def forest(segments: int = SEGMENTS, width: int = WIDTH, tolerance: int = TOLERANCE):
    """A mapInArrow function over rows (start, key, i, j, fp) that stand in groups of (start, key, i, j): (a, b), the edges of a forest
    that joins what the links of the group join. i, j: the pair of blocks."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        budgets = []  # (bits of the chain, differences allowed), where the budget rises
        for n in range(1, segments + 1):
            if n == segments or (n + 1) * tolerance // segments > n * tolerance // segments:
                budgets.append((width * n, n * tolerance // segments))

        def edges(start: int, fps):
            fps = np.unique(fps)
            if len(fps) < 2:
                return fps[:0], fps[:0]
            x = fps.view(np.uint64)
            shift, total = np.uint64(start * width), np.uint64(segments * width)
            turned = (x >> shift) | (x << ((total - shift) % total)) if start else x
            parent = np.arange(len(x))
            rows = max(1, (1 << 21) // len(x))
            for lo in range(0, len(x), rows):
                part = turned[lo : lo + rows]
                differ = part[:, None] ^ turned[None, lo:]
                a, b = np.nonzero(np.bitwise_count(differ & np.uint64((1 << budgets[1][0]) - 1)) <= budgets[1][1])
                a, b = a[a < b], b[a < b]
                differ = differ[a, b]
                for bits, most in budgets[2:]:
                    ok = np.bitwise_count(differ if bits == 64 else differ & np.uint64((1 << bits) - 1)) <= most
                    a, b, differ = a[ok], b[ok], differ[ok]
                a, b = a + lo, b + lo
                while len(a):  # hook roots to lesser roots and shorten paths until the links of this part are joined
                    ra, rb = parent[a], parent[b]
                    least = np.minimum(ra, rb)
                    np.minimum.at(parent, np.maximum(ra, rb), least)
                    while (parent[parent] != parent).any():
                        parent = parent[parent]
                    open_ = parent[a] != parent[b]
                    a, b = a[open_], b[open_]
            child = np.flatnonzero(parent != np.arange(len(x)))
            return fps[child], fps[parent[child]]

        held, last = [], None

        def done():
            return edges(last[0], np.concatenate(held)) if held else None

        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            n = len(cols[0])
            if not n:
                continue
            change = np.zeros(n, bool)
            for c in cols[:4]:
                change[1:] |= c[1:] != c[:-1]
            bounds = [0, *np.flatnonzero(change).tolist(), n]
            out_a, out_b = [], []
            for lo, hi in zip(bounds, bounds[1:]):
                key = tuple(int(c[lo]) for c in cols[:4])
                if key != last:
                    if got := done():
                        out_a.append(got[0])
                        out_b.append(got[1])
                    held, last = [], key
                held.append(cols[4][lo:hi])
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])
        if got := done():
            yield pa.RecordBatch.from_arrays([pa.array(got[0]), pa.array(got[1])], names=["a", "b"])

    return run


def links(distinct: DataFrame, block: int = BLOCK, long_keys_from: int = LONG_KEYS_FROM) -> DataFrame:
    """distinct fingerprints (fp) -> edges (a, b) that join exactly what pairs within the tolerance join."""
    chain = 5 if distinct.count() < long_keys_from else 10
    keyed = stage(arrow_map(distinct.select("fp"), ring_keys(chain), "start int, key long, fp long"), "simhash-keys")
    shared = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1")
    rows = keyed.join(shared, ["start", "key"])
    # A large key falls into blocks; every pair of its blocks, each with itself too, is a group of its own.
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks").cast("long")).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("start", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    group = ["start", "key", "i", "j"]
    grouped = rows.repartition(*group).sortWithinPartitions(*group)
    return arrow_map(grouped, forest(), "a long, b long")


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """docs (text and any other columns) with _fp, which replaces a column of that name, instead of text."""
    docs = docs.drop("_fp")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    return arrow_map(docs, fingerprint_rows(), schema + ", _fp long")


def groups(fps: DataFrame, block: int = BLOCK, long_keys_from: int = LONG_KEYS_FROM) -> DataFrame:
    """(doc_id, fp) -> (fp, component_id), one row per fingerprint."""
    nodes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    comp = connected_components(links(nodes, block, long_keys_from))
    named = nodes.join(comp, nodes["fp"] == comp["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return named.join(ids, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, block: int = BLOCK, long_keys_from: int = LONG_KEYS_FROM) -> DataFrame:
    """One row per row of docs: doc_id, fp (the fingerprint as a signed long), component_id.

    Null and empty texts, and texts of white space, have fingerprint zero. Repeated rows and exact copies share a
    fingerprint. A null doc_id is never a component's id unless all its ids are null. Empty table: no rows."""
    fps = stage(with_fingerprints(doc_text(docs)).select("doc_id", F.col("_fp").alias("fp")), "simhash-fps")
    return fps.join(groups(fps, block, long_keys_from), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, block: int = BLOCK, long_keys_from: int = LONG_KEYS_FROM) -> DataFrame:
    """docs with one document of each near-duplicate group, that with the least doc_id (null ids last); all columns stay. Of rows with the same
    doc_id in a group one stays. What goes is decided on ids and hashes alone; only texts that may go are shuffled. Null, empty and very long texts as in
    near_duplicates. Columns named _fp, _keep_id or _keep_key go. Empty table: no rows."""
    docs = docs.drop("_fp", "_keep_id", "_keep_key")
    own = docs.withColumns({"_keep_id": F.col("doc_id").cast("long"), "_keep_key": F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))})
    rows = with_fingerprints(own.select(F.col("_keep_id").alias("doc_id"), F.col("_keep_key").alias("key"), F.col("text").cast("string").alias("text")))
    rows = stage(rows.withColumnRenamed("_fp", "fp"), "simhash-fps")
    grouped = stage(rows.join(groups(rows.select("doc_id", "fp"), block, long_keys_from).select("fp", "component"), "fp"), "simhash-grouped")
    first = stage(grouped.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))).alias("x")), "simhash-first")
    gone = grouped.join(first, "component").where(~(F.col("doc_id").eqNullSafe(F.col("x.doc_id")) & (F.col("key") == F.col("x.key"))))
    twice = rows.groupBy("doc_id", "key").agg(F.count("*").alias("n")).where("n > 1")  # equal rows; one of them stays
    marks = stage(gone.select("doc_id", "key", F.lit(True).alias("gone")).union(twice.select("doc_id", "key", F.lit(False))), "simhash-gone")
    near, rest = split_by_keys(own, F.col("_keep_key"), marks.select("key"))
    out = marks.where("gone").select(F.col("doc_id").alias("_gone_id"), F.col("key").alias("_gone_key"))
    kept = near.join(out, (F.col("_keep_key") == F.col("_gone_key")) & F.col("_keep_id").eqNullSafe(F.col("_gone_id")), "left_anti")
    return rest.unionByName(kept.dropDuplicates(["_keep_id", "_keep_key"])).drop("_keep_id", "_keep_key")


def hex_digits(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
