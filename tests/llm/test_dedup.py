"""Line dedup and SimHash against brute force."""

import random

import duckdb
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import line_dedup, simhash
from quarry.llm.common import split_by_keys
from quarry.llm.components import connected_components


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return {d: least[find(i)] for i, d in enumerate(ids)}


def test_simhash_sf(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = {d: brute_fp(t) for d, t in rows}
    comp = brute_components([d for d, _ in rows], [want[d] for d, _ in rows])
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.fp % 2**64 for r in got} == want
    assert {r.doc_id: r.component_id for r in got} == comp


def test_simhash_links_equal_brute_force_for_every_key_length(spark):
    rng = random.Random(5)
    fps = set()
    for _ in range(120):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            fps.add(x)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
    fps = sorted(f - 2**64 if f >> 63 else f for f in fps)
    want = brute_components(fps, [f % 2**64 for f in fps])
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    for block, long_from in ((8192, 1 << 30), (8192, 1), (2, 1 << 30)):
        comp = {r.node: r.component for r in connected_components(simhash.links(nodes, block, long_from)).collect()}
        assert {f: comp.get(f, f) for f in fps} == want


def test_simhash_edges_of_input(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "One"), (4, "one"), (None, "one"), (7, "a b"), (8, "x " * 50000)]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fp string")
    got = {(r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert {(1, 0, 1), (2, 0, 1), (3, 0, 1), (4, brute_fp("one"), 4), (None, brute_fp("one"), 4), (8, brute_fp("x " * 5), 8)} <= got
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_pigeonring(x, bits):
    differ = [sum(1 for b in bits if b // 4 == s) for s in range(16)]
    assert any(all(sum(differ[(s + k) % 16] for k in range(n)) <= n * 3 // 16 for n in range(1, 17)) for s in range(16))


def brute_lines(docs, min_lines=3, min_words=50):
    """What is left of each text, from the definition alone: of every stretch of lines, however long, that is long enough and has an equal one earlier that ends before
    it begins, all lines go."""
    flat = {d: [x.strip() for x in docs[d].split("\n") if x.strip()] for d in docs}
    places, gone = {}, {d: set() for d in docs}
    for d in sorted(flat):
        lines = flat[d]
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                if j - i >= min_lines or sum(len(x.split()) for x in lines[i:j]) >= min_words:
                    places.setdefault(tuple(lines[i:j]), []).append((d, i, j))
    for same in places.values():
        for d, i, j in same:
            if any(e < d or (e == d and y <= i) for e, x, y in same):
                gone[d].update(range(i, j))
    return {d: [x for i, x in enumerate(flat[d]) if i not in gone[d]] for d in docs}


def cut(spark, docs, **options):
    return {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), **options).collect()}


def test_line_dedup_small(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = {
        1: "a\nb\nc\nd\ne", 2: "x\na\nb\n\nc\ny", 3: "a\nb\nq\nd\ne", 4: f"p\n{long}\nq", 5: f"  {long} \nq\nz", 6: "b\nc\nd\ne\nf",
        7: "r\nr\nr\nr\nr\nr", 8: "short line", 9: "short line", 10: "", 12: f"{long} {long}" * 3000 + "\nend", 13: f"{long} {long}" * 3000,
    }
    df = spark.createDataFrame([(d, t, 1) for d, t in docs.items()] + [(None, "a\nb\nc", 2), (11, None, 3)], "doc_id long, text string, _windows int")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got[None] == "a\nb\nc" and got[1] == "d\ne"  # a null id is first
    assert got[2] == "x\ny" and got[3] == docs[3] and got[4] == docs[4] and got[5] == "z" and got[6] == "f" and got[7] == "r\nr\nr"
    assert got[8] == got[9] == "short line" and got[10] == "" and got[11] is None and got[12] == docs[12] and got[13] == ""
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_finds_runs_of_any_earlier_place(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(30))
    assert cut(spark, {1: f"{a}\nx", 2: f"{a}\n{b}\ny", 3: f"{a}\n{b}\nz"}) == {1: f"{a}\nx", 2: f"{b}\ny", 3: "z"}


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    for words in (1, 20, 30):
        bank = [" ".join([f"l{i}"] * rng.choice((1, words, 30))) for i in range(9)]
        docs = {d: "\n".join(rng.choice(bank) for _ in range(rng.randint(0, 14))) for d in range(50)}
        got = cut(spark, docs)
        assert {d: [x for x in t.split("\n") if x] for d, t in got.items()} == brute_lines(docs)


def test_line_dedup_compares_lines_where_hashes_collide(spark):
    rng = random.Random(9)
    bank = [f"line {i}" for i in range(30)]
    docs = {d: "\n".join(rng.choice(bank) for _ in range(rng.randint(0, 10))) for d in range(60)}
    got = cut(spark, docs, digest=lambda b: len(b) % 3)
    assert {d: [x for x in t.split("\n") if x] for d, t in got.items()} == brute_lines(docs)


def test_fingerprints_are_window_minima(spark):
    import pyarrow as pa

    text = "\n".join(f"line {i % 7} {i % 3}" for i in range(40))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text])], names=["doc_id", "text_hash", "text"])
    (out,) = line_dedup.spot_rows()(iter([batch]))
    h = [xxhash.xxh3_64_intdigest(x.encode()) for x in text.split("\n")]
    want = {i + min(range(3), key=lambda k: (h[i + k], k)) for i in range(38)}
    assert out.num_rows == len(want) < 38 and sorted(f % 2**64 for f in out.column("fp").to_pylist()) == sorted(h[i] for i in want)
    assert sorted(w["first"] for ws in out.column("windows").to_pylist() for w in ws) == list(range(38))


def test_split_by_keys(spark):
    keys = spark.range(0, 3000, 3).selectExpr("id * 7919 AS k")
    near, rest = split_by_keys(spark.range(0, 3000 * 7919, 7919).toDF("k"), F.col("k"), keys)
    a, b = {r.k for r in near.collect()}, {r.k for r in rest.collect()}
    assert a | b == {k * 7919 for k in range(3000)} and not a & b and {r.k for r in keys.collect()} <= a and len(b) > 1500
    near, rest = split_by_keys(spark.range(5), F.col("id"), keys.limit(0))
    assert near.count() == 0 and rest.count() == 5


def test_line_dedup_equals_sql(spark, sf):
    rng = random.Random(6)
    bank = [" ".join([f"l{i}"] * rng.choice((1, 1, 20, 30, 60))) for i in range(14)] + ["", "  ", "\t"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect() + [(1000 + d, "\n".join(rng.choice(bank) for _ in range(rng.randint(0, 25)))) for d in range(80)] + [(5000, None)]
    df = spark.createDataFrame([tuple(r) for r in docs], "doc_id long, text string")
    got = sorted((r.doc_id, r.text, r["_n_lines"], r["_n_deleted"], r["_deleted_words"]) for r in line_dedup.dedup_lines(df).collect())
    with duckdb.connect() as c:
        documents = df.toArrow()
        c.register("documents", documents)
        assert got == sorted(c.sql(line_dedup.oracle()).fetchall())
    assert sum(r[3] for r in got) > 100


def test_line_dedup_repeated_rows(spark):
    t = "a\nb\nc\nd"
    df = spark.createDataFrame([(5, t), (5, t), (5, t + "\ne"), (6, t)], "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(df).collect())
    assert got.count((6, "")) == 1 and len(got) == 4 and sum(x == (5, t) for x in got) in (0, 2)
