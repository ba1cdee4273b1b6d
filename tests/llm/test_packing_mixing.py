import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import mixing, packing

ODD = ["don't it's <|endoftext|>", "ábc é \x85 µm ªº x y İß 12a3!!'re k​z 中文字,ok", "", None, "a_b-c ~^` \x7f", "é" * 9000, "hello " * 3000]


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(200):
        cap = rng.choice((8, 20, 64))
        counts = Counter(rng.randint(1, cap) for _ in range(rng.randint(0, 300)))
        at, placed = defaultdict(list), Counter()
        for length, a, b, seq, each, offset in packing.plan(dict(counts), cap):
            for r in range(b - a):
                at[seq + r // each].append((offset + r % each * length, length))
                placed[length] += 1
        assert placed == counts
        for v in at.values():
            end = 0
            for o, n in sorted(v):
                assert o == end
                end += n
            assert end <= cap
        bins = []
        for n in sorted(counts.elements(), reverse=True):
            fits = [x for x in bins if x >= n]
            if fits:
                bins.remove(min(fits))
            bins.append((min(fits) if fits else cap) - n)
        assert len(bins) == len(at)


def test_pack(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit(1).alias("length"))
    docs = docs.union(spark.createDataFrame([(-k - 1, t, 0) for k, t in enumerate(ODD)] + [(None, "x", 0), (-1, ODD[0], 0)], "doc_id long, text string, length int"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    want = Counter()
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[d, k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    got = packing.pack(docs).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    at = defaultdict(list)
    for r in got:
        at[r.sequence_id].append((r.offset, r.length))
    for v in at.values():
        end = 0
        for o, n in sorted(v):
            assert o == end
            end += n
        assert end <= 2048
    total = sum(r.length for r in got)
    assert -(-total // 2048) <= len(at) <= 1.02 * total / 2048 + 2
    assert packing.pack(docs.limit(0)).count() == 0


def check_mix(spark, docs):
    got = [tuple(r) for r in mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()]
    with duckdb.connect() as c:
        documents = docs.select("doc_id", "source", "text").toArrow()
        c.register("documents", documents)
        want = c.sql(mixing.oracle()).fetchall()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


def test_mix_equals_sql(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = check_mix(spark, docs)
    by = defaultdict(lambda: [0.0, 0, 0])
    source = {r.doc_id: r.source for r in docs.collect()}
    for d, size, _, target, taken in got:
        assert 0 <= taken <= 2 * size
        x = by[source[d]]
        x[0], x[1], x[2] = target, x[1] + taken, max(x[2], size)
    assert all(abs(t - n) <= 2 * most + 1 for t, n, most in by.values())


def test_mix_edges(spark):
    rows = [(1, "a", "one two"), (2, None, "x"), (3, "b", None), (4, "b", ""), (5, "é", "p q r\x0bs"), (6, "é", "a b c " * 400), (6, "é", "a b c " * 400), (None, "Z", "n o"), (7, "a", "z")]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, source string, text string, size int")
    assert len(check_mix(spark, docs)) == len(rows)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(docs.where("size < 0 or text = ''")).collect()] == [0]


def test_mix_reruns_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = sorted(map(tuple, mixing.mix(docs).collect()))
    assert one == sorted(map(tuple, mixing.mix(docs.repartition(13, "text"), ranges=16).collect()))


def test_mix_of_many_sources(spark):
    """Nothing is in one task: sources are ranked in ranges, and the end of the budget is cut until few rows are left."""
    rng = random.Random(7)
    rows = [(i, None if i % 50 == 7 else f"site{i % 20_000:05d}.org" if i % 3 else "hot", "w " * rng.randint(0, 4)) for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(8)
    check_mix(spark, docs)
    want = Counter({r.doc_id: r.copies for r in mixing.mix(docs, edge=10).collect() if r.copies})
    assert want == Counter({r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies})
    assert Counter(r.doc_id for r in mixing.mixed_documents(docs).collect()) == want


def test_mix_of_rows_without_ids(spark):
    rng = random.Random(8)
    docs = spark.createDataFrame([(None, rng.choice("abc"), "w " * rng.randint(0, 30) + rng.choice("xyz")) for _ in range(3000)], "doc_id long, source string, text string")
    check_mix(spark, docs)
    spread = mixing.finish_times(docs.select(F.lit(None).cast("long").alias("doc_id"), "source", F.concat("text", F.rand(1).cast("string")).alias("text"))).select("u").distinct().count()
    assert spread == 3000
    taken = sum(r.taken for r in mixing.mix(docs).collect())
    assert sum(len(r.text.split()) for r in mixing.mixed_documents(docs).collect()) == taken


def test_mix_in_order_item_by_item(spark):
    """Weighted fair queueing step by step: the item that finishes first is next, while it fits."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {(r.doc_id): r for r in mixing.finish_times(docs).collect()}
    items = sorted(((r.done + n * r.source_size) / r.weight, r.u, d, n) for d, r in rows.items() for n in range(2) if r["size"])
    left, want = next(iter(rows.values())).budget, Counter()
    for _, _, d, _ in items:
        left -= rows[d]["size"]
        if left < 0:
            break
        want[d] += 1
    assert want == Counter({r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies})


def test_pack_with_another_tokenizer(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    rows = [(k, t) for k, t in enumerate([*ODD, "Upper and  lower\n\tcase"])]
    want = Counter()
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            want[d, k // 2048, zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())] += 1
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer=path).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in got) == want


def encoded_alone(texts):
    """(doc_id, piece, start, length, crc32) of texts, each encoded as a whole."""
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    for d, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            yield d, k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())


def pieces_of(texts, batch=100):
    import pyarrow as pa

    table = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    fn = packing.encode_pieces(public_tokenizers.path("word_bpe_49k.json"), 2048, 0)
    return [tuple(r.values())[:5] for b in fn(iter(table.to_batches(max_chunksize=batch))) for r in b.to_pylist()]


def test_new_words_of_texts_are_encoded_together(monkeypatch):
    import tokenizers

    calls = []

    class Counted:
        def __init__(self, tok):
            self.tok, self.get_vocab = tok, tok.get_vocab

        @classmethod
        def from_file(cls, path):
            return cls(Tokenizer.from_file(path))

        def encode(self, text, **kw):
            calls.append(text)
            return self.tok.encode(text, **kw)

        def encode_batch_fast(self, texts, **kw):
            calls.append(texts)
            return self.tok.encode_batch_fast(texts, **kw)

    texts = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)} text" for k in range(500)]
    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    assert pieces_of(texts) == list(encoded_alone(texts))
    assert len(calls) <= 5  # one a batch; before, one a text


def test_groups_of_texts_and_a_full_store_of_words(monkeypatch):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeÉ'1!") for _ in range(rng.randint(1, 7)))
    texts = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(150)] + ODD
    rng.shuffle(texts)
    for kept, group in ((30, 400), (400_000, 1), (1, 1 << 18)):
        monkeypatch.setattr(packing, "KEPT_WORDS", kept)
        monkeypatch.setattr(packing, "GROUP_CHARS", group)
        assert pieces_of(texts, 40) == list(encoded_alone(texts))
