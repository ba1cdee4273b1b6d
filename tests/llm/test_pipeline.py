"""The pipeline's stages against brute force on a small corpus."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_dedup import brute_components, brute_fp, brute_lines
from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm import langid, line_dedup, mixing, packing, simhash

LONG = " ".join(f"word{i}" for i in range(60))


def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    top = 10_000
    extra = [(top, "123 456", "en", "src0", 7), (top + 1, None, "en", None, 0), (top + 2, f"{LONG}\nthe and of", "en", "src1", 1), (top + 3, f"in the\n{LONG}\nof and to", "en", "src1", 1), (top + 4, f"{LONG}\nthe and of", "en", "src2", 1)]
    return docs.union(spark.createDataFrame(extra, docs.schema))


def brute_languages(model, text):
    """(language, probability) of a text, word by word: emissions, forward and backward sums of each stretch, and the weighted mean."""
    words = langid.WORD.findall((text or "").lower())
    if not words:
        return None
    k, step = len(model["labels"]), np.exp(model["transitions"])
    score = {w: langid.emissions([w], model["weights"], model["lexicon"])[0].astype(float) for w in set(words)}
    p = []
    for lo in range(0, len(words), langid.STRETCH):
        e = [np.exp(score[w] - score[w].max()) for w in words[lo : lo + langid.STRETCH]]
        ahead, back = [e[0] / e[0].sum()], [np.ones(k)]
        for x in e[1:]:
            a = x * (ahead[-1] @ step)
            ahead.append(a / a.sum())
        for x in reversed(e[1:]):
            b = step @ (x * back[-1])
            back.append(b / b.sum())
        p += [(g := a * b) / g.sum() for a, b in zip(ahead, reversed(back))]
    n = Counter(words)
    weight = [n[w] ** -0.5 for w in words]
    mean = (sum(w * x for w, x in zip(weight, p)) + model["prior"]) / (sum(weight) + 1)
    return model["labels"][int(mean.argmax())], float(mean.max())


def brute_mix(docs):
    """Copies of each document: the queues item by item, always the one that finishes first, until one doesn't fit."""
    size = {d: len(re.findall("[^\\x20\\x09-\\x0D]+", r.text or "")) for d, r in docs.items()}
    sources = sorted({r.source for r in docs.values()}, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    of = {s: sorted((hashlib.md5(f"{d} {r.text or ''}".encode()).hexdigest(), d) for d, r in docs.items() if r.source == s) for s in sources}
    items = []
    for s, own in of.items():
        done = 0
        for n in range(2):
            for u, d in own:
                done += size[d]
                if size[d]:
                    items.append((done / weight[s], u, d, n))
    left, copies = min(1.5 * sum(size.values()), 2 * sum(size.values())), Counter()
    for _, _, d, _ in sorted(items):
        left -= size[d]
        if left < 0:
            break
        copies[d] += 1
    return copies


def brute_pack(rows):
    """(Pieces by doc_id with their ids' checksums, the number of sequences of best fit decreasing, item by item)."""
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    pieces, bins = Counter(), []
    for r in rows:
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            pieces[r.doc_id, k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    for n in sorted((p[3] for p in pieces.elements()), reverse=True):
        fits = [x for x in bins if x >= n]
        if fits:
            bins.remove(min(fits))
        bins.append((min(fits) if fits else 2048) - n)
    return pieces, len(bins)


def test_stages_equal_brute_force(spark, tmp_path):
    docs = corpus(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    df = docs
    for name, step in corpus_pipeline.STAGES:
        was = df.collect()
        now = {r.doc_id: r for r in was}
        out = step(spark, df, str(tmp_path))
        if name != "best_fit_packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        rows = out.collect()
        if name == "language_id":
            model = langid.fit(langid.learner_rows(df))
            want = {}
            for d, r in now.items():
                best = brute_languages(model, r.text)
                assert best is None or abs(best[1] - corpus_pipeline.LEAST_SCORE) > 1e-4  # no tie
                if best and best[1] >= corpus_pipeline.LEAST_SCORE:
                    want[d] = (best[0], r.text, r.source)
            assert {r.doc_id: (r.lang, r.text, r.source) for r in rows} == want and len(rows) == len(want) and not {10_000, 10_001} & set(want)
        elif name == "line_dedup":
            left = brute_lines({d: r.text for d, r in now.items()})
            full = lambda t: [x.strip(" \t\r\x0b\x0c") for x in t.split("\n") if x.strip(" \t\r\x0b\x0c")]
            want = {d: lines for d, lines in left.items() if lines or not full(now[d].text)}
            assert {r.doc_id: full(r.text) for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)
            assert 10_004 not in want and want[10_003] == ["in the", "of and to"] and LONG in want[10_002]
            assert all(r.text == now[r.doc_id].text for r in rows if want[r.doc_id] == full(now[r.doc_id].text))
        elif name == "simhash_dedup":
            least = brute_components(list(now), [brute_fp(r.text) for r in now.values()])
            assert sorted(r.doc_id for r in rows) == sorted(d for d in now if least[d] == d) and all(r == now[r.doc_id] for r in rows)
        elif name == "source_mixing":
            want = brute_mix(now)
            assert Counter(r.doc_id for r in rows) == want and max(want.values()) <= 2 and all(r == now[r.doc_id] for r in rows)
        else:
            pieces, sequences = brute_pack(was)
            assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == pieces
            assert len({r.sequence_id for r in rows}) == sequences
            at = defaultdict(list)
            for r in rows:
                at[r.sequence_id].append((r.offset, r.length))
            for v in at.values():
                assert [o for o, _ in sorted(v)] == [sum(n for _, n in sorted(v)[:i]) for i in range(len(v))] and sum(n for _, n in v) <= 2048
        df = out
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.columns == df.columns
    assert Counter(map(tuple, whole.select(*columns).collect())) == Counter(map(tuple, df.select(*columns).collect()))


def test_stages_on_nothing(spark, tmp_path):
    df = corpus(spark).limit(0)
    for _, step in corpus_pipeline.STAGES:
        df = step(spark, df, str(tmp_path))
        assert df.count() == 0


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "source_mixing", "best_fit_packing"]
    assert langid.UNKNOWN == "und"


def test_keep_one_repeated_rows(spark):
    rows = [(5, "alpha beta gamma"), (5, "alpha beta gamma"), (6, "alpha beta gamma"), (5, "quite another text here"), (None, "alpha beta gamma"), (None, "only null has this one")]
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(5, "alpha beta gamma"), (5, "quite another text here"), (None, "only null has this one")], key=str)


def test_mixed_documents_rows_alike(spark):
    rows = [(1, "s", "a b"), (1, "s", "c d"), (1, "s", "a b"), (2, "t", "x y z"), (None, None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    taken = sum(r.taken for r in mixing.mix(df).collect())
    assert sum(len(r.text.split()) for r in mixing.mixed_documents(df).collect()) == taken


def test_clashing_names(spark):
    names = ["_fp", "_keep_id", "_keep_key", "_n_lines", "_windows", "_run_doc", "_lang_pred", "_score", "_mix_id", "_nth", "_copies", "fp", "component", "size", "n_chars"]
    df = spark.createDataFrame([(k, f"the and of text number {k}", "en", f"s{k % 2}") for k in range(12)], "doc_id long, text string, lang string, source string")
    df = df.select("*", *[F.lit(7).alias(n) for n in names])
    assert line_dedup.dedup_lines(df).count() == 12 and simhash.keep_one(df).count() >= 1 and mixing.mixed_documents(df).count() >= 1
    assert langid.identify(df, langid.fit(langid.learner_rows(df))).count() == 12 and packing.pack(df).count() == 12
    assert "fp" in simhash.keep_one(df).columns
