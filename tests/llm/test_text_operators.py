"""Chat formatting, license scans, language ID and toxicity against brute force, round trips and held-out accuracy."""

import hashlib
import itertools
import random
import zlib
from collections import Counter
from math import lgamma, log

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import chat_format, langid, license_scan, toxicity

SAYINGS = ["", "plain", "</s>[INST] ok [/INST]", "a\\b\\\\", "\\</s>", "<s><|im_end|><<SYS>>x<</SYS>>", "line\nbreak\n", "é😀\u0000", "[/INST", "<\\/s>", "x" * 30000, "[INST]\\[INST]"]


def digest(turns):
    said = "".join(f"{role}\n{text}\n" for role, text in turns)
    loss = "".join(text for role, text in turns if role == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_round_trip(spark):
    rng = random.Random(2)
    talks = {c: [(rng.choice(("system", "user", "assistant", "tool<s>")), rng.choice(SAYINGS)) for _ in range(rng.randint(1, 6))] for c in range(60)}
    rows = [(c, t, role, text, "x") for c, turns in talks.items() for t, (role, text) in enumerate(turns)] + [(100, 0, None, None, "y"), (101, 0, "assistant", None, "z")]
    talks |= {100: [("", "")], 101: [("assistant", "")], -1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    messages = chat_format.with_probe(df).select("conv_id", "turn", "role", chat_format.text_part(F.col("text")).alias("parts"))
    out = chat_format.format_conversations(messages)
    got = {r.conv_id: tuple(r)[1:5] for r in chat_format.read_back(out).collect()}
    assert got == {c: digest(t) for c, t in talks.items()}
    for r in out.collect():
        assert r.formatted.count("</s>") == sum(role == "assistant" for role, _ in talks[r.conv_id])
        assert r.formatted.count("[INST]") == r.formatted.count("[/INST]")
        assert [r.formatted[s.start : s.start + s.length] for s in r.loss_spans] == [x.rpartition("\n")[2] if "\n" not in x else x for x in [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]]
    assert chat_format.read_back(chat_format.format_conversations(messages.limit(0))).count() == 0


def test_chat_parts(spark):
    parts = "array(named_struct('type','text','text','see <s>','ref',null,'width',null,'height',null,'seconds',null,'pages',null), named_struct('type','image','text',null,'ref','a.png','width',56,'height',29,'seconds',null,'pages',null), null, named_struct('type','audio','text',null,'ref','b.wav','width',null,'height',null,'seconds',1.5D,'pages',null), named_struct('type','document','text',null,'ref','c.pdf','width',null,'height',null,'seconds',null,'pages',2), named_struct('type',null,'text',' end','ref',null,'width',null,'height',null,'seconds',null,'pages',null))"
    df = spark.sql(f"SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, {parts} AS parts UNION ALL SELECT 1L, 1L, 'assistant', null")
    df = df.withColumn("parts", F.col("parts").cast(f"array<{chat_format.PART}>"))
    r = chat_format.format_conversations(df).first()
    assert r.formatted == "[INST]user\nsee <\\s><|image:1|><|audio:2|><|document:3|> end[/INST]<s>assistant\n</s>"
    assert [tuple(a) for a in r.attachments] == [("image", "a.png", 4), ("audio", "b.wav", 38), ("document", "c.pdf", 2048)]
    assert r.expanded_tokens == 2090 and r.n_turns == 2


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=40), st.lists(st.tuples(st.lists(st.sampled_from("abcdefghxyz"), min_size=1, max_size=6), st.booleans()), min_size=1, max_size=5), st.sampled_from((0.5, 0.7, 0.8, 1.0)))
def test_similarity_join_is_exact(text, templates, threshold):
    known = license_scan.read_templates([(str(i), " ".join(t), t[0] if key else "") for i, (t, key) in enumerate(templates)], threshold)
    index = license_scan.Index(known, {w.encode(): n for n, w in enumerate("hgfedcbaxyz")})
    words = [w.encode() for w in text]
    want = set()
    for k, t in enumerate(known):
        held = [len(t.words.intersection(words[i : i + t.room])) for i in range(len(words)) if t.keys <= set(words[i : i + t.room])]
        if max(held, default=0) >= threshold * len(t.words) - 1e-9:
            want.add((k, max(held) / len(t.words)))
    assert set(index.matches(words, set(words))) == want


def test_license_scan_equals_sql(spark, sf):
    odd = [None, "", "MIT LICENSE mit license", "the Apache\nLicense", "GNU general public license, général public license", "É mit  license\x7fmit-license", "Licensed\nunder CC\nBY-NC 4.0", "licensed under cc by nc 4 0 " + "word " * 5000]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(-k, t) for k, t in enumerate(odd, 1)] + [(-3, odd[2]), (None, "mit license")], "doc_id long, text string"))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = [tuple(r) for r in license_scan.scan(docs.withColumn("labels", F.lit("clash"))).select(*names).collect()]
    with duckdb.connect() as c:
        documents = docs.toArrow()
        c.register("documents", documents)
        want = c.sql(license_scan.oracle()).fetchall()
    assert sorted(got, key=str) == sorted(want, key=str)
    found = {r[0]: r for r in got}
    assert found[-3][2:7] == (2, 0, 2, "mit", "mit") and found[-4][5] == "apache" and found[-7][6] == "cc-by-nc" and found[-2][1] == 0
    assert license_scan.scan(docs.limit(0)).count() == 0


def scanned(texts):
    """(labels, score) of each text by the function that runs in the tasks."""
    import pyarrow as pa

    index = license_scan.Index(license_scan.read_templates(), {})
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    (out,) = license_scan.scan_rows(index)(iter([batch]))
    return list(zip(out.column("labels").to_pylist(), out.column("score").to_pylist()))


NOTICE = {label: notice for label, notice, _ in reversed(license_scan.TEMPLATES)}
PROSE = " ".join(f"w{i}" for i in range(40))


def test_license_notices_broken_over_lines_of_any_width():
    bsd = NOTICE["bsd"].split()
    wide = " ".join([PROSE, *bsd[:9]]) + "\n" + " ".join([*bsd[9:], PROSE])
    hard = "\n".join(" ".join(bsd[i : i + 4]) for i in range(0, len(bsd), 4))
    two = "\n".join(" ".join(x) for x in (bsd[:13], bsd[13:]))
    # Words of a notice that are farther from each other than it is long are none.
    apart = "released under\n" + "\n".join([PROSE] * 2) + "\nthe Mit x\nLicense"
    got = scanned([wide, f"{hard}\n{PROSE}", f"{PROSE}\n{hard}", f"{PROSE}\n\n{hard}", hard.replace("\n", "\n\n# "), f"{PROSE} {two} {PROSE}", f"x\nLicensed under CC\n!\nBY-NC 4.0\n{PROSE}", apart])
    assert got[:6] == [("bsd", 1.0)] * 6 and got[6:] == [("cc-by-nc", 1.0), ("", 0.0)]


def test_a_license_hides_no_other():
    bsd = NOTICE["bsd"].replace("following", "latter").replace("permitted", "allowed")
    got = scanned([f"{NOTICE['cc-by-nc']} {bsd}", f"{NOTICE['cc-by-sa']} {PROSE}", f"{NOTICE['cc-by-nc']} or {NOTICE['cc-by-sa']}", f"{NOTICE['mpl']} {NOTICE['apache']}"])
    assert got == [("bsd,cc-by-nc", 1.0), ("cc-by-sa", 1.0), ("cc-by-nc,cc-by-sa", 1.0), ("apache,mpl", 1.0)]


def test_sentences_that_are_no_notice_of_the_license():
    album = "The album was released on Monday under the new label with a license"
    got = scanned(["Released under the Apache License", "Licensed under CC BY 4.0", album, f"{album}\n" * 300, "Research at MIT was released under the university license", NOTICE["mit"], "licensed under the General Public License"])
    assert [x for x, _ in got] == ["apache", "", "", "", "", "mit", "gpl"]


def test_license_templates_are_a_table(spark):
    own = spark.createDataFrame([("beer", "buy the author a beer in return", "beer"), ("none", None, None), ("wine", "buy me wine", None)], "label string, notice string, keys string")
    docs = spark.createDataFrame([(1, "you may Buy the author\n\na Beer, in return"), (2, "buy the author a house in return"), (3, "buy me WINE"), (4, "mit license")], "doc_id long, text string")
    assert {r.doc_id: (r.labels, r.score) for r in license_scan.scan(docs, own).collect()} == {1: ("beer", 1.0), 2: ("", 0.0), 3: ("wine", 1.0), 4: ("mit", 1.0)}
    assert {r.labels for r in license_scan.scan(docs, own.limit(0)).collect()} == {"", "mit"}


def brute_marginals(scores, transitions):
    n, k = scores.shape
    total, out = 0.0, np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        p = np.exp(sum(scores[i, y] for i, y in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:])))
        total += p
        for i, y in enumerate(path):
            out[i, y] += p
    return out / total


def test_forward_backward():
    rng = np.random.default_rng(0)
    lengths = np.array([6, 4, 4, 1])
    scores, transitions = rng.normal(size=(4, langid.STRETCH, 3)), rng.normal(size=(3, 3))
    gamma = langid.forward_backward(scores, lengths, transitions)
    for s, n, g in zip(scores, lengths, gamma):
        assert np.allclose(g[:n], brute_marginals(s[:n], transitions))


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(-1, None, None), (-2, "", "en"), (-3, "12 .. ²½ __", "en"), (-4, "the and of " * 20000, None), (None, "der die und das", "de")], "doc_id long, text string, lang string")
    got = langid.train_and_identify(docs.select("doc_id", "text", "lang").union(odd).withColumn("score", F.lit("x"))).collect()
    by = {r.doc_id: r for r in got}
    assert [by[-k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and by[-1].score == 0
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in got if r.doc_id is not None and r.doc_id >= 0 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.train_and_identify(docs.limit(0)).count() == 0


def test_code_switched_words_are_labelled_one_by_one():
    rng = random.Random(4)
    words = {"a": ["foo", "fab", "fin"], "b": ["zoz", "zaz", "zuz"]}
    model = langid.train([(lang, [rng.choice(words[lang]) for _ in range(30)]) for _ in range(60) for lang in words])
    p = langid.Labeller(model).word_probabilities([["fab", "foo", "fin", "foo", "zaz", "zuz", "zoz", "zaz"]])
    assert p.argmax(axis=1).tolist() == [0] * 4 + [1] * 4


def test_boilerplate_and_repetition_teach_nothing():
    rows = [("a", ["x", "y", "p"], [1, 1, 2]), ("b", ["x", "y", "q"], [1, 1, 3]), ("b", ["z"] * 9, [4] * 9)]
    assert langid.own_lines(rows) == [("a", ["p"]), ("b", ["q"])]
    assert langid.own_lines(rows[:1]) == [("a", ["x", "y", "p"])]
    assert langid.own_lines([("a", ["x"], [1]), ("b", ["x"], [1])]) == [("a", ["x"]), ("b", ["x"])]  # nothing else is there


def test_repeated_words_dont_outvote_a_text():
    rng = random.Random(4)
    words = {"a": ["foo", "fab", "fin", "fet", "fup"], "b": ["zoz", "zaz", "zuz", "zyx", "zib"]}
    model = langid.train([(lang, [rng.choice(words[lang]) for _ in range(9)]) for _ in range(90) for lang in words])
    p = langid.Labeller(model).languages([words["a"] * 2 + ["zaz"] * 30, words["b"]])
    assert p.argmax(axis=1).tolist() == [0, 1] and np.allclose(p.sum(axis=1), 1)


def brute_segments(values):
    """Maximal segments by their definition: the best segment, then the same to its left and right."""
    if not values:
        return []
    best, where = 0, None
    for i in range(len(values)):
        for j in range(i + 1, len(values) + 1):
            s = sum(values[i:j])
            if s > best + 1e-9:
                best, where = s, (i, j)
    if where is None:
        return []
    i, j = where
    return [(a, b) for a, b in brute_segments(values[:i])] + [(i, j)] + [(a + j, b + j) for a, b in brute_segments(values[j:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-7, 9).filter(lambda x: x != 0).map(lambda x: x + 0.01 * (x % 3)), max_size=9), st.sampled_from((0.5123, 1.3717, 3.1153)))
def test_maximal_segments(gaps, penalty):
    scores, place = [], 0
    for g in gaps:  # positive numbers are tokens that score, negative ones gaps
        if g < 0:
            place += int(-g) + 1
        else:
            scores.append((place, g))
            place += 1
    values = [-penalty] * place
    for p, s in scores:
        values[p] = s
    got = [(a, b + 1) for _, a, b in toxicity.segments(scores, penalty)]
    total = lambda ab: sum(values[ab[0] : ab[1]])
    want = brute_segments(values)
    assert sorted(round(total(x), 6) for x in got) == pytest.approx(sorted(round(total(x), 6) for x in want))


def test_lambda():
    shares, scores = np.array([0.001, 0.0005]), np.array([3.0, 6.0])
    lam = toxicity.solve_lambda(shares, scores, 0.05)
    rest = 1 - shares.sum()
    assert abs((shares * np.exp(lam * scores)).sum() + rest * np.exp(-0.05 * lam) - 1) < 1e-6 and lam > 0.01 and log(2) > 0


def test_toxicity(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "idiot moron scum " * 5000), (None, "clean")], "doc_id long, text string")
    got = toxicity.score_documents(docs.select("doc_id", "text").union(odd).withColumn("passages", F.lit(1)), labels).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == docs.count() + 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert by[-1].predicted == by[-2].predicted == 0 and by[-3].predicted == 1
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    hit = sum(t and p for t, p in held)
    assert hit >= 0.9 * sum(t for t, _ in held) and hit >= 0.9 * sum(p for _, p in held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (2, 0), (2, 0), (None, 1)], "doc_id long, toxic int")
    assert {(r.doc_id, r.score, r.predicted) for r in toxicity.score_documents(docs, labels).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}
    assert toxicity.score_documents(docs.limit(0), labels.limit(0)).count() == 0


def test_fit_of_the_tail_finds_the_law():
    rng = np.random.default_rng(3)
    words = rng.integers(20, 2000, 20_000).astype(float)
    best = -np.log(-np.log(rng.random(20_000)) / (0.02 * words)) / 0.7  # P(S < s) = exp(-K n exp(-lambda s))
    lam, k = toxicity.fit_tail(np.maximum(best, 0), words, 9.0)
    assert lam == pytest.approx(0.7, rel=0.05) and k == pytest.approx(0.02, rel=0.35)
    assert toxicity.fit_tail(np.zeros(50), np.full(50, 30.0), 2.0)[0] == 2.0 and toxicity.fit_tail(np.zeros(0), np.zeros(0), 2.0) == (2.0, 1.0)


def test_the_law_holds_for_clean_held_out_texts(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{d}/labels.parquet")
    model = toxicity.learn(docs, toxicity.labelled_sample(labels, 4, 2))
    out = toxicity.arrow_map(docs.join(labels.where("toxic = 0"), "doc_id").select("doc_id", "text"), toxicity.scan_rows(model["weights"], model["penalty"]), "doc_id long, words long, best double, passages array<struct<score:double,first:int,last:int>>").toPandas()
    held = np.array([zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id])
    words, best = np.maximum(out.words.to_numpy(float), 1), out.best.to_numpy()
    lam, k = toxicity.fit_tail(best[~held], words[~held], 1.0)
    for share in (0.1, 0.03, 0.01):
        s = float(np.quantile(best[~held], 1 - share))
        seen, told = float((best[held] > s).mean()), float((1 - np.exp(-k * words[held] * np.exp(-lam * s))).mean())
        assert seen / 3 <= told <= 3 * seen + 0.005


def brute_toxicity(docs, labels):
    """Scores of a small corpus, step by step from the definitions, with plain counters."""
    feats = lambda w: [w, *(w[:n] + "*" for n in range(4, 9) if len(w) > n)]
    tokens = {d: toxicity.WORD.findall((t or "").lower()) for d, t in docs}
    known = {d: t for d, t in labels.items() if zlib.crc32(str(d).encode()) % 4 != 2}
    count = lambda ids: Counter(f for d in ids for w in tokens[d] for f in feats(w))
    toxic, clean = [d for d in known if known[d]], [d for d in known if not known[d]]
    y_t, y_c, every = count(toxic), count(clean), count(tokens)
    stands = Counter(f for d in toxic for f in {f for w in tokens[d] for f in feats(w)})
    n_t, n_c, total = (float(sum(len(tokens[d]) for d in ids)) for ids in (toxic, clean, tokens))
    weights = {}
    for f, n in stands.items():
        if n >= toxicity.MIN_DOCS:
            a = toxicity.PRIOR * every[f] / total
            odds = lambda y, n, a=a: np.log((y + a) / (n + toxicity.PRIOR - y - a))
            z = odds(y_t[f], n_t) - odds(y_c[f], n_c) - toxicity.ERRORS * np.sqrt(1 / (y_t[f] + a) + 1 / (y_c[f] + a))
            if z >= toxicity.LEAST:
                weights[f] = z
    value = lambda w: max([weights[f] for f in feats(w) if f in weights], default=0.0)
    hit = sum(y_t[f] for f in weights if not f.endswith("*")) / n_t
    penalty = max(0.02, -log(1 - min(0.5, hit)), 2 * sum(value(w) for d in tokens for w in tokens[d]) / total)
    found = {d: [sum(v[i:j]) for v in [[value(w) or -penalty for w in ws]] for i, j in brute_segments(v)] for d, ws in tokens.items()}
    best, words = {d: max(s, default=0.0) for d, s in found.items()}, {d: max(1, len(ws)) for d, ws in tokens.items()}
    lam, k = toxicity.fit_tail(np.array([best[d] for d in clean]), np.array([float(words[d]) for d in clean]), 1.0)

    def surprise(d):
        x = sorted([v for v in (lam * s - log(k * words[d]) for s in found[d]) if v >= -log(toxicity.ALPHA)], reverse=True)
        p = lambda r: -(sum(x[:r])) + (r - 1) * log(max(1.0, sum(x[:r]))) - lgamma(r + 1) - lgamma(r)
        return max([-p(r) for r in range(1, len(x) + 1)], default=0.0)

    w = toxicity.logistic(np.array([[np.sqrt(surprise(d))] for d in known]), np.array([float(t) for t in known.values()]))
    significant = {d: sum(k * words[d] * np.exp(-lam * s) <= toxicity.ALPHA for s in found[d]) for d in tokens}
    return {d: (1 / (1 + np.exp(-(w[0] * np.sqrt(surprise(d)) + w[1]))), significant[d]) for d in tokens}


def test_toxicity_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PRIOR", 20.0)  # the corpus is small
    rng = random.Random(8)
    plain, bad = [f"word{i}x" for i in range(60)], ["idiotic", "idiots", "scum", "moronic"]
    texts, labels = [], {}
    for d in range(160):
        labels[d] = int(d % 4 == 0)
        odds = (0.25 if labels[d] else 0.004) if d % 9 else 0.03
        texts.append((d, " ".join(rng.choice(bad) if rng.random() < odds else rng.choice(plain) for _ in range(rng.randint(1, 30)))))
    texts += [(200, None), (201, ""), (202, "scum " * 40)]
    want = brute_toxicity(texts, labels)
    got = toxicity.score_documents(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")).collect()
    assert len(got) == len(want) and any(r.n_passages for r in got)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id][0], abs=1e-6) and r.n_passages == want[r.doc_id][1]


def test_toxicity_repeated_ids_are_one_example(spark):
    docs = spark.createDataFrame([(1, "scum here"), (1, "scum there"), (1, "scum here"), (2, "all is well"), (3, "well said")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    assert len(toxicity.score_documents(docs, labels).collect()) == 5
