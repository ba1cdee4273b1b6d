"""Toxic passages by maximum-scoring segments.

Tokens are lower-case words; each stands for itself and for its beginnings of 4 to 8 letters. Their scores are log-odds of toxic
against other labelled texts with an informative Dirichlet prior, whose shape is the counts of the whole corpus; only what is
significant scores, at its lower confidence bound, and every other token costs a small penalty, so random text has negative
drift. A linear scan (Ruzzo and Tompa) finds all maximal scoring segments of a text. The best segment of a clean text of n words follows an
extreme-value law, P(S >= s) = 1 - exp(-K n exp(-lambda s)); lambda and K are fitted to the upper tail of the clean texts of the labelled
sample by censored maximum likelihood. By this law a segment is significant if fewer than ALPHA such segments are to be expected in a clean text of this
length, and the significant ones of a text have one p-value together (the law of the sum of the r best ones). Its surprise alone is what a
document's probability is calibrated from.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, crc32_mod, doc_text, stage

#: Bounds of the labelled sample: about so many documents of either label.
SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 12000
#: A feature must stand in so many toxic documents of the sample; prior strength in tokens; standard errors off the log-odds; least score.
MIN_DOCS, PRIOR, ERRORS, LEAST = 4, 20_000.0, 2.0, 1.0
#: Expected number of segments, in a clean text, from which on one is significant; share of the clean texts below the fitted tail; least texts in it.
ALPHA, BODY, LEAST_TAIL = 0.05, 0.95, 5
PREFIXES = range(4, 9)
#: Words whose score a task remembers at most; bounds memory, not what is scored.
KEPT_WORDS = 400_000
WORD = re.compile(r"[^\W\d_]+")
THRESHOLD = 0.3


def features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def toxic_features(batches: Iterator) -> Iterator:
    """mapInArrow: (text) of toxic documents -> (feature, docs, n), summed over a batch."""
    from collections import Counter

    import pyarrow as pa

    for batch in batches:
        docs, n = Counter(), Counter()
        for text in batch.column(0).to_pylist():
            own = Counter()
            for w, c in Counter(WORD.findall((text or "").lower())).items():
                for f in features(w):
                    own[f] += c
            docs.update(own.keys())
            n.update(own)
        yield pa.RecordBatch.from_arrays([pa.array(list(docs), pa.string()), pa.array(list(docs.values()), pa.int64()), pa.array([n[f] for f in docs], pa.int64())], names=["feature", "docs", "n"])


def corpus_counts(candidates: dict[str, int]):
    """mapInArrow: (text, toxic) -> (hits, n, clean): how often words with the same candidate features stand in all texts and in those labelled
    clean. hits: the features' numbers, comma-joined; empty for the words that have none."""

    def run(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        known: dict[str, str] = {}

        def key(word: str) -> str:
            k = known.get(word)
            if k is None:
                if len(known) >= KEPT_WORDS:
                    known.clear()
                k = known[word] = ",".join([str(candidates[f]) for f in features(word) if f in candidates])
            return k

        every, clean = Counter(), Counter()
        for batch in batches:
            words, other = Counter(), Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    found = WORD.findall(text.lower())
                    words.update(found)
                    if toxic == 0:
                        other.update(found)
            for w, c in words.items():
                every[key(w)] += c
            for w, c in other.items():
                clean[key(w)] += c
        yield pa.RecordBatch.from_arrays([pa.array(list(every), pa.string()), pa.array(list(every.values()), pa.int64()), pa.array([clean[k] for k in every], pa.int64())], names=["hits", "n", "clean"])

    return run


def segments(scores: list[tuple[int, float]], penalty: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (Ruzzo and Tompa, linear time) of a text in which the tokens at the given places score and all
    others cost the penalty: (score, first place, last place)."""
    held: list[list] = []  # [left sum, right sum, first, last, index of the nearest earlier with a lesser left sum]
    total, last = 0.0, -1
    for place, s in scores:
        total -= penalty * (place - last - 1)
        left, total, last = total, total + s, place
        new = [left, total, place, place, -1]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][0] >= new[0]:
                j = held[j][4]
            if j < 0 or held[j][1] >= new[1]:
                new[4] = j
                held.append(new)
                break
            new = [held[j][0], new[1], held[j][2], new[3], -1]
            del held[j:]
    return [(x[1] - x[0], x[2], x[3]) for x in held]


def scan_rows(weights: dict[str, float], penalty: float):
    """mapInArrow: (doc_id, text) -> (doc_id, words, best, passages): all maximal segments with their places by words."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        passage = pa.struct([("score", pa.float64()), ("first", pa.int32()), ("last", pa.int32())])
        hits: dict[str, float] = {}
        seen: set[str] = set()
        for batch in batches:
            n_words, best, found = [], [], []
            for text in batch.column(1).to_pylist():
                words = WORD.findall((text or "").lower())
                new = set(words).difference(seen)
                if len(seen) + len(new) > KEPT_WORDS:
                    seen.clear()
                    hits.clear()
                    new = set(words)
                for w in new:
                    s = max([weights[f] for f in features(w) if f in weights], default=0.0)
                    if s:
                        hits[w] = s
                seen.update(new)
                got = segments([(i, hits[w]) for i, w in enumerate(words) if w in hits], penalty)
                n_words.append(len(words))
                best.append(max([s for s, _, _ in got], default=0.0))
                found.append([{"score": s, "first": a, "last": b} for s, a, b in got])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(best, pa.float64()), pa.array(found, pa.list_(passage))], names=["doc_id", "words", "best", "passages"])

    return run


def solve_lambda(shares: np.ndarray, scores: np.ndarray, penalty: float) -> float:
    """The positive root of E[exp(lambda * score)] = 1 over the tokens of the corpus."""
    rest = 1.0 - shares.sum()
    f = lambda x: float((shares * np.exp(np.minimum(x * scores, 700))).sum() + rest * math.exp(-x * penalty) - 1)
    lo, hi = 1e-9, 1.0
    while f(hi) < 0 and hi < 64:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return hi


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-5) -> np.ndarray:
    """Newton's method; the last coefficient is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) / len(x) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, sample: DataFrame) -> dict:
    """The token scores, penalty and lambda. docs: doc_id, text. sample: doc_id, toxic (bounded)."""
    labelled = docs.join(F.broadcast(sample), "doc_id", "left")
    toxic = stage(arrow_map(labelled.where("toxic = 1").select("text"), toxic_features, "feature string, docs long, n long"), "toxic-features")
    # The sample bounds the number of candidates.
    rows = toxic.groupBy("feature").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).where(F.col("docs") >= MIN_DOCS).collect()
    rows.sort(key=lambda r: r["feature"])
    candidates = {r["feature"]: i for i, r in enumerate(rows)}
    y_t = np.array([r["n"] for r in rows], float)
    n_t = float(toxic.where(~F.col("feature").endswith("*")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    counts = arrow_map(labelled.select("text", "toxic"), corpus_counts(candidates), "hits string, n long, clean long")
    counts = counts.groupBy("hits").agg(F.sum("n").alias("n"), F.sum("clean").alias("clean")).collect()
    total, n_c = float(sum(r["n"] for r in counts)), float(sum(r["clean"] for r in counts))
    every, y_c = np.zeros(len(rows)), np.zeros(len(rows))
    for r in counts:
        for k in filter(None, r["hits"].split(",")):
            every[int(k)] += r["n"]
            y_c[int(k)] += r["clean"]
    if not rows or not n_t or not n_c:
        return {"weights": {}, "penalty": 1.0, "lambda": 1.0}
    a = PRIOR * np.maximum(every, y_t) / max(total, 1.0)
    delta = np.log((y_t + a) / np.maximum(n_t + PRIOR - y_t - a, 1)) - np.log((y_c + a) / np.maximum(n_c + PRIOR - y_c - a, 1))
    score = delta - ERRORS * np.sqrt(1 / (y_t + a) + 1 / (y_c + a))
    weights = {f: float(score[i]) for f, i in candidates.items() if score[i] >= LEAST}
    # Tokens score by their best feature.
    shares, values = [], []
    for r in counts:
        s = max([score[int(k)] for k in filter(None, r["hits"].split(","))], default=0.0)
        if s >= LEAST:
            shares.append(r["n"] / total)
            values.append(s)
    shares, values = np.array(shares), np.array(values)
    # The root of E[exp(lambda * score)] = 1 over the tokens of the corpus is what lambda is without a tail to fit it to.
    hit = float(sum(y_t[i] for f, i in candidates.items() if f in weights and not f.endswith("*"))) / n_t
    penalty = max(0.02, -math.log(max(1e-6, 1 - min(0.5, hit))), 2 * float((shares * values).sum()))
    return {"weights": weights, "penalty": penalty, "lambda": solve_lambda(shares, values, penalty) if len(shares) else 1.0}


def fit_tail(best: np.ndarray, words: np.ndarray, fallback: float) -> tuple[float, float]:
    """lambda and K of the law of the best segments of clean texts, by maximum likelihood over what is above their BODY quantile; of the others only that they
    are below counts. With fewer than LEAST_TAIL texts above, lambda is `fallback`."""
    if not len(best):
        return fallback, 1.0
    n, start = np.maximum(words, 1.0), max(0.0, float(np.quantile(best, BODY)))
    held, over = np.maximum(best, start), best > start
    tail = int(over.sum())

    def weights(lam: float) -> np.ndarray:
        return n * np.exp(-lam * (held - start))

    lam = fallback
    if tail >= LEAST_TAIL:
        lo, hi = 1e-3, 64.0
        for _ in range(100):
            lam = (lo + hi) / 2
            e = weights(lam)
            rises = tail / lam - best[over].sum() + tail * (e * held).sum() / e.sum() > 0
            lo, hi = (lam, hi) if rises else (lo, lam)
    return lam, max(tail, 0.5) / float(weights(lam).sum()) * math.exp(min(700.0, lam * start))


def surprise(lam: float, k: float, scores: Column, words: Column) -> Column:
    """-ln of the p-value of a text's significant segments together: of the sum T of the r best normalised scores, p = exp(-T) T^(r-1) / (r! (r-1)!), the least
    over r. Without any it is 0."""
    size = F.log(F.lit(k) * F.greatest(words, F.lit(1)))
    x = F.reverse(F.array_sort(F.filter(F.transform(scores, lambda s: F.lit(lam) * s - size), lambda v: v >= F.lit(-math.log(ALPHA)))))
    zero = F.struct(F.lit(0.0).alias("r"), F.lit(0.0).alias("t"), F.lit(0.0).alias("f"), F.lit(0.0).alias("top"))

    def step(state: Column, v: Column) -> Column:
        r, t = state["r"] + 1, state["t"] + v
        f = state["f"] + F.log(r)  # ln r!
        return F.struct(r.alias("r"), t.alias("t"), f.alias("f"), F.greatest(state["top"], t + 2 * f - F.log(r) - (r - 1) * F.log(F.greatest(t, F.lit(1.0)))).alias("top"))

    return F.aggregate(x, zero, step, lambda state: state["top"])


def labelled_sample(labels: DataFrame, folds: int, held: int, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> DataFrame:
    """(doc_id, toxic): a bounded sample of the labels outside the held-out fold, those with the least hashes of their ids.
    A document with several labels is toxic if one says so."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc32_mod(F.col("doc_id"), folds) != held)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {1: min(1.0, toxic / max(1, n.get(1, 0))), 0: min(1.0, clean / max(1, n.get(0, 0)))}
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(((F.col("toxic") == 1) & (hashed < share[1])) | ((F.col("toxic") == 0) & (hashed < share[0])))


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """One row per row of docs: doc_id, held_out (crc32(doc_id) mod folds is `held`), score, predicted, n_passages, passages (the significant
    segments: score, first and last word).

    Null and empty texts score as texts without words. Very long texts are scanned whole. Without labels of both kinds there is nothing to learn, and all
    score 0. Repeated rows score alike, and a labelled doc_id that stands in several rows is one example; rows without doc_id are none. Extra columns don't matter,
    whatever their names. Empty table: no rows."""
    texts = doc_text(docs)
    sample = stage(labelled_sample(labels, folds, held), "toxic-sample")
    model = learn(texts, sample)
    found = stage(arrow_map(texts, scan_rows(model["weights"], model["penalty"]), "doc_id long, words long, best double, passages array<struct<score:double,first:int,last:int>>"), "toxic-found")
    # One row for each document of the bounded sample.
    known = found.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct("words", "best", F.transform("passages", lambda p: p["score"]).alias("scores"))).alias("x"))
    known = stage(known.select("toxic", "x.*"), "toxic-known")
    clean = known.where("toxic = 0").select("best", "words").toArrow()
    lam, k = fit_tail(*[clean.column(c).to_numpy().astype(float) for c in ("best", "words")], model["lambda"])
    rows = known.select("toxic", surprise(lam, k, F.col("scores"), F.col("words")).alias("x")).toArrow()
    y, x = (rows.column(c).to_numpy().astype(float) for c in ("toxic", "x"))
    out = found.withColumn("x", surprise(lam, k, F.transform("passages", lambda p: p["score"]), F.col("words")))
    if len(y) and 0 < y.sum() < len(y):
        w = logistic(np.sqrt(x)[:, None], y)
        score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.sqrt("x") * F.lit(float(w[0])) + F.lit(float(w[1]))))))
    else:
        score = F.lit(0.0)
    least = F.log(F.lit(k / ALPHA) * F.greatest(F.col("words"), F.lit(1)))
    passages = F.filter("passages", lambda p: F.lit(lam) * p["score"] >= least)
    out = out.withColumn("score", score).withColumn("passages", passages)
    return out.select(
        "doc_id", F.coalesce(crc32_mod(F.col("doc_id"), folds) == F.lit(held), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= F.lit(THRESHOLD)).cast("int").alias("predicted"), F.size("passages").alias("n_passages"), "passages",
    )
