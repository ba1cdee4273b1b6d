"""Language identification with a linear-chain conditional random field.

Every word gets a label. A word's features are its affixes, its letter n-grams and the lexicons it stands in (words that
the labelled sample has almost only in one language); transition weights between the labels of neighbours are learned
with them. Forward-backward gives each word's label probabilities, so the words of a code-switched text are labelled one
by one; a document's language is the label with most probability over all its words, repeated ones counting less.

Features are hashed to a table of fixed size, so the model's size depends on the number of languages alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, crc32_mod, doc_text

#: The chain is cut into stretches of so many words, in training and in use.
STRETCH = 64
#: Bound of the labelled sample: about so many documents a language, and stretches of a document.
SAMPLE_DOCS, SAMPLE_STRETCHES = 400, 4
FEATURES, UNKNOWN = 1 << 16, "und"
ROUNDS, RATE, DECAY = 40, 0.25, 1e-5
#: Words that a task keeps the emissions of, and words that it scores at once; both bound memory, neither what is scored.
KEPT_WORDS, FLUSH_WORDS = 300_000, 200_000
WORD = re.compile(r"[^\W\d_]+")
#: The model without anything learned.
EMPTY = {"labels": [], "weights": np.zeros((FEATURES, 0), np.float32), "transitions": np.zeros((0, 0)), "lexicon": {}, "prior": np.zeros(0)}


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(feature, word number) of lower-case words, all at once. With marks at both ends of a word, its letter 2- to 4-grams have its affixes
    among them; suffixes of 4 letters come on top. Lexicons have the numbers from FEATURES on."""
    points = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    owner = np.cumsum(points == ord("^"), dtype=np.int32) - np.int32(1)
    grams, owners = [], []
    for n in (2, 3, 4, 5):
        m = len(points) - n + 1
        if m <= 0:
            break
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = (h * np.uint64(1_000_003)) ^ points[k : k + m]
        inside = owner[:m] == owner[n - 1 :]
        if n == 5:
            inside &= points[n - 1 :] == ord("$")
        grams.append(((h[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 16)).astype(np.int32) % FEATURES)
        owners.append(owner[:m][inside])
    known = [(FEATURES + lexicon[w], i) for i, w in enumerate(words) if w in lexicon]
    grams.append(np.array([f for f, _ in known], np.int32))
    owners.append(np.array([i for _, i in known], np.int32))
    return np.concatenate(grams), np.concatenate(owners)


def emissions(words: list[str], weights: np.ndarray, lexicon: dict[str, int]) -> np.ndarray:
    """Label scores of words: the sum of their features' weights over the root of their number."""
    if not words:
        return np.zeros((0, weights.shape[1]), np.float32)
    flat, owner = word_features(words, lexicon)
    scale = np.maximum(1, np.bincount(owner, minlength=len(words))) ** -0.5
    return np.stack([np.bincount(owner, weights[flat, j], len(words)) * scale for j in range(weights.shape[1])], axis=1).astype(np.float32)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """scores [stretches, STRETCH, labels] with stretches in descending order of length -> label probabilities of the same shape
    (zero beyond a stretch's length), and with pairs the expected counts of label pairs and the log partition sums."""
    n, t, k = scores.shape
    active = [int(np.searchsorted(-lengths, -i, side="left")) for i in range(t + 1)]  # stretches longer than i
    step = np.exp(transitions)
    top = scores.max(axis=2, keepdims=True)
    e = np.exp(scores - top)
    alpha, scale = np.zeros_like(e), np.ones((n, t), e.dtype)
    for i in range(t):
        m = active[i]
        if not m:
            break
        a = e[:m, i] * (alpha[:m, i - 1] @ step if i else 1.0)
        scale[:m, i] = a.sum(axis=1)
        alpha[:m, i] = a / scale[:m, i, None]
    beta = np.ones_like(e)
    expected = np.zeros((k, k))
    for i in range(t - 2, -1, -1):
        m = active[i + 1]
        if m:
            ahead = e[:m, i + 1] * beta[:m, i + 1] / scale[:m, i + 1, None]
            if pairs:
                expected += step * (alpha[:m, i].T @ ahead)
            beta[:m, i] = ahead @ step.T
    gamma = alpha * beta
    total = gamma.sum(axis=2, keepdims=True)
    gamma = np.divide(gamma, total, out=np.zeros_like(gamma), where=total > 0)
    return (gamma, expected) if pairs else gamma


def train(samples: list[tuple[str, list[str]]], seed: int = 7) -> dict:
    """samples: (language, words of a stretch). Returns the model: labels, weights [FEATURES + labels, labels], transitions, lexicon.

    A quarter of the stretches are spliced from two, so that the chain learns that languages do change, and how seldom."""
    labels = sorted({lang for lang, _ in samples})
    k, rng = len(labels), np.random.default_rng(seed)
    place = {lang: i for i, lang in enumerate(labels)}
    counts: dict[str, np.ndarray] = {}
    for lang, words in samples:
        for w in words:
            counts.setdefault(w, np.zeros(k, np.int32))[place[lang]] += 1
    lexicon = {w: int(c.argmax()) for w, c in counts.items() if c.sum() >= 8 and c.max() >= 0.9 * c.sum()}
    vocabulary = {w: i for i, w in enumerate(counts)}
    flat, owner = word_features(list(vocabulary), lexicon)
    scale = np.maximum(1, np.bincount(owner, minlength=len(vocabulary))) ** -0.5
    stretches = []
    for lang, words in samples:
        ids, gold = [vocabulary[w] for w in words], [place[lang]] * len(words)
        if rng.random() < 0.25 and len(words) > 4:
            other, more = samples[int(rng.integers(len(samples)))]
            cut = int(rng.integers(1, len(words)))
            ids, gold = ids[:cut] + [vocabulary[w] for w in more[cut:]], gold[:cut] + [place[other]] * len(more[cut:])
        stretches.append((ids, gold))
    stretches.sort(key=lambda x: -len(x[0]))
    n = len(stretches)
    lengths = np.array([len(s[0]) for s in stretches])
    at = np.concatenate([np.arange(m) + i * STRETCH for i, m in enumerate(lengths)])
    ids, gold = np.concatenate([s[0] for s in stretches]), np.concatenate([s[1] for s in stretches])
    observed = np.zeros((k, k))
    for _, g in stretches:
        np.add.at(observed, (g[:-1], g[1:]), 1)
    onehot = np.eye(k)[gold]
    size = FEATURES + k
    params = [np.zeros((size, k)), np.zeros((k, k))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for r in range(1, ROUNDS + 1):
        words = np.stack([np.bincount(owner, params[0][flat, j], len(vocabulary)) * scale for j in range(k)], axis=1)
        scores = np.zeros((n * STRETCH, k), np.float32)
        scores[at] = words[ids]
        gamma, expected = forward_backward(scores.reshape(n, STRETCH, k), lengths, params[1], pairs=True)
        slip = onehot - gamma.reshape(-1, k)[at]
        by_word = np.stack([np.bincount(ids, slip[:, j], len(vocabulary)) for j in range(k)], axis=1) * scale[:, None]
        grads = [np.stack([np.bincount(flat, by_word[owner, j], size) for j in range(k)], axis=1) / len(ids), (observed - expected) / len(ids)]
        for p, g, u, v in zip(params, grads, first, second):  # Adam, ascending
            g = g - DECAY * p
            u += 0.1 * (g - u)
            v += 0.01 * (g * g - v)
            p += RATE * (u / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    return {"labels": labels, "weights": params[0].astype(np.float32), "transitions": params[1], "lexicon": lexicon, "prior": np.full(k, 1 / k)}


def sample_stretches(per_doc: int):
    """A mapInArrow function: (lang, text) -> (lang, words, lines): up to per_doc stretches of a text, evenly spread over all of it, and for each word
    the hash of its line."""

    def run(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        for batch in batches:
            langs, out, out_lines = [], [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, lines = [], []
                for line in (text or "").lower().split("\n"):
                    found = WORD.findall(line)
                    words += found
                    lines += [zlib.crc32(line.strip().encode("utf-8", "replace"))] * len(found)
                starts = range(0, len(words), STRETCH)
                for start in [starts[i * len(starts) // min(per_doc, len(starts))] for i in range(min(per_doc, len(starts)))]:
                    langs.append(lang)
                    out.append(words[start : start + STRETCH])
                    out_lines.append(lines[start : start + STRETCH])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.list_(pa.string())), pa.array(out_lines, pa.list_(pa.int64()))], names=["lang", "words", "lines"])

    return run


def own_lines(rows: list[tuple[str, list[str], list[int]]]) -> list[tuple[str, list[str]]]:
    """(language, words) of the stretches without lines that stand under several languages, and without stretches of repetitions: neither says much
    of a text's language."""
    under: dict[int, set[str]] = {}
    for lang, _, lines in rows:
        for h in set(lines):
            under.setdefault(h, set()).add(lang)
    kept = [(lang, [w for w, h in zip(words, lines) if len(under[h]) == 1]) for lang, words, lines in rows]
    kept = [(lang, words) for lang, words in kept if words and 2 * len(set(words)) >= len(words)]
    return kept if {lang for lang, _ in kept} == {lang for lang, _, _ in rows} else [(lang, words) for lang, words, _ in rows]


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, per_doc: int = SAMPLE_STRETCHES) -> dict:
    """labelled: doc_id, text, lang. Fits the model on about sample_docs documents of each language, those with the least hashes of
    their ids. The sample alone comes to the driver."""
    counts = {r["lang"]: r["n"] for r in labelled.where("lang is not null").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = {lang: min(1.0, sample_docs / n) for lang, n in counts.items()}
    if not share:
        return EMPTY
    limit = F.create_map(*[F.lit(x) for kv in share.items() for x in kv])
    # Rows without an id are told apart by their texts.
    hashed = F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64(F.col("doc_id").cast("string"))), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = labelled.where(F.col("lang").isNotNull() & (hashed < F.element_at(limit, F.col("lang")))).select("lang", "text")
    rows = arrow_map(chosen, sample_stretches(per_doc), "lang string, words array<string>, lines array<long>").collect()
    samples = own_lines(sorted((r["lang"], list(r["words"]), list(r["lines"])) for r in rows if r["words"]))
    if not samples:
        return EMPTY
    model = train(samples)
    known = np.array([counts[lang] for lang in model["labels"]], float)
    return model | {"prior": known / known.sum()}


class Labeller:
    """Scores texts, many at a time; keeps the emissions of the words it has met."""

    def __init__(self, model: dict):
        self.model, self.known = model, {}
        self.k = len(model["labels"])
        self.table = np.zeros((1024, self.k), np.float32)

    def word_probabilities(self, docs: list[list[str]]) -> np.ndarray:
        """Label probabilities of all words of docs, one after the other."""
        flat = [w for words in docs for w in words]
        new = list(set(flat).difference(self.known))
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known.clear()
            new = list(set(flat))
        first = len(self.known)
        if first + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((max(len(self.table), first + len(new)), self.k), np.float32)])
        for lo in range(0, len(new), 20_000):
            part = new[lo : lo + 20_000]
            self.table[first + lo : first + lo + len(part)] = emissions(part, self.model["weights"], self.model["lexicon"])
        self.known.update(zip(new, range(first, first + len(new))))
        self.ids = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        scores = self.table[self.ids]
        lengths = np.array([len(d) for d in docs], np.int64)
        per = -(-lengths // STRETCH)
        base = np.concatenate([[0], np.cumsum(per)])[:-1]
        inside = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        stretch = np.repeat(base, lengths) + inside // STRETCH
        size = np.bincount(stretch, minlength=int(per.sum()))
        order = np.argsort(-size, kind="stable")
        row = np.empty_like(order)
        row[order] = np.arange(len(order))
        at = row[stretch] * STRETCH + inside % STRETCH
        padded = np.zeros((len(order) * STRETCH, self.k), np.float32)
        padded[at] = scores
        gamma = forward_backward(padded.reshape(-1, STRETCH, self.k), size[order], self.model["transitions"].astype(np.float32))
        return gamma.reshape(-1, self.k)[at]

    def languages(self, docs: list[list[str]]) -> np.ndarray:
        """Label probabilities of each of docs (all with words): the mean over its words, in which a word that stands there n times counts as much
        as the root of n words, and the languages' shares of the labelled documents count as one word. What is repeated a hundred times isn't a hundred times the evidence."""
        p = self.word_probabilities(docs).astype(np.float64)
        lengths = np.array([len(d) for d in docs])
        _, where, n = np.unique(np.repeat(np.arange(len(docs)), lengths) * len(self.table) + self.ids, return_inverse=True, return_counts=True)
        weight = n[where] ** -0.5
        first = np.cumsum(lengths) - lengths
        prior = self.model["prior"]  # weighs as much as one word
        return (np.add.reduceat(p * weight[:, None], first, axis=0) + prior) / (np.add.reduceat(weight, first)[:, None] + 1)


def predict_rows(model: dict, text_name: str = "text"):
    """A mapInArrow function: adds lang_pred and score to the columns."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import regex

        letter = regex.compile(r"\p{L}")
        labeller, labels = Labeller(model), model["labels"]
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_name))
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            held, docs, words = [], [], 0

            def flush() -> None:
                if docs:
                    p = labeller.languages(docs)
                    for k, best, s in zip(held, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                        lang[k], score[k] = labels[best], min(1.0, max(0.0, s))
                    held.clear()
                    docs.clear()

            for k in range(len(texts)):
                text = texts[k].as_py()
                if text and labels and letter.search(text):
                    found = WORD.findall(text.lower())
                    if found:
                        held.append(k)
                        docs.append(found)
                        words += len(found)
                if words >= FLUSH_WORDS:
                    flush()
                    words = 0
            flush()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*batch.schema.names, "_lang_pred", "_score"])

    return run


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """docs (text and any other columns) with _lang_pred (`und` if the text is null or has no letter) and _score (its probability, the
    mean over the words, repeated ones counting less; 0 for `und`). Empty and very long texts, repeated rows and extra columns need nothing special; equal probabilities go to
    the first label by code point. Columns that already have one of the new names are replaced."""
    docs = docs.drop("_lang_pred", "_score")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return arrow_map(docs, predict_rows(model), schema + ", _lang_pred string, _score double")


def learner_rows(docs: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, text and lang of the documents that may be learned from."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return rows.where(~F.coalesce(crc32_mod(F.col("doc_id"), folds) == F.lit(held), F.lit(False)))


def train_and_identify(docs: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learns from the documents whose crc32(doc_id) mod folds isn't `held`; rows without doc_id are not held out. Where no row has a
    lang there is nothing to learn, and all are `und`. Nulls, ties and long texts as in `identify`. Empty table: no rows."""
    model = fit(learner_rows(docs, folds, held))
    fold = F.coalesce(crc32_mod(F.col("doc_id"), folds) == F.lit(held), F.lit(False))
    return identify(doc_text(docs), model).select("doc_id", fold.alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"))
