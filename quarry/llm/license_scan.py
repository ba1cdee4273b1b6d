"""License scans by an exact set-similarity join.

Template notices are joined with the text blocks of all documents on containment. A block is any stretch of consecutive words, over line
breaks, blank lines and comment marks, that is as long as the notice by THRESHOLD; it matches if it holds at least
THRESHOLD of the notice's distinct words, and all of those that tell the license from others. Words are ordered by their document
frequency in the whole corpus, rarest first. A block that holds c of a template's n words must hold one of its first n - c + 1
(prefix filter), its document must have c of them at all (length filter), and where the first common word stands at places i and
j, there must be enough words left behind both (positional filter). Only stretches around words of the prefix are looked at then, and
every one of them is verified, so the join is exact. The templates are a bounded table and are sent to all tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, doc_text

THRESHOLD = 0.8
WORD = rb"[0-9a-z\x80-\xff]+"
#: Phrases whose places are counted, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: (label, notice, the words without which a stretch is no such notice).
TEMPLATES = (
    ("mit", "Released under the MIT License", "mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction", ""),
    ("apache", "Licensed under the Apache License, Version 2.0", "apache license"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", "general public license"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "general public license"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ""),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla"),
)
#: Characters of all notices of a template table at most; it is sent to all tasks.
MAX_TEMPLATE_CHARS = 32 << 20


def words_of(text: bytes) -> list[bytes]:
    return re.findall(WORD, text.lower())


@dataclass(frozen=True)
class Template:
    label: str
    words: frozenset[bytes]
    keys: frozenset[bytes]
    #: Words of a block.
    room: int
    #: Distinct words that a block must hold.
    need: int


def read_templates(templates: Sequence[tuple[str, str, str]] | DataFrame = TEMPLATES, threshold: float = THRESHOLD) -> list[Template]:
    """templates: (label, notice, keys), or a DataFrame with these columns (keys may be null). Notices without words match nothing and go."""
    if isinstance(templates, DataFrame):
        rows = templates.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("label", "notice", "keys")])
        chars = rows.agg(F.sum(F.length("notice"))).first()[0] or 0
        if chars > MAX_TEMPLATE_CHARS:
            raise ValueError(f"templates of {chars} characters are more than {MAX_TEMPLATE_CHARS}")
        templates = sorted(map(tuple, rows.collect()))
    out = []
    for label, notice, keys in templates:
        words = words_of(notice.encode())
        if words:
            own = frozenset(words)
            out.append(Template(label, own, frozenset(words_of(keys.encode())) & own, max(len(own), floor(len(words) / threshold + 1e-9)), max(1, ceil(threshold * len(own) - 1e-9))))
    return out


def document_frequency(texts: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """In how many documents each word of the templates stands, counted in the JVM. One row for each of these words at most comes back."""
    lower = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    own = F.array_intersect(words, F.array(*[F.lit(w.decode()) for w in sorted(vocabulary)]).cast("array<string>"))
    rows = texts.select(F.explode(own).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    return {r["word"].encode(): r["n"] for r in rows}


class Index:
    """Templates by the words of their prefixes, in global order of frequency."""

    def __init__(self, templates: list[Template], frequency: dict[bytes, int]):
        self.templates = templates
        self.rank = {w: i for i, w in enumerate(sorted({w for t in templates for w in t.words}, key=lambda w: (frequency.get(w, 0), w)))}
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        self.prefixes: list[frozenset[bytes]] = []
        for k, t in enumerate(templates):
            order = sorted(t.words, key=self.rank.__getitem__)[: len(t.words) - t.need + 1]
            self.prefixes.append(frozenset(order))
            for i, w in enumerate(order):
                self.prefix.setdefault(w, []).append((k, i))
        self.least = min((t.need for t in templates), default=1)

    def candidates(self, have: set[bytes]) -> list[int]:
        """The templates that a set of words holds to the threshold; of any other, no part of the set does."""
        own = sorted(self.rank.keys() & have, key=self.rank.__getitem__)
        if len(own) < self.least:
            return []
        met, out = set(), []
        for j, w in enumerate(own):
            for k, i in self.prefix.get(w, ()):
                if k in met:
                    continue
                met.add(k)  # this is the first common word: a later one can only leave less behind it
                t = self.templates[k]
                if len(own) < t.need or 1 + min(len(t.words) - i - 1, len(own) - j - 1) < t.need or not t.keys <= have:
                    continue
                if len(t.words.intersection(own)) >= t.need:
                    out.append(k)
        return out

    def matches(self, words: list[bytes], have: set[bytes]) -> list[tuple[int, float]]:
        """(template, greatest containment) of all templates that some block of a text's words matches."""
        out = []
        candidates = self.candidates(have)
        if candidates:
            wanted = frozenset().union(*[self.templates[k].words for k in candidates])
            hits = [(i, w) for i, w in enumerate(words) if w in wanted]
        for k in candidates:
            t, anchors = self.templates[k], self.prefixes[k]
            at = [i for i, w in hits if w in anchors]
            counts: dict[bytes, int] = {}
            best = start = overlap = keys = n = 0
            own = []
            for i, w in hits:
                if w in t.words:
                    while n < len(at) and at[n] < i:
                        n += 1
                    if (n < len(at) and at[n] - i < t.room) or (n and i - at[n - 1] < t.room):
                        own.append((i, w))
            for i, w in own:
                counts[w] = counts.get(w, 0) + 1
                if counts[w] == 1:
                    overlap += 1
                    keys += w in t.keys
                while own[start][0] <= i - t.room:
                    x = own[start][1]
                    start += 1
                    counts[x] -= 1
                    if not counts[x]:
                        overlap -= 1
                        keys -= x in t.keys
                if overlap > best and overlap >= t.need and keys == len(t.keys):
                    best = overlap
            if best:
                out.append((k, best / len(t.words)))
        return out


def scan_rows(index: Index, phrases=PHRASES):
    """mapInArrow: (doc_id, text) -> (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    ends: dict[bytes, list[tuple[list[bytes], str]]] = {}
    for phrase, label in phrases:
        words = words_of(phrase.encode())
        ends.setdefault(words[-1], []).append((words, label))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        find = re.compile(WORD).findall
        prefix = frozenset(index.prefix)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            out: list[list] = [[] for _ in types]
            for k in range(len(texts)):
                words = find((texts[k].as_py() or b"").lower())
                have = set(words)
                starts, base, score = [], set(), 0.0
                for end, wanted in ends.items():
                    if end in have:
                        at = -1
                        for _ in range(words.count(end)):
                            at = words.index(end, at + 1)
                            for phrase, label in wanted:
                                start = at - len(phrase) + 1
                                if start >= 0 and words[start : at + 1] == phrase:
                                    starts.append(start)
                                    base.add(label)
                                    score = 1.0
                labels = set(base)
                if not prefix.isdisjoint(have):
                    for t, c in index.matches(words, have):
                        labels.add(index.templates[t].label)
                        score = max(score, c)
                row = (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)
                for column, v in zip(out, row):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, t) for v, t in zip(out, types)]], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return run


def scan(docs: DataFrame, templates: Sequence[tuple[str, str, str]] | DataFrame = TEMPLATES, threshold: float = THRESHOLD, phrases=PHRASES) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_base (places of phrases), first_word, last_word (their least and greatest start, else
    null), base_labels, labels, score (the greatest containment of a matched template, 1 with a phrase, else 0).

    Null and empty texts have no words. Texts are read whole, whatever their length; repeated rows give equal rows, and equal matches one label.
    Other columns of docs don't matter, whatever their names. Empty table: no rows."""
    texts, known = doc_text(docs), read_templates(templates, threshold)
    frequency = document_frequency(texts, frozenset(w for t in known for w in t.words))
    return arrow_map(texts, scan_rows(Index(known, frequency), phrases), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def oracle(templates: Sequence[tuple[str, str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same rows in DuckDB SQL, by comparing every stretch of every text with every template that the whole text could hold."""
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    quoted = lambda words: "[" + ", ".join(repr(w.decode()) for w in sorted(words)) + "]::VARCHAR[]"
    rows = ",\n".join(f"('{t.label}', {quoted(t.words)}, {quoted(t.keys)}, {t.room}, {t.need})" for t in read_templates(templates, threshold))
    return f"""
WITH t(label, own, keys, room, need) AS (VALUES
{rows}),
w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {word}) AS words FROM documents),
p AS (SELECT rid, doc_id, len(words)::BIGINT AS n_words,
  list_filter(range(len(words)), lambda i: words[i + 1] = 'mit' AND words[i + 2] = 'license') AS mit,
  list_filter(range(len(words)), lambda i: words[i + 1] = 'apache' AND words[i + 2] = 'license') AS apache,
  list_filter(range(len(words)), lambda i: words[i + 1] = 'general' AND words[i + 2] = 'public' AND words[i + 3] = 'license') AS gpl FROM w),
able AS (SELECT w.rid, w.words, t.* FROM w, t WHERE len(list_intersect(w.words, t.own)) >= t.need),
blocks AS (SELECT rid, label, own, keys, need, words, room, unnest(range(greatest(len(words) - room, 0) + 1)) AS pos FROM able),
m AS (SELECT rid, label, len(list_intersect(b, own)) / len(own) AS c FROM (SELECT *, words[pos + 1 : pos + room] AS b FROM blocks) WHERE len(list_intersect(b, own)) >= need AND len(list_intersect(b, keys)) = len(keys)),
g AS (SELECT rid, list(DISTINCT label) AS labels, max(c) AS c FROM m GROUP BY rid),
r AS (SELECT p.*, list_concat(mit, apache, gpl) AS starts, list_concat(CASE WHEN len(apache) > 0 THEN ['apache'] ELSE [] END, CASE WHEN len(gpl) > 0 THEN ['gpl'] ELSE [] END, CASE WHEN len(mit) > 0 THEN ['mit'] ELSE [] END) AS base FROM p)
SELECT doc_id, n_words, len(starts)::BIGINT AS n_base, list_min(starts)::BIGINT AS first_word, list_max(starts)::BIGINT AS last_word, array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(g.labels, [])))), ',') AS labels,
  CASE WHEN len(starts) > 0 THEN 1.0 ELSE coalesce(g.c, 0.0) END::DOUBLE AS score
FROM r LEFT JOIN g USING (rid)"""
