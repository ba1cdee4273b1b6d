"""Best-fit packing planned on a histogram of lengths.

Documents are tokenised into pieces of at most ``capacity`` tokens. Only the count of pieces by length reaches the
planner (at most ``capacity`` numbers): best fit decreasing runs over counts, a step placing every piece of one length
at once, so its work and its plan depend on the capacity alone. A piece then takes the planned slot of its rank within
its length. Ranks come from counts by written task and length, so one very common length needs no common task.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, doc_text, stage, tokenizer_path

CAPACITY = 2048
END_ID = 0
#: Words whose ids a task keeps at most before it starts anew; bounds the memory of a worker, not what is encoded.
KEPT_WORDS = 400_000
#: Characters of texts whose new words are encoded together, about.
GROUP_CHARS = 1 << 18
#: Plain texts: Latin letters, digits, ASCII marks but the apostrophe, ASCII white space. Their pre-tokens are runs of letters,
#: single digits and runs of marks.
LETTERS, MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "!-&(-/:-@\\[-`{-~"
PLAIN, PRETOKEN = re.compile(f"[{LETTERS}0-9{MARKS} \\n\\t\\r]*"), re.compile(f"[{LETTERS}]+|[0-9]|[{MARKS}]+")
WHITE = re.compile("[ \\t\\n\\r]+")
#: Texts that tell whether a tokenizer works word by word.
PROBES = ("Don't Stop  the\tWORLD", "A b\n\n12 ok! (x)", " two  \r\n Words ")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def works_by_word(tokenizer: str) -> bool:
    """Whether a tokenizer lower-cases, drops white space and never joins across it, and marks the ends of words."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer)
    ids = lambda text: tok.encode(text, add_special_tokens=False).ids
    return any(w.endswith("</w>") for w in tok.get_vocab()) and all(ids(text) == [i for w in text.lower().split() for i in ids(w)] for text in PROBES)


def encode_pieces(tokenizer: str, capacity: int, end_id: int, by_word: bool = True):
    """A mapInArrow function over (doc_id, text). by_word: the tokenizer works word by word, so each distinct word of a task is encoded once; else every text is
    encoded as it is."""

    def run(batches: Iterator) -> Iterator:
        import os
        import zlib
        from collections import Counter
        from itertools import chain

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tok = Tokenizer.from_file(tokenizer)
        tok.encode_special_tokens = True
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        parts: dict[str, bytes] = {}  # ids of pre-tokens
        whole: dict[str, bytes] = {}  # ids of words of other texts
        seen: Counter = Counter()
        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        vocabulary = tok.get_vocab()
        ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True

        def fast(texts: list[str]) -> list:
            return tok.encode_batch_fast(texts, add_special_tokens=False)

        def learn(fresh: list[str]) -> None:
            """Encodes pre-tokens many at a time; as each ends in an id of a word's end, their ids come apart again."""
            for lo in range(0, len(fresh), 512):
                some = fresh[lo : lo + 512]
                ids = np.array(fast([" ".join(some)])[0].ids, "<u4")
                cuts = np.flatnonzero(ends[ids]) + 1
                if len(cuts) != len(some):  # not a vocabulary with word ends
                    parts.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(some, fast(some)))
                    continue
                data, at = ids.tobytes(), 0
                for p, cut in zip(some, (4 * cuts).tolist()):
                    parts[p] = data[at:cut]
                    at = cut

        def learn_whole(fresh: list[str]) -> None:
            whole.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(fresh, fast(fresh)))

        def encode(texts: list[str]) -> Iterator[bytes]:
            """Texts of plain characters fall into pre-tokens by a plain rule; of other texts, words are encoded whole. New words of all texts are encoded together."""
            split = [(PRETOKEN.findall(t.lower()), parts) if PLAIN.fullmatch(t) else (WHITE.split(t), whole) for t in texts]
            for kept, learner in ((parts, learn), (whole, learn_whole)):
                new: set[str] = set()
                for words in (words for words, own in split if own is kept):
                    new.update(set(words).difference(kept))
                if len(kept) + len(new) > KEPT_WORDS:
                    kept.clear()
                    new.update(*[words for words, own in split if own is kept])
                if new:
                    learner(list(new))
            for words, kept in split:
                yield b"".join(map(kept.__getitem__, words))

        def encode_whole(texts: list[str]) -> Iterator[bytes]:
            for text in texts:
                yield np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

        def groups(texts) -> Iterator[list[str]]:
            group, size = [], 0
            for k in range(len(texts)):
                group.append(texts[k].as_py() or "")
                size += len(group[-1])
                if size >= GROUP_CHARS:
                    yield group
                    group, size = [], 0
            if group:
                yield group

        encoded = encode if by_word else encode_whole
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            out: list[list] = [[] for _ in range(7)]
            for doc_id, data in zip(ids, chain.from_iterable(map(encoded, groups(texts)))):
                data += end
                for piece, lo in enumerate(range(0, len(data), step)):
                    part = data[lo : lo + step]
                    n = len(part) // 4
                    for column, v in zip(out, (doc_id, piece, lo // 4, n, zlib.crc32(part), task, seen[n])):
                        column.append(v)
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return run


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int, int]]:
    """Best fit decreasing over counts. Returns runs (length, first, last, sequence, each, offset, 0): pieces of the length with
    ranks first <= r < last go, `each` to a sequence, to sequence + (r - first) // each at offset + ((r - first) % each) * length.

    A group is a run of sequences with the same filling, so the state is one list of groups for each room left. The
    pieces of a length fill the groups of the least room that holds them; each group is used whole but the last, which
    splits in at most three. There are so at most about 3 runs and 3 more groups for each length."""
    rooms: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, number)]
    order: list[int] = []  # rooms in use, ascending
    runs, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in rooms:
                rooms[room] = []
                bisect.insort(order, room)
            rooms[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(order, length)
            if at < len(order):
                room = order[at]
                first, n = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    order.pop(at)
            else:
                room, first, n = capacity, sequences, -(-left // (capacity // length))
                sequences += n
            each = room // length
            full = min(n, left // each)
            if full:
                runs.append((length, rank, rank + full * each, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            rest = n - full
            if rest and left:  # fewer than one sequence's worth are left
                runs.append((length, rank, rank + left, first + full, each, capacity - room))
                put(room - left * length, first + full, 1)
                rank, left, rest, full = rank + left, 0, rest - 1, full + 1
            put(room, first + full, rest)
    return runs


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts give one piece, the end id alone. Repeated rows are packed as often as they stand. Very long
    texts are cut into pieces of `capacity` tokens, nothing else is cut. Other columns don't matter, whatever their names. tokenizer: any tokenizer file; which of
    equally long pieces takes which slot is not fixed. Empty table: no rows."""
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path("word_bpe_49k.json")
    pieces = stage(arrow_map(doc_text(docs), encode_pieces(tokenizer, capacity, end_id, works_by_word(tokenizer)), PIECES), "pack-pieces")
    by_task = stage(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "pack-counts")
    counts = {int(r["length"]): int(r["n"]) for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs = plan(counts, capacity)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = pieces.join(by_task.select("task", "length", before.alias("before")), ["task", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    slots = spark.createDataFrame(runs, "length long, first long, last long, sequence long, each long, at long")
    placed = ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    nth = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (nth % F.col("each")) * ranked["length"]).cast("long").alias("offset"),
    )
