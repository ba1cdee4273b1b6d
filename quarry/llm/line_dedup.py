"""Line deduplication by winnowing over line hashes.

Lines are compared without outer white space; blank lines are not counted. A window is a stretch of MIN_LINES lines, or of fewer lines with at
least MIN_WORDS words. A window is repeated if the same lines stand at an earlier place and end there before it begins; all lines of repeated
windows go. As any longer run is covered by its windows, every line of every run that repeats an earlier one goes, whichever
earlier place that is.

* In each window the line with the least hash is selected (the first of equal ones): equal windows select the same line. A selected line is one
  fingerprint, however many windows selected it. What repeats has fingerprints that repeat, so fingerprints whose hash stands once in the corpus go
  at once, and with them most of the text.
* Places with the same fingerprint are joined, split by the hash of each of their windows, so that a line that a third of all documents
  share doesn't meet in one task. A class has one first place, which is joined to the others: no pairs.
* A match extends as far back and forward as further windows match; what overlaps or touches is one run.
* Lines of equal hashes are compared before anything goes. Where a hash stands for different lines, the classes with it are split by the
  lines themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, split_by_keys, stage

MIN_LINES, MIN_WORDS = 3, 50
SPOTS = "doc_id long, text_hash long, fp long, windows array<struct<first:int,hashes:array<long>>>"


def lines_of(text: bytes) -> list[bytes]:
    """The lines that aren't blank, without outer white space."""
    return [x for x in map(bytes.strip, text.split(b"\n")) if x]


def windows_of(words: list[int], min_lines: int, min_words: int) -> Iterator[tuple[int, int]]:
    """(first line, number of lines) of all windows of a text whose lines have so many words."""
    for first in range(len(words)):
        total = 0
        for n in range(1, min(min_lines, len(words) - first) + 1):
            total += words[first + n - 1]
            if n == min_lines or total >= min_words:
                yield first, n


def spot_rows(min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, digest=None):
    """A mapInArrow function: (doc_id, text_hash, text) -> SPOTS: each selected line once, with the windows that selected it. digest: bytes to an
    unsigned 64-bit hash."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        hashed = digest or xxhash.xxh3_64_intdigest
        for batch in batches:
            ids, hashes, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())
            out_doc, out_fp, sizes = [], [], []
            firsts, ns, parts = [], [], []
            for k in range(len(ids)):
                lines = lines_of(texts[k].as_py() or b"")
                h = [hashed(x) for x in lines]
                raw = np.array(h, "<u8").tobytes()
                by_place: dict[int, list[tuple[int, int]]] = {}
                for first, n in windows_of([len(x.split()) for x in lines], min_lines, min_words):
                    own = h[first : first + n]
                    by_place.setdefault(first + own.index(min(own)), []).append((first, n))
                for place, windows in by_place.items():
                    out_doc.append(k)
                    out_fp.append(h[place])
                    sizes.append(len(windows))
                    for first, n in windows:
                        firsts.append(first)
                        ns.append(n)
                        parts.append(raw[8 * first : 8 * (first + n)])
            signed = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
            ends = lambda v: pa.array(np.concatenate([[0], np.cumsum(np.array(v, np.int64))]).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends(ns), pa.array(np.frombuffer(b"".join(parts), "<i8")))
            windows = pa.StructArray.from_arrays([pa.array(firsts, pa.int32()), lists], names=["first", "hashes"])
            offsets, at = ends(sizes), pa.array(out_doc, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), signed(out_fp), pa.ListArray.from_arrays(offsets, windows)], names=["doc_id", "text_hash", "fp", "windows"])

    return run


#: A place of a window: earlier is by doc_id (null before all others), then by the hash of the text, then by line.
PLACE = ("doc_id", "text_hash", "first")


def later(src: str):
    """Whether a window stands behind the first place of its class and doesn't overlap it."""
    same = F.col("doc_id").eqNullSafe(F.col(f"{src}.doc_id")) & (F.col("text_hash") == F.col(f"{src}.text_hash"))
    return ~(same & (F.col("first") < F.col(f"{src}.first") + F.size("hashes")))


def matched_windows(docs: DataFrame, min_lines: int, min_words: int, digest=None) -> DataFrame:
    """(doc_id, text_hash, windows): for each document with a window that stands more than once, these windows: first, hashes (of its lines), and gone (it repeats
    an earlier one, as far as hashes tell). docs: doc_id, text_hash, text."""
    spots = stage(arrow_map(docs.select("doc_id", "text_hash", "text"), spot_rows(min_lines, min_words, digest), SPOTS), "lines-spots")
    shared = stage(spots.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "lines-shared")
    spots, _ = split_by_keys(spots, F.col("fp"), shared)  # what is left over is told apart by the classes
    windows = stage(spots.select("doc_id", "text_hash", F.explode("windows").alias("w")).select("doc_id", "text_hash", "w.*"), "lines-windows")
    place = F.struct(*PLACE)
    # Written, so that the join is between two plain scans and a class that very many places share can be split.
    first = stage(windows.groupBy("hashes").agg(F.min(place).alias("src"), F.max(place).alias("last")).where("src != last").drop("last"), "lines-first")
    found = windows.join(first, "hashes").withColumn("gone", later("src"))
    return found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "hashes", "gone")).alias("windows"))


def window_lines(batches: Iterator) -> Iterator:
    """mapInArrow: (text, windows) -> (hash, line): the lines of windows, once a batch."""
    import pyarrow as pa

    for batch in batches:
        seen: set[tuple[int, bytes]] = set()
        texts, windows = batch.column(0).cast(pa.binary()), batch.column(1).to_pylist()
        for k in range(batch.num_rows):
            lines = lines_of(texts[k].as_py() or b"")
            for w in windows[k]:
                seen.update(zip(w["hashes"], lines[w["first"] : w["first"] + len(w["hashes"])]))
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in seen], pa.int64()), pa.array([x for _, x in seen], pa.binary())], names=["hash", "line"])


def window_texts(batches: Iterator) -> Iterator:
    """mapInArrow: (doc_id, text_hash, text, windows) -> (doc_id, text_hash, first, hashes, lines) for each window."""
    import pyarrow as pa

    types = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary())
    for batch in batches:
        out: list[list] = [[] for _ in types]
        texts = batch.column(2).cast(pa.binary())
        for k in range(batch.num_rows):
            doc_id, text_hash, windows = (batch.column(i)[k].as_py() for i in (0, 1, 3))
            lines = lines_of(texts[k].as_py() or b"")
            for w in windows:
                for column, v in zip(out, (doc_id, text_hash, w["first"], w["hashes"], b"\n".join(lines[w["first"] : w["first"] + len(w["hashes"])]))):
                    column.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=[*PLACE, "hashes", "lines"])


def delete_runs(text_name: str):
    """A mapInArrow function: takes (columns of docs ..., windows), gives (columns ..., _n_lines, _n_deleted, _deleted_words). Windows that are gone and
    overlap or touch are one run, and blank lines inside a run go with it."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index(text_name)
            windows = batch.column(batch.num_columns - 1)
            texts = batch.column(at)
            out, n_lines, n_deleted, words = [], [], [], []
            for k in range(batch.num_rows):
                text = texts[k].as_py()
                lines = (text or "").split("\n")
                full = [i for i, x in enumerate(lines) if x.encode().strip()]
                n_lines.append(len(full))
                gone = set()
                for w in windows[k].as_py() or ():
                    if w["gone"]:
                        gone.update(range(w["first"], w["first"] + len(w["hashes"])))
                n_deleted.append(len(gone))
                if gone:
                    drop, n = set(), 0
                    for i in gone:
                        drop.add(full[i])
                        n += len(lines[full[i]].encode().split())
                        if i + 1 in gone:
                            drop.update(range(full[i], full[i + 1]))
                    words.append(n)
                    text = "\n".join(x for i, x in enumerate(lines) if i not in drop)
                else:
                    words.append(0)
                out.append(text)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[at] = pa.array(out, texts.type)
            extra = [pa.array(n_lines, pa.int32()), pa.array(n_deleted, pa.int32()), pa.array(words, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *extra], names=[*batch.schema.names[:-1], "_n_lines", "_n_deleted", "_deleted_words"])

    return run


WINDOWS = "array<struct<first:int,hashes:array<long>,gone:boolean>>"


def verified(touched: DataFrame) -> DataFrame:
    """touched (_run_doc, _run_hash, text, _windows and other columns) with the windows' `gone` as the lines themselves say. The lines of each hash are compared
    by their least and greatest; only classes with a hash of several lines are looked at again, by lines."""
    text = F.col("text").cast("string").alias("text")
    lines = arrow_map(touched.select(text, F.col("_windows").alias("windows")), window_lines, "hash long, line binary")
    mixed = stage(lines.groupBy("hash").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a != b").select("hash"), "lines-mixed")
    if mixed.isEmpty():
        return touched
    texts = arrow_map(touched.select(F.col("_run_doc").alias("doc_id"), F.col("_run_hash").alias("text_hash"), text, F.col("_windows").alias("windows")), window_texts, "doc_id long, text_hash long, first int, hashes array<long>, lines binary")
    classes = texts.select("hashes", F.explode("hashes").alias("hash")).distinct().join(mixed, "hash").select("hashes").distinct()
    again = stage(texts.join(classes, "hashes", "left_semi"), "lines-again")
    first = stage(again.groupBy("hashes", "lines").agg(F.min(F.struct(*PLACE)).alias("src")), "lines-again-first")
    again = again.join(first, ["hashes", "lines"]).withColumn("gone", later("src"))
    again = again.groupBy(F.col("doc_id").alias("v_doc"), F.col("text_hash").alias("v_hash")).agg(F.collect_set(F.struct("first", "hashes", "gone")).alias("v_windows"))
    joined = touched.join(again, F.col("_run_doc").eqNullSafe(F.col("v_doc")) & (F.col("_run_hash") == F.col("v_hash")), "left")
    other = lambda w: ~F.exists("v_windows", lambda v: (v["first"] == w["first"]) & (v["hashes"] == w["hashes"]))
    now = F.when(F.col("v_windows").isNull(), F.col("_windows")).otherwise(F.concat(F.filter("_windows", other), F.col("v_windows")))
    return joined.withColumn("_windows", now).drop("v_doc", "v_hash", "v_windows")


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, digest=None) -> DataFrame:
    """docs (doc_id, text and any other columns) with the later repeated runs cut from text, and _n_lines (lines that aren't blank, before),
    _n_deleted, _deleted_words.

    Null texts stay null and empty ones empty. Rows with the same doc_id and text are one document: what stays of one stays of all.
    Rows with the same doc_id and other text are documents of their own, and so are rows without doc_id. Within a document a repeated run goes too,
    where it doesn't overlap its first place: of a line that stands six times in a row, three stay. Very long texts and lines are taken whole.
    Columns that already have one of the new names, or _windows, _run_doc, _run_hash or _run_key, are replaced. Empty table: no rows."""
    docs = docs.drop("_n_lines", "_n_deleted", "_deleted_words", "_windows", "_run_doc", "_run_hash", "_run_key")
    keyed = docs.withColumns({"_run_doc": F.col("doc_id").cast("long"), "_run_hash": F.xxhash64(F.col("text").cast("string"))})
    found = matched_windows(keyed.select(F.col("_run_doc").alias("doc_id"), F.col("_run_hash").alias("text_hash"), F.col("text").cast("string").alias("text")), min_lines, min_words, digest)
    found = stage(found.select(F.col("doc_id").alias("_w_doc"), F.col("text_hash").alias("_w_hash"), F.xxhash64("doc_id", "text_hash").alias("_w_key"), F.col("windows").alias("_windows")), "lines-found")
    near, rest = split_by_keys(keyed, F.xxhash64("_run_doc", "_run_hash"), found.select("_w_key"))
    own = near.join(found.drop("_w_key"), F.col("_run_doc").eqNullSafe(F.col("_w_doc")) & (F.col("_run_hash") == F.col("_w_hash")), "left").drop("_w_doc", "_w_hash")
    own = stage(own, "lines-touched")
    own = verified(own.where("_windows is not null")).unionByName(own.where("_windows is null"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", _n_lines int, _n_deleted int, _deleted_words long"
    cut = lambda rows: arrow_map(rows.select(*[f"`{c}`" for c in docs.columns], "_windows"), delete_runs("text"), schema)
    return cut(own).unionByName(cut(rest.withColumn("_windows", F.lit(None).cast(WINDOWS))))


def oracle(min_words: int = MIN_WORDS) -> str:
    """The query in DuckDB SQL: windows are compared by their text, line by line (for windows of MIN_LINES = 3 lines)."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
raw AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM d WHERE text IS NOT NULL),
marked AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM raw),
numbered AS (SELECT *, t <> '' AS full_, count(*) FILTER (WHERE t <> '') OVER (PARTITION BY rid ORDER BY pos) - 1 AS i FROM marked),
l AS (SELECT rid, doc_id, i, t, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w FROM numbered WHERE full_),
ahead AS (SELECT rid, doc_id, i, [t, lead(t) OVER o, lead(t, 2) OVER o] AS t, [w, w + lead(w) OVER o] AS w FROM l WINDOW o AS (PARTITION BY rid ORDER BY i)),
win AS (SELECT rid, doc_id, i, n, list_slice(t, 1, n) AS key FROM ahead, (SELECT unnest([1, 2, 3]) AS n) WHERE t[n] IS NOT NULL AND (n = 3 OR w[n] >= {min_words})),
ranked AS (SELECT *, first_value(rid) OVER p AS f_rid, first_value(i) OVER p AS f_i FROM win WINDOW p AS (PARTITION BY key ORDER BY doc_id NULLS FIRST, rid, i)),
found AS (SELECT rid, i AS lo, i + n - 1 AS hi FROM ranked WHERE NOT (rid = f_rid AND i < f_i + n)),
gone AS (SELECT DISTINCT rid, unnest(range(lo, hi + 1)) AS i FROM found),
kept AS (SELECT x.rid, x.line, x.pos, x.full_, g.i IS NOT NULL AS here, h.i IS NOT NULL AS next_ FROM numbered x LEFT JOIN gone g ON x.rid = g.rid AND x.i = g.i LEFT JOIN gone h ON x.rid = h.rid AND x.i + 1 = h.i),
texts AS (SELECT rid, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT (here AND (full_ OR next_))), '') AS text, count(*) FILTER (WHERE full_) AS n_lines FROM kept GROUP BY rid),
sums AS (SELECT g.rid, count(*) AS n, sum(l.w) AS words FROM gone g JOIN l ON g.rid = l.rid AND g.i = l.i GROUP BY g.rid)
SELECT d.doc_id, CASE WHEN s.rid IS NULL THEN d.text ELSE x.text END AS text, coalesce(x.n_lines, 0)::INTEGER AS n_lines, coalesce(s.n, 0)::INTEGER AS n_deleted, coalesce(s.words, 0)::BIGINT AS deleted_words
FROM d LEFT JOIN texts x ON d.rid = x.rid LEFT JOIN sums s ON d.rid = s.rid"""
