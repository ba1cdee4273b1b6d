"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue whose documents stand in a shuffled order (md5 of id and text). A document's virtual finish time
is the number of its source's tokens up to and including it, divided by the source's target weight. Documents may be
repeated: a second pass over a source queues behind its first. The mix is the prefix of all queues, sorted by virtual
finish time, whose tokens fit the total budget; a source that has no more to give leaves its share to the others, as
fair queueing does.

Nothing is sorted in one task, whatever the number of documents or of sources. Sources are ranked in ranges, and the level to which
they are filled comes from sums over them. Running sums within a source are taken in hash ranges of the shuffled order, so a
source with a third of all rows is spread over all of them. The global range sort is over ranges of the virtual time: the one range in
which the budget ends is cut again and again until few rows are left, and only these are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Weights by the sources' place in code point order (null last), repeating.
WEIGHTS = (3, 1, 2)
#: Tokens of the mix by all tokens; how often one document may be taken.
SHARE, PASSES = 1.5, 2
#: Documents of a hash range of a source, about; ranges at least; rows that are put in order in one task at the end of the budget, about.
PER_RANGE, RANGES, EDGE = 65_536, 4096, 65_536
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def shuffled(doc_id: Column, text: Column) -> Column:
    """The place of a document in its queue: rows without an id, or with the same one, are spread as well."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(" "), F.coalesce(text.cast("string"), F.lit(""))).cast("binary"))


def ranked_sources(per: DataFrame) -> DataFrame:
    """per with `place`: the number of a source from 0 in code point order, null last. Ranges of sources are numbered each for itself."""
    cuts = int(per.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = stage(per.repartitionByRange(cuts, F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id()), "mix-sources")
    before, sizes = 0, []
    for r in sorted(cut.groupBy("part").agg(F.count("*").alias("n")).collect()):  # a row a range
        sizes.append((r["part"], before))
        before += r["n"]
    starts = cut.sparkSession.createDataFrame(sizes, "part int, before long")
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").isNull(), F.col("source"))) - 1
    return cut.withColumn("own", own).join(F.broadcast(starts), "part").withColumn("place", F.col("before") + F.col("own")).drop("part", "own", "before")


def plan_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """One row per source: source, weight, source_size, budget, target. The fill level L has sum(min(passes * size, L * weight)) = share * total: it rises
    as sources that are full leave their share to the others, until no more are."""
    per = ranked_sources(sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
    per = stage(per.withColumn("cap", F.col("source_size") * F.lit(passes)).withColumn("fill_at", F.col("cap") / F.col("weight")).drop("place"), "mix-ranked")
    total, caps = per.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("cap"), F.lit(0))).first()
    budget, level, was = min(total * float(share), float(caps)), 0.0, -1
    while True:
        open_ = F.col("fill_at") >= F.lit(level)
        full, weight, n = per.agg(F.coalesce(F.sum(F.when(~open_, F.col("cap"))), F.lit(0)), F.sum(F.when(open_, F.col("weight"))), F.count_if(~open_)).first()
        if not weight or n == was:
            break
        level, was = (budget - full) / weight, n
    target = F.when(F.col("fill_at") <= F.lit(level), F.col("cap").cast("double")).otherwise(F.lit(level) * F.col("weight")) if weight else F.col("cap").cast("double")
    return stage(per.select("source", "weight", "source_size", F.lit(budget).alias("budget"), target.alias("target")), "mix-targets")


def finish_times(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES, ranges: int | None = None) -> DataFrame:
    """doc_id, u (shuffled order), size, source, source_size, target, budget, weight, done (its source's tokens up to and with it).
    ranges: hash ranges of each source's order; a task holds one range of one source at a time."""
    sized = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), shuffled(F.col("doc_id"), F.col("text")).alias("u")), "mix-sized")
    ranges = ranges or max(RANGES, -(-sized.count() // PER_RANGE))
    sized = sized.withColumn("range", F.pmod(F.floor(F.conv(F.substring("u", 1, 8), 16, 10).cast("long") * F.lit(ranges) / F.lit(1 << 32)), F.lit(ranges)))
    targets = plan_targets(sized, weights, share, passes)
    sums = sized.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    earlier = F.coalesce(F.sum("range_size").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("earlier", earlier).drop("range_size")
    sums = sums.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select("s.*", "t.weight", "t.source_size", "t.target", "t.budget")
    within = F.sum("size").over(Window.partitionBy("source", "range").orderBy("u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    run = sized.withColumn("within", within)
    run = run.alias("r").join(sums.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")) & (F.col("r.range") == F.col("s.range")))
    return run.select("r.doc_id", "r.source", "r.u", "r.size", "s.source_size", "s.target", "s.budget", "s.weight", (F.col("s.earlier") + F.col("r.within")).alias("done"))


def refined(rows: DataFrame, key: Column, budget: float, before: int, edge: int, cells: int = 4096) -> tuple[DataFrame, int, int] | None:
    """(the rows of a narrow range of key in which the sizes up to and with them pass the budget, the sizes before that range, their number); None if they
    never do. Each round sends at most `cells` rows to the driver; it ends with at most `edge` rows or a single key."""
    rows = rows.withColumn("_key", key)
    low, high = rows.agg(F.min("_key"), F.max("_key")).first()
    while low is not None:
        rows = rows.where((F.col("_key") >= F.lit(low)) & (F.col("_key") <= F.lit(high)))
        cell = F.least(F.floor((F.col("_key") - F.lit(low)) / F.lit((high - low) / cells)), F.lit(cells - 1)) if high > low else F.lit(0)
        found = None
        for r in sorted(rows.groupBy(cell.alias("cell")).agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.min("_key").alias("low"), F.max("_key").alias("high")).collect()):
            if before + r["size"] > budget:
                found = r
                break
            before += r["size"]
        if found is None:
            return None
        if found["n"] <= edge or found["low"] == found["high"]:
            rows = rows.where((F.col("_key") >= F.lit(found["low"])) & (F.col("_key") <= F.lit(found["high"])))
            return rows.drop("_key"), before, found["n"]
        low, high = found["low"], found["high"]
    return None


ORDER = (("at", "double"), ("u", "string"), ("doc_id", "long"), ("n", "int"), ("size", "long"), ("source", "string"))


def end_of_budget(items: DataFrame, budget: float, edge: int = EDGE):
    """The first item, in order of ORDER, with which the budget is passed; None if there is none."""
    found = refined(items, F.col("at"), budget, 0, edge)
    for digits in (1, 14):  # many items of one time: by their place in the shuffled order, 13 hex digits at once
        if found and found[2] > edge:
            found = refined(found[0], F.conv(F.substring("u", digits, 13), 16, 10).cast("double"), budget, found[1], edge)
    if not found:
        return None
    names = [c for c, _ in ORDER]
    order = Window.partitionBy(F.lit(0)).orderBy(*names).rowsBetween(Window.unboundedPreceding, 0)
    last = found[0].withColumn("upto", F.sum("size").over(order) + F.lit(found[1])).where(F.col("upto") > F.lit(budget))
    return last.agg(F.min(F.struct(*names)).alias("k")).first()["k"]


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES, ranges: int | None = None, edge: int = EDGE) -> DataFrame:
    """finish_times with `copies`: how often each document is taken, at most `passes` times."""
    queued = stage(finish_times(docs, weights, share, passes, ranges), "mix-queued")
    finish = lambda n: (F.col("done") + F.col("source_size") * n) / F.col("weight")
    items = queued.where("size > 0").select("u", "doc_id", "size", "source", F.explode(F.array(*[F.struct(finish(n).alias("at"), F.lit(n).alias("n")) for n in range(passes)])).alias("x"))
    items = items.select("x.at", "u", "doc_id", "x.n", "source", "size")
    budget = queued.agg(F.max("budget")).first()[0]
    cut = None if budget is None else end_of_budget(items, budget, edge)
    if cut is None:
        times = [F.lit(1)] * passes
    else:
        limit = F.struct(*[F.lit(cut[k]).cast(t).alias(k) for k, t in ORDER])
        times = [(F.struct(finish(n).alias("at"), F.col("u"), F.col("doc_id"), F.lit(n).alias("n"), F.col("size"), F.col("source")) < limit).cast("int") for n in range(passes)]
    copies = sum(times[1:], times[0])
    return queued.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("int"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies (times taken, at most passes), taken.

    docs: doc_id, source, text; other columns don't matter, whatever their names. Null text: size 0, and size 0 is never taken. Very long texts are counted
    whole. Null source: a source of its own. Rows with equal doc_id and text are interchangeable, of rows without doc_id too. Empty table: no rows."""
    return taken(docs, **options).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, passes: int = PASSES, **options) -> DataFrame:
    """docs as the mix has them: every row as often as it was taken, all columns but those whose names begin with _mix_.

    What a pass takes of a source is the beginning of its queue, so where each ends, one row a source, says of every document whether it is taken: texts
    are joined with these few rows alone. Of interchangeable rows at such an end as many stay as were taken. Nulls, long texts and empty tables as in `mix`."""
    docs = docs.drop(*[c for c in docs.columns if c.startswith("_mix_")])
    place = F.struct("u", "doc_id", "size")
    plan = taken(docs, passes=passes, **options)
    ends = stage(plan.groupBy("source").agg(*[F.max(F.when(F.col("copies") > n, place)).alias(f"_mix_end{n}") for n in range(passes)]), "mix-ends")
    # Rows alike at an end, of which not all are taken: (source, place) and how many of each pass.
    last = F.array_contains(F.array(*[f"_mix_end{n}" for n in range(passes)]), place)
    alike = plan.alias("p").join(ends.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source"))).select("p.source", place.alias("place"), "copies", last.alias("last")).where("last")
    alike = alike.groupBy("source", "place").agg(F.count("*").alias("rows"), *[F.count_if(F.col("copies") > n).alias(f"n{n}") for n in range(passes)])
    some = lambda n: (F.col(f"n{n}") > 0) & (F.col(f"n{n}") < F.col("rows"))
    any_ = some(0)
    for n in range(1, passes):
        any_ = any_ | some(n)
    alike = stage(alike.where(any_), "mix-alike")
    own = F.struct(shuffled(F.col("doc_id"), F.col("text")).alias("u"), F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"))
    rows = docs.withColumns({"_mix_place": own, "_mix_source": F.col("source").cast("string")})
    rows = rows.alias("d").join(ends.withColumnRenamed("source", "_mix_of").alias("e"), F.col("_mix_source").eqNullSafe(F.col("_mix_of"))).where("_mix_place.size > 0")
    count = lambda n: F.coalesce(F.col("_mix_place") <= F.col(f"_mix_end{n}"), F.lit(False)).cast("int")
    rows = rows.withColumn("_mix_times", sum((count(n) for n in range(1, passes)), count(0)))
    names = [F.col(f"`{c}`") for c in docs.columns]
    if not alike.isEmpty():
        same = alike.select(F.col("source").alias("_mix_s"), F.col("place").alias("_mix_p"), *[F.col(f"n{n}").alias(f"_mix_n{n}") for n in range(passes)])
        rows = rows.join(same, F.col("_mix_source").eqNullSafe(F.col("_mix_s")) & (F.col("_mix_place") == F.col("_mix_p")), "left")
        nth = F.row_number().over(Window.partitionBy("_mix_s", "_mix_p").orderBy(F.lit(0)))
        of = lambda n: (F.col("_mix_nth") <= F.col(f"_mix_n{n}")).cast("int")
        few = rows.where("_mix_p is not null").withColumn("_mix_nth", nth).withColumn("_mix_times", sum((of(n) for n in range(1, passes)), of(0)))
        rows = rows.where("_mix_p is null").select(*names, "_mix_times").unionByName(few.select(*names, "_mix_times"))
    return rows.where("_mix_times > 0").select(*names, F.explode(F.sequence(F.lit(1), F.col("_mix_times"))).alias("_mix_time")).drop("_mix_time")


def oracle(share: float = SHARE) -> str:
    """The same mix in DuckDB SQL, with plain window sums."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || ' ' || coalesce(text, '')) AS u FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight FROM per),
filled AS (SELECT *, 2 * source_size AS cap, 2 * source_size / weight AS fill_at, {share} * sum(source_size) OVER () AS budget FROM ranked),
levels AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY fill_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY fill_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM filled),
goal AS (SELECT *, max(CASE WHEN fill_at >= lv THEN lv END) OVER () AS fill FROM levels),
targets AS (SELECT source, weight, source_size, budget, CASE WHEN fill IS NULL OR fill_at <= fill THEN cap::DOUBLE ELSE fill * weight END AS target FROM goal),
queued AS (
  SELECT s.doc_id, s.source, s.u, s.size, t.source_size, t.target, t.budget, t.weight,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.u, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS done
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
items AS (SELECT doc_id, source, u, size, done, budget, n, (done + n * source_size)::DOUBLE / weight AS vft FROM queued, (SELECT unnest([0, 1]) AS n) WHERE size > 0),
kept AS (SELECT doc_id, source, done, sum(size) OVER (ORDER BY vft, u, doc_id, n, size, source ROWS UNBOUNDED PRECEDING) <= budget AS fits FROM items),
copies AS (SELECT doc_id, source, done, count(*) FILTER (WHERE fits) AS c FROM kept GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target::DOUBLE AS target, (q.size * coalesce(c.c, 0))::BIGINT AS taken
FROM queued q LEFT JOIN copies c ON q.doc_id IS NOT DISTINCT FROM c.doc_id AND q.source IS NOT DISTINCT FROM c.source AND q.done = c.done AND q.size > 0"""
