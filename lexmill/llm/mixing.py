"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame operations.

Every document draws an exponential key -ln(u) / quality, u from a hash of its id, so that
the smallest keys of a source are a weighted sample without replacement. A source whose
target exceeds its size is taken in complete epochs first; the rest is the longest prefix of
the key order that the remainder holds, and the one document beyond it whose size comes
nearest to what is then left. The prefix is found by summing sizes over fixed bins of the
key, then over those within the bin in which the budget ends, and ordering only one of the
latter, so the rows of a hot source never meet in one task. Rows that tie, being equal in id
and text, are counted as one with a multiplicity; where the prefix ends among them, they are
numbered by task, and as many are taken as fit. What is broadcast is a row per source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm._common import WORD, work_dir, written

#: Bins of the key, and bins of each of them; sources above which the table of sources is not broadcast.
BINS, MANY_SOURCES = 4096, 10_000
OWN = ("size", "source_size", "target", "taken", "key__", "bin__", "fine__", "tie__", "src__", "more__", "row__", "nth__", "task__", "ahead__", "wanted__")


def quality(text: str = "text") -> Column:
    """Between 0.25 and 1: less for texts with many symbols among their characters."""
    t = F.coalesce(F.col(text), F.lit(""))
    symbols = F.length(t) - F.length(F.translate(t, "#*$%&|<>!", ""))
    return F.greatest(F.lit(0.25), 1 - 4 * symbols / F.greatest(F.length(t), F.lit(1)))


def uniform(seed: int, doc_id: str = "doc_id", text: str = "text") -> Column:
    """A number in (0, 1) from the first 48 bits of md5 of `seed:doc_id`; a row without an id goes by its text."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text "), F.xxhash64(text).cast("string")))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = (5, 2, 1), cap: int = 3) -> dict[str | None, float]:
    """Words to take by source: shares of the sum of sizes by weight, at most cap times the source's size.

    Sources go by code point, null last, and take the weights in turn; what a capped source
    cannot take is shared among the others by weight until none is above its cap.
    """
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    free = {s: (weights[i % len(weights)], cap * n) for i, (s, n) in enumerate(order)}
    out, rest = {}, sum(n for _, n in order)
    while free:
        level = rest / sum(w for w, _ in free.values())
        above = [s for s, (w, most) in free.items() if level * w > most]
        if not above:
            return out | {s: level * w for s, (w, _) in free.items()}
        for s in above:
            out[s] = float(free[s][1])
            rest -= free.pop(s)[1]
    return out


def _sums(rows: DataFrame, info: DataFrame, by: str) -> DataFrame:
    """(src, by, before): per source the bin in which the running sum of sizes reaches the remainder, and the sum before it; info: (src, remainder, start)."""
    bins = rows.groupBy("src__", by).agg(F.sum("size").alias("n"))
    running = bins.withColumn("upto", F.sum("n").over(Window.partitionBy("src__").orderBy(by)))  # BINS rows a source at most
    ends = running.join(info, F.col("src__").eqNullSafe(F.col("src"))).withColumn("upto", F.col("upto") + F.col("start"))
    ends = ends.where("remainder > 0 and upto >= remainder").groupBy("src").agg(F.min(F.struct(F.col(by).alias("at"), (F.col("upto") - F.col("n")).alias("start"), "remainder")).alias("e"))
    return ends.select("src", "e.*")


def _within(rows: DataFrame, ends: DataFrame, by: str, hint) -> DataFrame:  # noqa: ANN001
    """The rows of the bins where the remainders end, with start and remainder."""
    return rows.join(hint(ends), F.col("src__").eqNullSafe(F.col("src")) & (F.col(by) == F.col("at"))).drop("src", "at")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: int = 3, seed: int = 17, quality_column: Column | None = None) -> DataFrame:
    """docs with size (words), source_size, target (of its source) and taken (words, repeats counted).

    taken is a whole multiple of size, at most cap times: whole documents are taken. Null
    texts have size 0, and very long texts are documents like others; documents of equal id
    draw equal keys and go by size and text, and of rows equal in all three as many are taken
    as fit. Columns of the names added are replaced; an empty table stays empty.
    """
    spark, folder = docs.sparkSession, work_dir(docs.sparkSession)
    rows = docs.drop(*[c for c in docs.columns if c.lower() in OWN])
    rows = rows.withColumns({"size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint"), "src__": F.col("source").cast("string")})
    rows = rows.withColumn("key__", -F.log(uniform(seed)) / (quality() if quality_column is None else quality_column))
    rows = rows.withColumns({"fine__": F.floor(BINS * BINS * (1 - F.exp(-F.col("key__")))).cast("int"), "tie__": F.struct("key__", F.col("doc_id").cast("bigint").alias("id"), "size", F.xxhash64("text").alias("h"))})

    slim = written(rows.select("src__", "size", "fine__", "tie__"), folder, "keys").withColumn("bin__", F.floor(F.col("fine__") / BINS).cast("int"))
    total = [(r.src__, r.n) for r in slim.groupBy("src__").agg(F.sum("size").alias("n")).collect()]  # a row per source of the mix
    hint = F.broadcast if len(total) <= MANY_SOURCES else lambda x: x
    goal = targets(total, weights, cap)
    info = []
    for s, n in total:
        epochs = min(cap, math.floor(goal[s] / n)) if n else 0
        info.append((s, int(n), float(goal[s]), epochs, float(goal[s] - epochs * n) if epochs < cap else 0.0))
    info = spark.createDataFrame(info, "src string, source_size bigint, target double, epochs int, remainder double")

    ends = _sums(slim, hint(info.select("src", "remainder", F.lit(0).alias("start"))), "bin__")
    last = _within(slim, ends, "bin__", hint).drop("start", "remainder")
    ends = _sums(last, hint(ends.drop("at")), "fine__")
    last = _within(last, ends, "fine__", hint).groupBy("src__", "tie__").agg(F.count(F.lit(1)).alias("k"), F.min("size").alias("size"), F.min("start").alias("start"), F.min("remainder").alias("remainder"))
    order = Window.partitionBy("src__").orderBy("tie__").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = last.withColumn("start", F.col("start") + F.sum(F.col("k") * F.col("size")).over(order) - F.col("k") * F.col("size"))
    room = F.col("remainder") - F.col("start")
    last = last.withColumn("m", F.when(room < 0, 0).when(F.col("size") == 0, F.col("k")).otherwise(F.least("k", F.floor(room / F.col("size")))).cast("bigint")).where("m > 0")
    last = last.groupBy("src__").agg(F.max(F.struct("tie__", "m", "k", (F.col("start") + F.col("m") * F.col("size")).alias("got"))).alias("l")).select(F.col("src__").alias("src2"), "l.*")
    cut = ends.join(last, F.col("src").eqNullSafe(F.col("src2")), "left")
    cut = cut.select(F.col("src").alias("src2"), F.col("at").alias("fine"), F.col("tie__").alias("cut"), "m", "k", (F.col("remainder") - F.coalesce("got", "start")).alias("gap"))
    info = written(hint(info).join(cut, F.col("src").eqNullSafe(F.col("src2")), "left").drop("src2"), folder, "cuts")

    below = F.coalesce((F.col("fine__") < F.col("fine")) | ((F.col("fine__") == F.col("fine")) & (F.col("tie__") < F.col("cut"))), F.lit(False))
    full = F.coalesce((F.col("tie__") == F.col("cut")) & (F.col("m") == F.col("k")), F.lit(False))
    beyond = slim.join(hint(info.where("gap > 0")), F.col("src__").eqNullSafe(F.col("src"))).where(~below & ~full & (F.col("size") > 0))
    beyond = beyond.withColumn("off", F.abs(F.col("size") - F.col("gap"))).where("off < gap").groupBy("src__").agg(F.min(F.struct("off", "tie__")).alias("o"))
    one = written(beyond.select(F.col("src__").alias("src2"), F.col("o.tie__").alias("one")), folder, "nearest")
    some = slim.join(hint(one), F.col("src__").eqNullSafe(F.col("src2")) & (F.col("tie__") == F.col("one"))).groupBy("src2").agg(F.count(F.lit(1)).alias("k1"), F.min("one").alias("one"))
    info = written(hint(info).join(some, F.col("src").eqNullSafe(F.col("src2")), "left").drop("src2", "gap"), folder, "plan")
    own = {c: f"i_{c}__" for c in ("src", "epochs", "remainder", "fine", "cut", "m", "k", "one", "k1")}  # beside whatever columns docs have
    out = rows.join(hint(info.withColumnsRenamed(own)), F.col("src__").eqNullSafe(F.col(own["src"])), "left")
    i = {c: F.col(name) for c, name in own.items()}
    at_cut, at_one = (F.coalesce(F.col("tie__") == i[c], F.lit(False)) for c in ("cut", "one"))
    below = F.coalesce((F.col("fine__") < i["fine"]) | ((F.col("fine__") == i["fine"]) & (F.col("tie__") < i["cut"])), F.lit(False))
    wanted = F.when(at_cut, i["m"]).otherwise(F.lit(0)) + at_one.cast("int")  # of the rows that tie with this one
    equal = F.when(at_cut, i["k"]).when(at_one, i["k1"]).otherwise(F.lit(1))
    if info.where("m < k or k1 > 1").isEmpty():
        out = out.withColumn("more__", below | (wanted >= equal))
    else:  # a prefix ends among equal rows
        split = (wanted > 0) & (wanted < equal)
        edge = written(out.where(split).withColumns({"row__": F.monotonically_increasing_id(), "wanted__": wanted.cast("bigint")}), folder, "edge")
        task = F.shiftright("row__", 33)
        group = ["src__", "tie__", "task__"]
        edge = edge.withColumn("task__", task)
        ahead = Window.partitionBy("src__", "tie__").orderBy("task__").rowsBetween(Window.unboundedPreceding, -1)
        tasks = edge.groupBy(*group).agg(F.count(F.lit(1)).alias("n__")).withColumn("ahead__", F.coalesce(F.sum("n__").over(ahead), F.lit(0)))  # a row a task
        tasks = tasks.select(*[F.col(c).alias(f"t_{c}") for c in group], "ahead__")
        edge = edge.withColumn("nth__", F.row_number().over(Window.partitionBy(*group).orderBy("row__")))
        edge = edge.join(tasks, (F.col("t_src__").eqNullSafe(F.col("src__"))) & (F.col("t_tie__") == F.col("tie__")) & (F.col("t_task__") == F.col("task__")))
        edge = edge.withColumn("more__", F.col("nth__") + F.col("ahead__") <= F.col("wanted__")).drop("row__", "wanted__", "nth__", "ahead__", "task__", *[f"t_{c}" for c in group])
        out = out.where(~split).withColumn("more__", below | (wanted >= equal)).unionByName(edge)
    return out.withColumn("taken", F.col("size") * (i["epochs"] + F.col("more__").cast("int"))).drop("src__", "key__", "fine__", "tie__", "more__", *own.values())


def mixed_digest(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


def repeated(mixed: DataFrame) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, those not taken left out."""
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    return mixed.where(times > 0).withColumn("copy__", F.explode(F.sequence(F.lit(1), times))).drop("copy__", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, coalesce(text, '') AS t FROM documents
), k AS (
  SELECT doc_id, source, size,
    -ln((('0x' || substr(md5('17:' || doc_id), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
    / greatest(0.25::DOUBLE, 1 - 4 * (length(t) - length(translate(t, '#*$%&|<>!', '')))::DOUBLE / greatest(length(t), 1)) AS key FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS n, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS w FROM d GROUP BY source
), f AS (
  SELECT *, (sum(n) OVER () - coalesce(sum(3 * n) OVER (ORDER BY 3 * n / w::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER (ORDER BY 3 * n / w::DOUBLE, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM s
), l AS (SELECT max(level) AS level FROM f WHERE level * w <= 3 * n
), g AS (
  SELECT source, n, least((SELECT level FROM l) * w, 3.0::DOUBLE * n)::DOUBLE AS target FROM s
), r AS (
  SELECT *, CASE WHEN n > 0 THEN least(3, floor(target / n))::BIGINT ELSE 0 END AS epochs FROM g
), p AS (
  SELECT k.*, r.n, r.target, r.epochs, target - epochs * n AS rest,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM k JOIN r ON k.source IS NOT DISTINCT FROM r.source
)
, q AS (
  SELECT *, epochs < 3 AND rest > 0 AND upto <= rest AS chosen FROM p
), h AS (
  SELECT source, rest - coalesce(max(upto) FILTER (chosen), 0) AS gap FROM q GROUP BY source, rest
), x AS (
  SELECT q.source, arg_min(doc_id, (abs(size - gap), key, doc_id)) AS one FROM q JOIN h ON q.source IS NOT DISTINCT FROM h.source
  WHERE NOT chosen AND size > 0 AND epochs < 3 AND abs(size - gap) < gap GROUP BY q.source
)
SELECT doc_id, size, n AS source_size, target, (size * (epochs + CASE WHEN chosen OR doc_id = one THEN 1 ELSE 0 END))::BIGINT AS taken FROM q LEFT JOIN x ON q.source IS NOT DISTINCT FROM x.source
"""
