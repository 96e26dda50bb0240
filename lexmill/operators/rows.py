"""Row-level operators on keys and positions: deduplication, upserts, resumption and forward fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.work import work_dir, written


def _best(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row a key. A maximum of a struct is combined before the shuffle, so a hot key costs a row a task."""
    values = F.struct(*order, F.struct(*[F.col(c) for c in df.columns]).alias("row__"))
    return df.groupBy(*keys).agg(F.min(values).alias("b")).select("b.row__.*")


def keep_longest(df: DataFrame, keys: Sequence[str], text: str, pos: str) -> DataFrame:
    """A-03: the longest text of each key; of equals the earliest."""
    return _best(df, keys, (-F.length(text)).alias("o1"), F.col(pos).alias("o2"))


def keep_longest_entry(df: DataFrame, keys: Sequence[str], contents: Column, text: str, pos: str) -> DataFrame:
    """A-04: rows that are not contents entries first, then the longest, then the earliest."""
    return _best(df, keys, contents.alias("o0"), (-F.length(text)).alias("o1"), F.col(pos).alias("o2"))


def keep_last(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """A-05 and A-07: the last row of each key."""
    return _best(df, keys, (-F.col(pos)).alias("o1"))


def keep_first(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """A-06: the first row of each key."""
    return _best(df, keys, F.col(pos).alias("o1"))


def upsert(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """K-03 to K-05: rows of new replace all rows of target with their key; rows of target without a key go."""
    kept = target.where(F.col(key).isNotNull()).join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def resume(new: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """J-07, J-08 and G-05: rows of new whose key the target does not hold."""
    return new.join(target.select(key).distinct(), key, "left_anti")


def reconcile(target: DataFrame, run: DataFrame, scope: str, key: str) -> DataFrame:
    """G-08: rows of target in a scope that the run covered, but whose key the run did not make."""
    return target.join(run.select(scope).distinct(), scope, "left_semi").join(run.select(key).distinct(), key, "left_anti")


def forward_fill(df: DataFrame, by: Sequence[str], pos: str, column: str, name: str) -> DataFrame:
    """W-01: the last value that is not null up to each row."""
    return df.withColumn(name, F.last(column, ignorenulls=True).over(Window.partitionBy(*by).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)))


def islands(df: DataFrame, by: Sequence[str], pos: str, header: Column, name: str = "island") -> DataFrame:
    """W-02 and W-13: the number of headers up to each row; 0 before the first."""
    return df.withColumn(name, F.sum(header.cast("int")).over(Window.partitionBy(*by).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)))


def once_true(df: DataFrame, by: Sequence[str], pos: str, flag: Column, name: str) -> DataFrame:
    """W-15: whether the flag has been true up to each row."""
    return df.withColumn(name, F.max(flag).over(Window.partitionBy(*by).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)))


def slices(df: DataFrame, by: Sequence[str], start: str, end: str, text: str, name: str = "body") -> DataFrame:
    """W-03: the text from the end of each header to the start of the next."""
    nxt = F.lead(start).over(Window.partitionBy(*by).orderBy(start))
    return df.withColumn(name, F.substring(F.col(text), F.col(end) + 1, F.coalesce(nxt, F.length(text)) - F.col(end)))


def until_misses(df: DataFrame, by: Sequence[str], pos: str, hit: Column, misses: int, name: str = "probed") -> DataFrame:
    """W-05: rows before so many consecutive misses after the last hit."""
    last = F.max(F.when(hit, F.col(pos))).over(Window.partitionBy(*by).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(name, F.col(pos) - F.coalesce(last, F.lit(-1)) <= misses)


def trusted(df: DataFrame, by: Sequence[str], pos: str, asked: Column) -> DataFrame:
    """W-06: all rows of a window but the last, which may be cut off, unless it was asked for."""
    back = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(pos)))
    return df.withColumn("back__", back).where((F.col("back__") > 1) | asked).drop("back__")


def numbered_repeats(df: DataFrame, keys: Sequence[str], number: str, pos: str, name: str) -> DataFrame:
    """A-10: -v2, -v3 after a number that occurs again."""
    n = F.row_number().over(Window.partitionBy(*keys, number).orderBy(pos))
    return df.withColumn(name, F.when(n > 1, F.concat(F.col(number), F.lit("-v"), n.cast("string"))).otherwise(F.col(number)))


def merged_versions(df: DataFrame, key: str, version: str, text: str, note: str, name: str = "text") -> DataFrame:
    """A-02: versions of a section in order, each under its note in brackets if there are several."""
    part = F.sort_array(F.collect_list(F.struct(F.col(version).alias("v"), F.col(text).alias("t"), F.col(note).alias("n"))))
    rows = df.groupBy(key).agg(part.alias("p"))
    head = lambda x: F.concat(F.lit("["), F.coalesce(F.nullif(x["n"], F.lit("")), F.lit("Alternate version")), F.lit("]\n"), x["t"])
    return rows.select(key, F.when(F.size("p") > 1, F.array_join(F.transform("p", head), "\n\n")).otherwise(F.get("p", F.lit(0))["t"]).alias(name))


def glued(df: DataFrame, by: Sequence[str], pos: str, text: str, lone: Column) -> DataFrame:
    """W-07: a lone enumerator joined to the row after it, greedily from the left."""
    w = Window.partitionBy(*by).orderBy(pos)
    rows = df.withColumn("lone__", lone).withColumn("next__", F.lead(text).over(w))
    rows = rows.withColumn("run__", F.sum((~F.col("lone__")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    inner = Window.partitionBy(*by, F.coalesce("run__", F.lit(0))).orderBy(pos)
    rows = rows.withColumn("odd__", F.row_number().over(inner) % 2 == 1)
    glue = F.col("lone__") & F.col("odd__") & F.col("next__").isNotNull()
    eaten = F.lag(glue).over(w)
    out = rows.withColumn(text, F.when(glue, F.concat_ws(" ", F.col(text), F.col("next__"))).otherwise(F.col(text))).withColumn("eaten__", F.coalesce(eaten, F.lit(False)))
    return out.where(~F.col("eaten__")).drop("lone__", "next__", "run__", "odd__", "eaten__")


def dewrapped(df: DataFrame, by: Sequence[str], pos: str, line: str, marker: str) -> DataFrame:
    """W-08: wrapped lines joined to paragraphs, which start at blank lines and markers."""
    blank = F.trim(line) == ""
    w = Window.partitionBy(*by).orderBy(pos)
    start = blank | F.trim(line).rlike(marker) | F.coalesce(F.lag(blank).over(w), F.lit(True))
    rows = df.withColumn("start__", start)
    rows = islands(rows, by, pos, F.col("start__"), "para").where(~blank)
    texts = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.trim(line).alias("t"))))
    return rows.groupBy(*by, "para").agg(F.array_join(F.transform(texts, lambda x: x["t"]), " ").alias("text"))


def as_of(events: DataFrame, labels: DataFrame, by: Sequence[str], at: str, label: str) -> DataFrame:
    """J-10: each event with the label of the greatest start that is not after it; one sort, no range join."""
    both = events.withColumn("l__", F.lit(None).cast(labels.schema[label].dataType)).withColumn("e__", F.lit(1)).unionByName(labels.select(*by, at, F.col(label).alias("l__"), F.lit(0).alias("e__")), allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(at, "e__").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(label, F.last("l__", ignorenulls=True).over(w)).where("e__ = 1").drop("l__", "e__")


def children(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """A-20."""
    return nodes.where(F.col(parent).isNotNull()).groupBy(F.col(parent).alias("node")).agg(F.sort_array(F.collect_list(node)).alias("children"))


def reverse_index(cites: DataFrame, key: str, *columns: str) -> DataFrame:
    """A-01: the sorted distinct sources of each cited key."""
    return cites.groupBy(key).agg(F.sort_array(F.collect_set(F.struct(*columns))).alias("sources"))


def terms_in(texts: DataFrame, terms: DataFrame, doc: str, text: str, term: str) -> DataFrame:
    """F-24 and J-13: (doc, term) where a one-word term stands in the text, by an equi-join on words."""
    tokens = texts.select(doc, F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\w+"), F.lit(0)))).alias("w__"))
    return tokens.join(terms.select(F.col(term), F.lower(term).alias("w__")).distinct(), "w__").select(doc, term)


def reachable(edges: DataFrame, start: DataFrame) -> DataFrame:
    """H-08: nodes by the number of steps from the start, breadth first, each once, until a step finds no new node."""
    folder, depth = work_dir(edges.sparkSession), 0
    seen = last = written(start.select("node").distinct().withColumn("depth", F.lit(0)), folder, "0")
    while not last.isEmpty():
        depth += 1
        found = last.join(edges, F.col("src") == F.col("node")).select(F.col("dst").alias("node")).where("node is not null").distinct()
        last = written(found.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth)), folder, str(depth))
        seen = seen.unionByName(last)
    return seen


def placed(df: DataFrame, by: Sequence[str], *order: Column | str) -> DataFrame:
    """O-04: df with place, the number of each row within its group."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
