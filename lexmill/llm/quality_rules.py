"""Quality rules: word, line and repetition counts, and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into BUCKETS; their counts over the trusted documents and
over the whole corpus give two multinomials, and a document's score is the mean over its
n-grams of the logarithm of their ratio. A document is kept if it passes the base rules and
scores at least THRESHOLD: the same text under the same tables always gets the same verdict.
DataFrame functions only: the counts shuffle at most BUCKETS rows a task, the table of ratios
(BUCKETS numbers, rounded to six places) goes to the tasks as a literal, and texts never
leave their row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, SMOOTHING, THRESHOLD = 1 << 13, 0.5, -0.25
#: Trusted documents that the target is learned from: of those labelled, the smallest hashes of doc_id.
TRUSTED = 20_000
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _get(a: str, i: Column) -> Column:
    return F.get(F.col(a), i)


def features(hashed: str) -> Column:
    """Buckets of the words and pairs of neighbours of the array of word hashes."""
    pairs = F.transform(F.slice(F.col(hashed), 2, F.greatest(F.size(hashed) - 1, F.lit(0))), lambda h, i: F.xxhash64(_get(hashed, i), h))
    return F.transform(F.concat(F.col(hashed), pairs), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))


def ratios(docs: DataFrame, trusted: DataFrame, text: str = "text") -> DataFrame:
    """One row, ratios: the logarithm of trusted over raw probability, by bucket.

    docs needs doc_id and text; trusted needs doc_id, one row each. With no trusted document
    every ratio is that of equal counts.
    """
    marked = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("t__")).join(F.broadcast(trusted.select("doc_id", F.lit(1).alias("good__"))), "doc_id", "left")
    hashed = marked.select("good__", hashes(F.col("t__")).alias("h__"))
    each = hashed.select(F.coalesce("good__", F.lit(0)).alias("good"), F.explode(features("h__")).alias("bucket"))
    counts = each.groupBy("bucket").agg(F.sum("good").alias("good"), F.count(F.lit(1)).alias("raw"))
    every = docs.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket").join(F.broadcast(counts), "bucket", "left")
    every = every.select("bucket", (F.coalesce("good", F.lit(0)) + SMOOTHING).alias("good"), (F.coalesce("raw", F.lit(0)) + SMOOTHING).alias("raw"))
    rows = every.agg(F.sort_array(F.collect_list(F.struct("bucket", F.log(F.col("good") / F.col("raw")).alias("r")))).alias("rows"), F.log(F.sum("raw") / F.sum("good")).alias("shift"))
    return rows.select(F.transform("rows", lambda x: x["r"] + F.col("shift")).alias("ratios"))


def repeated_words(grams: str, sorted_grams: str) -> Column:
    """Words in windows found twice or more, from (window hash, place) in both orders."""
    s = F.col(sorted_grams)
    twice = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["g"] == x["g"], F.lit(False)))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    return F.aggregate(places, F.struct(F.lit(-5).alias("last"), F.lit(0).cast("bigint").alias("n")), lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(5), p - a["last"])).alias("n")), lambda a: a["n"])


def judge(docs: DataFrame, trusted: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    Null texts count as empty: no words, base_failed. An empty text scores 0. Columns of the
    names added are replaced.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")
    t = F.col("t__")
    rows = docs.drop(*[c for c in docs.columns if c.lower() in names]).withColumn("t__", F.coalesce(F.col(text).cast("string"), F.lit("")))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.translate(x, BLANKS, "") != "")
    rows = rows.withColumns({"h__": hashes(t), "l__": lines, "word_chars": F.length(F.translate(t, BLANKS, "")).cast("bigint"), "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint")}).drop("t__")
    h = F.col("h__")
    grams = F.transform(F.slice(h, 5, F.greatest(F.size(h) - 4, F.lit(0))), lambda x, i: F.xxhash64(_get("h__", i), _get("h__", i + 1), _get("h__", i + 2), _get("h__", i + 3), x))
    rows = rows.withColumns({"n_words": F.size(h).cast("bigint"), "n_dup_lines": (F.size("l__") - F.size(F.array_distinct("l__"))).cast("bigint"), "g__": F.when(F.size(h) >= 5, grams).otherwise(F.expr("cast(array() as array<bigint>)"))}).drop("l__")
    rows = rows.withColumn("s__", F.when(F.size(F.array_distinct("g__")) < F.size("g__"), F.sort_array(F.transform("g__", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    rows = rows.withColumn("n_repeat_words", F.coalesce(repeated_words("g__", "s__"), F.lit(0).cast("bigint"))).drop("g__", "s__")
    numbers = ratios(docs, trusted, text).first().ratios  # one row of BUCKETS numbers
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in numbers)), ",").cast("array<double>")  # folded to a literal
    rows = rows.withColumn("f__", features("h__")).drop("h__")
    total = F.aggregate("f__", F.lit(0.0), lambda a, b: a + F.element_at(table, b + 1))
    rows = rows.withColumn("score", F.coalesce(total / F.nullif(F.size("f__"), F.lit(0)), F.lit(0.0))).drop("f__")
    rows = rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def trusted_documents(labels: DataFrame, most: int = TRUSTED) -> DataFrame:
    """doc_id of at most so many documents labelled of good quality, by the smallest hash."""
    return labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = judge(docs.select("doc_id", "text"), trusted_documents(labels))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
