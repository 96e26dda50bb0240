"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed 1- to 3-grams of the lower-cased text are summed by language over every
labelled training document; a task sends at most BUCKETS rows a language. The matrix of
log-probabilities, BUCKETS x languages, is broadcast, and batches of texts are scored by
looking up each n-gram's row and summing the rows of a document. Nothing but the text is
an input of a prediction.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS, ORDERS, GROUP_CHARS, SMOOTHING = 1 << 16, (1, 2, 3), 250_000, 0.5
OVERLAP = max(ORDERS) - 1
UNKNOWN = "und"


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves 2 by 4; a null id counts as kept for training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def ngrams(pieces: list[str], last: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of the n-grams that start at each character, edges of each piece's run); n-grams beyond a piece fall in bucket BUCKETS.

    A piece that is not the last of its text ends with OVERLAP characters that the next begins with and counts.
    """
    codes = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    edges = np.cumsum([0, *map(len, pieces)])
    out = np.empty((len(codes), len(ORDERS)), np.int32)
    crossing = edges[1:]
    shared = crossing[~np.array(last, bool)]
    mixed = np.zeros(len(codes), np.uint32)
    for k, n in enumerate(ORDERS):
        mixed = mixed * np.uint32(0x01000193) + np.concatenate([codes[n - 1 :], np.zeros(n - 1, np.uint32)]) + np.uint32(n)
        h = mixed * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        out[:, k] = (h * np.uint32(0x85EBCA6B)) >> np.uint32(16)
        for back in range(1, n):
            out[crossing - back, k] = BUCKETS
        for back in range(1, OVERLAP + 1):
            out[shared - back, k] = BUCKETS
    return out, edges


def _groups(texts: list[str | None]):
    """(rows, pieces, whether each is its text's last) of about GROUP_CHARS characters; texts are lower-cased between blanks, long ones cut; null counts as empty."""
    rows, pieces, last, size = [], [], [], 0
    for i, t in enumerate(texts):
        padded = f" {(t or '').lower()} "
        stops = range(0, max(1, len(padded) - OVERLAP), GROUP_CHARS)
        for at in stops:
            rows.append(i)
            pieces.append(padded[at : at + GROUP_CHARS + OVERLAP])
            last.append(at == stops[-1])
            size += len(pieces[-1])
            if size > GROUP_CHARS:
                yield rows, pieces, last
                rows, pieces, last, size = [], [], [], 0
    if rows:
        yield rows, pieces, last


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages in order, log-probabilities by bucket and language, log-priors) of docs(lang, text).

    Rows without lang or text teach nothing; no rows give no languages.
    """

    def count(batches):
        import pyarrow as pa

        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, pieces, last in _groups(texts):
                grams, edges = ngrams(pieces, last)
                own = np.array([langs[i] for i in at], dtype=object)
                for lang in sorted(set(own)):
                    rows = total.setdefault(lang, np.zeros(BUCKETS + 2, np.int64))
                    mask = np.repeat(own == lang, np.diff(edges))
                    rows[: BUCKETS + 1] += np.bincount(grams[mask].ravel(), minlength=BUCKETS + 1)
                    rows[BUCKETS + 1] += int(((own == lang) & last).sum())
        for lang, rows in total.items():
            at = np.flatnonzero(rows)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(rows[at])], names=["lang", "bucket", "n"])

    known = docs.where("lang is not null and text is not null").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    counts = known.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS + 2 rows a language
    langs = sorted(counts["lang"].unique())
    if not langs:
        return [], np.zeros((BUCKETS + 1, 0)), np.zeros(0)
    n = np.zeros((BUCKETS + 2, len(langs)))
    n[counts["bucket"], np.searchsorted(langs, counts["lang"])] = counts["n"]
    grams = n[:BUCKETS] + SMOOTHING
    table = np.zeros((BUCKETS + 1, len(langs)))
    table[:BUCKETS] = np.log(grams / grams.sum(axis=0))
    return langs, table, np.log(n[BUCKETS + 1] / n[BUCKETS + 1].sum())


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text: str = "text") -> DataFrame:
    """docs with lang_pred and score (the posterior of lang_pred); columns of these names are replaced.

    lang_pred is `und` with score 0 where the text is null or has no letter, or nothing was learned.
    Ties go to the language that sorts first. Rows that repeat are predicted alike; a very long
    text is counted and scored whole, in stretches of GROUP_CHARS characters.
    """
    langs, table, prior = model
    shared = docs.sparkSession.sparkContext.broadcast((langs, table.astype(np.float32), prior))
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]

    def run(batches):
        import pyarrow as pa
        import regex

        letter = regex.compile(r"\p{L}")
        langs, table, prior = shared.value
        columns = [np.ascontiguousarray(table[:, k]) for k in range(len(langs))]
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            total = np.tile(prior, (len(texts), 1))
            for at, pieces, last in _groups(texts) if langs else ():
                grams, edges = ngrams(pieces, last)
                for k in range(len(langs)):
                    np.add.at(total[:, k], at, np.add.reduceat(columns[k][grams].sum(axis=1, dtype=np.float64), edges[:-1]))
            found = [bool(langs) and t is not None and letter.search(t) is not None for t in texts]
            if langs:
                best = total.argmax(axis=1).tolist()
                share = (1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)).tolist()
            names = [langs[best[i]] if f else UNKNOWN for i, f in enumerate(found)]
            scores = [share[i] if f else 0.0 for i, f in enumerate(found)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "lang_pred", "score"])

    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    return docs.select(*kept, F.col(text).cast("string").alias("text__")).mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """docs with held_out, lang_pred and score, learned from the rows that are not held out."""
    rows = docs.withColumn("held_out", held_out())
    return predict(rows, train(rows.where(~F.col("held_out")).select("lang", "text")))


def language_digest(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), held_out().alias("held_out"))
    model = train(rows.where(~F.col("held_out")).select("lang", "text"))
    return predict(rows.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
