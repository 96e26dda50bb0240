"""Boundary-aware chunks with overlap, as an Arrow UDF."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.ids import point_id, text_sha1
from lexmill.functions.text import word_count

#: Characters to a token, tokens of a chunk, of the overlap, and of the smallest last chunk.
CHARS, TOKENS, OVERLAP, LEAST = 4, 1000, 100, 100
#: Fixed patterns where a chunk may end, the best first.
BREAKS = (r"\n\s*\([a-z]\)", r"\n\s*\(\d+\)", r"\n\s*\([ivx]+\)", r"\n\n", r"\.\s+")


def chunks(text: str, tokens: int = TOKENS, overlap: int = OVERLAP, least: int = LEAST) -> list[str]:
    """C-01: pieces of at most tokens * CHARS characters.

    A piece that is not the last ends at the last match of the first pattern with any in its
    final three tenths. A small last piece joins the one before.
    """
    if len(text) // CHARS <= tokens:
        return [text]
    most, back, out, at = tokens * CHARS, overlap * CHARS, [], 0
    while at < len(text):
        stop = min(at + most, len(text))
        if stop < len(text):
            low = at + int(most * 0.7)
            ends = ([m.start() for m in re.finditer(p, text[low:stop])] for p in BREAKS)
            found = next((e for e in ends if e), None)
            if found and low + found[-1] > at:
                stop = low + found[-1]
        piece = text[at:stop].strip()
        if piece and stop >= len(text) and len(piece) // CHARS < least and out:
            out[-1] = f"{out[-1]}\n\n{piece}".strip()
        elif piece:
            out.append(piece)
        at = stop - back if stop < len(text) else len(text)
    return out or [text]


@F.pandas_udf(T.ArrayType(T.StringType()))
def chunked(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(lambda t: [] if t is None else chunks(t))


def chunk_rows(df: DataFrame, act_id: Column, text: str = "text") -> DataFrame:
    """C-03 and P-03: a row a chunk with its ids, from sections of at least 20 characters."""
    rows = df.withColumn("act_id", act_id).where(F.length(text) >= 20)
    short = F.length(text) < CHARS * (TOKENS + 1)  # one chunk: no Python needed
    one = rows.where(short).withColumn("parts__", F.array(F.col(text)))
    many = rows.where(~short).withColumn("parts__", chunked(F.col(text)))
    rows = one.unionByName(many).withColumn("full_text_sha1", text_sha1(F.col(text))).withColumn("parent_chunk_id", point_id(F.col("act_id"), F.lit(-1), F.col(text)))
    rows = rows.withColumn("total_chunks", F.size("parts__")).select("*", F.posexplode("parts__").alias("chunk_index", "chunk")).drop("parts__")
    return rows.withColumns({"point_id": point_id(F.col("act_id"), F.col("chunk_index"), F.col("chunk")), "word_count": word_count(F.col("chunk"))})
