"""Tables of contents, versions and headings: what sections a document says it has, and their titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import collapse, html_paragraphs, present, stripped_html
from lexmill.operators.segment import segments, stripped


def front_sections(text: Column, chapter: Column) -> Column:
    """T-17: numbers of the chapter's sections in the contents before the first `History:`, each once, in order."""
    front = F.get(F.split(text, "History:", 2), F.lit(0))
    return F.array_distinct(F.filter(F.regexp_extract_all(front, F.lit(r"\b\d+\.\d+\w*"), F.lit(0)), lambda n: F.startswith(n, F.concat(chapter, F.lit(".")))))


def versions(sections: DataFrame, section: Column, text: str, marker: str) -> DataFrame:
    """T-18: (…, pos, id, body): the versions that markers begin, the first under the section's id, others as id-v2 and on; one version without markers."""
    whole = F.array(F.struct(F.lit("").alias("header"), F.col(text).alias("body")))
    parts = segments(F.col(text), marker)
    rows = sections.select("*", F.posexplode(F.when(F.size(parts) > 0, parts).otherwise(whole)).alias("pos", "part"))
    number = F.when(F.col("pos") > 0, F.concat(F.lit("-v"), (F.col("pos") + 1).cast("string"))).otherwise(F.lit(""))
    return rows.withColumns({"id": F.concat(section, number), "body": stripped(F.col("part.body"))}).drop("part")


def titled(parsed: DataFrame, stubs: DataFrame, key: str, title: str) -> DataFrame:
    """J-11: parsed rows with the title of the stub of the same key where there is one; stubs are one a key."""
    own = stubs.select(F.col(key).alias("k__"), present(F.col(title)).alias("t__")).groupBy("k__").agg(F.min("t__").alias("t__"))
    return parsed.join(own, F.col(key) == F.col("k__"), "left").withColumn(title, F.coalesce("t__", title)).drop("k__", "t__")


def sibling_slices(pages: DataFrame, key: str, html: str, stubs: DataFrame) -> DataFrame:
    """T-20: (key, pos, number, title, body) of what stands between headings; a stub (key, number, title) gives its title."""
    rows = pages.select(key, F.posexplode(segments(F.col(html), r"(?is)<h[1-6][^>]*>.*?</h[1-6]>")).alias("pos", "part"))
    heading = collapse(stripped_html(F.col("part.header")))
    rows = rows.withColumns({"number": F.regexp_extract(heading, r"^(\S+)", 1), "title": F.trim(F.regexp_replace(heading, r"^\S+", "")), "body": F.array_join(html_paragraphs(F.col("part.body")), "\n")})
    rows = rows.withColumn("at__", F.struct(F.col(key).alias("k"), F.col("number").alias("n")))
    own = stubs.select(F.struct(F.col(key).alias("k"), F.col("number").alias("n")).alias("at__"), "title")
    return titled(rows, own, "at__", "title").drop("part", "at__")
