"""Segmentation: a text with headers becomes a row for each segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def segments(text: Column, header: str) -> Column:
    """T-01: array<struct<header, body>> of what follows each match of the header; text before the first is left out.

    The pieces between matches and the matches come from two passes that both take the
    leftmost match, so pieces[i + 1] follows matches[i].
    """
    matches = F.regexp_extract_all(text, F.lit(header), F.lit(0))
    bodies = F.slice(F.split(text, header, -1), F.lit(2), F.greatest(F.size(matches), F.lit(0)))
    return F.zip_with(matches, bodies, lambda h, b: F.struct(F.trim(h).alias("header"), F.trim(b).alias("body")))


def segment_rows(df: DataFrame, text: str, header: str, number: str, least: int = 1) -> DataFrame:
    """T-01 with F-02: (…, pos, number, title, body) for bodies of at least so many characters."""
    rows = df.select(*[c for c in df.columns if c != text], F.posexplode(segments(F.col(text), header)).alias("pos", "seg"))
    rows = rows.withColumns({"number": F.regexp_extract("seg.header", number, 1), "title": F.trim(F.regexp_replace("seg.header", number, "")), "body": F.col("seg.body")}).drop("seg")
    return rows.where(F.length("body") >= least)


def two_levels(df: DataFrame, text: str, article: str, section: str) -> DataFrame:
    """T-03: (…, article, section, body): an article without sections is its section 0; A-10 numbers repeats."""
    keep = [c for c in df.columns if c != text]
    articles = df.select(*keep, F.posexplode(segments(F.col(text), article)).alias("apos", "a"))
    inner = segments(F.concat(F.lit("\n"), F.col("a.body")), section)
    whole = F.array(F.struct(F.lit("0").alias("header"), F.col("a.body").alias("body")))
    rows = articles.withColumn("parts", inner).withColumn("parts", F.when(F.size("parts") > 0, F.col("parts")).otherwise(whole))
    return rows.select(*keep, "apos", F.col("a.header").alias("article"), F.posexplode("parts").alias("pos", "s")).select(*keep, "apos", "article", "pos", F.col("s.header").alias("section"), F.col("s.body").alias("body"))


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"\A\s+|\s+\z", "")


def levels(df: DataFrame, text: str, **headers: str) -> DataFrame:
    """T-04: (…, a column and a place for each level, body): any number of levels, outermost first.

    Text before the first header of the first level is left out; what has no header of a
    lower level is part 0 of it.
    """
    keep = [c for c in df.columns if c != text]
    rows, outer = df.withColumn("body", F.col(text)), True
    for name, header in headers.items():
        parts = segments(F.col("body"), header)
        if not outer:
            parts = F.when(F.size(parts) > 0, parts).otherwise(F.array(F.struct(F.lit("0").alias("header"), F.col("body").alias("body"))))
        rows = rows.select(*keep, F.posexplode(parts).alias(f"{name}_pos", "s"))
        rows = rows.withColumns({name: stripped(F.col("s.header")), "body": stripped(F.col("s.body"))}).drop("s")
        keep, outer = [*keep, f"{name}_pos", name], False
    return rows


def div_blocks(html: Column, kind: str) -> Column:
    """T-02: array<struct<id, body>> of divs of a class, each up to the next."""
    header = rf'(?i)<div[^>]*class="{kind}"[^>]*>'
    return F.transform(segments(html, header), lambda s: F.struct(F.regexp_extract(s["header"], r'(?i)id="([^"]*)"', 1).alias("id"), s["body"].alias("body")))


def anchors(html: Column) -> Column:
    """T-14: array<struct<url, headline>> of links."""
    pattern = r'(?is)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>'
    urls, texts = (F.regexp_extract_all(html, F.lit(pattern), F.lit(g)) for g in (1, 2))
    return F.zip_with(urls, texts, lambda u, t: F.struct(u.alias("url"), F.trim(F.regexp_replace(t, "<[^>]+>", "")).alias("headline")))


def labelled(text: Column, *labels: str) -> Column:
    """T-09, T-22: map of label to what follows it up to the next label."""
    every = "|".join(labels)
    found = [F.trim(F.regexp_extract(text, rf"(?s)\b{label}:\s*(.*?)(?=\b(?:{every}):|\z)", 1)) for label in labels]
    return F.create_map(*[x for label, value in zip(labels, found) for x in (F.lit(label), value)])


def routed(blocks: Column) -> Column:
    """T-21 and T-23: struct(title, history, note, body) of array<struct<kind, text>>; unknown kinds are body."""
    of = lambda *kinds: F.array_join(F.transform(F.filter(blocks, lambda b: b["kind"].isin(*kinds)), lambda b: b["text"]), "\n")
    body = F.array_join(F.transform(F.filter(blocks, lambda b: ~b["kind"].isin("title", "history", "note")), lambda b: b["text"]), "\n")
    return F.struct(of("title").alias("title"), of("history").alias("history"), of("note").alias("note"), body.alias("body"))


def amendment_tail(text: Column, marker: str) -> Column:
    """T-05: struct(body, amendments): what follows the marker is a list of amendments."""
    at = F.split(text, marker, 2)
    return F.struct(F.get(at, F.lit(0)).alias("body"), F.when(F.size(at) > 1, F.get(at, F.lit(1))).otherwise(F.lit("")).alias("amendments"))


def second_occurrence(text: Column, anchor: str) -> Column:
    """W-10: the text from the second occurrence of an anchor on, else from the first, else whole."""
    pieces = F.split(text, rf"\Q{anchor}\E", 3)
    first = F.length(F.get(pieces, F.lit(0)))
    skip = F.when(F.size(pieces) > 2, first + len(anchor) + F.length(F.get(pieces, F.lit(1)))).when(F.size(pieces) > 1, first).otherwise(F.lit(0))
    return F.substring(text, skip + 1, F.length(text))


def sentences_with(text: Column, pattern: str) -> Column:
    """W-11: sentences that match, each once, in order."""
    parts = F.split(text, r"(?<=[.!?])\s+")
    return F.array_distinct(F.filter(parts, lambda s: s.rlike(pattern)))
