"""Pages of guidance as rows: rulings from HTML, bulletin documents from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.cites import GUIDANCE, guidance_links, ruling_references
from lexmill.functions.dates import iso_date
from lexmill.functions.text import collapse, extract, present, stripped_html

#: Fixed pattern of a ruling's number.
RULING = r"((?:SSR|AR)\s+\d{2,4}-\d+(?:[a-z]|\(\d+\))?)"


def ruling(html: Column) -> Column:
    """T-15: struct(number, title, effective, rulings, regulations, statutes) of a ruling's page; null without a number."""
    head, plain = stripped_html(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)), stripped_html(html)
    number, named = extract(head, RULING), ruling_references(plain)
    title = F.trim(F.regexp_replace(head, "^.*?" + RULING + r"\s*[:—–-]*", ""))
    effective = iso_date(F.regexp_extract(plain, r"(?i)effective[^:]{0,20}:\s*(.{0,60})", 1))
    return F.when(number.isNotNull(), F.struct(collapse(number).alias("number"), title.alias("title"), effective.alias("effective"), *[named[n].alias(n) for n in ("rulings", "regulations", "statutes")]))


def bulletin(text: Column) -> Column:
    """T-16: struct(number, kind, year, effective, links) of a bulletin document; the number is the first item named."""
    number = collapse(present(F.regexp_extract(text, GUIDANCE, 1)))
    digits = F.regexp_extract(number, r"(\d+)-\d+$", 1)
    kind = F.trim(F.regexp_replace(number, r"\d+-\d+$", ""))
    effective = iso_date(F.regexp_extract(text, r"(?is)\beffective\b(.{0,60})", 1))
    return F.when(number.isNotNull(), F.struct(number.alias("number"), kind.alias("kind"), digits.try_cast("int").alias("year"), effective.alias("effective"), guidance_links(text, number).alias("links")))
