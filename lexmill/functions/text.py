"""Text normalisation as Column expressions. Patterns use (?U) where white space includes U+00A0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(c: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(c, F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, null where nothing matches."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def extract_all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def collapse(c: Column) -> Column:
    """X-01: runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def collapse_blanks(c: Column) -> Column:
    """X-02: runs of blanks and tabs as one blank, at most two line ends together."""
    c = F.regexp_replace(F.translate(c, " ", " "), r"[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"\A\s+|\s+\z", "")


def without_tags(c: Column) -> Column:
    """X-03: line ends removed, U+00A0 and zero-width characters as blanks or nothing, tags removed."""
    return F.trim(F.regexp_replace(F.translate(c, " \n\r​﻿", " "), "<.*?>", ""))


#: Fixed entities that unescape knows.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&sect;", "§"), ("&mdash;", "—"), ("&ndash;", "–"), ("&amp;", "&"))


def unescape(c: Column) -> Column:
    for entity, character in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(character))
    return c


def stripped_html(c: Column) -> Column:
    """X-06: tags as blanks, entities decoded, white space collapsed."""
    return collapse(unescape(F.regexp_replace(c, "<[^>]+>", " ")))


def inline_text(c: Column) -> Column:
    """X-12: the text of an element and all below it, tags as nothing, white space collapsed."""
    return collapse(unescape(F.regexp_replace(c, "<[^>]+>", "")))


def html_paragraphs(c: Column) -> Column:
    """X-07: the texts of p, li and blockquote elements in order, empty ones left out."""
    inner = extract_all(c, r"(?is)<(?:p|li|blockquote)\b[^>]*>(.*?)</(?:p|li|blockquote)>", 1)
    return F.filter(F.transform(inner, stripped_html), lambda x: x != "")


def heading_name(c: Column) -> Column:
    """X-11: a heading without `CHAPTER IV -` or the like before it."""
    return F.trim(F.regexp_replace(c, r"(?i)^(CHAPTER|PART|SUBPART|SUBCHAPTER|SUBCHAP)\s+[\dIVXLCDMA-Z]+\s*[-—]+\s*", ""))


def without_label(c: Column, *labels: str) -> Column:
    """X-14: each label in turn cut from the start, with a colon if there is one."""
    for label in labels:
        c = F.regexp_replace(c, rf"(?i)^\s*\Q{label}\E\s*:?\s*", "")
    return collapse(c)


def without_noise(c: Column, noise: str) -> Column:
    """X-15: leading runs of the noise pattern cut, as often as it matches."""
    return F.regexp_replace(c, rf"^(?:{noise})+", "")


def without_header_lines(c: Column, terms: str, lines: int = 10) -> Column:
    """X-16: of the first lines, those that match the terms left out."""
    kept = F.filter(F.split(c, "\n"), lambda x, i: (i >= lines) | ~x.rlike(terms))
    return F.array_join(kept, "\n")


def from_anchor(c: Column, anchor: str) -> Column:
    """X-17: the text from the first match of the anchor on, whole if there is none."""
    at = F.length(F.split(c, anchor, 2)[0])
    return F.when(c.rlike(anchor), F.substring(c, at + 1, F.length(c))).otherwise(c)


def before_tail(c: Column, label: str, least: int = 200) -> Column:
    """X-18: what stands before the label if that is longer than least characters."""
    head = F.split(c, label, 2)[0]
    return F.when(c.rlike(label) & (F.length(head) > least), F.rtrim(head)).otherwise(c)


def body_and_notes(c: Column, marker: str) -> Column:
    """X-19: struct(body, notes), split where the marker stands."""
    body = F.when(c.rlike(marker), F.split(c, marker, 2)[0]).otherwise(c)
    return F.struct(F.trim(body).alias("body"), F.trim(F.substring(c, F.length(body) + 1, F.length(c))).alias("notes"))


#: Fixed names of months.
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def source_block(c: Column) -> Column:
    """X-20: struct(body, effective, registers, source) of a text that ends in `(Source: ...)`; the last effective date counts."""
    tail = r"(?s)\(Source:\s*(.+?)\)\s*$"
    source = F.trim(F.coalesce(extract(c, tail), F.lit("")))
    body = F.when(c.rlike(tail), F.rtrim(F.regexp_replace(c, tail, ""))).otherwise(F.trim(c))
    dates = extract_all(source, rf"(?i)effective\s+((?:{MONTHS})\s+\d{{1,2}},\s+\d{{4}})", 1)
    volumes, pages = (extract_all(source, r"(?i)\b(\d{1,3})\s+Ill\.\s*Reg\.\s+(\d{1,6})\b", g) for g in (1, 2))
    registers = F.array_distinct(F.zip_with(volumes, pages, lambda v, p: F.concat(v, F.lit(" Ill. Reg. "), p)))
    return F.struct(body.alias("body"), F.coalesce(F.try_element_at(dates, F.lit(-1)), F.lit("")).alias("effective"), registers.alias("registers"), source.alias("source"))


def heading_and_body(c: Column, marker: str = r"^\([a-z0-9]+\)", lines: int = 8) -> Column:
    """X-21: struct(heading, body): lines up to the first that ends in a period or before the first marker, within so many lines."""
    parts = F.transform(F.filter(F.split(c, "\n"), lambda x: F.trim(x) != ""), lambda x: F.trim(x))
    stops = F.transform(parts, lambda x, i: F.when(x.rlike(marker), i).when(x.endswith("."), i + 1))
    stop = F.coalesce(F.array_min(F.filter(stops, lambda x: x.isNotNull())), F.lit(1))
    stop = F.least(stop, F.lit(lines), F.size(parts))
    return F.struct(F.array_join(F.slice(parts, 1, stop), " ").alias("heading"), F.array_join(F.slice(parts, stop + 1, F.greatest(F.size(parts) - stop, F.lit(0))), "\n").alias("body"))


def heading_at_terminator(c: Column, terminator: str, most: int = 700, fallback: int = 200) -> Column:
    """X-22: struct(heading, body) cut after a citation terminator among the first characters, else after the first period within fallback."""
    head = F.left(c, F.lit(most))
    first = F.when(head.rlike(terminator), F.length(extract(head, rf"(?s)^(.*?{terminator})")))
    period = F.nullif(F.instr(F.left(c, F.lit(fallback)), "."), F.lit(0))
    cut = F.coalesce(first, period, F.least(F.length(c), F.lit(fallback)))
    return F.struct(F.trim(F.left(c, cut)).alias("heading"), F.trim(F.substring(c, cut + 1, F.length(c))).alias("body"))


def safe_id(c: Column) -> Column:
    """X-23: runs of other than letters and digits as one underscore."""
    return F.regexp_replace(c, "[^A-Za-z0-9]+", "_")


def act_slug(c: Column) -> Column:
    """X-24: runs of other than letters, digits and dashes as one dash, none at the start; case and a last dash stay."""
    return F.regexp_replace(F.regexp_replace(F.trim(c), "[^0-9A-Za-z-]+", "-"), "^-+", "")


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    """X-25: white-space tokens."""
    return F.size(words(c))


def token_estimate(c: Column) -> Column:
    """X-26: a quarter of the characters, rounded down."""
    return F.floor(F.length(c) / 4).cast("int")


def ruling_number(c: Column) -> Column:
    """X-27: one blank between words, en dashes as hyphens, `( 9 )` as `(9)`."""
    c = F.translate(collapse(c), "–—", "--")
    return F.regexp_replace(F.regexp_replace(c, r"\s*-\s*", "-"), r"\s*\(\s*(\w+)\s*\)", "($1)")


def subject(c: Column) -> Column:
    """X-28: the last two of the last four plausible lines."""
    lines = F.filter(F.transform(F.split(c, "\n"), collapse), lambda x: x != "")
    last = F.slice(lines, F.greatest(F.size(lines) - 3, F.lit(1)), F.lit(4))
    plausible = F.filter(last, lambda x: ~x.rlike(r"^(Part\s+\w+|\d+)$"))
    return F.array_join(F.slice(plausible, F.greatest(F.size(plausible) - 1, F.lit(1)), F.lit(2)), " ")


def first_present(*cs: Column) -> Column:
    """X-29 and X-47: the first that is neither null nor empty, trimmed."""
    return F.trim(F.coalesce(*[present(c) for c in cs], F.lit("")))


def joined_paragraphs(paragraphs: Column) -> Column:
    """X-30 with O-08: texts of struct(idx, text) by idx, empty ones left out, a blank line between."""
    texts = F.transform(F.array_sort(F.transform(paragraphs, lambda p: F.struct(p["idx"].alias("idx"), p["text"].alias("text")))), lambda p: p["text"])
    return F.array_join(F.filter(texts, lambda t: t.isNotNull() & (t != "")), "\n\n")


def bare_numbers(c: Column) -> Column:
    """X-45: parts between dashes and periods without leading zeros, joined by dashes."""
    return F.array_join(F.transform(F.split(c, "[-.]"), lambda p: F.when(p.rlike(r"^\d+$"), p.cast("bigint").cast("string")).otherwise(p)), "-")


def script_files(c: Column, variable: str = "versionArr", pattern: str = r"'([^']+\.html)'") -> Column:
    """X-46: file names after a variable in an inline script, each once, in order."""
    return F.when(F.instr(c, variable) > 0, F.array_distinct(extract_all(F.substring(c, F.instr(c, variable), F.length(c)), pattern, 1))).otherwise(F.expr("cast(array() as array<string>)"))


def title_case(c: Column) -> Column:
    """P-32: each word capitalised, also after a hyphen, small words in lower case but at the start."""
    low = F.lower(c)
    parts = F.transform(F.split(low, " "), lambda w, i: F.when((i > 0) & w.isin("of", "the", "and", "for", "in", "to", "a", "an", "or"), w).otherwise(hyphen_title(w)))
    return F.array_join(parts, " ")


def hyphen_title(c: Column) -> Column:
    """P-07: capitals after every non-letter, as in `Subject-Group`."""
    return F.array_join(F.transform(F.split(c, "-"), F.initcap), "-")
