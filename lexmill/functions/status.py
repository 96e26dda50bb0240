"""Status and kind of sections, files and runs: ordered cascades and predicates over text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import extract

# Fixed patterns of status markers at the head of a text.
REPEALED = r"(?i)^\s*(?:\[Repealed[\]\s]|\(Repealed\s+by\b|Repealed\s*\.(?:\s|$)|Repealed\s+by\b)"
RESERVED = r"(?i)^\s*(?:\[Reserved\]|Reserved\s*\.(?:\s|$))"


def cascade(subject: Column, rules: tuple[tuple[str, str], ...], default: str) -> Column:
    """The value of the first rule whose pattern matches."""
    out = F.lit(default)
    for pattern, value in reversed(rules):
        out = F.when(subject.rlike(pattern), F.lit(value)).otherwise(out)
    return out


def head(c: Column, limit: int = 300) -> Column:
    """F-05: the first characters without white space and section numbers before them."""
    first = F.left(F.regexp_replace(c, r"\A\s+", ""), F.lit(limit))
    return F.regexp_replace(F.regexp_replace(first, r"\A[\d.\-:()§\s]+", ""), r"\A\s+", "")


def is_repealed(c: Column) -> Column:
    """F-03."""
    return F.coalesce(head(c).rlike(REPEALED), F.lit(False))


def is_reserved(c: Column) -> Column:
    """F-04."""
    return F.coalesce(head(c).rlike(RESERVED), F.lit(False))


def flipped(status: Column, c: Column) -> Column:
    """E-09: a status that is unset or in force becomes repealed or reserved by the head of the text."""
    open_ = status.isNull() | status.isin("", "in_force")
    return F.when(open_ & is_repealed(c), "repealed").when(open_ & is_reserved(c), "reserved").otherwise(status)


def has_keyword(c: Column, keywords: tuple[str, ...], any_case: bool = True) -> Column:
    """F-06."""
    t = F.lower(c) if any_case else c
    return reduce(lambda a, b: a | b, [F.contains(t, F.lit(k.lower() if any_case else k)) for k in keywords])


def first_keyword(heading: Column, body: Column, keywords: tuple[str, ...], limit: int = 120, default: str = "in_force") -> Column:
    """F-07: the first keyword of the list that the heading or the first characters of the body hold."""
    t = F.lower(F.concat_ws(" ", heading, F.left(body, F.lit(limit))))
    out = F.lit(default)
    for k in reversed(keywords):
        out = F.when(F.contains(t, F.lit(k)), F.lit(k)).otherwise(out)
    return out


#: Fixed cascade of reasons, in order.
REASONS = (("repeal|abolish", "repealed"), ("expired", "expired"), ("omitted", "omitted"), ("reserved", "reserved"), ("renumber", "renumbered"), ("transferred", "transferred"), ("recodified", "recodified"), ("not fund", "not_funded"), ("not applicable", "not_applicable"))
ENTRY_STATUSES = ("current", "proposed", "withdrawn", "repealed", "inactive", "expired", "reserved", "vacated")


def status_of_reason(c: Column) -> Column:
    """F-08."""
    return cascade(F.lower(F.trim(F.coalesce(c, F.lit("")))), REASONS, "in_force")


def status_of_entry(c: Column) -> Column:
    """F-09: the last word of a contents entry if it is a status."""
    last = F.lower(F.regexp_extract(F.trim(c), r"(\S+)$", 1))
    return F.when(last.isin(*ENTRY_STATUSES), last).otherwise(F.lit(""))


def status_of_name(c: Column) -> Column:
    """F-10: repealed before transferred before reserved."""
    return cascade(F.lower(c), (("repealed", "repealed"), ("transferred", "transferred"), ("reserved", "reserved")), "in_force")


def is_capital_header(c: Column) -> Column:
    """F-11: over 85 in 100 letters are capitals, a period at the end, no contents row, not reserved."""
    t = F.trim(c)
    letters = F.regexp_replace(F.regexp_replace(t, r"\([^)]*\)", " "), "[^A-Za-z]", "")
    upper = F.length(F.regexp_replace(letters, "[^A-Z]", ""))
    row = F.contains(t, F.lit("....")) | t.rlike(r"\.\s*\d+\s*$") | t.rlike(r"(?i)\(?\breserved\b\)?")
    return ~row & (F.length(letters) > 0) & (upper > 0.85 * F.length(letters)) & t.endswith(".")


#: Fixed beginnings of history lines.
HISTORY_STARTS = ("Added by", "Amended by", "Renumbered", "Redesignated", "Transferred", "Acts ", "Repealed by", "Reenacted")


def is_history_line(c: Column) -> Column:
    """F-12."""
    return reduce(lambda a, b: a | b, [c.startswith(s) for s in HISTORY_STARTS])


def is_contents_row(c: Column) -> Column:
    """F-13."""
    return F.contains(c, F.lit("....")) | c.startswith("TABLE OF CONTENTS") | c.startswith("INDEX")


def file_kind(c: Column) -> Column:
    """F-14: toc, front, section, chapter, title, other, in that order."""
    name = F.substring_index(c, "/", -1)
    rules = ((r"-toc\.(htm|pdf)$", "toc"), (r"-front\.(htm|pdf)$", "front"), (r"-sec[\w.\-]+\.(htm|pdf)$", "section"), (r"-chap\w+\.(htm|pdf)$", "chapter"), (r"^USCODE-\d+-title\d+\.(htm|pdf)$", "title"))
    return cascade(name, rules, "other")


def run_outcome(out: Column, err: Column, code: Column, sections: Column) -> Column:
    """F-15: why a run found nothing, by an ordered cascade over its output."""
    t = F.lower(F.concat_ws("\n", out, err))
    has = lambda *words: reduce(lambda a, b: a & b, [F.contains(t, F.lit(w)) for w in words])
    late = (code == 124) | has("timeout", "connect")
    return (
        F.when(sections > 0, "ok").when(late & has("connection to", "timed out"), "geofenced_tcp_timeout").when(late, "timeout")
        .when(has("chromedriver") | has("webdriver") | has("selenium"), "selenium_crash").when(has("attributeerror"), "selector_drift")
        .when(has("valueerror", "level_classifier"), "schema_mismatch").when(has("name resolution") | has("nodename"), "dns_failure")
        .when(has("403", "forbidden"), "http_403_blocked").when(has("no module named"), "import_error").when(code == 0, "no_content_nodes").otherwise("other")
    )


def ruling_kind(c: Column, program: Column) -> Column:
    """F-16."""
    low = F.left(F.lower(c), F.lit(2000))
    return F.when(program == "AR", "Acquiescence Ruling").when(F.contains(low, F.lit("policy interpretation ruling")), "Policy Interpretation Ruling").when(F.contains(low, F.lit("policy statement")), "Policy Statement").otherwise("Ruling")


def body_status(c: Column, rules: tuple[tuple[str, str], ...], limit: int = 200, default: str = "in_force") -> Column:
    """F-26: the first pattern that matches the first characters."""
    return cascade(F.left(c, F.lit(limit)), rules, default)


def looks_zip(body: Column) -> Column:
    """F-21."""
    return F.left(F.hex(body), F.lit(4)) == "504B"


def looks_pdf(body: Column) -> Column:
    return F.left(F.hex(body), F.lit(8)) == "25504446"


def is_challenge(c: Column) -> Column:
    """F-22: a page that asks whether the reader is a browser."""
    return has_keyword(c, ("just a moment", "cf-challenge", "attention required", "checking your browser"))


def granule(c: Column) -> Column:
    """P-28: hierarchy fields of a granule id."""
    g = lambda p: F.coalesce(extract(c, p), F.lit(""))
    return F.struct(
        extract(c, r"^USCODE-(\d{4})-title\d+").cast("int").alias("year"), extract(c, r"^USCODE-\d{4}-title(\d+)").cast("int").alias("title_number"), g("-subtitle([A-Z])").alias("subtitle"), g(r"-chap(\d+[A-Za-z]*)").alias("chapter"),
        g(r"-subchap([IVXLCDM]+|\d+[A-Za-z]*)").alias("subchapter"), g(r"-part([IVXLCDM]+|\d+[A-Za-z]*)").alias("part"), g(r"-subpart([IVXLCDM]+|\d+[A-Za-z]*|[A-Z])").alias("subpart"), g(r"-sec([^\-]+)$").alias("section_number"),
    )


def act_number(c: Column) -> Column:
    """P-26: four digits and a decimal digit, the decimal left out if it is zero."""
    return F.concat(F.left(c, F.lit(4)).cast("int").cast("string"), F.when(F.right(c, F.lit(1)) == "0", "").otherwise(F.concat(F.lit("."), F.right(c, F.lit(1)))))


def manifest_entry(c: Column) -> Column:
    """S-12: struct(chapter, act, type, section) of a fixed-width line, null for others."""
    f = F.struct(F.left(c, F.lit(4)).cast("int").alias("chapter"), act_number(F.substring(c, 5, 5)).alias("act"), F.substring(c, 10, 1).alias("type"), F.trim(F.substring(c, 11, 1000)).alias("section"))
    return F.when(c.rlike(r"^\d{9}[AFHK]"), f)


def versioned_section(c: Column) -> Column:
    """P-29: struct(title, article, chapter, citation, path, version) of `T-A-C-S` with a version letter or not; null for others."""
    p = F.split(F.trim(c), "-")
    version = F.when((F.size(p) == 5) & F.get(p, F.lit(4)).rlike("^[a-z]$"), F.get(p, F.lit(4)))
    base = F.slice(p, F.lit(1), F.lit(4))
    ok = ((F.size(p) == 4) | version.isNotNull()) & F.forall(base, lambda x: F.trim(x) != "")
    citation = F.array_join(F.transform(base, lambda x: F.trim(x)), "-")
    return F.when(ok, F.struct(F.get(base, F.lit(0)).alias("title"), F.get(base, F.lit(1)).alias("article"), F.get(base, F.lit(2)).alias("chapter"), citation.alias("citation"), F.concat_ws("-", citation, version).alias("path"), version.alias("version")))


#: Fixed bodies of law of one state's labels.
BODIES = ("RS", "CC", "CCP", "CCRP", "CE", "CHC")


def label_parts(c: Column) -> Column:
    """P-30: struct(body, title, number) of `RS 14:30` or `CC 2315`; null for headings."""
    body, rest = F.regexp_extract(F.trim(c), r"^([A-Z]+)\s+(.+)$", 1), F.trim(F.regexp_extract(F.trim(c), r"^([A-Z]+)\s+(.+)$", 2))
    title, number = F.trim(F.substring_index(rest, ":", 1)), F.trim(F.regexp_extract(rest, r"^[^:]*:(.*)$", 1))
    code = F.when(body == "RS", F.contains(rest, F.lit(":")) & (title != "") & (number != "")).otherwise(rest.rlike("^[0-9]"))
    return F.when(body.isin(*BODIES) & code, F.struct(body.alias("body"), F.when(body == "RS", title).otherwise(F.lit("")).alias("title"), F.when(body == "RS", number).otherwise(rest).alias("number")))


def file_parts(c: Column) -> Column:
    """P-31: struct(title, part, subpart, section) of a regulation's file name, null for others."""
    p = r"^(\d{3})(\d{5})([A-Z])?(\d{4,6})R?\.html$"
    return F.when(c.rlike(p), F.struct(*[F.regexp_extract(c, p, i + 1).alias(n) for i, n in enumerate(("title", "part", "subpart", "section"))]))


def chapter_of_section(c: Column, rule: str = "middle") -> Column:
    """P-27: the middle part between dashes, or the leading digits."""
    return F.split_part(c, F.lit("-"), F.lit(2)) if rule == "middle" else F.regexp_extract(c, r"^(\d+)", 1)


def spec_values(c: Column) -> Column:
    """P-33: years of a specification such as `2019-2021,2024`."""
    parts = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda p: p != "")

    def one(p: Column) -> Column:
        low = F.regexp_extract(p, r"^(\d{4})", 1).cast("int")
        high = F.coalesce(F.nullif(F.regexp_extract(p, r"^\d{4}-(\d{4})$", 1), F.lit("")).cast("int"), low)
        return F.sequence(low, high)

    return F.flatten(F.transform(F.filter(parts, lambda p: p.rlike(r"^\d{4}(-\d{4})?$")), one))
