"""Citations: inline references, amendment years, authority strings, source credits and history notes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.dates import iso_date
from lexmill.functions.text import collapse, extract, extract_all, present

# Fixed patterns of citations.
USC = r"(?i)\b(\d{1,2})\s*U\.?\s*S\.?\s*C\.?\s*(?:§+|sec(?:tion)?\.?)\s*(\d{1,5}[A-Za-z0-9.\-]*)"
CFR = r"(?i)\b(\d{1,2})\s*C\.?\s*F\.?\s*R\.?\s*(?:§+|sec(?:tion)?\.?)\s*(\d{1,4}\.[0-9A-Za-z\-]+)"
PUBLIC_LAW = r"(?i)\bPub\.?\s*L\.?\s*(?:No\.?\s*)?(\d{2,3}-\d{1,4})"
AMENDED = r"(?i)\b(?:added|amended|enacted|repealed|effective|L\.?)\s*[^0-9]{0,40}\b((?:1[7-9]|20)\d{2})\b"
IN_BRACKETS = r"\((?:[A-Za-z. ,]{1,40})((?:1[7-9]|20)\d{2})\b"
LETTERS = r"(?m)(?:^|\n)\s*\(([a-z]{1,2})\)\s"
NUMBERS = r"(?m)(?:^|\n)\s*\((\d+)\)\s"
ROMANS = r"(?m)(?:^|\n)\s*\(([ivxlcdm]{1,5})\)\s"
AUTHORITY_USC = r"\b(\d{1,2})\s+U\.?\s*S\.?\s*C\.?(?:\s*§+)?\s*(\d[\w\.\-]*(?:\s*(?:,|-|and)\s*\d[\w\.\-]*)*)"
ORDER = r"(?i)\b(?:E\.?\s*O\.?|Executive\s+Order)\s+(\d{3,6})"
REGISTER = r"\b(\d+)\s+FR\s+(\d{2,6}(?:-\d{2,6})?)"
LAW = r"\bPub\.\s*L\.\s*(\d+)[\-–](\d+)(?:,\s*§\s*(\d[\w\.\-]*))?"
STATUTES = r"\b(\d+)\s+Stat\.\s+(\d+)"
CODE = r"\b(\d{1,2})\s+CFR\b(?:[,\s]+([^;]{1,100}?))?(?=\s*(?:;|$|\.$))"
NOTES = r"(?:interpret|apply|and)\s+[a-z\s]{2,30}\s+(?:sec\.|§)"


def sorted_distinct(c: Column, most: int | None = None) -> Column:
    """A-09: sorted, each once, the first so many."""
    out = F.array_sort(F.array_distinct(c))
    return F.slice(out, F.lit(1), F.lit(most)) if most else out


def joined_matches(c: Column, pattern: str, separator: str = ":") -> Column:
    return F.zip_with(extract_all(c, pattern, 1), extract_all(c, pattern, 2), lambda a, b: F.concat(a, F.lit(separator), b))


def subsection_letters(c: Column) -> Column:
    """E-02."""
    return sorted_distinct(extract_all(c, LETTERS, 1))


def numbered_paragraphs(c: Column) -> Column:
    """E-03: different numbers and different roman numerals; (i), (v) and the like count as letters too."""
    return F.size(F.array_distinct(extract_all(c, NUMBERS, 1))) + F.size(F.array_distinct(extract_all(c, ROMANS, 1)))


def usc_references(c: Column) -> Column:
    """E-04."""
    return sorted_distinct(joined_matches(c, USC))


def cfr_references(c: Column) -> Column:
    """E-05."""
    return sorted_distinct(joined_matches(c, CFR))


def public_laws(c: Column) -> Column:
    """E-06."""
    return sorted_distinct(F.transform(extract_all(c, PUBLIC_LAW, 1), lambda x: F.concat(F.lit("Pub. L. "), x)))


def amendment_years(c: Column, edition: Column | None = None) -> Column:
    """E-07: years after a verb, or, only if there are none at all, years in brackets; within 1789 and the edition."""
    verb, bracket = extract_all(c, AMENDED, 1), extract_all(c, IN_BRACKETS, 1)
    years = F.transform(F.when(F.size(verb) > 0, verb).otherwise(bracket), lambda y: y.cast("int"))
    last = F.lit(2100) if edition is None else F.when(edition >= 1789, edition).otherwise(F.lit(2100))
    return sorted_distinct(F.filter(years, lambda y: (y >= 1789) & (y <= last)))


def enriched(c: Column, edition: Column | None = None) -> Column:
    """E-01 and E-08: one struct of everything above, over the full text."""
    letters, usc, cfr, laws, years = subsection_letters(c), usc_references(c), cfr_references(c), public_laws(c), amendment_years(c, edition)
    return F.struct(
        letters.alias("subsection_letters"), F.size(letters).alias("subsection_count"), numbered_paragraphs(c).alias("numbered_paragraph_count"),
        usc.alias("cross_references_usc"), cfr.alias("cross_references_cfr"), (F.size(usc) + F.size(cfr)).alias("cross_references_count"),
        laws.alias("public_laws_referenced"), F.size(laws).alias("public_laws_count"),
        years.alias("amendment_years"), F.size(years).alias("amendments_count"), F.array_max(years).alias("last_amended_year"),
    )


def enumerated(c: Column) -> Column:
    """X-37: sections of a list such as `1506, 1508-1510`; ranges of at most 50 are written out, falling ones are empty."""
    parts = F.filter(F.transform(F.split(F.regexp_replace(F.trim(c), r"[,;. ]+$", ""), r"\s*(?:,|\band\b)\s*"), lambda x: F.trim(x)), lambda p: p != "")

    def one(p: Column) -> Column:
        low, high = (F.regexp_extract(p, r"^(\d+)-(\d+)$", g).try_cast("bigint") for g in (1, 2))
        span = F.transform(F.sequence(low, F.greatest(low, high)), lambda n: n.cast("string"))
        none = F.expr("cast(array() as array<string>)")
        return F.when(p.rlike(r"^\d+-\d+$") & (high - low <= 50), F.when(high < low, none).otherwise(span)).otherwise(F.array(p))

    return F.flatten(F.transform(parts, one))


AUTHORITY_TYPE = "struct<type:string,title:int,section:string,number:string,volume:string,page:string,congress:int,law:int,ref:string,display:string>"


def _cite(**fields: Column) -> Column:
    names = [x.split(":") for x in AUTHORITY_TYPE[7:-1].split(",")]
    return F.struct(*[fields.get(n, F.lit(None)).cast(t).alias(n) for n, t in names])


def authority_text(c: Column) -> Column:
    """An authority string with one kind of dash and blank, `et seq.` as a comma, explanatory notes cut off."""
    t = F.trim(F.regexp_replace(F.translate(c, " –—", "---"), r"(?U)\s+", " "))
    t = F.when(F.contains(F.lower(t), F.lit("seq")), F.regexp_replace(t, r"(?i)\s+et\s+seq\.?\s*,?", ",")).otherwise(t)
    return F.when(t.rlike(NOTES), F.split(t, NOTES, 2)[0]).otherwise(t)


def usc_keys(c: Column) -> Column:
    """`title:section` of every U.S.C. section that an authority string cites; for indexes, which need no other type."""
    t = authority_text(c)

    def keys(title: Column, sections: Column) -> Column:
        one = F.array(F.regexp_replace(sections, r"[,;. ]+$", ""))
        each = F.when(sections.rlike(r"[^\w.]"), enumerated(sections)).otherwise(one)  # most cite one section
        return F.transform(each, lambda s: F.concat(title.cast("int").cast("string"), F.lit(":"), s))

    return F.array_distinct(F.flatten(F.zip_with(extract_all(t, AUTHORITY_USC, 1), extract_all(t, AUTHORITY_USC, 2), keys)))


def authority(c: Column) -> Column:
    """T-07: citations of an authority string by type (U.S.C., E.O., FR, Pub. L., Stat., CFR), the first of each display."""
    t = authority_text(c)
    usc = F.flatten(F.zip_with(extract_all(t, AUTHORITY_USC, 1), extract_all(t, AUTHORITY_USC, 2), lambda n, s: F.transform(enumerated(s), lambda x: _cite(type=F.lit("usc"), title=n, section=x, display=F.concat(n.cast("int").cast("string"), F.lit(" U.S.C. "), x)))))
    orders = F.transform(extract_all(t, ORDER, 1), lambda n: _cite(type=F.lit("executive_order"), number=n, display=F.concat(F.lit("E.O. "), n)))
    registers = F.zip_with(extract_all(t, REGISTER, 1), extract_all(t, REGISTER, 2), lambda v, p: _cite(type=F.lit("federal_register"), volume=v, page=p, display=F.concat(v, F.lit(" FR "), p)))
    laws = F.transform(F.arrays_zip(*[extract_all(t, LAW, g).alias(n) for g, n in ((1, "a"), (2, "b"), (3, "c"))]), lambda x: _cite(type=F.lit("public_law"), congress=x["a"], law=x["b"], section=present(x["c"]), display=F.concat(F.lit("Pub. L. "), x["a"], F.lit("-"), x["b"])))
    statutes = F.zip_with(extract_all(t, STATUTES, 1), extract_all(t, STATUTES, 2), lambda v, p: _cite(type=F.lit("statutes_at_large"), volume=v, page=p, display=F.concat(v, F.lit(" Stat. "), p)))
    codes = F.zip_with(extract_all(t, CODE, 1), extract_all(t, CODE, 2), lambda n, r: _cite(type=F.lit("cfr"), title=n, ref=F.trim(r), display=F.concat(n.cast("int").cast("string"), F.lit(" CFR"), F.when(F.trim(r) != "", F.concat(F.lit(", "), F.trim(r))).otherwise(F.lit("")))))
    return first_by(F.concat(usc, orders, registers, laws, statutes, codes), "display")


def first_by(items: Column, field: str) -> Column:
    """A-08 over structs: the first item of each value of the field, in order."""
    names = F.transform(items, lambda x: x[field])
    return F.filter(items, lambda x, i: F.array_position(names, x[field]) == i + 1)


def source_credit(c: Column) -> Column:
    """T-06: one struct for each part between semicolons: revised statutes, public law, act or other."""
    segments = F.transform(F.filter(F.split(c, ";"), lambda s: F.trim(s) != ""), lambda s: F.regexp_replace(F.trim(s), r"\.+$", ""))
    law, old, act = r"(?i)Pub\.\s*L\.\s*(\d+)[\-–](\d+)", r"(?i)\bR\.?\s*S\.?\s*§\s*(\d+)", r"(?i)(?:Act\s+(?:of\s+)?)?((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)[a-z\.]*\s+\d{1,2},\s+\d{4})[^;]*?ch\.\s*\d+"
    stat, section, title, chapter = r"\b(\d+)\s+Stat\.\s+(\d+)\b", r"§\s*(\d[\w\.\-]*(?:\([\w\.\-]+\))*)", r"(?i)\btitle\s+([IVXLCDM]+)\b", r"\bch\.\s*(\d+\w*)"

    first = lambda s, p, g=1: present(F.regexp_extract(s, p, g))
    kind = lambda s: F.when(s.rlike(law), "public_law").when(s.rlike(old), "revised_statutes").when(s.rlike(act), "act").otherwise("other")

    def one(x: Column) -> Column:
        s, k = x["s"], x["kind"]
        public, dated = k == "public_law", k.isin("public_law", "act")
        return F.struct(
            k.alias("type"), F.when(public, first(s, law)).cast("int").alias("congress"), F.when(public, first(s, law, 2)).cast("int").alias("law"),
            F.when(dated, present(iso_date(s))).alias("date"), F.when(k == "act", first(s, act)).alias("date_text"), F.when(dated, first(s, stat)).cast("int").alias("stat_volume"), F.when(dated, first(s, stat, 2)).cast("int").alias("stat_page"),
            F.when(public, F.upper(first(s, title))).alias("title_roman"), F.when(public, first(s, section)).when(k == "revised_statutes", first(s, old)).alias("section"),
            F.when(k == "act", first(s, chapter)).alias("chapter"), F.when(k == "revised_statutes", F.concat(F.lit("R.S. §"), first(s, old))).otherwise(s).alias("display"),
        )

    return F.transform(F.transform(segments, lambda s: F.struct(kind(s).alias("kind"), s.alias("s"))), one)


def washington_history(c: Column) -> Column:
    """T-11, where the first effective date is the current one."""
    rcw = F.array_distinct(extract_all(c, r"RCW\s+([\d]+[\dA-Za-z.]*)", 1))
    effective = F.array_distinct(extract_all(c, r"effective\s+(\d{1,2}/\d{1,2}/\d{2,4})", 1))
    preamble = F.regexp_replace(collapse(extract(c, r"(?is)Statutory Authority:\s*(.*?)(?:\bWSR\b|$)")), r"[. ]+$", "")
    return F.struct(
        F.coalesce(present(preamble), F.when(F.size(rcw) > 0, F.concat(F.lit("RCW "), F.array_join(rcw, ", "))), F.lit("")).alias("authority"), F.transform(rcw, lambda x: F.concat(F.lit("RCW "), x)).alias("rcw"),
        F.transform(F.array_distinct(extract_all(c, r"WSR\s+(\d{2}-\d{2}-\d{3})", 1)), lambda x: F.concat(F.lit("WSR "), x)).alias("filings"), F.array_distinct(extract_all(c, r"\(Order\s+([^)]+)\)", 1)).alias("orders"),
        F.coalesce(F.get(effective, F.lit(0)), F.lit("")).alias("effective"), F.array_join(F.slice(effective, F.lit(2), F.lit(1000)), "; ").alias("prior"),
    )


def minnesota_history(c: Column) -> Column:
    return F.struct(F.array_distinct(extract_all(c, r"\b\d+\s+SR\s+\d+\b")).alias("registers"), F.array_distinct(extract_all(c, r"\bL\s+\d{4}\s+c\s+\d+(?:\s+art\s+\d+)?(?:\s+s\s+\d+)?")).alias("laws"))


def virginia_history(c: Column) -> Column:
    """T-11, where the last effective date is the current one."""
    dates = F.array_distinct(F.transform(extract_all(c, r"eff\.\s+([A-Z][a-z]+\s+\d{1,2},\s+\d{4})", 1), lambda x: F.trim(x)))
    return F.struct(
        F.coalesce(F.try_element_at(dates, F.lit(-1)), F.lit("")).alias("effective"), F.array_join(F.slice(dates, F.lit(1), F.greatest(F.size(dates) - 1, F.lit(0))), "; ").alias("prior"),
        F.array_distinct(F.transform(extract_all(c, r"Volume\s+\d+,\s+Issue\s+\d+"), collapse)).alias("registers"), F.coalesce(extract(c, r"(?i)derived\s+from\s+([^\s,;]+)"), F.lit("")).alias("derived"),
    )


#: Fixed patterns by state: where its amendment notes stand, and the years in them.
AMENDMENT_NOTES = (
    ("va", None, r"ratified\s+[A-Za-z]+\.?\s+\d{1,2},?\s+((?:19|20)\d{2})"),
    ("md", None, r"ratified\s+[A-Za-z]+\.?\s+\d{1,2},?\s+((?:19|20)\d{2})"),
    ("wi", r"\[As (?:amended|created)[^\]]{0,200}\]", r"\b((?:19|20)\d{2})\b"),
    ("ak", r"\[Amended (?:19|20)\d{2}\]", r"\b((?:19|20)\d{2})\b"),
    ("mn", r"\[Amended,? [^\]]{0,60}\]", r"\b((?:19|20)\d{2})\b"),
    ("tn", r"\[As [Aa]mended:[^\]]{0,800}\]", r"\b((?:19|20)\d{2})\b"),
    ("wy", r"This section was (?:amended|repealed)(?: again)?.{0,400}", r"\b((?:19|20)\d{2})\b"),
    ("la", r"Amended by Acts.{0,600}", r"\b((?:19|20)\d{2})\b"),
    ("nh", r"Amended (?:19|20)\d{2}.{0,150}", r"\b((?:19|20)\d{2})\b"),
    ("ca", r"\(Sec\.\s*[\w.]+\s+(?:added|amended)[^)]{0,150}\)", r"\b((?:19|20)\d{2})\b"),
    ("nc", r"\((?:19|20)\d{2}[^()]{0,80}\)\s*$", r"\b((?:19|20)\d{2})\b"),
    ("ct", None, r"(?i)amended in ((?:19|20)\d{2})"),
    ("tx", None, r"(?i)\b(?:added|amended)\s+[A-Za-z]+\.?\s+\d{1,2},?\s+((?:19|20)\d{2})"),
    ("ne", None, r"(?i)\b(?:last\s+)?amended(?:\s+in)?\s+((?:19|20)\d{2})"),
    ("nj", None, r"(?i)amended effective [A-Za-z]+\.?\s+\d{1,2},?\s+((?:19|20)\d{2})"),
    ("pa", r"(?s)\([^()]*?J\.R\.[^()]*\)", r"\b((?:19|20)\d{2})\b"),
)


def years_in(spans: Column, year: str) -> Column:
    return F.flatten(F.transform(spans, lambda s: extract_all(s, year, 1)))


def constitution_events(c: Column, state: Column) -> Column:
    """E-10: every year of a state's amendment notes in order; none for states without a pattern."""
    out = None
    for code, span, year in AMENDMENT_NOTES:
        found = extract_all(c, year, 1) if span is None else years_in(extract_all(c, span), year)
        out = F.when(state == code, found) if out is None else out.when(state == code, found)
    return F.transform(out.otherwise(F.expr("cast(array() as array<string>)")), lambda y: y.cast("int"))


def amendment_summary(c: Column, state: Column) -> Column:
    """A-18: struct(events, years, last)."""
    raw = constitution_events(c, state)
    return F.struct(F.size(raw).alias("events"), sorted_distinct(raw).alias("years"), F.array_max(raw).alias("last"))


GUIDANCE = r"(Rev\.\s*Proc\.\s*\d{2,4}-\d+|Rev\.\s*Rul\.\s*\d{2,4}-\d+|Notice\s+\d{2,4}-\d+|Announcement\s+\d{2,4}-\d+)"
VERBS = ("modifies", "supersedes", "amplifies", "clarifies", "obsoletes")


def guidance_links(c: Column, own: Column) -> Column:
    """E-11: map of verb to the guidance it names, without the document itself."""
    flat = lambda x: F.lower(F.replace(x, F.lit(" "), F.lit("")))
    entries = []
    for verb in VERBS:
        hits = extract_all(c, rf"(?i)\b{verb}\b(?:[\s,]+(?:in\s+part|and\s+supersedes|and\s+amplifies))?[\s,]+" + GUIDANCE, 1)
        entries += [F.lit(verb), sorted_distinct(F.filter(F.transform(hits, collapse), lambda x: flat(x) != flat(own)))]
    return F.create_map(*entries)


def ruling_references(c: Column) -> Column:
    """E-12: struct(rulings, regulations, statutes), in order, each once; SSR before AR."""
    rulings = F.concat(extract_all(c, r"\bSSR\s+\d{2,4}-\d+[a-z]?"), extract_all(c, r"\bAR\s+\d{2,4}-\d+\(\d+\)"))
    return F.struct(F.array_distinct(F.transform(rulings, collapse)).alias("rulings"), F.array_distinct(extract_all(c, r"\b20\s+CFR\s+(\d+(?:\.\d+)?)", 1)).alias("regulations"), F.array_distinct(extract_all(c, r"\b42\s+U\.S\.C\.\s+(?:§\s*)?(\d+\w*)", 1)).alias("statutes"))
