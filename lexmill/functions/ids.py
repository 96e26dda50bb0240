"""Identity: path ids, act ids and content-addressed point ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import hyphen_title, present

#: Fixed levels of a path id.
LEVELS = ("title", "subtitle", "code", "part", "subpart", "division", "subdivision", "article", "subarticle", "chapter", "subchapter", "subject-group", "section", "appendix", "hub", "act")


def uuid_of(digest: Column) -> Column:
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def _hashed(act_id: Column, index: Column, digest: Column) -> Column:
    return uuid_of(F.md5(F.concat(act_id, F.lit("::"), index.cast("string"), F.lit("::"), digest).cast("binary")))


def point_id(act_id: Column, index: Column, text: Column) -> Column:
    """X-40 and X-44 (index -1 over the full text): an empty text has a name of its own."""
    t = F.coalesce(text, F.lit(""))
    return _hashed(act_id, index, F.when(t == "", F.lit("nochunktext")).otherwise(F.left(F.sha1(t.cast("binary")), F.lit(12))))


def point_id_hashed(act_id: Column, index: Column, text: Column) -> Column:
    """X-41: like point_id, with the hash of the empty text too."""
    return _hashed(act_id, index, F.left(F.sha1(F.coalesce(text, F.lit("")).cast("binary")), F.lit(12)))


def point_id_long(act_id: Column, index: Column, text: Column) -> Column:
    """X-42: with the whole hash of the text."""
    return _hashed(act_id, index, F.sha1(F.coalesce(text, F.lit("")).cast("binary")))


def text_sha1(text: Column) -> Column:
    """X-43."""
    return F.sha1(text.cast("binary"))


def pairs(node_id: Column) -> Column:
    """H-01: array<struct<classifier, number>> of a path id below country, jurisdiction and corpus."""
    parts = F.slice(F.split(node_id, "/"), F.lit(4), F.lit(1000))
    return F.transform(parts, lambda p: F.struct(F.split(p, "=", 2)[0].alias("classifier"), F.get(F.split(p, "=", 2), F.lit(1)).alias("number")))


def valid_levels(node_id: Column) -> Column:
    """Whether every classifier of the path is a known level."""
    return F.forall(pairs(node_id), lambda p: p["classifier"].isin(*LEVELS))


def level(node_id: Column, back: int = 1) -> Column:
    """H-02: the last pair, or the one before."""
    return F.try_element_at(pairs(node_id), F.lit(-back))


def parent_id(node_id: Column) -> Column:
    """H-03."""
    return F.regexp_replace(node_id, "/[^/]+$", "")


def ancestor_at(node_id: Column, name: str) -> Column:
    """H-04: the path up to the first component that starts with the level's name; null if none."""
    parts = F.split(node_id, "/")
    at = F.array_position(F.transform(parts, lambda p: p.startswith(name)), F.lit(True))
    return F.when(at > 0, F.array_join(F.slice(parts, F.lit(1), at.cast("int")), "/"))


def ancestors(path: Column, separator: str = r"\.", join: str = ".") -> Column:
    """H-05: all prefixes of a path, the root first."""
    parts = F.split(path, separator)
    return F.transform(parts, lambda _, i: F.array_join(F.slice(parts, F.lit(1), i + 1), join))


def act_id(node_id: Column, state: Column) -> Column:
    """P-04: STATE_XX and each level's first letter with its number; a hash of the path if it has no levels."""
    levels = F.transform(pairs(node_id), lambda p: F.concat(F.upper(F.left(p["classifier"], F.lit(1))), p["number"]))
    tail = F.when(F.size(levels) == 0, F.array(F.left(F.sha1(node_id.cast("binary")), F.lit(8)))).otherwise(levels)
    return F.concat_ws("_", F.concat(F.lit("STATE_"), F.upper(state)), tail)


def section_number(node_id: Column, number: Column) -> Column:
    """P-05."""
    last = level(node_id)
    return F.when(last["classifier"] == "section", last["number"]).otherwise(present(number))


def title_number(node_id: Column) -> Column:
    """P-06: digits of the first title, null if it has none."""
    first = F.get(F.filter(pairs(node_id), lambda p: p["classifier"] == "title"), F.lit(0))["number"]
    return present(F.regexp_replace(first, "[^0-9]", "")).try_cast("int")


def breadcrumb(node_id: Column) -> Column:
    """P-07."""
    return F.transform(pairs(node_id), lambda p: F.struct(p["classifier"].alias("type"), p["number"].alias("num"), F.concat(hyphen_title(p["classifier"]), F.lit(" "), p["number"]).alias("label"), F.lit("").alias("name")))


def display_path(node_id: Column, state_name: Column) -> Column:
    """P-08."""
    return F.concat_ws(" / ", F.concat(state_name, F.lit(" Code")), F.transform(breadcrumb(node_id), lambda b: b["label"]))


def embedding_prefix(state_name: Column, year: Column, title: Column, chapter: Column, section: Column, heading: Column) -> Column:
    """P-09: two header lines; the first always says In Force."""
    one = F.concat(F.lit("Statute: "), state_name, F.lit(" Code ("), year.cast("string"), F.lit(") | US | "), state_name, F.lit(" | In Force"))
    sec = F.when(present(section).isNotNull(), F.when(present(heading).isNotNull(), F.concat(F.lit("Section "), section, F.lit(": "), heading)).otherwise(F.concat(F.lit("Section "), section)))
    two = present(F.concat_ws(" | ", F.concat(F.lit("Title "), title.cast("string")), F.concat(F.lit("Chapter "), present(chapter)), sec))
    return F.concat(one, F.lit("\n"), F.coalesce(two, state_name), F.lit("\n\n"))


def default_citation(citation: Column, state: Column, title: Column, section: Column) -> Column:
    """P-10."""
    code = F.concat(F.upper(state), F.lit(". Code § "), section)
    made = F.when(present(section).isNotNull(), F.when(title.isNotNull(), F.concat(title.cast("string"), F.lit(" "), code)).otherwise(code))
    return F.coalesce(present(citation), made, F.lit(""))


def chunk_header(title_name: Column, citation: Column, section: Column, heading: Column, index: Column, total: Column) -> Column:
    """P-11: two lines before the first chunk of a constitution's section, one before the others."""
    part = F.when(total > 1, F.concat(F.lit(" | part "), (index + 1).cast("string"), F.lit(" of "), total.cast("string"))).otherwise(F.lit(""))
    label = F.coalesce(present(heading), F.concat(F.lit("Section "), section))
    head = F.concat(title_name, F.lit(" | "), citation, part)
    return F.when(index == 0, F.concat(head, F.lit("\n"), label, F.lit("\n\n"))).otherwise(F.concat(head, F.lit(" | "), F.left(label, F.lit(110)), F.lit("\n\n")))


def filled(template: Column, article: Column, section: Column, state: Column) -> Column:
    """P-12: a citation template with {art} and {sec} filled; `Xx. Const.` where there is none."""
    t = F.coalesce(template, F.concat(F.initcap(state), F.lit(". Const. art. {art}, § {sec}")))
    return F.replace(F.replace(t, F.lit("{art}"), article), F.lit("{sec}"), section)


def natural_key(c: Column) -> Column:
    """O-01: digit runs padded, so that 940.9 sorts before 940.10; mixed ids compare as text."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"\d+|\D+"), F.lit(0)), lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 12, "0")).otherwise(p))


def integer_key(c: Column) -> Column:
    """O-04: integers stored as text sort as numbers, all else last."""
    return F.coalesce(c.try_cast("bigint"), F.lit((1 << 63) - 1))
