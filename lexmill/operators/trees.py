"""Nested documents: trees of laws, details, breadcrumbs, paragraphs and partial links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import collapse, extract, first_present, inline_text, present
from lexmill.work import work_dir, written


def law_leaves(laws: DataFrame, law: str, tree: str) -> DataFrame:
    """S-22: (law, type, location, title, text, path) of a JSON tree's leaves.

    Subtrees marked repealed are left out; a container without children that has a text is a
    leaf itself. Level by level: a recursive query over the items of each node, which raises beyond
    spark.sql.cteRecursionLevelLimit levels.
    """
    return laws.sparkSession.sql(
        f"""WITH RECURSIVE walk(law, node, path, depth) AS (
              SELECT {law}, get_json_object({tree}, '$.documents'), '', 0 FROM {{laws}} WHERE get_json_object({tree}, '$.documents') IS NOT NULL
              UNION ALL
              SELECT law, item, concat(path, '/', coalesce(get_json_object(node, '$.docLevelId'), '')), depth + 1
              FROM (SELECT law, path, depth, node, explode(from_json(get_json_object(node, '$.documents.items'), 'array<string>')) AS item FROM walk
                    WHERE coalesce(get_json_object(node, '$.repealed'), 'false') <> 'true' AND coalesce(get_json_object(node, '$.docType'), '') NOT IN ('SECTION', 'RULE')))
            SELECT law, get_json_object(node, '$.docType') AS type, coalesce(get_json_object(node, '$.locationId'), get_json_object(node, '$.docLevelId'), '') AS location,
              trim(coalesce(get_json_object(node, '$.title'), '')) AS title, trim(get_json_object(node, '$.text')) AS text, path
            FROM walk WHERE coalesce(get_json_object(node, '$.repealed'), 'false') <> 'true' AND trim(coalesce(get_json_object(node, '$.text'), '')) <> ''
              AND (get_json_object(node, '$.docType') IN ('SECTION', 'RULE') OR size(coalesce(from_json(get_json_object(node, '$.documents.items'), 'array<string>'), array())) = 0)""",
        laws=laws,
    )


DETAIL = "TitleNumber string, TitleName string, ChapterList array<struct<SectionNumber: string, SectionTitle: string, ChapterNum: string, ArticleNum: string, PartNum: string, Body: string, SectionText: string>>"


def section_detail(json: Column) -> Column:
    """S-23: struct of a section's detail, null if it has no section."""
    d = F.from_json(json, DETAIL)
    c = F.get(d["ChapterList"], F.lit(0))
    fields = F.struct(*[F.trim(F.coalesce(v, F.lit(""))).alias(n) for n, v in (("title", d["TitleNumber"]), ("title_name", d["TitleName"]), ("chapter", c["ChapterNum"]), ("article", c["ArticleNum"]), ("part", c["PartNum"]), ("section", c["SectionNumber"]), ("heading", c["SectionTitle"]))], first_present(c["Body"], c["SectionText"]).alias("body"))
    return F.when(F.trim(F.coalesce(c["SectionNumber"], F.lit(""))) != "", fields)


def any_depth(json: Column, key: str) -> Column:
    """T-24: the first string value of a key at any depth of a JSON text."""
    return F.regexp_replace(F.regexp_extract(json, rf'"{key}"\s*:\s*"((?:[^"\\]|\\.)*)"', 1), r'\\(["\\/])', "$1")


def agency(page: Column) -> Column:
    """T-08: struct(number, name) if one of the first six lines is `Agency N`; the name is the first of the next four that can be one."""
    lines = F.filter(F.transform(F.split(page, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    at = F.array_min(F.transform(F.filter(F.transform(F.slice(lines, 1, 6), lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: s["x"].rlike(r"^Agency\s+\d+$")), lambda s: s["i"]))
    after = F.filter(F.slice(lines, F.coalesce(at, F.lit(0)) + 2, F.lit(4)), lambda x: ~x.rlike(r"(?i)^(Articles?$|\d)"))
    return F.when(at.isNotNull(), F.struct(F.regexp_extract(F.get(lines, at), r"(\d+)$", 1).alias("number"), F.coalesce(F.get(after, F.lit(0)), F.lit("")).alias("name")))


def articles(page: Column) -> Column:
    """Headers `Article N.--NAME` in order; names in small letters are contents rows."""
    pattern = r"(?m)^Article\s+(\d+)\.\s*[-—–]+\s*(.+)$"
    numbers, names = (F.regexp_extract_all(page, F.lit(pattern), F.lit(g)) for g in (1, 2))
    both = F.zip_with(numbers, names, lambda n, x: F.struct(n.alias("number"), F.regexp_replace(collapse(x), r"\.+$", "").alias("name")))
    return F.filter(both, lambda s: (s["name"] != "") & ~s["name"].rlike("^[a-z]"))


def breadcrumb_lines(c: Column) -> Column:
    """T-10: struct of the lines TITLE, CHAPTER, SUBCHAPTER, PART and SUBPART of a heading."""
    line = lambda p: F.trim(F.coalesce(extract(c, p), F.lit("")))
    return F.struct(
        line(r"(?im)^\s*TITLE\s+\d+\s*:?\s*(.+)$").alias("title_name"), line(r"(?im)^\s*(CHAPTER\s.+)$").alias("chapter_label"), line(r"(?im)^\s*CHAPTER\s+[IVXLCDM\d]+\s*:?\s*(.+)$").alias("issuing_agency"),
        line(r"(?im)^\s*(SUBCHAPTER\s.+)$").alias("subchapter_label"), line(r"(?im)^\s*PART\s+(\w+)").alias("part_num"), line(r"(?im)^\s*PART\s+\w+\s*(.*)$").alias("part_name"),
        F.upper(line(r"(?im)^\s*SUBPART\s+([A-Z])\b")).alias("subpart_letter"), line(r"(?im)^\s*SUBPART\s+[A-Z]\s*:?\s*(.*)$").alias("subpart_name"),
    )


def merged_paragraphs(paragraphs: DataFrame, node: str, idx: str, key: str, text: str) -> DataFrame:
    """A-11: neighbours of one id are one paragraph, their texts by a blank line; an id that comes again later is a copy."""
    w = Window.partitionBy(node).orderBy(idx)
    rows = paragraphs.withColumn("island", F.sum((~F.coalesce(F.lag(key).over(w) == F.col(key), F.lit(False))).cast("int")).over(w))
    parts = F.sort_array(F.collect_list(F.struct(F.col(idx).alias("i"), F.col(text).alias("t"))))
    rows = rows.groupBy(node, "island", key).agg(F.min(idx).alias(idx), F.array_join(F.transform(parts, lambda p: p["t"]), "\n\n").alias(text))
    n = F.row_number().over(Window.partitionBy(node, key).orderBy(idx))
    return rows.withColumn(key, F.when(n > 1, F.concat(F.col(key), F.lit("-copy-"), (n - 1).cast("string"))).otherwise(F.col(key))).drop("island")


def resolved_links(links: DataFrame, nodes: DataFrame, link: str, node: str) -> DataFrame:
    """J-15: a partial link with the node that shares its longest suffix of components, the smallest of equals; null if none."""
    suffixes = lambda c: F.transform(F.sequence(F.lit(1), F.size(F.split(c, "/"))), lambda k: F.struct(k.alias("k"), F.array_join(F.slice(F.split(c, "/"), F.size(F.split(c, "/")) - k + 1, k), "/").alias("tail")))
    a = links.select(link).distinct().select(link, F.explode(suffixes(F.col(link))).alias("s")).select(link, "s.k", "s.tail")
    b = nodes.select(F.col(node), F.explode(suffixes(F.col(node))).alias("s")).select(node, F.col("s.tail").alias("tail")).groupBy("tail").agg(F.min(node).alias(node))
    best = a.join(b, "tail").groupBy(link).agg(F.max(F.struct("k", (F.lit(0)).alias("z"), node)).alias("m")).select(link, F.col(f"m.{node}").alias(node))
    return links.join(best, link, "left")


def enclosing(sections: DataFrame, parts: DataFrame, doc: str, at: str) -> DataFrame:
    """J-12: each section with the innermost part whose offsets (lo, hi) hold it."""
    joined = sections.join(parts, doc, "left").where(F.col("lo").isNull() | ((F.col("lo") <= F.col(at)) & (F.col(at) < F.col("hi"))))
    found = joined.groupBy(doc, at).agg(F.max(F.struct("lo", "part")).alias("p")).select(doc, at, F.col("p.part").alias("part"))
    return sections.join(found, [doc, at], "left")


def element(xml: Column, name: str) -> Column:
    """The text of the first element of a name, null if there is none or it is empty."""
    return present(inline_text(F.regexp_extract(xml, rf"(?s)<{name}\b[^>]*>(.*?)</{name}>", 1)))


def elements(xml: Column, name: str) -> Column:
    return F.regexp_extract_all(xml, F.lit(rf"(?s)<{name}\b[^>]*>.*?</{name}>"), F.lit(0))


def granules(docs: DataFrame, key: str, xml: str) -> DataFrame:
    """S-14: (key, granule, title, class) of the related items of a metadata document."""
    rows = docs.select(key, F.explode(elements(F.col(xml), "relatedItem")).alias("x"))
    name = F.coalesce(element(F.col("x"), "accessId"), F.regexp_replace(F.regexp_extract("x", 'ID="([^"]*)"', 1), "^id-", ""))
    return rows.select(key, name.alias("granule"), element(F.col("x"), "title").alias("title"), element(F.col("x"), "granuleClass").alias("class"))


def inherited(docs: DataFrame, key: str, xml: str, outer: str, name: str, inner: str, number: str, body: str) -> DataFrame:
    """S-15 and S-18: (key, context, number, body) of inner elements, with the name of the outer element that holds them, null outside of any."""
    x = F.col(xml)
    blocks = F.transform(elements(x, outer), lambda o: F.struct(element(o, name).alias("context"), o.alias("x")))
    rest = F.array(F.struct(F.lit(None).cast("string").alias("context"), F.regexp_replace(x, rf"(?s)<{outer}\b[^>]*>.*?</{outer}>", "").alias("x")))
    rows = docs.select(key, F.explode(F.concat(blocks, rest)).alias("o")).select(key, "o.context", F.explode(elements(F.col("o.x"), inner)).alias("x"))
    return rows.select(key, "context", element(F.col("x"), number).alias("number"), element(F.col("x"), body).alias("body"))


def section(xml: Column) -> Column:
    """S-17: struct(number, heading, body); the body of a section without text is made of its heading and note."""
    heading, note = element(xml, "heading"), element(xml, "annotations")
    omitted = F.concat(F.lit("[Omitted] "), F.coalesce(heading, F.lit("")), F.lit(". "), F.coalesce(note, F.lit("")))
    return F.struct(element(xml, "num").alias("number"), heading.alias("heading"), F.coalesce(element(xml, "text"), F.trim(omitted)).alias("body"))


def flat(nodes: DataFrame, node: str, parent: str, label: str) -> DataFrame:
    """T-19: (node, depth, line) of every node below a root (null parent), a line being the label after two blanks a level; level by level until none is left."""
    folder, depth = work_dir(nodes.sparkSession), 0
    slim = nodes.select(F.col(node).alias("node"), F.col(parent).alias("parent"), F.col(label).alias("label"))
    level = written(slim.where("parent is null").select("node", "label", F.lit(0).alias("depth")), folder, "0")
    out = level
    while not level.isEmpty():
        depth += 1
        above = level.select(F.col("node").alias("parent"))
        level = written(slim.join(above, "parent").select("node", "label", F.lit(depth).alias("depth")), folder, str(depth))
        out = out.unionByName(level)
    return out.select("node", "depth", F.concat(F.repeat(F.lit("  "), F.col("depth")), "label").alias("line"))
