"""Queries over records, trees and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.operators import records, trees
from lexmill.plans.recipe import DOCS, NODES, query


@query("p13_records", DOCS, "SELECT doc_id, 'STATE_MN_ADR_' || doc_id || '_0010' AS act_id, 'Minn. R. ' || doc_id || '.0010' AS citation, 'state_regulation' AS category, len(regexp_extract_all(text, '\\S+'))::INTEGER AS word_count, sha1(text) AS full_text_sha1 FROM base")
def _(d):
    s = d.select("doc_id", F.lit("mn_regulations").alias("source_name"), F.lit("mn").alias("state"), F.concat("doc_id", F.lit(".0010")).alias("number"), F.lit("").alias("part"), F.lit("").alias("prefix"), F.lit("").alias("rule_set"), F.lit("").alias("section_title"), "text")
    return records.records(s).withColumn("doc_id", F.regexp_extract("section_number", r"^(\d+)", 1).cast("bigint")).select("doc_id", "act_id", "citation", "category", "word_count", "full_text_sha1")


@query("p18_record_sources", "SELECT s_suppkey, s_name FROM {supplier}")
def _(d):
    names = F.array(*[F.lit(r[0]) for r in records.SOURCES])
    s = d.select(F.get(names, (F.col("s_suppkey") % len(records.SOURCES)).cast("int")).alias("source_name"), F.lit("xx").alias("state"), F.col("s_suppkey").cast("string").alias("number"), F.lit("7").alias("part"), F.lit("Pre.").alias("prefix"), F.lit("SET").alias("rule_set"), F.lit("").alias("section_title"), F.col("s_name").alias("text"))
    return records.records(s).groupBy("category", "document_type", "level_classifier").agg(F.count(F.lit(1)).alias("n"), F.min("act_id").alias("first_act"), F.min("citation").alias("first_citation"))


TREES = """SELECT s_suppkey, concat(chr(123), '"documents": ', chr(123), '"docType": "CHAPTER", "docLevelId": "L", "documents": ', chr(123), '"items": [', chr(123), '"docType": "SECTION", "locationId": "1", "title": " One ", "text": "', s_name, '"', chr(125), ', ',
  chr(123), '"docType": "ARTICLE", "docLevelId": "A2", "repealed": ', CASE WHEN s_suppkey % 2 = 0 THEN 'true' ELSE 'false' END, ', "documents": ', chr(123), '"items": [', chr(123), '"docType": "SECTION", "locationId": "2", "text": "two"', chr(125), ']', chr(125), chr(125), ', ',
  chr(123), '"docType": "ARTICLE", "docLevelId": "A3", "text": "whole"', chr(125), ']', chr(125), chr(125), chr(125)) AS tree, s_name FROM {supplier}"""


@query("s22_law_leaves", TREES, "SELECT s_suppkey AS law, 'SECTION' AS type, '1' AS location, 'One' AS title, s_name AS text, '/L' AS path FROM base UNION ALL SELECT s_suppkey, 'SECTION', '2', '', 'two', '/L/A2' FROM base WHERE s_suppkey % 2 = 1 UNION ALL SELECT s_suppkey, 'ARTICLE', 'A3', '', 'whole', '/L' FROM base")
def _(d):
    return trees.law_leaves(d, "s_suppkey", "tree")


@query("s23_section_detail", "SELECT s_suppkey, concat(chr(123), '\"TitleNumber\": \"', s_nationkey, '\", \"ChapterList\": [', CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE concat(chr(123), '\"SectionNumber\": \" ', s_suppkey, '\", \"Body\": \"\", \"SectionText\": \"', s_name, '\"', chr(125)) END, ']', chr(125)) AS j, s_name, s_nationkey FROM {supplier}", "SELECT s_suppkey, s_nationkey::VARCHAR AS title, s_suppkey::VARCHAR AS section, s_name AS body, s_name AS found FROM base WHERE s_suppkey % 3 > 0")
def _(d):
    return d.withColumn("x", trees.section_detail(F.col("j"))).where("x is not null").select("s_suppkey", "x.title", "x.section", "x.body", trees.any_depth(F.col("j"), "SectionText").alias("found"))


@query("t08_agency_events", "SELECT s_suppkey, concat('x', chr(10), 'Agency ', s_suppkey, chr(10), 'Articles', chr(10), '1-1. Purpose', chr(10), s_name, chr(10), 'Article 5.--KANSAS ', s_suppkey, '.', chr(10), 'Article 6.-- small') AS page, s_name FROM {supplier}", "SELECT s_suppkey, s_suppkey::VARCHAR AS number, s_name AS name, '5:KANSAS ' || s_suppkey AS articles FROM base")
def _(d):
    a = F.array_join(F.transform(trees.articles(F.col("page")), lambda s: F.concat_ws(":", s["number"], s["name"])), "|")
    return d.select("s_suppkey", trees.agency(F.col("page")).alias("x"), a.alias("articles")).select("s_suppkey", "x.number", "x.name", "articles")


@query("t10_breadcrumb_lines", "SELECT s_suppkey, concat('TITLE 8: ', s_name, chr(10), 'CHAPTER I: DEPARTMENT ', s_suppkey, chr(10), 'SUBCHAPTER b: X', chr(10), 'PART ', s_suppkey, ' RULES', chr(10), 'SUBPART c: GENERAL') AS t, s_name FROM {supplier}", "SELECT s_suppkey, s_name AS title_name, 'CHAPTER I: DEPARTMENT ' || s_suppkey AS chapter_label, 'DEPARTMENT ' || s_suppkey AS issuing_agency, 'SUBCHAPTER b: X' AS subchapter_label, s_suppkey::VARCHAR AS part_num, 'RULES' AS part_name, 'C' AS subpart_letter, 'GENERAL' AS subpart_name FROM base")
def _(d):
    return d.select("s_suppkey", trees.breadcrumb_lines(F.col("t")).alias("x")).select("s_suppkey", "x.*")


@query("a11_merged_paragraphs", "SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus FROM {lineitem} GROUP BY l_orderkey, l_linenumber", ", i AS (SELECT *, sum(fresh) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN lag(l_returnflag) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) = l_returnflag THEN 0 ELSE 1 END AS fresh FROM base)), g AS (SELECT l_orderkey, island, l_returnflag, min(l_linenumber) AS l_linenumber, string_agg(l_linestatus, chr(10) || chr(10) ORDER BY l_linenumber, l_linestatus) AS t FROM i GROUP BY 1, 2, 3)\n--\nSELECT l_orderkey, l_linenumber, t AS l_linestatus, l_returnflag || CASE WHEN n > 1 THEN '-copy-' || (n - 1) ELSE '' END AS l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber) AS n FROM g)")
def _(d):
    return trees.merged_paragraphs(d, "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus").select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag")


@query("j12_enclosing_part", "SELECT l_orderkey AS doc, l_linenumber AS pos, l_partkey AS part, l_suppkey FROM {lineitem}", ", s AS (SELECT DISTINCT doc, pos FROM base WHERE pos % 2 = 0), p AS (SELECT doc, pos AS lo, pos + 3 AS hi, max(part) AS part FROM base WHERE pos % 2 = 1 GROUP BY 1, 2, 3)\n--\nSELECT s.doc, s.pos, arg_max(part, lo) AS part FROM s LEFT JOIN p ON s.doc = p.doc AND lo <= s.pos AND s.pos < hi GROUP BY 1, 2")
def _(d):
    parts = d.where("pos % 2 = 1").groupBy("doc", F.col("pos").alias("lo")).agg(F.max("part").alias("part")).withColumn("hi", F.col("lo") + 3)
    return trees.enclosing(d.where("pos % 2 = 0").select("doc", "pos").distinct(), parts, "doc", "pos").select("doc", "pos", "part")


@query("j15_partial_links", NODES, "SELECT s_suppkey, node_id FROM base")
def _(d):
    links = d.select("s_suppkey", F.concat_ws("/", F.lit("x"), F.concat(F.lit("chapter="), F.col("s_suppkey") % 7), F.concat(F.lit("section="), F.col("s_suppkey"))).alias("link"))
    return trees.resolved_links(links, d.select("node_id"), "link", "node_id").select("s_suppkey", "node_id")


@query("j17_batched_lookup", "SELECT o_orderkey, o_custkey, c_name FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey", "SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN c_name ELSE '' END AS content FROM base")
def _(d):
    looked = d.where("o_custkey % 2 = 0").select("o_custkey", F.col("c_name").alias("content")).distinct()
    return d.select("o_orderkey", "o_custkey").join(looked, "o_custkey", "left").select("o_orderkey", F.coalesce("content", F.lit("")).alias("content"))


@query("j05_chapter_names", NODES, ", c AS (SELECT DISTINCT concat(n_nationkey, '-chap', s_suppkey % 7) AS k, concat('Chapter ', s_suppkey % 7) AS name FROM base WHERE s_suppkey % 7 < 5)\n--\nSELECT s_suppkey, coalesce(name, '') AS chapter_name FROM base LEFT JOIN c ON k = concat(n_nationkey, '-chap', s_suppkey % 7)")
def _(d):
    key = F.concat("n_nationkey", F.lit("-chap"), F.col("s_suppkey") % 7)
    names = d.where("s_suppkey % 7 < 5").select(key.alias("k"), F.concat(F.lit("Chapter "), F.col("s_suppkey") % 7).alias("name")).distinct()
    return d.select("s_suppkey", key.alias("k")).join(names, "k", "left").select("s_suppkey", F.coalesce("name", F.lit("")).alias("chapter_name"))


@query("j18_chapter_metadata", "SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus, o_orderpriority FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey", "SELECT l_orderkey, l_linenumber, o_orderstatus AS authority, o_orderpriority AS history FROM base")
def _(d):
    chapters = d.select("l_orderkey", F.col("o_orderstatus").alias("authority"), F.col("o_orderpriority").alias("history")).distinct()
    return d.select("l_orderkey", "l_linenumber").join(chapters, "l_orderkey")
