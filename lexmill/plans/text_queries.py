"""Queries over scalar functions: text, dates, identity, status."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.functions import dates, ids, status, text
from lexmill.plans.recipe import CREDITS, DOCS, NODES, PAGES, query



def T():  # noqa: N802
    return F.col("text")



@query("x01_collapse", DOCS, r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean FROM base")
def _(d):
    return d.select("doc_id", text.collapse(T()).alias("clean"))


@query("x02_collapse_blanks", "SELECT doc_id, concat('  ', replace(text, '.', concat('.   ', chr(10), chr(10), chr(10), chr(10)))) AS text FROM {documents}", r"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '\A\s+|\s+\z', '', 'g') AS clean FROM base")
def _(d):
    return d.select("doc_id", text.collapse_blanks(T()).alias("clean"))


@query("x03_without_tags", PAGES, r"SELECT page_id, trim(regexp_replace(replace(replace(replace(html, chr(10), ''), chr(13), ''), chr(160), ' '), '<.*?>', '', 'g')) AS clean FROM base")
def _(d):
    return d.select("page_id", text.without_tags(F.col("html")).alias("clean"))


@query("x06_stripped_html", PAGES, r"SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&sect;', '§'), '&mdash;', '—'), '&ndash;', '–'), '&amp;', '&'), '\s+', ' ', 'g')) AS clean FROM base".replace('\\"', '"'))
def _(d):
    return d.select("page_id", text.stripped_html(F.col("html")).alias("clean"))


@query("x07_html_paragraphs", PAGES, r"SELECT page_id, len(regexp_extract_all(html, '(?is)<(?:p|li|blockquote)\b[^>]*>(.*?)</(?:p|li|blockquote)>', 1))::INTEGER AS n, md5(array_to_string(list_transform(regexp_extract_all(html, '(?is)<(?:p|li|blockquote)\b[^>]*>(.*?)</(?:p|li|blockquote)>', 1), lambda x: trim(regexp_replace(x, '<[^>]+>|\s+', '', 'g'))), '')) AS digest FROM base")
def _(d):
    raw = text.extract_all(F.col("html"), r"(?is)<(?:p|li|blockquote)\b[^>]*>(.*?)</(?:p|li|blockquote)>", 1)
    flat = F.transform(raw, lambda x: F.trim(F.regexp_replace(x, r"<[^>]+>|\s+", "")))
    return d.select("page_id", F.size(raw).alias("n"), F.md5(F.array_join(flat, "").cast("binary")).alias("digest"))


@query("x11_heading_name", "SELECT p_partkey, concat(CASE p_size % 4 WHEN 0 THEN 'CHAPTER ' WHEN 1 THEN 'Part ' WHEN 2 THEN 'SUBPART ' ELSE '' END, CASE WHEN p_size % 4 < 3 THEN 'IV - ' ELSE '' END, p_name) AS heading FROM {part}", r"SELECT p_partkey, trim(regexp_replace(heading, '^(CHAPTER|PART|SUBPART|SUBCHAPTER|SUBCHAP)\s+[\dIVXLCDMA-Z]+\s*[-—]+\s*', '', 'i')) AS name FROM base")
def _(d):
    return d.select("p_partkey", text.heading_name(F.col("heading")).alias("name"))


@query("x14_without_label", "SELECT s_suppkey, concat(' History: Authority ', s_name, '  x') AS t FROM {supplier}", r"SELECT s_suppkey, trim(regexp_replace(regexp_replace(regexp_replace(t, '^\s*History\s*:?\s*', '', 'i'), '^\s*Authority\s*:?\s*', '', 'i'), '\s+', ' ', 'g')) AS rest FROM base")
def _(d):
    return d.select("s_suppkey", text.without_label(F.col("t"), "History", "Authority").alias("rest"))


@query("x15_without_noise", "SELECT s_suppkey, concat('Rule | Rule | ', s_name) AS t FROM {supplier}", r"SELECT s_suppkey, regexp_replace(t, '^(?:Rule \| )+', '') AS rest FROM base")
def _(d):
    return d.select("s_suppkey", text.without_noise(F.col("t"), r"Rule \| ").alias("rest"))


@query("x16_without_header_lines", DOCS, r"SELECT doc_id, array_to_string(list_transform(list_filter(list_zip(string_split(text, chr(10)), range(len(string_split(text, chr(10))))), lambda x: x[2] >= 10 OR NOT regexp_matches(x[1], 'the|de')), lambda x: x[1]), chr(10)) AS body FROM base")
def _(d):
    return d.select("doc_id", text.without_header_lines(T(), "the|de").alias("body"))


@query("x17_from_anchor", DOCS, r"SELECT doc_id, CASE WHEN regexp_matches(text, '[Tt]he ') THEN substr(text, length(regexp_extract(text, '(?s)^(.*?)[Tt]he ', 1)) + 1) ELSE text END AS body FROM base")
def _(d):
    return d.select("doc_id", text.from_anchor(T(), "[Tt]he ").alias("body"))


@query("x18_before_tail", DOCS, r"SELECT doc_id, CASE WHEN regexp_matches(text, '[,;] the') AND length(regexp_extract(text, '(?s)^(.*?)[,;] the', 1)) > 200 THEN rtrim(regexp_extract(text, '(?s)^(.*?)[,;] the', 1)) ELSE text END AS body FROM base")
def _(d):
    return d.select("doc_id", text.before_tail(T(), "[,;] the").alias("body"))


@query("x19_body_and_notes", "SELECT s_suppkey, concat(s_name, ' body. NOTES: see ', s_suppkey) AS t FROM {supplier}", "SELECT s_suppkey, trim(split_part(t, 'NOTES:', 1)) AS body, 'NOTES: ' || trim(split_part(t, 'NOTES:', 2)) AS notes FROM base")
def _(d):
    return d.select("s_suppkey", text.body_and_notes(F.col("t"), "NOTES:").alias("x")).select("s_suppkey", "x.body", "x.notes")


@query("x20_source_block", "SELECT s_suppkey, concat(s_name, ' text. (Source: Added at ', s_suppkey % 40 + 1, ' Ill. Reg. ', s_suppkey, ', effective January 2, 1990; amended at 9 Ill. Reg. 77, effective March 4, ', 1990 + s_suppkey % 30, ')') AS t FROM {supplier}", "SELECT s_suppkey, s_name_body AS body, 'March 4, ' || (1990 + s_suppkey % 30) AS effective, (s_suppkey % 40 + 1) || ' Ill. Reg. ' || s_suppkey || '|9 Ill. Reg. 77' AS registers FROM (SELECT *, rtrim(split_part(t, '(Source:', 1)) AS s_name_body FROM base)")
def _(d):
    return d.select("s_suppkey", text.source_block(F.col("t")).alias("x")).select("s_suppkey", "x.body", "x.effective", F.array_join("x.registers", "|").alias("registers"))


@query("x21_heading_and_body", DOCS, r", l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS p FROM base), s AS (SELECT doc_id, p, least(coalesce(list_min(list_filter(list_transform(p, lambda x, i: CASE WHEN regexp_matches(x, '^\([a-z0-9]+\)') THEN i - 1 WHEN suffix(x, '.') THEN i END), lambda v: v IS NOT NULL)), 1), 8, len(p)) AS n FROM l)"
"\n--\n" "SELECT doc_id, array_to_string(p[1:n], ' ') AS heading, array_to_string(p[n + 1:], chr(10)) AS body FROM s")
def _(d):
    return d.select("doc_id", text.heading_and_body(T()).alias("x")).select("doc_id", "x.heading", "x.body")


@query("x22_heading_at_terminator", DOCS, r"SELECT doc_id, trim(left(text, cut), ' ') AS heading, trim(substr(text, cut + 1), ' ') AS body FROM (SELECT doc_id, text, CASE WHEN contains(left(text, 700), '.' || chr(10)) THEN position('.' || chr(10) IN text) + 1 ELSE coalesce(nullif(position('.' IN left(text, 200)), 0), least(length(text), 200)) END::INTEGER AS cut FROM base)")
def _(d):
    return d.select("doc_id", text.heading_at_terminator(T(), r"\.\n").alias("x")).select("doc_id", "x.heading", "x.body")


@query("x23_safe_id", DOCS, "SELECT doc_id, regexp_replace(substr(text, 1, 80), '[^A-Za-z0-9]+', '_', 'g') AS safe FROM base")
def _(d):
    return d.select("doc_id", text.safe_id(F.left(T(), F.lit(80))).alias("safe"))


@query("x24_act_slug", "SELECT s_suppkey, concat(' Act ', s_suppkey, ' of 19', 10 + s_suppkey % 89, ' (1st Ex. Sess.)') AS t FROM {supplier}", "SELECT s_suppkey, 'Act-' || s_suppkey || '-of-19' || (10 + s_suppkey % 89) || '-1st-Ex-Sess-' AS slug FROM base")
def _(d):
    return d.select("s_suppkey", text.act_slug(F.col("t")).alias("slug"))


@query("x25_word_count", DOCS, r"SELECT doc_id, len(regexp_extract_all(text, '\S+'))::INTEGER AS words, (length(text) // 4)::INTEGER AS tokens FROM base")
def _(d):
    return d.select("doc_id", text.word_count(T()).alias("words"), text.token_estimate(T()).alias("tokens"))


@query("x27_ruling_number", "SELECT s_suppkey, concat('AR  ', 80 + s_suppkey % 20, ' – ', s_suppkey, ' ( ', s_suppkey % 11 + 1, ' )') AS t FROM {supplier}", "SELECT s_suppkey, 'AR ' || (80 + s_suppkey % 20) || '-' || s_suppkey || '(' || (s_suppkey % 11 + 1) || ')' AS ruling FROM base")
def _(d):
    return d.select("s_suppkey", text.ruling_number(F.col("t")).alias("ruling"))


@query("x28_subject", "SELECT s_suppkey, concat('Part IV', chr(10), '12', chr(10), s_name, chr(10), chr(10), 'About  it', chr(10), 'Part III') AS t FROM {supplier}", r"SELECT s_suppkey, regexp_extract(t, '(?m)^(Supplier.*)$', 1) || ' About it' AS subject FROM base")
def _(d):
    return d.select("s_suppkey", text.subject(F.col("t")).alias("subject"))


@query("x29_first_present", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat(' ', c_name) END AS a, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS b FROM {customer}", "SELECT c_custkey, trim(coalesce(nullif(a, ''), nullif(b, ''), '')) AS v FROM base")
def _(d):
    return d.select("c_custkey", text.first_present(F.col("a"), F.col("b")).alias("v"))


@query("x30_joined_paragraphs", "SELECT conv_id, turn, text FROM {conversations}", "SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (text <> '') AS text FROM base GROUP BY conv_id")
def _(d):
    return d.groupBy("conv_id").agg(F.collect_list(F.struct(F.col("turn").alias("idx"), "text")).alias("p")).select("conv_id", text.joined_paragraphs(F.col("p")).alias("text"))


@query("x45_bare_numbers", "SELECT l_orderkey, l_linenumber, concat(lpad(concat('', l_linenumber), 3, '0'), '-', lpad(concat('', l_suppkey), 5, '0'), '.', l_returnflag) AS t FROM {lineitem}", r"SELECT l_orderkey, l_linenumber, regexp_replace(regexp_replace(replace(t, '.', '-'), '^0+', ''), '-0+(\d)', '-\1', 'g') AS bare FROM base")
def _(d):
    return d.select("l_orderkey", "l_linenumber", text.bare_numbers(F.col("t")).alias("bare"))


@query("x46_script_files", "SELECT s_suppkey, concat('var a=1; versionArr = [[''', s_suppkey, '.html'',1],[''b.html'',2],[''', s_suppkey, '.html'',3]]') AS js FROM {supplier}", "SELECT s_suppkey, s_suppkey || '.html|b.html' AS files FROM base")
def _(d):
    return d.select("s_suppkey", F.array_join(text.script_files(F.col("js")), "|").alias("files"))


@query("p32_title_case", "SELECT p_partkey, upper(concat(p_name, ' of the sub-part')) AS t FROM {part}", None)
def _(d):
    return d.select("p_partkey", text.title_case(F.col("t")).alias("title"))


@query("x31_iso_date", CREDITS, r"SELECT o_orderkey, regexp_extract(credit, '\b(?:Jan|Sep|Sept|Dec|Jul|July)[a-z.]*\s+\d{1,2},\s+(\d{4})', 1) || '-' || CASE month(o_orderdate) % 4 WHEN 0 THEN '12' WHEN 1 THEN '01' WHEN 2 THEN '09' ELSE '07' END || '-' || lpad(day(o_orderdate)::VARCHAR, 2, '0') AS iso FROM base")
def _(d):
    return d.select("o_orderkey", dates.iso_date(F.col("credit")).alias("iso"))


@query("x32_dashed_date", "SELECT o_orderkey, concat(month(o_orderdate), '/', day(o_orderdate), '/', substring(concat('', year(o_orderdate) + 20), 3, 2)) AS d, o_orderdate FROM {orders}", "SELECT o_orderkey, lpad(month(o_orderdate)::VARCHAR, 2, '0') || '-' || lpad(day(o_orderdate)::VARCHAR, 2, '0') || '-' || CASE WHEN right(d, 2)::INT > 30 THEN '19' ELSE '20' END || right(d, 2) AS date, (CASE WHEN right(d, 2)::INT > 30 THEN '19' ELSE '20' END || right(d, 2))::INTEGER AS year FROM base")
def _(d):
    return d.withColumn("date", dates.dashed_date(F.col("d"))).select("o_orderkey", "date", dates.trailing_year(F.col("date")).alias("year"))


@query("x33_slashed_dates", "SELECT o_orderkey, concat('1/2/49, ', month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate), '; ', day(o_orderdate) % 12 + 1, '/3/50') AS h, o_orderdate FROM {orders}", "SELECT o_orderkey, '01/02/2049|' || lpad(month(o_orderdate)::VARCHAR, 2, '0') || '/' || lpad(day(o_orderdate)::VARCHAR, 2, '0') || '/' || year(o_orderdate) || '|' || lpad((day(o_orderdate) % 12 + 1)::VARCHAR, 2, '0') || '/03/1950' AS dates, lpad((day(o_orderdate) % 12 + 1)::VARCHAR, 2, '0') || '/03/1950' AS last FROM base")
def _(d):
    return d.select("o_orderkey", F.array_join(dates.slashed_dates(F.col("h")), "|").alias("dates"), dates.last_date(F.col("h")).alias("last"))


@query("x35_clamped_year", "SELECT p_partkey, cast(1700 + p_size * 10 as int) AS y FROM {part}", "SELECT p_partkey, CASE WHEN y BETWEEN 1789 AND 2026 THEN y END AS year FROM base")
def _(d):
    return d.select("p_partkey", dates.clamped_year(F.col("y"), 2026).alias("year"))


@query("x36_month_days", "SELECT o_orderkey, cast(year(o_orderdate) as int) AS y, cast(month(o_orderdate) as int) AS m FROM {orders}", "SELECT o_orderkey, day(last_day(make_date(y, m, 1)))::INTEGER AS days FROM base")
def _(d):
    return d.select("o_orderkey", dates.month_days(F.col("y"), F.col("m")).alias("days"))


@query("x38_action_code", "SELECT s_suppkey, concat('[1-1-97; 1.2.3.4 NMAC - ', CASE s_suppkey % 4 WHEN 0 THEN 'Rn' WHEN 1 THEN 'N/E' WHEN 2 THEN 'a' ELSE 'Rp' END, ', 1.2 NMAC]') AS h FROM {supplier}", "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'RN' WHEN 1 THEN 'N/E' WHEN 2 THEN 'A' ELSE 'RP' END AS action FROM base")
def _(d):
    return d.select("s_suppkey", dates.action_code(F.col("h")).alias("action"))


@query("x39_roman", CREDITS, "SELECT o_orderkey, 'IV' AS roman FROM base")
def _(d):
    return d.select("o_orderkey", dates.roman(F.col("credit")).alias("roman"))


UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12)"


@query("x40_point_id", DOCS, f"SELECT doc_id, {UUID} AS point_id FROM (SELECT doc_id, md5('DOC_' || doc_id || '::0::' || CASE WHEN text = '' THEN 'nochunktext' ELSE substr(sha1(text), 1, 12) END) AS h FROM base)")
def _(d):
    return d.select("doc_id", ids.point_id(F.concat(F.lit("DOC_"), "doc_id"), F.lit(0), T()).alias("point_id"))


@query("x41_point_id_hashed", DOCS, f"SELECT doc_id, {UUID} AS point_id FROM (SELECT doc_id, md5('DOC_' || doc_id || '::0::' || substr(sha1(text), 1, 12)) AS h FROM base)")
def _(d):
    return d.select("doc_id", ids.point_id_hashed(F.concat(F.lit("DOC_"), "doc_id"), F.lit(0), T()).alias("point_id"))


@query("x42_point_id_long", DOCS, f"SELECT doc_id, {UUID} AS point_id, sha1(text) AS full_text_sha1 FROM (SELECT doc_id, text, md5('DOC_' || doc_id || '::0::' || sha1(text)) AS h FROM base)")
def _(d):
    return d.select("doc_id", ids.point_id_long(F.concat(F.lit("DOC_"), "doc_id"), F.lit(0), T()).alias("point_id"), ids.text_sha1(T()).alias("full_text_sha1"))


@query("x44_parent_chunk_id", DOCS, f"SELECT doc_id, {UUID} AS parent_chunk_id FROM (SELECT doc_id, md5('DOC_' || doc_id || '::-1::' || substr(sha1(text), 1, 12)) AS h FROM base)")
def _(d):
    return d.select("doc_id", ids.point_id(F.concat(F.lit("DOC_"), "doc_id"), F.lit(-1), T()).alias("parent_chunk_id"))


def NODE():  # noqa: N802
    return F.col("node_id")


@query("h01_node_parse", NODES, "SELECT s_suppkey, 'title:' || n_nationkey || '|chapter:' || (s_suppkey % 7) || '|section:' || s_suppkey AS pairs, true AS valid FROM base")
def _(d):
    return d.select("s_suppkey", F.array_join(F.transform(ids.pairs(NODE()), lambda p: F.concat_ws(":", p["classifier"], p["number"])), "|").alias("pairs"), ids.valid_levels(NODE()).alias("valid"))


@query("h02_levels", NODES, "SELECT s_suppkey, 'section' AS level, 'chapter' AS above, 'us/' || st || '/statutes/title=' || n_nationkey || '/chapter=' || (s_suppkey % 7) AS parent, 'us/' || st || '/statutes/title=' || n_nationkey AS title FROM base")
def _(d):
    return d.select("s_suppkey", ids.level(NODE())["classifier"].alias("level"), ids.level(NODE(), 2)["classifier"].alias("above"), ids.parent_id(NODE()).alias("parent"), ids.ancestor_at(NODE(), "title").alias("title"))


@query("h05_ancestors", "SELECT s_suppkey, concat(s_nationkey, '.', s_suppkey % 5, '.', s_suppkey) AS path FROM {supplier}", "SELECT s_suppkey, split_part(path, '.', 1) || '|' || split_part(path, '.', 1) || '.' || split_part(path, '.', 2) || '|' || path AS chain FROM base")
def _(d):
    return d.select("s_suppkey", F.array_join(ids.ancestors(F.col("path")), "|").alias("chain"))


@query("p04_act_id", NODES, "SELECT s_suppkey, 'STATE_' || upper(st) || '_T' || n_nationkey || '_C' || (s_suppkey % 7) || '_S' || s_suppkey AS act_id FROM base")
def _(d):
    return d.select("s_suppkey", ids.act_id(NODE(), F.col("st")).alias("act_id"))


@query("p05_section_number", NODES, "SELECT s_suppkey, s_suppkey::VARCHAR AS section_number, n_nationkey::INTEGER AS title_number FROM base")
def _(d):
    return d.select("s_suppkey", ids.section_number(NODE(), F.col("heading")).alias("section_number"), ids.title_number(NODE()).alias("title_number"))


@query("p07_breadcrumb", NODES, "SELECT s_suppkey, 'Title ' || n_nationkey || '|Chapter ' || (s_suppkey % 7) || '|Section ' || s_suppkey AS labels, r_name || ' Code / Title ' || n_nationkey || ' / Chapter ' || (s_suppkey % 7) || ' / Section ' || s_suppkey AS path FROM base")
def _(d):
    return d.select("s_suppkey", F.array_join(F.transform(ids.breadcrumb(NODE()), lambda b: b["label"]), "|").alias("labels"), ids.display_path(NODE(), F.col("r_name")).alias("path"))


@query("p09_embedding_prefix", NODES, "SELECT s_suppkey, 'Statute: ' || r_name || ' Code (2026) | US | ' || r_name || ' | In Force' || chr(10) || CASE WHEN third > 0 THEN 'Title ' || third || ' | ' ELSE '' END || 'Chapter ' || (s_suppkey % 7) || ' | Section ' || s_suppkey || ': ' || heading || chr(10) || chr(10) AS prefix FROM base")
def _(d):
    return d.select("s_suppkey", ids.embedding_prefix(F.col("r_name"), F.lit(2026), F.nullif("third", F.lit(0)), (F.col("s_suppkey") % 7).cast("string"), F.col("s_suppkey").cast("string"), F.col("heading")).alias("prefix"))


@query("p10_default_citation", NODES, "SELECT s_suppkey, CASE third WHEN 0 THEN upper(st) || '. Code § ' || s_suppkey WHEN 1 THEN '1 ' || upper(st) || '. Code § ' || s_suppkey ELSE heading END AS citation FROM base")
def _(d):
    return d.select("s_suppkey", ids.default_citation(F.when(F.col("third") == 2, F.col("heading")), F.col("st"), F.nullif("third", F.lit(0)), F.col("s_suppkey").cast("string")).alias("citation"))


@query("p11_chunk_header", NODES, "SELECT s_suppkey, CASE WHEN third = 0 THEN r_name || ' Constitution | art. ' || n_nationkey || ' | part 1 of 3' || chr(10) || heading || chr(10) || chr(10) ELSE r_name || ' Constitution | art. ' || n_nationkey || ' | part ' || (third + 1) || ' of 3 | ' || substr(heading, 1, 110) || chr(10) || chr(10) END AS header FROM base")
def _(d):
    return d.select("s_suppkey", ids.chunk_header(F.concat("r_name", F.lit(" Constitution")), F.concat(F.lit("art. "), "n_nationkey"), F.col("s_suppkey").cast("string"), F.col("heading"), F.col("third"), F.lit(3)).alias("header"))


@query("p12_citation_template", NODES, "SELECT s_suppkey, CASE WHEN third = 0 THEN 'Const. art. ' || n_nationkey || ' sec. ' || s_suppkey ELSE upper(substr(st, 1, 1)) || substr(st, 2) || '. Const. art. ' || n_nationkey || ', § ' || s_suppkey END AS citation FROM base")
def _(d):
    template = F.when(F.col("third") == 0, "Const. art. {art} sec. {sec}")
    return d.select("s_suppkey", ids.filled(template, F.col("n_nationkey").cast("string"), F.col("s_suppkey").cast("string"), F.col("st")).alias("citation"))


@query("p26_act_number", "SELECT s_suppkey, lpad(concat('', s_suppkey * 5 % 99999), 5, '0') AS code FROM {supplier}", "SELECT s_suppkey, (left(code, 4)::INT)::VARCHAR || CASE WHEN right(code, 1) = '0' THEN '' ELSE '.' || right(code, 1) END AS act FROM base")
def _(d):
    return d.select("s_suppkey", status.act_number(F.col("code")).alias("act"))


@query("p27_chapter_of_section", "SELECT l_orderkey, l_linenumber, concat(l_linenumber, '-', l_suppkey, '-', l_partkey) AS s FROM {lineitem}", "SELECT l_orderkey, l_linenumber, split_part(s, '-', 2) AS middle, split_part(s, '-', 1) AS lead FROM base")
def _(d):
    return d.select("l_orderkey", "l_linenumber", status.chapter_of_section(F.col("s")).alias("middle"), status.chapter_of_section(F.col("s"), "digits").alias("lead"))


@query("p28_granule", "SELECT s_suppkey, concat('USCODE-2024-title', s_nationkey, '-chap', s_suppkey % 90, 'A-subchapI-sec', s_suppkey) AS g FROM {supplier}", "SELECT s_suppkey, 2024 AS year, regexp_extract(g, 'title(\\d+)', 1)::INTEGER AS title_number, '' AS subtitle, (s_suppkey % 90) || 'A' AS chapter, 'I' AS subchapter, '' AS part, '' AS subpart, s_suppkey::VARCHAR AS section_number FROM base")
def _(d):
    return d.select("s_suppkey", status.granule(F.col("g")).alias("x")).select("s_suppkey", "x.*")


@query("p29_versioned_section", "SELECT s_suppkey, concat(s_nationkey, '-', s_suppkey % 9, '-2-1', CASE s_suppkey % 3 WHEN 0 THEN '-b' WHEN 1 THEN '' ELSE '-9' END) AS s FROM {supplier}", "SELECT s_suppkey, split_part(s, '-', 2) AS article, regexp_replace(s, '-b$', '') AS citation, s AS path, CASE WHEN s_suppkey % 3 = 0 THEN 'b' END AS version FROM base WHERE s_suppkey % 3 < 2")
def _(d):
    return d.select("s_suppkey", status.versioned_section(F.col("s")).alias("x")).where("x is not null").select("s_suppkey", "x.article", "x.citation", "x.path", "x.version")


@query("p30_label_parts", "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN concat('RS 14:', s_suppkey) WHEN 1 THEN concat('CC ', s_suppkey) WHEN 2 THEN 'RS 14' ELSE concat('ZZ ', s_suppkey) END AS s FROM {supplier}", "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'RS' ELSE 'CC' END AS body, CASE s_suppkey % 4 WHEN 0 THEN '14' ELSE '' END AS title, s_suppkey::VARCHAR AS number FROM base WHERE s_suppkey % 4 < 2")
def _(d):
    return d.select("s_suppkey", status.label_parts(F.col("s")).alias("x")).where("x is not null").select("s_suppkey", "x.body", "x.title", "x.number")


@query("p31_file_parts", "SELECT s_suppkey, concat(lpad(concat('', s_nationkey), 3, '0'), lpad(concat('', s_suppkey), 5, '0'), CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE '' END, lpad(concat('', s_suppkey * 10), 6, '0'), 'R.html') AS f FROM {supplier}", "SELECT s_suppkey, substr(f, 1, 3) AS title, substr(f, 4, 5) AS part, CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE '' END AS subpart, lpad((s_suppkey * 10)::VARCHAR, 6, '0') AS section FROM base")
def _(d):
    return d.select("s_suppkey", status.file_parts(F.col("f")).alias("x")).select("s_suppkey", "x.*")


@query("p33_spec_values", "SELECT s_suppkey, concat(2000 + s_suppkey % 5, '-', 2005 + s_suppkey % 3, ', 2024, x') AS spec FROM {supplier}", "SELECT s_suppkey, list_sum(range(2000 + s_suppkey % 5, 2006 + s_suppkey % 3))::BIGINT + 2024 AS total, (6 + s_suppkey % 3 - s_suppkey % 5 + 1)::INTEGER AS n FROM base")
def _(d):
    v = status.spec_values(F.col("spec"))
    return d.select("s_suppkey", F.aggregate(v, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"), F.size(v).alias("n"))


# Predicates and statuses.
HEADS = """SELECT doc_id, concat(CASE doc_id % 8 WHEN 0 THEN '[Repealed]' WHEN 1 THEN '12.5. [Repealed by Stats. 1999]' WHEN 2 THEN 'Repealed by L. 2004' WHEN 3 THEN '§ 7. Reserved. ' WHEN 4 THEN '(Repealed by L. 1990)' WHEN 5 THEN 'Shall be repealed. ' ELSE '' END, text) AS text FROM {documents}"""
HEAD_SQL = r"left(ltrim(regexp_replace(left(ltrim(text), 300), '\A[\d.\-:()§\s]+', '')), 300)"


@query("f03_repealed_head", HEADS, rf"SELECT doc_id, regexp_matches({HEAD_SQL}, '(?i)^\s*(?:\[Repealed[\]\s]|\(Repealed\s+by\b|Repealed\s*\.(?:\s|$)|Repealed\s+by\b)') AS repealed, regexp_matches({HEAD_SQL}, '(?i)^\s*(?:\[Reserved\]|Reserved\s*\.(?:\s|$))') AS reserved FROM base")
def _(d):
    return d.select("doc_id", status.is_repealed(T()).alias("repealed"), status.is_reserved(T()).alias("reserved"))


@query("e09_flipped_status", HEADS, rf"SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'expired' WHEN regexp_matches({HEAD_SQL}, '(?i)^\s*(?:\[Repealed[\]\s]|Repealed\s*\.(?:\s|$)|Repealed\s+by\b)') THEN 'repealed' WHEN regexp_matches({HEAD_SQL}, '(?i)^\s*(?:\[Reserved\]|Reserved\s*\.(?:\s|$))') THEN 'reserved' ELSE 'in_force' END AS act_status FROM base")
def _(d):
    return d.select("doc_id", status.flipped(F.when(F.col("doc_id") % 3 == 0, "expired").otherwise("in_force"), T()).alias("act_status"))


@query("f01_content_rows", DOCS, "SELECT doc_id, length(text)::INTEGER AS n FROM base WHERE length(text) >= 20")
def _(d):
    return d.where(F.length("text") >= 20).select("doc_id", F.length("text").alias("n"))


@query("f02_min_length", DOCS, "SELECT k, count(*) AS n FROM base, (VALUES (5), (10), (20), (25), (30), (40), (60), (100), (120)) v(k) WHERE length(text) >= k GROUP BY k")
def _(d):
    limits = F.array(*map(F.lit, (5, 10, 20, 25, 30, 40, 60, 100, 120)))
    return d.select(F.explode(F.filter(limits, lambda k: F.length("text") >= k)).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("f06_keywords", DOCS, "SELECT doc_id, contains(lower(text), 'reserved') OR contains(lower(text), 'repealed') AS hit FROM base")
def _(d):
    return d.select("doc_id", status.has_keyword(T(), ("reserved", "repealed")).alias("hit"))


@query("f07_first_keyword", DOCS, "SELECT doc_id, CASE WHEN contains(h, 'the') THEN 'the' WHEN contains(h, 'de') THEN 'de' ELSE 'in_force' END AS status FROM (SELECT doc_id, lower(source || ' ' || left(text, 120)) AS h FROM base)")
def _(d):
    return d.select("doc_id", status.first_keyword(F.col("source"), T(), ("the", "de")).alias("status"))


REASONS = "SELECT s_suppkey, CASE s_suppkey % 9 WHEN 0 THEN 'Repealed' WHEN 1 THEN 'Abolished' WHEN 2 THEN 'Not Fundeded' WHEN 3 THEN '' WHEN 4 THEN 'Expired, then omitted' WHEN 5 THEN 'Applicable 2027' WHEN 6 THEN 'Renumbered' WHEN 7 THEN 'Section  reserved ' ELSE 'Not applicable' END AS r FROM {supplier}"


@query("f08_status_of_reason", REASONS, "SELECT s_suppkey, CASE s_suppkey % 9 WHEN 0 THEN 'repealed' WHEN 1 THEN 'repealed' WHEN 2 THEN 'not_funded' WHEN 4 THEN 'expired' WHEN 6 THEN 'renumbered' WHEN 7 THEN 'reserved' WHEN 8 THEN 'not_applicable' ELSE 'in_force' END AS status FROM base")
def _(d):
    return d.select("s_suppkey", status.status_of_reason(F.col("r")).alias("status"))


@query("f09_status_of_entry", REASONS, "SELECT s_suppkey, CASE s_suppkey % 9 WHEN 0 THEN 'repealed' WHEN 7 THEN 'reserved' ELSE '' END AS status FROM base")
def _(d):
    return d.select("s_suppkey", status.status_of_entry(F.col("r")).alias("status"))


@query("f10_status_of_name", REASONS, "SELECT s_suppkey, CASE s_suppkey % 9 WHEN 0 THEN 'repealed' WHEN 7 THEN 'reserved' ELSE 'in_force' END AS status FROM base")
def _(d):
    return d.select("s_suppkey", status.status_of_name(F.col("r")).alias("status"))


@query("f11_capital_header", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN concat(upper(p_name), '.') WHEN 1 THEN concat(p_name, '.') WHEN 2 THEN concat(upper(p_name), '.... 7') ELSE 'RESERVED.' END AS t FROM {part}", "SELECT p_partkey FROM base WHERE t = upper(t) AND NOT contains(t, '....') AND t <> 'RESERVED.'")
def _(d):
    return d.where(status.is_capital_header(F.col("t"))).select("p_partkey")


@query("f12_history_lines", "SELECT p_partkey, concat(CASE p_size % 3 WHEN 0 THEN 'Added by ' WHEN 1 THEN 'added by ' ELSE 'Acts ' END, p_name) AS t FROM {part}", "SELECT p_partkey FROM base WHERE starts_with(t, 'Added by') OR starts_with(t, 'Acts ')")
def _(d):
    return d.where(status.is_history_line(F.col("t"))).select("p_partkey")


@query("f14_file_kind", "SELECT s_suppkey, concat('x/USCODE-2024-title', s_nationkey, CASE s_suppkey % 5 WHEN 0 THEN '-chap1-sec1.htm' WHEN 1 THEN '-chap1.htm' WHEN 2 THEN '-toc.htm' WHEN 3 THEN '.pdf' ELSE '-front.pdf' END) AS f, cast(s_acctbal as bigint) AS size FROM {supplier}", "SELECT CASE s_suppkey % 5 WHEN 0 THEN 'section' WHEN 1 THEN 'chapter' WHEN 2 THEN 'toc' WHEN 3 THEN 'title' ELSE 'front' END AS kind, count(*) AS files FROM base GROUP BY 1")
def _(d):
    return d.groupBy(status.file_kind(F.col("f")).alias("kind")).agg(F.count(F.lit(1)).alias("files"))


@query("f15_run_outcome", "SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'Timeout on connect' WHEN 1 THEN 'No module named x' WHEN 2 THEN '403 Forbidden' WHEN 3 THEN 'AttributeError' ELSE '' END AS err, cast(s_suppkey % 6 % 5 as int) AS code FROM {supplier}", "SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'timeout' WHEN 1 THEN 'import_error' WHEN 2 THEN 'http_403_blocked' WHEN 3 THEN 'selector_drift' WHEN 4 THEN 'other' ELSE 'no_content_nodes' END AS outcome FROM base")
def _(d):
    return d.select("s_suppkey", status.run_outcome(F.lit(""), F.col("err"), F.col("code"), F.lit(0)).alias("outcome"))


@query("f16_ruling_kind", DOCS, "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'Acquiescence Ruling' WHEN contains(left(lower(text), 2000), 'policy statement') THEN 'Policy Statement' ELSE 'Ruling' END AS kind FROM base")
def _(d):
    return d.select("doc_id", status.ruling_kind(T(), F.when(F.col("doc_id") % 5 == 0, "AR").otherwise("SSR")).alias("kind"))


@query("f18_coverage_gate", "SELECT source, count(*) AS section_count, count(DISTINCT lang) AS langs FROM {documents} GROUP BY source", "SELECT source, section_count FROM base WHERE section_count >= 50 AND langs > 1")
def _(d):
    return d.where((F.col("section_count") >= 50) & (F.col("langs") > 1)).select("source", "section_count")


@query("f21_magic_bytes", "SELECT page_id, html FROM {pages}", "SELECT page_id, page_id % 2 = 0 AS zip, page_id % 2 = 1 AS pdf FROM base")
def _(d):
    body = F.when(F.col("page_id") % 2 == 0, F.concat(F.unhex(F.lit("504B0304")), F.col("html").cast("binary"))).otherwise(F.concat(F.lit("%PDF-1").cast("binary"), F.col("html").cast("binary")))
    return d.select("page_id", status.looks_zip(body).alias("zip"), status.looks_pdf(body).alias("pdf"))


@query("f22_challenge_pages", PAGES, "SELECT page_id, contains(lower(html), 'just a moment') OR contains(lower(html), 'attention required') AS challenge FROM base")
def _(d):
    return d.select("page_id", status.is_challenge(F.col("html")).alias("challenge"))


@query("f25_path_like", NODES, "SELECT s_suppkey FROM base WHERE node_id ILIKE '%chapter=3%'")
def _(d):
    return d.where(NODE().ilike("%chapter=3%")).select("s_suppkey")


@query("f26_body_status", HEADS, "SELECT doc_id, CASE WHEN contains(left(text, 200), 'epealed by') THEN 'repealed' WHEN contains(left(text, 200), 'eserved') THEN 'reserved' ELSE 'in_force' END AS status FROM base")
def _(d):
    return d.select("doc_id", status.body_status(T(), (("epealed by", "repealed"), ("eserved", "reserved"))).alias("status"))


@query("f27_reserved_short", DOCS, "SELECT doc_id FROM base WHERE NOT (length(text) < 15 OR (doc_id % 4 = 0 AND length(text) < 300))")
def _(d):
    title = F.when(F.col("doc_id") % 4 == 0, "[Reserved]").otherwise("")
    return d.where(~((F.length("text") < 15) | (F.contains(title, F.lit("Reserved")) & (F.length("text") < 300)))).select("doc_id")
