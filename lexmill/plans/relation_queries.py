"""Queries over relations: citations, joins, aggregates, windows, sets, sorts, hierarchies, chunks, payloads."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexmill.functions import cites, dates, ids, text
from lexmill.operators import chunk, payload, rows, segment
from lexmill.plans.recipe import AUTHORITY, CREDITS, DOCS, NODES, PAGES, query
from lexmill.sources import markup, readers
from lexmill.streaming import ingest



def T():  # noqa: N802
    return F.col("text")

CITED = """SELECT doc_id, concat('(a) First see ', doc_id % 50 + 1, ' U.S.C. § ', doc_id % 9999 + 1, 'a, and ', doc_id % 40 + 1, ' C.F.R. § 12.', doc_id % 9, chr(10), '(b) second; Pub. L. 117-', doc_id % 200 + 1, chr(10), '(1) one', chr(10), '(', CASE doc_id % 3 WHEN 0 THEN 'i' WHEN 1 THEN 'ii' ELSE 'a' END, ') last. Amended ', 1900 + doc_id % 120, '; repealed effective in 2050. ') AS text, doc_id % 120 AS y FROM {documents}"""


@query("e02_subsections", CITED, "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'a|b|i' WHEN 1 THEN 'a|b|ii' ELSE 'a|b' END AS letters, (CASE doc_id % 3 WHEN 2 THEN 2 ELSE 3 END)::INTEGER AS n, (CASE doc_id % 3 WHEN 2 THEN 1 ELSE 2 END)::INTEGER AS numbered FROM base")
def _(d):
    return d.select("doc_id", F.array_join(cites.subsection_letters(T()), "|").alias("letters"), F.size(cites.subsection_letters(T())).alias("n"), cites.numbered_paragraphs(T()).alias("numbered"))


@query("e04_references", CITED, "SELECT doc_id, (doc_id % 50 + 1) || ':' || (doc_id % 9999 + 1) || 'a' AS usc, (doc_id % 40 + 1) || ':12.' || (doc_id % 9) AS cfr, 'Pub. L. 117-' || (doc_id % 200 + 1) AS laws FROM base")
def _(d):
    return d.select("doc_id", F.array_join(cites.usc_references(T()), "|").alias("usc"), F.array_join(cites.cfr_references(T()), "|").alias("cfr"), F.array_join(cites.public_laws(T()), "|").alias("laws"))


@query("e07_amendment_years", CITED, "SELECT doc_id, (1900 + y)::VARCHAR AS years, (1900 + y)::INTEGER AS last FROM base")
def _(d):
    years = cites.amendment_years(T(), F.lit(2026))
    return d.select("doc_id", F.array_join(years, "|").alias("years"), F.array_max(years).alias("last"))


@query("e01_enrich", CITED, "SELECT doc_id, (CASE doc_id % 3 WHEN 2 THEN 2 ELSE 3 END)::INTEGER AS subsection_count, 2 AS cross_references_count, 1 AS public_laws_count, 2 AS amendments_count, 2050 AS last_amended_year FROM base")
def _(d):
    return d.select("doc_id", cites.enriched(T()).alias("e")).select("doc_id", "e.subsection_count", "e.cross_references_count", "e.public_laws_count", "e.amendments_count", "e.last_amended_year")


@query("e10_constitution_years", "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'md' WHEN 1 THEN 'tx' WHEN 2 THEN 'wi' ELSE 'zz' END AS st, concat('ratified Nov. 7, ', 1950 + s_suppkey % 40, '; ratified Nov. 2, 2010. (Feb. 15, 1876. Amended Nov. 5, 1918.) [As amended Apr. ', 1950 + s_suppkey % 40, ']') AS t FROM {supplier}", "SELECT s_suppkey, (CASE s_suppkey % 4 WHEN 0 THEN 2 WHEN 3 THEN 0 ELSE 1 END)::INTEGER AS events, CASE s_suppkey % 4 WHEN 0 THEN (1950 + s_suppkey % 40) || '|2010' WHEN 1 THEN '1918' WHEN 2 THEN (1950 + s_suppkey % 40)::VARCHAR ELSE '' END AS years, (CASE s_suppkey % 4 WHEN 0 THEN 2010 WHEN 1 THEN 1918 WHEN 2 THEN 1950 + s_suppkey % 40 END)::INTEGER AS last FROM base")
def _(d):
    x = cites.amendment_summary(F.col("t"), F.col("st"))
    return d.select("s_suppkey", x.alias("x")).select("s_suppkey", "x.events", F.array_join("x.years", "|").alias("years"), "x.last")


@query("e11_guidance_links", "SELECT s_suppkey, concat('Modifies Rev. Proc. 2020-', s_suppkey, ' and supersedes Notice 2019-', s_suppkey % 7, '; clarifies Rev. Rul. 99-1.') AS t, concat('Notice 2019-', s_suppkey % 14) AS own FROM {supplier}", "SELECT s_suppkey, 'Rev. Proc. 2020-' || s_suppkey AS modifies, CASE WHEN s_suppkey % 7 = s_suppkey % 14 THEN '' ELSE 'Notice 2019-' || (s_suppkey % 7) END AS supersedes, 'Rev. Rul. 99-1' AS clarifies FROM base")
def _(d):
    links = cites.guidance_links(F.col("t"), F.col("own"))
    return d.select("s_suppkey", *[F.array_join(links[v], "|").alias(v) for v in ("modifies", "supersedes", "clarifies")])


@query("e12_ruling_references", "SELECT s_suppkey, concat('AR 92-', s_suppkey, '(9) and SSR 82-', s_suppkey, ' under 20 CFR 404.', s_suppkey, ', 42 U.S.C. 423') AS t FROM {supplier}", "SELECT s_suppkey, 'SSR 82-' || s_suppkey || '|AR 92-' || s_suppkey || '(9)' AS rulings, '404.' || s_suppkey AS regulations, '423' AS statutes FROM base")
def _(d):
    return d.select("s_suppkey", cites.ruling_references(F.col("t")).alias("x")).select("s_suppkey", *[F.array_join(f"x.{n}", "|").alias(n) for n in ("rulings", "regulations", "statutes")])


@query("x37_enumerate", "SELECT s_suppkey, concat(s_suppkey, ', ', s_suppkey + 5, '-', s_suppkey + 5 + s_suppkey % 4, ' and 1-100, 5-3') AS t FROM {supplier}", "SELECT s_suppkey, s_suppkey || '|' || array_to_string(range(s_suppkey + 5, s_suppkey + 6 + s_suppkey % 4), '|') || '|1-100' AS sections FROM base")
def _(d):
    return d.select("s_suppkey", F.array_join(cites.enumerated(F.col("t")), "|").alias("sections"))


@query("t06_source_credit", CREDITS, "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'public_law|revised_statutes|other' ELSE 'public_law|act|other' END AS types, regexp_extract(credit, 'Pub. L. (\\d+)-', 1)::INTEGER AS congress, regexp_extract(credit, 'Pub. L. \\d+-(\\d+)', 1)::INTEGER AS law, 'IV' AS title_roman, regexp_extract(credit, '§(\\d+)\\(a\\)', 1) || '(a)' AS section, regexp_extract(credit, '(\\d+) Stat', 1)::INTEGER AS stat_volume FROM base")
def _(d):
    return d.withColumn("c", cites.source_credit(F.col("credit"))).withColumn("p", F.get("c", F.lit(0))).select("o_orderkey", F.array_join(F.transform("c", lambda x: x["type"]), "|").alias("types"), "p.congress", "p.law", "p.title_roman", "p.section", "p.stat_volume")


@query("t07_authority", "SELECT s_suppkey, concat('44 U.S.C. ', s_suppkey, ', ', s_suppkey + 1, '; E.O. 10530, 19 FR 2709, 3 CFR, 1954-1958 Comp., p. 189; 44 U.S.C. ', s_suppkey) AS t FROM {supplier}")
def _(d):
    return d.select("s_suppkey", F.array_join(F.transform(cites.authority(F.col("t")), lambda c: c["display"]), "|").alias("displays"))


HISTORIES = "SELECT s_suppkey, concat('Statutory Authority: RCW 43.20.050. WSR 91-02-051 (Order 124B), filed 12/27/90, effective 1/31/', s_suppkey % 90 + 10, '; WSR 87-11-047 (Order 302), effective 5/19/87.') AS wa, concat(s_suppkey, ' SR 1419; ', s_suppkey, ' SR 1419; L 2008 c 328 s 13') AS mn, concat('Derived from VR630-1-8, eff. January 1, 1985; amended, Virginia Register Volume ', s_suppkey, ', Issue 11, eff. March 4, 2009.') AS va FROM {supplier}"


@query("t11_histories", HISTORIES, "SELECT s_suppkey, 'RCW 43.20.050' AS authority, '1/31/' || (s_suppkey % 90 + 10) AS effective, '5/19/87' AS prior, '124B|302' AS orders, s_suppkey || ' SR 1419' AS registers, 'March 4, 2009' AS va_effective, 'January 1, 1985' AS va_prior, 'VR630-1-8' AS derived FROM base")
def _(d):
    d = d.select("s_suppkey", cites.washington_history(F.col("wa")).alias("w"), cites.minnesota_history(F.col("mn")).alias("m"), cites.virginia_history(F.col("va")).alias("v"))
    return d.select("s_suppkey", "w.authority", "w.effective", "w.prior", F.array_join("w.orders", "|").alias("orders"), F.array_join("m.registers", "|").alias("registers"), F.col("v.effective").alias("va_effective"), F.col("v.prior").alias("va_prior"), "v.derived")


# Cross-linking: the flagship, from authority strings to the regulations of each section.
def usc_cites(d):
    parts = d.select("cfr_title", "part", "part_name", "authority").distinct()  # the sections of a part repeat its authority
    return parts.select(F.explode(cites.usc_keys(F.col("authority"))).alias("usc_key"), "cfr_title", "part", "part_name")


@query("a01_reverse_index", AUTHORITY, "SELECT concat(l_linenumber, ':', split_part(authority, 'U.S.C. ', 2)) AS usc_key, count(DISTINCT (cfr_title, part, part_name))::INTEGER AS n, min((cfr_title, part))[2] AS first_part FROM base GROUP BY 1")
def _(d):
    index = rows.reverse_index(usc_cites(d), "usc_key", "cfr_title", "part", "part_name")
    return index.select("usc_key", F.size("sources").alias("n"), F.get("sources", F.lit(0))["part"].alias("first_part"))


@query("j01_implementing_regulations", AUTHORITY, ", idx AS (SELECT concat(l_linenumber, ':', split_part(authority, 'U.S.C. ', 2)) AS usc_key, count(DISTINCT (cfr_title, part, part_name)) AS n FROM base GROUP BY 1)\n--\nSELECT usc_key, coalesce(n, 0)::INTEGER AS implementing_regulations_count FROM (SELECT DISTINCT concat(l_linenumber % 9, ':', l_orderkey) AS usc_key FROM base) LEFT JOIN idx USING (usc_key)")
def _(d):
    index = rows.reverse_index(usc_cites(d), "usc_key", "cfr_title", "part", "part_name")
    sections = d.select(F.concat_ws(":", (F.col("l_linenumber") % 9).cast("string"), F.col("l_orderkey").cast("string")).alias("usc_key")).distinct()
    return sections.join(index, "usc_key", "left").select("usc_key", F.coalesce(F.size("sources"), F.lit(0)).cast("int").alias("n")).select("usc_key", F.greatest("n", F.lit(0)).alias("implementing_regulations_count"))


@query("j02_metadata_bodies", "SELECT o_orderkey, o_custkey, o_orderdate, l_orderkey, l_linenumber FROM {orders} LEFT JOIN (SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM {lineitem} WHERE l_linenumber < 3 GROUP BY l_orderkey) ON o_orderkey = l_orderkey", "SELECT o_orderkey, l_linenumber IS NULL AS missing FROM base")
def _(d):
    meta, bodies = d.select("o_orderkey"), d.where("l_orderkey is not null").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber").distinct()
    return meta.join(bodies, "o_orderkey", "left").select("o_orderkey", F.col("l_linenumber").isNull().alias("missing"))


@query("j03_toc_chain", "SELECT s_suppkey, concat('c', s_nationkey % 3) AS code, concat(s_nationkey, '.', s_suppkey % 5) AS path FROM {supplier}", ", toc AS (SELECT DISTINCT code, path, min(s_suppkey) OVER (PARTITION BY code, path) AS node FROM base WHERE s_suppkey % 2 = 0)\n--\nSELECT s_suppkey, coalesce(node, -1) AS node FROM base LEFT JOIN toc USING (code, path)")
def _(d):
    toc = d.where("s_suppkey % 2 = 0").groupBy("code", "path").agg(F.min("s_suppkey").alias("node"))
    return d.join(toc, ["code", "path"], "left").select("s_suppkey", F.coalesce("node", F.lit(-1).cast("bigint")).alias("node"))


@query("j06_fallback_key", "SELECT c_custkey, c_nationkey, n_nationkey, n_name FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey", ", n AS (SELECT DISTINCT n_nationkey, n_name FROM base WHERE n_nationkey % 2 = 0)\n--\nSELECT c_custkey, coalesce(a.n_name, b.n_name, '') AS bulletin FROM base d LEFT JOIN n a ON d.c_nationkey = a.n_nationkey LEFT JOIN n b ON d.c_custkey % 40 = b.n_nationkey")
def _(d):
    n = d.where("n_nationkey % 2 = 0").select("n_nationkey", "n_name").distinct()
    first, second = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("a")), n.select(F.col("n_nationkey").alias("alt"), F.col("n_name").alias("b"))
    rows_ = d.select("c_custkey", "c_nationkey", (F.col("c_custkey") % 40).alias("alt"))
    return rows_.join(first, "c_nationkey", "left").join(second, "alt", "left").select("c_custkey", F.coalesce("a", "b", F.lit("")).alias("bulletin"))


@query("j07_resume_anti", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM {orders}", "SELECT o_orderkey FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM base WHERE o_orderstatus = 'F')")
def _(d):
    return rows.resume(d, d.where("o_orderstatus = 'F'"), "o_orderkey").select("o_orderkey")


@query("j09_known_bodies", "SELECT c_custkey, c_mktsegment FROM {customer}", "SELECT c_custkey FROM base WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def _(d):
    known = d.sparkSession.createDataFrame([("BUILDING",), ("MACHINERY",)], "c_mktsegment string")
    return d.join(F.broadcast(known), "c_mktsegment", "left_semi").select("c_custkey")


@query("j10_asof_label", "SELECT event_id, ts, user_id, event_type, value FROM {events}", ", labels2 AS (SELECT user_id, ts, max(event_id) AS label FROM base WHERE event_type = 'purchase' GROUP BY user_id, ts)\n--\nSELECT e.event_id, l.label FROM base e ASOF LEFT JOIN labels2 l ON e.user_id = l.user_id AND e.ts >= l.ts")
def _(d):
    labels = d.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("event_id").alias("label"))
    return rows.as_of(d, labels, ["user_id"], "ts", "label").select("event_id", "label")


@query("j13_term_join", "SELECT d.doc_id, d.text, b.item_id, b.term FROM {documents} d LEFT JOIN (SELECT item_id, lower(substring(text, 1, strpos(text, ' ') - 1)) AS term FROM {benchmark}) b ON d.doc_id = b.item_id".replace("strpos(text, ' ')", "position(' ' in text)"), r", t AS (SELECT DISTINCT term FROM base WHERE regexp_full_match(term, '[a-z]+')), w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS term FROM base)" + "\n--\nSELECT term, count(*) AS docs FROM w JOIN t USING (term) GROUP BY term")
def _(d):
    terms = d.select("term").where(F.col("term").rlike("^[a-z]+$")).distinct()
    tokens = d.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower(T()), F.lit("[a-z]+"), F.lit(0)))).alias("term"))
    return tokens.join(terms, "term").groupBy("term").agg(F.count(F.lit(1)).alias("docs"))


@query("f24_terms_in_text", "SELECT doc_id, text, lang FROM {documents}", "SELECT term, count(*) AS docs FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '\\w+')) AS term FROM base) WHERE term IN ('the', 'de', 'und') GROUP BY term")
def _(d):
    terms = d.sparkSession.createDataFrame([("the",), ("de",), ("und",)], "term string")
    return rows.terms_in(d, terms, "doc_id", "text", "term").groupBy("term").agg(F.count(F.lit(1)).alias("docs"))


@query("j14_ancestor_hubs", NODES, "SELECT s_suppkey, count(*)::BIGINT AS hubs FROM base JOIN (SELECT DISTINCT 'us/' || st || '/statutes/title=' || n_nationkey AS hub FROM base WHERE third = 0) h ON starts_with(node_id, hub || '/') GROUP BY 1")
def _(d):
    hubs = d.where("third = 0").select(ids.ancestor_at(F.col("node_id"), "title").alias("hub")).distinct()
    paths = d.select("s_suppkey", F.explode(ids.ancestors(F.col("node_id"), "/", "/")).alias("hub"))
    return paths.join(hubs, "hub").groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("hubs"))


# Aggregation, deduplication, upserts.
VERSIONED = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat(l_returnflag, repeat('x', l_suppkey % 7)) AS body, l_shipdate FROM {lineitem}"


@query("a02_merged_versions", VERSIONED, "SELECT l_partkey, CASE WHEN count(*) > 1 THEN string_agg('[' || l_orderkey || ']' || chr(10) || body, chr(10) || chr(10) ORDER BY l_orderkey, l_linenumber, body) ELSE min(body) END AS text FROM base GROUP BY 1")
def _(d):
    d = d.withColumns({"v": F.struct("l_orderkey", "l_linenumber"), "note": F.col("l_orderkey").cast("string")})
    return rows.merged_versions(d, "l_partkey", "v", "body", "note")


@query("a03_keep_longest", VERSIONED, "SELECT l_partkey, l_orderkey, l_linenumber, body FROM base QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY length(body) DESC, l_orderkey, l_linenumber) = 1")
def _(d):
    return rows.keep_longest(d.withColumn("pos", F.struct("l_orderkey", "l_linenumber")), ["l_partkey"], "body", "pos").select("l_partkey", "l_orderkey", "l_linenumber", "body")


@query("a04_keep_longest_entry", VERSIONED, "SELECT l_partkey, l_orderkey, l_linenumber FROM base QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY starts_with(body, 'N'), length(body) DESC, l_orderkey, l_linenumber) = 1")
def _(d):
    return rows.keep_longest_entry(d.withColumn("pos", F.struct("l_orderkey", "l_linenumber")), ["l_partkey"], F.startswith("body", F.lit("N")), "body", "pos").select("l_partkey", "l_orderkey", "l_linenumber")


@query("a05_keep_last", "SELECT user_id, event_id, event_type FROM {events}", "SELECT user_id, event_type, max(event_id) AS event_id FROM base GROUP BY 1, 2")
def _(d):
    return rows.keep_last(d, ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


@query("a06_keep_first", DOCS, "SELECT doc_id, source FROM base QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1")
def _(d):
    return rows.keep_first(d.withColumn("h", F.md5(T().cast("binary"))).drop("text"), ["h"], "doc_id").select("doc_id", "source")


@query("a08_ordered_distinct", "SELECT s_suppkey, concat(s_nationkey % 3, ',', s_nationkey % 2, ',', s_nationkey % 3) AS l FROM {supplier}", "SELECT s_suppkey, CASE WHEN s_a = s_b THEN s_a ELSE s_a || ',' || s_b END AS l FROM (SELECT s_suppkey, split_part(l, ',', 1) AS s_a, split_part(l, ',', 2) AS s_b FROM base)")
def _(d):
    return d.select("s_suppkey", F.array_join(F.array_distinct(F.split("l", ",")), ",").alias("l"))


@query("a09_sorted_capped", DOCS, r"SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[A-Z][a-z]+')))[1:20], '|') AS names FROM base")
def _(d):
    return d.select("doc_id", F.array_join(cites.sorted_distinct(text.extract_all(T(), "[A-Z][a-z]+"), 20), "|").alias("names"))


@query("a10_numbered_repeats", "SELECT l_orderkey, l_linenumber, concat('', l_suppkey % 3) AS num FROM {lineitem}", "SELECT l_orderkey, l_linenumber, num || CASE WHEN k > 1 THEN '-v' || k ELSE '' END AS num2 FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, num ORDER BY l_linenumber) AS k FROM base)")
def _(d):
    return rows.numbered_repeats(d, ["l_orderkey"], "num", "l_linenumber", "num2").select("l_orderkey", "l_linenumber", "num2")


@query("a12_copy_number", "SELECT s_suppkey, concat('p', CASE WHEN s_suppkey % 2 = 0 THEN concat('-copy-', s_suppkey) ELSE '' END) AS id FROM {supplier}", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'p-copy-' || (s_suppkey + 1) ELSE 'p-copy-1' END AS id FROM base")
def _(d):
    n = text.extract(F.col("id"), r"-copy-(\d+)$").cast("bigint")
    return d.select("s_suppkey", F.concat(F.regexp_replace("id", r"-copy-\d+$", ""), F.lit("-copy-"), (F.coalesce(n, F.lit(0)) + 1).cast("string")).alias("id"))


@query("a13_merged_maps", "SELECT s_suppkey, s_nationkey FROM {supplier}", "SELECT s_suppkey, 'R' AS a, 'L' AS b, s_nationkey::VARCHAR AS c FROM base")
def _(d):
    left, right = F.create_map(F.lit("a"), F.lit("L"), F.lit("b"), F.lit("L")), F.create_map(F.lit("a"), F.lit("R"), F.lit("c"), F.col("s_nationkey").cast("string"))
    own = F.map_filter(left, lambda k, _: ~F.array_contains(F.map_keys(right), k))
    merged = F.map_concat(own, right)
    return d.select("s_suppkey", *[F.element_at(merged, F.lit(k)).alias(k) for k in "abc"])


@query("a14_outcome_counts", "SELECT event_type, user_id FROM {events}", "SELECT event_type, count(*) AS n FROM base GROUP BY 1")
def _(d):
    return d.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("a16_class_counts", "SELECT l_returnflag, l_linestatus, cast(l_quantity as bigint) AS q FROM {lineitem}", "SELECT l_returnflag, l_linestatus, count(*) AS files, sum(q)::BIGINT AS bytes FROM base GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def _(d):
    return d.rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("files"), F.sum("q").alias("bytes"))


@query("a17_by_date", "SELECT o_orderkey, cast(o_orderdate as date) AS d FROM {orders}", "SELECT d, count(*) AS n FROM base WHERE d IS NOT NULL GROUP BY d")
def _(d):
    return d.where("d is not null").groupBy("d").agg(F.count(F.lit(1)).alias("n"))


@query("a19_brute_extend", "SELECT DISTINCT s_nationkey AS title, s_suppkey % 4 AS chapter, s_suppkey % 9 AS part FROM {supplier}", ", m AS (SELECT title, chapter, max(part) AS top FROM base GROUP BY 1, 2)\n--\nSELECT title, chapter, p AS part FROM (SELECT title, chapter, unnest(range(1, top + 6)) AS p FROM m) WHERE (title, chapter, p) NOT IN (SELECT title, chapter, part FROM base)")
def _(d):
    top = d.groupBy("title", "chapter").agg(F.max("part").alias("top"))
    return top.select("title", "chapter", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("top") + 5)).alias("part")).join(d, ["title", "chapter", "part"], "left_anti")


@query("a20_children", NODES, "SELECT 'us/' || st || '/statutes/title=' || n_nationkey || '/chapter=' || (s_suppkey % 7) AS node, count(*)::INTEGER AS n, min(node_id) AS first FROM base GROUP BY 1")
def _(d):
    c = rows.children(d.withColumn("parent", ids.parent_id(F.col("node_id"))), "node_id", "parent")
    return c.select("node", F.size("children").alias("n"), F.get("children", F.lit(0)).alias("first"))


@query("a21_latest_date", "SELECT o_custkey, o_orderkey, o_orderdate FROM {orders}", "SELECT o_custkey, strftime(max(o_orderdate), '%B %-d, %Y') AS latest FROM base GROUP BY 1")
def _(d):
    named = d.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "MMMM d, yyyy").alias("s"))
    listed = named.groupBy("o_custkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", "s"))), lambda x: x["s"]).alias("l"))
    return listed.select("o_custkey", dates.latest_named(F.col("l")).alias("latest"))


@query("a22_sections_by_source", DOCS, "SELECT source, count(DISTINCT doc_id) AS sections FROM base GROUP BY source")
def _(d):
    return d.groupBy("source").agg(F.countDistinct("doc_id").alias("sections"))


ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM {orders}"


@query("k03_upsert", ORDERS, "SELECT o_orderkey, o_orderstatus AS v FROM base WHERE o_orderstatus <> 'O' UNION ALL SELECT o_orderkey, 'new' FROM base WHERE o_orderstatus = 'O' AND o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_orderstatus FROM base WHERE o_orderstatus = 'O' AND o_orderkey % 2 = 1")
def _(d):
    target = d.select("o_orderkey", F.col("o_orderstatus").alias("v")).unionByName(d.limit(1).select(F.lit(None).cast("bigint").alias("o_orderkey"), F.lit("lost").alias("v")))
    new = d.where("o_orderstatus = 'O' and o_orderkey % 2 = 0").select("o_orderkey", F.lit("new").alias("v"))
    return rows.upsert(target, new, "o_orderkey")


@query("k04_group_replace", "SELECT l_orderkey, l_linenumber, l_partkey FROM {lineitem}", "SELECT l_orderkey, l_linenumber, false AS fresh FROM base WHERE l_orderkey % 3 > 0 UNION ALL SELECT DISTINCT l_orderkey, 1, true FROM base WHERE l_orderkey % 3 = 0")
def _(d):
    target = d.select("l_orderkey", "l_linenumber", F.lit(False).alias("fresh"))
    return rows.upsert(target, d.where("l_orderkey % 3 = 0").select("l_orderkey", F.lit(1).alias("l_linenumber"), F.lit(True).alias("fresh")).distinct(), "l_orderkey")


@query("k06_last_wins", "SELECT event_id, user_id, value FROM {events}", "SELECT user_id, max(event_id) AS event_id, count(*) > 0 AS fresh FROM base GROUP BY 1")
def _(d):
    return rows.keep_last(d, ["user_id"], "event_id").select("user_id", "event_id", F.lit(True).alias("fresh"))


@query("g08_reconcile", "SELECT l_orderkey, l_linenumber, concat(l_orderkey, '-', l_linenumber) AS point_id FROM {lineitem}", "SELECT point_id FROM base WHERE l_orderkey % 2 = 0 AND l_linenumber > 2 AND l_orderkey IN (SELECT l_orderkey FROM base WHERE l_linenumber <= 2)")
def _(d):
    run = d.where("l_orderkey % 2 = 0 and l_linenumber <= 2")
    return rows.reconcile(d, run, "l_orderkey", "point_id").select("point_id")


# Windows.
LINES = "SELECT doc_id, text FROM {documents}"


def numbered_lines(d):
    return d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


NUMBERED = ", lines AS (SELECT doc_id, unnest(range(len(l)))::INTEGER AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM base))\n--\n"


@query("w01_forward_fill", "SELECT user_id, event_id, event_type FROM {events}", "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS current FROM base")
def _(d):
    return rows.forward_fill(d.withColumn("x", F.when(F.col("event_type") == "purchase", F.col("event_id"))), ["user_id"], "event_id", "x", "current").select("event_id", "current")


@query("w02_islands", LINES, NUMBERED + "SELECT doc_id, island, string_agg(line, ' ' ORDER BY pos) AS text FROM (SELECT *, sum(CASE WHEN starts_with(line, 'T') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS island FROM lines) WHERE island > 0 GROUP BY 1, 2")
def _(d):
    i = rows.islands(numbered_lines(d), ["doc_id"], "pos", F.startswith("line", F.lit("T"))).where("island > 0")
    return i.groupBy("doc_id", "island").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), " ").alias("text"))


@query("w03_header_slices", LINES, NUMBERED + "SELECT doc_id, pos, next AS until FROM (SELECT *, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos), -1) AS next FROM lines WHERE starts_with(line, 'T'))")
def _(d):
    heads = numbered_lines(d).where(F.startswith("line", F.lit("T")))
    return heads.select("doc_id", "pos", F.coalesce(F.lead("pos").over(Window.partitionBy("doc_id").orderBy("pos")), F.lit(-1)).alias("until"))


@query("w04_current_prior", "SELECT o_custkey, o_orderkey, o_orderdate FROM {orders}", "SELECT o_custkey, l[-1] AS current, l[1] AS oldest, array_to_string(l[1:-2], '; ') AS prior FROM (SELECT o_custkey, list(strftime(o_orderdate, '%m/%d/%Y') ORDER BY o_orderkey) AS l FROM base GROUP BY 1)")
def _(d):
    l = d.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("s")).groupBy("o_custkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", "s"))), lambda x: x["s"]).alias("l"))  # noqa: E741
    last, first = dates.current_and_prior(F.col("l")), dates.current_and_prior(F.col("l"), "first")
    return l.select("o_custkey", last["current"].alias("current"), first["current"].alias("oldest"), F.array_join(last["prior"], "; ").alias("prior"))


@query("w05_miss_run", "SELECT l_suppkey, l_orderkey, max(l_quantity) AS l_quantity FROM {lineitem} GROUP BY l_suppkey, l_orderkey", "SELECT l_suppkey, l_orderkey, l_orderkey - coalesce(max(CASE WHEN l_quantity > 25 THEN l_orderkey END) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) <= 200 AS probed FROM base")
def _(d):
    return rows.until_misses(d, ["l_suppkey"], "l_orderkey", F.col("l_quantity") > 25, 200).select("l_suppkey", "l_orderkey", "probed")


@query("w06_trusted_rows", "SELECT l_orderkey, l_linenumber FROM {lineitem}", "SELECT l_orderkey, l_linenumber FROM base QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) > 1 OR l_linenumber = 4")
def _(d):
    return rows.trusted(d, ["l_orderkey"], "l_linenumber", F.col("l_linenumber") == 4)


@query("w07_glued_labels", "SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 3 = 0 THEN '(a)' ELSE concat('text ', l_partkey) END AS t FROM {lineitem}")
def _(d):
    return rows.glued(d, ["l_orderkey"], "l_linenumber", "t", F.col("t") == "(a)").select("l_orderkey", "l_linenumber", "t")


@query("w08_dewrapped", LINES, NUMBERED + r"SELECT doc_id, island AS para, string_agg(trim(line), ' ' ORDER BY pos) AS text FROM (SELECT *, sum(CASE WHEN pos = 0 OR regexp_matches(trim(line), '^[A-D]') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS island FROM lines) WHERE trim(line) <> '' GROUP BY 1, 2")
def _(d):
    return rows.dewrapped(numbered_lines(d), ["doc_id"], "pos", "line", "^[A-D]")


@query("w09_footers", LINES, NUMBERED + "SELECT doc_id, count(*) AS kept FROM (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY pos) AS prev FROM lines) WHERE NOT starts_with(line, 'A') AND NOT coalesce(starts_with(prev, 'A'), false) GROUP BY 1")
def _(d):
    prev = F.lag("line").over(Window.partitionBy("doc_id").orderBy("pos"))
    lines = numbered_lines(d).withColumn("prev", prev).where(~F.startswith("line", F.lit("A")) & ~F.coalesce(F.startswith("prev", F.lit("A")), F.lit(False)))
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("kept"))


@query("w10_second_occurrence", DOCS, "SELECT doc_id, CASE WHEN len(string_split(text, 'the ')) > 2 THEN substr(text, length(split_part(text, 'the ', 1)) + 5 + length(split_part(text, 'the ', 2))) WHEN contains(text, 'the ') THEN substr(text, length(split_part(text, 'the ', 1)) + 1) ELSE text END AS tail FROM base")
def _(d):
    return d.select("doc_id", segment.second_occurrence(T(), "the ").alias("tail"))


@query("w11_sentences", DOCS, r", f AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: regexp_matches(s, '\bthe\b')) AS f FROM base)"
"\n--\n" "SELECT doc_id, array_to_string(list_filter(f, lambda x, i: list_position(f, x) = i), '|') AS sentences FROM f")
def _(d):
    return d.select("doc_id", F.array_join(segment.sentences_with(T(), r"\bthe\b"), "|").alias("sentences"))


@query("w13_title_groups", LINES, NUMBERED + "SELECT doc_id, island, count(*) - 1 AS members FROM (SELECT *, sum(CASE WHEN length(line) < 60 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS island FROM lines) WHERE island > 0 GROUP BY 1, 2")
def _(d):
    i = rows.islands(numbered_lines(d), ["doc_id"], "pos", F.length("line") < 60).where("island > 0")
    return i.groupBy("doc_id", "island").agg((F.count(F.lit(1)) - 1).alias("members"))


@query("w14_first_real_header", LINES, NUMBERED + "SELECT doc_id, coalesce(min(pos) FILTER (starts_with(line, 'T') AND NOT starts_with(nxt, 'T') AND nxt <> ''), 0)::INTEGER AS start FROM (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM lines) GROUP BY 1")
def _(d):
    nxt = F.lead("line").over(Window.partitionBy("doc_id").orderBy("pos"))
    good = F.startswith("line", F.lit("T")) & ~F.startswith("nxt", F.lit("T")) & (F.col("nxt") != "")
    return numbered_lines(d).withColumn("nxt", nxt).groupBy("doc_id").agg(F.coalesce(F.min(F.when(good, F.col("pos"))), F.lit(0)).alias("start"))


@query("w15_once_true", LINES, NUMBERED + "SELECT doc_id, pos, max(starts_with(line, 'A')) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS history FROM lines")
def _(d):
    return rows.once_true(numbered_lines(d), ["doc_id"], "pos", F.startswith("line", F.lit("A")), "history").select("doc_id", "pos", "history")


# Sorts, limits, sets.
@query("o01_natural_sort", "SELECT l_orderkey, l_linenumber, l_partkey, concat(l_suppkey, '.', l_linenumber, CASE WHEN l_orderkey % 2 = 0 THEN 'a' ELSE '' END) AS s FROM {lineitem}", "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_partkey ORDER BY split_part(s, '.', 1)::INT, regexp_extract(s, '\\.(\\d+)', 1)::INT, s, l_orderkey) AS place FROM base")
def _(d):
    order = Window.partitionBy("l_partkey").orderBy(ids.natural_key(F.col("s")), "l_orderkey")
    return d.select("l_orderkey", "l_linenumber", F.row_number().over(order).cast("bigint").alias("place"))


@query("o02_id_sort", "SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 5 = 0 THEN 'x' ELSE concat(s_suppkey % 13, chr(97 + cast(s_suppkey % 3 as int))) END AS id FROM {supplier}", "SELECT s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY coalesce(try_cast(regexp_extract(id, '^\\d+') AS INT), 1000000000), id, s_suppkey) AS place FROM base")
def _(d):
    number = F.coalesce(text.extract(F.col("id"), r"^(\d+)").cast("int"), F.lit(1_000_000_000))
    return d.select("s_suppkey", F.row_number().over(Window.partitionBy("s_nationkey").orderBy(number, "id", "s_suppkey")).cast("bigint").alias("place"))


@query("o06_first_rows", ORDERS, "SELECT o_orderkey FROM base WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 25")
def _(d):
    return d.where("o_orderstatus = 'O'").orderBy("o_orderkey").limit(25).select("o_orderkey")


@query("o07_capped", DOCS, "SELECT doc_id, left(text, 200) AS head FROM base")
def _(d):
    return d.select("doc_id", F.left(T(), F.lit(200)).alias("head"))


@query("o09_last_paragraph", "SELECT conv_id, turn, text FROM {conversations}", "SELECT conv_id, arg_max(text, turn) AS last FROM base GROUP BY 1")
def _(d):
    return d.groupBy("conv_id").agg(F.max_by("text", "turn").alias("last"))


@query("u01_vacant", "SELECT o_custkey, c_custkey FROM {customer} FULL OUTER JOIN {orders} ON c_custkey = o_custkey", "SELECT c_custkey FROM base EXCEPT SELECT o_custkey FROM base")
def _(d):
    return d.select("c_custkey").subtract(d.select(F.col("o_custkey").alias("c_custkey")))


@query("u02_union_sources", "SELECT s_nationkey, s_suppkey FROM {supplier}", "SELECT s_nationkey::BIGINT AS k FROM base UNION SELECT s_suppkey FROM base")
def _(d):
    return d.select(F.col("s_nationkey").cast("bigint").alias("k")).union(d.select("s_suppkey")).distinct()


@query("u03_union_triples", "SELECT l_linenumber, l_suppkey, l_partkey FROM {lineitem}", "SELECT DISTINCT l_linenumber AS a, l_suppkey AS b FROM base")
def _(d):
    return d.select(F.col("l_linenumber").alias("a"), F.col("l_suppkey").alias("b")).distinct()


@query("u06_union_corpora", "SELECT doc_id, text, lang FROM {documents}", "SELECT doc_id AS id, lang, NULL::VARCHAR AS kind FROM base WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, NULL, 'even' FROM base WHERE doc_id % 2 = 1")
def _(d):
    a = d.where("doc_id % 2 = 0").select(F.col("doc_id").alias("id"), "lang")
    return a.unionByName(d.where("doc_id % 2 = 1").select(F.col("doc_id").alias("id"), F.lit("even").alias("kind")), allowMissingColumns=True)


# Hierarchies.
@query("h06_parent_walk", NODES, "SELECT s_suppkey, 'us/' || st || '/statutes/title=' || n_nationkey AS title FROM base")
def _(d):
    paths = d.select("s_suppkey", F.explode(ids.ancestors(F.col("node_id"), "/", "/")).alias("a"))
    return paths.where(F.col("a").rlike("/title=[^/]+$")).select("s_suppkey", F.col("a").alias("title"))


@query("h08_breadth_first", "SELECT s_suppkey AS node, cast(floor(s_suppkey / 3) as bigint) AS up FROM {supplier}", ", walk(node, depth) AS (SELECT 1::BIGINT, 0 UNION SELECT b.node, w.depth + 1 FROM walk w JOIN base b ON b.up = w.node WHERE w.depth < 20 AND b.node <> w.node)\n--\nSELECT node, min(depth) AS depth FROM walk GROUP BY node")
def _(d):
    edges = d.where("node <> up").select(F.col("up").alias("src"), F.col("node").alias("dst"))
    return rows.reachable(edges, d.sparkSession.range(1, 2).withColumnRenamed("id", "node"))


@query("h10_toc_rows", "SELECT s_suppkey, concat(s_suppkey, chr(9), '`civ`', chr(9), '`TITLE ', s_nationkey, '. Of things`', chr(9), '2', chr(9), '`', s_nationkey, '.', s_suppkey, '`') AS value FROM {supplier}", "SELECT 'CIV' AS code, s_suppkey::VARCHAR AS node_id, regexp_extract(value, 'TITLE (\\d+)', 1) AS number, 'title' AS level, regexp_extract(value, 'TITLE (\\d+)', 1) AS parent_path FROM base")
def _(d):
    return readers.contents_rows(d).select("code", "node_id", "number", "level", "parent_path")


@query("h11_linked_ring", "SELECT o_orderkey, o_custkey FROM {orders}", ", e AS (SELECT o_orderkey AS node, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prev FROM base)\n--\nSELECT node, CASE WHEN prev IS NULL THEN true ELSE false END AS head FROM e")
def _(d):
    e = d.withColumn("prev", F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")))
    heads = e.select(F.col("o_orderkey").alias("node")).join(e.where("prev is not null").select(F.col("o_orderkey").alias("node")), "node", "left_anti").withColumn("head", F.lit(True))
    return e.select(F.col("o_orderkey").alias("node")).join(heads, "node", "left").select("node", F.coalesce("head", F.lit(False)).alias("head"))


# Sources over rows that are already there.
@query("s01_json_records", "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN concat(chr(123), 'broken') ELSE props END AS line FROM {events}", "SELECT event_id, (json_extract(line, '$.k'))::INTEGER AS k FROM base WHERE event_id % 10 <> 0")
def _(d):
    j = F.from_json("line", "k int, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return d.withColumn("j", j).where("j._bad is null").select("event_id", "j.k")


@query("s10_dump_fields", "SELECT s_suppkey, concat(s_suppkey, chr(9), '`', s_name, '`', chr(9), 'NULL', chr(9), ' ') AS line FROM {supplier}", "SELECT s_suppkey, s_suppkey::VARCHAR AS a, split_part(line, '`', 2) AS b, true AS c, true AS d FROM base")
def _(d):
    f = readers.dump_fields(F.col("line"))
    return d.select("s_suppkey", F.get(f, F.lit(0)).alias("a"), F.get(f, F.lit(1)).alias("b"), F.get(f, F.lit(2)).isNull().alias("c"), F.get(f, F.lit(3)).isNull().alias("d"))


@query("s12_manifest", "SELECT s_suppkey, concat(lpad(concat('', s_nationkey), 4, '0'), lpad(concat('', s_suppkey % 9999), 5, '0'), CASE s_suppkey % 3 WHEN 0 THEN 'K' WHEN 1 THEN 'A' ELSE '?' END, '0', s_suppkey) AS value FROM {supplier}", "SELECT substr(value, 1, 4)::INTEGER AS chapter, (substr(value, 5, 4)::INT)::VARCHAR || CASE WHEN substr(value, 9, 1) = '0' THEN '' ELSE '.' || substr(value, 9, 1) END AS act, substr(value, 10, 1) AS type, substr(value, 11) AS section FROM base WHERE s_suppkey % 3 < 2")
def _(d):
    return readers.manifest(d.select("value"))


@query("s13_rule_bodies", "SELECT doc_id AS pos, source AS document_number, text AS body FROM {documents}", "SELECT document_number, arg_max(body, pos) AS body FROM base WHERE length(body) >= 100 GROUP BY 1")
def _(d):
    return readers.rule_bodies(d)


@query("s24_page_words", "SELECT l_orderkey AS doc, l_linenumber AS page, cast(100 as double) AS width, cast(l_quantity * 2 as double) AS x, cast(l_suppkey % 5 as double) AS y, concat('w', l_partkey, 'x', l_suppkey) AS text FROM {lineitem}", ", w AS (SELECT *, least(floor(x / 50), 1) AS c FROM base), l AS (SELECT doc, page, c, y, string_agg(text, ' ' ORDER BY x, text) AS line FROM w GROUP BY ALL), p AS (SELECT doc, page, string_agg(line, chr(10) ORDER BY c, y) AS t FROM l GROUP BY ALL)\n--\nSELECT doc, string_agg(t, chr(10) || chr(10) ORDER BY page) AS text FROM p GROUP BY doc")
def _(d):
    return readers.page_text(d, 2)


@query("s36_first_week", "SELECT o_orderkey, o_custkey, year(o_orderdate) AS y, o_orderkey % 52 AS w FROM {orders}", "SELECT o_custkey, arg_min(w, (y, w)) AS week FROM base GROUP BY 1")
def _(d):
    return d.groupBy("o_custkey").agg(F.min_by("w", F.struct("y", "w")).alias("week"))


@query("s34_latest_year", "SELECT l_suppkey, year(l_shipdate) AS y, l_orderkey FROM {lineitem}", "SELECT l_suppkey, max(y)::INTEGER AS year FROM base GROUP BY 1")
def _(d):
    return d.groupBy("l_suppkey").agg(F.max("y").cast("int").alias("year"))


# Segmentation over texts and pages.
@query("t01_segments", DOCS, r"SELECT doc_id, (len(string_split_regex(text, '\bThe\b')) - 1)::INTEGER AS n, coalesce(trim(string_split_regex(text, '\bThe\b')[2]), '') AS first FROM base")
def _(d):
    s = segment.segments(T(), r"\bThe\b")
    return d.select("doc_id", F.size(s).alias("n"), F.coalesce(F.get(s, F.lit(0))["body"], F.lit("")).alias("first"))


@query("t03_two_levels", DOCS, r", arts AS (SELECT doc_id, string_split_regex(text, '\bThe\b')[2:] AS parts FROM base), e AS (SELECT doc_id, unnest(parts) AS art, generate_subscripts(parts, 1) - 1 AS apos FROM arts), p AS (SELECT doc_id, apos, string_split(trim(art, ' '), chr(10)) AS ls FROM e)"
"\n--\n" "SELECT doc_id, apos::INTEGER AS apos, unnest(range(len(ls)))::INTEGER AS pos, chr(10) AS section, unnest(list_transform(ls, lambda x: trim(x, ' '))) AS body FROM p")
def _(d):
    return segment.two_levels(d.select("doc_id", "text"), "text", r"\bThe\b", r"\n").select("doc_id", "apos", "pos", "section", "body")


@query("t14_anchors", PAGES, r"""SELECT page_id, len(regexp_extract_all(html, '(?is)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1))::INTEGER AS n, array_to_string(regexp_extract_all(html, '(?is)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1), '|') AS urls FROM base""")
def _(d):
    a = segment.anchors(F.col("html"))
    return d.select("page_id", F.size(a).alias("n"), F.array_join(F.transform(a, lambda x: x["url"]), "|").alias("urls"))


@query("t21_routed_blocks", "SELECT conv_id, turn, CASE role WHEN 'system' THEN 'title' WHEN 'assistant' THEN 'note' ELSE role END AS kind, text FROM {conversations}", "SELECT conv_id, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (kind = 'title'), '') AS title, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (kind = 'note'), '') AS note, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (kind = 'user'), '') AS body FROM base GROUP BY 1")
def _(d):
    blocks = F.transform(F.sort_array(F.collect_list(F.struct("turn", "kind", "text"))), lambda x: F.struct(x["kind"].alias("kind"), x["text"].alias("text")))
    return d.groupBy("conv_id").agg(blocks.alias("b")).select("conv_id", segment.routed(F.col("b")).alias("x")).select("conv_id", "x.title", "x.note", "x.body")


@query("x04_html_text", PAGES)
def _(d):
    return d.select("page_id", markup.udf_of(markup.html_text)(F.col("html")).alias("text"))


@query("x05_block_text", PAGES)
def _(d):
    return d.select("page_id", markup.udf_of(markup.block_text)(F.col("html")).alias("text"))


# Chunks and payloads.
@query("c01_chunks", DOCS)
def _(d):
    return chunk.chunk_rows(d, F.concat(F.lit("DOC_"), "doc_id")).select("doc_id", "chunk_index", "total_chunks", "point_id", "word_count", "parent_chunk_id")


@query("c02_one_chunk", DOCS, "SELECT doc_id, 0 AS chunk_index, text AS chunk FROM base")
def _(d):
    return d.select("doc_id", F.posexplode(F.array(F.coalesce(T(), F.lit("")))).alias("chunk_index", "chunk"))


def FIELDS():  # noqa: N802
    return F.create_map(*[F.lit(x) for x in ("act_id", "A1", "category", "state_statute", "document_type", "statute", "state", "de", "chunk_index", "0", "total_chunks", "1", "history_notes", "old", "bogus", "1")])


@query("f20_payload_audit", DOCS, "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'country_code|jurisdiction|text' ELSE 'country_code|jurisdiction' END AS missing_required, 17 AS missing_expected, 'bogus' AS unknown, 'history_notes' AS deprecated, false AS ok FROM base")
def _(d):
    fields = F.map_concat(FIELDS(), F.create_map(F.lit("text"), F.when(F.col("doc_id") % 3 == 0, "").otherwise("some text")))
    return d.select("doc_id", payload.audit(fields).alias("x")).select("doc_id", F.array_join("x.missing_required", "|").alias("missing_required"), F.size("x.missing_expected").alias("missing_expected"), F.array_join("x.unknown", "|").alias("unknown"), F.array_join("x.deprecated", "|").alias("deprecated"), "x.ok")


@query("p01_canonical_fields", DOCS, "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'own' ELSE 'old' END AS history, 'US' AS jurisdiction FROM base")
def _(d):
    extra = F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("history"), F.lit("own"))).otherwise(F.create_map(F.lit("jurisdiction"), F.lit("")))
    fixed = payload.with_defaults(payload.canonical(F.map_concat(FIELDS(), extra)))
    return d.select("doc_id", F.element_at(fixed, F.lit("history")).alias("history"), F.element_at(fixed, F.lit("jurisdiction")).alias("jurisdiction"))


@query("p22_reference_structs", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM {lineitem}", "SELECT l_orderkey, coalesce(string_agg(l_linenumber || ':' || l_partkey, '|' ORDER BY l_linenumber, l_partkey) FILTER (l_partkey % 5 > 0), '') AS refs FROM base GROUP BY 1")
def _(d):
    refs = d.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("title"), F.when(F.col("l_partkey") % 5 > 0, F.col("l_partkey")).alias("part")))).alias("r"))
    kept = F.filter("r", lambda x: x["title"].isNotNull() & x["part"].isNotNull())
    return refs.select("l_orderkey", F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["title"].cast("string"), x["part"].cast("string"))), "|").alias("refs"))


@query("p23_agency_slugs", "SELECT o_custkey, o_orderpriority FROM {orders}", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS slugs FROM base GROUP BY 1")
def _(d):
    return d.groupBy("o_custkey").agg(F.array_join(cites.sorted_distinct(F.collect_list("o_orderpriority")), "|").alias("slugs"))


@query("p24_tuple_node", NODES, "SELECT node_id, CASE WHEN third = 0 THEN 'structure' ELSE 'content' END AS node_type, 'section' AS level, s_suppkey::VARCHAR AS number FROM base")
def _(d):
    slots = F.array("node_id", F.when(F.col("third") > 0, F.col("heading")), F.col("s_suppkey").cast("string"))
    return d.select(F.get(slots, F.lit(0)).alias("node_id"), F.when(F.get(slots, F.lit(1)).isNull(), "structure").otherwise("content").alias("node_type"), F.coalesce(ids.level(F.col("node_id"))["classifier"], F.lit("hub")).alias("level"), F.get(slots, F.lit(2)).alias("number"))


@query("g04_coverage", DOCS, "SELECT count(*) FILTER (n >= 50) AS ready, count(*) FILTER (n < 50) AS held, sum(n)::BIGINT AS sections FROM (SELECT source, count(*) AS n FROM base GROUP BY 1)")
def _(d):
    by = d.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return by.agg(F.count_if(F.col("n") >= 50).alias("ready"), F.count_if(F.col("n") < 50).alias("held"), F.sum("n").alias("sections"))


# Event-time windows, as batch.
EVENTS = "SELECT event_id, ts, user_id, event_type, value FROM {events}"


@query("z01_tumbling_windows", EVENTS, "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM base GROUP BY 1, 2")
def _(d):
    return ingest.windowed_counts(d).withColumn("total", F.round("total", 4))


@query("z02_sessions", EVENTS, "SELECT user_id, min(ts) AS start, max(ts) + INTERVAL '30 minutes' AS stop, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS fresh FROM base)) GROUP BY user_id, s")
def _(d):
    return ingest.sessions(d)

