"""Queries over the smaller operators: keys, fallbacks, predicates, orders, labelled blocks, gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexmill.functions import status, text
from lexmill.operators import payload, rows, segment
from lexmill.plans.recipe import DOCS, NODES, PAGES, query
from lexmill.sources import readers


@query("s02_known_keys", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE concat('A', user_id) END AS act FROM {events}", "SELECT DISTINCT act AS act_id FROM base WHERE act IS NOT NULL")
def _(d):
    return readers.known_keys(d.select(F.struct(F.col("act").alias("act_id")).alias("metadata")))


@query("s07_archive_inventory", "SELECT l_returnflag AS archive, l_linestatus AS kind, cast(l_quantity as bigint) AS size FROM {lineitem}", "SELECT archive, kind, count(*) AS files, sum(size)::BIGINT AS bytes FROM base GROUP BY ROLLUP (archive, kind)")
def _(d):
    return readers.member_counts(d)


@query("s11_code_names", "SELECT concat('`', lower(n_name), '`', chr(9), '`Code of ', n_name, '`') AS value, n_name FROM {nation}", "SELECT upper(n_name) AS code, 'Code of ' || n_name AS name FROM base")
def _(d):
    return readers.code_names(d)


@query("s30_paged_lists", "SELECT l_orderkey AS document, l_linenumber AS page, l_partkey AS v, l_suppkey FROM {lineitem}", "SELECT document, max((page, v))[2] AS v FROM base GROUP BY 1")
def _(d):
    return d.groupBy("document").agg(F.max(F.struct("page", "v")).alias("m")).select("document", F.col("m.v").alias("v"))


def _plain(html: str) -> str:
    """SQL of a page without tags, its entities replaced one after another."""
    out = f"regexp_replace({html}, '<[^>]+>', ' ', 'g')"
    for entity, character in text.ENTITIES:
        out = f"replace({out}, '{entity}', chr({ord(character)}))"
    return rf"trim(regexp_replace({out}, '[\s\x0b\x{{85}}\p{{Z}}]+', ' ', 'g'))"


@query("s31_text_fallback", PAGES, f"SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'raw ' || page_id ELSE {_plain('html')} END AS t FROM base")
def _(d):
    raw = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("raw "), "page_id"))
    return d.select("page_id", F.coalesce(raw, text.stripped_html(F.col("html"))).alias("t"))


@query("s32_titles_dimension", "SELECT n_nationkey, n_name, n_regionkey FROM {nation}", "SELECT n_nationkey AS number, n_name AS name FROM base WHERE n_regionkey <> 2")
def _(d):
    return d.withColumn("reserved", F.col("n_regionkey") == 2).where(~F.col("reserved")).select(F.col("n_nationkey").alias("number"), F.col("n_name").alias("name"))


@query("p02_defaults", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN NULL ELSE 'federal' END AS jurisdiction FROM {customer}", "SELECT c_custkey, coalesce(nullif(jurisdiction, ''), 'US') AS jurisdiction FROM base")
def _(d):
    fields = payload.with_defaults(F.create_map(F.lit("jurisdiction"), F.col("jurisdiction")))
    return d.select("c_custkey", F.element_at(fields, F.lit("jurisdiction")).alias("jurisdiction"))


@query("p21_node_paths", "SELECT s_suppkey, s_nationkey FROM {supplier}", "SELECT s_suppkey, 'us/in/statutes/title=' || s_nationkey || '/section=' || s_suppkey AS node_id FROM base")
def _(d):
    levels = F.concat_ws("/", F.concat(F.lit("title="), "s_nationkey"), F.concat(F.lit("section="), "s_suppkey"))
    return d.select("s_suppkey", F.concat_ws("/", F.lit("us"), F.lit("in"), F.lit("statutes"), levels).alias("node_id"))


@query("p25_text_coercion", "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN concat('[\"a\", \"', c_name, '\"]') WHEN 1 THEN concat('\"', c_name, '\"') ELSE 'null' END AS v, c_name FROM {customer}", "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'a|' || c_name WHEN 1 THEN c_name ELSE '' END AS paragraphs FROM base")
def _(d):
    v = F.try_parse_json("v")
    listed = F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<string>")).when(F.schema_of_variant(v) == "STRING", F.array(F.try_variant_get(v, "$", "string")))
    return d.select("c_custkey", F.coalesce(F.array_join(listed, "|"), F.lit("")).alias("paragraphs"))


@query("p34_list_fallback", "SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE concat('u', n_nationkey) END AS url FROM {nation}", "SELECT n_name AS name, url FROM base WHERE url IS NOT NULL")
def _(d):
    primary = d.where("n_nationkey > 1000").select(F.col("n_name").alias("name"), "url")
    fallback = d.where("url is not null and n_name <> ''").select(F.col("n_name").alias("name"), "url")
    some = primary.agg(F.count(F.lit(1)).alias("k"))
    return primary.unionByName(fallback.join(F.broadcast(some.where("k = 0")), F.lit(True), "left_semi"))


@query("f13_contents_rows", "SELECT p_partkey, concat(CASE p_size % 3 WHEN 0 THEN 'INDEX ' ELSE '' END, p_name, CASE p_size % 5 WHEN 0 THEN ' .... 7' ELSE '' END) AS t, p_size FROM {part}", "SELECT p_partkey FROM base WHERE p_size % 3 = 0 OR p_size % 5 = 0")
def _(d):
    return d.where(status.is_contents_row(F.col("t"))).select("p_partkey")


@query("f17_type_filter", "SELECT o_orderkey, o_orderpriority FROM {orders}", "SELECT o_orderkey FROM base WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def _(d):
    return d.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey")


@query("f19_missing_required", DOCS, "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 8 ELSE 7 END::INTEGER AS n FROM base")
def _(d):
    fields = F.create_map(F.lit("chunk_index"), F.lit("0"), F.lit("state"), F.when(F.col("doc_id") % 2 == 0, "").otherwise("de"))
    return d.select("doc_id", F.size(payload.missing_required(fields)).alias("n"))


@query("f23_hard_sites", PAGES, "SELECT page_id, contains(url, 'site1') OR contains(url, 'site2') AS hard FROM base")
def _(d):
    return d.select("page_id", status.has_keyword(F.col("url"), ("site1", "site2"), any_case=False).alias("hard"))


@query("j04_granule_metadata", "SELECT l_orderkey, l_linenumber, o_orderpriority, o_orderkey FROM {lineitem} LEFT JOIN (SELECT * FROM {orders} WHERE o_orderkey % 3 > 0) ON l_orderkey = o_orderkey", "SELECT l_orderkey, l_linenumber, coalesce(o_orderpriority, '') AS meta FROM base")
def _(d):
    mods = d.where("o_orderkey is not null").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority").distinct()
    return d.select("l_orderkey", "l_linenumber").join(mods, "l_orderkey", "left").select("l_orderkey", "l_linenumber", F.coalesce("o_orderpriority", F.lit("")).alias("meta"))


@query("j16_url_match", "SELECT s_suppkey, concat('https://h/', s_nationkey, '/', s_suppkey) AS url, s_nationkey FROM {supplier}", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN url ELSE 'https://h/' || s_nationkey || '/' END AS found FROM base")
def _(d):
    asked = d.select("s_suppkey", "url", F.regexp_replace("url", "[^/]+$", "").alias("stem"))
    exact = d.where("s_suppkey % 2 = 0").select("url", F.col("url").alias("same"))
    stems = asked.select("stem").distinct().withColumn("near", F.col("stem"))
    return asked.join(exact, "url", "left").join(stems, "stem", "left").select("s_suppkey", F.coalesce("same", "near").alias("found"))


@query("a15_class_order", "SELECT event_type FROM {events}", "SELECT event_type, n, row_number() OVER (ORDER BY n DESC, event_type) AS place FROM (SELECT event_type, count(*) AS n FROM base GROUP BY 1)")
def _(d):
    by = d.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))  # a row a class
    return by.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "event_type")).cast("bigint"))


@query("o03_numeric_prefixes", "SELECT s_suppkey, s_nationkey, concat(s_suppkey % 3, '.', s_suppkey % 11, '.', CASE WHEN s_suppkey % 4 = 0 THEN 'x' ELSE concat('', s_suppkey) END) AS id FROM {supplier}", "SELECT s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY split_part(id, '.', 1)::INT, split_part(id, '.', 2)::INT, coalesce(try_cast(split_part(id, '.', 3) AS INT), 9999), s_suppkey) AS place FROM base")
def _(d):
    part = lambda i: F.coalesce(F.split_part("id", F.lit("."), F.lit(i)).try_cast("int"), F.lit(9999))
    return d.select("s_suppkey", F.row_number().over(Window.partitionBy("s_nationkey").orderBy(part(1), part(2), part(3), "s_suppkey")).cast("bigint").alias("place"))


@query("o05_failures_last", "SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 3 = 0 THEN 'ok' ELSE 'timeout' END AS outcome FROM {supplier}", "SELECT s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY outcome <> 'ok', s_suppkey) AS place FROM base")
def _(d):
    return d.select("s_suppkey", F.row_number().over(Window.partitionBy("s_nationkey").orderBy(F.col("outcome") != "ok", "s_suppkey")).cast("bigint").alias("place"))


@query("t02_div_blocks", "SELECT page_id, concat('<div class=\"section\" id=\"s', page_id, '-1\">', url, '<div class=\"section\" id=\"s', page_id, '-2\">end') AS html, url FROM {pages}", "SELECT page_id, 's' || page_id || '-1|s' || page_id || '-2' AS ids, url AS first FROM base")
def _(d):
    b = segment.div_blocks(F.col("html"), "section")
    return d.select("page_id", F.array_join(F.transform(b, lambda x: x["id"]), "|").alias("ids"), F.get(b, F.lit(0))["body"].alias("first"))


@query("t05_amendment_tail", "SELECT s_suppkey, concat(s_name, ' ARTICLES OF AMENDMENT I. ', s_suppkey) AS t, s_name FROM {supplier}", "SELECT s_suppkey, s_name || ' ' AS body, ' I. ' || s_suppkey AS amendments FROM base")
def _(d):
    return d.select("s_suppkey", segment.amendment_tail(F.col("t"), "ARTICLES OF AMENDMENT").alias("x")).select("s_suppkey", "x.body", "x.amendments")


@query("t09_labelled_block", "SELECT s_suppkey, concat('STATUTORY AUTHORITY: ', s_name, ' EFFECTIVE DATE: Jan ', s_suppkey, ' AMENDED: none') AS t, s_name FROM {supplier}", "SELECT s_suppkey, s_name AS authority, 'Jan ' || s_suppkey AS effective FROM base")
def _(d):
    m = segment.labelled(F.col("t"), "STATUTORY AUTHORITY", "EFFECTIVE DATE", "AMENDED")
    return d.select("s_suppkey", m["STATUTORY AUTHORITY"].alias("authority"), m["EFFECTIVE DATE"].alias("effective"))


@query("t13_page_harvest", PAGES, r"""SELECT page_id, len(regexp_extract_all(html, '(?is)<(h1|p|li)\b[^>]*>'))::INTEGER AS blocks, len(regexp_extract_all(html, '(?i)<p\b'))::INTEGER AS paragraphs FROM base""")
def _(d):
    kinds = F.transform(text.extract_all(F.col("html"), r"(?is)<(h1|p|li)\b[^>]*>", 1), lambda k: F.lower(k))
    return d.select("page_id", F.size(kinds).alias("blocks"), F.size(F.filter(kinds, lambda k: k == "p")).alias("paragraphs"))


@query("t22_labelled_pivot", "SELECT conv_id, turn, role, text FROM {conversations}", "SELECT conv_id, count(*) FILTER (role = 'user') AS n_user, count(*) FILTER (role = 'assistant') AS n_assistant FROM base GROUP BY 1")
def _(d):
    p = d.groupBy("conv_id").pivot("role", ["user", "assistant"]).agg(F.count(F.lit(1)))
    return p.select("conv_id", F.coalesce("user", F.lit(0).cast("bigint")).alias("n_user"), F.coalesce("assistant", F.lit(0).cast("bigint")).alias("n_assistant"))


@query("g02_alias_names", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'r2_txt_url' WHEN 1 THEN 'history_notes' WHEN 2 THEN 'history_note_raw' ELSE 'history_action' END AS k FROM {orders}", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'r2_section_text_url' WHEN 3 THEN 'history_action' ELSE 'history' END AS name FROM base")
def _(d):
    return d.select("o_orderkey", payload.canonical_key(F.col("k")).alias("name"))


@query("g03_drop_accounting", DOCS, "SELECT CASE WHEN length(text) < 20 THEN 'too_short' WHEN length(text) > 10000 THEN 'too_long' ELSE 'kept' END AS outcome, count(*) AS n FROM base GROUP BY 1")
def _(d):
    outcome = F.when(F.length("text") < 20, "too_short").when(F.length("text") > 10000, "too_long").otherwise("kept")
    return d.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("g06_done_titles", NODES, "SELECT s_suppkey FROM base WHERE n_nationkey NOT IN (SELECT n_nationkey FROM base WHERE third = 1)")
def _(d):
    return rows.resume(d, d.where("third = 1"), "n_nationkey").select("s_suppkey")


@query("z03_statistics", "SELECT l_returnflag, l_linestatus, l_partkey, cast(l_quantity as bigint) AS q FROM {lineitem}", "SELECT l_returnflag, l_linestatus, count(*) AS n, max(q) AS top FROM base GROUP BY CUBE (l_returnflag, l_linestatus)")
def _(d):
    return d.cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.max("q").alias("top"))
