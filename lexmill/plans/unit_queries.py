"""Queries over the operators that others use within: identity, heads, enrichment of whole texts, records, payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.functions import cites, dates, ids, status, text
from lexmill.operators import chunk, contents, pages, payload, records, rows, segment, trees
from lexmill.plans.recipe import DOCS, NODES, query

#: Whole texts of documents with a section's apparatus after them, which differs from row to row.
SECTIONS = """SELECT doc_id, concat(coalesce(text, ''), chr(10), '(a) See ', doc_id % 50 + 1, ' U.S.C. § ', doc_id % 9999 + 1, 'a and ', doc_id % 40 + 1, ' C.F.R. § 12.', doc_id % 9, CASE WHEN doc_id % 3 = 0 THEN concat(' and ', doc_id % 50 + 1, ' USC sec. 7') ELSE '' END,
  chr(10), '(b) Pub. L. 117-', doc_id % 200 + 1, ' and Pub. L. No. 99-', doc_id % 7, CASE WHEN doc_id % 2 = 0 THEN concat('; amended ', 1900 + doc_id % 120) ELSE '' END, chr(10), '(', doc_id % 5, ') x', chr(10), '(iv) y ') AS text FROM {documents}"""


def found(pattern: str, joined: bool = True) -> str:
    """A sorted list of the pattern's matches, two groups joined by a colon or one."""
    if not joined:
        return f"list_sort(list_distinct(regexp_extract_all(text, '{pattern}', 1)))"
    return f"list_sort(list_distinct(list_transform(list_zip(regexp_extract_all(text, '{pattern}', 1), regexp_extract_all(text, '{pattern}', 2)), lambda x: x[1] || ':' || x[2])))"


SQL_USC, SQL_CFR, SQL_LAWS = found(cites.USC), found(cites.CFR), found(cites.PUBLIC_LAW, False)
SQL_LETTERS, SQL_NUMBERS, SQL_ROMANS = (found(p, False) for p in (cites.LETTERS, cites.NUMBERS, cites.ROMANS))
SQL_YEARS = f"list_filter(list_sort(list_distinct(list_transform(CASE WHEN len(regexp_extract_all(text, '{cites.AMENDED}', 1)) > 0 THEN regexp_extract_all(text, '{cites.AMENDED}', 1) ELSE regexp_extract_all(text, '{cites.IN_BRACKETS}', 1) END, lambda y: y::INTEGER))), lambda y: y BETWEEN 1789 AND 2100)"


def T():  # noqa: N802
    return F.col("text")


def bar(c, separator="|"):  # noqa: ANN001, ANN201
    return F.array_join(c, separator)


@query("e02_subsections_of_texts", SECTIONS, f"SELECT doc_id, array_to_string({SQL_LETTERS}, '|') AS letters, len({SQL_LETTERS})::INTEGER AS n FROM base")
def _(d):
    return d.select("doc_id", bar(cites.subsection_letters(T())).alias("letters"), F.size(cites.subsection_letters(T())).alias("n"))


@query("e03_numbered_paragraphs", SECTIONS, f"SELECT doc_id, (len({SQL_NUMBERS}) + len({SQL_ROMANS}))::INTEGER AS n FROM base")
def _(d):
    return d.select("doc_id", cites.numbered_paragraphs(T()).alias("n"))


@query("e04_usc_of_texts", SECTIONS, f"SELECT doc_id, array_to_string({SQL_USC}, '|') AS usc FROM base")
def _(d):
    return d.select("doc_id", bar(cites.usc_references(T())).alias("usc"))


@query("e05_cfr_references", SECTIONS, f"SELECT doc_id, array_to_string({SQL_CFR}, '|') AS cfr FROM base")
def _(d):
    return d.select("doc_id", bar(cites.cfr_references(T())).alias("cfr"))


@query("e06_public_laws", SECTIONS, f"SELECT doc_id, array_to_string(list_sort(list_transform({SQL_LAWS}, lambda x: 'Pub. L. ' || x)), '|') AS laws FROM base")
def _(d):
    return d.select("doc_id", bar(cites.public_laws(T())).alias("laws"))


@query("e07_years_of_texts", SECTIONS, f"SELECT doc_id, array_to_string({SQL_YEARS}, '|') AS years FROM base")
def _(d):
    return d.select("doc_id", bar(cites.amendment_years(T())).alias("years"))


@query("e08_last_amended", SECTIONS, f"SELECT doc_id, list_max({SQL_YEARS})::INTEGER AS last_amended_year, len({SQL_YEARS})::INTEGER AS amendments_count, len({SQL_LAWS})::INTEGER AS public_laws_count, (len({SQL_USC}) + len({SQL_CFR}))::INTEGER AS cross_references_count FROM base")
def _(d):
    return d.select("doc_id", cites.enriched(T()).alias("e")).select("doc_id", "e.last_amended_year", "e.amendments_count", "e.public_laws_count", "e.cross_references_count")


@query("f04_reserved_head", "SELECT doc_id, concat(CASE doc_id % 4 WHEN 0 THEN '§ 12.1 [Reserved] ' WHEN 1 THEN ' 3-2. Reserved. ' WHEN 2 THEN 'Reserved by law ' ELSE '' END, coalesce(text, '')) AS text FROM {documents}", r"SELECT doc_id, regexp_matches(left(regexp_replace(text, '^\s+', ''), 300), '^[\d.\-:()§\s]*(\[(?i:reserved)\]|(?i:reserved)\s*\.(\s|$))') AS reserved FROM base")
def _(d):
    return d.select("doc_id", status.is_reserved(T()).alias("reserved"))


@query("f05_head", DOCS, r"SELECT doc_id, regexp_replace(left(regexp_replace(text, '^\s+', ''), 300), '^[\d.\-:()§\s]+', '') AS head FROM base")
def _(d):
    return d.select("doc_id", status.head(T()).alias("head"))


@query("p06_title_number", NODES, "SELECT s_suppkey, n_nationkey::INTEGER AS title FROM base")
def _(d):
    return d.select("s_suppkey", ids.title_number(F.col("node_id")).alias("title"))


@query("p08_display_path", NODES, "SELECT s_suppkey, 'Ohio Code / Title ' || n_nationkey || ' / Chapter ' || (s_suppkey % 7) || ' / Section ' || s_suppkey AS path FROM base")
def _(d):
    return d.select("s_suppkey", ids.display_path(F.col("node_id"), F.lit("Ohio")).alias("path"))


@query("h03_parent_id", NODES, "SELECT s_suppkey, 'us/' || st || '/statutes/title=' || n_nationkey || '/chapter=' || (s_suppkey % 7) AS parent FROM base")
def _(d):
    return d.select("s_suppkey", ids.parent_id(F.col("node_id")).alias("parent"))


@query("h04_ancestor_at", NODES, "SELECT s_suppkey, 'us/' || st || '/statutes/title=' || n_nationkey AS title, NULL::VARCHAR AS part FROM base")
def _(d):
    return d.select("s_suppkey", ids.ancestor_at(F.col("node_id"), "title").alias("title"), ids.ancestor_at(F.col("node_id"), "part").alias("part"))


@query("x26_token_estimate", DOCS, "SELECT doc_id, (length(text) // 4)::INTEGER AS tokens FROM base")
def _(d):
    return d.select("doc_id", text.token_estimate(T()).alias("tokens"))


@query("x43_text_sha1", DOCS, "SELECT doc_id, sha1(text) AS sha1 FROM base")
def _(d):
    return d.select("doc_id", ids.text_sha1(T()).alias("sha1"))


@query("x34_trailing_year", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'no year' ELSE concat('chapter ', o_custkey, ', ', year(o_orderdate)) END AS s, o_orderdate FROM {orders}", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN year(o_orderdate) END::INTEGER AS year FROM base")
def _(d):
    return d.select("o_orderkey", dates.trailing_year(F.col("s")).alias("year"))


@query("x47_first_present", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS a, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat(' ', c_mktsegment, ' ') END AS b FROM {customer}", "SELECT c_custkey, trim(coalesce(nullif(a, ''), nullif(b, ''), '')) AS v FROM base")
def _(d):
    return d.select("c_custkey", text.first_present(F.col("a"), F.col("b")).alias("v"))


@query("a07_last_write", "SELECT l_orderkey AS act_id, cast(l_linenumber as bigint) * 10000000 + l_partkey AS written, l_partkey FROM {lineitem}", "SELECT act_id, arg_max(l_partkey, written) AS l_partkey FROM base GROUP BY act_id")
def _(d):
    return rows.keep_last(d, ["act_id"], "written").select("act_id", "l_partkey")


@query("a18_amendment_events", "SELECT o_orderkey, concat('(Feb. 15, 1876. Added Mar. 1, ', year(o_orderdate), '; amended Nov. 5, ', year(o_orderdate), '.)') AS t, o_orderdate FROM {orders}", "SELECT o_orderkey, len(regexp_extract_all(substr(t, position('Added' IN t)), '(\\d{4})', 1))::INTEGER AS events, year(o_orderdate)::INTEGER AS last FROM base")
def _(d):
    return d.select("o_orderkey", cites.amendment_summary(F.col("t"), F.lit("tx")).alias("x")).select("o_orderkey", "x.events", "x.last")


@query("j08_resume_titles", "SELECT o_orderkey, o_custkey AS title, o_orderstatus FROM {orders}", "SELECT o_orderkey FROM base WHERE title NOT IN (SELECT title FROM base WHERE o_orderstatus = 'P')")
def _(d):
    return rows.resume(d, d.where("o_orderstatus = 'P'"), "title").select("o_orderkey")


@query("k05_upsert_rules", "SELECT l_orderkey AS act_id, l_linenumber AS n, l_partkey, l_suppkey FROM {lineitem}", "SELECT act_id, n, CASE WHEN act_id % 3 = 0 AND n = 1 THEN -1 ELSE l_partkey END AS v FROM base WHERE act_id % 3 <> 0 OR n = 1 OR act_id NOT IN (SELECT act_id FROM base WHERE n = 1)")
def _(d):
    old, new = d.select("act_id", "n", F.col("l_partkey").alias("v")), d.where("act_id % 3 = 0 and n = 1").select("act_id", "n", F.lit(-1).cast("bigint").alias("v"))
    return rows.upsert(old, new, "act_id")


@query("o04_integers_as_text", "SELECT l_orderkey, l_linenumber, l_suppkey, cast(l_partkey as string) AS s FROM {lineitem}".replace("string", "varchar(20)"), "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY s::INTEGER, l_orderkey, l_linenumber) AS place FROM base")
def _(d):
    return rows.placed(d, ["l_suppkey"], ids.integer_key(F.col("s")), "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber", F.col("place").cast("bigint").alias("place"))


@query("o08_paragraphs_by_index", "SELECT l_orderkey, l_linenumber, l_partkey FROM {lineitem}", "SELECT l_orderkey, string_agg('p' || l_partkey, chr(10) || chr(10) ORDER BY l_linenumber, 'p' || l_partkey) AS text FROM base GROUP BY 1")
def _(d):
    paragraphs = d.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("idx"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("text"))).alias("p"))
    return paragraphs.select("l_orderkey", text.joined_paragraphs(F.col("p")).alias("text"))


@query("u04_key_differences", "SELECT c_custkey, concat('k', c_custkey % 5) AS odd, c_custkey % 2 AS two FROM {customer}", "SELECT c_custkey, odd AS unknown, CASE two WHEN 1 THEN 'corpus_type' ELSE '' END AS deprecated FROM base")
def _(d):
    fields = F.when(F.col("two") == 1, F.create_map(F.lit("text"), F.lit("x"), F.col("odd"), F.lit("y"), F.lit("corpus_type"), F.lit("z"))).otherwise(F.create_map(F.lit("text"), F.lit("x"), F.col("odd"), F.lit("y")))
    return d.select("c_custkey", payload.audit(fields).alias("a")).select("c_custkey", bar("a.unknown").alias("unknown"), bar("a.deprecated").alias("deprecated"))


@query("u05_known_fields", "SELECT r_regionkey FROM {region}", f"SELECT r_regionkey, {len(set(payload.KNOWN))}::INTEGER AS known, true AS all_there FROM base")
def _(d):
    known = payload.names(payload.KNOWN)
    every = payload.names((*payload.REQUIRED, *payload.EXPECTED, *payload.HIERARCHY, *payload.ENRICHMENT, *payload.ADDRESSES, *payload.OTHERS, *payload.DEPRECATED))
    return d.select("r_regionkey", F.size(F.array_distinct(known)).alias("known"), (F.size(F.array_except(every, known)) == 0).alias("all_there"))


@query("c03_chunk_records", "SELECT doc_id, text FROM {documents} WHERE length(text) < 4000", "SELECT 'D' || doc_id AS act_id, 0 AS chunk_index, 1 AS total_chunks, text AS chunk, sha1(text) AS full_text_sha1 FROM base WHERE length(text) >= 20")
def _(d):
    return chunk.chunk_rows(d, F.concat(F.lit("D"), F.col("doc_id"))).select("act_id", "chunk_index", "total_chunks", "chunk", "full_text_sha1")


def _record_query(name: str, sources: tuple[str, ...], act: str, citation: str) -> None:
    """A query over the records of some sources, each row with one of them in turn."""
    pick = "CASE doc_id % {0} {1} END".format(len(sources), " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(sources)))
    base = f"SELECT doc_id, {pick} AS source_name, concat(doc_id, '.', doc_id % 7) AS number, concat('', doc_id % 9) AS part, concat('P', doc_id % 3) AS prefix, concat('R', doc_id % 4) AS rule_set, concat('OH') AS state, concat('t') AS section_title, text FROM {{documents}}"

    @query(name, base, f"SELECT {act} AS act_id, {citation} AS citation, sha1(text) AS full_text_sha1, 'OH' AS state FROM base")
    def _(d):  # noqa: ANN202
        return records.records(d).select("act_id", "citation", "full_text_sha1", "state")


SAFE = "regexp_replace(number, '[^A-Za-z0-9]+', '_', 'g')"
_record_query("p14_register_records", ("federal_register",), f"'FR_' || {SAFE}", "prefix")
_record_query("p15_bulletin_records", ("irs_bulletin",), f"'IRB_' || {SAFE}", "number")
_record_query("p16_ruling_records", ("ssa_rulings",), f"'SSA_' || {SAFE}", "number")
_record_query("p17_presidential_records", ("presidential",), f"'FRP_' || {SAFE}", "prefix")
_record_query("p19_court_rule_records", ("mn_court_rules", "nj_court_rules"), f"CASE source_name WHEN 'mn_court_rules' THEN 'SRULES_MN_' || rule_set || '_R' || {SAFE} ELSE 'SRULES_NJ_P' || part || '_S' || {SAFE} END", "CASE source_name WHEN 'mn_court_rules' THEN prefix || ' ' || number ELSE 'R. ' || part || ':' || number END")
_record_query("p20_statute_records", ("dc_statutes", "oh_statutes", "ut_statutes", "pr_codes"), f"CASE source_name WHEN 'pr_codes' THEN 'STATE_PR_' || rule_set || '_A' || {SAFE} ELSE 'STATE_' || upper(left(source_name, 2)) || '_S' || {SAFE} END", "CASE source_name WHEN 'dc_statutes' THEN 'D.C. Code § ' || number WHEN 'oh_statutes' THEN 'Ohio Rev. Code § ' || number WHEN 'ut_statutes' THEN 'Utah Code § ' || number ELSE prefix || ' Art. ' || number END")


@query("p03_payload", NODES, "SELECT 'STATE_' || upper(st) || '_T' || n_nationkey || '_C' || (s_suppkey % 7) || '_S' || s_suppkey AS act_id, s_suppkey::VARCHAR AS section_number, n_nationkey::INTEGER AS title_number, 'section' AS level_classifier, heading AS section_title, 'us' AS country_code FROM base")
def _(d):
    made = payload.of_node(F.col("node_id"), F.col("st"), F.col("s_suppkey").cast("string"), F.col("heading"))
    return d.select(made.alias("p")).select("p.act_id", "p.section_number", "p.title_number", "p.level_classifier", "p.section_title", "p.country_code")


@query("g01_audit_records", "SELECT c_custkey, c_custkey % 2 AS two FROM {customer}", "SELECT c_custkey, two = 0 AS ok, (CASE two WHEN 0 THEN 0 ELSE 1 END)::INTEGER AS missing FROM base")
def _(d):
    whole = F.map_from_arrays(payload.names(payload.REQUIRED), F.transform(payload.names(payload.REQUIRED), lambda k: F.when((F.col("two") == 1) & (k == "act_id"), F.lit("")).otherwise(F.lit("v"))))
    return d.select("c_custkey", payload.audit(whole).alias("a")).select("c_custkey", "a.ok", F.size("a.missing_required").alias("missing"))


@query("g05_resume_set", "SELECT l_orderkey, l_linenumber FROM {lineitem}", "SELECT l_orderkey, count(*) AS n FROM base WHERE l_orderkey NOT IN (SELECT l_orderkey FROM base WHERE l_linenumber >= 5) GROUP BY 1")
def _(d):
    return rows.resume(d, d.where("l_linenumber >= 5"), "l_orderkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("t23_part_footer", "SELECT s_suppkey, s_name, concat('', s_nationkey) AS k FROM {supplier}", "SELECT s_suppkey, s_name AS title, 'H ' || k AS history, 'N1' || chr(10) || 'N2' AS note, 'b' AS body FROM base")
def _(d):
    block = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("text"))
    blocks = F.array(block("title", F.col("s_name")), block("note", F.lit("N1")), block("p", F.lit("b")), block("history", F.concat(F.lit("H "), F.col("k"))), block("note", F.lit("N2")))
    return d.select("s_suppkey", segment.routed(blocks).alias("r")).select("s_suppkey", "r.*")


@query("t24_any_depth", """SELECT s_suppkey, concat(chr(123), '"a": [', chr(123), '"b": ', chr(123), '"Body": "', s_name, '", "n": 1', chr(125), chr(125), ']', chr(125)) AS j FROM {supplier}""", "SELECT s_suppkey, json_extract_string(j, '$.a[0].b.Body') AS body FROM base")
def _(d):
    return d.select("s_suppkey", trees.any_depth(F.col("j"), "Body").alias("body"))


# Composite rows of whole pages, and operators of contents and levels.
@query("t04_three_levels", "SELECT s_suppkey, concat('ARTICLE I', chr(10), 'SECTION I', chr(10), '1. One ', s_suppkey, chr(10), '2. Two', chr(10), 'SECTION II', chr(10), 'whole', chr(10), 'ARTICLE II', chr(10), 'bare ', s_name) AS t, s_name FROM {supplier}", """SELECT s_suppkey, u.a AS article, u.s AS section, u.p AS paragraph, u.b AS body FROM (SELECT s_suppkey, unnest([
  {'a': 'ARTICLE I', 's': 'SECTION I', 'p': '1.', 'b': 'One ' || s_suppkey}, {'a': 'ARTICLE I', 's': 'SECTION I', 'p': '2.', 'b': 'Two'}, {'a': 'ARTICLE I', 's': 'SECTION II', 'p': '0', 'b': 'whole'}, {'a': 'ARTICLE II', 's': '0', 'p': '0', 'b': 'bare ' || s_name}]) AS u FROM base)""")
def _(d):
    return segment.levels(d, "t", article=r"(?m)^ARTICLE [IVX]+$", section=r"(?m)^SECTION [IVX]+$", paragraph=r"(?m)^\d+\.").select("s_suppkey", "article", "section", "paragraph", "body")


@query("t15_ruling_rows", "SELECT s_suppkey, s_name, concat('<html><head><title>SSA</title></head><h1>SSR 82-', s_suppkey, ': ', s_name, '</h1><p>EFFECTIVE: March ', s_suppkey % 28 + 1, ', 1982</p><p>See AR 92-', s_suppkey, '(9) and 20 CFR 404.', s_suppkey, '.</p></html>') AS html FROM {supplier}", "SELECT s_suppkey, 'SSR 82-' || s_suppkey AS number, s_name AS title, '1982-03-' || lpad((s_suppkey % 28 + 1)::VARCHAR, 2, '0') AS effective, 'SSR 82-' || s_suppkey || '|AR 92-' || s_suppkey || '(9)' AS rulings, '404.' || s_suppkey AS regulations FROM base")
def _(d):
    r = pages.ruling(F.col("html"))
    return d.select("s_suppkey", r.alias("r")).select("s_suppkey", "r.number", "r.title", "r.effective", bar("r.rulings").alias("rulings"), bar("r.regulations").alias("regulations"))


@query("t16_bulletin_rows", "SELECT s_suppkey, concat('26 CFR 601.105', chr(10), 'Rev. Proc. 2020-', s_suppkey, chr(10), 'SECTION 1. PURPOSE', chr(10), 'This modifies Rev. Proc. 2019-', s_suppkey, ' and  Notice 2018-4.', chr(10), 'Effective January ', s_suppkey % 28 + 1, ', 2020.') AS t FROM {supplier}", "SELECT s_suppkey, 'Rev. Proc. 2020-' || s_suppkey AS number, 'Rev. Proc.' AS kind, 2020 AS year, 'Rev. Proc. 2019-' || s_suppkey AS modifies, '2020-01-' || lpad((s_suppkey % 28 + 1)::VARCHAR, 2, '0') AS effective FROM base")
def _(d):
    return d.select("s_suppkey", pages.bulletin(F.col("t")).alias("b")).select("s_suppkey", "b.number", "b.kind", "b.year", bar(F.col("b.links")["modifies"]).alias("modifies"), "b.effective")


@query("t17_contents_sections", "SELECT s_suppkey, s_suppkey % 90 + 10 AS ch, concat('Chapter', chr(10), s_suppkey % 90 + 10, '.01 One. ', s_suppkey % 90 + 10, '.02  Two', chr(10), s_suppkey % 90 + 10, '.02 again 99.01', chr(10), 'History: ', s_suppkey % 90 + 10, '.55 x') AS t FROM {supplier}", "SELECT s_suppkey, ch || '.01|' || ch || '.02' AS sections FROM base")
def _(d):
    return d.select("s_suppkey", bar(contents.front_sections(F.col("t"), F.col("ch").cast("string"))).alias("sections"))


@query("t18_version_slices", "SELECT s_suppkey, concat('(Text of Section before amendment)', chr(10), 'old ', s_suppkey, chr(10), '(Text of Section after amendment)', chr(10), 'new') AS t FROM {supplier}", "SELECT s_suppkey, u.id AS id, u.b AS body FROM (SELECT s_suppkey, unnest([{'id': 's' || s_suppkey, 'b': 'old ' || s_suppkey}, {'id': 's' || s_suppkey || '-v2', 'b': 'new'}]) AS u FROM base)")
def _(d):
    return contents.versions(d, F.concat(F.lit("s"), F.col("s_suppkey")), "t", r"(?m)^\(Text of Section [a-z ]+\)$").select("s_suppkey", "id", "body")


@query("t19_flat_tree", "SELECT s_suppkey AS node, CASE WHEN s_suppkey % 10 = 1 THEN NULL ELSE s_suppkey - 1 END AS parent, s_name AS label FROM {supplier}", ", walk AS (SELECT node, 0 AS depth, label FROM base WHERE parent IS NULL UNION ALL SELECT b.node, w.depth + 1, b.label FROM base b JOIN walk w ON b.parent = w.node)\n--\nSELECT node, depth, repeat('  ', depth) || label AS line FROM walk")
def _(d):
    return trees.flat(d, "node", "parent", "label").select("node", "depth", "line")


@query("j11_stub_titles", "SELECT l_orderkey, l_linenumber, l_partkey FROM {lineitem}", ", stub AS (SELECT DISTINCT l_orderkey, 'Stub ' || l_orderkey AS t FROM base WHERE l_linenumber = 2)\n--\nSELECT b.l_orderkey, b.l_linenumber, coalesce(s.t, 'Own ' || l_partkey) AS title FROM base b LEFT JOIN stub s ON s.l_orderkey = b.l_orderkey AND b.l_linenumber = 1")
def _(d):
    parsed = d.select(F.concat_ws(".", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("number"), "l_orderkey", "l_linenumber", F.concat(F.lit("Own "), "l_partkey").alias("title"))
    stubs = d.where("l_linenumber = 2").select(F.concat(F.col("l_orderkey").cast("string"), F.lit(".1")).alias("number"), F.concat(F.lit("Stub "), "l_orderkey").alias("title"))
    return contents.titled(parsed, stubs, "number", "title").select("l_orderkey", "l_linenumber", "title")


@query("t20_sibling_slices", "SELECT s_suppkey, concat('<h2>.01 Old</h2><p>a ', s_suppkey, '</p><p>b</p><h2>.02 Kept</h2><p>c</p>') AS html FROM {supplier}", "SELECT s_suppkey, u.n AS number, u.t AS title, u.b AS body FROM (SELECT s_suppkey, unnest([{'n': '.01', 't': 'Stub ' || s_suppkey, 'b': 'a ' || s_suppkey || chr(10) || 'b'}, {'n': '.02', 't': 'Kept', 'b': 'c'}]) AS u FROM base)")
def _(d):
    stubs = d.select("s_suppkey", F.lit(".01").alias("number"), F.concat(F.lit("Stub "), "s_suppkey").alias("title"))
    return contents.sibling_slices(d, "s_suppkey", "html", stubs).select("s_suppkey", "number", "title", "body")


@query("x12_inline_text", "SELECT s_suppkey, s_name, concat('<text>The <em>', s_name, '</em> &amp; <ref href=\"x\">§ ', s_suppkey, '</ref>  of', chr(10), ' it</text>') AS xml FROM {supplier}", "SELECT s_suppkey, 'The ' || s_name || ' & § ' || s_suppkey || ' of it' AS t FROM base")
def _(d):
    return d.select("s_suppkey", text.inline_text(F.col("xml")).alias("t"))


@query("s14_granule_records", "SELECT s_suppkey, s_name, concat('<mods><relatedItem ID=\"id-G', s_suppkey, '\"><titleInfo><title>', s_name, '</title></titleInfo><extension><accessId>G', s_suppkey, '</accessId><granuleClass>SECTION</granuleClass></extension></relatedItem><relatedItem ID=\"id-X\"><titleInfo><title>T</title></titleInfo></relatedItem></mods>') AS xml FROM {supplier}", "SELECT s_suppkey, u.g AS granule, u.t AS title, u.c AS class FROM (SELECT s_suppkey, unnest([{'g': 'G' || s_suppkey, 't': s_name, 'c': 'SECTION'}, {'g': 'X', 't': 'T', 'c': NULL}]) AS u FROM base)")
def _(d):
    return trees.granules(d, "s_suppkey", "xml").select("s_suppkey", "granule", "title", "class")


@query("s15_inherited_act", "SELECT s_suppkey, s_name, concat('<doc><statute><name>', s_name, '</name><section><no>1.', s_suppkey, '</no><body>one</body></section><section><no>2</no><body>two</body></section></statute><section><no>3</no><body>three</body></section></doc>') AS xml FROM {supplier}", "SELECT s_suppkey, u.a AS act, u.n AS number, u.b AS body FROM (SELECT s_suppkey, unnest([{'a': s_name, 'n': '1.' || s_suppkey, 'b': 'one'}, {'a': s_name, 'n': '2', 'b': 'two'}, {'a': NULL, 'n': '3', 'b': 'three'}]) AS u FROM base)")
def _(d):
    return trees.inherited(d, "s_suppkey", "xml", outer="statute", name="name", inner="section", number="no", body="body").select("s_suppkey", F.col("context").alias("act"), "number", "body")


@query("s17_omitted_sections", "SELECT s_suppkey, s_name, concat('<section><num>', s_suppkey, '</num><heading>', s_name, '</heading>', CASE WHEN s_suppkey % 2 = 0 THEN '<text>body</text>' ELSE '<annotations>Omitted.</annotations>' END, '</section>') AS xml FROM {supplier}", "SELECT s_suppkey, s_name AS heading, CASE WHEN s_suppkey % 2 = 0 THEN 'body' ELSE '[Omitted] ' || s_name || '. Omitted.' END AS body FROM base")
def _(d):
    return d.select("s_suppkey", trees.section(F.col("xml")).alias("s")).select("s_suppkey", "s.heading", "s.body")


@query("g09_rights", "SELECT s_suppkey, s_nationkey FROM {supplier}", "SELECT s_suppkey, 'public_domain' AS snapshot_license, 'US' AS country_code FROM base")
def _(d):
    return payload.with_rights(d, "public_domain", "US").select("s_suppkey", "snapshot_license", "country_code")
