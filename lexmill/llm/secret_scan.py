"""Secret scans with multipart credential linking, with DataFrame functions only.

Strong patterns (assignments, access keys, long hex runs) are reported wherever they occur.
Weak parts are reported only where a complementary part lies in the same scope, that is,
within SCOPE characters: a weak secret next to an access identifier, a weak identifier next
to a secret, an endpoint next to both. The join of the intervals runs inside each row, over
the few parts of one document, so no document's parts leave their row and nothing shuffles.

Positions come from the lengths of the pieces between matches: split and regexp_extract_all
both go through the text by the leftmost match that does not overlap the one before. Matches
are placed in blocks of BLOCK, after the blocks' own places are known, and a part looks for
others only in the blocks that reach into its scope, so a long text with very many matches
takes little more than its share of the time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters between linked parts, matches of a block.
SCOPE, BLOCK = 200, 256
#: Fixed patterns: (kind, a cheap test, pattern, least characters, the group they are counted in).
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]""", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("access", "AKIA[A-Z0-9]{16}", "AKIA[A-Z0-9]+", 20, 0),
    ("hex", "[0-9a-f]{24}", "[0-9a-f]{24,}", 24, 0),
)
WEAK = (
    ("id", r"""(?i)(user_?name|user|login|client_?id|account_?id|key_?id)["']?\x20*[:=]""", r"""(?i)(user_?name|user|login|client_?id|account_?id|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", 3, 2),
    ("key", "[A-Za-z0-9+/_=-]{16}", "[A-Za-z0-9+/_=-]{16,}", 16, 0),
    ("endpoint", "(?i)(https?|ftp|postgres|postgresql|mysql|mongodb|redis|amqp)://", r"""(?i)(https?|ftp|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+""", 10, 0),
)
KINDS = tuple(k[0] for k in BASE + WEAK)
NONE = "cast(array() as array<struct<start: int, kind: int, stop: int>>)"


def found(text: Column, kind: str, test: str, pattern: str, least: int, group: int) -> Column:
    """array<struct<start, kind, stop>> of the pattern's matches whose group has so many characters; code points, end exclusive."""
    k = KINDS.index(kind)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    steps = F.zip_with(F.split(text, pattern, -1), F.arrays_zip(whole.alias("w"), part.alias("p")), lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["w"]).alias("n"), m["p"].alias("p")))
    keep = lambda s: (F.length(s["p"]) >= least) & ((s["p"].rlike("[0-9]") & s["p"].rlike("[A-Z]") & s["p"].rlike("[a-z]")) if kind == "key" else F.lit(True))

    def add(acc: Column, s: Column) -> Column:
        at = acc["at"] + s["gap"]
        span = F.struct(at.alias("start"), F.lit(k).alias("kind"), (at + s["n"]).alias("stop"))
        return F.struct((at + F.coalesce(s["n"], F.lit(0))).alias("at"), F.when(s["n"].isNotNull() & keep(s), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def placed(blocks: Column) -> Column:
        size = lambda b: F.aggregate(b, F.lit(0), lambda a, s: a + s["gap"] + F.coalesce(s["n"], F.lit(0)))
        first = F.aggregate(blocks, F.array(F.lit(0)), lambda a, b: F.concat(a, F.array(F.get(a, F.size(a) - 1) + size(b))))
        inside = lambda b, at: F.aggregate(b, F.struct(at.alias("at"), F.expr(NONE).alias("out")), add, lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, F.slice(first, F.lit(1), F.size(blocks)), inside))

    return F.when(text.rlike(test), let(let(steps, cut), placed)).otherwise(F.expr(NONE))


def let(value: Column, use) -> Column:  # noqa: ANN001
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def cut(values: Column) -> Column:
    """Blocks of the array, of BLOCK each; none of an empty one."""
    some = F.transform(F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(BLOCK)), lambda i: F.slice(values, i + 1, F.lit(BLOCK)))
    return F.filter(some, lambda b: F.size(b) > 0)


def reaching(parts: Column, others: Column, scope: int, wanted: bool = True) -> Column:
    """The parts that have one of the others within so many characters, or those that have none; others by start."""

    def meets(a: Column, b: Column) -> Column:
        return (b["start"] < a["stop"] + scope) & (b["stop"] > a["start"] - scope)

    blocks = lambda o: F.transform(cut(o), lambda b: F.struct(b.alias("spans"), F.get(b, F.lit(0))["start"].alias("start"), F.array_max(F.transform(b, lambda s: s["stop"])).alias("stop")))
    found = lambda k, a: F.exists(k, lambda b: meets(a, b) & F.exists(b["spans"], lambda s: meets(a, s)))
    return let(let(others, blocks), lambda k: F.filter(parts, lambda a: found(k, a) == F.lit(wanted)))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with base and spans: arrays of struct(start, kind, stop), kind by place in KINDS, by start, then kind.

    A null text counts as empty and has no spans; rows that repeat, or have no id, have the
    same spans each. Columns of these names are replaced.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.drop("base", "spans", "t__").withColumn("t__", t)
    rows = rows.withColumns({f"{k[0]}__": found(F.col("t__"), *k) for k in BASE}).withColumn("base", F.array_sort(F.concat(*[F.col(f"{k[0]}__") for k in BASE])))
    # A weak part needs another beside it: texts with no identifier have none to report.
    some = F.size("access__") > 0
    weak = {f"{k[0]}__": found(F.col("t__"), *k) for k in WEAK}
    rows = rows.withColumn("id__", weak["id__"])
    linked = some | (F.size("id__") > 0)
    rows = rows.withColumns({c: F.when(linked, weak[c]).otherwise(F.expr(NONE)) for c in ("key__", "endpoint__")})
    rows = rows.withColumns({c: reaching(F.col(c), F.col("base"), 0, False) for c in ("id__", "key__", "endpoint__")})
    ids = F.array_sort(F.concat("access__", "id__"))
    secrets = F.array_sort(F.concat("assign__", "hex__", "key__"))
    keys = reaching(F.col("key__"), ids, SCOPE)
    known = reaching(F.col("id__"), secrets, SCOPE)
    ends = reaching(reaching(F.col("endpoint__"), ids, SCOPE), secrets, SCOPE)
    rows = rows.withColumn("spans", F.when(linked, F.array_sort(F.concat("base", known, keys, ends))).otherwise(F.col("base")))
    return rows.drop("t__", *[f"{k}__" for k in KINDS])


def secrets_digest(docs: DataFrame) -> DataFrame:
    rows = scan(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return rows.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """scan(docs) with the text's spans replaced by `[secret]`, overlapping spans together."""
    rows = scan(docs, text)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col(text), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.when(s["stop"] <= acc["at"], acc["out"]).otherwise(F.concat(acc["out"], gap, F.when(s["start"] >= acc["at"], F.lit("[secret]")).otherwise(F.lit("")))).alias("out"))

    done = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    return rows.withColumn(text, F.when(F.size("spans") > 0, done).otherwise(F.col(text)))


def _spans_sql(kind: str, pattern: str, least: int, group: int) -> str:
    p = pattern.replace("'", "''")
    part = f"regexp_extract_all(t, '{p}', {group})"
    extra = " AND regexp_matches(p[i], '[0-9]') AND regexp_matches(p[i], '[A-Z]') AND regexp_matches(p[i], '[a-z]')" if kind == "key" else ""
    k = KINDS.index(kind)
    return f"""m{k} AS (SELECT doc_id, list_transform(string_split_regex(t, '{p}'), lambda x: length(x)) AS g, regexp_extract_all(t, '{p}') AS w, {part} AS p FROM d),
s{k} AS (SELECT doc_id, [struct_pack(a := (list_sum(g[1:i]) + coalesce(list_sum(list_transform(w[1:i-1], lambda x: length(x))), 0))::BIGINT, k := {k}, n := length(w[i]))
  FOR i IN range(1, len(w) + 1) IF length(p[i]) >= {least}{extra}] AS s FROM m{k}),
e{k} AS (SELECT doc_id, u.a AS a, u.k AS k, u.a + u.n AS b FROM (SELECT doc_id, unnest(s) AS u FROM s{k}))"""


ORACLE = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),\n"
    + ",\n".join(_spans_sql(k, p, n, g) for k, _, p, n, g in BASE + WEAK)
    + f""",
base AS (SELECT * FROM e0 UNION ALL SELECT * FROM e1 UNION ALL SELECT * FROM e2),
weak AS (SELECT w.* FROM (SELECT * FROM e3 UNION ALL SELECT * FROM e4 UNION ALL SELECT * FROM e5) w
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.a < w.b AND b.b > w.a)),
ids AS (SELECT * FROM e1 UNION ALL SELECT * FROM weak WHERE k = 3),
secrets AS (SELECT * FROM base WHERE k <> 1 UNION ALL SELECT * FROM weak WHERE k = 4),
shown AS (SELECT * FROM base UNION ALL SELECT * FROM weak w WHERE
  (k = 3 OR EXISTS (SELECT 1 FROM ids b WHERE b.doc_id = w.doc_id AND b.a < w.b + {SCOPE} AND b.b > w.a - {SCOPE}))
  AND (k = 4 OR EXISTS (SELECT 1 FROM secrets b WHERE b.doc_id = w.doc_id AND b.a < w.b + {SCOPE} AND b.b > w.a - {SCOPE}))),
named AS (SELECT doc_id, a, k, [{', '.join(repr(k) for k in KINDS)}][k + 1] || ':' || a || ':' || b AS s FROM shown),
g AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg(s, ',' ORDER BY a, k) FILTER (k < 3) AS base, string_agg(s, ',' ORDER BY a, k) AS spans FROM named GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)"""
)
