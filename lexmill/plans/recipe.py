"""How a query is stated: one base relation in SQL that Spark and the oracle share, and what is done with it.

The base is written in SQL that both engines read, with tables in braces. Spark applies
Column builders or operators to it, the oracle plain SQL to the relation `base`.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexmill.session import shipped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def relation(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    shipped(spark)
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def plain(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def query(name: str, base: str, oracle: str | None = None):  # noqa: ANN201
    """Register fn(base relation) under a name; oracle is SQL over `base`, which may begin with further relations."""

    def add(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(relation(spark, sf_dir, base))
        if oracle is not None:
            head, body = ("", oracle) if not oracle.lstrip().startswith(",") else (oracle[: oracle.index("\n--\n")], oracle[oracle.index("\n--\n") + 4 :])
            ORACLE[name] = f"WITH RECURSIVE base AS ({plain(base)}){head}\n{body}"
        return fn

    return add


#: Bases that several queries share.
DOCS = "SELECT doc_id, text, source, lang FROM {documents}"
PAGES = "SELECT page_id, url, html FROM {pages}"
NODES = """SELECT s_suppkey, n_nationkey, r_name, concat('us/', lower(substring(r_name, 1, 2)), '/statutes/title=', n_nationkey, '/chapter=', s_suppkey % 7, '/section=', s_suppkey) AS node_id,
  lower(substring(r_name, 1, 2)) AS st, s_name AS heading, cast(s_suppkey % 3 as int) AS third FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""
AUTHORITY = """SELECT p_size AS cfr_title, concat('', l_suppkey) AS part, p_name AS part_name, concat(l_linenumber, ' U.S.C. ', l_partkey) AS authority, l_orderkey, l_linenumber FROM {lineitem} JOIN {part} ON l_partkey = p_partkey"""
CREDITS = """SELECT o_orderkey, concat('Pub. L. ', o_custkey % 117 + 1, '-', o_orderkey % 500 + 1, ', title IV, §', o_custkey % 90 + 1, '(a), ', CASE month(o_orderdate) % 4 WHEN 0 THEN 'Dec.' WHEN 1 THEN 'Jan.' WHEN 2 THEN 'Sept.' ELSE 'July' END, ' ', day(o_orderdate), ', ', year(o_orderdate), ', ',
  o_custkey, ' Stat. ', o_orderkey, '; ', CASE WHEN o_orderkey % 2 = 0 THEN 'R.S. §' ELSE 'Act of July 30, 1947, ch. ' END, o_orderkey % 999, ', 61 Stat. 633; unknown.') AS credit, o_orderdate FROM {orders}"""
