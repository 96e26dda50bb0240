"""Sources as DataFrames: JSON lines, XML, ZIP members, fixed-width and quoted dumps, page words."""

from __future__ import annotations

import re
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.status import file_kind, manifest_entry
from lexmill.functions.text import present


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S-01: records of a schema; blank and malformed lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def known_keys(records: DataFrame, key: str = "metadata.act_id") -> DataFrame:
    """S-02: the distinct keys already written."""
    return records.select(F.col(key).alias("act_id")).where("act_id is not null").distinct()


def xml_rows(spark: SparkSession, path: str, tag: str, schema: str | None = None) -> DataFrame:
    """S-03, S-04, S-13 to S-19: a row for each element of a tag, read in parallel by splits."""
    reader = spark.read.format("xml").option("rowTag", tag)
    return (reader.schema(schema) if schema else reader).load(path)


ECFR_PART = "_N string, _TYPE string, HEAD string, AUTH struct<PSPACE: string>, SOURCE struct<PSPACE: string>, DIV8 array<struct<_N: string, _TYPE: string, HEAD: string, P: array<string>>>, DIV6 array<struct<_N: string, HEAD: string, DIV8: array<struct<_N: string, _TYPE: string, HEAD: string, P: array<string>>>>>"


def ecfr_sections(parts: DataFrame) -> DataFrame:
    """S-03, S-04 and H-07: sections of PART rows with the part's authority and source; paragraphs joined by line ends."""
    none = F.expr("cast(array() as array<struct<_N: string, _TYPE: string, HEAD: string, P: array<string>>>)")
    direct = F.transform(F.coalesce("DIV8", none), lambda s: F.struct(F.lit("").alias("subpart"), s.alias("s")))
    nested = F.flatten(F.transform(F.coalesce("DIV6", F.expr("cast(array() as array<struct<_N: string, HEAD: string, DIV8: array<struct<_N: string, _TYPE: string, HEAD: string, P: array<string>>>>>)")), lambda d: F.transform(F.coalesce(d["DIV8"], none), lambda s: F.struct(d["_N"].alias("subpart"), s.alias("s")))))
    rows = parts.select(F.col("_N").alias("part"), F.col("HEAD").alias("part_name"), F.col("AUTH.PSPACE").alias("authority"), F.col("SOURCE.PSPACE").alias("source"), F.explode(F.concat(direct, nested)).alias("x"))
    rows = rows.select("part", "part_name", "authority", "source", "x.subpart", F.col("x.s._N").alias("section_number"), F.col("x.s.HEAD").alias("heading"), F.array_join("x.s.P", "\n").alias("text"))
    return rows.where(F.length("text") >= 10)


def opened(path: str):  # noqa: ANN201
    """A seekable file of any store that Arrow reads, of which only what is asked for is read."""
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))
    return store.open_input_file(at)


def zip_entries(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """S-07 and S-08: (archive, member, size, error) from the archives' directories alone; one row with an error for what is no archive."""

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["path"]:
                try:
                    with opened(archive) as f, zipfile.ZipFile(f) as z:
                        rows = [(archive, m.filename, m.file_size, None) for m in z.infolist() if not m.is_dir()]
                except (zipfile.BadZipFile, OSError, ValueError) as e:
                    rows = [(archive, None, None, str(e))]
                yield pd.DataFrame(rows, columns=["archive", "member", "size", "error"]).astype({"size": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
    return files.mapInPandas(entries, "archive string, member string, size bigint, error string")


def zip_bodies(entries: DataFrame, share: int = 32) -> DataFrame:
    """S-08 and S-09: entries with body, each member read by its own range; an archive's members are dealt over as many as `share` tasks."""

    def bodies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, own in batch.groupby("archive", sort=False):
                out, errors = [None] * len(own), list(own["error"])
                if own["member"].notna().any():
                    try:
                        with opened(archive) as f, zipfile.ZipFile(f) as z:
                            for i, m in enumerate(own["member"]):
                                try:
                                    out[i] = z.read(m) if m is not None else None
                                except (zipfile.BadZipFile, zlib.error, KeyError, NotImplementedError) as e:
                                    errors[i] = str(e)
                    except (zipfile.BadZipFile, OSError, ValueError) as e:
                        errors = [str(e)] * len(own)
                yield own.assign(body=out, error=errors)

    dealt = entries.withColumn("size", F.coalesce("size", F.lit(0))).repartition(F.col("archive"), F.pmod(F.xxhash64("member"), F.lit(share)))
    return dealt.mapInPandas(bodies, "archive string, member string, size bigint, error string, body binary")


def zip_members(spark: SparkSession, path: str, pattern: str = ".*") -> DataFrame:
    """S-05, S-06, S-08 and S-09: (archive, member, size, error, body, kind) of every file of every archive; what cannot be read has an error and no body."""
    wanted = zip_entries(spark, path).where(F.col("member").isNull() | F.col("member").rlike(pattern))
    return zip_bodies(wanted).withColumn("kind", file_kind(F.col("member")))


def member_counts(members: DataFrame) -> DataFrame:
    """S-07 and A-16: files and bytes by archive and kind, with totals."""
    return members.rollup("archive", "kind").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def dump_fields(line: Column) -> Column:
    """S-10: fields of a tab-separated line, back quotes off, NULL and blanks null."""
    return F.transform(F.split(line, "\t"), lambda f: F.nullif(present(F.trim(F.regexp_replace(f, "^`|`$", ""))), F.lit("NULL")))


def code_names(lines: DataFrame, line: str = "value") -> DataFrame:
    """S-11: (code, name) of a dump of codes."""
    return lines.select(dump_fields(F.col(line)).alias("f")).select(F.upper(F.get("f", F.lit(0))).alias("code"), F.get("f", F.lit(1)).alias("name")).where("code is not null")


def contents_rows(lines: DataFrame, line: str = "value") -> DataFrame:
    """H-10: (code, node_id, heading, depth, path, parent_path, level, number) of a dump of contents."""
    f = lines.select(dump_fields(F.col(line)).alias("f"))
    at = lambda i: F.coalesce(F.get("f", F.lit(i)), F.lit(""))
    rows = f.select(F.upper(at(1)).alias("code"), at(0).alias("node_id"), at(2).alias("heading"), F.coalesce(at(3).try_cast("int"), F.lit(0)).alias("depth"), at(4).alias("path")).where("node_id <> '' and code <> ''")
    level = r"(?i)^(TITLE|PART|DIVISION|CHAPTER|ARTICLE|SUBDIVISION|SUBCHAPTER)\s+([\dIVXLCA-Z.]+)"
    return rows.withColumns({"parent_path": F.regexp_extract("path", r"^(.*)\.[^.]+$", 1), "level": F.lower(F.regexp_extract("heading", level, 1)), "number": F.rtrim(F.regexp_extract("heading", level, 2), F.lit("."))})


def manifest(lines: DataFrame, line: str = "value") -> DataFrame:
    """S-12."""
    return lines.select(manifest_entry(F.col(line)).alias("e")).where("e is not null").select("e.*")


def rule_bodies(rules: DataFrame) -> DataFrame:
    """S-13: (document_number, body) of at least 100 characters; the last of equal numbers by position."""
    rows = rules.where(F.length("body") >= 100)
    return rows.groupBy("document_number").agg(F.max(F.struct("pos", "body")).alias("b")).select("document_number", "b.body")


def page_text(words: DataFrame, columns: int = 1, sep: str = "\n\n") -> DataFrame:
    """S-24 to S-26: (doc, text) of page words (doc, page, width, x, y, text), read column by column; blank pages are left out."""
    placed = words.withColumn("col", F.least(F.floor(F.col("x") / (F.col("width") / columns)), F.lit(columns - 1)))
    lines = placed.groupBy("doc", "page", "col", "y").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("x", "text"))), lambda w: w["text"]), " ").alias("line"))
    pages = lines.groupBy("doc", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("col", "y", "line"))), lambda w: w["line"]), "\n").alias("text")).where(F.trim("text") != "")
    return pages.groupBy("doc").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "text"))), lambda p: p["text"]), sep).alias("text"))


def docx_text(spark: SparkSession, path: str) -> DataFrame:
    """S-27 and S-29: (path, text) of word files: paragraphs, then table rows with cells joined by ` | `; null where there is none to read."""
    files = zip_bodies(zip_entries(spark, path, "*.docx").where("member = 'word/document.xml' or member is null"))
    return files.select(F.col("archive").alias("path"), docx_body(F.col("body")).alias("text"))


@F.pandas_udf(T.StringType())
def docx_body(bodies: pd.Series) -> pd.Series:
    from xml.etree import ElementTree

    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

    def text(el) -> str:  # noqa: ANN001
        return "".join(t.text or "" if t.tag == w + "t" else "\t" for t in el.iter() if t.tag in (w + "t", w + "tab"))

    def one(body: bytes | None) -> str | None:
        try:
            top = ElementTree.fromstring(body).find(w + "body") if body is not None else None
        except ElementTree.ParseError:
            top = None
        if top is None:
            return None
        parts = [text(p).rstrip() for p in top.findall(w + "p")]
        for row in top.iter(w + "tr"):
            cells = [" ".join(text(p) for p in c.iter(w + "p")).strip() for c in row.findall(w + "tc")]
            if any(cells):
                parts.append(" | ".join(cells))
        return "\n".join(parts).strip()

    return bodies.map(one)
