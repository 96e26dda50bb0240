"""Readers and writers over small files, and markup that only Python can read."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from lexmill.operators import contents, rows, segment
from lexmill.sinks import writers
from lexmill.sources import markup, readers
from lexmill.streaming import ingest


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"act_id": "A", "n": 1}\n\n{broken\n{"act_id": "B", "n": 2}\n')
    got = readers.json_lines(spark, str(tmp_path), "act_id string, n int").orderBy("act_id").collect()
    assert [(r.act_id, r.n) for r in got] == [("A", 1), ("B", 2)]


def test_zip_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "t.zip", "w") as z:
        z.writestr("USCODE-2024-title1-chap1-sec1.htm", "<p>x</p>")
        z.writestr("USCODE-2024-title1-toc.htm", "toc")
    members = readers.zip_members(spark, str(tmp_path))
    assert {r.kind: r.size for r in members.collect()} == {"section": 8, "toc": 3}
    totals = {(r.kind, r.files) for r in readers.member_counts(members).collect()}
    assert (None, 2) in totals


def test_ecfr(spark, tmp_path):
    (tmp_path / "e.xml").write_text(
        """<ECFR><DIV5 N="240" TYPE="PART"><HEAD>PART 240—RULES</HEAD><AUTH><PSPACE>15 U.S.C. 78a</PSPACE></AUTH><SOURCE><PSPACE>13 FR 1</PSPACE></SOURCE>
        <DIV8 N="240.1" TYPE="SECTION"><HEAD>§ 240.1 Terms.</HEAD><P>First paragraph.</P><P>Second one.</P></DIV8>
        <DIV6 N="A"><HEAD>Subpart A</HEAD><DIV8 N="240.2" TYPE="SECTION"><HEAD>§ 240.2</HEAD><P>Another paragraph.</P></DIV8></DIV6></DIV5></ECFR>"""
    )
    parts = readers.xml_rows(spark, str(tmp_path / "e.xml"), "DIV5", readers.ECFR_PART)
    got = {r.section_number: r for r in readers.ecfr_sections(parts).collect()}
    assert got["240.1"].text == "First paragraph.\nSecond one." and got["240.1"].authority == "15 U.S.C. 78a"
    assert got["240.2"].subpart == "A"


def test_docx(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = f"<w:document {w}><w:body><w:p><w:r><w:t>One</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", body)
    (tmp_path / "x.docx").write_bytes(data.getvalue())
    assert [r.text for r in readers.docx_text(spark, str(tmp_path)).collect()] == ["One\na | b"]


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("{\\*\\bkmk skip}Chapter 1\\par A \\'e9 \\u8217?s \\{x\\}", "Chapter 1 A \u00e9 \u2019s {x}"),
        ("un\r\nless", "unless"),
    ],
)
def test_rtf(given, wanted):
    assert markup.rtf_text(given) == wanted


def test_rtf_sections(spark):
    rtf = r"{\rtf1 x\pard\s1 TITLE 2\par\pard\s2 2:1-1. First\par\pard\s3 Body one.\par\pard\s3 More.\par\pard\s2 2:1-2. Second\par\pard\s3 Body two.}"
    df = spark.createDataFrame([(1, rtf)], "doc int, rtf string")
    got = markup.rtf_sections(df, "doc", "rtf", {1: "title", 2: "section"}).orderBy("section").collect()
    assert [(r.title, r.section, r.text) for r in got] == [("TITLE 2", "2:1-1. First", "Body one.\nMore."), ("TITLE 2", "2:1-2. Second", "Body two.")]


def test_caml():
    ns = 'xmlns:caml="x"'
    assert markup.caml_text(f"<p {ns}>1<caml:Fraction><caml:Numerator>1</caml:Numerator><caml:Denominator>4</caml:Denominator></caml:Fraction> days</p>")[0] == "1 1/4 days"
    assert markup.caml_text("<p>(<caml:Fraction><caml:Numerator>4</caml:Numerator><caml:Denominator>5</caml:Denominator></caml:Fraction>)</p>")[0] == "(4/5)"
    text, unknown = markup.caml_text("<p>(a)<span class='EnSpace'/>This <odd>is</odd></p><table><tr><td>x</td><td>y</td></tr></table>")
    assert text == "(a) This is\n\nx y" and unknown == ["odd"]


def test_html():
    assert markup.html_text("<head><title>t</title></head><p>a &amp; b</p><script>x</script><div>c</div>") == "a & b\n\nc"
    assert markup.block_text("<div>a<p>b</p></div>") == "a b\nb"
    assert markup.register_text("<RULE><P>one</P><PRTPAGE P='1'/>lost<P>two</P></RULE>") == "one\n\ntwo"


def test_rendered():
    xml = "<section><div class='subsection'><div class='heading'>1. Name</div><p>text</p><div class='para'><div class='heading'>a.</div><p>inner</p></div></div><div class='history'>[C73]</div></section>"
    assert markup.rendered(xml) == "(1) text\n(1) (a) inner\n[C73]"


def test_doc_text():
    blob = b"\x00\x01junk 26-239 DEPARTMENT OF THE ATTORNEY\r\nRule text is here. " + b"word " * 100 + bytes(range(1, 9)) * 100
    got = markup.doc_text(blob)
    assert got.startswith("26-239 DEPARTMENT") and len(got) < 900


def test_segments(spark):
    df = spark.createDataFrame([("x § 1. One\nbody § 2. Two",), ("",), (None,)], "text string")
    got = df.select(segment.segments(F.col("text"), r"§ \d+\.").alias("s")).collect()
    assert [(s.header, s.body) for s in got[0].s] == [("§ 1.", "One\nbody"), ("§ 2.", "Two")]
    assert got[1].s == [] and got[2].s is None


def test_glued(spark):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(["A.", "one", "(1)", "(a)", "two", "B."])], "d int, pos int, t string")
    got = rows.glued(df, ["d"], "pos", "t", F.col("t").rlike(r"^(\([0-9A-Za-z]+\)|[0-9A-Za-z]{1,4}[.])$")).orderBy("pos").collect()
    assert [r.t for r in got] == ["A. one", "(1) (a)", "two", "B."]


def test_merge_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    new = spark.createDataFrame([("A", 1), ("B", 2)], "act_id string, n int")
    assert writers.merge(spark, new, path, "act_id") == 2
    assert writers.merge(spark, new, path, "act_id") == 2
    assert writers.merge(spark, spark.createDataFrame([("B", 3), ("C", 4)], "act_id string, n int"), path, "act_id") == 3
    assert {(r.act_id, r.n) for r in spark.read.parquet(path).collect()} == {("A", 1), ("B", 3), ("C", 4)}


def test_stream_appends_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p1", "a")], "point_id string, t string").write.parquet(source)
    stream = ingest.file_stream(spark, source, "point_id string, t string")
    for checkpoint in ("c1", "c2"):  # a second run from scratch replays all input
        ingest.append_new(stream, target, str(tmp_path / checkpoint)).awaitTermination()
    assert sorted(r.point_id for r in spark.read.parquet(target).collect()) == ["p1", "p2"]


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").orderBy("ts")
    events.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    query = ingest.windowed_counts(stream).writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    query.awaitTermination()
    key = ["start", "event_type", "n"]
    assert spark.table("windows").select(*key).exceptAll(ingest.windowed_counts(events).select(*key)).isEmpty()


def test_bad_rows_do_not_fail():
    assert markup.rtf_text(r"a\'zzb \u-10179?\u-8704? {\*\x skip {y} z} \{q\} un" + "\r\nless") == "ab �� {q} unless"
    assert markup.caml_text("<p>a & b") == ("a & b", []) and markup.caml_text("</p>x</td>")[0] == "x"
    assert markup.register_text("") == "" and markup.rendered("<div>") is None
    assert markup.html_text("<p>a<script>if (a<b) {'</p>'}</script>b<br/>c &amp; &eacute; <") == "ab\nc & é <"
    assert markup.block_text("<ul><li>a<p>b</li><li>c</ul>") == "a b\nb\nc"


def test_archives(spark, tmp_path):
    """Members are listed from directories and read one by one; what is no archive, or not a whole one, has an error."""
    with zipfile.ZipFile(tmp_path / "t.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(40):
            z.writestr(f"m{i}.xml", f"<a>{i}</a>" * (i + 1))
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    entries = readers.zip_entries(spark, str(tmp_path))
    assert entries.where("error is null").count() == 40 and entries.where("member is null").count() == 1
    rows = readers.zip_members(spark, str(tmp_path)).collect()
    assert {r.member: bytes(r.body) for r in rows if r.member} == {f"m{i}.xml": f"<a>{i}</a>".encode() * (i + 1) for i in range(40)}
    assert [r.error is None for r in rows if r.member is None] == [False]
    assert readers.zip_members(spark, str(tmp_path), r"^m1\.").where("error is null").count() == 1
    (tmp_path / "x.docx").write_bytes(b"no word file")
    assert [r.text for r in readers.docx_text(spark, str(tmp_path)).collect()] == [None]


def test_swap_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2):
        writers.swap(spark.createDataFrame([(n,)], "n int"), path)
        assert [r.n for r in spark.read.parquet(path).collect()] == [n]
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]


def test_levels_and_contents(spark):
    df = spark.createDataFrame([(1, "x\nARTICLE I\n1. a\n2. b\nARTICLE II\nc"), (2, None), (3, "")], "d int, t string")
    got = segment.levels(df, "t", article=r"(?m)^ARTICLE [IVX]+$", section=r"(?m)^\d+\.").select("d", "article", "section", "body").collect()
    assert sorted(map(tuple, got)) == [(1, "ARTICLE I", "1.", "a"), (1, "ARTICLE I", "2.", "b"), (1, "ARTICLE II", "0", "c")]
    none = contents.versions(df, F.col("d").cast("string"), "t", "NOWHERE").select("id", "body").collect()
    assert ("1", "x\nARTICLE I\n1. a\n2. b\nARTICLE II\nc") in {tuple(r) for r in none}
