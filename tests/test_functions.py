"""Worked examples through the Column builders."""

import pytest
from pyspark.sql import functions as F

from lexmill.functions import cites, dates, ids, status, text
from lexmill.operators import payload
from lexmill.operators.chunk import chunks


def value(spark, column, **named):
    row = spark.createDataFrame([tuple(named.values())], ", ".join(f"{k} string" for k in named)) if named else spark.range(1)
    out = row.select(column.alias("v")).first().v
    return out.asDict() if hasattr(out, "asDict") else out


def S():  # noqa: N802
    return F.col("s")


@pytest.mark.parametrize(
    ("build", "given", "wanted"),
    [
        (lambda c: ids.act_id(c, F.lit("de")), "us/de/statutes/title=6/chapter=5/section=101", "STATE_DE_T6_C5_S101"),
        (lambda c: ids.act_id(c, F.lit("ca")), "us/ca/statutes/code=civ/division=3/part=4/title=5/chapter=2/section=1950.5", "STATE_CA_Cciv_D3_P4_T5_C2_S1950.5"),
        (status.act_number, "00050", "5"), (status.act_number, "00055", "5.5"), (status.act_number, "01200", "120"),
        (status.chapter_of_section, "22-16-4", "16"), (status.chapter_of_section, "1-1A-1", "1A"),
        (text.act_slug, "Act 328 of 1931", "Act-328-of-1931"), (text.act_slug, "E.R.O. No. 2003-2", "E-R-O-No-2003-2"), (text.act_slug, "Act 31 of 1948 (1st Ex. Sess.)", "Act-31-of-1948-1st-Ex-Sess-"),
        (dates.iso_date, "Dec. 29, 1979", "1979-12-29"), (dates.iso_date, "none", ""), (dates.iso_date, "Feb. 30, 2001", "2001-02-30"),
        (dates.dashed_date, "7/4/31", "07-04-1931"), (dates.dashed_date, "7/4/30", "07-04-2030"), (dates.dashed_date, "x", "x"),
        (dates.last_date, "1/2/49 and 3/4/50", "03/04/1950"), (dates.last_date, "none", ""),
        (cites.enumerated, "1506, 1507, 1508", ["1506", "1507", "1508"]), (cites.enumerated, "1506-1509", ["1506", "1507", "1508", "1509"]), (cites.enumerated, "1-100", ["1-100"]), (cites.enumerated, "5-3", []),
        (cites.usc_references, "see 18 U.S.C. § 1030 and 5 USC section 552a", ["18:1030", "5:552a"]), (cites.usc_references, "see 18 U.S.C. 1030", []),
        (cites.cfr_references, "12 C.F.R. § 226.5", ["12:226.5"]), (cites.public_laws, "Pub. L. 117-103", ["Pub. L. 117-103"]),
        (cites.subsection_letters, "(a) x\n(b) y\n(1) z\n(i) w", ["a", "b", "i"]), (cites.numbered_paragraphs, "(a) x\n(b) y\n(1) z\n(i) w", 2),
        (lambda c: cites.amendment_years(c, F.lit(2026)), "Amended 2018; repealed effective in 2050", [2018]),
        (status.status_of_reason, "Not Fundeded", "not_funded"), (status.status_of_reason, "Applicable 2027", "in_force"), (status.status_of_reason, "", "in_force"),
        (status.file_kind, "x/USCODE-2024-title1-chap1-sec1.htm", "section"), (status.file_kind, "x/USCODE-2024-title1-toc.htm", "toc"), (status.file_kind, "USCODE-2024-title1.pdf", "title"),
        (text.word_count, "", 0), (text.hyphen_title, "subject-group", "Subject-Group"),
        (text.collapse, " a   b\n", "a b"),
    ],
)
def test_golden(spark, build, given, wanted):
    assert value(spark, build(S()), s=given) == wanted


@pytest.mark.parametrize("head", ["[Repealed]", "1234.5. [Repealed by Stats. 1999]", "Repealed by Stats. 2004, ch. 1", "(Repealed by L. 1990)", "Repealed."])
def test_repealed(spark, head):
    assert value(spark, status.is_repealed(S()), s=head) is True


@pytest.mark.parametrize("head", ["This section shall remain in effect only until January 1, 2030, and as of that date is repealed.", "bylaws may be adopted, amended or repealed by the board", "any of the acts repealed by this code"])
def test_not_repealed(spark, head):
    assert value(spark, status.is_repealed(S()), s=head) is False


@pytest.mark.parametrize(("given", "wanted"), [("Every person is entitled to notice.", "b55440be-4dae-8ef5-c6ff-d45dc007dc08"), ("", "b5800671-cefc-991d-2f41-e542c0a427fe")])
def test_point_id(spark, given, wanted):
    assert value(spark, ids.point_id(F.lit("STATE_DE_T6_C5_S101"), F.lit(0), S()), s=given) == wanted


def test_point_ids_differ_only_where_they_should(spark):
    a, b, c = (value(spark, f(F.lit("A"), F.lit(0), S()), s="") for f in (ids.point_id, ids.point_id_hashed, ids.point_id_long))
    assert len({a, b, c}) == 3
    assert value(spark, ids.point_id(F.lit("A"), F.lit(0), S()), s="x") == value(spark, ids.point_id_hashed(F.lit("A"), F.lit(0), S()), s="x")


def test_source_credit(spark):
    raw = "R.S. §1979; Pub. L. 96-170, §1, Dec. 29, 1979, 93 Stat. 1284; Pub. L. 104-317, title III, §309(c), Oct. 19, 1996, 110 Stat. 3853."
    one, two, three = (x.asDict() for x in value(spark, cites.source_credit(S()), s=raw))
    assert (one["type"], one["section"], one["display"]) == ("revised_statutes", "1979", "R.S. §1979")
    assert [two[k] for k in ("type", "congress", "law", "date", "stat_volume", "stat_page", "section")] == ["public_law", 96, 170, "1979-12-29", 93, 1284, "1"]
    assert [three[k] for k in ("title_roman", "section", "date", "stat_page")] == ["III", "309(c)", "1996-10-19", 3853]
    (act,) = (x.asDict() for x in value(spark, cites.source_credit(S()), s="July 30, 1947, ch. 388, 61 Stat. 633"))
    assert [act[k] for k in ("type", "date_text", "date", "stat_volume", "chapter")] == ["act", "July 30, 1947", "1947-07-30", 61, "388"]


def test_authority(spark):
    got = value(spark, cites.authority(S()), s="44 U.S.C. 1506; E.O. 10530, 19 FR 2709, 3 CFR, 1954-1958 Comp., p. 189")
    assert [x.type for x in got] == ["usc", "executive_order", "federal_register", "cfr"]
    assert got[3].ref == "1954-1958 Comp., p. 189" and got[0].display == "44 U.S.C. 1506"
    assert [x.section for x in value(spark, cites.authority(S()), s="15 U.S.C. 78a et seq., 78c, 78d")] == ["78a", "78c", "78d"]
    raw = "15 U.S.C. 78a et seq., 78c, 78d; 44 U.S.C. 1506-1508 and 1510; 5 U.S.C. 552."
    keys = value(spark, cites.usc_keys(S()), s=raw)
    assert keys == [f"{x.title}:{x.section}" for x in value(spark, cites.authority(S()), s=raw)] and "44:1507" in keys and keys[-1] == "5:552"
    assert value(spark, cites.authority(S()), s="44 U.S.C. 1506") == []


def test_histories(spark):
    wa = value(spark, cites.washington_history(S()), s="Statutory Authority: RCW 43.20.050. WSR 91-02-051 (Order 124B), recodified as § 246-100-006, filed 12/27/90, effective 1/31/91; WSR 87-11-047 (Order 302), § 248-100-006, filed 5/19/87.")
    assert (wa["authority"], wa["orders"], wa["filings"], wa["effective"], wa["prior"]) == ("RCW 43.20.050", ["124B", "302"], ["WSR 91-02-051", "WSR 87-11-047"], "1/31/91", "")
    mn = value(spark, cites.minnesota_history(S()), s="19 SR 1419; 19 SR 1637; L 2008 c 328 s 13")
    assert mn == {"registers": ["19 SR 1419", "19 SR 1637"], "laws": ["L 2008 c 328 s 13"]}
    va = value(spark, cites.virginia_history(S()), s="Derived from VR630-1-8, eff. January 1, 1985; amended, Virginia Register Volume 25, Issue 11, eff. March 4, 2009.")
    assert va == {"effective": "March 4, 2009", "prior": "January 1, 1985", "registers": ["Volume 25, Issue 11"], "derived": "VR630-1-8"}


def test_amendment_events(spark):
    md = value(spark, cites.amendment_summary(S(), F.lit("md")), s="ratified Nov. 7, 2006; x ratified Nov. 2, 2010")
    assert md == {"events": 2, "years": [2006, 2010], "last": 2010}
    assert value(spark, cites.amendment_summary(S(), F.lit("tx")), s="(Feb. 15, 1876. Amended Nov. 5, 1918.)")["years"] == [1918]


def test_granule(spark):
    got = value(spark, status.granule(S()), s="USCODE-2024-title42-chap21-subchapI-sec1983")
    assert got == {"year": 2024, "title_number": 42, "subtitle": "", "chapter": "21", "subchapter": "I", "part": "", "subpart": "", "section_number": "1983"}


def test_natural_order(spark):
    rows = spark.createDataFrame([("940.10",), ("940.9",), ("x",)], "s string").orderBy(ids.natural_key(S())).collect()
    assert [r.s for r in rows] == ["940.9", "940.10", "x"]


def test_chunker():
    assert len(chunks("a" * 4003)) == 1
    assert [len(c) for c in chunks("a" * 4004)] == [4000, 404]
    assert [len(c) for c in chunks("x" * 3500 + ". " + "y" * 1000)] == [3500, 1402]
    text_ = "\n\n".join(" ".join(f"Sentence {i}-{j}. It goes on, and on." for j in range(7)) for i in range(200))
    parts, at = chunks(text_), 0
    for p in parts:  # nothing is lost
        at = text_.index(p[:50], max(0, at - 500))
        assert p in text_
        at += len(p)
    assert at == len(text_)


def test_payload(spark):
    fields = F.from_json(S(), "map<string,string>")
    got = value(spark, payload.audit(fields), s='{"text": "", "chunk_index": "0", "history_notes": "a", "odd": "1"}')
    assert "text" in got["missing_required"] and "chunk_index" not in got["missing_required"]
    assert got["unknown"] == ["odd"] and got["deprecated"] == ["history_notes"] and not got["ok"]
    assert value(spark, payload.canonical(fields), s='{"history_notes": "a", "history": "b"}') == {"history": "b"}
    assert value(spark, payload.canonical(fields), s='{"history_note_raw": "c"}') == {"history": "c"}
    assert value(spark, payload.with_defaults(fields), s='{"jurisdiction": ""}') == {"jurisdiction": "US", "country_code": "US"}


def test_walks_go_on_until_nothing_is_left(spark):
    import json

    from lexmill.operators import rows, trees

    edges = spark.createDataFrame([(i, i + 1) for i in range(24)] + [(3, 1), (5, None)], "src bigint, dst bigint")
    got = rows.reachable(edges, spark.range(1).withColumnRenamed("id", "node")).collect()
    assert sorted(map(tuple, got)) == [(i, i) for i in range(25)]
    node = {"docType": "SECTION", "docLevelId": "s", "text": "deep"}
    for i in range(15):
        node = {"docType": "CHAPTER", "docLevelId": f"c{i}", "documents": {"items": [node]}}
    leaves = trees.law_leaves(spark.createDataFrame([("L", json.dumps({"documents": node}))], "law string, tree string"), "law", "tree").collect()
    assert [r.text for r in leaves] == ["deep"]
