"""Records of sections by source: one projection, and a table of what differs from source to source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.cites import enriched
from lexmill.functions.ids import point_id, point_id_hashed, point_id_long, text_sha1
from lexmill.functions.status import flipped
from lexmill.functions.text import safe_id, word_count

# Fixed values by source: category, document type, level, title, and templates of the act id
# and the citation over the columns number, safe (the number made safe), part, prefix and rule_set.
SOURCES = (
    ("co_regulations", "state_regulation", "regulation", "section", "Code of Colorado Regulations", "STATE_CO_CCR_{safe}", "{number}"),
    ("id_regulations", "state_regulation", "regulation", "rule", "Idaho Administrative Code", "STATE_ID_IDAPA_{safe}", "IDAPA {part}.{number}"),
    ("il_regulations", "state_regulation", "regulation", "section", "Illinois Administrative Code", "STATE_IL_IAC_P{part}_S{safe}", "Ill. Adm. Code {part}.{number}"),
    ("ks_regulations", "state_regulation", "regulation", "section", "Kansas Administrative Regulations", "STATE_KS_KAR_{safe}", "K.A.R. {number}"),
    ("ky_regulations", "state_regulation", "regulation", "regulation", "Kentucky Administrative Regulations", "STATE_KY_KAR_{safe}", "{number}"),
    ("md_regulations", "state_regulation", "regulation", "regulation", "Code of Maryland Regulations", "STATE_MD_COMAR_{safe}", "COMAR {number}"),
    ("me_regulations", "state_regulation", "regulation", "section", "Code of Maine Rules", "STATE_ME_CMR_{safe}", "{part} Ch. {number}"),
    ("mn_regulations", "state_regulation", "regulation", "part", "Minnesota Administrative Rules", "STATE_MN_ADR_{safe}", "Minn. R. {number}"),
    ("nm_regulations", "state_regulation", "regulation", "section", "New Mexico Administrative Code", "STATE_NM_NMAC_{safe}", "{number} NMAC"),
    ("oh_regulations", "state_regulation", "regulation", "rule", "Ohio Administrative Code", "STATE_OH_ADC_{safe}", "Ohio Admin. Code {number}"),
    ("sc_regulations", "state_regulation", "regulation", "regulation", "South Carolina Code of Regulations", "STATE_SC_CODEREGS_{safe}", "S.C. Code Regs. {number}"),
    ("va_regulations", "state_regulation", "regulation", "section", "Virginia Administrative Code", "STATE_VA_VAC_{safe}", "{part} Va. Admin. Code § {number}"),
    ("wa_regulations", "state_regulation", "regulation", "section", "Washington Administrative Code", "STATE_WA_ADC_{safe}", "WAC {number}"),
    ("wi_regulations", "state_regulation", "regulation", "section", "Wisconsin Administrative Code", "STATE_WI_ADC_{safe}", "Wis. Admin. Code {part} § {number}"),
    ("fl_court_rules", "state_rules", "court_rule", "rule", "Florida Court Rules", "SRULES_FL_{rule_set}_R{safe}", "{prefix} {number}"),
    ("mn_court_rules", "state_rules", "court_rule", "rule", "Minnesota Court Rules", "SRULES_MN_{rule_set}_R{safe}", "{prefix} {number}"),
    ("nj_court_rules", "state_rules", "court_rule", "rule", "New Jersey Court Rules", "SRULES_NJ_P{part}_S{safe}", "R. {part}:{number}"),
    ("nv_court_rules", "state_rules", "court_rule", "rule", "Nevada Court Rules", "SRULES_NV_{rule_set}_R{safe}", "{prefix} {number}"),
    ("tx_court_rules", "state_rules", "court_rule", "rule", "Texas Court Rules", "SRULES_TX_{rule_set}_R{safe}", "{prefix} {number}"),
    ("state_court_rules", "state_rules", "court_rule", "rule", "Court Rules", "SRULES_{rule_set}_R{safe}", "R. Ct. {number}"),
    ("federal_register", "federal_register", "regulation", "regulation", "Federal Register", "FR_{safe}", "{prefix}"),
    ("presidential", "presidential_document", "regulation", "regulation", "Presidential Documents", "FRP_{safe}", "{prefix}"),
    ("irs_bulletin", "irs_guidance", "ruling", "ruling", "Internal Revenue Bulletin", "IRB_{safe}", "{number}"),
    ("ssa_rulings", "ssa_ruling", "ruling", "ruling", "Social Security Rulings", "SSA_{safe}", "{number}"),
    ("dc_statutes", "state_statute", "statute", "section", "D.C. Code", "STATE_DC_S{safe}", "D.C. Code § {number}"),
    ("oh_statutes", "state_statute", "statute", "section", "Ohio Revised Code", "STATE_OH_S{safe}", "Ohio Rev. Code § {number}"),
    ("ut_statutes", "state_statute", "statute", "section", "Utah Code", "STATE_UT_S{safe}", "Utah Code § {number}"),
    ("pr_codes", "state_statute", "statute", "article", "Puerto Rico Codes", "STATE_PR_{rule_set}_A{safe}", "{prefix} Art. {number}"),
    ("constitutions", "state_constitution", "constitution", "article", "Constitution", "SCONST_{rule_set}_A{part}_S{safe}", "{prefix} art. {part}, § {number}"),
)
#: Which formula names a chunk: the DC records hash their text whole, node chunks name empty texts.
POINT_IDS = {"dc_statutes": point_id_long}
COLUMNS = ("number", "safe", "part", "prefix", "rule_set")


def filled(template: str) -> Column:
    """A template with its columns filled in; nulls as empty."""
    out = F.lit(template)
    for c in COLUMNS:
        if "{" + c + "}" in template:
            out = F.replace(out, F.lit("{" + c + "}"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return out


def by_source(position: int, template: bool = False) -> Column:
    out = F.lit(None).cast("string")
    for row in reversed(SOURCES):
        out = F.when(F.col("source_name") == row[0], filled(row[position]) if template else F.lit(row[position])).otherwise(out)
    return out


def records(sections: DataFrame, edition: Column | None = None) -> DataFrame:
    """P-13 to P-20: sections(source_name, state, number, part, prefix, rule_set, section_title, text, …) as records.

    Enrichment reads the whole text; unknown sources give null categories, which the audit reports.
    """
    rows = sections.withColumn("safe", safe_id(F.col("number").cast("string")))
    rows = rows.withColumns({"act_id": by_source(5, True), "citation": F.trim(by_source(6, True)), "e": enriched(F.col("text"), edition)})
    naming = point_id_hashed(F.col("act_id"), F.lit(0), F.col("text"))
    for name, formula in POINT_IDS.items():
        naming = F.when(F.col("source_name") == name, formula(F.col("act_id"), F.lit(0), F.col("text"))).otherwise(naming)
    return rows.select(
        naming.alias("point_id"), "act_id", "text", by_source(1).alias("category"), by_source(2).alias("document_type"), F.lit("US").alias("jurisdiction"), F.lit("US").alias("country_code"), "state", F.lit(0).alias("chunk_index"), F.lit(1).alias("total_chunks"),
        F.col("number").cast("string").alias("section_number"), "section_title", "citation", F.col("citation").alias("citation_short"), F.col("citation").alias("display_label"), by_source(4).alias("title"), by_source(3).alias("level_classifier"),
        flipped(F.lit("in_force"), F.col("text")).alias("act_status"), word_count(F.col("text")).alias("word_count"), text_sha1(F.col("text")).alias("full_text_sha1"), point_id(F.col("act_id"), F.lit(-1), F.col("text")).alias("parent_chunk_id"), "e.*",
    )
