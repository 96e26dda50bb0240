"""The canonical field set of a section's record: tiers, aliases, defaults and the audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import ids

#: Fixed tiers of fields.
REQUIRED = ("text", "act_id", "category", "document_type", "jurisdiction", "country_code", "state", "chunk_index", "total_chunks")
EXPECTED = ("section_number", "section_title", "citation", "citation_short", "display_label", "display_title", "display_path", "breadcrumb", "title", "title_name", "top_level_title", "act_status", "level_classifier", "word_count", "full_text_sha1", "raw_node_id", "r2_section_text_url")
HIERARCHY = ("title_number", "cfr_title_number", "volume", "chapter", "chapter_name", "subchapter", "subchapter_name", "part", "part_name", "subpart", "subpart_name", "year", "sort_key", "title_code", "parent_id", "parent_chunk_id")
ENRICHMENT = (
    "subsection_count", "subsection_letters", "numbered_paragraph_count", "document_word_count", "cross_references_usc", "cross_references_cfr", "cross_references_count", "cross_references_state_statute", "amendment_years", "amendments_count",
    "last_amended_year", "public_laws_referenced", "public_laws_count", "public_law_cites", "public_law_cites_count", "renumbered_to", "transferred_to", "effective_date", "effective_date_text", "original_enactment_date", "amendment_history",
    "prior_effective_dates", "source_note", "source_credit_raw", "current_through", "currency_note", "currency_year", "referenced_short_titles", "implementing_regulations", "implementing_regulations_count", "statutory_authority",
    "statutory_authority_count", "rule_amplifies", "federal_register_citations", "authority",
)
ADDRESSES = ("source_url", "r2_source_url", "state_html_url", "r2_html_url", "r2_pdf_url", "r2_xml_url", "r2_json_url", "r2_docx_url", "r2_urls", "r2_formats_available", "govinfo_html_url", "govinfo_pdf_url")
OTHERS = ("usckey", "exp_cite", "granule_id", "package_id", "document_id", "item_sort_key", "pdf_page", "is_snapshot", "snapshot_source", "snapshot_dataset", "snapshot_license", "has_text", "citation_conflict", "rule_set", "rule_set_code", "rule_subtype", "committee_comment", "committee_note", "history", "history_action", "part_history", "settlement_amount")
ALIASES = (("r2_txt_url", "r2_section_text_url"), ("history_notes", "history"), ("history_note_raw", "history"))
DEPRECATED = ("corpus_type", *(a for a, _ in ALIASES))
DEFAULTS = (("jurisdiction", "US"), ("country_code", "US"))
#: U-05: every declared field.
KNOWN = tuple(sorted({*REQUIRED, *EXPECTED, *HIERARCHY, *ENRICHMENT, *ADDRESSES, *OTHERS, *DEPRECATED}))


def names(values: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, values))


def canonical_key(key: Column) -> Column:
    """G-02."""
    out = key
    for alias, name in ALIASES:
        out = F.when(key == alias, F.lit(name)).otherwise(out)
    return out


def canonical(fields: Column) -> Column:
    """P-01: a map with aliases renamed; a canonical key that is there wins, also with a null value."""
    aliases = [a for a, _ in ALIASES]
    own = F.map_filter(fields, lambda k, _: ~k.isin(*aliases))
    have = F.map_keys(own)
    folded = F.filter(F.map_entries(fields), lambda e: e["key"].isin(*aliases) & ~F.array_contains(have, canonical_key(e["key"])))
    renamed = F.transform(folded, lambda e, i: F.struct(canonical_key(e["key"]).alias("key"), e["value"].alias("value")))
    keys = F.transform(renamed, lambda e: e["key"])
    first = F.filter(renamed, lambda e, i: F.array_position(keys, e["key"]) == i + 1)
    return F.map_concat(own, F.map_from_entries(first))


def with_defaults(fields: Column) -> Column:
    """P-02: defaults where a value is missing, null or empty."""
    kept = F.map_filter(fields, lambda k, v: ~(k.isin(*[d for d, _ in DEFAULTS]) & (v.isNull() | (v == ""))))
    absent = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in DEFAULTS]), lambda e: ~F.array_contains(F.map_keys(kept), e["key"]))
    return F.map_concat(kept, F.map_from_entries(absent))


def missing_required(fields: Column) -> Column:
    """F-19: required fields that are absent, null or empty."""
    return F.filter(F.array_sort(names(REQUIRED)), lambda k: F.coalesce(F.try_element_at(fields, k), F.lit("")) == "")


def audit(fields: Column) -> Column:
    """F-20, G-01 and U-04: what is missing, undeclared or deprecated, and whether the record is sound."""
    keys = F.map_keys(fields)
    required, unknown = missing_required(fields), F.array_sort(F.array_except(keys, names(KNOWN)))
    return F.struct(
        required.alias("missing_required"), F.array_sort(F.array_except(names(EXPECTED), keys)).alias("missing_expected"), unknown.alias("unknown"),
        F.array_sort(F.array_intersect(keys, names(DEPRECATED))).alias("deprecated"), ((F.size(required) == 0) & (F.size(unknown) == 0)).alias("ok"),
    )


def of_node(node_id: Column, state: Column, number: Column, heading: Column) -> Column:
    """P-03: the fields of a record that follow from its node."""
    return F.struct(
        ids.act_id(node_id, state).alias("act_id"), ids.section_number(node_id, number).alias("section_number"), ids.title_number(node_id).alias("title_number"), ids.level(node_id)["classifier"].alias("level_classifier"),
        heading.alias("section_title"), F.get(F.split(node_id, "/"), F.lit(0)).alias("country_code"),
    )


def with_rights(records: DataFrame, rights: str, country: str) -> DataFrame:
    """G-09: records with the rights that hold for their corpus, where they have none of their own."""
    own = lambda c: F.col(c) if c in records.columns else F.lit(None).cast("string")
    return records.withColumns({c: F.coalesce(own(c), F.lit(v)) for c, v in (("snapshot_license", rights), ("country_code", country))})
