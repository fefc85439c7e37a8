"""Declared schemas of the engine's tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()), "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def _struct(text: str) -> T.StructType:
    """Schema from "name type, name type"; needs no session."""
    pairs = (field.split() for field in text.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PAPER = _struct(
    "paper_id string, doi string, pmid string, pmcid string, arxiv_id string, source string, title string, abstract string, authors array<string>, keywords array<string>, mesh_terms array<string>, article_types array<string>, "
    "journal string, issn string, publication_date string, publication_year int, citation_count int, is_open_access boolean, is_preprint boolean, content_hash string, fetched_at string, extra map<string,string>"
)
SECTION = _struct("paper_id string, sec_pos int, section_type string, header string, content string")
MENTION = _struct("paper_id string, label string, text string, start_char int, end_char int, confidence double, source_section string, canonical_name string, ontology_id string, ontology_name string, grounded boolean")
RELATION = _struct("relation_type string, paper_id string, source string, target string, direction string, p_value double, effect_size double, confidence double, evidence_strength string, source_sentence string, section_type string")
TRIPLE = _struct("subject string, predicate string, object string, confidence double, evidence string")
OVERRIDE = _struct("surface_form string, canonical_id string, entity_type string, curator_id string, justification string")
RUN_METRICS = _struct("run_id string, started_at string, stage1 bigint, stage2 bigint, gate bigint, stage3 bigint, llm bigint, total bigint, latency_ms double, _corrupt_record string")
VERDICT = _struct("keep boolean, confidence double, reason string")
