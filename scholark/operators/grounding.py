"""Grounding of mentions to ontology entries by stored tables, and the graph's edges between grounded ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORTEST = 3
# Relation types of the graph by the labels of their ends.
ROUTES = (
    ("taxon", "disease", "REPORTS_ASSOCIATION"), ("taxon", "metabolite", "TAXON_PRODUCES_METABOLITE"), ("taxon", "pathway", "TAXON_MODULATES_PATHWAY"), ("taxon", "gene", "TAXON_REGULATES_GENE"), ("taxon", "immune_cell", "TAXON_INFLUENCES_IMMUNE_CELL"),
    ("taxon", "clinical_outcome", "TAXON_AFFECTS_CLINICAL_OUTCOME"), ("metabolite", "disease", "METABOLITE_LINKED_TO_DISEASE"), ("metabolite", "immune_cell", "METABOLITE_INDUCES_IMMUNE_RESPONSE"), ("gene", "disease", "GENE_PREDISPOSES_TO_DISEASE"),
    ("dietary_component", "taxon", "DIET_SHAPES_TAXON"), ("population", "taxon", "ENVIRONMENT_SHAPES_TAXON"), ("paper", "method", "USES_METHODOLOGY"), ("paper", "taxon", "REPORTS_INTERVENTION_EFFECT"),
)


def lookup_keys(mentions: DataFrame) -> DataFrame:
    """(form, entity_type): what has to be looked up, each once, before any service is asked."""
    return mentions.where((F.trim("text") != "") & F.col("label").isNotNull()).select(F.lower(F.trim("text")).alias("form"), F.col("label").alias("entity_type")).distinct()


def grounding_table(mentions: DataFrame) -> DataFrame:
    """(form, entity_type, id, name, confidence): the surest stored grounding of each form, the smallest id on ties."""
    rows = mentions.where("grounded and ontology_id is not null and label is not null").select(F.lower(F.trim("text")).alias("form"), F.col("label").alias("entity_type"), "ontology_id", "ontology_name", F.coalesce("grounding_confidence", F.lit(0.0)).alias("c"))
    best = rows.where("form <> ''").groupBy("form", "entity_type").agg(F.min(F.struct((-F.col("c")).alias("c"), "ontology_id", "ontology_name")).alias("b"))
    return best.select("form", "entity_type", F.col("b.ontology_id").alias("id"), F.col("b.ontology_name").alias("name"), (-F.col("b.c")).alias("confidence"))


def ground(keys: DataFrame, stored: DataFrame, entities: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """(form, entity_type, id, name, confidence, source) of every key: stored grounding, name of the same type, abbreviation.

    Forms under three characters are noise and stay ungrounded, as does what no table knows: ``ungrounded:<form>``.
    Ambiguous names and abbreviations take the smallest id.
    """
    names = entities.groupBy(F.lower("primary_name").alias("form"), "entity_type").agg(F.min(F.struct("canonical_id", "primary_name")).alias("n"))
    short = abbreviations.join(entities, F.col("full_form") == F.col("primary_name")).groupBy(F.lower("abbreviated_form").alias("form"), "entity_type").agg(F.min(F.struct("canonical_id", "primary_name")).alias("s"))
    stored = stored.select("form", "entity_type", F.struct("id", "name", "confidence").alias("g"))
    rows = keys.join(stored, ["form", "entity_type"], "left").join(F.broadcast(names), ["form", "entity_type"], "left").join(F.broadcast(short), ["form", "entity_type"], "left")
    entry = lambda i, n, c, source: F.struct(i.alias("id"), n.alias("name"), c.cast("double").alias("confidence"), F.lit(source).alias("source"))
    known = F.length("form") >= SHORTEST
    found = F.coalesce(
        F.when(known & F.col("g").isNotNull(), entry(F.col("g.id"), F.col("g.name"), F.col("g.confidence"), "cache")), F.when(known & F.col("n").isNotNull(), entry(F.col("n.canonical_id"), F.col("n.primary_name"), F.lit(1.0), "registry")),
        F.when(known & F.col("s").isNotNull(), entry(F.col("s.canonical_id"), F.col("s.primary_name"), F.lit(0.9), "abbreviation")), entry(F.concat(F.lit("ungrounded:"), F.col("form")), F.col("form"), F.lit(0.0), "none"),
    )
    return rows.select("form", "entity_type", found.alias("x")).select("form", "entity_type", "x.*")


def failures(grounded: DataFrame) -> DataFrame:
    """What to look into: forms long enough that nothing grounded."""
    return grounded.where((F.col("source") == "none") & (F.length("form") >= SHORTEST)).select("form", "entity_type")


def route(source_label: Column, target_label: Column) -> Column:
    """Type of the edge between two labels; null for pairs that are no relation."""
    out = F.lit(None).cast("string")
    for a, b, name in reversed(ROUTES):
        out = F.when((source_label == a) & (target_label == b), name).otherwise(out)
    return out


def build_edges(relations: DataFrame, grounded: DataFrame) -> DataFrame:
    """Edges with their type and both ends grounded; a relation of labels that don't go together is no edge.

    ``relations``: evidence_id, source, source_label, target, target_label, direction.  Ends that no table knows keep
    their form as an ungrounded id, so no relation is lost.
    """
    g = grounded.select("form", "entity_type", "id")
    rows = relations.withColumn("rel", route(F.col("source_label"), F.col("target_label"))).where("rel is not null")
    for end in ("source", "target"):
        one = g.select(F.col("form").alias(end), F.col("entity_type").alias(f"{end}_label"), F.col("id").alias(f"{end}_id"))
        rows = rows.join(one, [end, f"{end}_label"], "left").withColumn(f"{end}_id", F.coalesce(f"{end}_id", F.concat(F.lit("ungrounded:"), F.lower(end))))
    return rows.select("evidence_id", "rel", F.col("source_id").alias("src"), F.col("target_id").alias("dst"), "direction")


def missing_nodes(nodes: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Nodes that the graph lacks, once each: what an upsert by id has to add."""
    return nodes.dropDuplicates([key]).join(existing.select(key).distinct(), key, "left_anti")
