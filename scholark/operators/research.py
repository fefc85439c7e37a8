"""The eight research questions, as pure functions from tables and parameters to a DataFrame.

Descending orders put nulls first, as the reference does, and end with the group key, so results are deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import consensus


def matching(filters: dict[str, object]) -> Column:
    """Conjunction of equalities; true when there are none."""
    return reduce(lambda a, kv: a & (F.col(kv[0]) == kv[1]), sorted(filters.items()), F.lit(True))


def _direction_counts() -> list[Column]:
    return [F.count_if(F.col("direction") == d).alias(f"n_{d}") for d in ("increased", "decreased", "no_change", "associated")]


def cross_study_associations(associations: DataFrame, papers: DataFrame, disease: str, study_type: str | None = "RCT", min_papers: int = 3, confidence_threshold: float = 0.7, require_open_data: bool = True) -> DataFrame:
    """Taxa with their consensus direction over the studies of one disease (all directions count edges, papers are distinct)."""
    rows = associations.where((F.col("disease") == disease) & (F.col("confidence") >= confidence_threshold))
    keep = papers
    if study_type not in (None, "any"):
        keep = keep.where(F.col("article_type") == study_type)
    if require_open_data:
        keep = keep.where((F.col("data_availability") == "open") & (F.size("accession_numbers") > 0))
    got = rows.join(keep.select("paper_id"), "paper_id").groupBy("taxon_id").agg(
        F.min("taxon").alias("taxon"), F.count_distinct("paper_id").alias("paper_count"), F.avg("confidence").alias("consensus_confidence"), F.count("direction").alias("n_directions"), *_direction_counts()
    )
    got = got.where((F.col("paper_count") >= min_papers) & (F.col("consensus_confidence") >= confidence_threshold))
    top = F.greatest("n_increased", "n_decreased", "n_no_change", "n_associated")
    got = got.withColumn("consensus_direction", consensus(F.col("n_increased"), F.col("n_decreased"), F.col("n_no_change"), F.col("n_associated")))
    got = got.withColumn("direction_consistency", F.round(F.try_divide(top.cast("double"), F.col("n_directions")), 6)).withColumn("consensus_confidence", F.round("consensus_confidence", 6))
    return got.orderBy(F.desc_nulls_first("consensus_confidence"), F.desc_nulls_first("paper_count"), "taxon_id")


def intervention_evidence(interventions: DataFrame, papers: DataFrame, types: list[str], min_sample_size: int = 50, evidence_strength: str = "strong") -> DataFrame:
    rows = interventions.where(F.col("intervention_type").isin(*types) & F.col("sample_size").isNotNull())
    if evidence_strength != "any":
        rows = rows.where(F.col("evidence_strength") == evidence_strength)
    keep = papers.where(F.col("article_type").isin("original_research", "meta_analysis")).select("paper_id")
    got = rows.join(keep, "paper_id").groupBy("intervention_type", "taxon", "effect_direction").agg(
        F.sum("sample_size").alias("total_sample_size"), F.round(F.avg("confidence"), 6).alias("avg_confidence"), F.count_distinct("paper_id").alias("paper_count")
    )
    got = got.where(F.col("total_sample_size") >= min_sample_size)
    return got.orderBy(F.desc_nulls_first("paper_count"), F.desc_nulls_first("total_sample_size"), "intervention_type", "taxon", "effect_direction")


def methodology_landscape(methodology: DataFrame, papers: DataFrame, year_start: int, year_end: int, methods: list[str] | None = None, require_deposited_data: bool = True) -> DataFrame:
    """Use of methods by year, with deposits; a paper counts once per method.  Without names, every method counts."""
    keep = papers.where(F.col("year").between(year_start, year_end))
    if require_deposited_data:
        keep = keep.where(F.size("accession_numbers") > 0)
    starts = lambda *p: F.exists("accession_numbers", lambda a: reduce(lambda x, y: x | y, [a.startswith(s) for s in p]))
    keep = keep.select("paper_id", "year", (F.size("accession_numbers") > 0).alias("deposited"), starts("SRP", "SRR", "PRJNA").alias("sra"), starts("ERP", "ERR", "PRJEB").alias("ena"))
    rows = methodology if methods is None else methodology.where(F.lower("method").isin(*[m.lower() for m in methods]))
    rows = rows.distinct().join(keep, "paper_id")
    got = rows.groupBy("method", "year").agg(
        F.count("*").alias("total_papers"), F.count_if("deposited").alias("papers_with_data"), F.count_if("sra").alias("sra_papers"), F.count_if("ena").alias("ena_papers"), F.count_if(F.col("sra") & F.col("ena")).alias("both_papers")
    )
    return got.withColumn("pct_with_data", F.round(F.try_divide(F.col("papers_with_data") * 100.0, F.col("total_papers")), 4)).orderBy(F.desc_nulls_first("year"), "method")


def top_associations(associations: DataFrame, disease: str, top_n: int = 10, min_confidence: float = 0.7) -> DataFrame:
    """The best supported taxa; ``associated`` counts in the denominator only."""
    got = associations.where((F.col("disease") == disease) & (F.col("confidence") >= min_confidence)).groupBy("taxon_id").agg(
        F.min("taxon").alias("taxon"), F.count_distinct("paper_id").alias("paper_count"), F.avg("confidence").alias("c"), F.count("direction").alias("n_directions"), *_direction_counts()
    )
    got = got.withColumn("consensus_direction", consensus(F.col("n_increased"), F.col("n_decreased"), F.col("n_no_change"), None))
    top = F.greatest("n_increased", "n_decreased", "n_no_change")
    got = got.withColumn("direction_consistency", F.round(F.try_divide(top.cast("double"), F.col("n_directions")), 6)).withColumn("avg_confidence", F.round("c", 6))
    return got.select("taxon_id", "taxon", "paper_count", "avg_confidence", "consensus_direction", "direction_consistency").orderBy(F.desc_nulls_first("paper_count"), F.desc_nulls_first("avg_confidence"), "taxon_id").limit(min(top_n, 1000))


def conflicting_evidence(associations: DataFrame, papers: DataFrame, disease: str, min_papers_per_direction: int = 2) -> DataFrame:
    """Taxa with evidence both ways; counts are per edge."""
    rows = associations.where((F.col("disease") == disease) & F.col("direction").isin("increased", "decreased")).join(papers.select("paper_id", "title", "year", "article_type"), "paper_id")
    study = F.struct("title", "year", "article_type")
    got = rows.groupBy("taxon_id").agg(
        F.min("taxon").alias("taxon"), F.count_if(F.col("direction") == "increased").alias("increased_count"), F.count_if(F.col("direction") == "decreased").alias("decreased_count"),
        F.sort_array(F.collect_list(F.when(F.col("direction") == "increased", study))).alias("increased_studies"), F.sort_array(F.collect_list(F.when(F.col("direction") == "decreased", study))).alias("decreased_studies"),
    )
    got = got.where((F.col("increased_count") >= min_papers_per_direction) & (F.col("decreased_count") >= min_papers_per_direction))
    total = F.col("increased_count") + F.col("decreased_count")
    got = got.withColumn("total_count", total).withColumn("increased_pct", F.round(F.col("increased_count") * 100.0 / total, 4)).withColumn("balance", F.abs(F.col("increased_count") - F.col("decreased_count")))
    return got.orderBy(F.desc_nulls_first("total_count"), "balance", "taxon_id")


def open_world_claims(claims: DataFrame, subject: str | None = None, predicate: str | None = None, object_type: str | None = None, min_paper_count: int = 2, confidence_threshold: float = 0.7) -> DataFrame:
    given = {k: v for k, v in (("subject_name", subject), ("canonical_predicate", predicate), ("object_type", object_type)) if v is not None}
    rows = claims.where(matching(given) & (F.col("paper_count") >= min_paper_count) & (F.col("consensus_confidence") >= confidence_threshold))
    return rows.orderBy(F.desc_nulls_first("consensus_confidence"), F.desc_nulls_first("paper_count"), "subject_id", "canonical_predicate", "object_id")


def entity_relationships(edges: DataFrame, claims: DataFrame, name: str) -> DataFrame:
    """Distinct union of paper edges that touch the entity, claims with it as subject, and claims with it as object."""
    touching = edges.where((F.col("target_name") == name) | (F.col("source_name") == name)).select(
        F.lit("paper_edge").alias("origin"), F.col("rel_type"), F.round("confidence", 6).alias("confidence"), F.when(F.col("target_name") == name, F.col("source_name")).otherwise(F.col("target_name")).alias("related_entity"), F.lit(1).cast("bigint").alias("paper_count")
    )
    claim = lambda own, other, origin: claims.where(F.col(own) == name).select(F.lit(origin).alias("origin"), F.col("canonical_predicate").alias("rel_type"), F.round("consensus_confidence", 6).alias("confidence"), F.col(other).alias("related_entity"), "paper_count")
    return touching.unionByName(claim("subject_name", "object_name", "claim_subject")).unionByName(claim("object_name", "subject_name", "claim_object")).distinct()


def cross_paper_predicates(claims: DataFrame, predicate_regex: str, min_paper_count: int = 2) -> DataFrame:
    """Claims whose whole predicate matches the pattern."""
    rows = claims.where(F.col("canonical_predicate").rlike(f"^(?:{predicate_regex})$") & (F.col("paper_count") >= min_paper_count))
    return rows.orderBy(F.desc_nulls_first("consensus_confidence"), F.desc_nulls_first("paper_count"), "subject_id", "canonical_predicate", "object_id")
