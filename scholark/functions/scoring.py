"""Score ladders: evidence strength, confidence, quality and consensus."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Primary studies, sections by weight, and scores of journals.
PRIMARY = ("original_research", "clinical_trial", "RCT")
WEAK_SECTIONS = ("abstract", "introduction")
STRONG_SECTIONS = ("results", "discussion")
RANK = {"weak": 1, "moderate": 2, "strong": 3}
QUARTILE = {"Q1": 0.30, "Q2": 0.20, "Q3": 0.10, "Q4": 0.05}


def strength_from_p(p: Column, article_type: Column, conflicting: Column | None = None) -> Column:
    """conflicting > strong (p < .01 and primary) > moderate (p < .05) > weak; a missing p is weak."""
    ladder = F.when(p.isNull(), "weak").when((p < 0.01) & article_type.isin(*PRIMARY), "strong").when(p < 0.05, "moderate").otherwise("weak")
    return ladder if conflicting is None else F.when(conflicting, "conflicting").otherwise(ladder)


def strength_of_pair(p: Column, article_type: Column) -> Column:
    """Of an extracted pair: strong below .01 in original research or a meta-analysis, moderate below .05, else weak."""
    return F.when((p < 0.01) & article_type.isin("original_research", "meta_analysis"), "strong").when(p < 0.05, "moderate").otherwise("weak")


def strength_of_triple(confidence: Column, section: Column, article_type: Column) -> Column:
    s = F.lower(F.trim(section))
    return (
        F.when(confidence < 0.7, "weak")
        .when(s.isin(*WEAK_SECTIONS), "weak")
        .when(s.isin(*STRONG_SECTIONS), F.when(article_type.isin(*PRIMARY) & (confidence >= 0.85), "strong").otherwise("moderate"))
        .otherwise("weak")
    )


def strength_rank(strength: Column) -> Column:
    out = F.lit(0)
    for name, k in RANK.items():
        out = F.when(strength == name, k).otherwise(out)
    return out


def strength_name(rank: Column) -> Column:
    return F.when(rank >= 3, "strong").when(rank == 2, "moderate").otherwise("weak")


def claim_strength(strengths: Column) -> Column:
    """An aggregate: three or more moderate or better items make a claim strong; else the best item counts."""
    rank = strength_rank(strengths)
    return F.when(F.count_if(rank >= 2) >= 3, "strong").otherwise(strength_name(F.max(rank)))


def association_confidence(direction: Column, p: Column, effect: Column, measure: Column) -> Column:
    part = lambda c, v: F.when(c.isNotNull(), v).otherwise(0.0)
    return F.least(F.lit(1.0), part(direction, 0.5) + part(p, 0.3) + part(effect, 0.15) + part(measure, 0.05))


def intervention_confidence(direction: Column, p: Column, duration: Column, dosage: Column) -> Column:
    part = lambda c, v: F.when(c.isNotNull(), v).otherwise(0.0)
    return F.least(F.lit(1.0), part(direction, 0.3) + part(p, 0.3) + 0.2 + part(duration, 0.1) + part(dosage, 0.1))


def quality(quartile: Column, article_type: Column, design: Column, design_confidence: Column, sample: Column, available: Column, methods: Column) -> Column:
    """Journal, study, sample, data and methods (a text of their names), capped at 1 and rounded to 3 digits."""
    q = F.lit(0.0)
    for name, v in QUARTILE.items():
        q = F.when(quartile == name, v).otherwise(q)
    kind = F.lower(F.coalesce(article_type, F.lit("")))
    scaled = F.round(design_confidence * 0.30, 3)
    scaled = F.when(design.isin("meta_analysis", "systematic_review"), F.least(scaled, F.lit(0.25))).otherwise(scaled)
    study = (
        F.when(kind.contains("meta_analysis"), 0.22).when(kind.contains("systematic_review"), 0.20).when(kind.contains("protocol") | (design == "protocol"), 0.05).when(kind.contains("case_report"), 0.05)
        .when(kind.contains("letter") | kind.contains("commentary"), 0.0).when(design_confidence > 0, scaled).when(kind.contains("original_research"), 0.10).otherwise(0.0)
    )
    n = F.when(sample >= 1000, 0.20).when(sample >= 500, 0.15).when(sample >= 100, 0.10).when(sample >= 10, 0.05).otherwise(0.0)
    a = F.when(available == "accession_linked", 0.15).when(available == "open", 0.10).when(available == "restricted", 0.05).otherwise(0.0)
    low = F.lower(F.coalesce(methods, F.lit("")))
    deep = low.contains("shotgun") | low.contains("whole metagenome") | low.contains("whole genome") | low.contains("wgs") | low.contains("metatranscriptom")
    m = F.when(deep, 0.05).when(low.contains("16s") | low.contains("amplicon"), 0.03).when(low != "", 0.01).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), q + study + n + a + m), 3)


def consensus(increased: Column, decreased: Column, unchanged: Column, associated: Column | None) -> Column:
    """The most frequent direction; ties go to increased, decreased, associated, no_change in this order."""
    if associated is None:
        return F.when((increased >= decreased) & (increased >= unchanged), "increased").when((decreased >= increased) & (decreased >= unchanged), "decreased").otherwise("no_change")
    top = F.greatest(increased, decreased, unchanged, associated)
    return F.when(increased == top, "increased").when(decreased == top, "decreased").when(associated == top, "associated").otherwise("no_change")
