"""Smaller enrichment and graph-build operators: ranking, interventions, methods, provenance, growth of stores, ML stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon, scoring, text

# Priority tiers of sections for entity recognition; others are tier 5 and dropped.
TIERS = (("results", 1), ("discussion", 2), ("conclusion", 2), ("methods", 3), ("introduction", 4))
# Weights of the resolution strategies.
WEIGHTS = (("manual_override", 1.0), ("exact", 0.95), ("normalized", 0.85), ("abbreviation", 0.80), ("synonym", 0.75), ("fuzzy", 0.60), ("ontology", 0.50))


def ranked_sections(sections: DataFrame) -> DataFrame:
    """Sections of each paper in the order of their tier, then of their place; the last tier goes."""
    tier = F.lit(None).cast("int")
    for name, k in reversed(TIERS):
        tier = F.when(F.col("section_type") == name, k).otherwise(tier)
    rows = sections.select("section_id", "paper_id", "sec_pos", tier.alias("tier")).where("tier is not null")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("paper_id").orderBy("tier", "sec_pos", "section_id")))


def ranked_candidates(candidates: DataFrame, *form: str) -> DataFrame:
    """Candidates per form by weight times confidence, then weight, then id."""
    weight = F.lit(0.5)
    for name, w in WEIGHTS:
        weight = F.when(F.col("strategy") == name, w).otherwise(weight)
    rows = candidates.withColumn("weight", weight).withColumn("score", F.round(F.col("weight") * F.col("confidence"), 6))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*form).orderBy(F.desc("score"), F.desc("weight"), "canonical_id")))


def interventions(sections: DataFrame) -> DataFrame:
    """One row per methods section and kind of intervention: the first word found, duration, dosage and sample size."""
    low = F.lower("content")
    found = []
    for kind, words in lexicon.INTERVENTIONS:
        first = F.lit(None).cast("string")
        for w in reversed(words):
            first = F.when(low.contains(w), w).otherwise(first)
        found.append(F.when(first.isNotNull(), F.struct(F.lit(kind).alias("kind"), first.alias("keyword"))))
    rows = sections.where("section_type = 'methods' and content is not null")
    c = F.col("content")
    rows = rows.select("section_id", "paper_id", "content", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("i"))
    return rows.select("section_id", "paper_id", F.col("i.kind").alias("intervention_type"), F.col("i.keyword").alias("keyword"), text.duration(c).alias("duration"), text.dosage(c).alias("dosage"), text.sample_size(c).alias("sample_size"))


def intervention_effects(items: DataFrame, taxa: DataFrame, found: DataFrame) -> DataFrame:
    """Effects of a paper's interventions on taxa: a sentence that names both, gives a direction and is significant.

    ``items`` (evidence_id, paper_id, source_sentence), ``taxa`` (evidence_id, taxon), ``found`` of ``interventions``.  A
    p-value of .05 or more rules a sentence out; without one it must say so in words.
    """
    s = F.col("source_sentence")
    rows = items.where(s.isNotNull()).select("evidence_id", "paper_id", s.alias("s"), text.direction(s).alias("effect_direction"), text.p_value(s).alias("p_value"))
    rows = rows.where(F.col("effect_direction").isin("increased", "decreased", "no_change") & F.coalesce(F.col("p_value") < 0.05, text.significant(F.col("s"))))
    once = found.groupBy("paper_id", "intervention_type", "keyword").agg(F.min_by(F.struct("duration", "dosage", "sample_size"), "section_id").alias("d"))
    got = rows.join(taxa, "evidence_id").join(once, "paper_id").where(F.lower("s").contains(F.col("keyword")))
    confidence = scoring.intervention_confidence(F.col("effect_direction"), F.col("p_value"), F.col("d.duration"), F.col("d.dosage"))
    got = got.select("evidence_id", "taxon", "intervention_type", "effect_direction", "p_value", "d.duration", "d.dosage", "d.sample_size", F.round(confidence, 6).alias("confidence"))
    return got.where("confidence >= 0.5")


def methodology_usage(sections: DataFrame, mentions: DataFrame, kind: str = "method") -> DataFrame:
    """One row per paper and method: the first methods section that names it, with platform, sample size and its beginning."""
    c = F.col("content")
    methods = mentions.where((F.col("label") == kind) & (F.trim("text") != "")).select("paper_id", F.lower(F.trim("text")).alias("method")).distinct()
    rows = sections.where("section_type = 'methods' and content is not null").select("paper_id", "section_id", "sec_pos", "content")
    hits = rows.join(methods, "paper_id").where(F.lower("content").contains(F.col("method")))
    first = hits.groupBy("paper_id", "method").agg(F.min(F.struct(F.coalesce("sec_pos", F.lit(2**31 - 1)).alias("p"), "section_id")).alias("at"))
    got = first.select("paper_id", "method", F.col("at.section_id").alias("section_id")).join(rows.select("section_id", "content"), "section_id")
    platform = text.first_match(c, lexicon.pairs(lexicon.PLATFORMS))
    return got.select("paper_id", "method", "section_id", platform.alias("platform"), text.sample_size(c).alias("sample_size"), F.substring("content", 1, 200).alias("source_sentence"), F.lit(0.8).alias("confidence"), F.lit("moderate").alias("evidence_strength"))


def provenance(items: DataFrame, papers: DataFrame) -> DataFrame:
    """Evidence with the paper's merge key, and whether its provenance holds: sentence, range, and a paper."""
    keys = papers.select("paper_id", text.dedup_key(F.col("doi"), F.col("pmid"), F.col("title")).alias("source_key"))
    rows = items.select("evidence_id", "paper_id", "source_sentence", "confidence", text.section_type(F.col("section_type")).alias("section_type")).join(keys, "paper_id", "left")
    fine = (F.coalesce(F.trim("source_sentence"), F.lit("")) != "") & F.coalesce(F.col("confidence").between(0.0, 1.0), F.lit(False)) & F.col("source_key").isNotNull()
    return rows.select("evidence_id", "source_key", "section_type", fine.alias("valid"))


def store_growth(scored: DataFrame, store: DataFrame, key: str, score: str) -> DataFrame:
    """New examples for the vector store: sure keeps and sure rejects that it lacks, once each."""
    part = F.when(F.col(score) >= 0.80, "positive").when(F.col(score) <= 0.20, "negative")
    rows = scored.select(key, part.alias("part")).where("part is not null").dropDuplicates([key])
    return rows.join(store.select(key).distinct(), key, "left_anti")


def training_bands(scored: DataFrame, score: str) -> Column:
    """Label band of a scored row: pseudo-positive, and hard, medium and easy negatives."""
    s = F.col(score)
    return F.when(s >= 0.85, "positive").when(s >= 0.45, "hard_negative").when(s >= 0.15, "medium_negative").otherwise("easy_negative")


def train_classifier(labelled: DataFrame, features: list[str], label: str):
    """Logistic model of the ML stage; its probabilities are compared with the keep and reject thresholds."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    stages = [VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip"), LogisticRegression(labelCol=label, maxIter=20)]
    return Pipeline(stages=stages).fit(labelled)


def ml_verdict(probability: Column, keep: float = 0.85, reject: float = 0.15) -> Column:
    return F.when(probability >= keep, "KEEP").when(probability <= reject, "REJECT").otherwise("BORDERLINE")


def induced_types(mentions: DataFrame, least: int = 100) -> DataFrame:
    """Entity types seen often enough to enter the schema."""
    return mentions.where("label is not null").groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def resume_points(papers: DataFrame, source: Column, ts: Column) -> DataFrame:
    """Where each source's next run starts: the latest instant stored."""
    return papers.groupBy(source.alias("source")).agg(F.max(ts).alias("latest"), F.count("*").alias("n_rows"))


def text_tiers(papers: DataFrame, sections: DataFrame) -> DataFrame:
    """The best text of each paper: full text where sections hold enough, else the abstract, else none."""
    body = sections.where("content is not null").groupBy("paper_id").agg(F.sum(F.length("content")).alias("n"), F.count("*").alias("n_sections"))
    rows = papers.select("paper_id", F.length(F.trim(F.coalesce("abstract", F.lit("")))).alias("a")).join(body, "paper_id", "left")
    tier = F.when(F.col("n") >= 300, "full_text").when(F.col("a") > 0, "abstract").otherwise("none")
    return rows.select("paper_id", tier.alias("tier"), F.coalesce("n_sections", F.lit(0)).alias("n_sections"))


def support_edges(claims: DataFrame, triples: DataFrame) -> DataFrame:
    """SUPPORTED_BY edges from claims to the papers of their triples, and CONTRADICTED_BY ones to those of opposite triples."""
    from .claims import OPPOSITES

    flip = F.lit(None).cast("string")
    for a, b in OPPOSITES:
        flip = F.when(F.col("canonical_predicate") == a, b).when(F.col("canonical_predicate") == b, a).otherwise(flip)
    papers = triples.select("subject_id", "object_id", "canonical_predicate", "paper_id").distinct()
    own = claims.select("subject_id", "object_id", "canonical_predicate")
    supported = own.join(papers, ["subject_id", "object_id", "canonical_predicate"]).withColumn("rel", F.lit("SUPPORTED_BY"))
    against = own.withColumn("other", flip).where("other is not null").join(papers.withColumnRenamed("canonical_predicate", "other"), ["subject_id", "object_id", "other"]).drop("other").withColumn("rel", F.lit("CONTRADICTED_BY"))
    return supported.unionByName(against)


def pmc_candidates(papers: DataFrame, texts: DataFrame, done: DataFrame) -> DataFrame:
    """Papers with a PMC id, no text of their own and no successful fetch yet."""
    rows = papers.where(F.trim("pmcid") != "").select("paper_id", F.trim("pmcid").alias("pmcid"))
    with_text = texts.where(F.length(F.trim("content")) > 0).select("paper_id").distinct()
    return rows.join(with_text, "paper_id", "left_anti").join(done.select("paper_id").distinct(), "paper_id", "left_anti")


def titles_by_key(keys: DataFrame, key: str, papers: DataFrame) -> DataFrame:
    """Titles for paper keys in any of four spellings: the id, the doi, and both prefixed; a key without a paper keeps null."""
    doi = F.lower(F.nullif(F.trim("doi"), F.lit("")))
    pmid = F.nullif(F.trim("pmid"), F.lit(""))
    spelled = F.filter(F.array("paper_id", doi, F.concat(F.lit("doi:"), doi), F.concat(F.lit("pmid:"), pmid)), lambda x: x.isNotNull())
    table = papers.where("title is not null").select("paper_id", "title", F.explode(spelled).alias(key)).groupBy(key).agg(F.min_by("title", "paper_id").alias("title"))
    return keys.join(table, key, "left")


def next_cursors(runs: DataFrame, source: str, fetched: str, offset: str) -> DataFrame:
    """(source, next_offset): where each source goes on; from the beginning again where the last run gave nothing."""
    last = runs.groupBy(source).agg(F.max(F.struct(F.col(offset).alias("o"), F.col(fetched).alias("n"))).alias("r"))
    return last.select(source, F.when(F.col("r.n") == 0, F.lit(0)).otherwise(F.col("r.o") + F.col("r.n")).cast("bigint").alias("next_offset"))


def provenance_errors(sentence: Column, confidence: Column, method: Column, at: Column, key: Column, methods: tuple[str, ...], now: Column) -> Column:
    """Names of the checks a provenance record fails; instants up to a minute ahead are clocks that differ."""
    checks = (
        ("sentence", F.coalesce(F.trim(sentence), F.lit("")) == ""), ("confidence", confidence.isNull() | ~confidence.between(0.0, 1.0)), ("method", ~F.coalesce(method.isin(*methods), F.lit(False))),
        ("time", at.isNull() | (at > now + F.expr("interval 60 seconds"))), ("source", key.isNull()),
    )
    return F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks]), lambda x: x.isNotNull())
