"""Relevance cascade: metadata, weighted rules, gate, embeddings, routing; calibration of its thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Small term lists of the stages, re-authored.
HUMAN = ("humans", "adult", "infant", "patients")
ANIMAL = ("mice", "rats", "fishes")
MICROBIOME = ("microbiota", "gastrointestinal microbiome", "metagenome")
POSITIVE = (("stool", 0.30), ("saliva", 0.25), ("metagenomics", 0.35), ("microbio", 0.30), ("cohort", 0.15), ("shotgun", 0.20), ("infants", 0.10))
NEGATIVE = (("mouse", -0.40), ("mice", -0.40), ("soil", -0.50), ("fish", -0.20), ("in vitro", -0.30))
GATE = ("metagenom", "amplicon", "16s", "sequencing", "strain", "shotgun")


DIGITS = 3


def _any(terms: Column, words: tuple[str, ...]) -> Column:
    low = F.transform(F.coalesce(terms, F.array().cast("array<string>")), lambda t: F.lower(t))
    return F.arrays_overlap(low, F.array(*[F.lit(w) for w in words]))


def metadata_verdict(mesh: Column) -> Column:
    """KEEP, REJECT or UNKNOWN with a score, from subject headings."""
    human, animal, micro = _any(mesh, HUMAN), _any(mesh, ANIMAL), _any(mesh, MICROBIOME)
    pair = lambda v, s: F.struct(F.lit(v).alias("verdict"), F.lit(s).alias("score"))
    return F.when(animal & ~human, pair("REJECT", 0.05)).when(~micro, pair("UNKNOWN", 0.10)).when(human & ~animal, pair("KEEP", 0.90)).when(human, pair("KEEP", 0.70)).otherwise(pair("UNKNOWN", 0.45))


def rule_score(text: Column) -> Column:
    """Weights of the terms found, clamped to [-1, 1.5], scaled by 1.5, clamped to [0, 1], 3 digits."""
    low = F.lower(text)
    total = F.lit(0.0)
    for term, w in POSITIVE + NEGATIVE:
        total = total + F.when(low.contains(term), w).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.least(F.lit(1.5), total)) / 1.5)), 3)


MOST_TERMS = 5000


def weighted_score(rows: DataFrame, text: Column, terms: DataFrame) -> DataFrame:
    """``rows`` with ``rule`` and ``n_terms`` by a table of terms (term, weight), scored as ``rule_score`` does.

    The table is the curators' own; its size is checked, and it travels as one row.
    """
    listed = [(r["term"], float(r["weight"])) for r in terms.where("trim(term) <> '' and weight is not null").select(F.lower("term").alias("term"), "weight").distinct().orderBy("term", "weight").limit(MOST_TERMS + 1).collect()]
    if len(listed) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    one = rows.sparkSession.createDataFrame([(listed,)], "terms array<struct<term:string,weight:double>>")
    hits = F.filter("terms", lambda t: F.col("low_").contains(t["term"]))
    got = rows.withColumn("low_", F.lower(text)).crossJoin(F.broadcast(one)).withColumn("hits_", hits)
    total = F.aggregate("hits_", F.lit(0.0), lambda s, t: s + t["weight"])
    score = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.least(F.lit(1.5), total)) / 1.5)), 3)
    return got.withColumns({"rule": score, "n_terms": F.size("hits_")}).drop("terms", "low_", "hits_")


def gate(text: Column) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for t in GATE:
        out = out | low.contains(t)
    return out


def cascade(df: DataFrame, text: Column, mesh: str, keep: float = 0.45, reject: float = 0.1) -> DataFrame:
    """First decisive stage wins; undecided rows go to review."""
    rows = df.withColumns({"m": metadata_verdict(F.col(mesh)), "rule": rule_score(text), "gate": gate(text)})
    stage = F.when(F.col("m.verdict") != "UNKNOWN", "stage1").when(~F.col("gate"), "gate").when((F.col("rule") >= keep) | (F.col("rule") <= reject), "stage2").otherwise("review")
    kept = F.when(F.col("m.verdict") != "UNKNOWN", F.col("m.verdict") == "KEEP").when(~F.col("gate"), False).when(F.col("rule") >= keep, True).when(F.col("rule") <= reject, False)
    score = F.when(stage == "stage1", F.col("m.score")).when(stage == "gate", F.round(F.col("rule") * 0.5, 4)).otherwise(F.col("rule"))
    return rows.withColumns({"stage": stage, "keep": kept, "score": score, "review": kept.isNull() | ~F.col("gate")}).drop("m")


def embedding_verdict(positive: Column, negative: Column, n_positive: Column, n_negative: Column) -> Column:
    enough = (n_positive >= 50) & (n_negative >= 50)
    return F.when(~enough, "INACTIVE").when((positive >= 0.85) & (negative < 0.60), "KEEP").when((negative >= 0.85) & (positive < 0.60), "REJECT").otherwise("BORDERLINE")


def route(rule_keep: Column, verdict: Column, rule: Column, embedding: Column) -> Column:
    """Rows for the verifier: the stages disagree, or the blended score is in the middle."""
    blended = (rule + embedding) / 2
    return ((verdict == "KEEP") & ~rule_keep) | ((verdict == "REJECT") & rule_keep) | blended.between(0.40, 0.70)


def decide(rows: DataFrame, keep: float = 0.45, reject: float = 0.1) -> DataFrame:
    """(stage, keep, review) of the whole cascade: the first decisive stage wins.

    Columns: ``m`` (verdict of the subject headings), ``gate``, ``rule``, ``probability`` (stage 3), ``embedding`` (verdict of
    stage 3.5) with its ``similarity``, ``llm_keep`` and ``llm_confidence`` (stage 4; null where it gave no answer).  Stage 3.5
    is final unless it contradicts the rules or the blended score is in the middle; then the verifier decides, and what
    it isn't sure of goes to a human.
    """
    rule, p, e = F.col("rule"), F.col("probability"), F.col("embedding")
    out = lambda stage, kept, review=False: F.struct(F.lit(stage).alias("stage"), (kept if isinstance(kept, Column) else F.lit(kept)).alias("keep"), F.lit(review).alias("review"))
    none = F.lit(None).cast("struct<stage:string,keep:boolean,review:boolean>")
    routed = route(rule >= keep, e, rule, F.col("similarity"))
    sure = F.col("llm_confidence") >= 0.70
    middle = F.col("llm_confidence").between(0.50, 0.70)
    verifier = F.when(F.col("llm_confidence").isNull(), out("stage4", None, True)).when(sure, F.struct(F.lit("stage4").alias("stage"), F.col("llm_keep").alias("keep"), F.lit(False).alias("review"))).when(middle, out("stage4", None, True)).otherwise(out("stage4", False))
    verdict = F.coalesce(
        F.when(F.col("m") == "KEEP", out("stage1", True)).when(F.col("m") == "REJECT", out("stage1", False)).otherwise(none), F.when(~F.col("gate"), out("gate", False, True)).otherwise(none),
        F.when(rule >= keep, out("stage2", True)).when(rule <= reject, out("stage2", False)).otherwise(none), F.when(p >= 0.85, out("stage3", True)).when(p <= 0.15, out("stage3", False)).otherwise(none),
        F.when(e.isin("KEEP", "REJECT") & ~routed, F.struct(F.lit("stage3.5").alias("stage"), (e == "KEEP").alias("keep"), F.lit(False).alias("review"))).otherwise(none), verifier,
    )
    return rows.withColumn("v_", verdict).select(*[c for c in rows.columns], F.col("v_.stage").alias("stage"), F.col("v_.keep").alias("keep"), F.col("v_.review").alias("review"))


def sweep_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score: rows, positives, precision of keeping from here up, recall of rejecting all below.

    Scores are taken at ``DIGITS`` digits, so the windows run over at most some thousand rows, whatever the table.
    """
    by = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.round(score, DIGITS).alias(score)).agg(F.count("*").alias("n"), F.sum(label).alias("pos"))
    down = Window.orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    got = by.withColumns({"cum_n": F.sum("n").over(down), "cum_pos": F.sum("pos").over(down), "cum_neg": F.coalesce(F.sum(F.col("n") - F.col("pos")).over(up), F.lit(0)), "neg": F.sum(F.col("n") - F.col("pos")).over(every)})
    return got.withColumns({"precision": F.try_divide("cum_pos", "cum_n"), "rejection": F.try_divide("cum_neg", "neg")})


def calibrated_thresholds(df: DataFrame, score: str, label: str, precision: float = 0.9, recall: float = 0.9, defaults: tuple[float, float] = (0.7, 0.3)) -> DataFrame:
    """(keep_at, reject_at): the lowest score down to which precision holds, and the highest up to which the recall of
    rejection holds, both stopping at the first miss; where nothing holds the default stays, crossed ones give both.

    The sweep for rejection begins at the lowest score, below which nothing is rejected: with any negative row it
    misses at once, as in the reference, and the default stays.
    """
    rows = sweep_counts(df, score, label)
    down = Window.orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.orderBy(score).rowsBetween(Window.unboundedPreceding, 0)
    held = rows.withColumns({"kept": F.min((F.col("precision") >= precision).cast("int")).over(down), "let": F.min(F.coalesce((F.col("rejection") >= recall).cast("int"), F.lit(0))).over(up)})
    got = held.agg(F.coalesce(F.min(F.when(F.col("kept") == 1, F.col(score))), F.lit(defaults[0])).alias("k"), F.coalesce(F.max(F.when(F.col("let") == 1, F.col(score))), F.lit(defaults[1])).alias("r"))
    crossed = F.col("r") >= F.col("k")
    return got.select(F.when(crossed, defaults[0]).otherwise(F.col("k")).alias("keep_at"), F.when(crossed, defaults[1]).otherwise(F.col("r")).alias("reject_at"))


def calibration_error(df: DataFrame, probability: str, label: str, bins: int = 10) -> DataFrame:
    """Expected calibration error over equal-width bins."""
    b = F.least(F.floor(F.col(probability) * bins), F.lit(bins - 1))
    got = df.where(F.col(probability).isNotNull() & F.col(label).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(label).alias("accuracy"), F.avg(probability).alias("confidence"))
    return got.agg(F.round(F.try_divide(F.sum(F.col("n") * F.abs(F.col("accuracy") - F.col("confidence"))), F.sum("n")), 6).alias("ece"), F.sum("n").alias("n_rows"))


def platt(df: DataFrame, score: str, label: str, least: int = 200):
    """Logistic fit of one score; None with too few rows; a falling slope is set to 0."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(F.col(score).cast("double").alias("s"), F.col(label).cast("double").alias("label"))
    if rows.limit(least).count() < least:
        return None
    model = LogisticRegression(featuresCol="f").fit(VectorAssembler(inputCols=["s"], outputCol="f").transform(rows))
    return max(0.0, float(model.coefficients[0])), float(model.intercept)


def calibrated(score: Column, fit: tuple[float, float] | None) -> Column:
    return score if fit is None else 1 / (1 + F.exp(-(score * fit[0] + fit[1])))


# What a rejection is called in reports, by what its stage's name holds, in order.
CAUSES = (("gate", "Metagenomics Gate"), ("stage2", "Stage 2: Score Too Low"), ("stage1", "Stage 1: MeSH Reject"), ("stage3.5", "Stage 3.5: Embedding Similarity Reject"), ("stage3", "Stage 3: ML Classifier Reject"), ("stage4", "Stage 4: LLM Reject"), ("llm", "Stage 4: LLM Reject"))
STAGES = (("stage1", "Stage 1: MeSH Metadata"), ("stage2", "Stage 2: Keyword Rules"), ("stage3.5", "Stage 3.5: Embedding Similarity"), ("stage3", "Stage 3: ML Classifier"), ("gate", "Metagenomics Gate"), ("stage4", "Stage 4: LLM Verifier"))


def named(stage: Column, table: tuple[tuple[str, str], ...]) -> Column:
    """The stage in words; its own name where none is known."""
    out = stage
    for sign, label in reversed(table):
        out = F.when(F.lower(stage).contains(sign), label).otherwise(out)
    return out
