"""Claims: predicate registry, promotion of triples, reification, aggregation, updates and conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon, scoring

OPPOSITES = (("INHIBITS", "PROMOTES"), ("INCREASES", "DECREASES"))


def canonical_predicate(raw: Column) -> Column:
    """Exact entry, else the first entry that contains or is contained in the phrase, else RELATES_TO.

    The dictionary is a constant array and a constant map: a chain of cases as long as it would be too large a method
    for the JVM to compile.
    """
    low = F.lower(F.trim(raw))
    exact = F.try_element_at(F.create_map(*[F.lit(x) for entry in lexicon.PREDICATES for x in entry]), low)
    entries = F.array(*[F.struct(F.lit(known).alias("known"), F.lit(name).alias("name")) for known, name in lexicon.PREDICATES])
    loose = F.try_element_at(F.filter(entries, lambda e: low.contains(e["known"]) | e["known"].contains(low)), F.lit(1))["name"]
    return F.coalesce(exact, loose, F.lit("RELATES_TO"))


def predicate_category(raw: Column) -> Column:
    """Category with the most votes of words; the first on ties; ``generic`` without votes."""
    words = F.split(F.translate(F.lower(raw), "_-", "  "), r"\s+")
    count = lambda known: F.size(F.filter(words, lambda w: w.isin(*known.split())))
    votes = [count(known) for _, known in lexicon.CATEGORIES]
    top = F.greatest(*votes)
    out = F.lit("generic")
    for (name, _), v in reversed(list(zip(lexicon.CATEGORIES, votes, strict=True))):
        out = F.when((v == top) & (top > 0), name).otherwise(out)
    return out


def promoted_predicate(raw: Column) -> Column:
    """The canonical form of a promoted predicate; fragments, stop words and words about records are RELATES_TO."""
    v = F.lower(F.trim(raw))
    bad = (F.length(v) > lexicon.LONGEST_PREDICATE) | v.isin(*lexicon.NO_PREDICATES.split())
    for w in lexicon.RECORD_WORDS:
        bad = bad | v.contains(w)
    return F.when(bad, "RELATES_TO").otherwise(F.translate(F.upper(v), " -", "__"))


def promote_triples(triples: DataFrame, papers: DataFrame) -> DataFrame:
    """Triples with evidence and a confidence of at least .5, with canonical predicate, category and strength."""
    rows = triples.where((F.col("confidence") >= 0.5) & (F.trim("evidence") != ""))
    rows = rows.join(papers.select("paper_id", "article_type"), "paper_id", "left")
    return rows.withColumns(
        {
            "canonical_predicate": canonical_predicate(F.col("raw_predicate")), "predicate_category": predicate_category(F.col("raw_predicate")),
            "evidence_strength": scoring.strength_of_triple(F.col("confidence"), F.col("section_type"), F.col("article_type")),
        }
    )


def aggregate_open_world(promoted: DataFrame, min_papers: int = 2) -> DataFrame:
    """One claim per (subject, predicate, object) over all papers; names from the first triple.

    Triples of one paper are combined first, so papers are counted without a distinct aggregate, and no buffer holds a
    string (hash aggregates throughout); names are looked up for the claims that remain.
    """
    key = ["subject_id", "canonical_predicate", "object_id"]
    rank = scoring.strength_rank(F.col("evidence_strength"))
    papers = promoted.groupBy(*key, "paper_id").agg(
        F.sum("confidence").alias("c"), F.count("confidence").alias("n"), F.count_if(rank >= 2).alias("fair"), F.max(rank).alias("best"), F.min("ord").alias("ord"),
        F.min("extracted_at").alias("first_reported"), F.max("extracted_at").alias("last_updated"),
    )
    got = papers.groupBy(*key).agg(
        F.count("paper_id").alias("paper_count"), F.try_divide(F.sum("c"), F.sum("n")).alias("consensus_confidence"), F.sum("fair").alias("fair"), F.max("best").alias("best"), F.min("ord").alias("ord"),
        F.min("first_reported").alias("first_reported"), F.max("last_updated").alias("last_updated"),
    ).where(F.col("paper_count") >= min_papers)
    strength = F.when(F.col("fair") >= 3, "strong").otherwise(scoring.strength_name(F.col("best")))
    # ``ord`` numbers the triples; where it repeats, the first of a claim's own rows counts
    names = promoted.select("ord", *key, "subject_name", "object_name", "object_type")
    got = got.join(names, ["ord", *key])
    return got.select(*key, "subject_name", "object_name", "object_type", "paper_count", "consensus_confidence", strength.alias("evidence_strength"), "first_reported", "last_updated", F.sha2(F.concat_ws("|", *key), 256).alias("claim_id"))


def reify(relations: DataFrame, papers: DataFrame) -> DataFrame:
    """Claims per (source, predicate, target): mean confidence, distinct papers, strength from the first p-value.

    A claim with any supporting evidence below .5 is rejected as a whole.  Combined per paper first, without strings in a
    buffer; of the first paper's first relation the article type is looked up for the claims that remain.
    """
    key = ["taxon_id", "direction", "disease"]
    rows = relations.where("direction is not null")
    first = F.min(F.struct("ord", "p_value"))
    papers_of = rows.groupBy(*key, "paper_id").agg(F.sum("confidence").alias("c"), F.count("confidence").alias("n"), F.min("confidence").alias("least"), first.alias("f"))
    got = papers_of.groupBy(*key).agg(F.try_divide(F.sum("c"), F.sum("n")).alias("c"), F.min("least").alias("least"), F.count("paper_id").alias("paper_count"), F.min(F.struct("paper_id", "f.p_value")).alias("first"))
    got = got.where(F.col("least") >= 0.5).select(*key, "c", "paper_count", F.col("first.paper_id").alias("paper_id"), F.col("first.p_value").alias("p_value"))
    got = got.join(papers.select("paper_id", "article_type"), "paper_id", "left")
    return got.select(*key, F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), "c")), 6).alias("consensus_confidence"), "paper_count", scoring.strength_from_p(F.col("p_value"), F.col("article_type")).alias("evidence_strength"))


def folded_confidence(items: DataFrame, claim: str, confidence: str, order: list[str]) -> DataFrame:
    """Running update of a claim: the first item's confidence, then .9 of the old and .1 of the new, in order.

    The fold's closed form needs no list of a claim's items: item k of n weighs .1 * .9 ** (n - k), the first .9 ** (n - 1).
    """
    w = Window.partitionBy(claim).orderBy(*order)
    rows = items.where(F.col(confidence).isNotNull()).select(claim, F.col(confidence).alias("x"), F.row_number().over(w).alias("k"))
    n = rows.groupBy(claim).agg(F.count("*").alias("n"))
    weight = F.when(F.col("k") == 1, 1.0).otherwise(0.1) * F.pow(F.lit(0.9), F.col("n") - F.col("k"))
    return rows.join(n, claim).groupBy(claim).agg(F.sum(F.col("x") * weight).alias("confidence"), F.max("n").alias("n_items"))


def updated_claims(items: DataFrame, claim: str, paper: str, confidence: str, against: Column, order: list[str]) -> DataFrame:
    """(claim, confidence, n_support, n_against, ratio): items of new papers in order; a paper that a claim knows changes nothing.

    The first supporting item sets the confidence, each further one makes it .9 of the old and .1 of its own, and each
    contradiction takes a fifth away.  As every step is linear, an item's weight is the product of the factors after it:
    no list of a claim's items is gathered.
    """
    cols = list(dict.fromkeys([claim, paper, *order]))
    rows = items.where(F.col(claim).isNotNull() & F.col(paper).isNotNull() & F.col(confidence).isNotNull()).select(*cols, F.col(confidence).alias("x"), against.alias("against"))
    first = rows.groupBy(claim, paper).agg(F.min(F.struct(*order, "x", "against")).alias("f")).select(claim, *[F.col(f"f.{c}").alias(c) for c in (*order, "x", "against")])
    w = Window.partitionBy(claim).orderBy(*order)
    ranked = first.withColumn("k", F.count(F.when(~F.col("against"), 1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    factor = F.when(F.col("against"), 0.8).otherwise(0.9)
    after = F.coalesce(F.sum(F.log(factor)).over(w.rowsBetween(1, Window.unboundedFollowing)), F.lit(0.0))
    own = F.when(F.col("against"), 0.0).when(F.col("k") == 1, F.col("x")).otherwise(0.1 * F.col("x"))
    got = ranked.withColumn("part", own * F.exp(after)).groupBy(claim).agg(F.sum("part").alias("c"), F.count_if(~F.col("against")).alias("n_support"), F.count_if("against").alias("n_against"))
    return got.select(claim, F.round("c", 6).alias("confidence"), "n_support", "n_against", F.round(F.col("n_against") / (F.col("n_support") + F.col("n_against")), 6).alias("ratio"))


def opposite_claims(claims: DataFrame) -> DataFrame:
    """Pairs of claims on the same subject and object with opposite predicates; one equi-join on the mapped predicate."""
    flip = F.lit(None).cast("string")
    for a, b in OPPOSITES:
        flip = F.when(F.col("canonical_predicate") == a, b).otherwise(flip)
    left = claims.select("subject_id", "object_id", F.col("canonical_predicate").alias("predicate_a"), flip.alias("predicate_b"), F.col("paper_count").alias("papers_a")).where("predicate_b is not null")
    right = claims.select("subject_id", "object_id", F.col("canonical_predicate").alias("predicate_b"), F.col("paper_count").alias("papers_b"))
    return left.join(right, ["subject_id", "object_id", "predicate_b"])


def novel_predicates(triples: DataFrame, threshold: int = 5) -> DataFrame:
    """Frequency of each raw predicate by occurrence and by distinct paper, first and last seen, and promotion."""
    got = triples.groupBy("raw_predicate").agg(F.count("*").alias("frequency"), F.count_distinct("paper_id").alias("paper_frequency"), F.min("extracted_at").alias("first_seen"), F.max("extracted_at").alias("last_seen"))
    return got.withColumn("promoted", F.col("frequency") >= threshold)


def relation_statistics(relations: DataFrame) -> DataFrame:
    return relations.groupBy("rel_type").agg(F.count("*").alias("n_edges"), F.count_distinct("paper_id").alias("n_papers"))
