"""Merging of records across sources, and incremental skips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import dedup_key

# Source priority of the collectors.
PRIORITY = ("pubmed", "europepmc", "semantic_scholar", "openalex", "crossref", "core")
FILLED = ("title", "doi", "pmid", "pmcid", "abstract", "journal", "issn", "publication_date", "publication_year", "volume", "issue", "pages", "citation_count", "reference_count", "full_text_url", "pdf_url")
LISTS = ("authors", "keywords", "mesh_terms", "article_types")
DEPOSIT = "10.5281/zenodo."


def source_priority(source: Column) -> Column:
    s = F.lower(F.trim(source))
    out = F.lit(len(PRIORITY))
    for k in range(len(PRIORITY) - 1, -1, -1):
        out = F.when(s == PRIORITY[k], k).otherwise(out)
    return out


def record_key(df: DataFrame) -> DataFrame:
    """The merge key; deposits with many versions share the key of their normalised title."""
    title = F.substring(F.trim(F.regexp_replace(F.regexp_replace(F.lower("title"), r"[^a-z0-9\s]", ""), r"\s+", " ")), 1, 120)
    deposit = F.lower(F.trim("doi")).startswith(DEPOSIT) & (title != "")
    return df.withColumn("dedup_key", F.when(deposit, F.concat(F.lit("deposit:"), title)).otherwise(dedup_key(F.col("doi"), F.col("pmid"), F.col("title"))))


def union_case_insensitive(lists: Column) -> Column:
    """Ordered union of an array of string arrays; of spellings that differ in case the first one stays."""
    step = lambda acc, x: F.when(F.exists(acc, lambda a: F.lower(a) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(F.flatten(F.filter(lists, lambda x: x.isNotNull())), F.array().cast("array<string>"), step)


def merge_records(df: DataFrame, order: tuple[str, ...] = ("paper_id",)) -> DataFrame:
    """One record per key: fields from the first source that has them, lists united, open access if any copy is.

    All aggregates are partial (min_by), so a key that a third of all rows share is combined before the shuffle; only
    list fields gather arrays, of distinct lists.
    """
    rows = record_key(df).where("dedup_key is not null")
    # of a deposit's versions the latest comes first, else the sources' order counts
    version = -F.coalesce(F.nullif(F.regexp_extract("doi", r"(?i)zenodo\.([0-9]+)", 1), F.lit("")).try_cast("bigint"), F.lit(0))
    place = F.when(F.col("dedup_key").startswith("deposit:"), version).otherwise(source_priority(F.col("source")).cast("bigint"))
    rows = rows.withColumn("rank", F.struct(place.alias("place"), *[F.col(c) for c in order]))
    present = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    fields = [F.min_by(F.when(present(c), F.col(c)), F.when(present(c), F.col("rank"))).alias(c) for c in FILLED if c in df.columns]
    lists = [F.sort_array(F.collect_set(F.when(F.size(c) > 0, F.struct("rank", F.col(c).alias("v"))))).alias(f"{c}_lists") for c in LISTS if c in df.columns]
    # the distinct sources in order: at most one entry a source
    named = F.array_sort(F.collect_set(F.struct(source_priority(F.col("source")).alias("k"), F.lower(F.trim("source")).alias("s"))))
    joined = F.array_join(F.transform(named, lambda x: x["s"]), "+")
    source = F.when(F.count("*") > 1, F.concat(F.lit("merged:"), joined)).otherwise(joined).alias("source")
    got = rows.groupBy("dedup_key").agg(F.count("*").alias("n_records"), source, F.coalesce(F.bool_or("is_open_access"), F.lit(False)).alias("is_open_access"), *fields, *lists)
    for c in LISTS:
        if c in df.columns:
            got = got.withColumn(c, union_case_insensitive(F.transform(f"{c}_lists", lambda x: x["v"]))).drop(f"{c}_lists")
    return got


def skip_processed(df: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    return df.join(processed.select(key).distinct(), key, "left_anti")


def first_by_key(df: DataFrame, key: Column, order: Column) -> DataFrame:
    """The first row of each key; keyless rows go."""
    cols = df.columns
    got = df.withColumn("k_", key).where("k_ is not null").groupBy("k_").agg(F.min_by(F.struct(*cols), order).alias("r"))
    return got.select("r.*")


def known_elsewhere(df: DataFrame, store: DataFrame) -> DataFrame:
    """Rows whose doi or pmid the store has: two semi joins, no disjunction in the join."""
    by_doi = df.join(store.select("doi").where("doi is not null").distinct(), "doi", "left_semi")
    by_pmid = df.join(store.select("pmid").where("pmid is not null").distinct(), "pmid", "left_semi")
    return by_doi.unionByName(by_pmid).dropDuplicates(["paper_id"])
