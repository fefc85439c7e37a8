"""Classes of journals from their free-entered names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon


def classify(names: DataFrame, reference: DataFrame) -> DataFrame:
    """(journal_name, journal_id, matched, quartile, is_open_access, is_predatory) of every distinct name.

    An entry of the same name, else the first entry whose name holds the cleaned one or is held by it, else signs in the
    name.  ``reference`` is a list of fixed size; only names without an exact entry are compared with it.
    """
    low = F.lower(F.trim("journal_name"))
    clean = F.trim(F.regexp_replace(F.regexp_replace(low, r"^(the|journal of the|journal of)\s+", ""), r"\s+", " "))
    rows = names.where(F.trim("journal_name") != "").select("journal_name").distinct().select("journal_name", low.alias("low"), clean.alias("clean"))
    known = reference.groupBy(F.lower("journal_name").alias("known")).agg(F.min("journal_id").alias("journal_id"))
    exact = rows.join(F.broadcast(known.withColumnRenamed("journal_id", "exact_id")), F.col("low") == F.col("known"), "left").drop("known")
    # one row: the whole list, in order of its ids
    entries = known.agg(F.array_sort(F.collect_list(F.struct("journal_id", "known"))).alias("entries"))
    held = F.filter("entries", lambda e: e["known"].contains(F.col("clean")) | F.col("clean").contains(e["known"]))
    rows = exact.crossJoin(F.broadcast(entries)).withColumn("partial_id", F.when(F.col("exact_id").isNull(), F.try_element_at(held, F.lit(1))["journal_id"])).drop("entries")
    rows = rows.withColumn("journal_id", F.coalesce("exact_id", "partial_id")).join(F.broadcast(reference.select("journal_id", "quartile", "is_open_access")), "journal_id", "left")
    signs = lambda words: F.coalesce(*[F.when(F.col("low").contains(w), True) for w in words], F.lit(False))
    matched = F.when(F.col("exact_id").isNotNull(), "exact").when(F.col("partial_id").isNotNull(), "partial").otherwise("guess")
    return rows.select("journal_name", "journal_id", matched.alias("matched"), F.coalesce("quartile", F.lit("unknown")).alias("quartile"), F.coalesce("is_open_access", signs(lexicon.OPEN_JOURNALS)).alias("is_open_access"), signs(lexicon.PREDATORY).alias("is_predatory"))
