"""Registry of extraction methods: id, type, version, state, statistics and source hash."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The methods known from the start.
DEFAULTS = (("rule_association", "rule"), ("rule_intervention", "rule"), ("rule_methodology", "rule"), ("rule_pair", "rule"), ("dictionary_ner", "dictionary"), ("model_ner", "model"), ("llm_triple", "llm"), ("manual_curation", "manual"))


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m, t, "1.0", True, 0) for m, t in DEFAULTS], "method_id string, method_type string, version string, active boolean, n_extractions bigint")


def register(known: DataFrame, new: DataFrame) -> DataFrame:
    """Known methods plus the new ones; ids that exist stay as they are."""
    return known.unionByName(new.join(known.select("method_id"), "method_id", "left_anti"))


def deactivate(known: DataFrame, method_id: str) -> DataFrame:
    return known.withColumn("active", F.col("active") & (F.col("method_id") != method_id))


def with_counts(known: DataFrame, extractions: DataFrame) -> DataFrame:
    """Numbers of extractions by method, zero where there are none."""
    counts = extractions.groupBy("method_id").agg(F.count("*").alias("c"))
    return known.join(counts, "method_id", "left").withColumn("n_extractions", F.col("n_extractions") + F.coalesce("c", F.lit(0))).drop("c")


def unregistered(extractions: DataFrame, known: DataFrame) -> DataFrame:
    """Extractions by a method that is unknown or inactive."""
    return extractions.join(known.where("active").select("method_id"), "method_id", "left_anti")


def source_hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:16]
