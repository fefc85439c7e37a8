"""Views that present the tables at hand in the engine's terms; each has its SQL twin for the cross-check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


ARTICLE_TYPE = "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'RCT' WHEN '2' THEN 'original_research' WHEN '3' THEN 'meta_analysis' WHEN '4' THEN 'review' ELSE 'observational' END"
AVAILABILITY = "CASE o_orderstatus WHEN 'F' THEN 'open' WHEN 'O' THEN 'accession_linked' ELSE 'restricted' END"
DIRECTION = "CASE WHEN l_linenumber >= 7 THEN NULL WHEN l_linenumber = 6 THEN 'associated' WHEN l_returnflag = 'A' THEN 'decreased' WHEN l_returnflag = 'N' THEN 'no_change' ELSE 'increased' END"
STRENGTH = "CASE WHEN l_tax < 0.03 THEN 'weak' WHEN l_tax < 0.06 THEN 'moderate' ELSE 'strong' END"
SECTION = "CASE l_linenumber WHEN 1 THEN 'results' WHEN 2 THEN 'discussion' WHEN 3 THEN 'abstract' WHEN 4 THEN 'methods' ELSE 'introduction' END"
PREDICATE = "CASE l_returnflag WHEN 'A' THEN 'inhibits' WHEN 'N' THEN 'associated with' ELSE 'promotes' END"


def papers(spark: SparkSession, folder: str) -> DataFrame:
    """paper_id, title, year, article_type, data_availability, accession_numbers."""
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    sra = F.when(key % 3 == 0, F.concat(F.lit("SRP"), key.cast("string")))
    ena = F.when(key % 4 == 0, F.concat(F.lit("ERP"), key.cast("string")))
    return orders.select(
        key.alias("paper_id"), F.concat(F.lit("paper "), key.cast("string")).alias("title"), F.year("o_orderdate").alias("year"), F.expr(ARTICLE_TYPE).alias("article_type"),
        F.expr(AVAILABILITY).alias("data_availability"), F.filter(F.array(sra, ena), lambda x: x.isNotNull()).alias("accession_numbers"),
    )


PAPERS = f"papers_q AS (SELECT o_orderkey AS paper_id, 'paper ' || o_orderkey AS title, CAST(year(o_orderdate) AS INT) AS year, {ARTICLE_TYPE} AS article_type, {AVAILABILITY} AS data_availability, o_orderkey % 3 = 0 AS has_sra, o_orderkey % 4 = 0 AS has_ena FROM orders)"


def associations(spark: SparkSession, folder: str) -> DataFrame:
    """paper_id, taxon_id, taxon, disease, direction, confidence, p_value, strength."""
    lines, parts = table(spark, folder, "lineitem"), table(spark, folder, "part")
    places = table(spark, folder, "supplier").join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = lines.join(places.select("s_suppkey", "r_name"), F.col("l_suppkey") == F.col("s_suppkey")).join(parts.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.selectExpr("l_orderkey AS paper_id", "l_partkey AS taxon_id", "p_name AS taxon", "r_name AS disease", f"{DIRECTION} AS direction", "1 - l_discount * 5 AS confidence", "l_tax AS p_value", f"{STRENGTH} AS evidence_strength", "l_linenumber AS ord")


ASSOCIATIONS = f"associations AS (SELECT l_orderkey AS paper_id, l_partkey AS taxon_id, p_name AS taxon, r_name AS disease, {DIRECTION} AS direction, 1 - l_discount * 5 AS confidence, l_tax AS p_value, {STRENGTH} AS evidence_strength, l_linenumber AS ord FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"


def interventions(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").join(table(spark, folder, "part").select("p_partkey", "p_name", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.selectExpr("l_orderkey AS paper_id", "p_name AS taxon", "p_brand AS intervention_type", "CASE l_linestatus WHEN 'O' THEN 'increased' ELSE 'decreased' END AS effect_direction", "CAST(l_quantity AS BIGINT) AS sample_size", "1 - l_discount * 5 AS confidence", f"{STRENGTH} AS evidence_strength")


INTERVENTIONS = f"interventions AS (SELECT l_orderkey AS paper_id, p_name AS taxon, p_brand AS intervention_type, CASE l_linestatus WHEN 'O' THEN 'increased' ELSE 'decreased' END AS effect_direction, CAST(l_quantity AS BIGINT) AS sample_size, 1 - l_discount * 5 AS confidence, {STRENGTH} AS evidence_strength FROM lineitem JOIN part ON l_partkey = p_partkey)"


def methodology(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").join(table(spark, folder, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.selectExpr("l_orderkey AS paper_id", "p_type AS method")


METHODOLOGY = "methodology AS (SELECT l_orderkey AS paper_id, p_type AS method FROM lineitem JOIN part ON l_partkey = p_partkey)"


def triples(spark: SparkSession, folder: str) -> DataFrame:
    """Open-world triples: subject part, object supplier, one per line."""
    rows = table(spark, folder, "lineitem").join(table(spark, folder, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.selectExpr(
        "concat('T', l_partkey % 97) AS subject_id", "p_name AS subject_name", f"{PREDICATE} AS raw_predicate", "concat('D', l_suppkey % 41) AS object_id", "concat('disease ', l_suppkey % 41) AS object_name",
        "CASE WHEN l_suppkey % 2 = 0 THEN 'disease' ELSE 'metabolite' END AS object_type", "1 - l_discount * 5 AS confidence", "concat('o', l_orderkey) AS paper_id", f"{SECTION} AS section_type",
        "l_shipdate AS extracted_at", "l_orderkey * 8 + l_linenumber AS ord", "l_tax AS p_value", "l_orderkey",
    )


TRIPLES = f"triples AS (SELECT 'T' || l_partkey % 97 AS subject_id, p_name AS subject_name, {PREDICATE} AS raw_predicate, 'D' || l_suppkey % 41 AS object_id, 'disease ' || l_suppkey % 41 AS object_name, CASE WHEN l_suppkey % 2 = 0 THEN 'disease' ELSE 'metabolite' END AS object_type, 1 - l_discount * 5 AS confidence, 'o' || l_orderkey AS paper_id, {SECTION} AS section_type, l_shipdate AS extracted_at, l_orderkey * 8 + l_linenumber AS ord, l_tax AS p_value, l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey)"
