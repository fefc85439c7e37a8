"""Property graph as nodes and edges: export, statistics, and merging of nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nodes_from(rows: DataFrame, key: str, name: str, label: str, order: list[str]) -> DataFrame:
    """One node per id; the last seen name and label stay (partial aggregation, no sort)."""
    return rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max_by(name, F.struct(*order)).alias("name"), F.max_by(label, F.struct(*order)).alias("label"), F.count("*").alias("n_rows"))


def mention_edges(mentions: DataFrame) -> DataFrame:
    """MENTIONED_IN edges of grounded entities with their numbers; a paper that repeats one is one edge."""
    rows = mentions.where("ontology_id is not null and paper_id is not null")
    return rows.groupBy(F.col("ontology_id").alias("src"), F.col("paper_id").alias("dst")).agg(F.count("*").alias("n_mentions"), F.round(F.max("confidence"), 6).alias("confidence")).withColumn("rel", F.lit("MENTIONED_IN"))


def evidence_edges(items: DataFrame) -> DataFrame:
    """SUPPORTED_BY edges from claims to papers."""
    return items.where("claim_id is not null and paper_id is not null").groupBy(F.col("claim_id").alias("src"), F.col("paper_id").alias("dst")).agg(F.count("*").alias("n_items"), F.round(F.max("confidence"), 6).alias("confidence"))


def merge_nodes(edges: DataFrame, mapping: DataFrame, key: tuple[str, str, str] = ("src", "rel", "dst")) -> DataFrame:
    """Edges repointed to the surviving nodes; of edges that clash the more confident one stays, loops go.

    ``mapping`` (old, new) may be large; its chains are expected to be resolved.
    """
    m = mapping.select("old", "new")
    out = edges
    for c in (key[0], key[2]):
        out = out.join(m.withColumnRenamed("old", c), c, "left").withColumn(c, F.coalesce("new", c)).drop("new")
    return out.where(F.col(key[0]) != F.col(key[2])).groupBy(*key).agg(F.max("confidence").alias("confidence"), F.count("*").alias("n_merged"))


def merge_plan(mapping: DataFrame, nodes: DataFrame) -> DataFrame:
    """(old, new, reason): what speaks against each merge; null where it can be done.

    Both nodes must be known and of one label, and a node that goes may not be one that another is merged into.
    """
    label = lambda c: nodes.select(F.col("id").alias(c), F.col("label").alias(f"{c}_label"))
    kept = mapping.select(F.col("new").alias("old")).distinct().withColumn("kept", F.lit(True))
    rows = mapping.select("old", "new").distinct().join(label("old"), "old", "left").join(label("new"), "new", "left").join(kept, "old", "left")
    reason = F.when(F.col("old") == F.col("new"), "same node").when(F.col("old_label").isNull() | F.col("new_label").isNull(), "unknown node").when(F.col("old_label") != F.col("new_label"), "type conflict").when(F.col("kept"), "target of a merge")
    return rows.select("old", "new", reason.alias("reason"))


def neighbours(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, way, rel, other) of every node's edges, outbound and inbound; a node without edges of a way has one row of nulls."""
    out = nodes.select("id").join(edges.select(F.col("src").alias("id"), "rel", F.col("dst").alias("other")), "id", "left").withColumn("way", F.lit("out"))
    back = nodes.select("id").join(edges.select(F.col("dst").alias("id"), "rel", F.col("src").alias("other")), "id", "left").withColumn("way", F.lit("in"))
    return out.unionByName(back).select("id", "way", "rel", "other")
