"""Sinks: parquet by partition, incremental appends, CSV reports, snapshots with rollback."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_new(rows: DataFrame, path: str, key: str, records_per_file: int = 500_000) -> DataFrame:
    """Append the rows whose key the store lacks (anti join on the key column alone), and return them."""
    spark = rows.sparkSession
    try:
        known = spark.read.parquet(path).select(key)
    except Exception as e:  # noqa: BLE001 - a store that does not exist yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        new = rows.dropDuplicates([key])
    else:
        new = rows.dropDuplicates([key]).join(known, key, "left_anti")
    new.write.mode("append").option("maxRecordsPerFile", records_per_file).parquet(path)
    return new


def write_relations(relations: DataFrame, path: str) -> None:
    """Relations by type: later reads of one type touch its files only."""
    relations.write.mode("overwrite").partitionBy("relation_type").parquet(path)


def write_decisions(decisions: DataFrame, path: str) -> None:
    """The filter's audit, by decision."""
    kind = F.when(F.col("review"), "review").when(F.col("keep"), "keep").otherwise("reject")
    decisions.withColumn("decision", kind).write.mode("overwrite").partitionBy("decision").parquet(path)


def rejected_report(decisions: DataFrame, path: str) -> None:
    """CSV of the rejected rows with the stage that rejected them in words."""
    cause = F.when(F.col("stage") == "stage1", "subject headings").when(F.col("stage") == "gate", "no method term").when(F.col("stage") == "stage2", "rule score").otherwise("undecided")
    decisions.where(~F.coalesce("keep", F.lit(False))).select("paper_id", "stage", cause.alias("cause"), "score").write.mode("overwrite").option("header", True).csv(path)


def snapshot(tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Write every table under the path; row counts for later verification."""
    counts = {}
    for name, df in sorted(tables.items()):
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        counts[name] = df.sparkSession.read.parquet(f"{path}/{name}").count()
    return counts


def verify(spark: SparkSession, path: str, counts: dict[str, int]) -> bool:
    return all(spark.read.parquet(f"{path}/{n}").count() == c for n, c in counts.items())


def rollback(spark: SparkSession, path: str, target: str, names: list[str]) -> None:
    """Overwrite the live tables with a snapshot."""
    for n in names:
        spark.read.parquet(f"{path}/{n}").write.mode("overwrite").parquet(f"{target}/{n}")


def append_batch(rows: DataFrame, path: str, key: str, batch: str, records_per_file: int = 5000) -> int:
    """Append what the store lacks as one batch, with its line in the manifest and its keys in the index; the number written."""
    new = append_new(rows, f"{path}/records", key, records_per_file)
    spark = rows.sparkSession
    keys = spark.read.parquet(f"{path}/records").select(key)
    known = _stored(spark, f"{path}/index")
    fresh = keys.distinct() if known is None else keys.distinct().join(known.select(key), key, "left_anti")
    fresh.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{path}/index")
    n = spark.read.parquet(f"{path}/index").where(F.col("batch") == batch).count()
    spark.createDataFrame([(batch, n)], "batch string, n_records long").withColumn("written_at", F.current_timestamp()).write.mode("append").json(f"{path}/manifest")
    return n if new is not None else 0


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001 - a store that does not exist yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def append_embeddings(vectors: DataFrame, path: str, key: str, vector: str, part: str) -> None:
    """Append vectors to their partition; those of another length than the store's are refused as a whole."""
    spark = vectors.sparkSession
    size = vectors.agg(F.min(F.size(vector)).alias("least"), F.max(F.size(vector)).alias("most")).first()
    known = _stored(spark, path)
    stored = known.select(F.size(vector)).first() if known is not None else None
    if size["most"] is not None and (size["least"] != size["most"] or (stored is not None and stored[0] != size["most"])):
        raise ValueError("vectors of different lengths")
    rows = vectors if known is None else vectors.join(known.select(key), key, "left_anti")
    rows.dropDuplicates([key]).write.mode("append").partitionBy(part).parquet(path)


def log_changes(changes: DataFrame, path: str, kind: str, actor: str, details: list[str]) -> None:
    """Modification log: one row per created or changed node or edge, its details as JSON."""
    rows = changes.select(F.lit(kind).alias("kind"), F.lit(actor).alias("actor"), F.to_json(F.struct(*details)).alias("details"), F.current_timestamp().alias("logged_at"))
    rows.write.mode("append").partitionBy("kind").parquet(path)


def log_resolutions(resolved: DataFrame, candidates: DataFrame, path: str) -> None:
    """Resolution audit: one row per form with its outcome and its conflict set (the candidates of all strategies)."""
    key = ["form", "entity_type"]
    sets = candidates.groupBy(*key).agg(F.array_sort(F.collect_set(F.struct("strategy", "canonical_id", "confidence"))).alias("conflict_set"))
    rows = resolved.join(sets, key, "left").withColumn("high_conflict", F.coalesce(F.size(F.array_distinct(F.transform("conflict_set", lambda c: c["strategy"]))) >= 3, F.lit(False)))
    rows.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def queue_invalid(rows: DataFrame, path: str) -> int:
    """Append the rows with errors to the queue for review; their number."""
    bad = rows.where(F.size("errors") > 0)
    bad.write.mode("append").json(path)
    return bad.count()


def log_run(spark: SparkSession, path: str, **metrics: object) -> None:
    """One line of metrics per run."""
    names = sorted(metrics)
    spark.createDataFrame([tuple(metrics[n] for n in names)], names).coalesce(1).write.mode("append").json(path)


def save_texts(texts: DataFrame, path: str, key: str = "content_hash", content: str = "content") -> None:
    """Content-addressed full texts, partitioned by the key's first two characters; known keys are not written again."""
    rows = texts.where(F.col(key).isNotNull() & (F.length(F.trim(content)) > 0)).select(key, content).dropDuplicates([key])
    known = _stored(texts.sparkSession, path)
    if known is not None:
        rows = rows.join(known.select(key), key, "left_anti")
    rows.withColumn("prefix", F.substring(key, 1, 2)).write.mode("append").partitionBy("prefix").parquet(path)


def load_texts(spark: SparkSession, path: str, keys: DataFrame, key: str = "content_hash") -> DataFrame:
    """Stored texts of the keys asked for; a key that isn't stored has no row."""
    return spark.read.parquet(path).join(keys.select(key).distinct(), key).drop("prefix")


def text_stats(spark: SparkSession, path: str, content: str = "content") -> DataFrame:
    return spark.read.parquet(path).agg(F.count("*").alias("n_texts"), F.sum(F.length(content)).alias("n_chars"), F.count_distinct("prefix").alias("n_prefixes"))
