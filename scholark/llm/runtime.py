"""Helpers shared by the text operators: durable lineage cuts and Arrow batch mapping."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``; set a local one only where it is unset."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), "scholark-checkpoints")
    spark.sparkContext.setCheckpointDir(folder)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that lost executors cost no recomputation from the start.

    What comes after reads the checkpoint, so the shuffle files that led to it are deleted with the action's end.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint()  # the setting holds for plans made from here on
    finally:
        spark.conf.set(CLEANUP, before)


def drop(df: DataFrame) -> None:
    """Delete the checkpoint of a frame that ``cut`` gave and that nothing reads any more."""
    spark = df.sparkSession
    plan = df._jdf.queryExecution().logical()
    if not plan.getClass().getSimpleName().startswith("LogicalRDD"):
        return
    file = plan.rdd().getCheckpointFile()
    if file.isDefined():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` over ``fn``, which turns one batch into one batch (or None for no rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)
