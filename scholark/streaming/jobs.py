"""Scheduled micro-batches: when a job is due, and a collecting job over newly stored pages."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks

# The jobs and their times (hour; weekday with Sunday as 6, or day of the month).
JOBS = {"collect": (2, None, None), "retrain": (3, 6, None), "drift": (4, None, 1)}


def next_run(job: str, after: datetime) -> datetime:
    """The first time of the job after an instant."""
    hour, weekday, day = JOBS[job]
    at = after.replace(hour=hour, minute=0, second=0, microsecond=0)
    while at <= after or (weekday is not None and at.weekday() != weekday) or (day is not None and at.day != day):
        at += timedelta(days=1)
    return at


def due(job: str, last: datetime | None, now: datetime) -> bool:
    """Whether a job that ran at ``last`` has to run again; one that never ran is due."""
    return last is None or next_run(job, last) <= now


def collect_new(spark: SparkSession, pages: str, store: str, state: str, mapping: Callable[[DataFrame], DataFrame], key: str = "content_hash") -> None:
    """Append the records of all pages that came since the last run, each page once, then stop.

    The stream's checkpoint in ``state`` knows the pages; the store's index keeps a repeated batch from adding twice.
    """
    lines = spark.readStream.option("wholetext", "true").schema("value string").text(pages, wholetext=True)

    def write(batch: DataFrame, number: int) -> None:
        names = ("$.resultList.result", "$.results", "$.records", "$.hits", "$.items", "$.data", "$")
        found = F.coalesce(*[F.from_json(F.get_json_object("value", n), "array<string>") for n in names])
        sinks.append_batch(mapping(batch.select(F.explode(found).alias("item"))), store, key, f"batch-{number}")

    lines.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
