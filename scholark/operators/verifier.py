"""Verification of undecided records by a model, in batches, behind a callable; and the combined classifier."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH = 16
VERDICT = "keep boolean, confidence double, reason string"
Ask = Callable[[list[str]], str]


def verdict_key(title: Column, abstract: Column) -> Column:
    """Key of a cached verdict."""
    return F.md5(F.concat_ws("|", F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit(""))))


def parse_answer(answer: str | None, size: int) -> list[tuple[bool, float, str]] | None:
    """Verdicts of one answer, by position; None where it is unreadable or of another length."""
    found = re.search(r"\[.*\]", re.sub(r"<think>.*?</think>|```(?:json)?", "", answer or "", flags=re.S), re.S)
    try:
        items = json.loads(found.group()) if found else None
        if not isinstance(items, list) or len(items) != size:
            return None
        return [(bool(x["keep"]), min(1.0, max(0.0, float(x.get("confidence", 0.5)))), str(x.get("reason", ""))) for x in items]
    except (ValueError, TypeError, KeyError, AttributeError):
        return None


def ask_batch(texts: list[str], ask: Ask) -> list[tuple[bool, float, str] | None]:
    """Verdicts of a batch: asked twice, then in halves; a single text that has no answer gets None."""
    for _ in range(2):
        try:
            got = parse_answer(ask(texts), len(texts))
        except Exception:  # noqa: BLE001 - the service failed; try again, then smaller
            got = None
        if got is not None:
            return list(got)
    if len(texts) == 1:
        return [None]
    half = len(texts) // 2
    return ask_batch(texts[:half], ask) + ask_batch(texts[half:], ask)


def verify(rows: DataFrame, key: str, text: str, ask: Ask, cache: DataFrame | None = None, batch: int = BATCH) -> DataFrame:
    """(key, keep, confidence, reason, review): every row once; a cached verdict is used, and what has no answer goes to a human.

    ``ask`` runs on the workers, one call a batch.  ``cache`` holds (key, keep, confidence, reason).
    """
    kind = dict(rows.select(key).dtypes)[key]
    todo = rows.select(key, F.coalesce(F.col(text), F.lit("")).alias("t_"))
    if cache is not None:
        todo = todo.join(cache.select(key).distinct(), key, "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo in range(0, len(frame), batch):
                part = frame.iloc[lo : lo + batch]
                got = ask_batch(part["t_"].tolist(), ask)
                yield pd.DataFrame({key: part[key].to_numpy(), "keep": pd.array([g[0] if g else None for g in got], dtype="boolean"), "confidence": [g[1] if g else None for g in got], "reason": [g[2] if g else "no answer" for g in got]})

    asked = todo.mapInPandas(run, f"{key} {kind}, {VERDICT}")
    got = asked if cache is None else asked.unionByName(rows.select(key).join(cache.dropDuplicates([key]), key).select(key, "keep", "confidence", "reason"))
    return got.withColumn("review", F.col("keep").isNull() | F.col("confidence").between(0.50, 0.6999999))


def train_with_validation(rows: DataFrame, features: list[str], label: str, folds: int = 3):
    """(model, F1 of the best parameters over the folds) of a logistic classifier."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    model = LogisticRegression(labelCol=label, maxIter=30, probabilityCol="p_", rawPredictionCol="raw_")
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), model])
    grid = ParamGridBuilder().addGrid(model.regParam, [0.0, 0.1]).build()
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="f1", probabilityCol="p_")
    fitted = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, seed=7).fit(rows.fillna(0.0, features))
    return fitted.bestModel, max(fitted.avgMetrics)


# When the combined classifier may decide.
LEAST_ROWS, LEAST_F1 = 200, 0.80
FEATURES = ["rule", "probability", "positive", "negative"]


def hybrid(labelled: DataFrame, label: str = "label"):
    """The combined classifier over the stages' four scores, or None with too few rows, one class only or too low an F1."""
    rows = labelled.where(F.col(label).isNotNull()).select(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in FEATURES], F.col(label).cast("double").alias(label))
    counts = rows.agg(F.count("*").alias("n"), F.count_distinct(label).alias("k")).first()
    if counts["n"] < LEAST_ROWS or counts["k"] < 2:
        return None
    model, f1 = train_with_validation(rows, FEATURES, label)
    return model if f1 >= LEAST_F1 else None


def hybrid_scores(rows: DataFrame, model, keep: float = 0.5) -> DataFrame:
    """``rows`` with ``combined`` and ``keep``; without a model both are null."""
    if model is None:
        return rows.withColumns({"combined": F.lit(None).cast("double"), "keep": F.lit(None).cast("boolean")})
    from pyspark.ml.functions import vector_to_array

    got = model.transform(rows.fillna(0.0, FEATURES)).withColumn("combined", F.round(vector_to_array("p_")[1], 6))
    return got.withColumn("keep", F.col("combined") >= keep)
