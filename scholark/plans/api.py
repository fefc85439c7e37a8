"""The request surface without HTTP: routes, validation, limits and envelopes over the query engine.

A server of any kind passes (method, path, body, client) on and sends back (status, body).
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .engine import MOST_ROWS, Engine, validate

# Routes with the plan behind each and its parameters: (name, type, allowed values, required).
STUDY_TYPES = ("RCT", "observational", "meta_analysis", "review", "original_research", "any")
STRENGTHS = ("strong", "moderate", "weak", "any")
ROUTES: dict[str, tuple[str, tuple[tuple[str, Any, tuple | None, bool], ...]]] = {
    "/query/cross-study-associations": ("cross_study_associations", (("disease", str, None, True), ("study_type", str, STUDY_TYPES, False), ("min_papers", int, None, False), ("confidence_threshold", (int, float), None, False))),
    "/query/intervention-evidence": ("intervention_evidence", (("types", list, None, True), ("min_sample_size", int, None, False), ("evidence_strength", str, STRENGTHS, False))),
    "/query/methodology-landscape": ("methodology_landscape", (("year_start", int, None, True), ("year_end", int, None, True), ("methods", list, None, False), ("require_deposited_data", bool, None, False))),
    "/query/top-associations": ("top_associations", (("disease", str, None, True), ("top_n", int, None, False), ("min_confidence", (int, float), None, False))),
    "/query/conflicting-evidence": ("conflicting_evidence", (("disease", str, None, True), ("min_papers_per_direction", int, None, False))),
}
RANGES = {"confidence_threshold": (0, 1), "min_confidence": (0, 1), "min_papers": (1, 1000), "top_n": (1, MOST_ROWS), "min_sample_size": (0, 10**6), "min_papers_per_direction": (1, 1000), "year_start": (1900, 2100), "year_end": (1900, 2100)}


class Limiter:
    """At most ``most`` accepted requests of a client within ``seconds``; rejected ones don't count."""

    def __init__(self, most: int = 10, seconds: float = 60.0, clock: Callable[[], float] = time.time) -> None:
        self.most, self.seconds, self.clock = most, seconds, clock
        self.kept: dict[str, deque[float]] = {}

    def accept(self, client: str) -> bool:
        now, times = self.clock(), self.kept.setdefault(client, deque())
        while times and times[0] <= now - self.seconds:
            times.popleft()
        if len(times) >= self.most:
            return False
        times.append(now)
        return True


def missing(names: list[str], known: DataFrame, column: str = "name") -> list[str]:
    """Those of the names that the table of known ones lacks; case aside."""
    if not names:
        return []
    found = {r["n"] for r in known.select(F.lower(column).alias("n")).where(F.col("n").isin(*[n.lower() for n in names])).distinct().collect()}
    return [n for n in names if n.lower() not in found]


class Api:
    """Routes over an engine; ``known`` maps a parameter to the table of its names, where they must exist."""

    def __init__(self, engine: Engine, limiter: Limiter | None = None, known: dict[str, DataFrame] | None = None) -> None:
        self.engine, self.limiter, self.known = engine, limiter or Limiter(), known or {}

    def handle(self, method: str, path: str, body: dict[str, Any] | None = None, client: str = "anonymous") -> tuple[int, dict[str, Any]]:
        fixed = {("GET", "/"): self._root, ("GET", "/health"): self._health, ("GET", "/cache/stats"): self._stats, ("POST", "/cache/invalidate"): self._invalidate, ("GET", "/limits"): self._limits}
        if (method, path) in fixed:
            return fixed[method, path]()
        if path not in ROUTES:
            return 404, {"error": "no such route"}
        if method != "POST":
            return 405, {"error": "only POST"}
        if not self.limiter.accept(client):
            return 429, {"error": f"more than {self.limiter.most} requests in {self.limiter.seconds:g} seconds"}
        plan, fields = ROUTES[path]
        params, errors = self._checked(fields, body or {})
        if errors:
            return 400, {"errors": errors}
        result = self.engine.run(plan, path, **params)
        if result.error is not None:
            return 500, {"error": result.error}
        return 200, {"query": plan, "rows": result.rows, "count": result.count, "seconds": round(result.seconds, 3), "cached": result.cached, "timed_out": result.timed_out}

    def _checked(self, fields: tuple, body: dict[str, Any]) -> tuple[dict[str, Any], list[str]]:
        params, errors = {}, [f"{k}: unknown parameter" for k in sorted(set(body) - {f[0] for f in fields})]
        for name, kind, allowed, required in fields:
            value = body.get(name)
            if value is None:
                if required:
                    errors.append(f"{name}: missing")
                continue
            error = validate(name, value, kind, allowed)
            if error is None and isinstance(value, list):
                error = next((e for e in (validate(name, v, str) for v in value) if e), None)
            if error is None and name in RANGES and not RANGES[name][0] <= value <= RANGES[name][1]:
                error = f"{name}: out of range"
            if error is None and name in self.known and (gone := missing(value if isinstance(value, list) else [value], self.known[name])):
                error = f"{name}: unknown {', '.join(gone)}"
            if error is None:
                params[name] = value
            else:
                errors.append(error)
        if not errors and params.get("year_start", 0) > params.get("year_end", 9999):
            errors.append("year_start: after year_end")
        return params, errors

    def _root(self) -> tuple[int, dict[str, Any]]:
        return 200, {"queries": sorted(ROUTES), "management": ["/health", "/cache/stats", "/cache/invalidate", "/limits"]}

    def _health(self) -> tuple[int, dict[str, Any]]:
        try:
            self.engine.spark.range(1).count()
        except Exception as e:  # noqa: BLE001 - the answer says so
            return 503, {"status": "unavailable", "error": str(e).split("\n")[0]}
        return 200, {"status": "healthy", "cache": self.engine.cache.stats()}

    def _stats(self) -> tuple[int, dict[str, Any]]:
        return 200, self.engine.cache.stats()

    def _invalidate(self) -> tuple[int, dict[str, Any]]:
        return 200, {"invalidated": self.engine.cache.invalidate()}

    def _limits(self) -> tuple[int, dict[str, Any]]:
        return 200, {"requests": self.limiter.most, "seconds": self.limiter.seconds, "max_rows": self.engine.most_rows}
