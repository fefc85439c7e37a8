"""The query facade: validated requests, timed envelopes, a result cache with time to live."""

from __future__ import annotations

import hashlib
import json
import math
import re
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

MOST_ROWS = 1000
MOST_NAME, MOST_LIST = 200, 50
_NAME = re.compile(r"^[\w\s.,:;()'+/&-]+$")
_INJECTION = re.compile(r"(?i)\b(drop|delete|detach|merge|create|union|insert|update|exec)\b\s")


@dataclass
class Result:
    """Envelope of one query."""

    query: str
    description: str
    rows: list[dict[str, Any]] = field(default_factory=list)
    seconds: float = 0.0
    timed_out: bool = False
    cached: bool = False
    error: str | None = None

    @property
    def count(self) -> int:
        return len(self.rows)


def validate(name: str, value: Any, kind: type | tuple[type, ...], allowed: tuple | None = None) -> str | None:
    """Error message of a parameter, None if it is fine."""
    if not isinstance(value, kind) or (isinstance(value, bool) and bool not in (kind if isinstance(kind, tuple) else (kind,))):
        return f"{name}: wrong type"
    if isinstance(value, float) and not math.isfinite(value):
        return f"{name}: not a finite number"
    if isinstance(value, str):
        if not value.strip() or len(value) > MOST_NAME:
            return f"{name}: empty or too long"
        if not _NAME.match(value) or _INJECTION.search(value):
            return f"{name}: characters or words that are not allowed"
    if isinstance(value, list) and (not value or len(value) > MOST_LIST):
        return f"{name}: empty or too long a list"
    if allowed is not None and value not in allowed:
        return f"{name}: not one of the allowed values"
    return None


def clean_string(value: str) -> str:
    return value.replace("\x00", "").strip()


class ResultCache:
    """Rows by query and parameters, for a time to live; the clock is injected."""

    def __init__(self, ttl: float = 86_400.0, clock: Callable[[], float] = time.time) -> None:
        self.ttl, self.clock, self.lock = ttl, clock, threading.Lock()
        self.rows: dict[str, tuple[float, str, list[dict[str, Any]]]] = {}
        self.hits = self.misses = self.expired = 0

    @staticmethod
    def key(name: str, params: dict[str, Any]) -> str:
        return hashlib.sha256(f"{name}:{json.dumps(params, sort_keys=True, default=str)}".encode()).hexdigest()

    def get(self, name: str, params: dict[str, Any]) -> list[dict[str, Any]] | None:
        k = self.key(name, params)
        with self.lock:
            got = self.rows.get(k)
            if got and self.clock() - got[0] < self.ttl:
                self.hits += 1
                return got[2]
            if got:
                del self.rows[k]
                self.expired += 1
            self.misses += 1
            return None

    def put(self, name: str, params: dict[str, Any], rows: list[dict[str, Any]]) -> None:
        with self.lock:
            self.rows[self.key(name, params)] = (self.clock(), name, rows)

    def invalidate(self, name: str | None = None) -> int:
        with self.lock:
            gone = [k for k, v in self.rows.items() if name is None or v[1] == name]
            for k in gone:
                del self.rows[k]
            return len(gone)

    def stats(self) -> dict[str, float]:
        asked = self.hits + self.misses
        return {"hits": self.hits, "misses": self.misses, "expired": self.expired, "size": len(self.rows), "hit_rate": self.hits / asked if asked else 0.0}


class Engine:
    """Runs named plans and ad-hoc parameterised SQL within the limits; errors land in the envelope."""

    def __init__(self, spark: SparkSession, plans: dict[str, Callable[..., DataFrame]], cache: ResultCache | None = None, timeout: float = 30.0, most_rows: int = MOST_ROWS) -> None:
        self.spark, self.plans, self.cache, self.timeout, self.most_rows = spark, plans, cache or ResultCache(), timeout, most_rows

    def run(self, name: str, description: str = "", limit: int | None = None, **params: Any) -> Result:
        got = self.cache.get(name, {**params, "limit": limit})
        if got is not None:
            return Result(name, description, got, cached=True)
        result = self._timed(name, description, lambda: self.plans[name](**params), limit)
        if result.error is None:
            self.cache.put(name, {**params, "limit": limit}, result.rows)
        return result

    def sql(self, statement: str, description: str = "", limit: int | None = None, **params: Any) -> Result:
        """Ad-hoc SQL with named parameters; values never enter the text."""
        return self._timed("sql", description, lambda: self.spark.sql(statement, args=params), limit)

    def _timed(self, name: str, description: str, plan: Callable[[], DataFrame], limit: int | None) -> Result:
        start = time.monotonic()
        result = Result(name, description)
        try:
            rows = plan().limit(min(limit or self.most_rows, self.most_rows)).collect()
            result.rows = [r.asDict(recursive=True) for r in rows]
        except Exception as e:  # noqa: BLE001 - the envelope carries it
            result.error = str(e).split("\n")[0]
        result.seconds = time.monotonic() - start
        result.timed_out = result.seconds > self.timeout
        return result
