"""Validation, audit, metrics and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIRECTIONS = ("increased", "decreased", "no_change", "associated")
STRENGTHS = ("weak", "moderate", "strong", "conflicting")
# Patterns of canonical ids by type, with the project's own prefixes.
ID_PATTERNS = (("taxon", r"^ncbx:[1-9][0-9]*$"), ("disease", r"^mshx:[A-Z][0-9]+$"), ("method", r"^METHOD-[A-Z0-9]+$"))


def relation_errors(strict: bool = False) -> Column:
    """Array of the names of the checks a relation fails."""
    allowed = DIRECTIONS[:3] if strict else DIRECTIONS
    checks = (
        ("confidence", F.col("confidence").isNull() | ~F.col("confidence").between(0.0, 1.0)), ("p_value", F.col("p_value").isNotNull() & ~F.col("p_value").between(0.0, 1.0)),
        ("direction", F.col("direction").isNull() | ~F.col("direction").isin(*allowed)), ("strength", F.col("evidence_strength").isNull() | ~F.col("evidence_strength").isin(*STRENGTHS)),
    )
    return F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks]), lambda x: x.isNotNull())


def split_valid(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with their errors)."""
    checked = rows.withColumn("errors", relation_errors())
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def error_queue_stats(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode(relation_errors(strict=True)).alias("error_type")).groupBy("error_type").agg(F.count("*").alias("n_rows"))


def valid_id(kind: Column, value: Column) -> Column:
    out = F.lit(False)
    for name, pattern in ID_PATTERNS:
        out = F.when(kind == name, value.rlike(pattern)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def statistics(rows: DataFrame, *groups: str) -> DataFrame:
    """Counts by each of the groups alone, and over all, in one pass."""
    sets = [[F.col(g)] for g in groups] + [[]]
    return rows.groupingSets(sets, *[F.col(g) for g in groups]).agg(F.count("*").alias("n_rows"))


def audit_query(log: DataFrame, since=None, until=None, limit: int = 1000, **equal) -> DataFrame:
    """Rows by optional predicates, newest first, at most ``limit`` (the feature's own cap)."""
    rows = log
    for k, v in sorted(equal.items()):
        if v is not None:
            rows = rows.where(F.col(k) == v)
    if since is not None:
        rows = rows.where(F.col("ts") >= since)
    if until is not None:
        rows = rows.where(F.col("ts") <= until)
    return rows.orderBy(F.desc_nulls_first("ts"), "event_id").limit(limit)


BUCKETS = 65_536


def drift_sample(decisions: DataFrame, key: str, share: float = 0.01, least: int = 10) -> DataFrame:
    """Sample without replacement of max(ceil(share * n), least) rows: the smallest hashes of the key.

    The hash's first 16 bits make a histogram, which tells up to which bucket whole ones belong to the sample; only the
    rows of the bucket at the edge are ordered.
    """
    order = F.md5(F.col(key).cast("string"))
    rows = decisions.withColumns({"h_": order, "b_": F.conv(F.substring(order, 1, 4), 16, 10).cast("int")})
    counts = sorted((r["b_"], r["n"]) for r in rows.where("b_ is not null").groupBy("b_").agg(F.count("*").alias("n")).collect())  # at most BUCKETS
    total = sum(n for _, n in counts)
    size = max(-(-int(total * share * 1_000_000) // 1_000_000), least)
    edge, room = BUCKETS, size
    for b, n in counts:
        if n > room:
            edge = b
            break
        room -= n
    whole = rows.where(F.col("b_") < edge)
    part = rows.where(F.col("b_") == edge).orderBy("h_", key).limit(room)
    return whole.unionByName(part).drop("h_", "b_")


def rolling_latency(log: DataFrame, source: str, order: str, value: str, width: int = 100) -> DataFrame:
    w = Window.partitionBy(source).orderBy(order, "event_id").rowsBetween(-(width - 1), 0)
    return log.select(source, "event_id", F.round(F.avg(value).over(w) + 1e-9, 6).alias("rolling_mean"))


def latency_percentiles(log: DataFrame, source: str, value: str) -> DataFrame:
    return log.groupBy(source).agg(F.round(F.percentile(value, 0.5), 6).alias("p50"), F.round(F.percentile(value, 0.95), 6).alias("p95"), F.count("*").alias("n_rows"))


def accepted_in_window(requests: DataFrame, client: str, ts: str, seconds: int, most: int, key: str = "event_id") -> DataFrame:
    """(key, client, accepted): a request passes while fewer than ``most`` accepted ones lie within ``seconds`` before it.

    Clients come one after the other in time (a sorted partition), so a task holds the accepted times of one client in
    the window, at most ``most`` numbers, however many requests the client makes.
    """
    from collections import deque
    from collections.abc import Iterator

    import pyarrow as pa

    kinds = dict(requests.select(key, client).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept = object(), deque()
        for batch in batches:
            verdicts = []
            for c, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if c != now:
                    now, kept = c, deque()
                while kept and kept[0] <= t - seconds * 1_000_000:
                    kept.popleft()
                ok = len(kept) < most
                if ok:
                    kept.append(t)
                verdicts.append(ok)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(verdicts, pa.bool_())], names=[key, client, "accepted"])

    rows = requests.where(F.col(client).isNotNull() & F.col(ts).isNotNull()).select(key, client, F.unix_micros(F.col(ts).cast("timestamp")).alias("at"))
    return rows.repartition(client).sortWithinPartitions(client, "at", key).mapInArrow(run, f"{key} {kinds[key]}, {client} {kinds[client]}, accepted boolean")


# Required properties and allowed directions of each relation type.
RELATIONS = (
    ("REPORTS_ASSOCIATION", ("increased", "decreased", "no_change", "associated")), ("REPORTS_INTERVENTION_EFFECT", ("increased", "decreased", "no_change")), ("TAXON_PRODUCES_METABOLITE", ("produces", "inhibits", "associated")),
    ("TAXON_MODULATES_PATHWAY", ("activates", "inhibits", "associated")), ("TAXON_REGULATES_GENE", ("upregulates", "downregulates", "associated")), ("TAXON_INFLUENCES_IMMUNE_CELL", ("activates", "suppresses", "recruits", "associated")),
    ("TAXON_AFFECTS_CLINICAL_OUTCOME", ("improves", "worsens", "associated")), ("METABOLITE_LINKED_TO_DISEASE", ("increased", "decreased", "associated")), ("METABOLITE_INDUCES_IMMUNE_RESPONSE", ("activates", "suppresses", "associated")),
    ("GENE_PREDISPOSES_TO_DISEASE", ("predisposes", "protective", "associated")), ("DIET_SHAPES_TAXON", ("enriches", "depletes", "associated")), ("ENVIRONMENT_SHAPES_TAXON", ("enriches", "depletes", "associated")),
)


def typed_errors(rel: Column, direction: Column, p_value: Column, sample_size: Column | None = None) -> Column:
    """Names of the checks a typed relation fails: its type, a direction of the type, p in [0, 1], a positive sample."""
    allowed = F.lit(False)
    for name, directions in RELATIONS:
        allowed = F.when(rel == name, F.coalesce(direction.isin(*directions), F.lit(False))).otherwise(allowed)
    known = F.coalesce(rel.isin(*[n for n, _ in RELATIONS]), F.lit(False))
    checks = [("type", ~known), ("direction", known & ~allowed), ("p_value", p_value.isNotNull() & ~p_value.between(0.0, 1.0))]
    if sample_size is not None:
        checks.append(("sample_size", sample_size.isNotNull() & (sample_size <= 0)))
    return F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks]), lambda x: x.isNotNull())
