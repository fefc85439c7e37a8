"""Sources: stored collector output in JSON, XML and JSON lines, CSV overrides, full texts by priority.

Every reader declares its schema (no inference pass over the data) and keeps rows it can't read in
``_corrupt_record`` instead of losing them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import text


def read_papers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Stored records of all collection runs, with the file each came from."""
    schema = T.StructType([*schemas.PAPER.fields, T.StructField("_corrupt_record", T.StringType())])
    got = spark.read.schema(schema).option("mode", "PERMISSIVE").option("multiLine", True).json(paths)
    return got.select("*", F.col("_metadata.file_path").alias("file"))


def latest_per_key(papers: DataFrame) -> DataFrame:
    """First wins from the newest file on: one row per merge key."""
    from ..operators.dedup import record_key

    rows = record_key(papers).where("dedup_key is not null")
    cols = [c for c in rows.columns if c != "dedup_key"]
    got = rows.groupBy("dedup_key").agg(F.max_by(F.struct(*cols), F.struct("file", F.xxhash64("paper_id"))).alias("r"))
    return got.select("dedup_key", "r.*")


def read_metrics(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(run metrics, lines that are no records) of an append log; nothing is dropped silently."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    schema = T.StructType([f for f in schemas.RUN_METRICS.fields if f.name != "_corrupt_record"])
    parsed = lines.withColumn("r", F.when(F.col("value").rlike(r"^\s*\{.*\}\s*$"), F.from_json("value", schema)))
    return parsed.where("r is not null").select("r.*"), parsed.where("r is null").select(F.col("value").alias("_corrupt_record"))


def read_overrides(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(overrides, rejected rows with reason) of a curators' CSV file."""
    from ..operators.audit import valid_id

    rows = spark.read.schema(schemas.OVERRIDE).option("header", True).csv(path)
    reason = F.when(F.col("surface_form").isNull() | F.col("canonical_id").isNull() | F.col("curator_id").isNull(), "missing value").when(F.length("justification") > 500, "justification too long").when(~valid_id(F.col("entity_type"), F.col("canonical_id")), "invalid id")
    rows = rows.withColumn("reason", reason)
    return rows.where("reason is null").drop("reason"), rows.where("reason is not null")


def items_of(raw: DataFrame, column: str, item: str) -> DataFrame:
    """Items of a response, under whichever of the usual names the service uses."""
    names = ("records", "resultList.result", "results", "hits", "items", "data")
    found = F.coalesce(*[F.from_json(F.get_json_object(column, f"$.{n}"), f"array<{item}>") for n in names])
    return raw.select(F.explode(found).alias("item")).select("item.*")


def from_openalex(rows: DataFrame) -> DataFrame:
    """Records with abstracts given as inverted indexes (``abstract_index`` map word -> positions)."""
    return rows.withColumn("abstract", F.when(F.col("abstract_index").isNotNull(), text.reconstruct(F.col("abstract_index")))).drop("abstract_index")


def from_crossref(rows: DataFrame) -> DataFrame:
    return rows.withColumn("abstract", text.strip_tags(F.col("abstract")))


def read_article_xml(spark: SparkSession, path: str, row_tag: str = "article") -> DataFrame:
    """Articles of an XML dump: title, abstract, year and sections."""
    schema = "title string, abstract string, year int, sec array<struct<title:string,p:array<string>>>"
    got = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path).where("title is not null and trim(title) <> ''")
    return got


def full_text(tiers: list[tuple[str, DataFrame]], key: str, papers: DataFrame, least: int = 300) -> DataFrame:
    """(key, content, tier): the first tier, in order, that holds enough text; each tier is (name, table of key, content)."""
    got = papers.select(key).distinct()
    columns: list[tuple[str, Column]] = []
    for n, (name, table) in enumerate(tiers):
        one = table.groupBy(key).agg(F.max("content").alias(f"t{n}"))
        got = got.join(one, key, "left")
        columns.append((name, F.when(F.length(F.trim(f"t{n}")) >= least, F.col(f"t{n}"))))
    content = F.coalesce(*[c for _, c in columns])
    tier = reduce(lambda acc, nc: F.when(nc[1].isNotNull(), nc[0]).otherwise(acc), reversed(columns), F.lit(None).cast("string"))
    return got.select(key, content.alias("content"), tier.alias("tier"))


def fetch_due(cache: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """Keys whose failed fetch is older than the negative cache's time to live."""
    return cache.where((F.col("status") != "exhausted") | (F.col("checked_at") < as_of - F.expr(f"interval {days} days")))


def parse_triples(rows: DataFrame, column: str) -> DataFrame:
    """Triples of a model's answer: thinking and fences cut, from the first to the last bracket, blanks dropped,
    confidence clamped to [.5, 1], evidence to 300 characters."""
    body = F.regexp_replace(F.regexp_replace(F.col(column), r"(?s)<think>.*?</think>", ""), r"```(?:json)?", "")
    body = F.regexp_extract(body, r"(?s)(\[.*\])", 1)
    got = rows.withColumn("t_", F.explode(F.from_json(body, T.ArrayType(schemas.TRIPLE))))
    got = got.select(*[c for c in rows.columns if c != column], "t_.*")
    ok = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    got = got.where(ok("subject") & ok("predicate") & ok("object"))
    return got.withColumns({"confidence": F.least(F.lit(1.0), F.greatest(F.lit(0.5), F.coalesce("confidence", F.lit(0.5)))), "evidence": F.substring("evidence", 1, 300)})


def parse_verdicts(rows: DataFrame, column: str) -> DataFrame:
    """A verifier's verdicts: JSON, else the bare flag at confidence .7, else a rejection at .5."""
    v = F.from_json(F.regexp_extract(column, r"(?s)(\{.*\})", 1), schemas.VERDICT)
    low = F.lower(column)
    fallback = F.when(low.rlike(r'"?keep"?\s*[:=]\s*true'), F.struct(F.lit(True).alias("keep"), F.lit(0.7).alias("confidence"), F.lit("text").alias("reason"))).otherwise(F.struct(F.lit(False).alias("keep"), F.lit(0.5).alias("confidence"), F.lit("error").alias("reason")))
    return rows.withColumn("verdict", F.when(v["keep"].isNotNull(), v).otherwise(fallback))


def parse_batch_verdicts(rows: DataFrame, key: str, column: str, size: int) -> DataFrame:
    """(key, pos, keep, confidence, reason) of answers to batches of ``size``: an object with ``results``, or a bare array.

    Verdicts are paired by position, so an answer with another number of them is none, and its batch has no row.
    """
    body = F.regexp_replace(F.regexp_replace(F.col(column), r"(?s)<think>.*?</think>", ""), r"```(?:json)?", "")
    listed = F.regexp_extract(body, r"(?s)(\[.*\])", 1)
    got = rows.select(key, F.from_json(listed, T.ArrayType(schemas.VERDICT)).alias("v")).where(F.size("v") == size)
    return got.select(key, F.posexplode("v").alias("pos", "x")).select(key, "pos", "x.*")


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """(section, term, weight) of a curators' file of lists: ``name:`` lines, below them ``term: weight`` or ``- term`` entries.

    Comments and blank lines are left out; an entry without a weight has null.  The file is small: one task reads it.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("n", "line"))
    body = F.trim(F.regexp_replace("line", r"(^|\s)#.*$", ""))
    rows = lines.select("n", "line", body.alias("body")).where("body <> ''")
    head = F.when(F.col("body").rlike(r"^[A-Za-z_]\w*:$"), F.regexp_extract("body", r"^(\w+):$", 1))
    named = rows.withColumn("section", F.last(head, ignorenulls=True).over(Window.orderBy("n"))).where(head.isNull())
    bare = F.regexp_replace("body", r"^-\s*", "")
    weight = F.nullif(F.regexp_extract(bare, r":\s*(-?[0-9]*\.?[0-9]+)$", 1), F.lit("")).try_cast("double")
    term = F.trim(F.translate(F.regexp_replace(bare, r":\s*-?[0-9]*\.?[0-9]+$", ""), "\"'", ""))
    return named.select("section", term.alias("term"), weight.alias("weight")).where("term <> ''")
