"""All queries over the engine's general operators, each with its DuckDB counterpart where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicon, scoring, text
from ..operators import audit, claims, dedup, enrichment, extraction, graph, relevance, research, resolution, similarity
from . import adapters as a
from .adapters import table

Query = Callable[[SparkSession, str], DataFrame]
CACHED_NAMES = 10_000  # per label, as the reference loads
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def re2(pattern: str) -> str:
    """The pattern as a DuckDB string literal's content."""
    return pattern.replace("'", "''")


COUNTS = "count(*) FILTER (direction = 'increased') AS n_increased, count(*) FILTER (direction = 'decreased') AS n_decreased, count(*) FILTER (direction = 'no_change') AS n_no_change, count(*) FILTER (direction = 'associated') AS n_associated"
BLANK = r"[\t-\r \x1c-\x1f\x{85}\p{Z}]"  # white space of every script


def surface_sql(col: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower(nfc_normalize({col})), '[!-/:-@\[-`{{-~]', '', 'g'), '{BLANK}+', ' ', 'g'))"


# ---- research questions -------------------------------------------------------------------------------------------


@query(f"""
WITH {a.PAPERS}, {a.ASSOCIATIONS}, g AS (
  SELECT taxon_id, min(taxon) AS taxon, count(DISTINCT paper_id) AS paper_count, avg(confidence) AS c, count(direction) AS n_directions, {COUNTS}
  FROM associations JOIN papers_q USING (paper_id) WHERE disease = 'ASIA' AND confidence >= 0.7 AND data_availability = 'open' AND (has_sra OR has_ena)
  GROUP BY taxon_id HAVING count(DISTINCT paper_id) >= 3 AND avg(confidence) >= 0.7)
SELECT taxon_id, taxon, paper_count, round(c, 6) AS consensus_confidence, n_directions, n_increased, n_decreased, n_no_change, n_associated,
  CASE greatest(n_increased, n_decreased, n_no_change, n_associated) WHEN n_increased THEN 'increased' WHEN n_decreased THEN 'decreased' WHEN n_associated THEN 'associated' ELSE 'no_change' END AS consensus_direction,
  CASE WHEN n_directions > 0 THEN round(greatest(n_increased, n_decreased, n_no_change, n_associated)::DOUBLE / n_directions, 6) END AS direction_consistency
FROM g""")
def cross_study_associations(spark, folder):
    return research.cross_study_associations(a.associations(spark, folder), a.papers(spark, folder), "ASIA", "any", 3, 0.7)


@query(f"""
WITH {a.PAPERS}, {a.INTERVENTIONS}
SELECT intervention_type, taxon, effect_direction, CAST(sum(sample_size) AS BIGINT) AS total_sample_size, round(avg(confidence), 6) AS avg_confidence, count(DISTINCT paper_id) AS paper_count
FROM interventions JOIN papers_q USING (paper_id)
WHERE intervention_type IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#21', 'Brand#22', 'Brand#33') AND evidence_strength = 'strong' AND article_type IN ('original_research', 'meta_analysis')
GROUP BY ALL HAVING sum(sample_size) >= 50""")
def intervention_evidence(spark, folder):
    return research.intervention_evidence(a.interventions(spark, folder), a.papers(spark, folder), ["Brand#11", "Brand#12", "Brand#13", "Brand#21", "Brand#22", "Brand#33"])


@query(f"""
WITH {a.PAPERS}, {a.METHODOLOGY}, m AS (SELECT DISTINCT method, paper_id FROM methodology)
SELECT method, year, count(*) AS total_papers, count(*) FILTER (has_sra OR has_ena) AS papers_with_data, count(*) FILTER (has_sra) AS sra_papers, count(*) FILTER (has_ena) AS ena_papers,
  count(*) FILTER (has_sra AND has_ena) AS both_papers, round(count(*) FILTER (has_sra OR has_ena) * 100.0 / count(*), 4)::DOUBLE AS pct_with_data
FROM m JOIN papers_q USING (paper_id) WHERE year BETWEEN 1996 AND 1999 GROUP BY ALL""")
def methodology_landscape(spark, folder):
    return research.methodology_landscape(a.methodology(spark, folder), a.papers(spark, folder), 1996, 1999, require_deposited_data=False)


@query(f"""
WITH {a.ASSOCIATIONS}, g AS (
  SELECT taxon_id, min(taxon) AS taxon, count(DISTINCT paper_id) AS paper_count, avg(confidence) AS c, count(direction) AS n_directions, {COUNTS}
  FROM associations WHERE disease = 'EUROPE' AND confidence >= 0.7 GROUP BY taxon_id)
SELECT taxon_id, taxon, paper_count, round(c, 6) AS avg_confidence,
  CASE WHEN n_increased >= n_decreased AND n_increased >= n_no_change THEN 'increased' WHEN n_decreased >= n_increased AND n_decreased >= n_no_change THEN 'decreased' ELSE 'no_change' END AS consensus_direction,
  CASE WHEN n_directions > 0 THEN round(greatest(n_increased, n_decreased, n_no_change)::DOUBLE / n_directions, 6) END AS direction_consistency
FROM g ORDER BY paper_count DESC, avg_confidence DESC, taxon_id LIMIT 25""")
def top_associations(spark, folder):
    return research.top_associations(a.associations(spark, folder), "EUROPE", 25)


@query(f"""
WITH {a.PAPERS}, {a.ASSOCIATIONS}, g AS (
  SELECT taxon_id, min(taxon) AS taxon, count(*) FILTER (direction = 'increased') AS increased_count, count(*) FILTER (direction = 'decreased') AS decreased_count
  FROM associations JOIN papers_q USING (paper_id) WHERE disease = 'AMERICA' AND direction IN ('increased', 'decreased') GROUP BY taxon_id)
SELECT taxon_id, taxon, increased_count, decreased_count, increased_count + decreased_count AS total_count, round(increased_count * 100.0 / (increased_count + decreased_count), 4)::DOUBLE AS increased_pct,
  abs(increased_count - decreased_count) AS balance, increased_count AS n_increased_studies, decreased_count AS n_decreased_studies
FROM g WHERE increased_count >= 2 AND decreased_count >= 2""")
def conflicting_evidence(spark, folder):
    got = research.conflicting_evidence(a.associations(spark, folder), a.papers(spark, folder), "AMERICA")
    sizes = {"n_increased_studies": F.size("increased_studies").cast("bigint"), "n_decreased_studies": F.size("decreased_studies").cast("bigint")}
    return got.withColumns(sizes).drop("increased_studies", "decreased_studies")


CANONICAL = "CASE raw_predicate WHEN 'inhibits' THEN 'INHIBITS' WHEN 'promotes' THEN 'PROMOTES' WHEN 'associated with' THEN 'ASSOCIATED_WITH' ELSE 'RELATES_TO' END"
SINGLE = "CASE WHEN confidence < 0.7 THEN 'weak' WHEN section_type IN ('abstract', 'introduction') THEN 'weak' WHEN section_type IN ('results', 'discussion') THEN CASE WHEN article_type IN ('original_research', 'clinical_trial', 'RCT') AND confidence >= 0.85 THEN 'strong' ELSE 'moderate' END ELSE 'weak' END"
CLAIMS = f"""{a.PAPERS}, {a.TRIPLES}, promoted AS (
  SELECT t.*, {CANONICAL} AS canonical_predicate, {SINGLE} AS evidence_strength FROM triples t LEFT JOIN (SELECT 'o' || paper_id AS paper_id, article_type FROM papers_q) p USING (paper_id) WHERE confidence >= 0.5),
claims AS (
  SELECT subject_id, canonical_predicate, object_id, arg_min(subject_name, ord) AS subject_name, arg_min(object_name, ord) AS object_name, arg_min(object_type, ord) AS object_type, count(DISTINCT paper_id) AS paper_count,
    avg(confidence) AS consensus_confidence, CASE WHEN count(*) FILTER (evidence_strength IN ('moderate', 'strong')) >= 3 OR count(*) FILTER (evidence_strength = 'strong') > 0 THEN 'strong' WHEN count(*) FILTER (evidence_strength = 'moderate') > 0 THEN 'moderate' ELSE 'weak' END AS evidence_strength,
    min(extracted_at) AS first_reported, max(extracted_at) AS last_updated
  FROM promoted GROUP BY subject_id, canonical_predicate, object_id HAVING count(DISTINCT paper_id) >= 2)"""


def _promoted(spark, folder):
    papers = a.papers(spark, folder).select(F.concat(F.lit("o"), F.col("paper_id").cast("string")).alias("paper_id"), "article_type")
    return claims.promote_triples(a.triples(spark, folder).withColumn("evidence", F.lit("line")), papers)


def _claims(spark, folder):
    return claims.aggregate_open_world(_promoted(spark, folder))


@query(f"WITH {CLAIMS} SELECT subject_id, canonical_predicate, object_id, subject_name, object_name, paper_count, round(consensus_confidence, 6) AS consensus_confidence, evidence_strength, first_reported, last_updated FROM claims")
def aggregate_open_world_claims(spark, folder):
    cols = ["subject_id", "canonical_predicate", "object_id", "subject_name", "object_name", "paper_count", F.round("consensus_confidence", 6).alias("consensus_confidence"), "evidence_strength", "first_reported", "last_updated"]
    return _claims(spark, folder).select(*cols)


@query(f"WITH {CLAIMS} SELECT subject_id, canonical_predicate, object_id, paper_count, round(consensus_confidence, 6) AS consensus_confidence FROM claims WHERE canonical_predicate = 'PROMOTES' AND object_type = 'disease' AND paper_count >= 2 AND consensus_confidence >= 0.705")
def open_world_claims(spark, folder):
    got = research.open_world_claims(_claims(spark, folder), predicate="PROMOTES", object_type="disease", confidence_threshold=0.705)
    return got.select("subject_id", "canonical_predicate", "object_id", "paper_count", F.round("consensus_confidence", 6).alias("consensus_confidence"))


@query(f"""
WITH {CLAIMS}, edges AS (SELECT 'o' || l_orderkey AS source_name, 'disease ' || l_suppkey % 41 AS target_name, {a.PREDICATE} AS rel_type, 1 - l_discount * 5 AS confidence FROM lineitem)
SELECT 'paper_edge' AS origin, rel_type, round(confidence, 6) AS confidence, CASE WHEN target_name = 'disease 7' THEN source_name ELSE target_name END AS related_entity, CAST(1 AS BIGINT) AS paper_count FROM edges WHERE target_name = 'disease 7' OR source_name = 'disease 7'
UNION SELECT 'claim_subject', canonical_predicate, round(consensus_confidence, 6), object_name, paper_count FROM claims WHERE subject_name = 'disease 7'
UNION SELECT 'claim_object', canonical_predicate, round(consensus_confidence, 6), subject_name, paper_count FROM claims WHERE object_name = 'disease 7'""")
def entity_relationships(spark, folder):
    edges = table(spark, folder, "lineitem").selectExpr("concat('o', l_orderkey) AS source_name", "concat('disease ', l_suppkey % 41) AS target_name", f"{a.PREDICATE} AS rel_type", "1 - l_discount * 5 AS confidence")
    return research.entity_relationships(edges, _claims(spark, folder), "disease 7")


@query(f"WITH {CLAIMS} SELECT subject_id, canonical_predicate, object_id, paper_count, round(consensus_confidence, 6) AS consensus_confidence FROM claims WHERE regexp_full_match(canonical_predicate, 'PRO.*|INH.*') AND paper_count >= 2")
def cross_paper_predicates(spark, folder):
    got = research.cross_paper_predicates(_claims(spark, folder), "PRO.*|INH.*")
    return got.select("subject_id", "canonical_predicate", "object_id", "paper_count", F.round("consensus_confidence", 6).alias("consensus_confidence"))


# ---- claims -------------------------------------------------------------------------------------------------------


@query(f"""
WITH {a.PAPERS}, {a.ASSOCIATIONS}, r AS (SELECT s.*, article_type FROM associations s LEFT JOIN papers_q USING (paper_id)),
g AS (SELECT taxon_id, direction, disease, avg(confidence) AS c, min(confidence) AS least, count(DISTINCT paper_id) AS paper_count, arg_min({{'p': p_value, 't': article_type}}, {{'a': paper_id, 'b': ord}}) AS f FROM r GROUP BY ALL)
SELECT taxon_id, direction, disease, round(least(1.0, greatest(0.0, c)), 6) AS consensus_confidence, paper_count,
  CASE WHEN f.p IS NULL THEN 'weak' WHEN f.p < 0.01 AND f.t IN ('original_research', 'clinical_trial', 'RCT') THEN 'strong' WHEN f.p < 0.05 THEN 'moderate' ELSE 'weak' END AS evidence_strength
FROM g WHERE least >= 0.5 AND direction IS NOT NULL""")
def reify_claims(spark, folder):
    return claims.reify(a.associations(spark, folder), a.papers(spark, folder))


@query(f"WITH {a.TRIPLES} SELECT raw_predicate, count(*) AS frequency, count(DISTINCT paper_id) AS paper_frequency, min(extracted_at) AS first_seen, max(extracted_at) AS last_seen, count(*) >= 5 AS promoted FROM triples GROUP BY raw_predicate")
def novel_predicates(spark, folder):
    return claims.novel_predicates(a.triples(spark, folder))


@query(f"""
WITH {CLAIMS} SELECT x.subject_id, x.object_id, y.canonical_predicate AS predicate_b, x.canonical_predicate AS predicate_a, x.paper_count AS papers_a, y.paper_count AS papers_b
FROM claims x JOIN claims y ON x.subject_id = y.subject_id AND x.object_id = y.object_id AND x.canonical_predicate = 'INHIBITS' AND y.canonical_predicate = 'PROMOTES'""")
def opposite_claims(spark, folder):
    return claims.opposite_claims(_claims(spark, folder))


@query("""
SELECT claim_id, count(DISTINCT paper_id) AS paper_count, round(avg(confidence), 6) AS consensus_confidence,
  CASE WHEN count(*) FILTER (evidence_strength IN ('moderate', 'strong')) >= 3 OR count(*) FILTER (evidence_strength = 'strong') > 0 THEN 'strong' WHEN count(*) FILTER (evidence_strength = 'moderate') > 0 THEN 'moderate' ELSE 'weak' END AS strength,
  min(extraction_timestamp) AS first_reported, max(extraction_timestamp) AS last_updated
FROM evidence_items WHERE claim_id IS NOT NULL GROUP BY claim_id HAVING count(DISTINCT paper_id) >= 2""")
def evidence_item_claims(spark, folder):
    items = table(spark, folder, "evidence_items").where("claim_id is not null")
    got = items.groupBy("claim_id").agg(
        F.count_distinct("paper_id").alias("paper_count"), F.round(F.avg("confidence"), 6).alias("consensus_confidence"), scoring.claim_strength(F.col("evidence_strength")).alias("strength"),
        F.min("extraction_timestamp").alias("first_reported"), F.max("extraction_timestamp").alias("last_updated"),
    )
    return got.where("paper_count >= 2")


@query("""
WITH r AS (SELECT claim_id, confidence AS x, row_number() OVER (PARTITION BY claim_id ORDER BY extraction_timestamp NULLS FIRST, evidence_id) AS k, count(*) OVER (PARTITION BY claim_id) AS n FROM evidence_items WHERE confidence IS NOT NULL AND claim_id IS NOT NULL)
SELECT claim_id, round(sum(x * CASE WHEN k = 1 THEN 1.0::DOUBLE ELSE 0.1::DOUBLE END * pow(0.9::DOUBLE, n - k)), 6) AS confidence, max(n) AS n_items FROM r GROUP BY claim_id""")
def incremental_claim_confidence(spark, folder):
    items = table(spark, folder, "evidence_items").where("claim_id is not null")
    return claims.folded_confidence(items, "claim_id", "confidence", ["extraction_timestamp", "evidence_id"]).withColumn("confidence", F.round("confidence", 6))


@query(f"WITH {a.ASSOCIATIONS} SELECT coalesce(direction, 'none') AS rel_type, count(*) AS n_edges, count(DISTINCT paper_id) AS n_papers FROM associations GROUP BY ALL")
def relation_statistics(spark, folder):
    return claims.relation_statistics(a.associations(spark, folder).withColumn("rel_type", F.coalesce("direction", F.lit("none"))))


# ---- dedup and merge ----------------------------------------------------------------------------------------------

TITLE_SQL = r"substr(trim(regexp_replace(regexp_replace(lower(title), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g')), 1, 120)"
DEPOSIT_SQL = f"starts_with(lower(trim(doi)), '{dedup.DEPOSIT}') AND {TITLE_SQL} <> ''"
KEY_SQL = "coalesce('doi:' || lower(nullif(trim(doi), '')), 'pmid:' || nullif(trim(pmid), ''), 'title:' || left(lower(nullif(trim(title), '')), 80))"
RANK_SQL = "CASE lower(trim(source)) WHEN 'pubmed' THEN 0 WHEN 'europepmc' THEN 1 WHEN 'semantic_scholar' THEN 2 WHEN 'openalex' THEN 3 WHEN 'crossref' THEN 4 WHEN 'core' THEN 5 ELSE 6 END"


MERGE_KEY_SQL = f"CASE WHEN {DEPOSIT_SQL} THEN 'deposit:' || {TITLE_SQL} ELSE {KEY_SQL} END"


@query(f"SELECT paper_id, {MERGE_KEY_SQL} AS dedup_key FROM papers")
def dedup_keys(spark, folder):
    return dedup.record_key(table(spark, folder, "papers")).select("paper_id", "dedup_key")


PLACE_SQL = f"CASE WHEN starts_with(dedup_key, 'deposit:') THEN -coalesce(try_cast(nullif(regexp_extract(doi, '(?i)zenodo\\.([0-9]+)', 1), '') AS BIGINT), 0) ELSE {RANK_SQL} END"
PRESENT = [c for c in dedup.FILLED if c not in ("volume", "issue", "pages", "reference_count", "full_text_url", "pdf_url")]  # of the tables at hand


def _first(col: str) -> str:
    return f"arg_min({col}, {{'r': place, 'p': paper_id}}) FILTER ({col} IS NOT NULL AND CAST({col} AS VARCHAR) <> '') AS {col}"


@query(f"""
WITH k0 AS (SELECT *, {MERGE_KEY_SQL} AS dedup_key FROM papers), k AS (SELECT *, {PLACE_SQL} AS place, {RANK_SQL} || ':' || lower(trim(source)) AS named FROM k0 WHERE dedup_key IS NOT NULL),
g AS (SELECT dedup_key, count(*) AS n_records, coalesce(array_to_string(list_transform(list_sort(list(DISTINCT named) FILTER (named IS NOT NULL)), lambda x: substr(x, 3)), '+'), '') AS s, coalesce(bool_or(is_open_access), false) AS is_open_access, {", ".join(_first(c) for c in PRESENT)} FROM k GROUP BY dedup_key)
SELECT * EXCLUDE (s), CASE WHEN n_records > 1 THEN 'merged:' || s ELSE s END AS source FROM g""")
def merge_records(spark, folder):
    return dedup.merge_records(table(spark, folder, "papers").drop(*dedup.LISTS))


def _list_sql(col: str) -> str:
    return f"""{col}_v AS (SELECT DISTINCT dedup_key, place, paper_id, {col} AS v FROM k WHERE len({col}) > 0), {col}_u AS (SELECT dedup_key, place, paper_id, p, v[p] AS x FROM (SELECT *, unnest(range(1, len(v) + 1)) AS p FROM {col}_v)),
{col}_f AS (SELECT *, row_number() OVER (PARTITION BY dedup_key, lower(x) ORDER BY place, paper_id, p) AS n FROM {col}_u), {col}_l AS (SELECT dedup_key, string_agg(x, '|' ORDER BY place, paper_id, p) AS {col} FROM {col}_f WHERE n = 1 GROUP BY dedup_key)"""


@query(f"""WITH k0 AS (SELECT *, {MERGE_KEY_SQL} AS dedup_key FROM papers), k AS (SELECT *, {PLACE_SQL} AS place FROM k0 WHERE dedup_key IS NOT NULL), {", ".join(_list_sql(c) for c in dedup.LISTS)}
SELECT dedup_key, {", ".join(f"coalesce({c}, '') AS {c}" for c in dedup.LISTS)} FROM (SELECT DISTINCT dedup_key FROM k) {" ".join(f"LEFT JOIN {c}_l USING (dedup_key)" for c in dedup.LISTS)}""")
def merge_record_lists(spark, folder):
    got = dedup.merge_records(table(spark, folder, "papers"))
    return got.select("dedup_key", *[F.array_join(c, "|").alias(c) for c in dedup.LISTS])


@query("SELECT paper_id, md5(coalesce(title, 'None') || '|' || coalesce(abstract, 'None') || '|' || coalesce(array_to_string(authors, '|'), '')) AS hash FROM papers")
def content_hashes(spark, folder):
    return table(spark, folder, "papers").select("paper_id", text.content_hash(F.col("title"), F.col("abstract"), F.col("authors")).alias("hash"))


@query("SELECT content_hash, min(paper_id) AS paper_id, count(*) AS n_copies FROM papers WHERE content_hash IS NOT NULL GROUP BY content_hash")
def stored_batches_dedup(spark, folder):
    rows = table(spark, folder, "papers").where("content_hash is not null")
    return rows.groupBy("content_hash").agg(F.min("paper_id").alias("paper_id"), F.count("*").alias("n_copies"))


@query("SELECT paper_id, content_hash FROM papers p WHERE lower(trim(source)) = 'core' AND content_hash IS NOT NULL AND NOT EXISTS (SELECT 1 FROM papers q WHERE lower(trim(q.source)) = 'pubmed' AND q.content_hash = p.content_hash)")
def skip_processed(spark, folder):
    rows = table(spark, folder, "papers").where("content_hash is not null").select("paper_id", "content_hash", F.lower(F.trim("source")).alias("s"))
    return dedup.skip_processed(rows.where("s = 'core'"), rows.where("s = 'pubmed'"), "content_hash").select("paper_id", "content_hash")


@query("""
WITH c AS (SELECT * FROM papers WHERE lower(trim(source)) = 'crossref'), s AS (SELECT * FROM papers WHERE lower(trim(source)) = 'pubmed')
SELECT paper_id FROM c WHERE doi IN (SELECT doi FROM s WHERE doi IS NOT NULL) OR pmid IN (SELECT pmid FROM s WHERE pmid IS NOT NULL)""")
def store_membership(spark, folder):
    rows = table(spark, folder, "papers").withColumn("s", F.lower(F.trim("source"))).select("paper_id", "doi", "pmid", "s")
    return dedup.known_elsewhere(rows.where("s = 'crossref'"), rows.where("s = 'pubmed'")).select("paper_id")


# ---- sentences and extraction -------------------------------------------------------------------------------------


SPACE = r"[\t-\r \x{85}\p{Z}]"  # white space as Unicode has it


def _pieces_sql(table_: str, key: str, col: str) -> str:
    """Sentences with their closing marks: a blank behind a mark is marked first, as RE2 looks at nothing behind."""
    cut = rf"string_split(regexp_replace({col}, '([.?!]){SPACE}+', '\1' || chr(1), 'g'), chr(1))"
    return rf"l AS (SELECT {key}, {col} AS whole, list_filter(list_transform({cut}, lambda s: regexp_replace(s, '^{SPACE}+|{SPACE}+$', '', 'g')), lambda s: s <> '') AS parts FROM {table_} WHERE {col} IS NOT NULL)"


@query(rf"""
WITH l AS (SELECT evidence_id, list_filter(list_transform(regexp_split_to_array(source_sentence, '[.!?]+{SPACE}+'), lambda s: regexp_replace(s, '^{SPACE}+|{SPACE}+$', '', 'g')), lambda s: s <> '') AS parts FROM evidence_items WHERE source_sentence IS NOT NULL)
SELECT evidence_id, CAST(p - 1 AS INT) AS pos, parts[p] AS sentence FROM (SELECT evidence_id, parts, unnest(range(1, len(parts) + 1)) AS p FROM l)""")
def relation_sentences(spark, folder):
    rows = table(spark, folder, "evidence_items").where("source_sentence is not null")
    return rows.select("evidence_id", F.posexplode(text.sentences_dropping(F.col("source_sentence"))).alias("pos", "sentence"))


@query(f"WITH {_pieces_sql('sections', 'section_id', 'content')} SELECT section_id, CAST(p - 1 AS INT) AS pos, parts[p] AS sentence FROM (SELECT section_id, parts, unnest(range(1, len(parts) + 1)) AS p FROM l)")
def promoter_sentences(spark, folder):
    rows = table(spark, folder, "sections").where("content is not null")
    return rows.select("section_id", F.posexplode(text.sentences_keeping(F.col("content"))).alias("pos", "sentence"))


@query(f"""WITH {_pieces_sql('sections', 'section_id', 'content')}
SELECT section_id, CAST(p - 1 AS INT) AS pos, CAST(nullif(strpos(whole, parts[p]) - 1, -1) AS INT) AS char_offset, array_to_string(parts[greatest(p - 2, 1):p + 2], ' ') AS context FROM (SELECT section_id, whole, parts, unnest(range(1, len(parts) + 1)) AS p FROM l)""")
def sentence_context(spark, folder):
    rows = table(spark, folder, "sections").where("content is not null").select("section_id", "content", text.sentences_keeping(F.col("content")).alias("all"))
    got = rows.select("section_id", "content", "all", F.posexplode("all").alias("pos", "sentence"))
    return got.select("section_id", "pos", text.char_offset(F.col("content"), F.col("sentence")).alias("char_offset"), text.context(F.col("all"), F.col("pos"), 2).alias("context"))


def _case(table_: tuple[tuple[str, str], ...], col: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({col}, '{re2(p)}') THEN '{n}'" for n, p in table_) + " END"


def _number_sql(pattern: str) -> str:
    return f"try_cast(nullif(regexp_extract(s, '(?i){pattern}', 1), '') AS DOUBLE)"


def _joined_sql(patterns: tuple[str, ...], col: str = "s") -> str:
    return f"regexp_matches({col}, '{re2(lexicon.joined(patterns))}')"


P_SQL = "coalesce(" + ", ".join(f"CASE WHEN {_number_sql(p)} BETWEEN 0 AND 1 THEN {_number_sql(p)} END" for p in lexicon.P_FORMS) + ")"
E_SQL = "coalesce(" + ", ".join(_number_sql(p) for p in lexicon.EFFECTS) + ")"
N_SQL = "CAST(coalesce(" + ", ".join(_number_sql(p) for p in lexicon.SAMPLE_FORMS) + ") AS BIGINT)"
COMPARED_SQL = f"regexp_matches(s, '(?i){lexicon.COMPARED}')"
COMPARISON_SQL = f"CASE WHEN {COMPARED_SQL} AND (contains(lower(s), 'healthy') OR contains(lower(s), 'control')) THEN 'vs healthy' WHEN {COMPARED_SQL} AND contains(lower(s), 'pre') AND contains(lower(s), 'post') THEN 'pre vs post' ELSE 'vs control' END"
SIGNIFICANT_SQL = f"regexp_matches(s, '(?i){lexicon.SIGNIFICANT}')"
DURATION_SQL = f"CASE WHEN regexp_extract(s, '(?i){lexicon.DURATION}', 1) <> '' THEN regexp_extract(s, '(?i){lexicon.DURATION}', 1) || ' ' || lower(regexp_extract(s, '(?i){lexicon.DURATION}', 2)) || 's' END"
DOSAGE_SQL = "coalesce(" + ", ".join(f"nullif(regexp_extract(lower(s), '{p}', 1), '')" for p in lexicon.DOSAGES) + ")"
STATEMENTS = f"""e AS (SELECT evidence_id, paper_id, source_sentence AS s FROM evidence_items WHERE source_sentence IS NOT NULL),
x AS (SELECT evidence_id, paper_id, {_case(text.DIRECTIONS, "s")} AS direction, {P_SQL} AS p_value, {E_SQL} AS effect_size, {_case(text.MEASURES, "s")} AS measure, {COMPARISON_SQL} AS comparison, {SIGNIFICANT_SQL} AS significant, {N_SQL} AS sample_size FROM e)"""


@query(f"""WITH {STATEMENTS} SELECT evidence_id, direction, p_value, effect_size, measure, comparison, significant, sample_size,
  round(least(1.0, CASE WHEN direction IS NOT NULL THEN 0.5 ELSE 0.0 END + CASE WHEN p_value IS NOT NULL THEN 0.3 ELSE 0.0 END + CASE WHEN effect_size IS NOT NULL THEN 0.15 ELSE 0.0 END + CASE WHEN measure IS NOT NULL THEN 0.05 ELSE 0.0 END), 6)::DOUBLE AS confidence FROM x""")
def association_statements(spark, folder):
    return extraction.statements(table(spark, folder, "evidence_items"), "evidence_id", "source_sentence")


def plain_sql(col: str) -> str:
    return rf"trim(regexp_replace(lower(nfc_normalize({col})), '[^\p{{L}}\p{{M}}\p{{N}}-]+', ' ', 'g'))"


OCCURRENCES = f"""dict AS (SELECT entity_type AS label, {plain_sql("primary_name")} AS term FROM canonical_entities UNION SELECT label, {plain_sql("text")} FROM (SELECT DISTINCT label, text FROM mentions WHERE label IS NOT NULL AND text IS NOT NULL)),
good AS (SELECT * FROM dict WHERE length(term) >= 2 AND NOT (label = 'disease' AND length(term) <= 3)),
s AS (SELECT evidence_id, paper_id, source_sentence AS raw, string_split({plain_sql("source_sentence")}, ' ') AS w FROM evidence_items WHERE source_sentence IS NOT NULL),
sizes AS (SELECT DISTINCT len(string_split(term, ' ')) AS n FROM good),
runs AS (SELECT DISTINCT evidence_id, paper_id, raw, array_to_string(w[i:i + n - 1], ' ') AS term FROM (SELECT evidence_id, paper_id, raw, w, unnest(range(1, len(w) + 1)) AS i FROM s) JOIN sizes ON i + n - 1 <= len(w)),
occ AS (SELECT evidence_id, paper_id, raw, label, term FROM runs JOIN good USING (term))"""


def _occurrences(spark, folder):
    entities, mentions = table(spark, folder, "canonical_entities"), table(spark, folder, "mentions")
    terms = entities.select(F.col("entity_type").alias("label"), F.col("primary_name").alias("term"))
    terms = terms.unionByName(mentions.where("label is not null and text is not null").select("label", F.col("text").alias("term")).distinct())
    return extraction.dictionary_mentions(table(spark, folder, "evidence_items"), "evidence_id", "source_sentence", terms)


@query(f"WITH {OCCURRENCES} SELECT evidence_id, label, term FROM occ")
def dictionary_mentions(spark, folder):
    return _occurrences(spark, folder)


def _pair_query(name: str, spec: extraction.Spec) -> None:
    prop = _case(spec.properties, "x.raw") if spec.properties else "NULL::VARCHAR"
    sql = f"""WITH {OCCURRENCES}, r AS (SELECT x.evidence_id, x.paper_id, x.raw AS s, x.term AS source, y.term AS target, {_case(spec.directions, "x.raw")} AS direction, {prop} AS property FROM occ x JOIN occ y ON x.evidence_id = y.evidence_id AND x.label = '{spec.source}' AND y.label = '{spec.target}'),
      q AS (SELECT *, {P_SQL} AS p_value FROM r WHERE direction IS NOT NULL), k AS (SELECT paper_id, article_type FROM ({ARTICLE_SQL}))
      SELECT '{name}' AS relation_type, evidence_id, source, target, direction, property, p_value, CASE WHEN p_value IS NULL THEN 0.5::DOUBLE ELSE 0.8::DOUBLE END AS confidence,
        CASE WHEN p_value < 0.01 AND article_type IN ('original_research', 'meta_analysis') THEN 'strong' WHEN p_value < 0.05 THEN 'moderate' ELSE 'weak' END AS evidence_strength FROM q LEFT JOIN k USING (paper_id)"""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        types = extraction.article_type(table(spark, folder, "papers"))
        got = extraction.pair_relations(table(spark, folder, "evidence_items"), _occurrences(spark, folder), spec, types)
        return got.select(F.lit(name).alias("relation_type"), "evidence_id", "source", "target", "direction", "property", "p_value", "confidence", "evidence_strength")

    run.__name__ = name
    query(sql)(run)


def _first_sql(col: str, rows: tuple) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({col}, '(?is){re2(p)}') THEN {{'kind': '{k}', 'c': {c}::DOUBLE}}" for p, k, c in rows) + " END"


def _article_sql() -> str:
    tags = "CASE " + " ".join(f"WHEN list_has_any(tags, [{', '.join(repr(t) for k, names in lexicon.TAGS if k == kind for t in names)}]) THEN {{'kind': '{kind}', 'c': 1.0::DOUBLE}}" for kind in lexicon.TYPES) + " END"
    found = ", ".join(f"CASE WHEN regexp_matches(a, '(?is){re2(p)}') THEN {{'c': {c}::DOUBLE, 'k': {-n}, 'kind': '{k}'}} END" for n, (p, k, c) in enumerate(lexicon.ABSTRACTS))
    parts = " + ".join(f"CASE WHEN contains(a, '{w}') THEN 1 ELSE 0 END" for w in lexicon.PARTS)
    return f"""WITH r0 AS (SELECT paper_id, list_transform(coalesce(article_types, []), lambda v: lower(trim(v, ' '))) AS tags, lower(coalesce(title, '')) AS t, lower(coalesce(abstract, '')) AS a FROM papers),
r1 AS (SELECT *, {parts} AS parts, list_max(list_filter([{found}], lambda z: z IS NOT NULL)) AS best FROM r0),
r2 AS (SELECT paper_id, coalesce({tags}, {_first_sql("t", lexicon.TITLES)}, CASE WHEN best IS NOT NULL THEN {{'kind': best.kind, 'c': best.c}} END,
  CASE WHEN parts >= 2 THEN coalesce({_first_sql("a", lexicon.OVERRIDES)}, CASE WHEN parts >= 3 THEN {{'kind': 'original_research', 'c': 0.60::DOUBLE}} ELSE {{'kind': 'original_research', 'c': 0.55::DOUBLE}} END) END,
  CASE WHEN list_contains(tags, '{lexicon.GENERIC_TAG}') THEN {{'kind': 'original_research', 'c': 0.65::DOUBLE}} END, {{'kind': 'unknown', 'c': 0.40::DOUBLE}}) AS x FROM r1)
SELECT paper_id, x.kind AS article_type, x.c AS confidence FROM r2"""


ARTICLE_SQL = _article_sql()


for _name, _spec in extraction.SPECS.items():
    _pair_query(_name, _spec)


def _found_sql(table_: lexicon.Table, col: str) -> str:
    every = [f"regexp_extract_all({col}, '(?i){p}')" for _, patterns in table_ for p in patterns]
    out = every[0]
    for e in every[1:]:
        out = f"list_concat({out}, {e})"
    return out


def _names_sql(table_: lexicon.Table, col: str) -> str:
    return ", ".join(f"CASE WHEN {_joined_sql(p, col)} THEN '{n}' END" for n, p in table_)


def _ordered_sql(expr: str) -> str:
    """A list without repeats, in the order of first places."""
    return f"list_transform(list_filter(list_zip({expr}, range(1, len({expr}) + 1)), lambda z: list_position({expr}, z[1]) = z[2]), lambda z: z[1])"


AVAILABILITY_SQL = f"""WITH r AS (SELECT section_id, content AS s, {_found_sql(lexicon.ACCESSIONS, "content")} AS a0, {_found_sql(lexicon.ADDRESSES, "content")} AS u0, list_filter([{_names_sql(lexicon.ACCESSIONS, "content")}, {_names_sql(lexicon.ADDRESSES, "content")}], lambda x: x IS NOT NULL) AS n0
  FROM sections WHERE section_type = 'data_availability' AND content IS NOT NULL),
q AS (SELECT *, {_joined_sql(lexicon.NOT_APPLICABLE, "lower(s)")} AS nothing FROM r),
t AS (SELECT *, CASE WHEN nothing THEN 'not_stated' WHEN len(a0) > 0 THEN 'accession_linked' WHEN len(u0) > 0 THEN 'open' WHEN {_joined_sql(lexicon.OPEN, "lower(s)")} THEN 'open' WHEN {_joined_sql(lexicon.RESTRICTED, "lower(s)")} THEN 'restricted' ELSE 'not_stated' END AS status FROM q)
SELECT section_id, status, CASE WHEN nothing THEN '' ELSE array_to_string({_ordered_sql("a0")}, '|') END AS accessions, CASE WHEN nothing THEN '' ELSE array_to_string({_ordered_sql("u0")}, '|') END AS addresses, CASE WHEN nothing THEN '' ELSE array_to_string({_ordered_sql("n0")}, '|') END AS repositories,
  CASE WHEN status = 'restricted' AND regexp_extract(s, '{lexicon.EMAIL}') <> '' THEN 'Contact: ' || regexp_extract(s, '{lexicon.EMAIL}') END AS contact FROM t"""


@query(AVAILABILITY_SQL)
def data_availability(spark, folder):
    rows = table(spark, folder, "sections").where("section_type = 'data_availability' and content is not null")
    got = extraction.availability(rows, "section_id", "content")
    return got.withColumns({c: F.array_join(c, "|") for c in ("accessions", "addresses", "repositories")})


DESIGN_ROWS = ", ".join(f"CASE WHEN regexp_matches(t, '(?is){re2(p)}') THEN {{'c': {c}::DOUBLE, 'k': {-k}, 'n': '{n}'}} END" for k, (n, c, p) in enumerate(lexicon.DESIGNS))


@query(f"""WITH x AS (SELECT paper_id, regexp_replace(coalesce(title, '') || ' ' || coalesce(abstract, ''), '(?i){lexicon.REGISTRATION}', ' ', 'g') AS t FROM papers),
y AS (SELECT paper_id, t, list_filter([{DESIGN_ROWS}], lambda z: z IS NOT NULL) AS found FROM x), b AS (SELECT *, list_max(found) AS best FROM y)
SELECT paper_id, best.n AS design, best.c AS confidence, CAST(len(found) AS INT) AS n_designs, len(found) > 0 AND regexp_matches(t, '(?i){lexicon.IS_RCT}') AS is_rct, len(found) > 0 AND regexp_matches(t, '(?i){lexicon.IS_PROSPECTIVE}') AS is_prospective FROM b""")
def study_design(spark, folder):
    return extraction.study_design(table(spark, folder, "papers"))


@query(ARTICLE_SQL)
def article_types(spark, folder):
    return extraction.article_type(table(spark, folder, "papers"))


@query(f"""SELECT info_id, CASE WHEN is_predatory THEN 'predatory' WHEN impact_factor IS NULL AND quartile IS NULL THEN 'unrated' ELSE coalesce(quartile, 'unranked') END AS class,
  round(CASE quartile WHEN 'Q1' THEN 0.30 WHEN 'Q2' THEN 0.20 WHEN 'Q3' THEN 0.10 WHEN 'Q4' THEN 0.05 ELSE 0.0 END + CASE WHEN is_open_access THEN 0.10 ELSE 0.0 END, 3)::DOUBLE AS score FROM journal_info""")
def journal_quality(spark, folder):
    rows = table(spark, folder, "journal_info")
    kind = F.when(F.col("is_predatory"), "predatory").when(F.col("impact_factor").isNull() & F.col("quartile").isNull(), "unrated").otherwise(F.coalesce("quartile", F.lit("unranked")))
    none, nothing = F.lit(None).cast("string"), F.lit(None).cast("double")
    score = scoring.quality(F.col("quartile"), none, none, nothing, F.lit(None).cast("int"), F.when(F.col("is_open_access"), "open"), none)
    return rows.select("info_id", kind.alias("class"), score.alias("score"))


@query("SELECT paper_id, lower(text) AS form, label, arg_min(text, mention_id) AS first_text, count(*) AS n FROM mentions WHERE trim(text) <> '' GROUP BY paper_id, lower(text), label")
def mention_groups(spark, folder):
    return extraction.distinct_mentions(table(spark, folder, "mentions"))


@query("""WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \\n\\r\\t\\f\\x0b]+'), lambda x: x <> '') AS words FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CAST(len(words) AS INT) AS n_words, CAST(greatest(0, len(words) - 51) // 350 + 1 AS INT) AS n_chunks FROM w""")
def word_chunks(spark, folder):
    words = F.filter(F.split("text", r"[ \n\r\t\f\x0b]+"), lambda w: w != "")
    rows = table(spark, folder, "documents").where("text is not null").select("doc_id", words.alias("words"))
    return rows.select("doc_id", F.size("words").alias("n_words"), F.size(text.chunks(F.col("words"))).alias("n_chunks"))


HEADER_SQL = extraction.HEADER.replace("'", "''")


@query(rf"""WITH l AS (SELECT section_id, i AS pos, trim(ls[i], ' ') AS line FROM (SELECT section_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT section_id, string_split_regex(content, '\r?\n') AS ls FROM sections WHERE content IS NOT NULL))),
b AS (SELECT *, trim(regexp_replace(line, '^[#=\s]+|[#=\s]+$', '', 'g'), ' ') AS bare FROM l), h AS (SELECT *, CASE WHEN regexp_matches(bare, '{HEADER_SQL}') THEN bare END AS header FROM b),
n AS (SELECT *, sum(CASE WHEN header IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY section_id ORDER BY pos) AS section_no FROM h)
SELECT section_id, CAST(section_no AS BIGINT) AS section_no, max(header) AS header, coalesce(string_agg(line, ' ' ORDER BY pos) FILTER (header IS NULL AND line <> ''), '') AS body FROM n GROUP BY section_id, section_no""")
def section_parse(spark, folder):
    return extraction.header_sections(table(spark, folder, "sections").where("content is not null"), "section_id", "content")


@query(rf"SELECT section_id, trim(regexp_replace(regexp_replace(content, '<[^>]+>', ' ', 'g'), '{SPACE}+', ' ', 'g')) AS stripped FROM sections WHERE content IS NOT NULL")
def stripped_tags(spark, folder):
    rows = table(spark, folder, "sections").where("content is not null")
    return rows.select("section_id", text.strip_tags(F.col("content")).alias("stripped"))


# ---- relevance ----------------------------------------------------------------------------------------------------

TEXT_SQL = "lower(coalesce(title, '') || ' ' || coalesce(abstract, ''))"
RULE_SQL = "round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, greatest(-1.0::DOUBLE, least(1.5::DOUBLE, " + " + ".join(f"CASE WHEN contains(t, '{w}') THEN {v}::DOUBLE ELSE 0.0::DOUBLE END" for w, v in relevance.POSITIVE + relevance.NEGATIVE) + ")) / 1.5::DOUBLE)), 3)"
GATE_SQL = "(" + " OR ".join(f"contains(t, '{w}')" for w in relevance.GATE) + ")"


def _list_sql(words: tuple[str, ...]) -> str:
    return "list_has_any(list_transform(coalesce(mesh_terms, []), lambda x: lower(x)), [" + ", ".join(f"'{w}'" for w in words) + "])"


META_SQL = f"CASE WHEN {_list_sql(relevance.ANIMAL)} AND NOT {_list_sql(relevance.HUMAN)} THEN 'REJECT' WHEN NOT {_list_sql(relevance.MICROBIOME)} THEN 'UNKNOWN' WHEN {_list_sql(relevance.HUMAN)} THEN 'KEEP' ELSE 'UNKNOWN' END"


@query(f"""WITH x AS (SELECT paper_id, mesh_terms, {TEXT_SQL} AS t FROM papers), y AS (SELECT paper_id, {META_SQL} AS m, {RULE_SQL} AS rule, {GATE_SQL} AS gate FROM x)
SELECT paper_id, CASE WHEN m <> 'UNKNOWN' THEN 'stage1' WHEN NOT gate THEN 'gate' WHEN rule >= 0.45 OR rule <= 0.1 THEN 'stage2' ELSE 'review' END AS stage, rule,
  CASE WHEN m <> 'UNKNOWN' THEN m = 'KEEP' WHEN NOT gate THEN false WHEN rule >= 0.45 THEN true WHEN rule <= 0.1 THEN false END AS keep FROM y""")
def relevance_cascade(spark, folder):
    rows = table(spark, folder, "papers")
    t = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("abstract", F.lit("")))
    return relevance.cascade(rows, t, "mesh_terms").select("paper_id", "stage", "rule", "keep")


@query(f"""WITH x AS (SELECT paper_id, mesh_terms, {TEXT_SQL} AS t FROM papers), y AS (SELECT {META_SQL} AS m, {RULE_SQL} AS rule, {GATE_SQL} AS gate FROM x)
SELECT CASE WHEN m <> 'UNKNOWN' THEN 'stage1' WHEN NOT gate THEN 'gate' WHEN rule >= 0.45 OR rule <= 0.1 THEN 'stage2' ELSE 'review' END AS stage, count(*) AS n_rows, round(avg(rule), 5) AS mean_rule FROM y GROUP BY 1""")
def filter_stage_counts(spark, folder):
    return relevance_cascade(spark, folder).groupBy("stage").agg(F.count("*").alias("n_rows"), F.round(F.avg("rule"), 5).alias("mean_rule"))


LABELLED = "labelled AS (SELECT mention_id, round(confidence, 3) AS score, CASE WHEN grounded THEN 1 ELSE 0 END AS label FROM mentions WHERE confidence IS NOT NULL)"


def _labelled(spark, folder):
    rows = table(spark, folder, "mentions").where("confidence is not null")
    return rows.select("mention_id", F.round("confidence", 3).alias("score"), F.when(F.col("grounded"), 1).otherwise(0).alias("label"))


@query(f"""WITH {LABELLED}, g AS (SELECT score, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos FROM labelled GROUP BY score)
SELECT score, n, pos, CAST(sum(n) OVER (ORDER BY score DESC) AS BIGINT) AS cum_n, CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS cum_pos, round(sum(pos) OVER (ORDER BY score DESC)::DOUBLE / sum(n) OVER (ORDER BY score DESC), 6) AS precision FROM g""")
def threshold_sweep(spark, folder):
    return relevance.sweep_counts(_labelled(spark, folder), "score", "label").select("score", "n", "pos", "cum_n", "cum_pos", F.round("precision", 6).alias("precision"))


@query(f"""WITH {LABELLED}, g AS (SELECT score, count(*) AS n, sum(label) AS pos FROM labelled GROUP BY score), p AS (SELECT score, sum(pos) OVER (ORDER BY score DESC)::DOUBLE / sum(n) OVER (ORDER BY score DESC) >= 0.9 AS ok FROM g),
h AS (SELECT score, min(CAST(ok AS INT)) OVER (ORDER BY score DESC) AS held FROM p), k AS (SELECT coalesce(min(score) FILTER (held = 1), 0.7) AS k FROM h)
SELECT CASE WHEN 0.3 >= k THEN 0.7::DOUBLE ELSE k END AS keep_at, 0.3::DOUBLE AS reject_at FROM k""")
def calibrated_thresholds(spark, folder):
    return relevance.calibrated_thresholds(_labelled(spark, folder), "score", "label")


@query(f"""WITH {LABELLED}, b AS (SELECT least(floor(score * 10), 9) AS bin, count(*) AS n, avg(label) AS acc, avg(score) AS conf FROM labelled GROUP BY 1)
SELECT round(sum(n * abs(acc - conf)) / sum(n), 6) AS ece, CAST(sum(n) AS BIGINT) AS n_rows FROM b""")
def calibration_error(spark, folder):
    return relevance.calibration_error(_labelled(spark, folder), "score", "label")


@query()
def platt_scores(spark, folder):
    rows = _labelled(spark, folder)
    fit = relevance.platt(rows, "score", "label")
    return rows.select("mention_id", F.round(relevance.calibrated(F.col("score"), fit), 4).alias("probability"))


# ---- similarity ---------------------------------------------------------------------------------------------------

COS_SQL = "list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[]))"


@query(f"""WITH p AS (SELECT q.vec_id AS query_id, v.vec_id AS id, round({COS_SQL}, 4) AS similarity, row_number() OVER (PARTITION BY q.vec_id ORDER BY {COS_SQL} DESC, v.vec_id) AS rank
  FROM embeddings q JOIN embeddings v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id) SELECT query_id, id, similarity, CAST(rank AS INT) AS rank FROM p WHERE rank <= 10""")
def nearest_vectors(spark, folder):
    vectors = table(spark, folder, "embeddings")
    got = similarity.top_k(vectors, vectors.where("vec_id % 100 = 0"), "vec_id", "embedding", 10)
    return got.withColumn("similarity", F.round("similarity", 4))


def _partition_best(spark, folder):
    vectors = table(spark, folder, "embeddings")
    queries = vectors.where("vec_id % 100 = 0")
    best = lambda p: similarity.top_k(vectors.where(f"label % 2 = {p}"), queries, "vec_id", "embedding", 1).select("query_id", F.col("similarity").alias(f"s{p}"))
    return best(1).join(best(0), "query_id")


BEST_SQL = f"b AS (SELECT q.vec_id AS query_id, max({COS_SQL}) FILTER (v.label % 2 = 1) AS s1, max({COS_SQL}) FILTER (v.label % 2 = 0) AS s0 FROM embeddings q JOIN embeddings v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id GROUP BY q.vec_id)"


@query(f"WITH {BEST_SQL} SELECT query_id, round(s1, 4) AS positive, round(s0, 4) AS negative, CASE WHEN (SELECT count(*) FILTER (label % 2 = 1) < 50 OR count(*) FILTER (label % 2 = 0) < 50 FROM embeddings) THEN 'INACTIVE' WHEN s1 >= 0.85 AND s0 < 0.60 THEN 'KEEP' WHEN s0 >= 0.85 AND s1 < 0.60 THEN 'REJECT' ELSE 'BORDERLINE' END AS verdict FROM b")
def embedding_verdicts(spark, folder):
    sizes = table(spark, folder, "embeddings").agg(F.count_if(F.col("label") % 2 == 1).alias("n1"), F.count_if(F.col("label") % 2 == 0).alias("n0"))
    got = _partition_best(spark, folder).crossJoin(F.broadcast(sizes))  # one row
    verdict = relevance.embedding_verdict(F.col("s1"), F.col("s0"), F.col("n1"), F.col("n0"))
    return got.select("query_id", F.round("s1", 4).alias("positive"), F.round("s0", 4).alias("negative"), verdict.alias("verdict"))


@query(f"WITH {BEST_SQL} SELECT query_id, greatest(s1, s0) > 0.97 AS cached FROM b")
def semantic_cache_hits(spark, folder):
    return _partition_best(spark, folder).select("query_id", (F.greatest("s1", "s0") > 0.97).alias("cached"))


# ---- entity resolution --------------------------------------------------------------------------------------------


@query(f"SELECT synonym_id, {surface_sql('surface_form')} AS form FROM synonyms WHERE surface_form IS NOT NULL")
def surface_forms(spark, folder):
    rows = _synonyms(spark, folder)
    return rows.select("synonym_id", text.surface_form(F.col("surface_form")).alias("form"))


GIVEN = "surface_form IS NOT NULL"


def _synonyms(spark, folder):
    return table(spark, folder, "synonyms").where("surface_form is not null")


@query(f"WITH s AS (SELECT {surface_sql('surface_form')} AS form, canonical_id FROM synonyms WHERE canonical_id IS NOT NULL AND {GIVEN}) SELECT form, count(DISTINCT canonical_id) AS n_entities, count(*) AS n_rows FROM s WHERE form <> '' GROUP BY form HAVING count(DISTINCT canonical_id) > 1")
def synonym_conflicts(spark, folder):
    return resolution.synonym_conflicts(_synonyms(spark, folder))


@query(f"""WITH f AS (SELECT DISTINCT entity_type, {surface_sql('surface_form')} AS form FROM synonyms JOIN canonical_entities USING (canonical_id) WHERE {GIVEN}), n AS (SELECT DISTINCT entity_type, {surface_sql('primary_name')} AS name FROM canonical_entities)
SELECT entity_type, form, name, CAST(levenshtein(form, name) AS INT) AS distance, round(1 - levenshtein(form, name)::DOUBLE / greatest(length(form), length(name)) * 0.5, 6) AS confidence
FROM f JOIN n USING (entity_type) WHERE length(form) >= 4 AND length(name) >= 4 AND levenshtein(form, name) <= 2""")
def fuzzy_matches(spark, folder):
    entities = table(spark, folder, "canonical_entities").select("canonical_id", "entity_type", text.surface_form(F.col("primary_name")).alias("n"))
    forms = _synonyms(spark, folder).join(entities, "canonical_id").select("entity_type", text.surface_form(F.col("surface_form")).alias("f"))
    return resolution.fuzzy_join(forms, entities, "f", "n", "entity_type")


@query(f"WITH s AS (SELECT DISTINCT {surface_sql('surface_form')} AS form FROM synonyms WHERE {GIVEN}) SELECT form FROM s WHERE starts_with(form, 'bez') ORDER BY form LIMIT 50")
def prefix_lookup(spark, folder):
    return resolution.prefix_lookup(_synonyms(spark, folder).select(text.surface_form(F.col("surface_form")).alias("form")), "bez")


@query("WITH f AS (SELECT DISTINCT trim(text) AS form FROM mentions WHERE text IS NOT NULL), j AS (SELECT form, full_form FROM f JOIN abbreviations ON lower(form) = lower(abbreviated_form)) SELECT form, full_form, round(1.0 / count(*) OVER (PARTITION BY form), 6)::DOUBLE AS confidence FROM j")
def abbreviation_expansions(spark, folder):
    forms = table(spark, folder, "mentions").where("text is not null").select(F.trim("text").alias("form")).distinct()
    return resolution.expand_abbreviations(forms, table(spark, folder, "abbreviations"))


@query(r"""WITH f AS (SELECT DISTINCT trim(text) AS form FROM mentions WHERE label = 'taxon' AND regexp_full_match(lower(trim(text)), '[a-z]\. ?[a-z]{3,}')),
t AS (SELECT canonical_id, lower(substr(primary_name, 1, 1)) AS i, lower(split_part(primary_name, ' ', 2)) AS s FROM canonical_entities WHERE entity_type = 'taxon')
SELECT form, canonical_id, round(1.0 / count(*) OVER (PARTITION BY form), 6)::DOUBLE AS confidence FROM f JOIN t ON i = substr(lower(form), 1, 1) AND s = regexp_extract(lower(form), '([a-z]{3,})$', 1)""")
def genus_expansions(spark, folder):
    forms = table(spark, folder, "mentions").where("label = 'taxon' and text is not null").select(F.trim("text").alias("form"))
    return resolution.expand_genus(forms, table(spark, folder, "canonical_entities").where("entity_type = 'taxon'"))


RESOLVE_SQL = f"""f AS (SELECT DISTINCT text AS form, label AS entity_type, {surface_sql('text')} AS norm FROM mentions WHERE text IS NOT NULL AND label IS NOT NULL AND {surface_sql('text')} <> ''),
e AS (SELECT {surface_sql('primary_name')} AS norm, canonical_id, entity_type AS kind, primary_name, lower(substr(primary_name, 1, 1)) AS initial, lower(list_last(string_split(primary_name, ' '))) AS species FROM canonical_entities),
c_exact AS (SELECT DISTINCT form, entity_type, canonical_id, 'exact' AS strategy, 1.0::DOUBLE AS confidence FROM f JOIN e USING (norm)),
ab AS (SELECT DISTINCT {surface_sql('abbreviated_form')} AS norm, full_form AS full_name FROM abbreviations),
sp0 AS (SELECT form, entity_type, full_name FROM f JOIN ab USING (norm)),
gi AS (SELECT form, entity_type, primary_name AS full_name FROM f JOIN e ON kind = 'taxon' AND regexp_matches(lower(trim(form)), '^[a-z]\\. ?[a-z]{{3,}}$') AND initial = substr(lower(trim(form)), 1, 1) AND species = regexp_extract(lower(trim(form)), '([a-z]{{3,}})$', 1)
  WHERE NOT EXISTS (SELECT 1 FROM sp0 WHERE sp0.form = f.form AND sp0.entity_type = f.entity_type)),
sp AS (SELECT * FROM sp0 UNION SELECT * FROM gi), spn AS (SELECT *, count(*) OVER (PARTITION BY form, entity_type) AS n FROM sp),
c_abbr AS (SELECT DISTINCT form, entity_type, canonical_id, 'abbreviation' AS strategy, 1.0::DOUBLE / n AS confidence FROM spn JOIN e ON {surface_sql('full_name')} = e.norm),
c_syn AS (SELECT DISTINCT form, entity_type, canonical_id, 'synonym' AS strategy, 0.95::DOUBLE AS confidence FROM f JOIN (SELECT DISTINCT {surface_sql('surface_form')} AS norm, canonical_id FROM synonyms WHERE canonical_id IS NOT NULL) USING (norm)),
c_fuzzy AS (SELECT DISTINCT form, entity_type, canonical_id, 'fuzzy' AS strategy, round(1 - levenshtein(single, e.norm)::DOUBLE / greatest(length(single), length(e.norm)) * 0.5, 6) AS confidence
  FROM (SELECT *, regexp_replace(norm, '[^\\x00-\\x7F]', chr(1), 'g') AS single FROM f) JOIN e ON entity_type = kind AND abs(length(single) - length(e.norm)) <= 2 WHERE length(single) >= 4 AND length(e.norm) >= 4 AND levenshtein(single, e.norm) BETWEEN 1 AND 2),
cands AS (SELECT * FROM c_exact UNION ALL SELECT * FROM c_abbr UNION ALL SELECT * FROM c_syn UNION ALL SELECT * FROM c_fuzzy),
firsts AS (SELECT *, row_number() OVER (PARTITION BY form, entity_type ORDER BY CASE strategy WHEN 'exact' THEN 1 WHEN 'abbreviation' THEN 2 WHEN 'synonym' THEN 3 ELSE 4 END, confidence DESC, canonical_id) AS k FROM cands WHERE confidence >= 0.5),
resolved AS (SELECT form, entity_type, canonical_id, coalesce(strategy, 'unresolved') AS strategy, coalesce(confidence, 0.0::DOUBLE) AS confidence FROM f LEFT JOIN (SELECT * FROM firsts WHERE k = 1) USING (form, entity_type))"""


def _resolution_inputs(spark, folder):
    forms = table(spark, folder, "mentions").where("text is not null and label is not null").select(F.col("text").alias("form"), F.col("label").alias("entity_type"))
    return forms, table(spark, folder, "canonical_entities"), table(spark, folder, "synonyms"), table(spark, folder, "abbreviations")


@query(f"WITH {RESOLVE_SQL} SELECT form, entity_type, canonical_id, strategy, confidence FROM resolved")
def resolution_cascade(spark, folder):
    return resolution.resolve(*_resolution_inputs(spark, folder))


@query(f"WITH {RESOLVE_SQL} SELECT strategy, entity_type, count(*) AS n_total, count(canonical_id) AS n_resolved, count(*) - count(canonical_id) AS n_unresolved, round(avg(confidence) FILTER (canonical_id IS NOT NULL), 6) AS avg_confidence, round(avg(CASE WHEN canonical_id IS NOT NULL THEN 1 ELSE 0 END), 6) AS resolution_rate FROM resolved GROUP BY GROUPING SETS ((strategy), (entity_type), ())")
def resolution_metrics(spark, folder):
    return resolution.resolution_metrics(resolution_cascade(spark, folder))


SNAP_SQL = "snap AS (SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, avg(value) / 100 AS rate FROM events GROUP BY 1, 2)"


@query(f"""WITH {SNAP_SQL}, w AS (SELECT *, avg(rate) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior, lead(day) OVER (PARTITION BY event_type ORDER BY day) AS nx FROM snap)
SELECT event_type, day, round(rate, 6) AS rate, round(prior, 6) AS prior, round(prior - rate, 9) > 0.05 AS degraded FROM w WHERE nx IS NULL AND prior IS NOT NULL""")
def degradation(spark, folder):
    snaps = table(spark, folder, "events").groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg((F.avg("value") / 100).alias("rate"))
    return resolution.degradation(snaps, "event_type", "day", "rate")


@query("""WITH e AS (SELECT DISTINCT 'n' || n_nationkey AS c, 'r' || n_regionkey AS p FROM nation UNION SELECT DISTINCT 's' || s_suppkey, 'n' || s_nationkey FROM supplier UNION SELECT DISTINCT 'r' || r_regionkey, 'world' FROM region),
l1 AS (SELECT c AS node, p AS ancestor FROM e), l2 AS (SELECT DISTINCT node, p AS ancestor FROM l1 JOIN e ON ancestor = c), l3 AS (SELECT DISTINCT node, p AS ancestor FROM l2 JOIN e ON ancestor = c)
SELECT node, ancestor, 1 AS level, 0.5::DOUBLE AS confidence FROM l1 UNION ALL SELECT node, ancestor, 2, 0.4::DOUBLE FROM l2 UNION ALL SELECT node, ancestor, 3, 0.3::DOUBLE FROM l3""")
def ontology_ancestors(spark, folder):
    k = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = table(spark, folder, "nation").select(k("n", "n_nationkey").alias("c"), k("r", "n_regionkey").alias("p"))
    edges = edges.unionByName(table(spark, folder, "supplier").select(k("s", "s_suppkey").alias("c"), k("n", "s_nationkey").alias("p"))).unionByName(table(spark, folder, "region").select(k("r", "r_regionkey").alias("c"), F.lit("world").alias("p")))
    return resolution.ancestors(edges, "c", "p")


@query(f"SELECT synonym_id, {surface_sql('surface_form')} AS ours, surface_form_normalized AS theirs FROM synonyms WHERE {GIVEN} AND {surface_sql('surface_form')} IS DISTINCT FROM surface_form_normalized")
def shadow_differences(spark, folder):
    rows = _synonyms(spark, folder).select("synonym_id", text.surface_form(F.col("surface_form")).alias("ours"), F.col("surface_form_normalized").alias("theirs"))
    return rows.where(~F.col("ours").eqNullSafe(F.col("theirs")))


@query("SELECT entity_type, canonical_id, regexp_full_match(canonical_id, CASE entity_type WHEN 'taxon' THEN 'ncbx:[1-9][0-9]*' WHEN 'disease' THEN 'mshx:[A-Z][0-9]+' ELSE 'METHOD-[A-Z0-9]+' END) AS valid FROM canonical_entities")
def canonical_id_checks(spark, folder):
    rows = table(spark, folder, "canonical_entities")
    return rows.select("entity_type", "canonical_id", audit.valid_id(F.col("entity_type"), F.col("canonical_id")).alias("valid"))


# ---- graph --------------------------------------------------------------------------------------------------------


@query("SELECT ontology_id AS id, arg_max(ontology_name, mention_id) AS name, arg_max(label, mention_id) AS label, count(*) AS n_rows FROM mentions WHERE ontology_id IS NOT NULL AND ontology_name IS NOT NULL GROUP BY ontology_id")
def entity_nodes(spark, folder):
    return graph.nodes_from(table(spark, folder, "mentions").where("ontology_name is not null"), "ontology_id", "ontology_name", "label", ["mention_id"])


@query("SELECT ontology_id AS src, paper_id AS dst, count(*) AS n_mentions, round(max(confidence), 6) AS confidence, 'MENTIONED_IN' AS rel FROM mentions WHERE ontology_id IS NOT NULL AND paper_id IS NOT NULL GROUP BY 1, 2")
def mention_edges(spark, folder):
    return graph.mention_edges(table(spark, folder, "mentions"))


@query("SELECT claim_id AS src, paper_id AS dst, count(*) AS n_items, round(max(confidence), 6) AS confidence FROM evidence_items WHERE claim_id IS NOT NULL AND paper_id IS NOT NULL GROUP BY 1, 2")
def evidence_edges(spark, folder):
    return graph.evidence_edges(table(spark, folder, "evidence_items"))


@query(f"""WITH {a.ASSOCIATIONS}, e AS (SELECT CAST(taxon_id AS VARCHAR) AS src, coalesce(direction, 'none') AS rel, disease AS dst, confidence FROM associations), m AS (SELECT CAST(p_partkey AS VARCHAR) AS old, CAST(p_partkey // 10 AS VARCHAR) AS new FROM part WHERE p_partkey % 10 > 0 AND p_partkey >= 10)
SELECT coalesce(new, src) AS src, rel, dst, round(max(confidence), 6) AS confidence, count(*) AS n_merged FROM e LEFT JOIN m ON src = old GROUP BY 1, 2, 3""")
def merged_nodes(spark, folder):
    edges = a.associations(spark, folder).select(F.col("taxon_id").cast("string").alias("src"), F.coalesce("direction", F.lit("none")).alias("rel"), F.col("disease").alias("dst"), "confidence")
    k = F.col("p_partkey")
    mapping = table(spark, folder, "part").where((k % 10 > 0) & (k >= 10)).select(k.cast("string").alias("old"), F.floor(k / 10).cast("bigint").cast("string").alias("new"))
    return graph.merge_nodes(edges, mapping).withColumn("confidence", F.round("confidence", 6))


@query("SELECT label, count(DISTINCT lower(trim(text, ' '))) AS n_forms, count(DISTINCT paper_id) AS n_papers, count(*) AS n_mentions FROM mentions WHERE trim(text, ' ') <> '' GROUP BY label")
def standalone_entities(spark, folder):
    rows = table(spark, folder, "mentions").where(F.trim("text") != "")
    return rows.groupBy("label").agg(F.count_distinct(F.lower(F.trim("text"))).alias("n_forms"), F.count_distinct("paper_id").alias("n_papers"), F.count("*").alias("n_mentions"))


@query(r"WITH h AS (SELECT DISTINCT header FROM sections WHERE header IS NOT NULL), v AS (SELECT header, regexp_replace(upper(trim(header)), '[^A-Z0-9_]', '_', 'g') AS rel FROM h) SELECT header, CASE WHEN regexp_matches(rel, '^[A-Z]') THEN rel ELSE 'REL_' || rel END AS rel FROM v")
def relation_names(spark, folder):
    rows = table(spark, folder, "sections").where("header is not null").select("header").distinct()
    return rows.select("header", text.relation_name(F.col("header")).alias("rel"))


# ---- audit, metrics, summaries ------------------------------------------------------------------------------------


@query(f"""WITH {a.ASSOCIATIONS}, x AS (SELECT unnest(list_filter([CASE WHEN confidence IS NULL OR confidence NOT BETWEEN 0 AND 1 THEN 'confidence' END, CASE WHEN p_value NOT BETWEEN 0 AND 1 THEN 'p_value' END,
  CASE WHEN direction IS NULL OR direction NOT IN ('increased', 'decreased', 'no_change') THEN 'direction' END, CASE WHEN evidence_strength NOT IN ('weak', 'moderate', 'strong', 'conflicting') THEN 'strength' END], lambda v: v IS NOT NULL)) AS error_type FROM associations)
SELECT error_type, count(*) AS n_rows FROM x GROUP BY 1""")
def validation_errors(spark, folder):
    return audit.error_queue_stats(a.associations(spark, folder))


@query("SELECT event_type, user_id % 7 AS actor, count(*) AS n_rows FROM events GROUP BY GROUPING SETS ((event_type), (actor), ())")
def audit_statistics(spark, folder):
    return audit.statistics(table(spark, folder, "events").withColumn("actor", F.col("user_id") % 7), "event_type", "actor")


@query("SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type = 'click' ORDER BY ts DESC, event_id LIMIT 1000")
def audit_log_query(spark, folder):
    return audit.audit_query(table(spark, folder, "events"), event_type="click").select("event_id", "ts", "user_id", "event_type", "value")


@query("WITH n AS (SELECT greatest(CAST(ceil(count(*) * 0.01) AS BIGINT), 10) AS k FROM papers) SELECT paper_id, source FROM papers QUALIFY row_number() OVER (ORDER BY md5(paper_id), paper_id) <= (SELECT k FROM n)")
def drift_sample(spark, folder):
    return audit.drift_sample(table(spark, folder, "papers"), "paper_id").select("paper_id", "source")


@query("SELECT event_type, event_id, round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) + 1e-9::DOUBLE, 6) AS rolling_mean FROM events")
def rolling_latency(spark, folder):
    return audit.rolling_latency(table(spark, folder, "events"), "event_type", "ts", "value")


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, count(*) AS n_rows FROM events GROUP BY event_type")
def latency_percentiles(spark, folder):
    return audit.latency_percentiles(table(spark, folder, "events"), "event_type", "value")


@query("""WITH RECURSIVE r AS (SELECT event_id, user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
w AS (SELECT event_id, user_id, k, [t] AS kept, true AS accepted FROM r WHERE k = 1
  UNION ALL SELECT r.event_id, r.user_id, r.k, CASE WHEN len(list_filter(w.kept, lambda x: x > r.t - 43200000000)) < 2 THEN list_append(list_filter(w.kept, lambda x: x > r.t - 43200000000), r.t) ELSE list_filter(w.kept, lambda x: x > r.t - 43200000000) END,
    len(list_filter(w.kept, lambda x: x > r.t - 43200000000)) < 2 FROM w JOIN r ON r.user_id = w.user_id AND r.k = w.k + 1)
SELECT event_id, user_id, accepted FROM w""")
def rate_limit_window(spark, folder):
    """The limiter's rule with a window of half a day and two requests, as the events lie hours apart."""
    return audit.accepted_in_window(table(spark, folder, "events"), "user_id", "ts", 43_200, 2)


@query("SELECT lower(trim(source)) AS source, publication_year, is_open_access, count(*) AS n_rows FROM papers GROUP BY GROUPING SETS ((lower(trim(source))), (publication_year), (is_open_access), ())")
def collection_summary(spark, folder):
    rows = table(spark, folder, "papers").withColumn("source", F.lower(F.trim("source")))
    return audit.statistics(rows, "source", "publication_year", "is_open_access")


@query("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n_events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def hourly_events(spark, folder):
    from ..streaming.windows import tumbling

    return tumbling(table(spark, folder, "events"), "ts", "1 hour", ["event_type"], "value").withColumn("total", F.round("total", 4))


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def event_properties(spark, folder):
    return table(spark, folder, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("SELECT doc_id, lang, journal_id, journal_name, quartile FROM documents LEFT JOIN journals USING (journal_id)")
def document_journals(spark, folder):
    journals = table(spark, folder, "journals").select("journal_id", "journal_name", "quartile")
    return table(spark, folder, "documents").join(journals, "journal_id", "left").select("doc_id", "lang", "journal_id", "journal_name", "quartile")


# ---- enrichment and graph build -----------------------------------------------------------------------------------


@query("""WITH t AS (SELECT section_id, paper_id, sec_pos, CASE section_type WHEN 'results' THEN 1 WHEN 'discussion' THEN 2 WHEN 'conclusion' THEN 2 WHEN 'methods' THEN 3 WHEN 'introduction' THEN 4 END AS tier FROM sections)
SELECT *, CAST(row_number() OVER (PARTITION BY paper_id ORDER BY tier, sec_pos NULLS FIRST, section_id) AS INT) AS rank FROM t WHERE tier IS NOT NULL""")
def ranked_sections(spark, folder):
    return enrichment.ranked_sections(table(spark, folder, "sections"))


@query(f"""WITH {RESOLVE_SQL}, w AS (SELECT *, CASE strategy WHEN 'exact' THEN 0.95::DOUBLE WHEN 'abbreviation' THEN 0.80::DOUBLE WHEN 'synonym' THEN 0.75::DOUBLE ELSE 0.60::DOUBLE END AS weight FROM cands),
r AS (SELECT *, round(weight * confidence, 6) AS score, row_number() OVER (PARTITION BY form, entity_type ORDER BY round(weight * confidence, 6) DESC, weight DESC, canonical_id) AS rank FROM w)
SELECT form, entity_type, canonical_id, strategy, score, CAST(rank AS INT) AS rank FROM r WHERE rank <= 5""")
def ranked_candidates(spark, folder):
    """The candidates of each form from all strategies, best first."""
    got = enrichment.ranked_candidates(resolution.candidates(*_resolution_inputs(spark, folder)), "form", "entity_type")
    return got.where("rank <= 5").select("form", "entity_type", "canonical_id", "strategy", "score", "rank")


INTERVENTION_SQL = " UNION ALL ".join(
    f"SELECT section_id, paper_id, content, '{kind}' AS intervention_type, CASE " + " ".join(f"WHEN contains(lower(content), '{w}') THEN '{w}'" for w in words) + " END AS keyword FROM m" for kind, words in lexicon.INTERVENTIONS
)
INTERVENTIONS_FOUND = f"""m AS (SELECT section_id, paper_id, content FROM sections WHERE section_type = 'methods' AND content IS NOT NULL), u AS ({INTERVENTION_SQL}), v AS (SELECT section_id, paper_id, intervention_type, keyword, content AS s FROM u WHERE keyword IS NOT NULL),
found AS (SELECT section_id, paper_id, intervention_type, keyword, {DURATION_SQL} AS duration, {DOSAGE_SQL} AS dosage, {N_SQL} AS sample_size FROM v)"""


@query(f"WITH {INTERVENTIONS_FOUND} SELECT * FROM found")
def intervention_mentions(spark, folder):
    return enrichment.interventions(table(spark, folder, "sections"))


@query(f"""WITH {OCCURRENCES.replace("s AS (SELECT evidence_id", "sent AS (SELECT evidence_id").replace("FROM s)", "FROM sent)")}, {INTERVENTIONS_FOUND},
t AS (SELECT evidence_id, paper_id, source_sentence AS s FROM evidence_items WHERE source_sentence IS NOT NULL), d AS (SELECT *, {_case(text.DIRECTIONS, "s")} AS effect_direction, {P_SQL} AS p_value FROM t),
o AS (SELECT paper_id, intervention_type, keyword, arg_min({{'a': duration, 'b': dosage, 'c': sample_size}}, section_id) AS x FROM found GROUP BY ALL),
z AS (SELECT d.evidence_id, occ.term AS taxon, intervention_type, effect_direction, p_value, x.a AS duration, x.b AS dosage, x.c AS sample_size,
  round(least(1.0, 0.3 + CASE WHEN p_value IS NOT NULL THEN 0.3 ELSE 0.0 END + 0.2 + CASE WHEN x.a IS NOT NULL THEN 0.1 ELSE 0.0 END + CASE WHEN x.b IS NOT NULL THEN 0.1 ELSE 0.0 END), 6)::DOUBLE AS confidence
  FROM d JOIN occ ON occ.evidence_id = d.evidence_id AND label = 'taxon' JOIN o ON o.paper_id = d.paper_id
  WHERE effect_direction IN ('increased', 'decreased', 'no_change') AND coalesce(p_value < 0.05, {SIGNIFICANT_SQL}) AND contains(lower(s), keyword))
SELECT * FROM z WHERE confidence >= 0.5""")
def intervention_effects(spark, folder):
    items = table(spark, folder, "evidence_items")
    taxa = _occurrences(spark, folder).where("label = 'taxon'").select("evidence_id", F.col("term").alias("taxon"))
    return enrichment.intervention_effects(items, taxa, enrichment.interventions(table(spark, folder, "sections")))


@query(f"""WITH m AS (SELECT DISTINCT paper_id, lower(trim(text)) AS method FROM mentions WHERE label = 'method' AND trim(text) <> ''), r AS (SELECT paper_id, section_id, sec_pos, content AS s FROM sections WHERE section_type = 'methods' AND content IS NOT NULL),
h AS (SELECT *, row_number() OVER (PARTITION BY paper_id, method ORDER BY coalesce(sec_pos, 2147483647), section_id) AS k FROM r JOIN m USING (paper_id) WHERE contains(lower(s), method))
SELECT paper_id, method, section_id, {_case(lexicon.pairs(lexicon.PLATFORMS), "s")} AS platform, {N_SQL} AS sample_size, left(s, 200) AS source_sentence, 0.8::DOUBLE AS confidence, 'moderate' AS evidence_strength FROM h WHERE k = 1""")
def methodology_usage(spark, folder):
    return enrichment.methodology_usage(table(spark, folder, "sections"), table(spark, folder, "mentions"))


def _tier_sql(tier: tuple[str, ...]) -> str:
    lists = [f"regexp_extract_all(c, '(?i){p}', 1)" for p in tier]
    whole = lists[0]
    for one in lists[1:]:
        whole = f"list_concat({whole}, {one})"
    return f"list_max(list_filter(list_transform({whole}, lambda x: try_cast(x AS BIGINT)), lambda n: n BETWEEN 2 AND 500000))"


@query(f"""WITH x AS (SELECT section_id, content, regexp_replace(regexp_replace(content, '(?i){lexicon.SEARCH_COUNTS[0]}', ' ', 'g'), '(?i){lexicon.SEARCH_COUNTS[1]}', ' ', 'g') AS c, regexp_matches(content, '(?i){lexicon.META}') AS pooled FROM sections WHERE content IS NOT NULL),
y AS (SELECT *, {", ".join(f"{_tier_sql(t)} AS t{k}" for k, t in enumerate(lexicon.SAMPLE_TIERS))} FROM x), z AS (SELECT * REPLACE (CASE WHEN NOT pooled THEN t6 END AS t6) FROM y)
SELECT section_id, coalesce(t0, t1, t2, t3, t4, t5, t6, 0) AS sample_size, CASE WHEN t0 IS NOT NULL THEN 1 WHEN t1 IS NOT NULL THEN 2 WHEN t2 IS NOT NULL THEN 3 WHEN t3 IS NOT NULL THEN 4 WHEN t4 IS NOT NULL THEN 5 WHEN t5 IS NOT NULL THEN 6 WHEN t6 IS NOT NULL THEN 7 ELSE 99 END AS tier,
  array_to_string(list_filter([{", ".join(f"CASE WHEN regexp_matches(content, '{re2(p)}') THEN '{n}' END" for n, p in lexicon.pairs(lexicon.METHODS))}], lambda v: v IS NOT NULL), '|') AS methods,
  CAST(len(list_distinct(list_transform(regexp_extract_all(content, '(?i){lexicon.DATASETS}'), lambda v: upper(v)))) AS INT) AS n_datasets,
  CASE WHEN regexp_matches(left(content, 2000), '(?i){lexicon.SURE_DESIGN}') THEN 0.9::DOUBLE WHEN regexp_matches(left(content, 2000), '(?i){lexicon.LIKELY_DESIGN}') THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS study_confidence, pooled AS is_meta_analysis FROM z""")
def evidence_signals(spark, folder):
    got = extraction.evidence_signals(table(spark, folder, "sections").where("content is not null"), "section_id", "content")
    return got.select("section_id", "sample_size", "tier", F.array_join("methods", "|").alias("methods"), F.size("datasets").alias("n_datasets"), "study_confidence", "is_meta_analysis")


@query(f"""SELECT evidence_id, {KEY_SQL} AS source_key, CASE WHEN lower(trim(section_type)) IN ({", ".join(repr(s) for s in text.SECTION_TYPES)}) THEN lower(trim(section_type)) ELSE 'other' END AS section_type,
  coalesce(trim(source_sentence), '') <> '' AND coalesce(confidence BETWEEN 0 AND 1, false) AND {KEY_SQL} IS NOT NULL AS valid FROM evidence_items e LEFT JOIN papers p USING (paper_id)""".replace("coalesce(confidence", "coalesce(e.confidence"))
def provenance_checks(spark, folder):
    return enrichment.provenance(table(spark, folder, "evidence_items"), table(spark, folder, "papers"))


@query(f"""WITH x AS (SELECT paper_id, source, {TEXT_SQL} AS t FROM papers), y AS (SELECT paper_id, source, {RULE_SQL} AS rule FROM x)
SELECT paper_id, CASE WHEN rule >= 0.80 THEN 'positive' ELSE 'negative' END AS part FROM y WHERE (rule >= 0.80 OR rule <= 0.20) AND paper_id NOT IN (SELECT paper_id FROM papers WHERE lower(trim(source)) = 'pubmed')""")
def store_growth(spark, folder):
    rows = table(spark, folder, "papers")
    scored = relevance_cascade(spark, folder)
    return enrichment.store_growth(scored, rows.where(F.lower(F.trim("source")) == "pubmed"), "paper_id", "rule")


@query(f"""WITH x AS (SELECT {TEXT_SQL} AS t FROM papers), y AS (SELECT {RULE_SQL} AS rule FROM x)
SELECT CASE WHEN rule >= 0.85 THEN 'positive' WHEN rule >= 0.45 THEN 'hard_negative' WHEN rule >= 0.15 THEN 'medium_negative' ELSE 'easy_negative' END AS band, count(*) AS n_rows FROM y GROUP BY 1""")
def training_bands(spark, folder):
    rows = relevance_cascade(spark, folder)
    return rows.groupBy(enrichment.training_bands(rows, "rule").alias("band")).agg(F.count("*").alias("n_rows"))


@query("SELECT label, count(*) AS n FROM mentions WHERE label IS NOT NULL GROUP BY label HAVING count(*) >= 100")
def induced_types(spark, folder):
    return enrichment.induced_types(table(spark, folder, "mentions"))


@query("SELECT lower(trim(source)) AS source, max(loaded_at) AS latest, count(*) AS n_rows FROM papers GROUP BY 1")
def resume_points(spark, folder):
    return enrichment.resume_points(table(spark, folder, "papers"), F.lower(F.trim("source")), F.col("loaded_at"))


@query("""WITH b AS (SELECT paper_id, sum(length(content)) AS n, count(*) AS n_sections FROM sections WHERE content IS NOT NULL GROUP BY paper_id)
SELECT paper_id, CASE WHEN n >= 300 THEN 'full_text' WHEN length(trim(coalesce(abstract, ''))) > 0 THEN 'abstract' ELSE 'none' END AS tier, coalesce(n_sections, 0) AS n_sections FROM papers LEFT JOIN b USING (paper_id)""")
def text_tiers(spark, folder):
    return enrichment.text_tiers(table(spark, folder, "papers"), table(spark, folder, "sections"))


@query(f"""WITH {CLAIMS}, p AS (SELECT DISTINCT subject_id, object_id, canonical_predicate, paper_id FROM promoted)
SELECT subject_id, object_id, canonical_predicate, paper_id, 'SUPPORTED_BY' AS rel FROM claims JOIN p USING (subject_id, object_id, canonical_predicate)
UNION ALL SELECT c.subject_id, c.object_id, c.canonical_predicate, p.paper_id, 'CONTRADICTED_BY' FROM claims c JOIN p ON c.subject_id = p.subject_id AND c.object_id = p.object_id AND ((c.canonical_predicate = 'INHIBITS' AND p.canonical_predicate = 'PROMOTES') OR (c.canonical_predicate = 'PROMOTES' AND p.canonical_predicate = 'INHIBITS'))""")
def support_edges(spark, folder):
    return enrichment.support_edges(_claims(spark, folder), _promoted(spark, folder))


def _ml_rows(spark, folder):
    """Every paper with the model's features; a missing one is 0 and flagged."""
    rows = relevance_cascade(spark, folder).join(table(spark, folder, "papers").select("paper_id", F.length("abstract").alias("n"), "citation_count"), "paper_id")
    filled = {name: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for name, c in (("length", "n"), ("citations", "citation_count"))}
    flags = {f"no_{name}": F.col(c).isNull().cast("double") for name, c in (("length", "n"), ("citations", "citation_count"))}
    return rows.withColumns({"label": (F.col("rule") >= 0.3).cast("double"), **filled, **flags})


@query()
def ml_verdicts(spark, folder):
    rows = _ml_rows(spark, folder)
    if rows.select("label").distinct().count() < 2:
        return rows.select("paper_id", F.lit("BORDERLINE").alias("verdict"))
    from pyspark.ml.functions import vector_to_array

    got = enrichment.train_classifier(rows, ["rule", "length", "no_length", "citations", "no_citations"], "label").transform(rows)
    return got.select("paper_id", enrichment.ml_verdict(vector_to_array("probability")[1]).alias("verdict"))


@query(f"SELECT label, name FROM (SELECT label, text AS name, row_number() OVER (PARTITION BY label ORDER BY text) AS r FROM (SELECT DISTINCT label, text FROM mentions WHERE trim(text) <> '')) WHERE r <= {CACHED_NAMES}")
def entity_name_cache(spark, folder):
    """The first names per label that the request checks hold in memory."""
    rows = table(spark, folder, "mentions").where(F.trim("text") != "").select("label", F.col("text").alias("name")).distinct()
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("name"))).where(F.col("r") <= CACHED_NAMES).select("label", "name")


@query("SELECT paper_id, md5(coalesce(title, '') || ' ' || coalesce(abstract, '') || ' ' || coalesce(array_to_string(mesh_terms, '|'), '')) AS hash FROM papers")
def change_hashes(spark, folder):
    return table(spark, folder, "papers").select("paper_id", text.change_hash(F.col("title"), F.col("abstract"), F.col("mesh_terms")).alias("hash"))


@query("SELECT canonical_id, count(DISTINCT surface_form) AS n_forms, min(surface_form) AS first_form, max(added_at) AS last_added FROM synonyms WHERE canonical_id IS NOT NULL GROUP BY canonical_id")
def registry_forms(spark, folder):
    rows = table(spark, folder, "synonyms").where("canonical_id is not null")
    return rows.groupBy("canonical_id").agg(F.count_distinct("surface_form").alias("n_forms"), F.min("surface_form").alias("first_form"), F.max("added_at").alias("last_added"))
