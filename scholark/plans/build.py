"""Queries over the graph's build: grounding, edges, predicates, journals, the whole cascade, defaults of the questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon, scoring, text
from ..operators import audit, claims, enrichment, extraction, graph, grounding, journals, relevance, research, resolution
from ..sources import collectors, readers
from . import adapters as a
from . import registry
from .adapters import table
from .registry import COUNTS, OCCURRENCES, _case, _occurrences, query

KEYS = "keys AS (SELECT DISTINCT lower(trim(text, ' ')) AS form, label AS entity_type FROM mentions WHERE trim(text, ' ') <> '' AND label IS NOT NULL)"
GROUNDED = f"""{KEYS}, st AS (SELECT lower(trim(text, ' ')) AS form, label AS entity_type, arg_min({{'i': ontology_id, 'n': ontology_name, 'c': coalesce(grounding_confidence, 0.0)}}, {{'c': -coalesce(grounding_confidence, 0.0), 'i': ontology_id, 'n': ontology_name}}) AS g
  FROM mentions WHERE grounded AND ontology_id IS NOT NULL AND label IS NOT NULL AND trim(text, ' ') <> '' GROUP BY 1, 2),
nm AS (SELECT lower(primary_name) AS form, entity_type, arg_min({{'i': canonical_id, 'n': primary_name}}, {{'i': canonical_id, 'n': primary_name}}) AS n FROM canonical_entities GROUP BY 1, 2),
sh AS (SELECT lower(abbreviated_form) AS form, entity_type, arg_min({{'i': canonical_id, 'n': primary_name}}, {{'i': canonical_id, 'n': primary_name}}) AS s FROM abbreviations JOIN canonical_entities ON full_form = primary_name GROUP BY 1, 2),
gr AS (SELECT form, entity_type, CASE WHEN length(form) < 3 THEN 'none' WHEN g IS NOT NULL THEN 'cache' WHEN n IS NOT NULL THEN 'registry' WHEN s IS NOT NULL THEN 'abbreviation' ELSE 'none' END AS source, g, n, s FROM keys LEFT JOIN st USING (form, entity_type) LEFT JOIN nm USING (form, entity_type) LEFT JOIN sh USING (form, entity_type)),
grounded AS (SELECT form, entity_type, CASE source WHEN 'cache' THEN g.i WHEN 'registry' THEN n.i WHEN 'abbreviation' THEN s.i ELSE 'ungrounded:' || form END AS id, CASE source WHEN 'cache' THEN g.n WHEN 'registry' THEN n.n WHEN 'abbreviation' THEN s.n ELSE form END AS name,
  CASE source WHEN 'cache' THEN g.c WHEN 'registry' THEN 1.0 WHEN 'abbreviation' THEN 0.9 ELSE 0.0 END::DOUBLE AS confidence, source FROM gr)"""


@query(f"WITH {KEYS} SELECT * FROM keys")
def grounding_keys(spark, folder):
    return grounding.lookup_keys(table(spark, folder, "mentions"))


def _grounded(spark, folder):
    mentions = table(spark, folder, "mentions")
    return grounding.ground(grounding.lookup_keys(mentions), grounding.grounding_table(mentions), table(spark, folder, "canonical_entities"), table(spark, folder, "abbreviations"))


@query(f"WITH {GROUNDED} SELECT * FROM grounded")
def grounding_cascade(spark, folder):
    return _grounded(spark, folder)


@query(f"WITH {GROUNDED} SELECT form, entity_type FROM grounded WHERE source = 'none' AND length(form) >= 3")
def grounding_failures(spark, folder):
    return grounding.failures(_grounded(spark, folder))


ROUTE_SQL = "CASE " + " ".join(f"WHEN x.label = '{s}' AND y.label = '{t}' THEN '{n}'" for s, t, n in grounding.ROUTES) + " END"
PAIRS = f"""{OCCURRENCES}, pr AS (SELECT x.evidence_id, x.raw AS s, x.term AS source, x.label AS source_label, y.term AS target, y.label AS target_label, {ROUTE_SQL} AS rel FROM occ x JOIN occ y ON x.evidence_id = y.evidence_id AND (x.label <> y.label)),
pairs AS (SELECT *, {_case(text.DIRECTIONS, "s")} AS direction FROM pr WHERE rel IS NOT NULL)"""


def _pairs(spark, folder):
    items = table(spark, folder, "evidence_items").where("source_sentence is not null").select("evidence_id", text.direction(F.col("source_sentence")).alias("direction"), text.p_value(F.col("source_sentence")).alias("p_value")).where("direction is not null")
    occ = _occurrences(spark, folder)
    end = lambda e: occ.select("evidence_id", F.col("term").alias(e), F.col("label").alias(f"{e}_label"))
    # the pairs of labels that go together are the join's key, so no other pair arises
    routes = spark.createDataFrame([(s, t) for s, t, _ in grounding.ROUTES], "source_label string, target_label string")
    left = end("source").join(F.broadcast(routes), "source_label")
    return items.join(left, "evidence_id").join(end("target"), ["evidence_id", "target_label"])


@query(f"WITH {PAIRS}, {GROUNDED} SELECT p.evidence_id, p.rel, coalesce(gs.id, 'ungrounded:' || lower(p.source)) AS src, coalesce(gt.id, 'ungrounded:' || lower(p.target)) AS dst, p.direction FROM pairs p LEFT JOIN grounded gs ON gs.form = p.source AND gs.entity_type = p.source_label LEFT JOIN grounded gt ON gt.form = p.target AND gt.entity_type = p.target_label WHERE p.direction IS NOT NULL")
def built_edges(spark, folder):
    return grounding.build_edges(_pairs(spark, folder), _grounded(spark, folder))


ALLOWED_SQL = "CASE " + " ".join(f"WHEN rel = '{n}' THEN direction IN ({', '.join(repr(d) for d in ds)})" for n, ds in audit.RELATIONS) + " ELSE false END"
KNOWN_SQL = f"rel IN ({', '.join(repr(n) for n, _ in audit.RELATIONS)})"


@query(f"""WITH {PAIRS}, e AS (SELECT unnest(list_filter([CASE WHEN NOT ({KNOWN_SQL}) THEN 'type' END, CASE WHEN {KNOWN_SQL} AND NOT ({ALLOWED_SQL}) THEN 'direction' END], lambda v: v IS NOT NULL)) AS error_type, rel FROM pairs WHERE direction IS NOT NULL)
SELECT rel, error_type, count(*) AS n_rows FROM e GROUP BY 1, 2""")
def typed_relation_errors(spark, folder):
    """Pairs with the general direction of their sentence, checked against what their type allows."""
    rows = _pairs(spark, folder).select(grounding.route(F.col("source_label"), F.col("target_label")).alias("rel"), "direction", "p_value")
    errors = audit.typed_errors(F.col("rel"), F.col("direction"), F.col("p_value"))
    return rows.select("rel", F.explode(errors).alias("error_type")).groupBy("rel", "error_type").agg(F.count("*").alias("n_rows"))


@query("SELECT canonical_id AS id, primary_name FROM canonical_entities e WHERE NOT EXISTS (SELECT 1 FROM mentions m WHERE m.ontology_id = e.canonical_id AND m.confidence >= 0.9)")
def missing_canonical_nodes(spark, folder):
    """Entities that a graph of sure mentions lacks."""
    nodes = table(spark, folder, "canonical_entities").select(F.col("canonical_id").alias("id"), "primary_name")
    return grounding.missing_nodes(nodes, table(spark, folder, "mentions").where("confidence >= 0.9").select(F.col("ontology_id").alias("id")), "id")


RAW = r"""raw AS (SELECT DISTINCT lower(trim(regexp_extract(source_sentence, '^[A-Za-z.]+ [a-z]+ ([a-z]+(?: [a-z]+)?)', 1), ' ')) AS p FROM evidence_items WHERE source_sentence IS NOT NULL UNION SELECT DISTINCT lower(trim(source_sentence, ' ')) FROM evidence_items WHERE length(source_sentence) BETWEEN 1 AND 80)"""
LOOSE_SQL = "CASE " + " ".join(f"WHEN contains(p, '{k}') OR contains('{k}', p) THEN '{n}'" for k, n in lexicon.PREDICATES) + " ELSE 'RELATES_TO' END"
EXACT_SQL = "CASE p " + " ".join(f"WHEN '{k}' THEN '{n}'" for k, n in lexicon.PREDICATES) + " END"
VOTES = [f"len(list_filter(w, lambda x: x IN ({', '.join(repr(v) for v in known.split())})))" for _, known in lexicon.CATEGORIES]
CATEGORY_SQL = "CASE WHEN top = 0 THEN 'generic' " + " ".join(f"WHEN v{k} = top THEN '{n}'" for k, (n, _) in enumerate(lexicon.CATEGORIES)) + " END"
BAD_SQL = f"length(p) > {lexicon.LONGEST_PREDICATE} OR p IN ({', '.join(repr(w) for w in lexicon.NO_PREDICATES.split())}) OR " + " OR ".join(f"contains(p, '{w}')" for w in lexicon.RECORD_WORDS)


@query(f"""WITH {RAW}, x AS (SELECT p, string_split_regex(translate(p, '_-', '  '), '\\s+') AS w FROM raw WHERE p <> ''), y AS (SELECT p, {", ".join(f"{v} AS v{k}" for k, v in enumerate(VOTES))} FROM x), z AS (SELECT *, greatest({", ".join(f"v{k}" for k in range(len(VOTES)))}) AS top FROM y)
SELECT p AS raw_predicate, coalesce({EXACT_SQL}, {LOOSE_SQL}) AS canonical, {CATEGORY_SQL} AS category, CASE WHEN {BAD_SQL} THEN 'RELATES_TO' ELSE translate(upper(p), ' -', '__') END AS promoted FROM z""".replace("\\\\s", "\\s"))
def predicate_registry(spark, folder):
    """Canonical form, category and promoted form of the phrases that stand where sentences have their predicates."""
    s = F.col("source_sentence")
    items = table(spark, folder, "evidence_items").where(s.isNotNull())
    raw = items.select(F.lower(F.trim(F.regexp_extract(s, r"^[A-Za-z.]+ [a-z]+ ([a-z]+(?: [a-z]+)?)", 1))).alias("p")).unionByName(items.where(F.length(s).between(1, 80)).select(F.lower(F.trim(s)).alias("p"))).distinct().where("p <> ''")
    p = F.col("p")
    return raw.select(p.alias("raw_predicate"), claims.canonical_predicate(p).alias("canonical"), claims.predicate_category(p).alias("category"), claims.promoted_predicate(p).alias("promoted"))


@query(f"""WITH n AS (SELECT DISTINCT journal_name FROM journal_info WHERE trim(journal_name, ' ') <> ''), c AS (SELECT journal_name, lower(trim(journal_name, ' ')) AS low, trim(regexp_replace(regexp_replace(lower(trim(journal_name, ' ')), '^(the|journal of the|journal of)\\s+', ''), '\\s+', ' ', 'g'), ' ') AS clean FROM n),
j AS (SELECT lower(journal_name) AS known, min(journal_id) AS journal_id FROM journals GROUP BY 1), e AS (SELECT journal_name, journal_id FROM c JOIN j ON low = known),
p AS (SELECT journal_name, min(journal_id) AS journal_id FROM c JOIN j ON contains(known, clean) OR contains(clean, known) GROUP BY 1)
SELECT journal_name, coalesce(e.journal_id, p.journal_id) AS journal_id, CASE WHEN e.journal_id IS NOT NULL THEN 'exact' WHEN p.journal_id IS NOT NULL THEN 'partial' ELSE 'guess' END AS matched, coalesce(r.quartile, 'unknown') AS quartile, coalesce(r.is_open_access, {" OR ".join(f"contains(low, '{w}')" for w in lexicon.OPEN_JOURNALS)}) AS is_open_access,
  {" OR ".join(f"contains(low, '{w}')" for w in lexicon.PREDATORY)} AS is_predatory FROM c LEFT JOIN e USING (journal_name) LEFT JOIN p USING (journal_name) LEFT JOIN journals r ON r.journal_id = coalesce(e.journal_id, p.journal_id)""".replace("\\\\s", "\\s"))
def journal_classes(spark, folder):
    return journals.classify(table(spark, folder, "journal_info"), table(spark, folder, "journals"))


# what the later stages would say, from the record's own hash
STAGES = "CAST('0x' || substr(md5(paper_id), 1, 4) AS BIGINT) / 65535.0 AS probability, CAST('0x' || substr(md5(paper_id), 5, 4) AS BIGINT) / 65535.0 AS similarity, CAST('0x' || substr(md5(paper_id), 9, 4) AS BIGINT) AS h"
DECIDE_SQL = f"""x AS (SELECT paper_id, mesh_terms, {registry.TEXT_SQL} AS t, {STAGES} FROM papers), y AS (SELECT *, {registry.META_SQL} AS m, {registry.RULE_SQL} AS rule, {registry.GATE_SQL} AS gate, CASE WHEN h % 3 = 0 THEN 'KEEP' WHEN h % 3 = 1 THEN 'REJECT' ELSE 'BORDERLINE' END AS embedding,
  CASE WHEN h % 5 > 0 THEN round((h % 100) / 100.0, 2) END AS llm_confidence, h % 2 = 0 AS llm_keep FROM x),
z AS (SELECT *, (embedding = 'KEEP' AND NOT rule >= 0.45) OR (embedding = 'REJECT' AND rule >= 0.45) OR (rule + similarity) / 2 BETWEEN 0.40 AND 0.70 AS routed FROM y),
d AS (SELECT *, CASE WHEN m <> 'UNKNOWN' THEN 'stage1' WHEN NOT gate THEN 'gate' WHEN rule >= 0.45 OR rule <= 0.1 THEN 'stage2' WHEN probability >= 0.85 OR probability <= 0.15 THEN 'stage3' WHEN embedding <> 'BORDERLINE' AND NOT routed THEN 'stage3.5' ELSE 'stage4' END AS stage FROM z)"""


@query(f"""WITH {DECIDE_SQL} SELECT paper_id, stage, CASE stage WHEN 'stage1' THEN m = 'KEEP' WHEN 'gate' THEN false WHEN 'stage2' THEN rule >= 0.45 WHEN 'stage3' THEN probability >= 0.85 WHEN 'stage3.5' THEN embedding = 'KEEP' ELSE CASE WHEN llm_confidence >= 0.70 THEN llm_keep WHEN llm_confidence < 0.50 THEN false END END AS keep,
  stage = 'gate' OR (stage = 'stage4' AND (llm_confidence IS NULL OR (llm_confidence >= 0.50 AND llm_confidence < 0.70))) AS review FROM d""")
def decision_cascade(spark, folder):
    rows = table(spark, folder, "papers")
    t = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("abstract", F.lit("")))
    digits = lambda k: F.conv(F.substring(F.md5("paper_id"), k, 4), 16, 10).cast("bigint")
    h = digits(9)
    rows = rows.select("paper_id", relevance.metadata_verdict(F.col("mesh_terms"))["verdict"].alias("m"), relevance.gate(t).alias("gate"), relevance.rule_score(t).alias("rule"), (digits(1) / 65535.0).alias("probability"), (digits(5) / 65535.0).alias("similarity"), h.alias("h"))
    rows = rows.withColumns({"embedding": F.when(F.col("h") % 3 == 0, "KEEP").when(F.col("h") % 3 == 1, "REJECT").otherwise("BORDERLINE"), "llm_confidence": F.when(F.col("h") % 5 > 0, F.round((F.col("h") % 100) / 100.0, 2)), "llm_keep": F.col("h") % 2 == 0})
    return relevance.decide(rows).select("paper_id", "stage", "keep", "review")


@query("""WITH b AS (SELECT event_id // 8 AS batch, event_id % 8 AS pos, value FROM events), n AS (SELECT batch, count(*) AS n FROM b GROUP BY 1)
SELECT batch, CAST(pos AS INT) AS pos, CASE WHEN n = 8 AND batch % 5 > 0 THEN value >= 50 END AS keep, CASE WHEN n = 8 AND batch % 5 > 0 THEN round(least(1.0, value / 100), 4) END AS confidence, n < 8 OR batch % 5 = 0 AS review FROM b JOIN n USING (batch)""")
def batch_verdicts(spark, folder):
    """Answers to batches of eight, some of them one short: those go to a human."""
    events = table(spark, folder, "events").select(F.expr("event_id div 8").alias("batch"), (F.col("event_id") % 8).cast("int").alias("pos"), "value")
    one = F.format_string('{"keep": %s, "confidence": %s}', (F.col("value") >= 50).cast("string"), F.round(F.least(F.lit(1.0), F.col("value") / 100), 4).cast("string"))
    asked = events.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("pos", one.alias("a")))).alias("all"))  # at most eight
    said = F.array_join(F.transform(F.when(F.col("batch") % 5 == 0, F.slice("all", 1, F.size("all") - 1)).otherwise(F.col("all")), lambda x: x["a"]), ", ")
    answers = asked.select("batch", F.when(F.col("batch") % 2 == 0, F.concat(F.lit('{"results": ['), said, F.lit("]}"))).otherwise(F.concat(F.lit("["), said, F.lit("]"))).alias("answer"))
    got = readers.parse_batch_verdicts(answers, "batch", "answer", 8)
    rows = events.join(got, ["batch", "pos"], "left")
    return rows.select("batch", "pos", "keep", "confidence", F.col("confidence").isNull().alias("review"))


# ---- the questions with their default filters


@query(f"""
WITH {a.PAPERS}, {a.ASSOCIATIONS}, g AS (
  SELECT taxon_id, min(taxon) AS taxon, count(DISTINCT paper_id) AS paper_count, avg(confidence) AS c, count(direction) AS n_directions, {COUNTS}
  FROM associations JOIN papers_q USING (paper_id) WHERE disease = 'ASIA' AND confidence >= 0.7 AND article_type = 'RCT' AND data_availability = 'open' AND (has_sra OR has_ena)
  GROUP BY taxon_id HAVING count(DISTINCT paper_id) >= 2 AND avg(confidence) >= 0.7)
SELECT taxon_id, taxon, paper_count, round(c, 6) AS consensus_confidence FROM g""")
def cross_study_trials(spark, folder):
    got = research.cross_study_associations(a.associations(spark, folder), a.papers(spark, folder), "ASIA", min_papers=2)
    return got.select("taxon_id", "taxon", "paper_count", "consensus_confidence")


@query(f"""
WITH {a.PAPERS}, {a.METHODOLOGY}, m AS (SELECT DISTINCT method, paper_id FROM methodology)
SELECT method, year, count(*) AS total_papers, count(*) FILTER (has_sra) AS sra_papers, count(*) FILTER (has_ena) AS ena_papers FROM m JOIN papers_q USING (paper_id)
WHERE year BETWEEN 1996 AND 1999 AND (has_sra OR has_ena) AND lower(method) IN ('standard', 'promo', 'economy') GROUP BY ALL""")
def methodology_deposited(spark, folder):
    got = research.methodology_landscape(a.methodology(spark, folder), a.papers(spark, folder), 1996, 1999, methods=["STANDARD", "Promo", "economy"])
    return got.select("method", "year", "total_papers", "sra_papers", "ena_papers")


@query(f"""
WITH {a.PAPERS}, {a.ASSOCIATIONS}, r AS (SELECT taxon_id, direction, title || '/' || year || '/' || article_type AS study, title, year, article_type FROM associations JOIN papers_q USING (paper_id) WHERE disease = 'AMERICA' AND direction IN ('increased', 'decreased')),
g AS (SELECT taxon_id, count(*) FILTER (direction = 'increased') AS i, count(*) FILTER (direction = 'decreased') AS d, string_agg(study, '|' ORDER BY title, year, article_type) FILTER (direction = 'increased') AS increased_studies, string_agg(study, '|' ORDER BY title, year, article_type) FILTER (direction = 'decreased') AS decreased_studies FROM r GROUP BY taxon_id)
SELECT taxon_id, increased_studies, decreased_studies FROM g WHERE i >= 2 AND d >= 2""")
def conflicting_studies(spark, folder):
    got = research.conflicting_evidence(a.associations(spark, folder), a.papers(spark, folder), "AMERICA")
    named = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("/", s["title"], s["year"].cast("string"), s["article_type"])), "|").alias(c)
    return got.select("taxon_id", named("increased_studies"), named("decreased_studies"))


# ---- collected records: the papers in each service's form, read back by its mapping

_OUT = ["doi", "title", "abstract", "authors", "journal", "publication_date", "publication_year", "is_open_access"]


def _collected(name, items):
    got = collectors.SERVICES[name](items)
    return got.select(*[F.array_join(c, "|").alias(c) if c == "authors" else F.col(c) for c in _OUT])


def _items_of(spark, folder, **fields):
    return table(spark, folder, "papers").select(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])).alias("item"))


def _collected_sql(**given: str) -> str:
    out = {"doi": "doi", "title": "nullif(trim(title, ' '), '')", "abstract": "abstract", "authors": "array_to_string(list_filter(coalesce(authors, []), lambda x: trim(x, ' ') <> ''), '|')", "journal": "journal", "publication_date": "publication_date", "publication_year": "publication_year", "is_open_access": "coalesce(is_open_access, false)", **given}
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in out.items()) + " FROM papers WHERE trim(title, ' ') <> ''"


_AUTHORS = "array_to_string(list_filter(list_transform(coalesce(authors, []), lambda x: trim(x, ' ')), lambda x: x <> ''), '|')"


@query(_collected_sql(publication_date="CAST(publication_year AS VARCHAR)", authors=_AUTHORS))
def collected_europepmc(spark, folder):
    c = F.col
    fields = {
        "doi": c("doi"), "title": c("title"), "abstractText": c("abstract"), "isOpenAccess": F.when(c("is_open_access"), "Y").otherwise("N"), "authorList": F.struct(F.transform("authors", lambda a: F.struct(a.alias("fullName"))).alias("author")),
        "journalInfo": F.struct(F.struct(c("journal").alias("title")).alias("journal"), F.concat(c("publication_year").cast("string"), F.lit(" Mar")).alias("dateOfPublication")),
    }
    return _collected("europepmc", _items_of(spark, folder, **fields))


@query(_collected_sql(journal="coalesce(nullif(trim(journal, ' '), ''), source)"))
def collected_semantic_scholar(spark, folder):
    c = F.col
    fields = {
        "externalIds": F.struct(c("doi").alias("DOI"), c("pmid").alias("PubMed")), "title": c("title"), "abstract": c("abstract"), "year": c("publication_year"), "publicationDate": c("publication_date"), "authors": F.transform("authors", lambda a: F.struct(a.alias("name"))), "venue": c("source"),
        "journal": F.struct(c("journal").alias("name")), "isOpenAccess": c("is_open_access"),
    }
    return _collected("semantic_scholar", _items_of(spark, folder, **fields))


WORDS_SQL = "array_to_string(list_filter(string_split(abstract, ' '), lambda x: x <> ''), ' ')"


@query(_collected_sql(doi=r"nullif(trim(regexp_extract(replace(doi, 'https://doi.org/', ''), '^([^\"''>< ]*)', 1), ' '), '')", abstract=f"nullif({WORDS_SQL}, '')"))
def collected_openalex(spark, folder):
    """With abstracts as inverted indexes."""
    c = F.col
    words = F.filter(F.split("abstract", " "), lambda w: w != "")
    index = F.map_from_entries(F.transform(F.array_distinct("words"), lambda w: F.struct(w, F.filter(F.transform("words", lambda x, i: F.when(x == w, i)), lambda i: i.isNotNull()))))
    rows = table(spark, folder, "papers").withColumn("words", words)
    item = F.to_json(F.struct(
        c("doi"), c("title"), F.when(F.size("words") > 0, index).alias("abstract_inverted_index"), F.transform("authors", lambda a: F.struct(F.struct(a.alias("display_name")).alias("author"))).alias("authorships"), c("publication_date"), c("publication_year"),
        F.struct(F.struct(c("journal").alias("display_name")).alias("source")).alias("primary_location"), F.struct(c("is_open_access").alias("is_oa")).alias("open_access"),
    ))
    return _collected("openalex", rows.select(item.alias("item")))


@query(_collected_sql(
    doi="nullif(trim(doi, ' '), '')", abstract=rf"nullif(trim(regexp_replace(regexp_replace('<jats:p>' || abstract || '</jats:p>', '<[^>]+>', ' ', 'g'), '{registry.SPACE}+', ' ', 'g'), ' '), '')", authors=_AUTHORS,
    publication_date="CAST(publication_year AS VARCHAR) || '-03-01'", is_open_access="coalesce(is_open_access, false)",
))
def collected_crossref(spark, folder):
    c = F.col
    fields = {
        "DOI": c("doi"), "title": F.array("title"), "abstract": F.concat(F.lit("<jats:p>"), c("abstract"), F.lit("</jats:p>")), "author": F.transform("authors", lambda a: F.struct(a.alias("family"))), "container-title": F.array("journal"),
        "published": F.when(c("publication_year").isNotNull(), F.struct(F.array(F.array(c("publication_year"), F.lit(3))).alias("date-parts"))), "license": F.when(c("is_open_access"), F.array(F.struct(F.lit("https://creativecommons.org/x").alias("URL")))),
    }
    return _collected("crossref", _items_of(spark, folder, **fields))


@query(_collected_sql(doi="nullif(trim(doi, ' '), '')", abstract="coalesce(nullif(trim(abstract, ' '), ''), nullif(trim(substr(repeat(coalesce(title, ''), 40), 1, 2000), ' '), ''))", publication_date="coalesce(substr(publication_date, 1, 10), CAST(publication_year AS VARCHAR))", is_open_access="coalesce(is_open_access, true)"))
def collected_core(spark, folder):
    c = F.col
    fields = {
        "doi": c("doi"), "title": c("title"), "abstract": c("abstract"), "fullText": F.repeat(F.coalesce("title", F.lit("")), 40), "authors": F.transform("authors", lambda a: F.struct(a.alias("name"))), "yearPublished": c("publication_year"), "publishedDate": c("publication_date"),
        "journals": F.array(F.struct(c("journal").alias("title"))), "isOpenAccess": c("is_open_access"),
    }
    return _collected("core", _items_of(spark, folder, **fields))


# ---- smaller operators of enrichment, graph and reports


@query("""SELECT paper_id, trim(pmcid, ' ') AS pmcid FROM papers p WHERE trim(pmcid, ' ') <> '' AND NOT EXISTS (SELECT 1 FROM sections s WHERE s.paper_id = p.paper_id AND length(trim(s.content, ' ')) > 0) AND NOT EXISTS (SELECT 1 FROM documents d WHERE d.paper_id = p.paper_id)""")
def pmc_candidates(spark, folder):
    return enrichment.pmc_candidates(table(spark, folder, "papers"), table(spark, folder, "sections"), table(spark, folder, "documents").where("paper_id is not null"))


_SPELLED = "CASE evidence_id % 4 WHEN 0 THEN paper_id WHEN 1 THEN lower(trim(doi)) WHEN 2 THEN 'doi:' || lower(trim(doi)) ELSE 'pmid:' || trim(pmid) END"


@query(f"""WITH k AS (SELECT evidence_id, {_SPELLED} AS paper_key FROM evidence_items JOIN papers USING (paper_id)), s AS (SELECT title, paper_id, unnest(list_filter([paper_id, lower(nullif(trim(doi), '')), 'doi:' || lower(nullif(trim(doi), '')), 'pmid:' || nullif(trim(pmid), '')], lambda x: x IS NOT NULL)) AS paper_key FROM papers WHERE title IS NOT NULL),
t AS (SELECT paper_key, arg_min(title, paper_id) AS title FROM s GROUP BY 1) SELECT evidence_id, paper_key, title FROM k LEFT JOIN t USING (paper_key)""")
def evidence_titles(spark, folder):
    papers = table(spark, folder, "papers").select("paper_id", "doi", "pmid", "title")
    keys = table(spark, folder, "evidence_items").select("evidence_id", "paper_id").join(papers, "paper_id").select("evidence_id", F.expr(_SPELLED).alias("paper_key"))
    return enrichment.titles_by_key(keys, "paper_key", papers)


@query("""WITH r AS (SELECT lower(trim(source)) AS source, CAST(date_trunc('month', loaded_at) AS TIMESTAMP) AS run, count(*) FILTER (abstract IS NOT NULL AND is_preprint) AS n FROM papers WHERE source IS NOT NULL GROUP BY 1, 2), o AS (SELECT source, n, row_number() OVER (PARTITION BY source ORDER BY run NULLS FIRST) * 100 AS o FROM r)
SELECT source, CAST(CASE WHEN arg_max(n, o) = 0 THEN 0 ELSE max(o) + arg_max(n, o) END AS BIGINT) AS next_offset FROM o GROUP BY source""")
def source_cursors(spark, folder):
    """Runs of a month each, whose offsets go by hundreds."""
    runs = table(spark, folder, "papers").where("source is not null").groupBy(F.lower(F.trim("source")).alias("source"), F.date_trunc("month", "loaded_at").alias("run")).agg(F.count_if(F.col("abstract").isNotNull() & F.col("is_preprint")).alias("n"))
    runs = runs.withColumn("o", F.expr("row_number() over (partition by source order by run nulls first) * 100"))
    return enrichment.next_cursors(runs, "source", "n", "o")


UP = registry.ORACLE["ontology_ancestors"]


@query(f"""WITH u AS ({UP}), k AS (SELECT 'r' || r_regionkey AS id FROM region WHERE r_regionkey % 2 = 1 UNION SELECT 'world' UNION SELECT 'n' || n_nationkey FROM nation WHERE n_nationkey % 3 = 0)
SELECT node, arg_min(ancestor, {{'l': level, 'a': ancestor}}) AS ancestor, CAST(min(level) AS INT) AS level FROM u JOIN k ON ancestor = id GROUP BY node""")
def nearest_registered(spark, folder):
    up = registry.ontology_ancestors(spark, folder)
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string")).alias("id")
    known = table(spark, folder, "region").where("r_regionkey % 2 = 1").select(key("r", "r_regionkey")).unionByName(table(spark, folder, "nation").where("n_nationkey % 3 = 0").select(key("n", "n_nationkey")))
    return resolution.nearest_registered(up, known.unionByName(spark.createDataFrame([("world",)], "id string")), "id")


@query("""WITH i AS (SELECT claim_id, paper_id, extraction_timestamp AS t, evidence_id AS e, confidence AS x, evidence_strength = 'weak' AS against FROM evidence_items WHERE claim_id IS NOT NULL AND paper_id IS NOT NULL AND confidence IS NOT NULL),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY claim_id, paper_id ORDER BY t NULLS FIRST, e) AS n FROM (SELECT claim_id, paper_id, t, e, x, coalesce(against, false) AS against FROM i)) WHERE n = 1),
k AS (SELECT *, count(*) FILTER (NOT against) OVER (PARTITION BY claim_id ORDER BY t NULLS FIRST, e ROWS UNBOUNDED PRECEDING) AS k, coalesce(sum(ln(CASE WHEN against THEN 0.8::DOUBLE ELSE 0.9::DOUBLE END)) OVER (PARTITION BY claim_id ORDER BY t NULLS FIRST, e ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0.0) AS l FROM f)
SELECT claim_id, round(sum(CASE WHEN against THEN 0.0 WHEN k = 1 THEN x ELSE 0.1 * x END * exp(l)), 6) AS confidence, count(*) FILTER (NOT against) AS n_support, count(*) FILTER (against) AS n_against, round(count(*) FILTER (against) / count(*), 6) AS ratio FROM k GROUP BY claim_id""")
def updated_claims(spark, folder):
    """Weak items stand for contradictions, as the tables hold no others."""
    items = table(spark, folder, "evidence_items")
    return claims.updated_claims(items, "claim_id", "paper_id", "confidence", F.coalesce(F.col("evidence_strength") == "weak", F.lit(False)), ["extraction_timestamp", "evidence_id"])


def _named_sql(table_: tuple, col: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({col}), '{s}') THEN '{n}'" for s, n in table_) + f" ELSE {col} END"


@query(f"WITH {DECIDE_SQL} SELECT paper_id, {_named_sql(relevance.CAUSES, 'stage')} AS cause, {_named_sql(relevance.STAGES, 'stage')} AS label FROM d")
def decision_labels(spark, folder):
    rows = decision_cascade(spark, folder)
    return rows.select("paper_id", relevance.named(F.col("stage"), relevance.CAUSES).alias("cause"), relevance.named(F.col("stage"), relevance.STAGES).alias("label"))


@query(f"WITH {DECIDE_SQL}, a AS (SELECT paper_id, stage FROM d WHERE stage <> 'stage4'), n AS (SELECT greatest(CAST(ceil(count(*) * 0.01) AS BIGINT), 10) AS k FROM a) SELECT paper_id, stage FROM a QUALIFY row_number() OVER (ORDER BY md5(paper_id), paper_id) <= (SELECT k FROM n)")
def automated_drift_sample(spark, folder):
    """Of the decisions that no verifier made."""
    return audit.drift_sample(decision_cascade(spark, folder).where("stage <> 'stage4'"), "paper_id").select("paper_id", "stage")


@query("""WITH n AS (SELECT ontology_id AS id, arg_max(label, mention_id) AS label FROM mentions WHERE ontology_id IS NOT NULL GROUP BY 1), m AS (SELECT canonical_id AS old, lead(canonical_id, 7) OVER (ORDER BY canonical_id) AS new FROM canonical_entities), g AS (SELECT old, coalesce(new, old) AS new FROM m)
SELECT g.old, g.new, CASE WHEN g.old = g.new THEN 'same node' WHEN a.label IS NULL OR b.label IS NULL THEN 'unknown node' WHEN a.label <> b.label THEN 'type conflict' WHEN g.old IN (SELECT new FROM g) THEN 'target of a merge' END AS reason FROM g LEFT JOIN n a ON a.id = g.old LEFT JOIN n b ON b.id = g.new""")
def node_merge_plan(spark, folder):
    nodes = graph.nodes_from(table(spark, folder, "mentions"), "ontology_id", "ontology_name", "label", ["mention_id"])
    mapping = table(spark, folder, "canonical_entities").select(F.col("canonical_id").alias("old"), F.expr("coalesce(lead(canonical_id, 7) over (order by canonical_id), canonical_id)").alias("new"))  # a list of fixed size
    return graph.merge_plan(mapping, nodes)


@query("""WITH e AS (SELECT DISTINCT ontology_id AS src, paper_id AS dst, 'MENTIONED_IN' AS rel FROM mentions WHERE ontology_id IS NOT NULL AND paper_id IS NOT NULL), n AS (SELECT canonical_id AS id FROM canonical_entities)
SELECT id, 'out' AS way, rel, dst AS other FROM n LEFT JOIN e ON src = id UNION ALL SELECT id, 'in', rel, src FROM n LEFT JOIN e ON dst = id""")
def node_neighbours(spark, folder):
    return graph.neighbours(table(spark, folder, "canonical_entities").select(F.col("canonical_id").alias("id")), graph.mention_edges(table(spark, folder, "mentions")))


TERMS_SQL = "terms AS (SELECT DISTINCT lower(primary_name) AS term, CASE entity_type WHEN 'taxon' THEN 0.3::DOUBLE WHEN 'disease' THEN 0.25::DOUBLE ELSE -0.2::DOUBLE END AS weight FROM canonical_entities)"


@query(f"""WITH {TERMS_SQL}, x AS (SELECT paper_id, {registry.TEXT_SQL} AS t FROM papers), h AS (SELECT paper_id, sum(weight) AS total, count(*) AS n FROM x JOIN terms ON contains(t, term) GROUP BY 1)
SELECT paper_id, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, greatest(-1.0::DOUBLE, least(1.5::DOUBLE, coalesce(total, 0.0))) / 1.5::DOUBLE)), 3) AS rule, CAST(coalesce(n, 0) AS INT) AS n_terms FROM x LEFT JOIN h USING (paper_id)""")
def weighted_scores(spark, folder):
    """Scores by a table of terms: here the canonical names, weighted by type."""
    weight = F.when(F.col("entity_type") == "taxon", 0.3).when(F.col("entity_type") == "disease", 0.25).otherwise(-0.2)
    terms = table(spark, folder, "canonical_entities").select(F.col("primary_name").alias("term"), weight.alias("weight"))
    t = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("abstract", F.lit("")))
    return relevance.weighted_score(table(spark, folder, "papers"), t, terms).select("paper_id", "rule", "n_terms")


@query(f"""WITH x AS (SELECT evidence_id, source_sentence, e.confidence, extraction_timestamp AS tm, CASE WHEN evidence_id % 9 = 0 THEN 'unregistered' WHEN evidence_id % 2 = 0 THEN 'rules' ELSE 'model' END AS method, {registry.KEY_SQL} AS key FROM evidence_items e LEFT JOIN papers p USING (paper_id)),
y AS (SELECT evidence_id, unnest(list_filter([CASE WHEN coalesce(trim(source_sentence, ' '), '') = '' THEN 'sentence' END, CASE WHEN confidence IS NULL OR confidence NOT BETWEEN 0 AND 1 THEN 'confidence' END, CASE WHEN method NOT IN ('rules', 'model') THEN 'method' END,
  CASE WHEN try_cast(tm AS TIMESTAMP) IS NULL OR try_cast(tm AS TIMESTAMP) > TIMESTAMP '2024-06-01 00:01:00' THEN 'time' END, CASE WHEN key IS NULL THEN 'source' END], lambda v: v IS NOT NULL)) AS error FROM x)
SELECT error, count(*) AS n_rows FROM y GROUP BY 1""")
def provenance_errors(spark, folder):
    """As of June 2024; every ninth record names a method that isn't registered."""
    keys = table(spark, folder, "papers").select("paper_id", text.dedup_key(F.col("doi"), F.col("pmid"), F.col("title")).alias("key"))
    e = F.col("evidence_id")
    rows = table(spark, folder, "evidence_items").withColumn("method", F.when(e % 9 == 0, "unregistered").when(e % 2 == 0, "rules").otherwise("model")).join(keys, "paper_id", "left")
    errors = enrichment.provenance_errors(F.col("source_sentence"), F.col("confidence"), F.col("method"), F.col("extraction_timestamp").try_cast("timestamp"), F.col("key"), ("rules", "model"), F.lit("2024-06-01").cast("timestamp"))
    return rows.select(F.explode(errors).alias("error")).groupBy("error").agg(F.count("*").alias("n_rows"))


@query("SELECT source, lang, count(*) AS n_texts, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY GROUPING SETS ((source), (lang), ())")
def text_store_stats(spark, folder):
    rows = table(spark, folder, "documents")
    return rows.groupingSets([["source"], ["lang"], []], "source", "lang").agg(F.count("*").alias("n_texts"), F.sum("n_chars").alias("n_chars"))


@query()
def rule_entities(spark, folder):
    """Spans of all canonical names and mentioned forms in the sections."""
    entities, mentions = table(spark, folder, "canonical_entities"), table(spark, folder, "mentions")
    terms = entities.select(F.col("entity_type").alias("label"), F.col("primary_name").alias("term")).unionByName(mentions.where("label is not null and text is not null").select("label", F.col("text").alias("term")).distinct())
    return extraction.rule_entities(table(spark, folder, "sections"), "section_id", "content", terms)


@query(f"""WITH d AS ({registry.ORACLE['study_design']}), t AS (SELECT paper_id, article_type FROM ({registry.ARTICLE_SQL})), j AS (SELECT paper_id, arg_min(quartile, info_id) FILTER (quartile IS NOT NULL) AS quartile FROM journal_info GROUP BY 1),
e AS (SELECT s.paper_id, max(g.sample_size) AS sample, string_agg(g.methods, '|' ORDER BY section_id) FILTER (g.methods <> '') AS methods FROM ({registry.ORACLE['evidence_signals']}) g JOIN sections s USING (section_id) WHERE s.section_type = 'methods' GROUP BY 1),
v AS (SELECT s.paper_id, arg_min(a.status, section_id) AS status FROM ({registry.ORACLE['data_availability']}) a JOIN sections s USING (section_id) GROUP BY 1),
x AS (SELECT p.paper_id, quartile, lower(coalesce(article_type, '')) AS kind, design, confidence AS c, sample, status, lower(coalesce(methods, '')) AS m FROM papers p LEFT JOIN d USING (paper_id) LEFT JOIN t USING (paper_id) LEFT JOIN j USING (paper_id) LEFT JOIN e USING (paper_id) LEFT JOIN v USING (paper_id))
SELECT paper_id, round(least(1.0::DOUBLE, CASE quartile WHEN 'Q1' THEN 0.30::DOUBLE WHEN 'Q2' THEN 0.20::DOUBLE WHEN 'Q3' THEN 0.10::DOUBLE WHEN 'Q4' THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END
  + CASE WHEN contains(kind, 'meta_analysis') THEN 0.22::DOUBLE WHEN contains(kind, 'systematic_review') THEN 0.20::DOUBLE WHEN contains(kind, 'protocol') OR design = 'protocol' THEN 0.05::DOUBLE WHEN contains(kind, 'case_report') THEN 0.05::DOUBLE WHEN contains(kind, 'letter') OR contains(kind, 'commentary') THEN 0.0::DOUBLE
    WHEN c > 0 THEN CASE WHEN design IN ('meta_analysis', 'systematic_review') THEN least(round(c * 0.30, 3), 0.25) ELSE round(c * 0.30, 3) END WHEN contains(kind, 'original_research') THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END
  + CASE WHEN sample >= 1000 THEN 0.20::DOUBLE WHEN sample >= 500 THEN 0.15::DOUBLE WHEN sample >= 100 THEN 0.10::DOUBLE WHEN sample >= 10 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END
  + CASE status WHEN 'accession_linked' THEN 0.15::DOUBLE WHEN 'open' THEN 0.10::DOUBLE WHEN 'restricted' THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END
  + CASE WHEN contains(m, 'shotgun') OR contains(m, 'whole metagenome') OR contains(m, 'whole genome') OR contains(m, 'wgs') OR contains(m, 'metatranscriptom') THEN 0.05::DOUBLE WHEN contains(m, '16s') OR contains(m, 'amplicon') THEN 0.03::DOUBLE WHEN m <> '' THEN 0.01::DOUBLE ELSE 0.0::DOUBLE END), 3) AS score FROM x""")
def paper_quality(spark, folder):
    papers, sections = table(spark, folder, "papers"), table(spark, folder, "sections").where("content is not null")
    quartile = table(spark, folder, "journal_info").where("quartile is not null").groupBy("paper_id").agg(F.min_by("quartile", "info_id").alias("quartile"))
    methods = sections.where("section_type = 'methods'")
    signals = extraction.evidence_signals(methods, "section_id", "content").join(methods.select("section_id", "paper_id"), "section_id")
    signals = signals.groupBy("paper_id").agg(F.max("sample_size").alias("sample"), F.array_join(F.array_sort(F.collect_set(F.array_join("methods", "|"))), "|").alias("methods"))
    stated = sections.where("section_type = 'data_availability'")
    status = extraction.availability(stated, "section_id", "content").join(stated.select("section_id", "paper_id"), "section_id").groupBy("paper_id").agg(F.min_by("status", "section_id").alias("status"))
    rows = papers.select("paper_id").join(extraction.study_design(papers).select("paper_id", "design", F.col("confidence").alias("c")), "paper_id").join(extraction.article_type(papers).select("paper_id", "article_type"), "paper_id")
    for other in (quartile, signals, status):
        rows = rows.join(other, "paper_id", "left")
    return rows.select("paper_id", scoring.quality(F.col("quartile"), F.col("article_type"), F.col("design"), F.col("c"), F.col("sample"), F.col("status"), F.col("methods")).alias("score"))
