"""Grounding, predicates, journals, the whole cascade, collectors, sinks and the limiter, with nulls, ties and empty tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from scholark.operators import audit, claims, dedup, enrichment, extraction, graph, grounding, journals, relevance, resolution
from scholark.plans import build, registry
from scholark.sources import collectors, readers, sinks

DATA = "/root/testdata/sf0.001"
NEW = sorted(n for n, f in registry.QUERIES.items() if f.__module__ == build.__name__)


def one(spark, expr, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("name", NEW)
def test_queries_on_empty_tables(spark, tmp_path_factory, name):
    folder = tmp_path_factory.getbasetemp() / "empty"
    if not folder.exists():
        for f in os.listdir(DATA):
            spark.read.parquet(f"{DATA}/{f}").limit(0).write.parquet(str(folder / f))
    assert registry.QUERIES[name](spark, str(folder)).count() == 0


def test_grounding_cascade(spark):
    mentions = spark.createDataFrame([("TNF", "gene", True, "g2", "b", 0.5), ("tnf ", "gene", True, "g1", "a", 0.9), ("TNF", "gene", True, "g0", "z", 0.9), ("ab", "gene", True, "g3", "c", 1.0), ("Rosa canina", "taxon", False, None, None, None), ("RCX", "taxon", None, None, None, None), ("odd", "gene", False, None, None, None), (None, "gene", True, "g", "n", 1.0), (" ", "gene", True, "g", "n", 1.0), ("x", None, True, "g", "n", 1.0)], "text string, label string, grounded boolean, ontology_id string, ontology_name string, grounding_confidence double")
    entities = spark.createDataFrame([("t1", "Rosa canina", "taxon"), ("t2", "Rosa alba", "taxon")], "canonical_id string, primary_name string, entity_type string")
    short = spark.createDataFrame([("RCX", "Rosa canina"), ("RCX", "Rosa alba")], "abbreviated_form string, full_form string")
    got = {r["form"]: (r["id"], r["source"]) for r in grounding.ground(grounding.lookup_keys(mentions), grounding.grounding_table(mentions), entities, short).collect()}
    assert got == {"tnf": ("g0", "cache"), "ab": ("ungrounded:ab", "none"), "rosa canina": ("t1", "registry"), "rcx": ("t1", "abbreviation"), "odd": ("ungrounded:odd", "none")}


def test_edges_keep_ungrounded_ends(spark):
    relations = spark.createDataFrame([(1, "A", "taxon", "b", "disease", "increased"), (2, "a", "taxon", "c", "taxon", "increased")], "evidence_id int, source string, source_label string, target string, target_label string, direction string")
    grounded = spark.createDataFrame([("b", "disease", "d1")], "form string, entity_type string, id string")
    assert [(r["rel"], r["src"], r["dst"]) for r in grounding.build_edges(relations, grounded).collect()] == [("REPORTS_ASSOCIATION", "ungrounded:a", "d1")]


@pytest.mark.parametrize(("raw", "want"), [("Produces", "PRODUCES"), ("is", "RELATES_TO"), ("x" * 61, "RELATES_TO"), ("cited by author", "RELATES_TO"), ("binds to-site", "BINDS_TO_SITE"), (None, None)])
def test_promoted_predicates(spark, raw, want):
    got = spark.createDataFrame([(raw,)], "p string").select(claims.promoted_predicate(F.col("p")).alias("x")).first()["x"]
    assert got == want


@pytest.mark.parametrize(("raw", "want"), [("produces and generates", "biosynthetic"), ("is linked_to", "associative"), ("increases inhibits", "regulatory"), ("zzz", "generic")])
def test_predicate_categories(spark, raw, want):
    assert one(spark, claims.predicate_category(F.col("p")), p=raw) == want


def test_article_types_by_tier(spark):
    rows = [
        ("tag", ["Journal Article", "Meta-Analysis", "Review"], "x", None), ("title", ["Journal Article"], "A study protocol", None), ("abstract", None, None, "We enrolled people; a forest plot is shown."), ("parts", [], "x", "Background: a. Methods: b. Results: c."),
        ("override", [], "", "Background: a. Methods: we searched the PubMed base."), ("generic", ["journal article "], "x", ""), ("none", None, None, None),
    ]
    got = {r["paper_id"]: (r["article_type"], r["confidence"]) for r in extraction.article_type(spark.createDataFrame(rows, "paper_id string, article_types array<string>, title string, abstract string")).collect()}
    assert got == {"tag": ("meta_analysis", 1.0), "title": ("protocol", 0.95), "abstract": ("meta_analysis", 0.92), "parts": ("original_research", 0.6), "override": ("systematic_review", 0.82), "generic": ("original_research", 0.65), "none": ("unknown", 0.4)}


def test_journal_classes(spark):
    names = spark.createDataFrame([("Gut Notes",), ("The  Gut",), ("Open Zoo",), ("Hilaris Zoo",), (" ",), (None,), ("Gut Notes",)], "journal_name string")
    known = spark.createDataFrame([("J1", "Gut Notes", "Q1", True), ("J0", "Gut", "Q2", False)], "journal_id string, journal_name string, quartile string, is_open_access boolean")
    got = {r["journal_name"]: (r["journal_id"], r["matched"], r["quartile"], r["is_open_access"], r["is_predatory"]) for r in journals.classify(names, known).collect()}
    assert got == {"Gut Notes": ("J1", "exact", "Q1", True, False), "The  Gut": ("J0", "partial", "Q2", False, False), "Open Zoo": (None, "guess", "unknown", True, False), "Hilaris Zoo": (None, "guess", "unknown", False, True)}


def test_cascade_stages_in_order(spark):
    cols = "k string, m string, gate boolean, rule double, probability double, embedding string, similarity double, llm_keep boolean, llm_confidence double"
    rows = [
        ("s1", "KEEP", False, 0.0, 0.0, "REJECT", 0.0, False, 0.9), ("gate", "UNKNOWN", False, 0.9, 0.9, "KEEP", 0.9, True, 0.9), ("s2", "UNKNOWN", True, 0.05, 0.9, "KEEP", 0.9, True, 0.9), ("s3", "UNKNOWN", True, 0.3, 0.9, "REJECT", 0.1, False, 0.9),
        ("s35", "UNKNOWN", True, 0.3, 0.5, "REJECT", 0.1, True, 0.9), ("routed", "UNKNOWN", True, 0.3, 0.5, "KEEP", 0.9, True, 0.9), ("unsure", "UNKNOWN", True, 0.3, 0.5, "BORDERLINE", 0.1, True, 0.6), ("mute", "UNKNOWN", True, 0.3, 0.5, "BORDERLINE", 0.1, None, None), ("low", "UNKNOWN", True, 0.3, 0.5, "BORDERLINE", 0.1, True, 0.4),
    ]
    got = {r["k"]: (r["stage"], r["keep"], r["review"]) for r in relevance.decide(spark.createDataFrame(rows, cols)).collect()}
    assert got == {
        "s1": ("stage1", True, False), "gate": ("gate", False, True), "s2": ("stage2", False, False), "s3": ("stage3", True, False), "s35": ("stage3.5", False, False), "routed": ("stage4", True, False), "unsure": ("stage4", None, True), "mute": ("stage4", None, True), "low": ("stage4", False, False),
    }


def test_limiter_counts_accepted_requests_only(spark):
    rows = [(k, 1, f"2024-01-01 00:00:{s:02d}") for k, s in enumerate([0, 1, 2, 30, 59])] + [(10, 1, "2024-01-01 00:01:00"), (11, 1, "2024-01-01 00:01:01"), (12, 2, "2024-01-01 00:00:00"), (13, None, "2024-01-01 00:00:00"), (14, 2, None)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts string").withColumn("ts", F.to_timestamp("ts"))
    got = {r["event_id"]: r["accepted"] for r in audit.accepted_in_window(df, "user_id", "ts", 60, 2).collect()}
    assert got == {0: True, 1: True, 2: False, 3: False, 4: False, 10: True, 11: True, 12: True}


def test_typed_relations(spark):
    rows = [("TAXON_REGULATES_GENE", "upregulates", 0.1), ("TAXON_REGULATES_GENE", "increased", 2.0), ("NONE", "x", None), (None, None, None)]
    df = spark.createDataFrame(rows, "r string, d string, p double").select(audit.typed_errors(F.col("r"), F.col("d"), F.col("p")).alias("e"))
    assert [r["e"] for r in df.collect()] == [[], ["direction", "p_value"], ["type"], ["type"]]


def test_deposits_merge_on_their_title_latest_first(spark):
    rows = [("a", "10.5281/zenodo.11", "core", "Gut  data!", "old", 1), ("b", "10.5281/ZENODO.12", "openalex", "gut data", None, 2), ("c", "10.5281/zenodo.13", "core", "", "x", 3)]
    df = spark.createDataFrame(rows, "paper_id string, doi string, source string, title string, abstract string, citation_count int").withColumns({"pmid": F.lit(None).cast("string"), "is_open_access": F.lit(None).cast("boolean")})
    got = {r["dedup_key"]: r for r in dedup.merge_records(df).collect()}
    r = got["deposit:gut data"]
    assert set(got) == {"deposit:gut data", "doi:10.5281/zenodo.13"} and (r["doi"], r["title"], r["abstract"], r["citation_count"], r["source"]) == ("10.5281/ZENODO.12", "gut data", "old", 2, "merged:openalex+core")


@pytest.mark.parametrize("most", [200_000, 0])
def test_rule_entities_match_alternations(spark, monkeypatch, most):
    """Leftmost-longest spans per label, as one alternation per label finds them; with small and large dictionaries."""
    import re

    monkeypatch.setattr(extraction, "MOST_TERMS", most)

    texts = ["E. coli and E. coli K12; IL-6, il-6a (IL-6).", "\u0130 TNF-\u03b1 rose. tnf-\u03b1", "", None, "gut gut microbiota gutx", "a|b a.b [x] e. coli"]
    terms = [("taxon", "E. coli"), ("taxon", "E. coli K12"), ("taxon", "coli K12"), ("gene", "IL-6"), ("gene", "TNF-\u03b1"), ("site", "gut"), ("site", "gut microbiota"), ("site", "g"), ("disease", "gut"), ("odd", "a|b"), ("odd", None)]
    got = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    rows = extraction.rule_entities(got, "k", "t", spark.createDataFrame(terms, "label string, term string")).collect()
    want = set()
    for k, t in enumerate(texts):
        for label in {x for x, _ in terms}:
            forms = sorted({f.lower() for x, f in terms if x == label and f and len(f) > 1 and not (label == "disease" and len(f) <= 3)}, key=len, reverse=True)
            if t and forms:
                for m in re.finditer(r"(?<![^\W_])(?:" + "|".join(map(re.escape, forms)) + r")(?![^\W_])", t.replace("\u0130", "i").lower()):
                    want.add((k, label, t[m.start() : m.end()], m.start(), m.end()))
    assert {(r["k"], r["label"], r["text"], r["start_char"], r["end_char"]) for r in rows} == want and len(rows) == len(want) > 8


def test_rule_entities_of_a_large_dictionary(spark, monkeypatch):
    """Only terms that occur count: the texts are mapped, not shuffled; in slices too every row of the texts counts."""
    texts = [(1, "The gut microbiota (E. coli K12) \u2265 gut-like \u03b2 E. coli"), (1, "gut"), (None, "E. coli, the gut"), (None, None), (2, ""), (3, "The gut microbiota"), (3, "The gut microbiota"), (3, "gut-like; IL")]
    terms = [("site", "gut"), ("site", "the gut microbiota"), ("taxon", "E. coli"), ("taxon", "(E. coli K12)"), ("taxon", '"E. coli"'), ("greek", "\u03b2 E."), ("gene", "IL-6"), ("gene", "IL 6")] + [("odd", f"word{k} of none") for k in range(20)]
    rows, known = spark.createDataFrame(texts, "k int, t string"), spark.createDataFrame(terms, "label string, term string")
    found = []
    for most in (100, 10, 2):
        monkeypatch.setattr(extraction, "MOST_TERMS", most)
        got = extraction.rule_entities(rows, "k", "t", known)
        assert most == 2 or "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        found.append(sorted(((r["k"] or 0), *r[1:]) for r in got.collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) == 10
    assert [x for x in found[0] if x[0] == 3] == [(3, "site", "The gut microbiota", 0, 18)] * 2


def test_updated_claims_are_the_sequential_fold(spark):
    rows = [("c", "p1", 0.9, False, 1), ("c", "p2", 0.5, False, 2), ("c", "p2", 0.1, True, 3), ("c", "p3", 0.7, True, 4), ("c", "p4", 1.0, False, 5), ("d", "p1", 0.4, True, 1), ("d", "p2", 0.6, False, 2), (None, "p", 0.5, False, 1), ("e", None, 0.5, False, 1)]
    df = spark.createDataFrame(rows, "claim string, paper string, x double, bad boolean, k int")
    got = {r["claim"]: (r["confidence"], r["n_support"], r["n_against"]) for r in claims.updated_claims(df, "claim", "paper", "x", F.col("bad"), ["k"]).collect()}
    c = ((0.9 * 0.9 + 0.1 * 0.5) * 0.8) * 0.9 + 0.1 * 1.0
    assert got == {"c": (round(c, 6), 3, 1), "d": (0.6, 1, 1)}


def test_weighted_terms_from_a_file(spark, tmp_path):
    (tmp_path / "terms.txt").write_text('# lists\npositive:\n  gut microbiome: 0.4\n  "stool": 0.3 # comment\nnegative:\n  mice: -0.5\ngate:\n  - 16s\n')
    terms = readers.read_terms(spark, str(tmp_path / "terms.txt"))
    assert sorted((r["section"], r["term"], r["weight"]) for r in terms.collect()) == [("gate", "16s", None), ("negative", "mice", -0.5), ("positive", "gut microbiome", 0.4), ("positive", "stool", 0.3)]
    rows = spark.createDataFrame([(1, "Gut Microbiome in STOOL of mice"), (2, "16S"), (3, None), (4, "")], "k int, t string")
    assert {r["k"]: (r["rule"], r["n_terms"]) for r in relevance.weighted_score(rows, F.coalesce("t", F.lit("")), terms).collect()} == {1: (0.133, 3), 2: (0.0, 0), 3: (0.0, 0), 4: (0.0, 0)}


def test_merge_plan_and_neighbours(spark):
    nodes = spark.createDataFrame([("a", "taxon"), ("b", "taxon"), ("c", "disease"), ("d", "taxon")], "id string, label string")
    mapping = spark.createDataFrame([("a", "b"), ("c", "b"), ("b", "d"), ("z", "a"), ("d", "d")], "old string, new string")
    got = {(r["old"], r["new"]): r["reason"] for r in graph.merge_plan(mapping, nodes).collect()}
    assert got == {("a", "b"): "target of a merge", ("c", "b"): "type conflict", ("b", "d"): "target of a merge", ("z", "a"): "unknown node", ("d", "d"): "same node"}
    rows = graph.neighbours(nodes.where("id in ('a', 'c')"), spark.createDataFrame([("a", "r", "c")], "src string, rel string, dst string")).collect()
    assert sorted((r["id"], r["way"], r["rel"] or "", r["other"] or "") for r in rows) == [("a", "in", "", ""), ("a", "out", "r", "c"), ("c", "in", "r", "a"), ("c", "out", "", "")]


def test_cursors_titles_and_nearest(spark):
    runs = spark.createDataFrame([("a", 0, 50), ("a", 50, 0), ("b", 0, 20), ("b", 20, 5)], "source string, o int, n int")
    assert {r["source"]: r["next_offset"] for r in enrichment.next_cursors(runs, "source", "n", "o").collect()} == {"a": 0, "b": 25}
    papers = spark.createDataFrame([("p1", "10.1/X", "7", "T"), ("p2", None, " ", None)], "paper_id string, doi string, pmid string, title string")
    keys = spark.createDataFrame([("p1",), ("10.1/x",), ("doi:10.1/x",), ("pmid:7",), ("p2",), (None,)], "key string")
    assert sorted((r["key"] or "", r["title"]) for r in enrichment.titles_by_key(keys, "key", papers).collect()) == [("", None), ("10.1/x", "T"), ("doi:10.1/x", "T"), ("p1", "T"), ("p2", None), ("pmid:7", "T")]
    up = resolution.ancestors(spark.createDataFrame([("x", "y"), ("y", "z"), ("z", "w"), ("w", "v")], "c string, p string"), "c", "p")
    assert {r["node"]: (r["ancestor"], r["level"]) for r in resolution.nearest_registered(up, spark.createDataFrame([("z",), ("v",)], "id string"), "id").collect()} == {"x": ("z", 2), "y": ("z", 1), "z": ("v", 2), "w": ("v", 1)}


# -- collectors
def _item(spark, value):
    return spark.createDataFrame([(json.dumps(value),), ("{broken",), (None,), ("{}",)], "item string")


def test_europepmc(spark):
    item = {"pmid": "1", "pmcid": "PMC1", "title": " T ", "authorList": {"author": [{"fullName": "Smith J"}, {"lastName": "Doe", "initials": "A"}, {}]}, "journalInfo": {"journal": {"title": "J", "essn": "1-2"}, "dateOfPublication": "2024 Mar"}, "isOpenAccess": "Y", "meshHeadingList": {"meshHeading": [{"descriptorName": "Humans"}]}, "citedByCount": 3}
    r = collectors.from_europepmc(_item(spark, item)).collect()
    assert len(r) == 1 and (r[0]["title"], r[0]["authors"], r[0]["issn"], r[0]["publication_year"], r[0]["is_open_access"], r[0]["mesh_terms"], r[0]["citation_count"], r[0]["full_text_url"]) == ("T", ["Smith J", "Doe A"], "1-2", 2024, True, ["Humans"], 3, "https://europepmc.org/article/MED/1")


def test_semantic_scholar(spark):
    item = {"externalIds": {"DOI": "10.1/x", "ArXiv": "2401.1"}, "title": "T", "authors": [{"name": "A"}, {"name": None}], "venue": "V", "journal": {}, "year": 2024, "openAccessPdf": {"url": "u"}}
    r = collectors.from_semantic_scholar(_item(spark, item)).collect()[0]
    assert (r["doi"], r["authors"], r["journal"], r["is_preprint"], r["is_open_access"], r["pdf_url"]) == ("10.1/x", ["A"], "V", True, False, "u")


def test_openalex(spark):
    item = {"doi": "https://doi.org/10.1/x\"><", "ids": {"pmid": "https://pubmed.ncbi.nlm.nih.gov/17"}, "title": "T", "abstract_inverted_index": {"b": [1], "a": [0, 2]}, "concepts": [{"display_name": "c", "score": 0.3}, {"display_name": "d", "score": 0.2}], "open_access": {"is_oa": True}}
    r = collectors.from_openalex(_item(spark, item)).collect()[0]
    assert (r["doi"], r["pmid"], r["abstract"], r["keywords"], r["is_open_access"], r["article_types"]) == ("10.1/x", "17", "a b a", ["c"], True, ["article"])


def test_crossref(spark):
    item = {"DOI": "10.1/x", "title": ["T"], "abstract": "<jats:p>A  b</jats:p>", "author": [{"given": "J", "family": "Roe"}, {"family": "Solo"}, {"name": "Org"}, {}], "published": {"date-parts": [[2024, 3]]}, "container-title": ["J"], "ISSN": ["1"], "license": [{"URL": "http://CreativeCommons.org/by"}], "link": [{"URL": "a", "content-type": "text/html"}, {"URL": "b", "content-type": "application/pdf"}], "is-referenced-by-count": 4}
    r = collectors.from_crossref(_item(spark, item)).collect()[0]
    assert (r["abstract"], r["authors"], r["publication_date"], r["is_open_access"], r["pdf_url"], r["citation_count"]) == ("A b", ["Roe, J", "Solo", "Org"], "2024-03-01", True, "b", 4)


def test_core(spark):
    item = {"title": "T", "abstract": " ", "fullText": "x" * 3000, "journals": [{"title": "J", "identifiers": ["oai:1", "issn:1-2"]}], "publishedDate": "2024-03-15T00:00:00", "links": [{"type": "download", "url": "d"}]}
    r = collectors.from_core(_item(spark, item)).collect()[0]
    assert (len(r["abstract"]), r["issn"], r["publication_date"], r["pdf_url"], r["full_text_url"], r["is_open_access"], r["article_types"]) == (2000, "1-2", "2024-03-15", "d", "d", True, ["research"])


def test_pubmed(spark):
    xml = (
        '<PubmedArticle><MedlineCitation><PMID Version="1">7</PMID><Article><ArticleTitle>T</ArticleTitle><Abstract><AbstractText Label="AIM">a</AbstractText><AbstractText>b</AbstractText></Abstract><AuthorList><Author><LastName>Roe</LastName><ForeName>J</ForeName></Author>'
        '<Author><CollectiveName>Org</CollectiveName></Author></AuthorList><Journal><Title>J</Title><ISSN IssnType="Print">1-2</ISSN><JournalIssue><Volume>3</Volume><PubDate><Year>2024</Year><Month>Mar</Month><Day>5</Day></PubDate></JournalIssue></Journal>'
        '<PublicationTypeList><PublicationType UI="D1">Review</PublicationType></PublicationTypeList></Article><MeshHeadingList><MeshHeading><DescriptorName UI="D2">Humans</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation>'
        '<PubmedData><ArticleIdList><ArticleId IdType="doi">10.1/x</ArticleId><ArticleId IdType="pmc">PMC9</ArticleId></ArticleIdList></PubmedData></PubmedArticle>'
    )
    rows = collectors.from_pubmed(spark.createDataFrame([(xml,), ("<PubmedArticle/>",), (None,)], "item string")).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["pmid"], r["pmcid"], r["doi"], r["abstract"], r["authors"], r["publication_date"], r["article_types"], r["mesh_terms"], r["volume"], r["is_open_access"]) == ("7", "PMC9", "10.1/x", "AIM: a\nb", ["Roe, J", "Org"], "2024-03-05", ["Review"], ["Humans"], "3", True)


def test_paged_source(spark, tmp_path):
    for n, page in enumerate([{"resultList": {"result": [{"title": "a"}, {"title": "b"}]}}, [{"title": "c"}], {"items": []}]):
        (tmp_path / f"p{n}.json").write_text(json.dumps(page))
    (tmp_path / "p3.json").write_text("{broken")
    spark.dataSource.register(collectors.PagedSource)
    rows = spark.read.format("scholark_pages").load(str(tmp_path)).collect()
    assert [(r["page"], json.loads(r["item"])["title"]) for r in rows if r["item"]] == [("p0.json", "a"), ("p0.json", "b"), ("p1.json", "c")] and [r["page"] for r in rows if r["error"]] == ["p3.json"]
    later = spark.read.format("scholark_pages").option("startPage", 1).option("maxPages", 1).load(str(tmp_path))
    assert [json.loads(r["item"])["title"] for r in later.collect()] == ["c"]


def test_batch_verdicts_pair_by_position(spark):
    good = '```json\n{"results": [{"keep": true, "confidence": 0.9}, {"keep": false, "confidence": 0.2}]}\n```'
    df = spark.createDataFrame([(1, good), (2, '[{"keep": true}]'), (3, "no"), (4, None), (5, '<think>[1]</think>[{"keep": true}, {"keep": true}]')], "k int, a string")
    got = sorted((r["k"], r["pos"], r["keep"]) for r in readers.parse_batch_verdicts(df, "k", "a", 2).collect())
    assert got == [(1, 0, True), (1, 1, False), (5, 0, True), (5, 1, True)]


# -- sinks
def test_batches_have_manifest_and_index(spark, tmp_path):
    rows = lambda *k: spark.createDataFrame([(x, x.upper()) for x in k], "content_hash string, title string")
    path = str(tmp_path / "store")
    assert [sinks.append_batch(rows("a", "b", "b"), path, "content_hash", "one"), sinks.append_batch(rows("b", "c"), path, "content_hash", "two"), sinks.append_batch(rows("c"), path, "content_hash", "three")] == [2, 1, 0]
    assert spark.read.parquet(f"{path}/records").count() == 3 and {(r["batch"], r["n_records"]) for r in spark.read.json(f"{path}/manifest").collect()} == {("one", 2), ("two", 1), ("three", 0)}


def test_embeddings_refuse_other_lengths(spark, tmp_path):
    path = str(tmp_path / "v")
    rows = lambda *v: spark.createDataFrame(list(v), "id int, v array<float>, part string")
    sinks.append_embeddings(rows((1, [1.0, 2.0], "p"), (1, [1.0, 2.0], "p")), path, "id", "v", "part")
    sinks.append_embeddings(rows((1, [3.0, 2.0], "n"), (2, [1.0, 2.0], "n")), path, "id", "v", "part")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError, match="lengths"):
        sinks.append_embeddings(rows((3, [1.0], "p")), path, "id", "v", "part")


def test_logs_queue_and_texts(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    nodes = spark.createDataFrame([("a", 1), ("b", None)], "id string, n int")
    sinks.log_changes(nodes, p("log"), "node_created", "job", ["id", "n"])
    assert {json.loads(r["details"])["id"] for r in spark.read.parquet(p("log")).collect()} == {"a", "b"}
    resolved = spark.createDataFrame([("x", "taxon", "t1"), ("y", "taxon", None)], "form string, entity_type string, canonical_id string")
    found = spark.createDataFrame([("x", "taxon", s, "t1", 1.0) for s in ("exact", "synonym", "fuzzy")], "form string, entity_type string, strategy string, canonical_id string, confidence double")
    sinks.log_resolutions(resolved, found, p("res"))
    assert {r["form"]: r["high_conflict"] for r in spark.read.parquet(p("res")).collect()} == {"x": True, "y": False}
    assert sinks.queue_invalid(nodes.withColumn("errors", F.when(F.col("n").isNull(), F.array(F.lit("n"))).otherwise(F.array())), p("queue")) == 1
    sinks.log_run(spark, p("runs"), run_id="r", stage1=3)
    sinks.log_run(spark, p("runs"), run_id="s", stage1=4)
    assert spark.read.json(p("runs")).count() == 2
    texts = spark.createDataFrame([("ab1", "one"), ("ab1", "one"), ("cd2", "two"), ("ee", " "), (None, "x")], "content_hash string, content string")
    sinks.save_texts(texts, p("texts"))
    sinks.save_texts(texts, p("texts"))
    assert {r["content_hash"]: r["content"] for r in sinks.load_texts(spark, p("texts"), spark.createDataFrame([("ab1",), ("zz",)], "content_hash string")).collect()} == {"ab1": "one"}
    assert sinks.text_stats(spark, p("texts")).first().asDict() == {"n_texts": 2, "n_chars": 6, "n_prefixes": 2}


# -- requests, verification, jobs
def _api(spark, clock, **more):
    from scholark.plans import api, engine

    plans = {name: (lambda **p: spark.createDataFrame([(json.dumps(p, sort_keys=True),)], "p string")) for name, _ in api.ROUTES.values()}
    plans["top_associations"] = lambda **p: spark.sql("select raise_error('bad')")
    return api.Api(engine.Engine(spark, plans), api.Limiter(3, 60, clock), **more)


def test_routes_validate_limit_and_answer(spark):
    now = [0.0]
    known = spark.createDataFrame([("Gut Pain",)], "name string")
    app = _api(spark, lambda: now[0], known={"disease": known})
    post = lambda path, who="u", **body: app.handle("POST", path, body, who)
    status, got = post("/query/cross-study-associations", disease="gut pain", min_papers=2)
    assert status == 200 and json.loads(got["rows"][0]["p"]) == {"disease": "gut pain", "min_papers": 2} and not got["cached"]
    assert post("/query/cross-study-associations", disease="gut pain", min_papers=2)[1]["cached"]
    assert post("/query/cross-study-associations", disease="odd")[1] == {"errors": ["disease: unknown odd"]}
    assert post("/query/cross-study-associations", disease="gut pain")[0] == 429
    now[0] = 61.0
    assert post("/query/top-associations", disease="gut pain")[0] == 500
    bad = [("/query/intervention-evidence", {"types": []}), ("/query/intervention-evidence", {"types": ["a", "DROP x"]}), ("/query/methodology-landscape", {"year_start": 2020, "year_end": 2010}), ("/query/conflicting-evidence", {"disease": "gut pain", "x": 1}), ("/query/top-associations", {"disease": "gut pain", "top_n": 0}), ("/query/conflicting-evidence", {})]
    assert [post(p, f"v{k}", **b)[0] for k, (p, b) in enumerate(bad)] == [400] * len(bad)
    assert app.handle("GET", "/health")[1]["status"] == "healthy" and app.handle("GET", "/limits")[1]["requests"] == 3 and app.handle("GET", "/none")[0] == 404
    assert app.handle("POST", "/cache/invalidate")[1] == {"invalidated": 1} and app.handle("GET", "/cache/stats")[1]["hits"] == 1 and "/health" in app.handle("GET", "/")[1]["management"]


def test_verifier_retries_splits_and_uses_the_cache(spark):
    from scholark.operators import verifier

    def ask(texts):
        if "bad" in texts and len(texts) > 1 or texts == ["bad"]:
            return "no json"
        if "boom" in texts:
            raise RuntimeError("down")
        return "```json\n" + json.dumps([{"keep": t.startswith("k"), "confidence": 0.9 if t != "k2" else 0.6} for t in texts]) + "\n```"

    rows = spark.createDataFrame([(1, "k1"), (2, "k2"), (3, "x"), (4, "bad"), (5, "boom"), (6, "cached"), (7, None)], "id int, t string").coalesce(1)
    cache = spark.createDataFrame([(6, True, 0.8, "old"), (6, True, 0.8, "old"), (99, True, 1.0, "")], "id int, keep boolean, confidence double, reason string")
    got = {r["id"]: (r["keep"], r["review"]) for r in verifier.verify(rows, "id", "t", ask, cache).collect()}
    assert got == {1: (True, False), 2: (True, True), 3: (False, False), 4: (None, True), 5: (None, True), 6: (True, False), 7: (False, False)}


def test_hybrid_needs_rows_classes_and_quality(spark):
    from scholark.operators import verifier

    rows = spark.range(300).selectExpr("id", "id / 300 as rule", "id / 300 as probability", "cast(null as double) as positive", "1.0 as negative", "case when id > 150 then 1 else 0 end as label")
    model = verifier.hybrid(rows)
    assert model is not None and verifier.hybrid(rows.limit(100)) is None and verifier.hybrid(rows.withColumn("label", F.lit(1))) is None
    noise = rows.withColumn("label", F.pmod(F.xxhash64("id"), F.lit(2)))
    assert verifier.hybrid(noise) is None
    got = verifier.hybrid_scores(rows.drop("probability").withColumn("probability", F.col("rule")), model)
    assert got.where("keep = (label = 1)").count() > 280 and verifier.hybrid_scores(rows, None).where("keep is not null").count() == 0


def test_jobs_are_due_at_their_times():
    from datetime import datetime

    from scholark.streaming import jobs

    at = datetime(2024, 5, 30, 2, 0)  # a Thursday
    assert jobs.next_run("collect", at) == datetime(2024, 5, 31, 2) and jobs.next_run("retrain", at) == datetime(2024, 6, 2, 3) and jobs.next_run("drift", at) == datetime(2024, 6, 1, 4)
    assert jobs.due("collect", None, at) and not jobs.due("collect", at, datetime(2024, 5, 31, 1, 59)) and jobs.due("collect", at, datetime(2024, 5, 31, 2))


def test_collecting_job_takes_each_page_once(spark, tmp_path):
    from scholark.streaming import jobs

    pages, store, state = (str(tmp_path / n) for n in ("pages", "store", "state"))
    os.mkdir(pages)
    page = lambda n, *titles: open(f"{pages}/{n}.json", "w").write(json.dumps({"results": [{"title": t} for t in titles]}))  # noqa: E731, SIM115
    page(1, "a", "b")
    jobs.collect_new(spark, pages, store, state, collectors.from_openalex)
    page(2, "b", "c")
    jobs.collect_new(spark, pages, store, state, collectors.from_openalex)
    jobs.collect_new(spark, pages, store, state, collectors.from_openalex)
    assert sorted(r["title"] for r in spark.read.parquet(f"{store}/records").collect()) == ["a", "b", "c"] and spark.read.json(f"{store}/manifest").count() == 2
