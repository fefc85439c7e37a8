"""Ladders, facade, sources, sinks, streaming and the registry's own queries against their SQL."""

import json
import math
import time

import pytest
from pyspark.sql import functions as F

from scholark.functions import scoring, text
from scholark.operators import audit, claims, dedup, enrichment, extraction, graph, relevance, research, resolution, similarity
from scholark.plans import build, engine, extractors, registry  # noqa: F401 - build registers its queries
from scholark.sources import readers, sinks
from scholark.streaming import state, windows

DATA = "/root/testdata/sf0.001"


def one(spark, expr, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(("sentence", "want"), [("levels increased in stool", "increased"), ("was reduced", "decreased"), ("no change in lactate", "no_change"), ("was linked to pain", "associated"), ("was associated with pain", None), ("a biomarker that increased", "increased"), ("nothing here", None), ("", None), (None, None)])
def test_directions(spark, sentence, want):
    assert spark.createDataFrame([(sentence,)], "s string").select(text.direction(F.col("s")).alias("x")).first()["x"] == want


@pytest.mark.parametrize(("sentence", "want"), [("(p = 0.031)", 0.031), ("P=.25", 0.25), ("p < 0.001", 0.001), ("p < 0.05, p = 0.03", 0.03), ("p = 7", None), ("step = 3", None)])
def test_p_values(spark, sentence, want):
    assert one(spark, text.p_value(F.col("s")), s=sentence) == want


@pytest.mark.parametrize(("confidence", "section", "kind", "want"), [(0.6999, "results", "RCT", "weak"), (0.7, "results", "review", "moderate"), (0.85, " Results ", "RCT", "strong"), (0.8499, "discussion", "RCT", "moderate"), (0.9, "abstract", "RCT", "weak"), (0.9, "methods", "RCT", "weak")])
def test_triple_strength(spark, confidence, section, kind, want):
    assert one(spark, scoring.strength_of_triple(F.col("c"), F.col("s"), F.col("k")), c=confidence, s=section, k=kind) == want


@pytest.mark.parametrize(("strengths", "want"), [(["weak"], "weak"), (["moderate"] * 2, "moderate"), (["moderate"] * 3, "strong"), (["strong", "weak"], "strong"), ([None], "weak")])
def test_claim_strength(spark, strengths, want):
    rows = spark.createDataFrame([(s,) for s in strengths], "s string")
    assert rows.agg(scoring.claim_strength(F.col("s")).alias("x")).first()["x"] == want


@pytest.mark.parametrize(("counts", "three", "want"), [((1, 1, 1, 1), False, "increased"), ((0, 2, 2, 2), False, "decreased"), ((0, 0, 2, 2), False, "associated"), ((0, 0, 0, 5), True, "increased"), ((0, 1, 2, 9), True, "no_change")])
def test_consensus_ties(spark, counts, three, want):
    i, d, n, a = (F.lit(x) for x in counts)
    assert one(spark, scoring.consensus(i, d, n, None if three else a)) == want


@pytest.mark.parametrize(("p", "kind", "want"), [(None, "RCT", "weak"), (0.0099, "RCT", "strong"), (0.01, "RCT", "moderate"), (0.0099, "review", "moderate"), (0.05, "RCT", "weak")])
def test_p_strength(spark, p, kind, want):
    got = spark.createDataFrame([(p, kind)], "p double, k string").select(scoring.strength_from_p(F.col("p"), F.col("k")).alias("x")).first()["x"]
    assert got == want


@pytest.mark.parametrize(("raw", "want"), [("inhibits", "INHIBITS"), ("strongly inhibits growth", "INHIBITS"), ("promo", "PROMOTES"), ("binds", "RELATES_TO"), ("Associated With", "ASSOCIATED_WITH")])
def test_predicates(spark, raw, want):
    assert one(spark, claims.canonical_predicate(F.col("r")), r=raw) == want


def test_sentence_functions(spark):
    s = spark.createDataFrame([("One two. Three 4), or? Five",)], "t string")
    assert s.select(text.sentences_dropping(F.col("t")).alias("x")).first()["x"] == ["One two", "Three 4), or", "Five"]
    assert s.select(text.sentences_keeping(F.col("t")).alias("x")).first()["x"] == ["One two.", "Three 4), or?", "Five"]
    row = s.select(text.context(text.sentences_keeping(F.col("t")), F.lit(0), 1).alias("c"), text.char_offset(F.col("t"), F.lit("Three")).alias("o"), text.char_offset(F.col("t"), F.lit("zzz")).alias("n")).first()
    assert (row["c"], row["o"], row["n"]) == ("One two. Three 4), or?", 9, None)


def test_small_text_functions(spark):
    assert one(spark, text.relation_name(F.col("s")), s="is part-of") == "IS_PART_OF" and one(spark, text.relation_name(F.col("s")), s="16S of") == "REL_16S_OF"
    assert one(spark, text.graph_label(F.col("s")), s="immune cell_type") == "ImmuneCellType"
    assert one(spark, text.reconstruct(F.create_map(F.lit("b"), F.array(F.lit(1), F.lit(3)), F.lit("a"), F.array(F.lit(0), F.lit(2))))) == "a b a b"
    n = lambda k: len(one(spark, text.chunks(F.array_repeat(F.lit("w"), k))))
    assert (n(1), n(400), n(401), n(751)) == (1, 1, 2, 3)


def test_merge_fills_from_the_next_source(spark):
    rows = [("a", "10.1234/X", None, "core", "T core", "", ["Al", "Bo"], False, 2020), ("b", "10.1234/x ", None, "PUBMED ", None, "text", ["al", "Cy"], True, None), ("c", None, "5", "core", "other", None, None, None, None), ("d", "", "", "core", "", None, [], None, None)]
    df = spark.createDataFrame(rows, "paper_id string, doi string, pmid string, source string, title string, abstract string, authors array<string>, is_open_access boolean, publication_year int")
    got = {r["dedup_key"]: r for r in dedup.merge_records(df).collect()}
    assert set(got) == {"doi:10.1234/x", "pmid:5"}
    r = got["doi:10.1234/x"]
    assert (r["n_records"], r["title"], r["abstract"], r["publication_year"], r["is_open_access"], r["authors"]) == (2, "T core", "text", 2020, True, ["al", "Cy", "Bo"])


def test_folded_confidence_is_the_sequential_update(spark):
    values = [0.9, 0.5, 0.7, 0.6, 1.0]
    c = values[0]
    for v in values[1:]:
        c = 0.9 * c + 0.1 * v
    df = spark.createDataFrame([("x", k, v) for k, v in enumerate(values)] + [("x", 9, None), ("y", 1, 0.4)], "claim string, k int, v double")
    got = {r["claim"]: r["confidence"] for r in claims.folded_confidence(df, "claim", "v", ["k"]).collect()}
    assert math.isclose(got["x"], c) and math.isclose(got["y"], 0.4)


def test_thresholds_stop_at_the_first_miss(spark):
    rows = [(0.9, 1)] * 10 + [(0.8, 0)] * 5 + [(0.7, 1)] * 200 + [(0.1, 0)] * 50
    got = relevance.calibrated_thresholds(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()
    assert (got["keep_at"], got["reject_at"]) == (0.9, 0.3)
    worse = relevance.calibrated_thresholds(spark.createDataFrame([(0.5, 0)], "s double, y int"), "s", "y").first()
    assert (worse["keep_at"], worse["reject_at"]) == (0.7, 0.3)


@pytest.mark.parametrize(("mesh", "want"), [(["Humans", "Microbiota"], ("KEEP", 0.9)), (["Humans", "Mice", "Microbiota"], ("KEEP", 0.7)), (["Mice", "Microbiota"], ("REJECT", 0.05)), (["Humans"], ("UNKNOWN", 0.1)), (["Microbiota"], ("UNKNOWN", 0.45)), (None, ("UNKNOWN", 0.1))])
def test_metadata_stage(spark, mesh, want):
    r = spark.createDataFrame([(mesh,)], "m array<string>").select(relevance.metadata_verdict(F.col("m")).alias("v")).first()["v"]
    assert (r["verdict"], r["score"]) == want


@pytest.mark.parametrize(("pos", "neg", "n", "want"), [(0.85, 0.5999, 50, "KEEP"), (0.85, 0.60, 50, "BORDERLINE"), (0.5, 0.9, 50, "REJECT"), (0.99, 0.1, 49, "INACTIVE")])
def test_embedding_verdicts(spark, pos, neg, n, want):
    assert one(spark, relevance.embedding_verdict(F.col("p"), F.col("g"), F.col("n"), F.col("n")), p=pos, g=neg, n=n) == want


def test_top_k_in_blocks_matches_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    m = rng.normal(size=(60, 8)).astype("float32")
    df = spark.createDataFrame([(int(k), [float(x) for x in v]) for k, v in enumerate(m)] + [(99, None)], "vec_id long, v array<float>")
    got = {(r["query_id"], r["rank"]): r["id"] for r in similarity.top_k(df, df.where("vec_id < 9"), "vec_id", "v", 3, block=4).collect()}
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    for q in range(9):
        s = unit @ unit[q]
        s[q] = -2
        assert [got[q, r + 1] for r in range(3)] == list(np.argsort(-s, kind="stable")[:3])


def test_nodes_merge_keeps_the_more_confident_edge(spark):
    edges = spark.createDataFrame([("a", "R", "x", 0.5), ("b", "R", "x", 0.9), ("a", "R", "b", 0.7)], "src string, rel string, dst string, confidence double")
    got = graph.merge_nodes(edges, spark.createDataFrame([("b", "a")], "old string, new string")).collect()
    assert [(r["src"], r["dst"], r["confidence"], r["n_merged"]) for r in got] == [("a", "x", 0.9, 2)]


def test_validation(spark):
    rows = spark.createDataFrame([(0.5, 0.1, "associated", "weak"), (1.5, None, "up", "weak"), (None, 2.0, None, None)], "confidence double, p_value double, direction string, evidence_strength string")
    good, bad = audit.split_valid(rows)
    assert good.count() == 1 and sorted(map(tuple, (r["errors"] for r in bad.collect()))) == [("confidence", "direction"), ("confidence", "p_value", "direction", "strength")]
    assert [one(spark, audit.valid_id(F.lit(k), F.lit(v))) for k, v in (("taxon", "ncbx:900001"), ("taxon", "ncbx:01"), ("disease", "mshx:Z00001"), ("method", "METHOD-Z0001"), ("gene", "x"))] == [True, False, True, True, False]


def test_degradation_needs_more_than_five_points(spark):
    rows = spark.createDataFrame([("a", 1, 0.9), ("a", 2, 0.85), ("b", 1, 0.9), ("b", 2, 0.8), ("c", 1, 0.9)], "k string, t int, r double")
    assert {r["k"]: r["degraded"] for r in resolution.degradation(rows, "k", "t", "r").collect()} == {"a": False, "b": True}


def test_sections_by_header(spark):
    df = spark.createDataFrame([(1, "lead\n\n1. Introduction\nfirst\r\nsecond\nRESULTS:\nthird")], "id long, c string")
    got = [(r["header"], r["body"]) for r in extraction.header_sections(df, "id", "c").orderBy("section_no").collect()]
    assert got == [(None, "lead"), ("1. Introduction", "first second"), ("RESULTS:", "third")]


# ---- facade ----
def test_envelope_and_cache(spark):
    now = [0.0]
    cache = engine.ResultCache(ttl=10, clock=lambda: now[0])
    calls = []

    def plan(n):
        calls.append(n)
        return spark.range(n)

    e = engine.Engine(spark, {"q": plan}, cache, most_rows=5)
    assert e.run("q", n=9).count == 5 and e.run("q", n=9).cached and calls == [9]
    now[0] = 11
    assert not e.run("q", n=9).cached and cache.stats()["expired"] == 1
    assert cache.invalidate("q") == 1
    assert "nope" in (e.run("nope").error or "") and e.sql("select :x + 1 as y", x=2).rows == [{"y": 3}]
    assert e.sql("select broken from nowhere").error


@pytest.mark.parametrize(("value", "kind", "fine"), [("Crohn's disease", str, True), ("x'; DROP table y", str, False), ("", str, False), ("a" * 201, str, False), (float("nan"), float, False), (0.5, float, True), (True, int, False), ([], list, False), (["a"] * 51, list, False)])
def test_parameters(value, kind, fine):
    assert (engine.validate("p", value, kind) is None) == fine


def test_extractors(spark):
    known = extractors.registry(spark)
    new = spark.createDataFrame([("mine", "rule", "1", True, 0), ("model_ner", "x", "9", False, 5)], known.schema)
    all_ = extractors.deactivate(extractors.register(known, new), "llm_triple")
    assert all_.count() == 9
    used = spark.createDataFrame([("mine",), ("mine",), ("llm_triple",), ("odd",)], "method_id string")
    assert extractors.with_counts(all_, used).where("method_id = 'mine'").first()["n_extractions"] == 2
    assert extractors.unregistered(used, all_).count() == 2


# ---- sources and sinks ----
def test_metrics_log_keeps_broken_lines(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    p.write_text('{"run_id": "a", "total": 5}\n<<<<<<< HEAD\n{"run_id": "b"}\n')
    good, bad = readers.read_metrics(spark, str(p))
    assert [r["run_id"] for r in good.collect()] == ["a", "b"] and bad.count() == 1


def test_stored_papers_newest_file_wins(spark, tmp_path):
    for name, title in (("run1.json", "old"), ("run2.json", "new")):
        (tmp_path / name).write_text(json.dumps([{"paper_id": "p", "doi": "10.1234/a", "title": title}]))
    got = readers.latest_per_key(readers.read_papers(spark, str(tmp_path))).collect()
    assert [r["title"] for r in got] == ["new"]


def test_overrides_and_full_text(spark, tmp_path):
    p = tmp_path / "o.csv"
    p.write_text("surface_form,canonical_id,entity_type,curator_id,justification\nx,ncbx:9,taxon,c,ok\ny,bad,taxon,c,ok\nz,,taxon,c,ok\n")
    good, bad = readers.read_overrides(spark, str(p))
    assert good.count() == 1 and sorted(r["reason"] for r in bad.collect()) == ["invalid id", "missing value"]
    papers = spark.createDataFrame([("a",), ("b",), ("c",)], "paper_id string")
    tier = lambda *rows: spark.createDataFrame(list(rows), "paper_id string, content string")
    got = {r["paper_id"]: r["tier"] for r in readers.full_text([("xml", tier(("a", "x" * 300), ("b", "short"))), ("pdf", tier(("b", "y" * 400)))], "paper_id", papers).collect()}
    assert got == {"a": "xml", "b": "pdf", "c": None}


def test_model_answers(spark):
    raw = '<think>hm</think>```json\n[{"subject": "A", "predicate": "inhibits", "object": "B", "confidence": 3}, {"subject": "", "predicate": "x", "object": "y"}]\n``` trailing'
    got = readers.parse_triples(spark.createDataFrame([("p", raw), ("q", "no json")], "paper_id string, raw string"), "raw").collect()
    assert [(r["paper_id"], r["subject"], r["confidence"]) for r in got] == [("p", "A", 1.0)]
    v = readers.parse_verdicts(spark.createDataFrame([('x {"keep": true, "confidence": 0.9} y',), ("keep: true maybe",), ("broken",)], "raw string"), "raw").collect()
    assert [(r["verdict"]["keep"], r["verdict"]["confidence"]) for r in v] == [(True, 0.9), (True, 0.7), (False, 0.5)]


def test_append_new_and_snapshot(spark, tmp_path):
    store = str(tmp_path / "store")
    a = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "k string, v int")
    sinks.append_new(a, store, "k")
    sinks.append_new(spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int"), store, "k")
    assert sorted(r["k"] for r in spark.read.parquet(store).collect()) == ["a", "b", "c"]
    counts = sinks.snapshot({"t": a}, str(tmp_path / "snap"))
    assert sinks.verify(spark, str(tmp_path / "snap"), counts) and counts == {"t": 3}
    sinks.rollback(spark, str(tmp_path / "snap"), str(tmp_path / "live"), ["t"])
    assert spark.read.parquet(str(tmp_path / "live/t")).count() == 3


# ---- streaming ----
def _stream(spark, tmp_path, df):
    df.write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))


def _drain(stream, name, mode):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return q


def test_rate_limiter_keeps_accepted_only(spark, tmp_path):
    rows = [(1, k, k * 10) for k in range(8)] + [(2, 100, 0)]
    df = spark.createDataFrame(rows, "user_id long, event_id long, s long").select("user_id", "event_id", F.timestamp_seconds("s").alias("ts"))
    _drain(state.rate_limiter(_stream(spark, tmp_path, df), seconds=30, most=2), "limited", "append")
    got = {r["event_id"]: r["accepted"] for r in spark.table("limited").collect()}
    # 0 and 10 pass; 20 meets two; 30 is 30 s after 0, which has left; 40 follows 10's leaving; and so on
    assert [got[k] for k in range(8)] == [True, True, False, True, True, False, True, True] and got[100]


def test_running_claims_ignore_known_papers(spark, tmp_path):
    rows = [("c", 1, "p1", 0.8), ("c", 2, "p2", 0.6), ("c", 3, "p1", 0.1), ("d", 4, "p1", None)]
    df = spark.createDataFrame(rows, "claim_id string, evidence_id long, paper_id string, confidence double")
    _drain(state.running_claims(_stream(spark, tmp_path, df)), "running", "update")
    got = {r["claim_id"]: (r["paper_count"], round(r["confidence"], 6)) for r in spark.table("running").collect()}
    assert got == {"c": (2, 0.78), "d": (0, 0.0)}


def test_windows_and_once(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 10, 2.0), ("a", 10, 2.0), ("b", 4000, 5.0)], "k string, s long, v double").withColumn("ts", F.timestamp_seconds("s"))
    got = windows.tumbling(df, "ts", "1 hour", ["k"], "v").collect()
    assert {(r["k"], r["n_events"], r["total"]) for r in got} == {("a", 3, 5.0), ("b", 1, 5.0)}
    assert windows.sessions(df, "ts", "5 minutes", "k").count() == 2
    _drain(windows.once(_stream(spark, tmp_path, df), "k", "ts", "2 hours"), "once", "append")
    assert spark.table("once").count() == 2


# ---- research questions on hand-made tables ----
def test_cross_study_and_conflicts(spark):
    assoc = spark.createDataFrame(
        [("p1", 1, "t", "d", "increased", 0.9), ("p1", 1, "t", "d", "increased", 0.9), ("p2", 1, "t", "d", "decreased", 0.7), ("p3", 1, "t", "d", None, 0.7), ("p3", 2, "u", "d", "increased", 0.6999), ("p2", 3, "v", "e", "increased", 1.0)],
        "paper_id string, taxon_id int, taxon string, disease string, direction string, confidence double",
    )
    papers = spark.createDataFrame([(f"p{k}", "t", 2000, "RCT", "open", ["SRP1"]) for k in (1, 2, 3)], "paper_id string, title string, year int, article_type string, data_availability string, accession_numbers array<string>")
    r = research.cross_study_associations(assoc, papers, "d").collect()
    assert [(x["taxon_id"], x["paper_count"], x["n_increased"], x["n_directions"], x["consensus_direction"]) for x in r] == [(1, 3, 2, 3, "increased")]
    assert research.cross_study_associations(assoc, papers.withColumn("accession_numbers", F.array().cast("array<string>")), "d").count() == 0
    c = research.conflicting_evidence(assoc, papers, "d", 1).first()
    assert (c["increased_count"], c["decreased_count"], c["balance"], len(c["increased_studies"])) == (2, 1, 1, 2)
    assert research.top_associations(assoc.withColumn("direction", F.lit("associated")), "d").first()["consensus_direction"] == "increased"


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_queries_on_empty_tables(spark, empty_tables, name):
    assert registry.QUERIES[name](spark, empty_tables).count() <= 1


@pytest.fixture(scope="session")
def empty_tables(spark, tmp_path_factory):
    import os

    folder = tmp_path_factory.mktemp("empty")
    for f in os.listdir(DATA):
        spark.read.parquet(f"{DATA}/{f}").limit(0).write.parquet(str(folder / f))
    return str(folder)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_queries_match_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import os

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(DATA):
        con.execute(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    got = registry.QUERIES[name](spark, DATA)
    want = con.execute(registry.ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    show = lambda v: repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    order = sorted(names)
    left = sorted(tuple(show(r[c]) for c in order) for r in got.collect())
    right = sorted(tuple(show(r[names.index(c)]) for c in order) for r in want.fetchall())
    assert left == right


def _rest(spark, tmp_path, tables):
    """A folder of the given tables, the others empty."""
    import os

    for f in os.listdir(DATA):
        full = spark.read.parquet(f"{DATA}/{f}")
        rows = tables.get(f[:-8], [])
        spark.createDataFrame([tuple(r.get(c) for c in full.columns) for r in rows], full.schema).write.parquet(str(tmp_path / f))
    return str(tmp_path)


def test_queries_keep_texts_beyond_ascii(spark, tmp_path):
    texts = ["TNF-\u03b1 rose.\tIL-6 fell.", "plain. text", None, "Cafe\u0301 na\u00efve.\u2003Next"]
    folder = _rest(spark, tmp_path, {
        "evidence_items": [{"evidence_id": k, "source_sentence": t} for k, t in enumerate(texts)],
        "sections": [{"section_id": 1, "content": "<b>\u03b2</b>\u00a0x"}],
        "synonyms": [{"synonym_id": 1, "canonical_id": "a", "surface_form": "Cafe\u0301!"}, {"synonym_id": 2, "canonical_id": "b", "surface_form": "caf\u00e9"}],
        "mentions": [{"mention_id": 1, "label": "gene", "paper_id": "p", "text": "CAF\u00c9"}],
    })
    run = lambda name: registry.QUERIES[name](spark, folder).collect()
    assert sorted((r["evidence_id"], r["pos"], r["sentence"]) for r in run("relation_sentences")) == [(0, 0, "TNF-\u03b1 rose"), (0, 1, "IL-6 fell."), (1, 0, "plain"), (1, 1, "text"), (3, 0, "Cafe\u0301 na\u00efve"), (3, 1, "Next")]
    assert run("stripped_tags")[0]["stripped"] == "\u03b2 x"
    assert [r["form"] for r in run("surface_forms")] == ["caf\u00e9"] * 2
    assert [(r["form"], r["n_entities"]) for r in run("synonym_conflicts")] == [("caf\u00e9", 2)]
    assert [(r["form"], r["canonical_id"], r["strategy"]) for r in run("resolution_cascade")] == [("CAF\u00c9", "a", "synonym")]
    assert run("standalone_entities")[0]["n_mentions"] == 1 and [(r["canonical_id"], r["rank"]) for r in sorted(run("ranked_candidates"), key=lambda r: r["rank"])] == [("a", 1), ("b", 2)]


def test_every_mention_has_short_long_and_greek_terms(spark):
    items = spark.createDataFrame([(1, "TNF-\u03b1 and IL-6 in A. bcd; the bile salt hydrolase gene of E. coli"), (2, None), (3, "")], "evidence_id long, source_sentence string")
    terms = spark.createDataFrame([("gene", "TNF-\u03b1"), ("gene", "IL-6"), ("gene", "the bile salt hydrolase gene"), ("taxon", "E. coli"), ("gene", "x"), ("disease", "bcd"), ("gene", "TNF")], "label string, term string")
    got = {(r["evidence_id"], r["label"], r["term"]) for r in extraction.dictionary_mentions(items, "evidence_id", "source_sentence", terms).collect()}
    assert got == {(1, "gene", "tnf-\u03b1"), (1, "gene", "il-6"), (1, "gene", "the bile salt hydrolase gene"), (1, "taxon", "e coli")}


def test_both_ways_of_dictionary_mentions_agree(spark):
    items = spark.createDataFrame([(1, "the bile salt hydrolase gene of E. coli, coli gene"), (2, None), (3, ""), (1, "E. coli")], "k long, s string")
    known = spark.createDataFrame([("gene", "bile salt"), ("gene", "bile salt hydrolase gene"), ("taxon", "e coli"), ("odd", "coli"), ("taxon", "coli")], "label string, term string")
    ways = [sorted(map(tuple, f(items, "k", "s", known).distinct().collect())) for f in (extraction._looked_up, extraction._joined_up)]
    assert ways[0] == ways[1] and len(ways[0]) == 5


def test_resolution_strategies_in_order(spark):
    forms = spark.createDataFrame([(f, "taxon") for f in ("Rosa canina", "ROSA  CANINA!", "RC", "R. canina", "R. alba", "dog rose", "Rosa canima", "Ros canima", "zzz", "R. minor", None)], "form string, entity_type string")
    entities = spark.createDataFrame([("t1", "Rosa canina", "taxon"), ("t2", "Rosa alba", "taxon"), ("t3", "Rumex alba", "taxon"), ("t4", "Rubus minor", "taxon"), ("t5", "Rheum minor", "taxon"), ("t6", "Ruta minor", "taxon")], "canonical_id string, primary_name string, entity_type string")
    synonyms = spark.createDataFrame([("t1", "dog rose"), ("t2", "dog rose"), (None, "zzz")], "canonical_id string, surface_form string")
    short = spark.createDataFrame([("RC", "Rosa canina")], "abbreviated_form string, full_form string")
    said = spark.createDataFrame([("Dog Rose", "taxon", "t9")], "surface_form string, entity_type string, canonical_id string")
    got = {r["form"]: (r["canonical_id"], r["strategy"]) for r in resolution.resolve(forms, entities, synonyms, short).collect()}
    assert got == {
        "Rosa canina": ("t1", "exact"), "ROSA  CANINA!": ("t1", "exact"), "RC": ("t1", "abbreviation"), "R. canina": ("t1", "abbreviation"), "R. alba": ("t2", "abbreviation"), "dog rose": ("t1", "synonym"),
        "Rosa canima": ("t1", "fuzzy"), "Ros canima": ("t1", "fuzzy"), "zzz": (None, "unresolved"), "R. minor": (None, "unresolved"),
    }
    over = resolution.resolve(forms, entities, synonyms, short, overrides=said, hierarchy=spark.createDataFrame([("t1", "g1")], "child string, parent string"))
    assert {r["form"]: (r["canonical_id"], r["strategy"]) for r in over.collect()}["dog rose"] == ("t9", "manual_override")


def test_evidence_signals_by_tier(spark):
    rows = [(1, "We screened 4,000 and 3200 abstracts. We enrolled 120; 45 patients left."), (2, "(n = 30), enrolled 500"), (3, "a cohort of 77"), (4, "forest plot of 90 people"), (5, "90 people gave stool; 16S rRNA and RNA-seq, PRJNA123456"), (6, ""), (7, None), (8, "n=1, n=700000")]
    got = {r["k"]: r for r in extraction.evidence_signals(spark.createDataFrame(rows, "k int, t string"), "k", "t").collect()}
    assert [(got[k]["sample_size"], got[k]["tier"]) for k in range(1, 9)] == [(120, 2), (30, 1), (77, 4), (0, 99), (90, 7), (0, 99), (0, 99), (0, 99)]
    assert got[5]["methods"] == ["16S rRNA sequencing", "RNA-seq"] and got[5]["datasets"] == ["PRJNA123456"] and got[4]["is_meta_analysis"]


def test_availability_order(spark):
    rows = [(1, "No new data were generated. SRP123456"), (2, "See SRR1234567 and srr1234567, PRJEB12345 at https://zenodo.org/record/12"), (3, "at https://osf.io/abcde"), (4, "Data are publicly available"), (5, "upon reasonable request to a.b@uni.example"), (6, "nothing"), (7, "E-MTAB-1234 and GSE12345")]
    got = {r["k"]: r for r in extraction.availability(spark.createDataFrame(rows, "k int, t string"), "k", "t").collect()}
    assert [got[k]["status"] for k in range(1, 8)] == ["not_stated", "accession_linked", "open", "open", "restricted", "not_stated", "accession_linked"]
    assert got[2]["repositories"] == ["SRA", "NCBI BioProject", "Zenodo"] and got[1]["accessions"] == [] and got[7]["repositories"] == ["GEO", "ArrayExpress"]
    assert got[5]["contact"] == "Contact: a.b@uni.example"


def test_study_designs(spark):
    rows = [("a", "A double-blind, placebo-controlled trial", None), ("b", "cohort study", "prospective cohort"), ("c", None, None), ("d", "x", "clinical trial registration only"), ("e", "pilot study of a case report", "")]
    got = {r["paper_id"]: (r["design"], r["confidence"]) for r in extraction.study_design(spark.createDataFrame(rows, "paper_id string, title string, abstract string")).collect()}
    assert got == {"a": ("rct", 0.95), "b": ("cohort", 0.85), "c": (None, None), "d": (None, None), "e": ("case_report", 0.9)}


def test_interventions_and_effects(spark):
    sections = spark.createDataFrame([(1, "p", "methods", 0, "40 participants took inulin and kefir, 10^9 CFU daily for 6 weeks on Illumina; Metm sorting"), (2, "p", "results", 1, "kefir"), (3, "q", "methods", None, None)], "section_id long, paper_id string, section_type string, sec_pos int, content string")
    found = enrichment.interventions(sections)
    got = {r["intervention_type"]: (r["keyword"], r["duration"], r["dosage"], r["sample_size"]) for r in found.collect()}
    assert got == {"probiotic": ("kefir", "6 weeks", "10^9 cfu", 40), "prebiotic": ("inulin", "6 weeks", "10^9 cfu", 40), "fermented_food": ("kefir", "6 weeks", "10^9 cfu", 40)}
    items = spark.createDataFrame([(1, "p", "B. minor increased with inulin (p = 0.01)"), (2, "p", "B. minor increased with inulin (p = 0.2)"), (3, "p", "B. minor rose with inulin"), (4, "p", None)], "evidence_id long, paper_id string, source_sentence string")
    taxa = spark.createDataFrame([(k, "b minor") for k in (1, 2, 3)], "evidence_id long, taxon string")
    rows = enrichment.intervention_effects(items, taxa, found).collect()
    assert [(r["evidence_id"], r["intervention_type"], r["confidence"]) for r in rows] == [(1, "prebiotic", 1.0)]
    mentions = spark.createDataFrame([("p", "method", "Metm Sorting"), ("p", "taxon", "kefir")], "paper_id string, label string, text string")
    used = enrichment.methodology_usage(sections, mentions).collect()
    assert [(r["method"], r["platform"], r["sample_size"]) for r in used] == [("metm sorting", "Illumina", 40)]


def test_name_cache_holds_as_many_names_as_the_reference(spark, tmp_path):
    rows = [{"mention_id": k, "label": "taxon", "text": f"n{k:05d}"} for k in range(10_003)] + [{"mention_id": 20_000, "label": "gene", "text": "TNF-\u03b1"}]
    got = registry.QUERIES["entity_name_cache"](spark, _rest(spark, tmp_path, {"mentions": rows})).collect()
    names = {label: [r["name"] for r in got if r["label"] == label] for label in ("taxon", "gene")}
    assert sorted(names["taxon"]) == [f"n{k:05d}" for k in range(10_000)] and names["gene"] == ["TNF-\u03b1"]


def test_ml_verdicts_score_every_paper(spark):
    papers = spark.read.parquet(f"{DATA}/papers.parquet")
    assert papers.where("abstract is null or citation_count is null").count() > 0
    got = registry.ml_verdicts(spark, DATA)
    assert sorted(r["paper_id"] for r in got.collect()) == sorted(r["paper_id"] for r in papers.select("paper_id").collect())
    assert got.where("verdict is null").count() == 0


def test_entry(spark):
    import __spark_entry__

    start = time.time()
    assert __spark_entry__.entry(spark).count() >= 0 and time.time() - start < 120
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
