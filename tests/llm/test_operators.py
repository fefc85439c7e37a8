"""Operators on Spark: nulls, empty tables, repeated rows, clashing names, skew, and brute force on small tables."""

import itertools
import os
import re

import pytest
from pyspark.sql import functions as F

from scholark.llm import bpe, chars, components, language, linking, markup, neardup, packing, queries, sentences, splitting, survivor

DATA = "/root/testdata/sf0.001"
# names that operators use inside, as extra columns
CLASH = {"id": 1, "k": 2, "value": "v", "row_key": 3, "t": "t", "code": 4, "n": 5, "root": "r", "piece": "p"}


def frame(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    for name, v in CLASH.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(v))
    return df


def test_column_operators_keep_every_row(spark):
    rows = [(1, "<b>x</b> y. Z ran. " * 200), (2, None), (3, ""), (4, " "), (5, "same"), (5, "same")]
    df = frame(spark, rows, "doc_id long, text string")
    assert markup.clean_column(df, "doc_id", "text", "f").count() == 6
    assert chars.normalise_column(df, "doc_id", "text", "f").count() == 6
    assert bpe.encode_documents(df).count() == 6
    assert {r["doc_id"]: r["ids"] for r in bpe.encode_documents(df).where("doc_id in (2, 3)").collect()} == {2: [], 3: []}
    assert sorted(r["row_key"] for r in sentences.sentence_rows(df, "doc_id", "text", "f").where("sent_pos = 0").collect()) == [1, 5, 5]
    got = splitting.split_column(df, "doc_id", "text", ("k",)).groupBy("doc_id").agg(F.max(F.length("piece")).alias("m"), F.count("*").alias("c")).collect()
    assert {r["doc_id"] for r in got} == {1, 3, 4, 5} - {3} and all(r["m"] <= 2500 for r in got)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_on_empty_tables(spark, tmp_path, name):
    for f in os.listdir(DATA):
        spark.read.parquet(f"{DATA}/{f}").limit(0).write.parquet(str(tmp_path / f))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


def brute_pairs(rows, run, least):
    sets = {}
    for i, t, b in rows:
        s = set()
        for field in (t, b):
            w = re.findall(r"\w+", (field or "").casefold())
            s |= set(zip(*[w[k:] for k in range(run)], strict=False))
        if s:
            sets[i] = s
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least}


def _papers():
    import random

    rng = random.Random(11)
    vocab = [f"w{k}" for k in range(400)]
    rows = []
    for d in range(60):
        text = [[rng.choice(vocab) for _ in range(12)] for _ in range(6)]
        rows.append((f"P{d:03d}a", f"title {d}", ". ".join(" ".join(s) for s in text) + "."))
        for v in "bc":
            other = [list(s) for s in text]
            for _ in range(rng.randint(0, 4)):
                other[rng.randrange(6)][rng.randrange(12)] = rng.choice(vocab)
            rng.shuffle(other)
            rows.append((f"P{d:03d}{v}", f"title {d}", ". ".join(" ".join(s) for s in other) + "."))
    rows += [("X1", None, None), ("X2", "one", ""), ("X3", "Title 0", rows[0][2].upper()), *[(f"Y{k:03d}", "hot", rows[3][2]) for k in range(150)]]
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = _papers()
    df = frame(spark, rows, "paper_id string, title string, abstract string")
    found = [(r[0], r[1]) for r in neardup.near_duplicate_pairs(df, "paper_id", "title", "abstract").collect()]
    want = brute_pairs(rows, 3, 0.5)
    # the index may miss a pair right at the threshold, none well above it
    assert len(found) == len(set(found)) and set(found) <= want and set(found) >= brute_pairs(rows, 3, 0.65)
    assert len(found) >= 0.98 * len(want)


def test_near_duplicate_groups(spark):
    rows = _papers()
    df = frame(spark, rows, "paper_id string, title string, abstract string")
    got = neardup.near_duplicate_groups(df, "paper_id", "title", "abstract").collect()
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute_pairs(rows, 5, 0.8):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {r["id"]: r["group_id"] for r in got} == {r[0]: find(r[0]) for r in rows} and len(got) == len(rows)
    assert max(r["copies"] for r in got) == 151


def test_hot_passage_is_split_and_loses_nothing(spark):
    boiler = "this passage stands in very many records and tells nothing about any of them at all"
    rows = []
    for d in range(120):
        own = " ".join(f"q{d}x{k}" for k in range(40))
        rows += [(f"A{d:03d}", None, f"{boiler}. {own}."), (f"B{d:03d}", None, f"{boiler}. {own} more.")]
    df = spark.createDataFrame(rows, "paper_id string, title string, abstract string")
    got = {(r[0], r[1]) for r in neardup.near_duplicate_pairs(df, "paper_id", "title", "abstract").collect()}
    assert got == brute_pairs(rows, 3, 0.5)


def test_hot_nodes_are_cut_into_slices_and_lose_nothing(spark):
    """A family of texts that all share a node: slices of three rows find the pairs that whole nodes find."""
    import numpy as np

    rng = np.random.default_rng(5)
    base = rng.integers(1, 2**63, 80, dtype=np.uint64)
    rows = [(k, neardup._pack(np.unique(np.r_[base[rng.permutation(80)[:70]], rng.integers(1, 2**63, 6, dtype=np.uint64)]))) for k in range(60)]
    df = spark.createDataFrame(rows, "cls long, runs binary").repartition(3)
    whole, cut_up = ({(r["a"], r["b"]) for r in neardup.candidate_pairs(df, hot).collect()} for hot in (4096, 3))
    assert whole == cut_up and len(whole) > 1000


def _edited(rng, sentences, words, edits):
    text = [[f"w{rng.randrange(10**6)}" for _ in range(words)] for _ in range(sentences)]
    other = [list(s) for s in text]
    for s in other:
        for k in rng.sample(range(words), edits):
            s[k] = f"w{rng.randrange(10**6)}"
    return [". ".join(" ".join(s) for s in t) + "." for t in (text, other)]


@pytest.mark.parametrize(("words", "edits"), [(12, 1), (20, 1), (30, 1), (20, 2)])
def test_edits_in_every_sentence_are_found(spark, words, edits):
    """No sentence is left unedited: recall against brute force, which only the index within its radius reaches."""
    import random

    rng = random.Random(words * 10 + edits)
    rows = []
    for d in range(150):
        rows += [(f"{d:03d}{v}", None, t) for v, t in zip("ab", _edited(rng, 6, words, edits), strict=True)]
    df = spark.createDataFrame(rows, "paper_id string, title string, abstract string")
    want = {(a, b) for a, b in ((f"{d:03d}a", f"{d:03d}b") for d in range(150)) if brute_pairs([r for r in rows if r[0] in (a, b)], 3, 0.5)}
    got = {(r[0], r[1]) for r in neardup.near_duplicate_pairs(df, "paper_id", "title", "abstract").collect()}
    assert got <= want and len(got) >= 0.95 * len(want) and len(want) > 90


@pytest.mark.parametrize("n", [2, 5, 12, 31, 32, 50, 63, 64, 100, 300])
def test_recall_for_texts_of_any_length(n):
    """Pairs of similarity 0.6 or more, also of unlike lengths across the bounds of the two kinds of fingerprints."""
    import numpy as np

    rng = np.random.default_rng(n)
    found = total = 0
    for _ in range(200):
        b = rng.integers(0, 2**64 - 1, 2 * n, dtype=np.uint64)
        shared = int(np.ceil(n * rng.uniform(0.75, 1.0)))
        other = rng.integers(0, max(1, int(n / 0.62 - n)) + 1) if shared == n else n - shared
        x, y = neardup._short(b[:n]), neardup._short(np.r_[b[:shared], b[n : n + other]])
        if len(np.intersect1d(x, y)) / len(np.union1d(x, y)) < 0.6 or len(x) == len(y) == shared:
            continue
        total += 1
        keys, owner = neardup.postings([x, y])
        found += any(len(a) for a, _ in neardup.node_pairs(keys, owner))
    assert found >= 0.97 * total


def test_index_finds_what_equal_fingerprints_do_not():
    import numpy as np

    rng = np.random.default_rng(3)
    only = 0
    for _ in range(50):
        x = rng.integers(0, 2**64 - 1, 120, dtype=np.uint64)
        y = np.r_[x[:88], rng.integers(0, 2**64 - 1, 32, dtype=np.uint64)]  # similarity 0.58
        keys, owner = neardup.postings([neardup._short(x), neardup._short(y)])
        found = any(len(a) for a, _ in neardup.node_pairs(keys, owner))
        only += found and not np.isin(keys[owner == 0], keys[owner == 1]).any()
    print(f"only the index finds {only} of 50 pairs")
    assert only > 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (102, 101), (200, 200)] + [(300, 300 + k) for k in range(1, 200)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(61)) and got[102] == 100 and got[499] == 300 and 200 not in got


def _records(spark):
    rows = [
        ("P1", "10.1234/A.b", None, None, "core", "2024-01-01T00:00:00Z", "T", None, None, 2020), ("P2", "https://doi.example/10.1234/a.B", "91", None, " PUBMED ", "2023-01-01 00:00:00", None, "long text", "J", 2020), ("P3", "doi:10.1234/c", "91", "ab12cd34", "pubmed", "2023-01-01T02:00:00+01:00", "T", "", "J", 2021),
        ("P4", "n/a", "0", "ab12cd34", None, None, "T2", None, None, None), ("P5", "n/a", "0", None, "core", None, None, None, None, None), ("P6", None, None, None, None, None, None, None, None, None), ("P7", "-", "", "", "core", "x", "T", None, None, 2020),
    ]
    return frame(spark, rows, "paper_id string, doi string, pmid string, content_hash string, source string, fetched_at string, title string, abstract string, journal string, publication_year int")


def test_survivors(spark):
    members, survivors, weights = survivor.best_representatives(_records(spark))
    # P3 is an hour earlier as UTC shows: 01:00 against 00:00 of P2
    assert {r["paper_id"]: r["best_paper_id"] for r in members.collect()} == dict.fromkeys(["P1", "P2", "P3", "P4"], "P3")
    row = survivors.collect()[0]
    assert (row["best_paper_id"], row["n_records"], row["title"], row["abstract"], row["journal"], row["publication_year"]) == ("P3", 4, "T", "long text", "J", "2020")
    assert len(weights) == 7 and max(weights) == 1.0


def test_survivors_keep_every_field(spark):
    rows = [
        ("P1", "10.1234/a", "core", None, ["Al"], 0, True, "n/a", "2024-01-01"), ("P2", "10.1234/a", "pubmed", "PMC1", [], None, None, None, "2023-01-01"), ("P3", "10.1234/a", "core", None, ["-"], 0, None, "1234-5678", None),
        ("P4", "10.1234/a", "openalex", "PMC2", None, 7, None, " ", None), ("P5", "10.1234/a", "crossref", "PMC2", ["Al"], None, None, None, None), ("P6", "10.1234/a", "europepmc", "PMC2", None, 0, False, None, None),
        ("P7", "10.1234/a", "core", None, None, None, True, None, None), ("P8", "10.1234/b", "core", None, ["lone"], 3, None, None, None),
    ]
    df = frame(spark, rows, "paper_id string, doi string, source string, pmcid string, authors array<string>, citation_count int, is_open_access boolean, issn string, fetched_at string")
    df = df.withColumns({"pmid": F.lit(None).cast("string"), "content_hash": F.lit(None).cast("string")})
    got = survivor.best_representatives(df.withColumns({"title": F.lit("T"), "abstract": F.lit("x"), "journal": F.lit("J"), "publication_year": F.lit(2020)}))[1].collect()
    assert len(got) == 1
    r = got[0]
    assert (r["best_paper_id"], r["n_records"], r["pmcid"], r["authors"], r["citation_count"], r["issn"], r["title"]) == ("P2", 7, "PMC2", ["Al"], 0, "1234-5678", "T")
    assert r["source"] is not None and r["fetched_at"] is not None and r["is_open_access"] in (True, False)


def test_survivors_return_all_columns_of_papers(spark):
    papers = spark.read.parquet(f"{DATA}/papers.parquet")
    got = survivor.best_representatives(papers)[1]
    kept = {c.removesuffix("_key") for c in got.columns}
    assert kept >= set(papers.columns) - {"paper_id"}
    # whatever one record of a group claims is in the survivor
    assert got.where("source is null or fetched_at is null and loaded_at is null").count() == 0 and got.where("authors is not null").count() > 0


def test_reliability_learns_the_bad_source(spark):
    votes = []
    good, bad = [0] * 7, [0] * 7
    good[0], good[1] = 1, 1
    bad[2] = 1
    votes.append(([good, bad], 50))
    weights = survivor.reliabilities(spark.createDataFrame(votes, "pattern array<array<int>>, n long"))
    assert weights[0] > 0.9 and weights[2] < 0.1


def test_packing(spark):
    rows = [(k, (k * 37) % 900) for k in range(400)] + [(1000, 5000), (1001, None), (1002, 0), (1003, 2048)]
    df = frame(spark, rows, "doc_id long, n_tokens long")
    got = packing.pack(df, "doc_id", "n_tokens", 2048).collect()
    fill: dict[int, int] = {}
    total: dict[int, int] = {}
    for r in got:
        fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["n_tokens"]
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
    assert total == {k: n or 0 for k, n in rows}
    assert max(fill.values()) <= 2048 and len(fill) <= sum(n or 0 for _, n in rows) // 2048 + 2
    assert {r["doc_id"] for r in got if r["piece"] > 0} == {1000}


def test_links_of_hot_values(spark):
    refs = linking.references([("t1", "Bezibplasma momrudivorans", "taxon")], [], [("j1", "Annals of Enteric Immunity")])
    values = frame(spark, [("taxon", "B. momrudivorans")] * 500 + [("journal", "unknown paper"), ("any", "Bezibplasma momrudivoran")], "kind string, value string")
    got = {(r["kind"], r["value"]): r["ref_id"] for r in linking.link_values(values, refs).collect()}
    assert got == {("taxon", "B. momrudivorans"): "t1", ("journal", "unknown paper"): "none", ("any", "Bezibplasma momrudivoran"): "t1"}


def test_label_column_agrees(spark):
    labels = ["en-US", " English ", "eng", "unknown", "", None, "pt-BR", "xx", "JA", "zh_CN"]
    df = spark.createDataFrame([(v,) for v in labels], "lang string").select("lang", language.label_column(F.col("lang")).alias("c"))
    assert {r["lang"]: r["c"] for r in df.collect()} == {v: language.label_code(v) for v in labels}


def test_languages_agree_with_scripts_and_labels(spark):
    """Held-out accuracy: stretches against scripts that only one language here uses, single ones against the labels."""
    folder = "/root/testdata/sf0.01"
    got = queries.detected(spark, folder).collect()
    script = {"ja": "[぀-ヿ]", "ko": "[가-힣]", "th": "[฀-๿]", "hi": "[ऀ-ॿ]", "ar": "[؀-ۿ]"}
    docs = {r["doc_id"]: (r["text"], language.label_code(r["lang"])) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    bad, same, labelled = 0, 0, 0
    for r in got:
        text, label = docs[r["doc_id"]]
        part = text[r["start_char"] : r["end_char"]]
        bad += r["true_lang"] in script and not re.search(script[r["true_lang"]], part)
        if r["n_stretches"] == 1 and label:
            labelled += 1
            same += label == r["true_lang"]
        assert 0 <= r["confidence"] <= 1
    assert bad == 0 and same > 0.85 * labelled


def test_ids_match_plain_encoding(spark):
    got = queries.p8_ids(spark, DATA).collect()
    enc = bpe.encoder()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert {r["doc_id"]: r["ids"] for r in got} == {k: enc.encode(v) for k, v in docs.items()}
