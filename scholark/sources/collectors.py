"""Records of the six collecting services, from their stored answers; and a paged source over stored pages.

Each mapping takes one JSON (or XML) text per item and gives the columns of ``COLUMNS``; items without a title are no
records, unreadable ones are counted by ``unreadable``.  Nothing is inferred from the data: the schemas are declared.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text

COLUMNS = (
    "pmid", "pmcid", "doi", "arxiv_id", "title", "abstract", "authors", "keywords", "mesh_terms", "article_types", "journal", "issn", "publication_date", "publication_year", "volume", "issue", "pages", "citation_count", "reference_count",
    "is_open_access", "is_preprint", "full_text_url", "pdf_url",
)
_LISTS = ("authors", "keywords", "mesh_terms", "article_types")
_NUMBERS = ("publication_year", "citation_count", "reference_count")
_FLAGS = ("is_open_access", "is_preprint")
# The services' answers, by their public descriptions.
EUROPEPMC = (
    "pmid string, pmcid string, doi string, title string, abstractText string, authorList struct<author:array<struct<fullName:string,lastName:string,initials:string>>>, "
    "journalInfo struct<journal:struct<title:string,issn:string,essn:string>,volume:string,issue:string,dateOfPublication:string>, pubTypeList struct<pubType:array<string>>, keywordList struct<keyword:array<string>>, "
    "meshHeadingList struct<meshHeading:array<struct<descriptorName:string>>>, isOpenAccess string, citedByCount int"
)
SEMANTIC_SCHOLAR = (
    "externalIds struct<DOI:string,PubMed:string,PubMedCentral:string,ArXiv:string>, title string, abstract string, year int, publicationDate string, authors array<struct<name:string>>, venue string, "
    "journal struct<name:string,volume:string,pages:string>, publicationTypes array<string>, openAccessPdf struct<url:string>, citationCount int, referenceCount int, isOpenAccess boolean"
)
OPENALEX = (
    "doi string, ids struct<pmid:string>, title string, abstract_inverted_index map<string,array<int>>, authorships array<struct<author:struct<display_name:string>>>, publication_date string, publication_year int, "
    "primary_location struct<source:struct<display_name:string,issn_l:string>>, open_access struct<is_oa:boolean,oa_url:string>, cited_by_count int, referenced_works_count int, type string, "
    "concepts array<struct<display_name:string,score:double>>, best_oa_location struct<pdf_url:string>"
)
CROSSREF = (
    "DOI string, title array<string>, abstract string, author array<struct<given:string,family:string,name:string>>, published struct<`date-parts`:array<array<int>>>, `container-title` array<string>, ISSN array<string>, volume string, issue string, page string, "
    "type string, `is-referenced-by-count` int, `references-count` int, license array<struct<URL:string>>, funder array<struct<name:string>>, link array<struct<URL:string,`content-type`:string>>"
)
CORE = (
    "doi string, title string, abstract string, fullText string, authors array<struct<name:string>>, yearPublished int, publishedDate string, journals array<struct<title:string,identifiers:array<string>>>, downloadUrl string, isOpenAccess boolean, "
    "citationCount int, documentType string, sourceFulltextUrls array<string>, links array<struct<type:string,url:string>>"
)
PUBMED = (
    "MedlineCitation struct<PMID:struct<_VALUE:string,_Version:string>,Article:struct<ArticleTitle:string,Abstract:struct<AbstractText:array<struct<_VALUE:string,_Label:string>>>,AuthorList:struct<Author:array<struct<LastName:string,ForeName:string,CollectiveName:string>>>,"
    "Journal:struct<Title:string,ISSN:struct<_VALUE:string,_IssnType:string>,JournalIssue:struct<Volume:string,Issue:string,PubDate:struct<Year:string,Month:string,Day:string>>>,Pagination:struct<MedlinePgn:string>,ELocationID:array<struct<_VALUE:string,_EIdType:string>>,"
    "PublicationTypeList:struct<PublicationType:array<struct<_VALUE:string,_UI:string>>>>,MeshHeadingList:struct<MeshHeading:array<struct<DescriptorName:struct<_VALUE:string,_UI:string>>>>,KeywordList:struct<Keyword:array<struct<_VALUE:string,_MajorTopicYN:string>>>>, "
    "PubmedData struct<ArticleIdList:struct<ArticleId:array<struct<_VALUE:string,_IdType:string>>>>"
)
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _text(col: Column) -> Column:
    """The trimmed text, null if nothing is left."""
    return F.nullif(F.trim(col), F.lit(""))


def _known(col: Column) -> Column:
    return F.filter(col, lambda x: x.isNotNull() & (F.trim(x) != ""))


def _at(col: Column, n: int) -> Column:
    return F.try_element_at(col, F.lit(n))


def _first(col: Column) -> Column:
    return _at(col, 1)


def _records(rows: DataFrame, fields: dict[str, Column], source: str) -> DataFrame:
    out = []
    for name in COLUMNS:
        kind = "array<string>" if name in _LISTS else "int" if name in _NUMBERS else "boolean" if name in _FLAGS else "string"
        col = fields[name].cast(kind) if name in fields else F.lit(None).cast(kind)
        if name in _LISTS:
            col = F.coalesce(_known(col), F.array().cast("array<string>"))
        if name in _FLAGS:
            col = F.coalesce(col, F.lit(False))
        out.append(col.alias(name))
    got = rows.select(*out).where(F.col("title").isNotNull())
    return got.withColumn("source", F.lit(source)).withColumn("content_hash", text.content_hash(F.col("title"), F.col("abstract"), F.col("authors")))


def _read(items: DataFrame, column: str, schema: str) -> DataFrame:
    return items.select(F.from_json(F.col(column), schema).alias("r")).where("r is not null").select("r.*")


def from_europepmc(items: DataFrame, column: str = "item") -> DataFrame:
    r = _read(items, column, EUROPEPMC)
    year = F.nullif(F.regexp_extract(F.trim("journalInfo.dateOfPublication"), r"^(\d+)(\s|$)", 1), F.lit(""))
    name = lambda a: F.coalesce(_text(a["fullName"]), _text(F.concat_ws(" ", a["lastName"], a["initials"])))
    return _records(r, {
        "pmid": F.col("pmid"), "pmcid": F.col("pmcid"), "doi": F.col("doi"), "title": _text(F.col("title")), "abstract": F.col("abstractText"), "authors": F.transform("authorList.author", name), "keywords": F.col("keywordList.keyword"),
        "mesh_terms": F.transform("meshHeadingList.meshHeading", lambda m: m["descriptorName"]), "article_types": F.col("pubTypeList.pubType"), "journal": F.col("journalInfo.journal.title"), "issn": F.coalesce("journalInfo.journal.issn", "journalInfo.journal.essn"),
        "publication_date": year, "publication_year": year, "volume": F.col("journalInfo.volume"), "issue": F.col("journalInfo.issue"), "citation_count": F.col("citedByCount"), "is_open_access": F.col("isOpenAccess") == "Y",
        "full_text_url": F.when(F.col("pmcid").isNotNull(), F.concat(F.lit("https://europepmc.org/article/MED/"), F.coalesce("pmid", "pmcid"))),
    }, "europepmc")


def from_semantic_scholar(items: DataFrame, column: str = "item") -> DataFrame:
    r = _read(items, column, SEMANTIC_SCHOLAR)
    return _records(r, {
        "pmid": F.col("externalIds.PubMed"), "pmcid": F.col("externalIds.PubMedCentral"), "doi": F.col("externalIds.DOI"), "arxiv_id": F.col("externalIds.ArXiv"), "title": _text(F.col("title")), "abstract": F.col("abstract"), "authors": F.transform("authors", lambda a: a["name"]),
        "journal": F.coalesce(_text(F.col("journal.name")), F.col("venue")), "publication_date": F.col("publicationDate"), "publication_year": F.col("year"), "volume": F.col("journal.volume"), "pages": F.col("journal.pages"), "article_types": F.col("publicationTypes"),
        "is_open_access": F.col("isOpenAccess"), "pdf_url": F.col("openAccessPdf.url"), "citation_count": F.col("citationCount"), "reference_count": F.col("referenceCount"), "is_preprint": F.col("externalIds.ArXiv").isNotNull(),
    }, "semantic_scholar")


def from_openalex(items: DataFrame, column: str = "item") -> DataFrame:
    r = _read(items, column, OPENALEX)
    doi = F.regexp_extract(F.replace(F.col("doi"), F.lit("https://doi.org/"), F.lit("")), r"""^([^"'>< ]*)""", 1)
    return _records(r, {
        "doi": _text(doi), "pmid": _text(F.replace(F.col("ids.pmid"), F.lit("https://pubmed.ncbi.nlm.nih.gov/"), F.lit(""))), "title": _text(F.col("title")), "abstract": F.when(F.size("abstract_inverted_index") > 0, text.reconstruct(F.col("abstract_inverted_index"))),
        "authors": F.transform("authorships", lambda a: a["author"]["display_name"]), "keywords": F.transform(F.filter("concepts", lambda c: c["score"] >= 0.3), lambda c: c["display_name"]), "journal": F.col("primary_location.source.display_name"), "issn": F.col("primary_location.source.issn_l"),
        "publication_date": F.col("publication_date"), "publication_year": F.col("publication_year"), "article_types": F.array(F.coalesce("type", F.lit("article"))), "is_open_access": F.col("open_access.is_oa"), "full_text_url": F.col("open_access.oa_url"), "pdf_url": F.col("best_oa_location.pdf_url"),
        "citation_count": F.col("cited_by_count"), "reference_count": F.col("referenced_works_count"),
    }, "openalex")


def from_crossref(items: DataFrame, column: str = "item") -> DataFrame:
    r = _read(items, column, CROSSREF)
    parts = _first(F.col("published.date-parts"))
    two = lambda n: F.lpad(F.coalesce(_at(parts, n).cast("string"), F.lit("1")), 2, "0")
    date = F.when(_first(parts).isNotNull(), F.concat(_first(parts).cast("string"), F.lit("-"), two(2), F.lit("-"), two(3)))
    name = lambda a: F.when(_text(a["family"]).isNotNull(), F.concat_ws(", ", F.trim(a["family"]), _text(a["given"]))).otherwise(_text(a["name"]))
    return _records(r, {
        "doi": _text(F.col("DOI")), "title": _text(_first(F.col("title"))), "abstract": _text(text.strip_tags(F.col("abstract"))), "authors": F.transform("author", name), "keywords": F.transform("funder", lambda f: f["name"]), "journal": _first(F.col("container-title")), "issn": _first(F.col("ISSN")),
        "publication_date": date, "publication_year": _first(parts), "volume": _text(F.col("volume")), "issue": _text(F.col("issue")), "pages": _text(F.col("page")), "article_types": F.array(F.coalesce("type", F.lit("journal-article"))),
        "is_open_access": F.exists("license", lambda x: F.lower(F.coalesce(x["URL"], F.lit(""))).contains("creativecommons")), "pdf_url": _first(F.filter("link", lambda x: F.lower(F.coalesce(x["content-type"], F.lit(""))).contains("pdf")))["URL"],
        "citation_count": F.col("is-referenced-by-count"), "reference_count": F.col("references-count"),
    }, "crossref")


def from_core(items: DataFrame, column: str = "item") -> DataFrame:
    """Where a record has no abstract, the beginning of its full text stands for it."""
    r = _read(items, column, CORE)
    issn = _first(F.filter(_first(F.col("journals"))["identifiers"], lambda x: x.startswith("issn:")))
    link = F.coalesce("downloadUrl", _first(F.filter("links", lambda x: x["type"] == "download"))["url"])
    return _records(r, {
        "doi": _text(F.col("doi")), "title": _text(F.col("title")), "abstract": F.coalesce(_text(F.col("abstract")), _text(F.substring("fullText", 1, 2000))), "authors": F.transform("authors", lambda a: a["name"]), "journal": _first(F.col("journals"))["title"],
        "issn": F.replace(issn, F.lit("issn:"), F.lit("")), "publication_date": F.coalesce(F.substring("publishedDate", 1, 10), F.col("yearPublished").cast("string")), "publication_year": F.col("yearPublished"), "article_types": F.array(F.coalesce(_text(F.col("documentType")), F.lit("research"))),
        "is_open_access": F.coalesce("isOpenAccess", F.lit(True)), "full_text_url": F.coalesce(link, _first(F.col("sourceFulltextUrls"))), "pdf_url": link, "citation_count": F.col("citationCount"),
    }, "core")


def from_pubmed(items: DataFrame, column: str = "item") -> DataFrame:
    """One XML text of an article per row."""
    r = items.select(F.from_xml(F.col(column), PUBMED).alias("r")).where("r is not null").select("r.*")
    a = "MedlineCitation.Article."
    other = lambda kind: _first(F.filter("PubmedData.ArticleIdList.ArticleId", lambda x: x["_IdType"] == kind))["_VALUE"]
    part = lambda x: F.when(_text(x["_Label"]).isNotNull(), F.concat(x["_Label"], F.lit(": "), x["_VALUE"])).otherwise(x["_VALUE"])
    name = lambda x: F.coalesce(_text(x["CollectiveName"]), F.when(_text(x["LastName"]).isNotNull(), F.concat_ws(", ", x["LastName"], _text(x["ForeName"]))))
    date = a + "Journal.JournalIssue.PubDate."
    month = F.coalesce(*[F.when(F.col(date + "Month") == m, f"{k:02d}") for k, m in enumerate(MONTHS, 1)], F.lpad(date + "Month", 2, "0"), F.lit("01"))
    values = lambda path, *inner: F.transform(path, lambda x: _inner(x, inner))
    pmc = other("pmc")
    return _records(r, {
        "pmid": F.col("MedlineCitation.PMID._VALUE"), "pmcid": pmc, "doi": F.coalesce(_first(F.filter(a + "ELocationID", lambda x: x["_EIdType"] == "doi"))["_VALUE"], other("doi")), "title": _text(F.col(a + "ArticleTitle")),
        "abstract": F.when(F.size(a + "Abstract.AbstractText") > 0, F.array_join(F.transform(a + "Abstract.AbstractText", part), "\n")), "authors": F.transform(a + "AuthorList.Author", name), "keywords": values("MedlineCitation.KeywordList.Keyword", "_VALUE"), "mesh_terms": values("MedlineCitation.MeshHeadingList.MeshHeading", "DescriptorName", "_VALUE"),
        "article_types": values(a + "PublicationTypeList.PublicationType", "_VALUE"), "journal": F.col(a + "Journal.Title"), "issn": F.col(a + "Journal.ISSN._VALUE"), "publication_year": F.col(date + "Year").try_cast("int"),
        "publication_date": F.when(F.col(date + "Year").isNotNull(), F.concat_ws("-", date + "Year", month, F.lpad(F.coalesce(date + "Day", F.lit("1")), 2, "0"))), "volume": F.col(a + "Journal.JournalIssue.Volume"), "issue": F.col(a + "Journal.JournalIssue.Issue"), "pages": F.col(a + "Pagination.MedlinePgn"),
        "is_open_access": pmc.isNotNull(), "full_text_url": F.when(pmc.isNotNull(), F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/"), pmc, F.lit("/"))),
    }, "pubmed")


def _inner(x: Column, names: tuple[str, ...]) -> Column:
    for n in names:
        x = x[n]
    return x


SERVICES = {"pubmed": from_pubmed, "europepmc": from_europepmc, "semantic_scholar": from_semantic_scholar, "openalex": from_openalex, "crossref": from_crossref, "core": from_core}


def unreadable(items: DataFrame, schema: str, column: str = "item") -> DataFrame:
    """Items that are no JSON object: what a collecting run has to report."""
    return items.where(F.col(column).isNotNull() & (F.from_json(F.col(column), schema).isNull() | ~F.trim(column).startswith("{")))


class _Page(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _PageReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.most = options["path"], int(options.get("maxPages", 2**31))
        self.first = int(options.get("startPage", 0))

    def partitions(self) -> list[InputPartition]:
        """One partition a page, from the resume point on."""
        pages = sorted(f for f in os.listdir(self.folder) if f.endswith(".json"))
        return [_Page(os.path.join(self.folder, f)) for f in pages[self.first : self.first + self.most]]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        page = os.path.basename(partition.path)
        try:
            with open(partition.path, encoding="utf-8") as f:
                found = _items(json.load(f))
        except (OSError, ValueError) as e:  # a page that can't be read is reported, and the others go on
            yield page, -1, None, str(e)[:200]
            return
        for n, item in enumerate(found):
            yield page, n, json.dumps(item, ensure_ascii=False), None


def _items(answer: object) -> list:
    """Items of a page, under whichever of the usual names the service uses."""
    if isinstance(answer, list):
        return answer
    for key in ("records", "resultList", "results", "hits", "items", "data"):
        found = answer.get(key) if isinstance(answer, dict) else None
        if isinstance(found, dict):
            found = next((found[k] for k in ("result", "items", "records") if isinstance(found.get(k), list)), None)
        if isinstance(found, list):
            return found
    return []


class PagedSource(DataSource):
    """``spark.read.format("scholark_pages").load(folder)``: items of stored pages, a page a partition.

    Options: ``startPage`` (resume point) and ``maxPages``.  The folder must be one that all executors share.
    """

    @classmethod
    def name(cls) -> str:
        return "scholark_pages"

    def schema(self) -> str:
        return "page string, n int, item string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self.options)
