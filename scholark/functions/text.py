"""Column functions over text: sentence splitting, statistics in sentences, directions, keys and hashes."""

from __future__ import annotations

import string
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import lexicon

ASCII = r"^[\x00-\x7F]*$"
_PUNCTUATION = str.maketrans("", "", string.punctuation)

SPLIT_DROPPING = r"(?U)[.!?]+\s+"
SPLIT_KEEPING = r"(?U)(?<=[.?!])\s+"

DIRECTIONS = lexicon.pairs(lexicon.DIRECTIONS)
MEASURES = lexicon.pairs(lexicon.MEASURES)
SECTION_TYPES = ("abstract", "introduction", "methods", "results", "discussion", "conclusion", "limitations", "supplementary", "data_availability")


def first_match(col: Column, table: tuple[tuple[str, str], ...]) -> Column:
    """Name of the first pattern that is found; null if none is."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(table):
        out = F.when(col.rlike(pattern), name).otherwise(out)
    return out


def direction(col: Column) -> Column:
    return first_match(col, DIRECTIONS)


def extract_number(col: Column, pattern: str) -> Column:
    """First captured number as a double; null where the pattern isn't found."""
    return F.nullif(F.regexp_extract(col, pattern, 1), F.lit("")).try_cast("double")


def p_value(col: Column) -> Column:
    """The exact form first, then the bounded one; only values from 0 to 1 count."""
    forms = (extract_number(col, "(?i)" + p) for p in lexicon.P_FORMS)
    return F.coalesce(*[F.when(v.between(0.0, 1.0), v) for v in forms])


def effect_size(col: Column) -> Column:
    return F.coalesce(*[extract_number(col, "(?i)" + p) for p in lexicon.EFFECTS])


def comparison(col: Column) -> Column:
    """``vs healthy``, ``pre vs post`` or, also without any comparison, ``vs control``."""
    low = F.lower(col)
    healthy = low.contains("healthy") | low.contains("control")
    return F.when(col.rlike("(?i)" + lexicon.COMPARED) & healthy, "vs healthy").when(col.rlike("(?i)" + lexicon.COMPARED) & low.contains("pre") & low.contains("post"), "pre vs post").otherwise("vs control")


def significant(col: Column) -> Column:
    return col.rlike("(?i)" + lexicon.SIGNIFICANT)


def sample_size(col: Column) -> Column:
    """Size of the sample that a methods text states, by the first form that is found."""
    return F.coalesce(*[extract_number(col, "(?i)" + p) for p in lexicon.SAMPLE_FORMS]).cast("bigint")


def duration(col: Column) -> Column:
    n = F.regexp_extract(col, "(?i)" + lexicon.DURATION, 1)
    return F.when(n != "", F.concat(n, F.lit(" "), F.lower(F.regexp_extract(col, "(?i)" + lexicon.DURATION, 2)), F.lit("s")))


def dosage(col: Column) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(F.lower(col), p, 1), F.lit("")) for p in lexicon.DOSAGES])


def sentences_dropping(col: Column) -> Column:
    """Sentences without their closing marks, as the relation extractor cuts them; blanks dropped."""
    return _pieces(col, SPLIT_DROPPING)


def sentences_keeping(col: Column) -> Column:
    """Sentences with their closing marks, as the triple promoter cuts them."""
    return _pieces(col, SPLIT_KEEPING)


def _pieces(col: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(col, pattern), lambda s: F.regexp_replace(s, r"(?U)^\s+|\s+$", "")), lambda s: s != "")


def context(sentences: Column, at: Column, width: int) -> Column:
    """The sentences within ``width`` of the 0-based place ``at``, joined by blanks."""
    start = F.greatest(at - width, F.lit(0))
    return F.array_join(F.slice(sentences, start + 1, at + width - start + 1), " ")


def char_offset(text: Column, sentence: Column) -> Column:
    """0-based offset of the sentence in the text; null if it isn't there."""
    return F.nullif(F.call_function("locate", sentence, text) - 1, F.lit(-1))


def section_type(col: Column) -> Column:
    v = F.lower(F.trim(col))
    return F.when(v.isin(*SECTION_TYPES), v).otherwise("other")


@F.arrow_udf(StringType())
def _composed_form(values: pa.Array) -> pa.Array:
    tidy = lambda x: " ".join(unicodedata.normalize("NFC", x).lower().translate(_PUNCTUATION).split())
    return pa.array([None if x is None else tidy(x) for x in values.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def _composed(values: pa.Array) -> pa.Array:
    return pa.array([None if x is None else unicodedata.normalize("NFC", x) for x in values.to_pylist()], pa.string())


def composed(col: Column) -> Column:
    """The text in NFC; only texts beyond ASCII go through Python."""
    return F.when(col.rlike(ASCII), col).otherwise(_composed(F.when(~col.rlike(ASCII), col)))


def surface_form(col: Column) -> Column:
    """NFC, lower case, without ASCII punctuation, blanks collapsed; only texts beyond ASCII go through Python."""
    return F.when(col.rlike(ASCII), _ascii_form(col)).otherwise(_composed_form(F.when(~col.rlike(ASCII), col)))


def _ascii_form(col: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(col), r"[!-/:-@\[-`{-~]", ""), r"[\s\x1c-\x1f]+", " "))


def strip_tags(col: Column) -> Column:
    """Tags to blanks, blanks collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(col, r"<[^>]+>", " "), r"(?U)\s+", " "))


def relation_name(col: Column) -> Column:
    """Upper snake case; names that don't begin with a letter get a prefix."""
    v = F.regexp_replace(F.upper(F.trim(col)), "[^A-Z0-9_]", "_")
    return F.when(v.rlike("^[A-Z]"), v).otherwise(F.concat(F.lit("REL_"), v))


def graph_label(col: Column) -> Column:
    """Words capitalised and joined."""
    words = F.filter(F.split(col, r"[\s_-]+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(w.substr(F.lit(2), F.length(w))))), "")


def chunks(words: Column, size: int = 400, overlap: int = 50) -> Column:
    """Windows of ``size`` words; a window starts only where more than ``overlap`` words are left."""
    n = F.size(words)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), n - overlap - 1), F.lit(size - overlap))
    return F.transform(starts, lambda i: F.slice(words, i + 1, F.lit(size)))


def reconstruct(inverted: Column) -> Column:
    """Text from a map word -> positions."""
    pairs = F.flatten(F.transform(F.map_entries(inverted), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.array_join(F.transform(F.array_sort(pairs), lambda x: x["w"]), " ")


def dedup_key(doi: Column, pmid: Column, title: Column) -> Column:
    """First available identifier: doi, then pmid, then the title's first 80 characters; blanks are missing."""
    d, p, t = (F.nullif(F.trim(c), F.lit("")) for c in (doi, pmid, title))
    return F.coalesce(F.concat(F.lit("doi:"), F.lower(d)), F.concat(F.lit("pmid:"), p), F.concat(F.lit("title:"), F.substring(F.lower(t), 1, 80)))


def change_hash(title: Column, abstract: Column, mesh: Column) -> Column:
    """MD5 of title, abstract and subject headings; tells whether a stored record has changed."""
    return F.md5(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit("")), F.coalesce(F.array_join(mesh, "|"), F.lit(""))))


def content_hash(title: Column, abstract: Column, authors: Column) -> Column:
    """MD5 of title, abstract and authors joined by bars; a missing abstract is written as None."""
    return F.md5(F.concat_ws("|", F.coalesce(title, F.lit("None")), F.coalesce(abstract, F.lit("None")), F.array_join(F.coalesce(authors, F.array().cast("array<string>")), "|")))
