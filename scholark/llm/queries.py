"""The ``pN_`` queries: each problem's operator over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chars, language, linking, markup, neardup, packing, sentences, splitting, survivor
from .runtime import cut

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def cleaned_texts(spark: SparkSession, folder: str) -> DataFrame:
    abstracts = markup.clean_column(_read(spark, folder, "papers"), "paper_id", "abstract", "abstract")
    contents = markup.clean_column(_read(spark, folder, "sections"), "section_id", "content", "content")
    return abstracts.unionByName(contents)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return markup.structure_rows(cleaned_texts(spark, folder)).select("field_name", "row_key", "structure")


def p1_clean(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned_texts(spark, folder).select("field_name", "row_key", "clean_text")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    oversized = _read(spark, folder, "sections").select("section_id", "content").where(F.length("content") > splitting.LIMIT)
    pieces = splitting.split_column(oversized, "section_id", "content", with_text=False)
    return pieces.groupBy("section_id").agg(F.max((F.col("cut_kind") == "hard").cast("int")).alias("hard_cut"))


def p2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split_column(_read(spark, folder, "sections"), "section_id", "content", ("section_type",))


def _titled(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "papers").select("paper_id", "title", "abstract").where(F.trim("abstract") != "")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = neardup.near_duplicate_pairs(_titled(spark, folder), "paper_id", "title", "abstract", run=3, least=0.5)
    return pairs.select(F.col("id_a").alias("paper_id_a"), F.col("id_b").alias("paper_id_b"))


def p3_groups(spark: SparkSession, folder: str) -> DataFrame:
    groups = neardup.near_duplicate_groups(_titled(spark, folder), "paper_id", "title", "abstract", run=3, least=0.5)
    return groups.withColumnsRenamed({"id": "paper_id"})


def normalised_values(spark: SparkSession, folder: str) -> DataFrame:
    titles = chars.normalise_column(_read(spark, folder, "papers"), "paper_id", "title", "title")
    mentions = chars.normalise_column(_read(spark, folder, "mentions"), "mention_id", "text", "mention")
    forms = chars.normalise_column(_read(spark, folder, "synonyms"), "synonym_id", "surface_form_normalized", "synonym")
    return titles.unionByName(mentions).unionByName(forms)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return normalised_values(spark, folder).where("differences > 0").select("field_name", "row_key")


def p4_normalised(spark: SparkSession, folder: str) -> DataFrame:
    return normalised_values(spark, folder).select("field_name", "row_key", "normalised")


def _sentences(spark: SparkSession, folder: str, with_text: bool, types: tuple[str, ...] = ()) -> DataFrame:
    sections = _read(spark, folder, "sections")
    if types:
        sections = sections.where(F.col("section_type").isin(*types))
    contents = sentences.sentence_rows(sections, "section_id", "content", "content", with_text)
    items = sentences.sentence_rows(_read(spark, folder, "evidence_items"), "evidence_id", "source_sentence", "source_sentence", with_text)
    return contents.unionByName(items)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _sentences(spark, folder, False, ("discussion", "conclusion", "limitations")).select("field_name", "row_key", "start_char")


def p5_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return _sentences(spark, folder, True).select("field_name", "row_key", "sent_pos", "start_char", "sentence")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    members, _, _ = survivor.best_representatives(_read(spark, folder, "papers"), fields=False)
    return members.select("paper_id", "best_paper_id")


def p6_survivors(spark: SparkSession, folder: str) -> DataFrame:
    return survivor.best_representatives(_read(spark, folder, "papers"))[1]


def linked_values(spark: SparkSession, folder: str) -> DataFrame:
    """(field_name, row_key, kind, value, ref_id, similarity) of every value that is no exact entry."""
    entities = _read(spark, folder, "canonical_entities").select("canonical_id", "primary_name", "entity_type")
    short = _read(spark, folder, "abbreviations").select("abbreviated_form", "full_form")
    journals = _read(spark, folder, "journals").select("journal_id", "journal_name")
    # the three reference lists are of fixed size
    refs = linking.references([tuple(r) for r in entities.collect()], [tuple(r) for r in short.collect()], [tuple(r) for r in journals.collect()])
    exact = entities.select(F.col("entity_type").alias("kind"), F.col("primary_name").alias("value"))
    exact = exact.unionByName(exact.withColumn("kind", F.lit("any"))).unionByName(journals.select(F.lit("journal").alias("kind"), F.col("journal_name").alias("value")))
    mentions = _read(spark, folder, "mentions").where(F.col("label").isin("taxon", "disease", "method"))
    mentions = mentions.select(F.lit("mention").alias("field_name"), F.col("mention_id").alias("row_key"), F.col("label").alias("kind"), F.col("text").alias("value"))
    forms = _read(spark, folder, "synonyms").where("provenance = 'paper_text'")
    forms = forms.select(F.lit("synonym").alias("field_name"), F.col("synonym_id").alias("row_key"), F.lit("any").alias("kind"), F.col("surface_form").alias("value"))
    names = _read(spark, folder, "journal_info").select(F.lit("journal").alias("field_name"), F.col("info_id").alias("row_key"), F.lit("journal").alias("kind"), F.col("journal_name").alias("value"))
    values = mentions.unionByName(forms).unionByName(names).where(F.col("value").rlike(r"(?U)\S")).join(F.broadcast(exact.distinct()), ["kind", "value"], "left_anti")
    links = cut(linking.link_values(values, refs))
    return values.join(links, ["kind", "value"])


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return linked_values(spark, folder).select("field_name", "row_key", "ref_id")


def p7_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    missed = linked_values(spark, folder).where("ref_id = 'none'")
    return missed.groupBy("kind", "value").agg(F.count("*").alias("n_rows"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(_read(spark, folder, "documents"))


def p9_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_read(spark, folder, "documents"))


def detected(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    return language.detect(docs, language.train(docs))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return language.relabelled(detected(spark, folder)).select("doc_id", "start_char", "true_lang")


def p10_stretches(spark: SparkSession, folder: str) -> DataFrame:
    return detected(spark, folder).select("doc_id", "start_char", "end_char", "true_lang", "confidence")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        p1_found, p1_clean, p2_found, p2_pieces, p3_found, p3_groups, p4_found, p4_normalised, p5_found, p5_sentences, p6_found, p6_survivors,
        p7_found, p7_unmatched, p8_ids, p9_pack, p10_found, p10_stretches,
    )
}
