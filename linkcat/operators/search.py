"""Keyword search over the names, descriptions and keywords of documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcat.functions.text import tokens
from linkcat.operators.nodes import as_array, node_type, text_at

FIELDS = ("keywords", "name", "description")
RESULT = ("doc_id", "type", "name", "version", "description")


def normalize_terms(keywords: Sequence[str]) -> list[str]:
    """Trimmed lower-case distinct keywords, in order."""
    return list(dict.fromkeys(k.strip().lower() for k in keywords if k.strip()))


def _strings(value: Column) -> Column:
    """One string, or the strings of an array joined by spaces."""
    listed = F.filter(F.transform(as_array(value), lambda v: v.try_cast("string")), lambda s: s.isNotNull())
    return F.coalesce(F.when(listed.isNotNull(), F.array_join(listed, " ")), value.try_cast("string"))


def searchable(catalog: DataFrame) -> DataFrame:
    """Documents of a catalog with the fields that are searched and shown, read from their bodies."""
    field = lambda name: _strings(F.try_variant_get("body", f"$.{name}", "variant")).alias(name)
    return catalog.select("doc_id", "version", node_type(F.col("body")).alias("type"), *[field(f) for f in FIELDS])


def document_terms(docs: DataFrame) -> DataFrame:
    """Documents with ``terms``: the distinct words of their searchable fields."""
    return docs.withColumn("terms", tokens(F.concat_ws(" ", *FIELDS)))


def search(docs: DataFrame, keywords: Sequence[str], mode: str = "any") -> DataFrame:
    """Documents that contain any (or all) of the keywords: one scan, nothing shuffled."""
    wanted = F.array(*[F.lit(t) for t in normalize_terms(keywords)])
    found = F.size(F.array_intersect("terms", wanted))
    enough = found > 0 if mode == "any" else found == F.size(wanted)
    return document_terms(docs).filter(enough).select(*RESULT, found.alias("n_terms"))


def index_terms(docs: DataFrame) -> DataFrame:
    """Inverted index ``(term, doc_id, version, ...)``; words are already distinct per document.

    What a result shows travels with every posting, so an answer needs the index alone.
    """
    shown = [c for c in ("type", "name", "description") if c in docs.columns]
    return document_terms(docs).select(F.explode("terms").alias("term"), "doc_id", "version", *shown)


def write_index(index: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store an index ranged and sorted by term, so that a search reads few files and row groups.

    Ranges cut inside a term too: the postings of a frequent term are spread over files.
    """
    ordered = index.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id")
    ordered.write.mode(mode).parquet(path)


def search_index(index: DataFrame, keywords: Sequence[str], mode: str = "any") -> DataFrame:
    """Documents that contain any (or all) of the keywords, from the index alone."""
    terms = normalize_terms(keywords)
    shown = [c for c in ("type", "name", "description") if c in index.columns]
    hits = index.filter(F.col("term").isin(terms)).groupBy("doc_id", "version").agg(
        F.count_distinct("term").alias("n_terms"), *[F.any_value(c).alias(c) for c in shown])
    return hits if mode == "any" else hits.filter(F.col("n_terms") == len(terms))


def search_count(found: DataFrame) -> DataFrame:
    """Number of results."""
    return found.agg(F.count("*").alias("n_results"))
