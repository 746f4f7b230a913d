"""Writing manifests, blobs, N-Quads, clones and catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkcat.functions.semver import version_key
from linkcat.operators.media import new_blobs


def write_manifest_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Assembled documents as text, lines in document order, split over files by range.

    Ranges cut inside a document too, so no document is bound to one task.
    """
    ordered = lines.withColumn("namespace", F.split_part("doc_id", F.lit("/"), F.lit(1)))
    (
        ordered.repartitionByRange("namespace", "doc_id", "pos", "sub")
        .sortWithinPartitions("namespace", "doc_id", "pos", "sub")
        .select("namespace", F.col("line").alias("value"))
        .write.mode(mode).partitionBy("namespace").text(path)
    )


def write_manifests(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Stored documents as JSON text, one per line, partitioned by namespace."""
    (
        docs.select(
            F.split_part("doc_id", F.lit("/"), F.lit(1)).alias("namespace"), "doc_id", F.to_json("body").alias("value"))
        .repartitionByRange("namespace", "doc_id").sortWithinPartitions("namespace", "doc_id")
        .select("namespace", "value").write.mode(mode).partitionBy("namespace").text(path)
    )


def write_blobs(blobs: DataFrame, path: str, stored: DataFrame | None = None) -> None:
    """Append the blobs the store lacks, one per address."""
    if stored is None:
        stored = blobs.select("sha1_hex").limit(0)
    new_blobs(blobs, stored).select("sha1_hex", "size", "content").write.mode("append").parquet(path)


def write_nquads(quads: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """N-Quads lines as text, in canonical order."""
    (
        quads.repartitionByRange("line").sortWithinPartitions("line")
        .select(F.col("line").alias("value")).write.mode(mode).text(path)
    )


def write_clone(contents: DataFrame, path: str, force: bool = False) -> None:
    """Files of a clone, keyed by target path; an existing clone is only replaced by ``force``."""
    contents.write.mode("overwrite" if force else "errorifexists").parquet(path)


def write_catalog(docs: DataFrame, path: str, mode: str = "append") -> None:
    """Append documents with sortable versions, ranged and sorted by document and version.

    Scans for a document or a range of versions then skip most files by their statistics, and
    a document with very many versions is spread over files.
    """
    (
        docs.withColumn("namespace", F.split_part("doc_id", F.lit("/"), F.lit(1)))
        .withColumn("version_key", version_key(F.col("version")))
        .repartitionByRange("doc_id", "version_key").sortWithinPartitions("doc_id", "version_key")
        .write.mode(mode).parquet(path)
    )
