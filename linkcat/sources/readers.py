"""Reading files, manifests, URL responses and catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcat.operators.media import MAX_FILE_BYTES, split_by_size
from linkcat.operators.paths import MANIFEST_NAME

RESPONSES = "url string, status int, headers map<string,string>"


def _below(root: str) -> Column:
    """Path below the root of a listing, whatever scheme the file system reports."""
    bare = root.split("://")[-1].split(":", 1)[-1].rstrip("/")
    start = F.locate(bare + "/", F.col("path"))
    below = F.substring("path", start + F.lit(len(bare) + 1), F.length("path"))
    return F.when(start > 0, below).otherwise(
        F.raise_error(F.concat(F.lit(f"no path below {bare}: "), "path")).cast("string"))


def scan_files(spark: SparkSession, root: str) -> DataFrame:
    """Listing of every file below ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .select(_below(root).alias("path"), "length", F.col("modificationTime").alias("mtime"))
    )


def scan_blobs(spark: SparkSession, root: str, limit: int = MAX_FILE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Files below ``root`` with their bytes, and those too large for one row as rejects with a reason."""
    fits = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .filter(F.col("length") <= limit)
        .select(_below(root).alias("path"), "length", F.col("modificationTime").alias("mtime"), "content")
    )
    return fits, split_by_size(scan_files(spark, root), limit)[1]


def parse_manifests(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents of manifest texts (``path, value``), and rejects whose text is no JSON."""
    parsed = texts.withColumn("body", F.try_parse_json("value"))
    rejects = parsed.filter("body is null").select("path", F.lit("malformed JSON").alias("reason"))
    return parsed.filter("body is not null").drop("value"), rejects


def scan_manifests(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Manifests below ``root`` as documents, and rejects whose text is malformed."""
    texts = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", MANIFEST_NAME).text(root, wholetext=True)
        .withColumn("path", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))
    )
    return parse_manifests(texts.select(_below(root).alias("path"), "value"))


def scan_manifest_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Documents that ``write_manifests`` stored, one JSON text a line, and rejects whose text is malformed."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    return parse_manifests(lines)


def scan_url_responses(spark: SparkSession, path: str) -> DataFrame:
    """Recorded responses ``(url, status, headers)`` as JSON lines."""
    return spark.read.schema(RESPONSES).json(path)


def scan_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A stored catalog."""
    return spark.read.parquet(path)
