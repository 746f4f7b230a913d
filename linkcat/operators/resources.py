"""Describing files and URLs as resources.

A resource row has its id, class and property family, and the media fields the family's
JSON layout is made from. Parts of a directory are a table of their own, so a directory of
any size is described without gathering its files.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcat.config import DEFAULT, Catalog
from linkcat.functions import headers, mime, urls
from linkcat.operators import paths
from linkcat.operators.ids import assign_unique_ids
from linkcat.operators.skew import MIN_ROWS
from linkcat.operators.vocab import family_of
from linkcat.session import durable

FIELDS = (
    "base", "type", "family", "source_kind", "source_rank", "spec_ord", "ref",
    "file_path", "content_url", "code_repository", "encoding_format", "content_size", "date_modified",
    "transfer_encoding", "programming_language", "operating_system", "processor_requirements",
)
NO_ENCODING = "struct<encoding_format:string,content_size:bigint>"


class Described(NamedTuple):
    """Resources, the parts of those that are directories, and what was rejected and why."""

    resources: DataFrame
    parts: DataFrame
    rejects: DataFrame


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def describe_files(
    matches: DataFrame,
    files: DataFrame,
    namespace: str | None = None,
    operating_system: str | None = None,
    processor: str | None = None,
) -> Described:
    """Resources of matched paths (``path, length, mtime, spec_ord, type``) over a file listing."""
    path, is_dir = F.col("path"), F.col("path").endswith("/")
    guessed = matches.withColumn("_mime", mime.mime_of(mime.file_ext(path)))
    typed = guessed.withColumn(
        "_mime", F.when(is_dir, F.col("_mime")).otherwise(mime.patch_mime(path, F.col("_mime")))).withColumn(
        "type", mime.resource_class(F.col("type"), F.col("_mime"))).withColumn("family", family_of(F.col("type")))
    refused = is_dir & (F.col("family") == "software")
    rejects = typed.filter(refused).select(
        path.alias("ref"), F.lit("directories are not supported for SoftwareApplication").alias("reason"))
    kept = typed.filter(~refused)

    dirs = kept.filter(is_dir)
    below = paths.files_under_dir(dirs, files)
    languages = paths.bundle_languages(below).withColumnRenamed("bundle", "path")
    own_language = F.array_compact(F.array(mime.programming_language(F.col("_mime"))))
    languages_of = F.when(F.col("family") == "code", F.coalesce("programming_language", own_language))
    software = F.col("family") == "software"
    place = F.lit(namespace).cast("string") if namespace else None
    resources = kept.join(languages, "path", "left").select(
        urls.slug_id(path, place).alias("base"), "type", "family",
        F.lit("file").alias("source_kind"), F.lit(0).alias("source_rank"), "spec_ord", path.alias("ref"),
        F.when(~is_dir, path).alias("file_path"),
        _null().alias("content_url"), _null().alias("code_repository"),
        F.when(is_dir, F.lit(mime.GTAR)).otherwise(F.col("_mime")).alias("encoding_format"),
        F.when(~is_dir, F.col("length")).alias("content_size"),
        F.col("mtime").alias("date_modified"),
        _null(NO_ENCODING).alias("transfer_encoding"),
        F.when(F.size(languages_of) > 0, languages_of).alias("programming_language"),
        F.when(software, F.lit(operating_system)).cast("string").alias("operating_system"),
        F.when(software, F.lit(processor)).cast("string").alias("processor_requirements"),
    )
    return Described(resources, paths.bundle_parts(below), rejects)


def reject_failed(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Responses that answered, and the failed ones with a reason."""
    failed = F.col("status").isNull() | (F.col("status") >= 400)
    return responses.filter(~failed), responses.filter(failed).withColumn(
        "reason", headers.failure(F.col("status"), F.col("url")))


def describe_urls(specs: DataFrame, responses: DataFrame, namespace: str | None = None) -> Described:
    """Resources of URLs (``spec_ord, id, type``) from the responses to them.

    Repository addresses are looked up by their tarball URL and get no namespace.
    """
    addressed = specs.withColumn("_repo", urls.repo_address(F.col("id"))).withColumn(
        "url", F.coalesce(F.col("_repo.tarball_url"), F.col("id")))
    is_repo = F.col("_repo").isNotNull()
    answer = F.min_by(F.struct("status", "headers"), F.struct("status", F.to_json("headers")))
    answers = responses.groupBy("url").agg(answer.alias("_a")).select("url", "_a.*")
    typed = (
        addressed.join(answers, "url", "left")
        .withColumn("_h", headers.parse_headers(F.col("headers")))
        .withColumn("_type", F.when(is_repo, F.coalesce("type", F.lit("Code"))).otherwise(
            mime.resource_class(F.col("type"), F.col("_h.encoding_format"))))
        .withColumn("family", family_of(F.col("_type")))
    )
    reason = (
        F.when(is_repo & (F.col("family") != "code"), F.lit("repositories must be of type Code or a subclass"))
        .otherwise(headers.failure(F.col("status"), F.col("url")))
    )
    typed = typed.withColumn("_reason", reason)
    rejects = typed.filter("_reason is not null").select(F.col("id").alias("ref"), F.col("_reason").alias("reason"))
    software = F.col("family") == "software"
    place = F.lit(namespace).cast("string") if namespace else None
    language = F.when(~is_repo & (F.col("family") == "code"), mime.programming_language(F.col("_h.encoding_format")))
    resources = typed.filter("_reason is null").select(
        F.when(is_repo, F.col("_repo.repo")).otherwise(urls.url_slug_id(F.col("id"), place)).alias("base"),
        F.col("_type").alias("type"), "family",
        F.when(is_repo, F.lit("repo")).otherwise(F.lit("url")).alias("source_kind"),
        F.lit(1).alias("source_rank"), "spec_ord", F.col("id").alias("ref"),
        _null().alias("file_path"), F.col("url").alias("content_url"),
        F.col("_repo.https_url").alias("code_repository"),
        F.col("_h.encoding_format").alias("encoding_format"),
        F.when(is_repo, F.coalesce("_h.content_size", "_h.transfer_encoding.content_size"))
        .otherwise(F.col("_h.content_size")).alias("content_size"),
        F.col("_h.date_modified").alias("date_modified"),
        F.when(~software & ~is_repo, F.col("_h.transfer_encoding")).alias("transfer_encoding"),
        F.when(language.isNotNull(), F.array(language)).alias("programming_language"),
        _null().alias("operating_system"), _null().alias("processor_requirements"),
    )
    empty_parts = resources.filter(F.lit(False)).select(
        F.col("ref").alias("bundle"), F.lit("MediaObject").alias("part_type"), "file_path", "content_size",
        "date_modified")
    return Described(resources, empty_parts, rejects)


def route_specs(specs: DataFrame, catalog: Catalog = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Inputs that are paths, and inputs that are URLs or repository addresses."""
    web = urls.is_url(F.col("id"))
    return specs.filter(~web), specs.filter(web)


def wrap(
    files: DataFrame, web: DataFrame, reserved: DataFrame | None = None, min_rows: int = MIN_ROWS
) -> DataFrame:
    """File resources followed by URL resources, with ids unique across both.

    Naming reads its candidates several times, so the described rows are stored first.
    """
    every = durable(files.select(*FIELDS).unionByName(web.select(*FIELDS)))
    return assign_unique_ids(every, ["source_rank", "spec_ord", "ref"], reserved, min_rows=min_rows)


def order_resources(resources: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """Resources by id."""
    return resources.orderBy(*key)


def resource_json() -> Column:
    """JSON of a resource row in its family's layout, without the parts of a directory."""
    software, repo = F.col("family") == "software", F.col("code_repository").isNotNull()
    when = headers.iso_millis(F.col("date_modified"))
    nested = F.when(F.col("transfer_encoding").isNotNull(), F.struct(
        F.lit("MediaObject").alias("@type"),
        F.col("transfer_encoding.encoding_format").alias("encodingFormat"),
        F.col("transfer_encoding.content_size").alias("contentSize")))
    media = lambda cls: F.struct(
        F.lit(cls).alias("@type"), F.col("content_url").alias("contentUrl"), F.col("file_path").alias("filePath"),
        F.col("encoding_format").alias("encodingFormat"), F.col("content_size").alias("contentSize"),
        when.alias("dateModified"), nested.alias("encoding"))
    names = F.transform("programming_language", lambda n: F.struct(n.alias("name")))
    one, many = F.when(F.size(names) == 1, F.get(names, 0)), F.when(F.size(names) > 1, names)
    head = (F.col("id").alias("@id"), F.col("type").alias("@type"))
    plain = F.to_json(F.struct(
        *head,
        F.when(software, F.col("encoding_format")).alias("fileFormat"),
        F.when(software, F.col("file_path")).alias("filePath"),
        F.when(software, F.col("content_url")).alias("downloadUrl"),
        F.when(software, F.col("content_size")).alias("fileSize"),
        F.when(software, when).alias("dateModified"),
        F.col("operating_system").alias("operatingSystem"),
        F.col("processor_requirements").alias("processorRequirements"),
        F.when(repo, F.col("code_repository")).alias("codeRepository"),
        one.alias("programmingLanguage"),
        F.when(F.col("family") == "dataset", media("DataDownload")).alias("distribution"),
        F.when(F.col("family").isin("code", "other"), media("MediaObject")).alias("encoding")))
    several = F.to_json(F.struct(
        *head, many.alias("programmingLanguage"), media("MediaObject").alias("encoding")))
    return F.when(F.size(names) > 1, several).otherwise(plain)
