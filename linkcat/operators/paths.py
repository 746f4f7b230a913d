"""Operators on file listings: matching, pruning, bundling and trees.

A listing has ``path`` (directories end in ``/``), ``length`` and ``mtime``; matches
also carry ``spec_ord`` and ``type`` of the input that matched them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcat.functions import digest, mime, urls

MANIFEST_NAME = "JSONLD"
MANIFEST = rf"(^|/){MANIFEST_NAME}$"


def _choices(text: str) -> tuple[list[str], int] | None:
    """Alternatives of the brace group ``text`` starts with and its length; None if it has no two of them."""
    depth, start, found = 0, 1, []
    for i, c in enumerate(text):
        depth += (c == "{") - (c == "}")
        if (c == "," and depth == 1) or depth == 0:
            found.append(text[start:i])
            start = i + 1
        if depth == 0:
            return (found, i + 1) if len(found) > 1 else None
    return None


def glob_regex(pattern: str, begins: bool = True) -> str:
    """Regular expression of a path glob; ``*`` and ``**`` skip dot names.

    ``**`` stands for any number of directories where it is a whole part of the path, elsewhere for ``*``.
    ``begins`` tells whether the pattern starts a part of the path.
    """
    out, i = [], 0
    while i < len(pattern):
        rest = pattern[i:]
        first = pattern[i - 1] == "/" if i else begins
        if first and rest.startswith("**/"):
            out.append(r"(?:(?!\.)[^/]+/)*")
            i += 3
        elif first and rest == "**":
            out.append(r"(?:(?!\.)[^/]+/)*(?!\.)[^/]+")
            i += 2
        elif stars := re.match(r"\*+", rest):
            out.append(r"(?!\.)(?=[^/])[^/]*" if first else "[^/]*")
            i += stars.end()
        elif rest[0] == "?":
            out.append("[^/]")
            i += 1
        elif rest[0] == "{" and (group := _choices(rest)):
            out.append("(?:" + "|".join(glob_regex(x, first) for x in group[0]) + ")")
            i += group[1]
        elif group := re.match(r"\[!?[^\]/]+\]", rest):
            out.append(group[0].replace("[!", "[^"))
            i += group.end()
        else:
            out.append(re.escape(rest[0]))
            i += 1
    return "".join(out)


def match_specs(listing: DataFrame, specs: Sequence[tuple[str, str | None]]) -> DataFrame:
    """Paths matched by each ``(glob, type)`` input, one row per input that matches.

    The inputs are typed by a user, so they are constants of one scan, not a join.
    """
    hits = [
        F.when(
            F.col("path").rlike(f"^{glob_regex(glob.rstrip('/'))}/?$"),
            F.struct(F.lit(i).alias("spec_ord"), F.lit(cls).cast("string").alias("type")),
        )
        for i, (glob, cls) in enumerate(specs)
    ]
    return (
        listing.withColumn("_hit", F.explode(F.array_compact(F.array(*hits))))
        .select(*listing.columns, "_hit.spec_ord", "_hit.type")
    )


def exclude_manifests(files: DataFrame) -> DataFrame:
    """Drop manifest files."""
    return files.filter(~F.col("path").rlike(MANIFEST))


def filter_paths(files: DataFrame, predicate: Column) -> DataFrame:
    """Keep the files a caller's predicate accepts."""
    return files.filter(predicate)


def with_directories(files: DataFrame) -> DataFrame:
    """Files plus a row for every directory above them (length 0, latest mtime below)."""
    dirs = (
        files.select(F.explode(urls.parent_dirs(F.col("path"))).alias("path"), "mtime")
        .groupBy("path").agg(F.max("mtime").alias("mtime"))
        .select("path", F.lit(0).cast("bigint").alias("length"), "mtime")
    )
    return files.select("path", "length", "mtime").unionByName(dirs)


def prune_parent_dirs(matches: DataFrame) -> DataFrame:
    """Per input, drop a matched directory when another match lies below it."""
    above = matches.select(
        "spec_ord", F.explode(urls.parent_dirs(F.col("path"))).alias("path")
    ).distinct()
    return matches.join(above, ["spec_ord", "path"], "left_anti")


def path_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` whose path is not in ``right``."""
    return left.join(right.select("path").distinct(), "path", "left_anti")


def duplicate_paths(matches: DataFrame) -> DataFrame:
    """Paths matched more than once, with their counts: an error for the caller."""
    return matches.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_urls(specs: DataFrame) -> DataFrame:
    """URLs given more than once, with their counts: an error for the caller."""
    return specs.groupBy("url").agg(F.count("*").alias("n")).filter("n > 1")


def files_under_dir(dirs: DataFrame, files: DataFrame) -> DataFrame:
    """Every regular file below each directory: ``dir`` plus the file's columns."""
    below = files.filter(~F.col("path").endswith("/")).withColumn(
        "dir", F.explode(urls.parent_dirs(F.col("path"))))
    return below.join(dirs.select(F.col("path").alias("dir")).distinct(), "dir")


def bundle_parts(dir_files: DataFrame) -> DataFrame:
    """Part rows of each bundle: what ``hasPart`` lists, one row per file."""
    return dir_files.select(
        F.col("dir").alias("bundle"),
        F.lit("MediaObject").alias("part_type"),
        F.col("path").alias("file_path"),
        F.col("length").alias("content_size"),
        F.col("mtime").alias("date_modified"),
    )


def bundle_summary(dir_files: DataFrame) -> DataFrame:
    """Number of parts and total size of each bundle."""
    return dir_files.groupBy(F.col("dir").alias("bundle")).agg(
        F.count("*").alias("n_parts"), F.sum("length").alias("total_size"))


def bundle_languages(dir_files: DataFrame) -> DataFrame:
    """Sorted distinct languages of the source files in each bundle.

    The set is bounded by the media type table, whatever the size of the bundle.
    """
    language = mime.programming_language(mime.mime_lookup(F.col("path")))
    return (
        dir_files.select(F.col("dir").alias("bundle"), language.alias("language"))
        .groupBy("bundle").agg(F.array_sort(F.collect_set("language")).alias("programming_language"))
    )


def bundle_digest(dir_files: DataFrame) -> DataFrame:
    """Digest of each bundle's paths and contents, free of order; needs ``sha1_hex``."""
    entry = F.concat_ws(":", "path", "sha1_hex")
    return dir_files.groupBy(F.col("dir").alias("bundle")).agg(
        digest.set_digest(entry).alias("digest"), F.count("*").alias("n_parts"))


def filter_bundle_entries(entries: DataFrame, parts: DataFrame) -> DataFrame:
    """Archive entries listed as parts of their bundle; the others are left out."""
    listed = parts.select("bundle", F.col("file_path").alias("path")).distinct()
    return entries.join(listed, ["bundle", "path"], "left_semi")


def path_tree(files: DataFrame) -> DataFrame:
    """Directory tree of a listing: files, bytes and height below each directory."""
    depth = F.size(F.split("path", "/"))
    return (
        files.select(F.explode(urls.parent_dirs(F.col("path"))).alias("prefix"), "length", depth.alias("_depth"))
        .groupBy("prefix")
        .agg(
            F.count("*").alias("n_files"),
            F.sum("length").alias("total_size"),
            (F.max("_depth") - F.size(F.split("prefix", "/")) + 1).cast("bigint").alias("height"),
        )
    )
