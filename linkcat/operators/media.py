"""Media of documents: refreshing, checking, archiving and fetching their bytes.

``media`` rows come from ``nodes.media_nodes``: document columns, ``path``, ``prop``,
``value`` and ``type``. Archive results are a side table keyed by document and node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcat.config import DEFAULT, Catalog
from linkcat.functions import digest, headers, mime, urls
from linkcat.operators.nodes import as_array, as_object, part_list, text_at
from linkcat.operators.vocab import RANGES, family_of

MAX_FILE_BYTES = 1 << 30
OWNERS = ("doc_id", "version", "submission_id")
DIGESTS = ("sha1_hex", "sha1_b64", "md5_b64", "size")
MEDIA_CLASSES = ("MediaObject", "ImageObject", "VideoObject", "AudioObject", "DataDownload")


def media_type(type_col: Column, prop: Column) -> Column:
    """Declared type, else the built-in range of the property."""
    return F.coalesce(type_col, F.try_element_at(mime.literal_map(RANGES), prop))


def size_property(type_col: Column) -> Column:
    """Property that holds a size under a class; NULL when the class has none."""
    return F.when(family_of(type_col) == "software", F.lit("fileSize")).when(
        type_col.isin(*MEDIA_CLASSES), F.lit("contentSize"))


def media_url(value: Column) -> Column:
    """URL a media node names."""
    return F.coalesce(text_at(value, "$.contentUrl"), text_at(value, "$.downloadUrl"))


def media_files(media: DataFrame) -> DataFrame:
    """Files each media node names: its own, or one row per part of a bundle, with the part's path inside the node."""
    value = F.col("value")
    own = text_at(value, "$.filePath")
    listed = as_array(F.try_variant_get(value, "$.hasPart", "variant")).isNotNull()
    step = lambda i: F.when(listed, F.array(F.lit("hasPart"), i.cast("string"))).otherwise(F.array(F.lit("hasPart")))
    part = lambda p, i: F.struct(
        text_at(p, "$.filePath").alias("file_path"),
        media_type(text_at(p, "$['@type']"), F.lit("hasPart")).alias("file_type"), F.lit(True).alias("is_part"), step(i).alias("part_path"))
    whole = F.array(F.struct(
        own.alias("file_path"), media_type(F.col("type"), F.col("prop")).alias("file_type"),
        F.lit(False).alias("is_part"), F.array().cast("array<string>").alias("part_path")))
    files = F.when(own.isNotNull(), whole).otherwise(
        F.filter(F.transform(part_list(as_object(value)), part), lambda f: f["file_path"].isNotNull()))
    return media.withColumn("_f", F.explode(files)).select("*", "_f.*").drop("_f")


def file_keys(media: DataFrame, files: DataFrame) -> list[str]:
    """Columns that say whose file a path is, as far as both sides have them.

    A listing without any of them is one folder that all documents share.
    """
    return [c for c in OWNERS if c in media.columns and c in files.columns]


def split_duplicates(files: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Files of which their owner and path say one thing only, and the others as rejects with a reason.

    A file listed again with the same columns is the same file. The hidden columns of a file travel as one struct, so a row is
    never mixed from two files.
    """
    others = [c for c in files.columns if c not in (*keys, "path")]
    file = F.struct(*others)
    grouped = files.groupBy(*keys, "path").agg(
        F.when(F.min(file).eqNullSafe(F.max(file)), 1).otherwise(2).alias("_n"), F.any_value(file).alias("_file"))
    rejects = grouped.filter("_n > 1").select(*keys, "path", F.lit("listed more than once").alias("reason"))
    return grouped.filter("_n = 1").select(*keys, "path", "_file.*"), rejects


def join_owned(named: DataFrame, known: DataFrame, owners: list[str], how: str = "inner") -> DataFrame:
    """Join on ``file_path`` and the owner; documents without a version have a version of their own."""
    there = known.select(*[F.col(c).alias(f"_k_{c}" if c in (*owners, "file_path") else c) for c in known.columns])
    same = F.col("file_path") == F.col("_k_file_path")
    for c in owners:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return named.join(there, same, how).drop("_k_file_path", *[f"_k_{c}" for c in owners])


def refresh_media(media: DataFrame, files: DataFrame) -> DataFrame:
    """Current size and time of every file media names; ``found`` tells whether it exists.

    Files that name their document (``doc_id``, ``version`` or ``submission_id``) are only those of that document.
    """
    keys = file_keys(media, files)
    bytes_ = [F.xxhash64("content").alias("_bytes")] if "content" in files.columns else []  # other bytes of one size are another file
    unique, _ = split_duplicates(files.select(*keys, "path", "length", "mtime", *bytes_), keys)
    known = unique.select(
        *keys, F.col("path").alias("file_path"), F.col("length").alias("content_size"), F.col("mtime").alias("date_modified"))
    return (
        join_owned(media_files(media), known, keys, "left")
        .withColumn("found", F.col("content_size").isNotNull())
        .withColumn("size_property", size_property(F.col("file_type")))
    )


def check_links(media: DataFrame, responses: DataFrame, catalog: Catalog = DEFAULT) -> DataFrame:
    """Whether the URL of each media row answers: ``url``, ``status`` and a ``reason`` when not."""
    url = urls.resolve_curie(media_url(F.col("value")), catalog)["url"]
    answered = responses.select("url", "status").groupBy("url").agg(F.max("status").alias("status"))
    reason = (
        F.when(F.col("url").isNull(), F.lit("names neither a file nor a URL"))
        .otherwise(headers.failure(F.col("status"), F.col("url")))
    )
    return media.withColumn("url", url).join(answered, "url", "left").withColumn("reason", reason)


def split_by_size(files: DataFrame, limit: int = MAX_FILE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Files whose bytes fit in one row, and the others as rejects with a reason."""
    fits = F.col("length") <= limit
    return files.filter(fits), files.filter(~fits).withColumn("reason", F.lit("too large for one row"))


def checksums(blobs: DataFrame) -> DataFrame:
    """Digests and size of every blob; contents are read once and dropped."""
    return blobs.withColumn("_c", digest.checksums(F.col("content"))).select(
        *[c for c in blobs.columns if c != "content"], "_c.*")


def content_addresses(digested: DataFrame) -> DataFrame:
    """Stored objects: equal bytes share one address."""
    return digested.groupBy("sha1_hex").agg(
        F.count("*").alias("n_copies"), F.min("path").alias("path"), F.max("size").alias("size"),
    ).withColumn("address", digest.address(F.col("sha1_hex")))


def archive(media: DataFrame, digested: DataFrame, uploaded_at: Column | None = None) -> DataFrame:
    """What publishing adds to every media node: checksum, format, address and upload time.

    ``digested`` has ``path, sha1_hex, sha1_b64, md5_b64, size`` and, unless all documents share one
    folder, the ``doc_id``, ``version`` or ``submission_id`` that a path belongs to; see ``split_duplicates``
    for paths that occur twice. A bundle gets the order-free digest of its files. Nodes with a file
    missing are left to ``check_links``.
    """
    keys = [c for c in media.columns if c not in ("owner", "value", "id", "type", "prop")]
    owners = file_keys(media, digested)
    unique, _ = split_duplicates(digested.select(*owners, "path", *DIGESTS), owners)
    known = unique.select(*owners, F.col("path").alias("file_path"), F.struct("path", *DIGESTS).alias("_file"))
    named = media_files(media.withColumn("type", media_type(F.col("type"), F.col("prop"))))
    declared = F.coalesce(text_at(F.col("value"), "$.encodingFormat"), text_at(F.col("value"), "$.fileFormat"))
    joined = join_owned(named.withColumn("declared", declared), known, owners, "left")
    per_node = joined.groupBy(*keys, "type", "is_part").agg(
        F.count("*").alias("n_files"),
        F.count("_file").alias("n_found"),
        F.sum("_file.size").alias("size"),
        F.max("declared").alias("declared"),
        F.any_value("_file").alias("_file"),
        digest.set_digest(F.concat_ws(":", "file_path", "_file.sha1_hex")).alias("_bundle"),
    ).filter("n_found = n_files")
    bundle = F.col("is_part")
    sha1 = F.when(bundle, F.col("_bundle")).otherwise(F.col("_file.sha1_hex"))
    path = F.when(~bundle, F.col("_file.path"))
    is_media = F.col("type").isin(*MEDIA_CLASSES)
    content_type = mime.content_type_at_publish(F.col("declared"), path, bundle)
    by_path = F.when(bundle, F.lit(mime.GTAR)).otherwise(mime.mime_lookup(path))
    return per_node.select(
        *keys, "type", "size", path.alias("file_path"),
        sha1.alias("sha1_hex"),
        F.when(bundle, F.base64(F.unhex("_bundle"))).otherwise(F.col("_file.sha1_b64")).alias("sha1_b64"),
        F.when(~bundle, F.col("_file.md5_b64")).alias("md5_b64"),
        content_type.alias("content_type"),
        (is_media & mime.is_gzip_encoded(by_path)).alias("gzip_encoded"),
        F.when(family_of(F.col("type")) == "software", F.lit("downloadUrl")).otherwise(F.lit("contentUrl"))
        .alias("url_property"),
        F.col("declared").isNotNull().alias("format_declared"),
        digest.address(sha1).alias("address"),
        F.when(is_media, uploaded_at if uploaded_at is not None else F.current_timestamp()).alias("upload_date"),
    )


def new_blobs(blobs: DataFrame, stored: DataFrame) -> DataFrame:
    """Blobs whose address the store lacks, one per address; ``blobs`` has ``path, sha1_hex, content``.

    The copy to keep is chosen on owners, paths and hashes alone, so equal contents never meet.
    """
    owners = [c for c in OWNERS if c in blobs.columns]
    fresh = blobs.select(*owners, "path", "sha1_hex").join(stored.select("sha1_hex").distinct(), "sha1_hex", "left_anti")
    kept = fresh.groupBy("sha1_hex").agg(F.min(F.struct("path", *owners)).alias("_k")).select("sha1_hex", "_k.*")
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"k.{c}")) for c in (*owners, "path", "sha1_hex")]
    whole = same[-1] & same[-2]
    for condition in same[:-2]:
        whole &= condition
    return blobs.alias("b").join(kept.alias("k"), whole, "left_semi")


def archived_files(media: DataFrame, digested: DataFrame) -> DataFrame:
    """Stored object of every file a media node names, bundle parts included."""
    keys = [c for c in media.columns if c not in ("owner", "value", "id", "type", "prop")]
    owners = file_keys(media, digested)
    unique, _ = split_duplicates(digested.select(*owners, "path", "sha1_hex", "size"), owners)
    known = unique.withColumnRenamed("path", "file_path")
    return join_owned(media_files(media), known, owners).select(*keys, "file_path", "sha1_hex", "size")


def join_clone(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Bytes of every archived file: ``files`` from ``archived_files``, ``stored`` the blob store."""
    return files.join(stored.select("sha1_hex", "content"), "sha1_hex")
