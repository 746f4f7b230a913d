"""Media types: from file name to MIME type to schema.org class."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

OCTET_STREAM = "application/octet-stream"
GTAR = "application/x-gtar"

# Extension -> media type (public registry values plus the
# source-code types the catalog defines). Pass a larger mapping to extend it.
MIME_EXTENSIONS = {
    "jsonld": "application/ld+json",
    "ldjson": "application/x-ldjson", "ldj": "application/x-ldjson",
    "gz": "application/x-gzip", "gzip": "application/x-gzip",
    "tgz": "application/x-gtar", "gtar": "application/x-gtar",
    "clj": "text/x-clojure",
    "coffee": "text/x-coffeescript",
    "go": "text/x-go",
    "ocaml": "text/x-ocaml", "ml": "text/x-ocaml", "mli": "text/x-ocaml",
    "scala": "text/x-scala",
    "py": "text/x-python",
    "r": "text/x-r",
    "rs": "text/x-rust",
    "m": "text/x-matlab",
    "erl": "text/x-erlang",
    "jl": "text/x-julia",
    "pl": "text/x-perl",
    "java": "text/x-java",
    "c": "text/x-c", "cc": "text/x-c", "cpp": "text/x-c", "cxx": "text/x-c",
    "h": "text/x-c", "hh": "text/x-c", "dic": "text/x-c",
    "f": "text/x-fortran", "for": "text/x-fortran", "f77": "text/x-fortran", "f90": "text/x-fortran",
    "s": "text/x-asm", "asm": "text/x-asm",
    "p": "text/x-pascal", "pas": "text/x-pascal",
    "js": "application/javascript", "ecma": "application/ecmascript",
    "json": "application/json",
    "xml": "application/xml", "xsl": "application/xml", "rdf": "application/rdf+xml",
    "n3": "text/n3", "ttl": "text/turtle",
    "csv": "text/csv", "tsv": "text/tab-separated-values",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "ods": "application/vnd.oasis.opendocument.spreadsheet",
    "doc": "application/msword", "dot": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "odt": "application/vnd.oasis.opendocument.text",
    "latex": "application/x-latex", "tex": "application/x-tex",
    "ppt": "application/vnd.ms-powerpoint", "pps": "application/vnd.ms-powerpoint",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "ps": "application/postscript", "eps": "application/postscript", "ai": "application/postscript",
    "pdf": "application/pdf", "rtf": "application/rtf", "epub": "application/epub+zip",
    "zip": "application/zip", "tar": "application/x-tar", "bz2": "application/x-bzip2",
    "7z": "application/x-7z-compressed", "rar": "application/x-rar-compressed",
    "jar": "application/java-archive", "sh": "application/x-sh", "sql": "application/x-sql",
    "swf": "application/x-shockwave-flash", "atom": "application/atom+xml",
    "html": "text/html", "htm": "text/html",
    "xhtml": "application/xhtml+xml", "xht": "application/xhtml+xml",
    "md": "text/x-markdown", "markdown": "text/x-markdown", "mkd": "text/x-markdown",
    "txt": "text/plain", "text": "text/plain", "conf": "text/plain", "def": "text/plain",
    "list": "text/plain", "log": "text/plain", "in": "text/plain",
    "css": "text/css", "yaml": "text/yaml", "yml": "text/yaml", "rtx": "text/richtext",
    "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "jpe": "image/jpeg",
    "gif": "image/gif", "bmp": "image/bmp", "svg": "image/svg+xml", "svgz": "image/svg+xml",
    "tif": "image/tiff", "tiff": "image/tiff", "webp": "image/webp", "ico": "image/x-icon",
    "psd": "image/vnd.adobe.photoshop",
    "mp4": "video/mp4", "mpeg": "video/mpeg", "mpg": "video/mpeg", "webm": "video/webm",
    "ogv": "video/ogg", "mov": "video/quicktime", "qt": "video/quicktime", "flv": "video/x-flv",
    "mkv": "video/x-matroska", "avi": "video/x-msvideo", "wmv": "video/x-ms-wmv",
    "mp3": "audio/mpeg", "mpga": "audio/mpeg", "ogg": "audio/ogg", "oga": "audio/ogg",
    "wav": "audio/x-wav", "aac": "audio/x-aac", "flac": "audio/x-flac", "weba": "audio/webm",
    "mid": "audio/midi", "midi": "audio/midi", "wma": "audio/x-ms-wma",
}

# Media type -> schema.org class, besides the image/video/audio families.
CLASS_MEMBERS = {
    "ImageObject": ("application/postscript", "application/vnd.ms-powerpoint"),
    "Dataset": (
        "application/vnd.ms-excel",
        "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
        "text/csv", "text/tab-separated-values", "application/json", "application/ld+json",
        "application/x-ldjson", "application/xml", "application/rdf+xml", "text/n3", "text/turtle",
    ),
    "Code": (
        "application/javascript", "application/ecmascript", "text/x-asm", "text/x-c",
        "text/x-fortran", "text/x-java", "text/x-java-source", "text/x-pascal", "text/x-clojure",
        "text/x-coffeescript", "text/x-go", "text/x-ocaml", "text/x-scala", "text/x-python",
        "text/x-r", "text/x-rust", "text/x-erlang", "text/x-julia", "text/x-perl",
    ),
    "Article": (
        "application/msword",
        "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
        "application/vnd.oasis.opendocument.text", "application/x-latex",
    ),
    "WebPage": ("text/html", "application/xhtml+xml"),
    "Readme": ("text/x-markdown",),
}
MEDIA_FAMILIES = {"image": "ImageObject", "video": "VideoObject", "audio": "AudioObject"}
PLAIN_TEXT_NAMES = ("readme", "license")


def literal_map(mapping: Mapping[str, str]) -> Column:
    """A constant map column; a lookup in it needs no join."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def basename(path: Column) -> Column:
    """Last path segment, trailing slashes ignored."""
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def file_ext(path: Column, tarballs: bool = True) -> Column:
    """Extension with its dot; ``.tar.gz`` counts as one; none for dot files."""
    ending = r"(\.tar\.gz|\.[^./]*)" if tarballs else r"(\.[^./]*)"
    return F.regexp_extract(path, "[^/]" + ending + "/*$", 1)


def mime_of(ext: Column, extensions: Mapping[str, str] = MIME_EXTENSIONS) -> Column:
    """Media type of an extension (with or without its dot)."""
    bare = F.lower(F.regexp_replace(ext, r"^\.", ""))
    known = F.try_element_at(literal_map({"tar.gz": GTAR, **extensions}), bare)
    return F.coalesce(known, F.lit(OCTET_STREAM))


def mime_lookup(path: Column, extensions: Mapping[str, str] = MIME_EXTENSIONS) -> Column:
    """Media type of a whole path: whatever follows its last dot or slash decides."""
    bare = F.lower(F.regexp_replace(path, r".*[./\\]", ""))
    known = F.try_element_at(literal_map(extensions), bare)
    return F.when(path.endswith(".tar.gz"), F.lit(GTAR)).otherwise(F.coalesce(known, F.lit(OCTET_STREAM)))


def patch_mime(path: Column, mime: Column) -> Column:
    """Untyped ``readme`` and ``license`` files are plain text."""
    named = F.lower(F.trim(basename(path))).isin(*PLAIN_TEXT_NAMES)
    return F.when((mime == OCTET_STREAM) & named, F.lit("text/plain")).otherwise(mime)


def bare_mime(mime: Column) -> Column:
    """Media type without its parameters."""
    return F.trim(F.split_part(mime, F.lit(";"), F.lit(1)))


def classify_mime(mime: Column) -> Column:
    """schema.org class of a media type; NULL when there is none."""
    bare = bare_mime(mime)
    members = {m: cls for cls, group in CLASS_MEMBERS.items() for m in group}
    family = F.split_part(bare, F.lit("/"), F.lit(1))
    return F.coalesce(
        F.try_element_at(literal_map(members), bare),
        F.try_element_at(literal_map(MEDIA_FAMILIES), family),
    )


def resource_class(declared: Column, mime: Column) -> Column:
    """Declared class, else the class of the media type, else CreativeWork."""
    return F.coalesce(declared, classify_mime(mime), F.lit("CreativeWork"))


def programming_language(mime: Column) -> Column:
    """Language named by a source-code media type: the part after ``x-`` if any."""
    subtype = F.split_part(mime, F.lit("/"), F.lit(2))
    after_dash = F.nullif(F.split_part(subtype, F.lit("-"), F.lit(2)), F.lit(""))
    return F.when(classify_mime(mime) == "Code", F.coalesce(after_dash, subtype))


def is_gzip_encoded(mime: Column) -> Column:
    """Text is transferred gzip-encoded."""
    return F.split_part(bare_mime(mime), F.lit("/"), F.lit(1)) == "text"


def content_type_at_publish(
    declared: Column, path: Column, is_bundle: Column, extensions: Mapping[str, str] = MIME_EXTENSIONS
) -> Column:
    """Declared media type, else tar for bundles, else the type of the path."""
    guessed = F.when(is_bundle, F.lit(GTAR)).otherwise(mime_lookup(F.coalesce(path, F.lit("")), extensions))
    return F.coalesce(F.nullif(declared, F.lit("")), guessed)
