"""HTTP response headers and error bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HTTP_DATE = "dd MMM yyyy HH:mm:ss 'GMT'"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
CONTEXT_REL = "http://www.w3.org/ns/json-ld#context"


def header(headers: Column, name: str) -> Column:
    """A header by its lower-case name."""
    return F.try_element_at(headers, F.lit(name))


def failure(status: Column, url: Column) -> Column:
    """Why a URL counts as dead: no response, or an error status; NULL if it answered."""
    return F.when(status.isNull(), F.concat(F.lit("no response from "), url)).when(
        status >= 400, F.concat(F.lit("status "), status.cast("string"), F.lit(" from "), url))


def http_date(value: Column) -> Column:
    """Timestamp of an HTTP date; the day name carries no information."""
    return F.try_to_timestamp(F.substring(value, 6, 100), F.lit(HTTP_DATE))


def iso_millis(ts: Column) -> Column:
    """Timestamp rendered as ISO-8601 UTC with milliseconds."""
    return F.date_format(ts, ISO_MILLIS)


def parse_headers(headers: Column) -> Column:
    """Struct of the headers a resource is described from.

    With a content encoding, the length is that of the encoded form.
    """
    length = F.regexp_extract(F.coalesce(header(headers, "content-length"), F.lit("")), r"^\s*([+-]?\d+)", 1)
    size = F.nullif(length, F.lit("")).try_cast("bigint")
    encoding = header(headers, "content-encoding")
    return F.struct(
        header(headers, "content-type").alias("encoding_format"),
        F.when(encoding.isNull(), size).alias("content_size"),
        http_date(header(headers, "last-modified")).alias("date_modified"),
        F.when(
            encoding.isNotNull(),
            F.struct(encoding.alias("encoding_format"), size.alias("content_size")),
        ).alias("transfer_encoding"),
    )


def context_from_link(headers: Column) -> Column:
    """Context IRI named by a ``Link`` header, else NULL."""
    pattern = r"<([^>]*)>\s*;[^,<]*rel=\"?" + CONTEXT_REL.replace(".", r"\.") + r"\"?"
    return F.nullif(F.regexp_extract(F.coalesce(header(headers, "link"), F.lit("")), pattern, 1), F.lit(""))


def error_reason(body: Column) -> Column:
    """First of description, reason and error in an error body."""
    named = [F.nullif(header(body, k), F.lit("")) for k in ("description", "reason", "error")]
    return F.coalesce(*named, F.lit("error"))
