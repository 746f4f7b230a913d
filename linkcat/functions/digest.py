"""Checksums of contents and order-free digests of sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LANES, LANE_WIDTH = 4, 15


def checksums(content: Column) -> Column:
    """Struct of SHA-1 (hex and base64), MD5 (base64) and byte size."""
    return F.struct(
        F.sha1(content).alias("sha1_hex"),
        F.base64(F.unhex(F.sha1(content))).alias("sha1_b64"),
        F.base64(F.unhex(F.md5(content))).alias("md5_b64"),
        F.octet_length(content).cast("bigint").alias("size"),
    )


def address(sha1_hex: Column) -> Column:
    """Address of stored bytes."""
    return F.concat(F.lit("r/"), sha1_hex)


def set_digest(item: Column) -> Column:
    """Aggregate digest of a multiset of strings.

    Every item is hashed and the hashes are added up in lanes, so the sum is combined
    on the map side and no group is ever collected, however large it is.
    """
    hashed = F.sha2(item, 256)
    lanes = [
        F.sum(F.conv(F.substring(hashed, 1 + LANE_WIDTH * i, LANE_WIDTH), 16, 10).cast("decimal(20,0)"))
        for i in range(LANES)
    ]
    return F.sha1(F.concat_ws(":", F.count(item).cast("string"), *[s.cast("string") for s in lanes]))
