"""Unique ids: ``x``, ``x-1``, ``x-2`` ... skipping every name that is taken."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkcat.operators.skew import MIN_ROWS, row_numbers

SUFFIXED = r"^(.*)-([1-9]\d{0,17})$"
CHUNK = 100_000


def reserved_conflict(candidates: DataFrame, reserved: DataFrame, key: str = "id") -> DataFrame:
    """Candidates whose id is already taken."""
    return candidates.join(reserved.select(key).distinct(), key, "left_semi")


def without_conflict(candidates: DataFrame, reserved: DataFrame, key: str = "id") -> DataFrame:
    """Candidates whose id is still free."""
    return candidates.join(reserved.select(key).distinct(), key, "left_anti")


def assign_unique_ids(
    candidates: DataFrame,
    order: Sequence[str],
    reserved: DataFrame | None = None,
    base: str = "base",
    out: str = "id",
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Give every candidate the first free name of its base.

    The first candidate of each base is served first and keeps the plain name unless it
    is reserved; later ones take the lowest free suffix. ``order`` must be unique.
    Then a name ``b-n`` can only clash with another base or a reserved id, so the blocked
    suffixes of every base are known up front and need no sequential pass.
    """
    numbered = row_numbers(candidates, [base], order, "_k", min_rows)
    taken = candidates.select(F.col(base).alias("_name"))
    if reserved is not None:
        taken = taken.unionByName(reserved.select(F.col(out).alias("_name")))
    taken = taken.distinct()

    # Only bases that repeat, or are reserved themselves, ever look for a suffix.
    needs = candidates.groupBy(base).agg(F.count("*").alias("_size")).withColumn("_held", F.lit(0))
    if reserved is not None:
        held = reserved.select(F.col(out).alias(base)).distinct().withColumn("_res", F.lit(1))
        needs = needs.join(held, base, "left").withColumn("_held", F.coalesce("_res", F.lit(0))).drop("_res")
        numbered = numbered.join(held, base, "left").withColumnRenamed("_res", "_held")
    else:
        numbered = numbered.withColumn("_held", F.lit(0))
    needs = needs.filter((F.col("_size") > 1) | (F.col("_held") == 1)).select(base)
    blocked = (
        taken.select(
            F.regexp_extract("_name", SUFFIXED, 1).alias(base),
            F.regexp_extract("_name", SUFFIXED, 2).try_cast("bigint").alias("_n"),
        )
        .filter(F.col("_n").isNotNull())
        .join(needs, base)
    )
    # The i-th blocked suffix has n - i free ones below it; the j-th free suffix is
    # j plus the number of blocked ones with fewer than j free ones below.
    blocked = row_numbers(blocked, [base], ["_n"], "_i", min_rows).select(
        base, (F.col("_n") - F.col("_i") + 1).alias("_j"), F.lit(0).alias("_kind")
    )
    wants = numbered.withColumn("_j", F.col("_k") - 1 + F.coalesce("_held", F.lit(0)))
    skipped = _blocked_below(wants, blocked, base)
    suffix = F.col("_j") + F.col("_skip")
    return skipped.withColumn(
        out, F.when(F.col("_j") == 0, F.col(base)).otherwise(F.concat_ws("-", base, suffix.cast("string")))
    ).drop("_k", "_held", "_j", "_skip")


def _blocked_below(wants: DataFrame, blocked: DataFrame, base: str) -> DataFrame:
    """Add ``_skip``: how many blocked suffixes of the base come at or before ``_j``.

    Counted per distinct (base, position) in chunks of positions, so a long run of
    candidates or of blocked names is spread over tasks.
    """
    at = blocked.groupBy(base, "_j").agg(F.count("*").alias("_b"))
    chunk = F.floor(F.col("_j") / CHUNK)
    probes = wants.join(at.select(base).distinct(), base, "left_semi").select(base, "_j").distinct()
    marks = (
        at.select(base, "_j", "_b", F.lit(False).alias("_probe"))
        .unionByName(probes.select(base, "_j", F.lit(0).cast("bigint").alias("_b"), F.lit(True).alias("_probe")))
        .groupBy(base, "_j").agg(F.sum("_b").alias("_b"), F.max("_probe").alias("_probe"))
        .withColumn("_chunk", chunk)
    )
    within = Window.partitionBy(base, "_chunk").orderBy("_j").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(base).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        marks.groupBy(base, "_chunk").agg(F.sum("_b").alias("_sum"))
        .withColumn("_prior", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    )
    counted = (
        marks.withColumn("_within", F.sum("_b").over(within))
        .join(chunks, [base, "_chunk"])
        .filter("_probe")
        .select(base, "_j", (F.col("_within") + F.col("_prior")).alias("_skip"))
    )
    return wants.join(counted, [base, "_j"], "left").withColumn("_skip", F.coalesce("_skip", F.lit(0)))
