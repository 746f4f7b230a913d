"""Mixing sources by weights that change during training: which documents are read, how often, and when.

Each source has a schedule, its weight at certain moments of the training time from 0 to 1, linear between them. The
integral of the schedule is the source's weight in the whole mix. Weights share out the tokens; a source stops at ``most`` times its size,
and what is left over goes to the others by weight until none is above (a source of weight 0 gets nothing). These targets are found in one pass: with the sources
in order of ``limit / weight``, those that stop are a prefix.

A source reads its documents in the order of a hash, again and again, until its target is reached; the last document
may be cut. The tokens it has asked for by time ``t`` are its target times the integral of the schedule up to ``t``,
divided by the whole integral. Inverting that gives each reading the time at which its middle token is asked for.
``training_order`` sorts the readings by it.

Defined results: a null text has size 0, and documents of size 0 are never read; null sources are one source, the last one;
documents with a null or repeated id count like any other (rows alike in id and size are told apart by their place, which does not show in
the result as a whole); without words all targets are 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcat.llm.registry import query, table
from linkcat.llm.scan import bounded, running
from linkcat.session import durable

Schedule = Callable[[Column], Column]
WORD = r"[^\x20\x09-\x0D]+"


def repeating(*schedules: list[tuple[float, float]]) -> Schedule:
    """Schedules dealt in turn to the sources by number; each is a list of (time, weight) from time 0 to 1."""
    arrays = [F.array(*[F.struct(F.lit(float(t)).alias("time"), F.lit(float(w)).alias("weight")) for t, w in s]) for s in schedules]
    return lambda number: F.get(F.array(*arrays), (number % len(arrays)).cast("int"))


#: Sources of weight 5 fade, those of weight 2 keep level, those of weight 1 come in late.
SCHEDULE = (((0, 7.0), (0.5, 5.0), (1, 3.0)), ((0, 2.0), (1, 2.0)), ((0, 0.5), (0.5, 0.75), (1, 2.0)))


def pieces(knots: Column) -> Column:
    """The linear pieces of a schedule: start time, weight there, slope, and the integral before and after the piece."""
    start = F.array().cast("array<struct<time:double,weight:double,slope:double,before:double,after:double>>")

    def add(done: Column, i: Column) -> Column:
        a, b = F.get(knots, i), F.get(knots, i + 1)
        before = F.coalesce(F.get(done, i - 1)["after"], F.lit(0.0))
        area = (a["weight"] + b["weight"]) / 2 * (b["time"] - a["time"])
        slope = (b["weight"] - a["weight"]) / (b["time"] - a["time"])
        return F.concat(done, F.array(F.struct(a["time"].alias("time"), a["weight"].alias("weight"), slope.alias("slope"), before.alias("before"), (before + area).alias("after"))))

    return F.aggregate(F.sequence(F.lit(0), F.size(knots) - 2), start, add)


def moment(cut: Column, part: Column) -> Column:
    """The time by which ``part`` (0 to 1) of a schedule's integral is used up."""
    wanted = part * F.element_at(cut, -1)["after"]
    piece = F.coalesce(F.get(F.filter(cut, lambda p: p["after"] >= wanted), F.lit(0)), F.element_at(cut, -1))
    rest = wanted - piece["before"]
    root = F.sqrt(F.greatest(piece["weight"] * piece["weight"] + 2 * piece["slope"] * rest, F.lit(0.0)))
    return piece["time"] + F.when(rest <= 0, F.lit(0.0)).otherwise(2 * rest / (piece["weight"] + root))


def targets(sizes: DataFrame, schedule: Schedule, share: float, most: int) -> DataFrame:
    """``source``, ``number``, ``source_size``, ``cut`` (its schedule's pieces) and ``target`` of sources with sizes ``source``, ``source_size``."""
    one = sizes.withColumn("one", F.lit(1).cast("long"))
    numbered = running(one, None, [F.col("source").asc_nulls_last()], sums=["one"]).withColumn("number", F.col("one_upto") - 1)
    cut = numbered.select("source", "number", "source_size", (most * F.col("source_size")).alias("limit"), pieces(schedule(F.col("number"))).alias("cut"))
    weighed = cut.withColumn("weight", F.element_at("cut", -1)["after"])
    # Weights are summed as whole numbers of 2^-20, so that their sums are exact in any order.
    weighed = durable(weighed.withColumn("units", F.round(F.col("weight") * (1 << 20)).cast("long")))
    size, units = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("units"), F.lit(0))).first()
    ratio = F.when(F.col("units") > 0, F.col("limit") / F.col("weight")).otherwise(F.lit(float("inf")))
    ordered = running(weighed, None, [ratio, F.col("number")], sums=["limit", "units"])
    left = share * size - (F.col("limit_upto") - F.col("limit"))
    open_units = F.lit(units) - (F.col("units_upto") - F.col("units"))
    ordered = durable(ordered.withColumn("stops", (F.col("units") > 0) & (F.col("limit").cast("double") * open_units <= F.col("units") * left)))
    taken, open_ = ordered.agg(F.coalesce(F.sum(F.when(F.col("stops"), F.col("limit"))), F.lit(0)), F.coalesce(F.sum(F.when(~F.col("stops"), F.col("units"))), F.lit(0))).first()
    rest = F.col("units") * F.lit(share * size - taken) / F.lit(max(open_, 1))
    return ordered.select("source", "number", "source_size", "cut", F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(rest).alias("target"))


def curriculum(docs: DataFrame, schedule: Schedule, *, share: float = 1.5, most: int = 2, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken`` and ``readings`` (array of time and tokens)."""
    size = F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(docs[id].alias("doc_id"), docs[source].alias("source"), size.alias("size"), F.md5(docs[id].cast("string")).alias("draw"))
    rows = durable(rows.withColumn("row", F.monotonically_increasing_id()))
    sources = durable(targets(durable(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), schedule, share, most))
    n = sources.count()
    numbers = sources.select(F.col("source").alias("_source"), F.col("number").alias("_number"))
    keyed = rows.join(bounded(numbers, n), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    summed = running(keyed, "_number", ["draw", "doc_id", "size", "row"], sums=["size"])
    known = bounded(sources.select(F.col("number").alias("_number"), "source_size", "cut", "target"), n)
    placed = summed.join(known, "_number").withColumn("begin", F.col("size_upto") - F.col("size"))
    budget = F.floor("target")
    times = F.when(F.col("size") > 0, F.ceil((budget - F.col("begin")) / F.col("source_size"))).otherwise(0)

    def reading(i: Column) -> Column:
        at = F.col("begin") + i * F.col("source_size")
        tokens = F.least(F.col("size"), budget - at)
        return F.struct(moment(F.col("cut"), (at + tokens / 2) / budget).alias("time"), tokens.alias("tokens"))

    readings = F.when(times > 0, F.transform(F.sequence(F.lit(0).cast("long"), times - 1), reading)).otherwise(F.array())
    taken = F.aggregate("readings", F.lit(0).cast("long"), lambda total, r: total + r["tokens"])
    return placed.withColumn("readings", readings).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "readings")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per reading, sorted by range of its time: ``time``, ``doc_id``, ``source``, ``tokens``."""
    return mixed.select("doc_id", "source", F.explode("readings").alias("r")).select("r.time", "doc_id", "source", "r.tokens").orderBy("time", "source", "doc_id")


SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS z, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INTEGER + 1]::BIGINT AS w FROM d GROUP BY source),
o AS (SELECT *, sum(z) OVER () AS total, sum(w) OVER () - sum(w) OVER a + w AS open_w, sum(2 * z) OVER a - 2 * z AS before
  FROM s WINDOW a AS (ORDER BY 2 * z / w::DOUBLE, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, 2 * (2 * z) * open_w <= w * (3 * total - 2 * before) AS stops FROM o),
t AS (SELECT source, z, CASE WHEN stops THEN (2 * z)::DOUBLE
    ELSE w * (3 * total - 2 * coalesce(sum(CASE WHEN stops THEN 2 * z END) OVER (), 0))::DOUBLE / (2 * sum(CASE WHEN stops THEN 0 ELSE w END) OVER ())::DOUBLE END AS target FROM c),
p AS (SELECT d.doc_id, d.size, t.z, t.target, floor(t.target)::BIGINT AS budget,
    (sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR) NULLS FIRST, d.doc_id NULLS FIRST, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS begin
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, z AS source_size, target,
  least(greatest(budget - begin, 0), size) + least(greatest(budget - begin - z, 0), size) AS taken,
  CASE WHEN size = 0 THEN 0 ELSE (budget > begin)::INTEGER + (budget > begin + z)::INTEGER END AS n_readings FROM p
"""


@query("op12_curriculum_mix", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed by weights of 5, 2 and 1 in the whole; sorted by the time of their first reading, those not read last."""
    mixed = curriculum(table(spark, sf_dir, "documents"), repeating(*SCHEDULE))
    first = F.get("readings", F.lit(0))["time"]
    return mixed.orderBy(first.asc_nulls_last(), "doc_id").select("doc_id", "size", "source_size", "target", "taken", F.size("readings").alias("n_readings"))
