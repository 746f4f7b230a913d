import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from linkcat.operators import ids, skew, versions
from pyspark.sql import Window
from pyspark.sql import functions as F


def hot_rows(n=3000):
    rng = random.Random(3)
    return [("hot" if rng.random() < 0.4 else f"k{rng.randrange(50)}", rng.randrange(5), f"p{i:05d}") for i in range(n)]


def test_row_numbers_with_hot_keys(spark):
    df = spark.createDataFrame(hot_rows(), "k string, o int, p string").repartition(5)
    got = skew.row_numbers(df, ["k"], ["o", "p"], "n", min_rows=100)
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("o", "p")).cast("bigint"))
    assert got.exceptAll(plain).count() == 0 and got.count() == 3000
    bucketed = skew.split_hot(df, ["k"], ["o", "p"], min_rows=100)
    assert bucketed.filter("k = 'hot'").select(skew.BUCKET).distinct().count() > 3


def test_last_before_with_hot_keys(spark):
    df = spark.createDataFrame(hot_rows(), "k string, o int, p string").repartition(5)
    value = F.when(F.crc32("p") % 97 == 0, F.col("p"))
    got = skew.last_before(df, ["k"], ["o", "p"], value, "v", min_rows=100)
    w = Window.partitionBy("k").orderBy("o", "p").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("v", F.last(value, ignorenulls=True).over(w))
    assert got.exceptAll(plain).count() == 0 and got.filter("v is not null").count() > 1000


def test_more_hot_keys_than_any_list_holds(spark):
    rows = spark.range(36_000).select((F.col("id") % 1200).alias("k"), F.hash("id").alias("o"), "id")
    got = skew.split_hot(rows, ["k"], ["o", "id"], min_rows=2)
    assert got.groupBy("k").agg(F.count_distinct(skew.BUCKET).alias("n")).filter("n < 2").count() == 0


def test_null_keys_are_a_key(spark):
    rows = spark.range(3000).select(F.lit(None).cast("string").alias("k"), F.hash("id").alias("o"), "id")
    got = skew.row_numbers(rows, ["k"], ["o", "id"], "n", min_rows=100)
    assert {r["n"] for r in got.collect()} == set(range(1, 3001))


def served_first(rows, reserved):
    """First occurrences in order, then the rest in order, each the first free name."""
    taken, out, seen = set(reserved), {}, set()
    first, rest = [], []
    for order, base in sorted(rows):
        (rest if base in seen else first).append((order, base))
        seen.add(base)
    waiting = [(o, b) for o, b in first if b in taken]
    for order, base in first:
        if base not in taken:
            out[order] = base
            taken.add(base)
    for order, base in sorted(waiting + rest):
        name, i = base, 0
        while name in taken:
            i += 1
            name = f"{base}-{i}"
        taken.add(name)
        out[order] = name
    return out


names = st.sampled_from(["x", "x-1", "x-2", "x-1-1", "x-3", "y", "y-1", "y-01", "x-10"])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(names, min_size=1, max_size=40), st.lists(names, max_size=4))
def test_unique_ids_match_served_first(spark, bases, reserved):
    rows = [(i, b) for i, b in enumerate(bases)]
    df = spark.createDataFrame(rows, "o int, base string")
    held = spark.createDataFrame([(r,) for r in reserved], "id string")
    got = {r["o"]: r["id"] for r in ids.assign_unique_ids(df, ["o"], held).collect()}
    assert got == served_first(rows, reserved)
    assert len(set(got.values())) == len(rows) and not set(got.values()) & set(reserved)


def test_unique_ids_with_hot_base(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["index"] * 6 + ["index-7", "index-8", "readme", "index-7-1"])) for i in range(1500)]
    df = spark.createDataFrame(rows, "o int, base string").repartition(4)
    got = {r["o"]: r["id"] for r in ids.assign_unique_ids(df, ["o"], min_rows=50).collect()}
    assert got == served_first(rows, [])


def test_ranges_with_hot_document(spark):
    rng = random.Random(9)
    rows = {("hot" if rng.random() < 0.5 else f"d{rng.randrange(4)}",
             f"{rng.randrange(4)}.{rng.randrange(9)}.{rng.randrange(9)}{rng.choice(['', '', '-rc.1', '-a'])}") for _ in range(800)}
    catalog = spark.createDataFrame(sorted(rows), "doc_id string, version string")
    specs = ["<2.1.0", "^1.2.0", "", ">1.2.3-a <1.4.0", "~0.4 || 2.x", ">9.0.0", "1.2.3-rc.1", ">=2.0.0-a <2.0.1"]
    asked = spark.createDataFrame([(d, s) for d in ("hot", "d1", "zz") for s in specs], "doc_id string, range string")
    got = {(r["doc_id"], r["range"]): r["version"] for r in versions.resolve_ranges(catalog, asked, min_rows=60).collect()}
    from linkcat.functions import semver
    pairs = asked.distinct().join(catalog, "doc_id").withColumn("k", semver.version_key(F.col("version")))
    inside = pairs.filter((F.col("range") == "") | semver.in_range(F.col("k"), F.col("range")) | (F.col("range") == F.col("version")))
    want = {(r["doc_id"], r["range"]): r["v"] for r in inside.groupBy("doc_id", "range").agg(
        F.max_by("version", F.struct("k", "version")).alias("v")).collect()}
    assert got == want and len(want) > 8
