"""Class hierarchy, property ranges and prefixes as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcat.session import durable

# The schema.org classes the media rules rely on, with their parents.
CLASSES = {
    "CreativeWork": "Thing", "Person": "Thing", "Organization": "Thing", "Role": "Thing",
    "MediaObject": "CreativeWork", "Dataset": "CreativeWork", "Code": "CreativeWork",
    "SoftwareApplication": "CreativeWork", "Article": "CreativeWork", "WebPage": "CreativeWork",
    "Readme": "CreativeWork", "Book": "CreativeWork",
    "ImageObject": "MediaObject", "VideoObject": "MediaObject", "AudioObject": "MediaObject",
    "DataDownload": "MediaObject",
    "ScholarlyArticle": "Article", "MedicalScholarlyArticle": "ScholarlyArticle",
    "NewsArticle": "Article", "BlogPosting": "Article",
    "MobileApplication": "SoftwareApplication", "WebApplication": "SoftwareApplication",
}
# The class a property's value has when it declares none.
RANGES = {"encoding": "MediaObject", "distribution": "DataDownload", "hasPart": "CreativeWork",
          "associatedMedia": "MediaObject", "programmingLanguage": "Language", "author": "Person"}
FAMILIES = ("SoftwareApplication", "Dataset", "Code", "MediaObject")


def seed_classes(spark: SparkSession) -> DataFrame:
    """The built-in hierarchy as ``vocab_classes(class, parent)``."""
    return spark.createDataFrame(list(CLASSES.items()), "class string, parent string")


def seed_ranges(spark: SparkSession) -> DataFrame:
    """The built-in ranges as ``vocab_ranges(property, range)``."""
    return spark.createDataFrame(list(RANGES.items()), "property string, range string")


def class_closure(classes: DataFrame) -> DataFrame:
    """Every (class, ancestor) pair, each class included as its own ancestor.

    Paths double in length per round, so the rounds grow with the logarithm of the depth;
    cycles end because pairs are distinct.
    """
    known = durable(
        classes.select("class", F.col("parent").alias("ancestor"))
        .unionByName(classes.select("class", F.col("class").alias("ancestor")))
        .unionByName(classes.select(F.col("parent").alias("class"), F.col("parent").alias("ancestor")))
        .dropna().distinct()
    )
    size = known.count()
    while True:
        step = known.filter("class <> ancestor")
        longer = (
            step.alias("a").join(step.alias("b"), F.col("a.ancestor") == F.col("b.class"))
            .select("a.class", "b.ancestor")
        )
        known = durable(known.unionByName(longer).distinct())
        grown = known.count()
        if grown == size:
            return known
        size = grown


def is_subclass(df: DataFrame, closure: DataFrame, cls: str, type_col: str = "type") -> DataFrame:
    """Rows whose type is ``cls`` or a subclass of it."""
    below = closure.filter(F.col("ancestor") == cls).select(F.col("class").alias(type_col)).distinct()
    return df.join(below, type_col, "left_semi")


def family_of(type_col: Column) -> Column:
    """Property layout of a class under the built-in hierarchy: software, dataset, code or other."""
    below = {name: [name] for name in FAMILIES}
    for cls in CLASSES:
        at = cls
        while at in CLASSES:
            at = CLASSES[at]
            if at in below:
                below[at].append(cls)
    return (
        F.when(type_col.isin(below["SoftwareApplication"]), F.lit("software"))
        .when(type_col.isin(below["Dataset"]), F.lit("dataset"))
        .when(type_col.isin(below["Code"]), F.lit("code"))
        .otherwise(F.lit("other"))
    )


def with_family(df: DataFrame, closure: DataFrame, type_col: str = "type") -> DataFrame:
    """Property layout of a class under any hierarchy: add ``family``."""
    rank = {"SoftwareApplication": "1software", "Dataset": "2dataset", "Code": "3code"}
    layouts = (
        closure.filter(F.col("ancestor").isin(*rank))
        .groupBy(F.col("class").alias(type_col))
        .agg(F.min(F.when(F.col("ancestor") == "SoftwareApplication", F.lit(rank["SoftwareApplication"]))
                   .when(F.col("ancestor") == "Dataset", F.lit(rank["Dataset"]))
                   .otherwise(F.lit(rank["Code"]))).alias("_layout"))
    )
    return df.join(layouts, type_col, "left").withColumn(
        "family", F.coalesce(F.substring("_layout", 2, 20), F.lit("other"))).drop("_layout")


def infer_type(df: DataFrame, ranges: DataFrame, type_col: str = "type", prop_col: str = "prop") -> DataFrame:
    """Declared type, else the range of the property that holds the node."""
    lookup = ranges.groupBy(F.col("property").alias(prop_col)).agg(F.min("range").alias("_range"))
    return df.join(lookup, prop_col, "left").withColumn(
        type_col, F.coalesce(type_col, "_range")).drop("_range")


def join_prefixes(df: DataFrame, prefixes: DataFrame, curie: str = "curie") -> tuple[DataFrame, DataFrame]:
    """Expand CURIEs against a prefix table: ``(expanded, rejects)``."""
    split = df.withColumn("prefix", F.split_part(curie, F.lit(":"), F.lit(1))).withColumn(
        "_local", F.substring(curie, F.length("prefix") + 2, F.length(curie)))
    joined = split.join(prefixes.select("prefix", F.col("iri").alias("_iri")), "prefix", "left")
    expanded = joined.filter("_iri is not null").withColumn("iri", F.concat("_iri", "_local"))
    rejects = joined.filter("_iri is null").withColumn(
        "reason", F.concat(F.lit("unsupported CURIE prefix: "), "prefix"))
    return expanded.drop("_iri", "_local"), rejects.drop("_iri", "_local")
