"""Catalog inputs derived from the benchmark tables, whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcat.config import DEFAULT
from linkcat.functions import urls
from linkcat.operators.media import checksums

CONTEXT = DEFAULT.context


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One benchmark table."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text(*parts: Column | str) -> Column:
    """Concatenation of columns and literal strings."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def ours(host: Column) -> Column:
    """Hosts of the benchmark's pages."""
    return host.rlike(r"\.example\.(com|net|org)$")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    """Page URLs with the namespace their path begins with."""
    return table(spark, sf, "pages").select("page_id", "url").withColumn(
        "namespace", urls.namespace_of(F.col("url"), is_catalog_host=ours))


def page_specs(spark: SparkSession, sf: str) -> DataFrame:
    """Page URLs as described inputs; some declare a type, a few are repositories."""
    n = F.col("page_id")
    repo = text("https://github.com/acme/tool", n % 7, "-", n, ".git")
    return table(spark, sf, "pages").select(
        n.alias("spec_ord"),
        F.when(n % 10 == 3, repo).otherwise(F.col("url")).alias("id"),
        F.when(n % 9 == 4, F.lit("Article")).when(n % 9 == 5, F.lit("MobileApplication")).alias("type"),
    )


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Responses to the page inputs, their size that of the page."""
    n = F.col("page_id")
    kinds = ["text/html; charset=utf-8", "application/json", "text/x-python", "image/png", "application/pdf"]
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (n % 5 + 1).cast("int"))
    day = F.date_format(F.date_add(F.lit("2014-01-01").cast("date"), (n % 3000).cast("int")), "dd MMM yyyy")
    always = F.create_map(
        F.lit("content-type"), kind,
        F.lit("last-modified"), text("Mon, ", day, " 10:20:30 GMT"))
    length = F.create_map(F.lit("content-length"), F.octet_length(F.col("html")).cast("string"))
    encoded = F.create_map(F.lit("content-encoding"), F.lit("gzip"))
    nothing = F.create_map().cast("map<string,string>")
    repo = text("https://api.github.com/repos/acme/tool", n % 7, "-", n, "/tarball/master")
    return table(spark, sf, "pages").select(
        F.when(n % 10 == 3, repo).otherwise(F.col("url")).alias("url"),
        F.when(n % 17 == 6, F.lit(404)).otherwise(F.lit(200)).alias("status"),
        F.map_concat(
            always,
            F.when(n % 6 != 0, length).otherwise(nothing),
            F.when(n % 4 == 1, encoded).otherwise(nothing)).alias("headers"),
    )


def file_path() -> Column:
    """Path of a benchmark document as a file."""
    n = F.col("doc_id")
    exts = ["csv", "c", "py", "md", "png", "pdf", "tar.gz"]
    ext = F.element_at(F.array(*[F.lit(e) for e in exts]), (n % 8 + 1).cast("int"))
    home = text(F.col("source"), "/", F.col("lang"), "/")
    return F.when(n % 8 == 7, text(home, "d", n, "/README")).otherwise(text(home, "doc-", n, ".", ext))


def files(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark documents as files: path, length and time."""
    return table(spark, sf, "documents").select(
        "doc_id", file_path().alias("path"),
        F.octet_length("text").cast("bigint").alias("length"),
        F.timestamp_add("SECOND", F.col("doc_id"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("mtime"),
    )


def blobs(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark documents as files with their bytes."""
    return table(spark, sf, "documents").select("doc_id", file_path().alias("path"), F.col("text").alias("content"))


def digests(spark: SparkSession, sf: str) -> DataFrame:
    """Checksums of the benchmark's files."""
    return checksums(blobs(spark, sf))


def links(spark: SparkSession, sf: str) -> DataFrame:
    """Responses to document links: toxic ones are gone, unlabelled ones never answer."""
    return table(spark, sf, "labels").select(
        text("https://site.example/", F.col("doc_id")).alias("url"),
        F.when(F.col("toxic") == 1, F.lit(404)).otherwise(F.lit(200)).alias("status"))


def link_media(spark: SparkSession, sf: str) -> DataFrame:
    """Media nodes that name a URL; every tenth names none."""
    url = text("https://site.example/", F.col("doc_id"))
    value = F.when(
        F.col("doc_id") % 10 == 9, F.to_variant_object(F.struct(F.lit("x").alias("name")))
    ).otherwise(F.to_variant_object(F.struct(url.alias("contentUrl"))))
    return table(spark, sf, "documents").select("doc_id", value.alias("value"))


def order_doc_id() -> Column:
    """Id of an order as a document, below its customer's namespace."""
    return text("c", F.col("o_custkey"), "/o", F.col("o_orderkey"))


def order_body() -> Column:
    """An order as a JSON-LD document with nested, repeated and anonymous nodes."""
    k, doc = F.col("o_orderkey"), order_doc_id()
    obj = lambda **fields: F.struct(*[
        (F.lit(v) if isinstance(v, str) else v).alias(f.replace("at_", "@")) for f, v in fields.items()])
    variant = lambda **fields: F.to_variant_object(obj(**fields))
    source = variant(
        at_id=text(doc, "/src"), at_type="Code", programmingLanguage=obj(name="c"),
        encoding=obj(hasPart=F.array(obj(filePath=text("src/", k, ".h")), obj(filePath=text("src/", k, ".c")))))
    app = variant(at_id=text(doc, "/app"), at_type="SoftwareApplication", filePath=text("app/", k, ".zip"))
    customer = text("Customer ", F.col("o_custkey"))
    return variant(
        at_context=CONTEXT, at_id=doc, at_type="Dataset",
        version=text("1.", k % 7, ".", k % 5),
        name=text("order ", k), description=F.col("o_orderpriority"),
        position=k, price=F.col("o_totalprice"), isAccessibleForFree=(k % 2 == 0),
        license="http://creativecommons.org/publicdomain/zero/1.0/",
        distribution=obj(filePath=text("data/", k, ".csv")),
        hasPart=F.array_compact(F.array(source, F.when(k % 3 == 0, app))),
        about=obj(at_id=text(doc, "/customer"), name=customer),
        author=obj(at_id=text(doc, "/customer"), at_type="Person", name=customer),
    )


def order_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as documents ``(doc_id, body)``."""
    return _spread_orders(spark, sf).select("doc_id", order_body().alias("body"))


def _spread_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders dealt out by document, so that statements of a document are where its body was."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # opening bodies takes longer than moving these rows
    return table(spark, sf, "orders").withColumn("doc_id", order_doc_id()).repartition(parts, "doc_id")


def order_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files the order documents name; some are missing."""
    k = F.col("o_orderkey")
    named = F.array_compact(F.array(
        F.when(k % 5 != 0, text("data/", k, ".csv")),
        F.when(k % 4 != 0, text("src/", k, ".h")),
        text("src/", k, ".c"), text("app/", k, ".zip")))
    return table(spark, sf, "orders").select(
        F.explode(named).alias("path"), "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").select(
        "path", (F.col("o_custkey") + F.length("path")).alias("length"),
        F.col("o_orderdate").cast("timestamp").alias("mtime"),
        text(F.col("path"), " ", F.col("o_custkey"), " ", F.col("o_orderpriority")).alias("content"))


def line_doc_id() -> Column:
    """Id of an order whose items are parts of the document."""
    return text("n", F.col("l_orderkey") % 25, "/o", F.col("l_orderkey"))


def line_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their line items as parts ``(doc_id, version, body, published_at)``; all name the same relative paths."""
    item = F.struct(
        F.concat(line_doc_id(), F.lit("/l"), F.col("l_linenumber").cast("string")).alias("@id"), F.lit("Dataset").alias("@type"),
        text("part ", F.col("l_partkey")).alias("name"),
        F.struct(text("items/", F.col("l_linenumber"), ".csv").alias("filePath")).alias("distribution"))
    items = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", item.alias("item")))).alias("items"))
    orders = table(spark, sf, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    body = F.to_variant_object(F.struct(
        F.lit(CONTEXT).alias("@context"), line_doc_id().alias("@id"), F.lit("Dataset").alias("@type"), F.lit("1.0.0").alias("version"),
        F.col("o_orderpriority").alias("name"), text("clerk of ", F.col("o_custkey")).alias("description"),
        F.array(F.lit("order"), F.lower("o_orderstatus")).alias("keywords"),
        F.struct(F.lit("data.csv").alias("filePath")).alias("distribution"),
        F.col("items.item").alias("hasPart")))
    return orders.select(line_doc_id().alias("doc_id"), F.lit("1.0.0").alias("version"), body.alias("body"),
                         F.col("o_orderdate").cast("timestamp").alias("published_at"))


def line_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of the orders with items: ``data.csv`` of each order and one file per item, keyed by document."""
    items = table(spark, sf, "lineitem").select(
        line_doc_id().alias("doc_id"), text("items/", F.col("l_linenumber"), ".csv").alias("path"),
        text(F.col("l_partkey"), ",", F.col("l_suppkey")).alias("content")).groupBy("doc_id", "path").agg(F.min("content").alias("content"))
    whole = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n")).select(
        line_doc_id().alias("doc_id"), F.lit("data.csv").alias("path"), text(F.col("l_orderkey"), " has ", F.col("n")).alias("content"))
    return whole.unionByName(items)


def event_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Events as publications: document of a user, version from the event."""
    k = F.regexp_extract("props", r'"k": (\d+)', 1).cast("bigint")
    e = F.col("event_id")
    suffix = F.when(e % 13 == 5, text("-rc.", e % 4)).otherwise(F.lit(""))
    return table(spark, sf, "events").select(
        "event_id", "event_type", "ts", "user_id",
        text("u", F.col("user_id")).alias("doc_id"),
        text(k % 3, ".", e % 11, ".", e % 23, suffix).alias("version"))


def stored_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog made of every second event."""
    return event_versions(spark, sf).filter("event_id % 2 = 0").groupBy("doc_id", "version").agg(
        F.min("ts").cast("timestamp").alias("published_at")).withColumn("body", version_body()).select(
        "doc_id", "version", "body", "published_at")


def version_body() -> Column:
    """A small document with a version."""
    return F.to_variant_object(F.struct(
        F.lit(CONTEXT).alias("@context"), F.col("doc_id").alias("@id"), F.col("version").alias("version"),
        text("document of ", F.col("doc_id")).alias("name")))


def submissions(spark: SparkSession, sf: str) -> DataFrame:
    """The other events as submissions: some invalid, some unversioned, some by strangers."""
    rows = event_versions(spark, sf).filter("event_id % 2 = 1")
    plain = F.to_variant_object(F.struct(
        F.lit(CONTEXT).alias("@context"), text(F.col("doc_id"), "-live").alias("@id")))
    bare = F.to_variant_object(F.struct(F.col("doc_id").alias("@id"), F.col("version").alias("version")))
    return rows.select(
        F.col("event_id").alias("submission_id"),
        F.when(F.col("event_id") % 5 == 0, F.lit("stranger")).otherwise(text("user", F.col("user_id"))).alias("username"),
        F.when(F.col("event_type") == "error", bare).when(F.col("event_type") == "view", plain)
        .otherwise(version_body()).alias("body"),
        F.col("ts").cast("timestamp").alias("published_at"))


def event_maintainers(spark: SparkSession, sf: str) -> DataFrame:
    """Users maintain their own namespace; a third of the namespaces has nobody yet."""
    return table(spark, sf, "events").filter("user_id % 3 <> 0").select(
        text("u", F.col("user_id")).alias("namespace"), text("user", F.col("user_id")).alias("username")).distinct()


def users(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as registered users, but for every seventh."""
    c = F.col("c_custkey")
    return table(spark, sf, "customer").filter("c_custkey % 7 <> 0").select(
        text("cust", c).alias("username"), text("ldr:users/cust", c).alias("id"),
        F.lit("Person").alias("type"), text("mailto:cust", c, "@shop.example").alias("email"))


def nation_maintainers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of even number maintain their nation's namespace."""
    named = table(spark, sf, "nation").select("n_nationkey", F.lower("n_name").alias("namespace"))
    return table(spark, sf, "customer").filter("c_custkey % 2 = 0").join(
        named, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "namespace", text("cust", F.col("c_custkey")).alias("username"))


def grants(spark: SparkSession, sf: str) -> DataFrame:
    """Requested grants: customers of every third number, by document CURIE."""
    named = table(spark, sf, "nation").select("n_nationkey", F.lower("n_name").alias("_nation"))
    c = F.col("c_custkey")
    return table(spark, sf, "customer").filter("c_custkey % 3 = 0").join(
        named, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(c % 11 != 0, text("cust", c)).alias("username"),
        F.when(c % 13 == 0, text("schema:doc", c)).otherwise(text("ldr:", F.col("_nation"), "/doc", c)).alias("curie"))


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """A class hierarchy of customers below nations below regions below one root."""
    region = table(spark, sf, "region").select(
        text("region-", F.col("r_regionkey")).alias("class"), F.lit("Thing").alias("parent"))
    nation = table(spark, sf, "nation").select(
        text("nation-", F.col("n_nationkey")).alias("class"), text("region-", F.col("n_regionkey")).alias("parent"))
    customer = table(spark, sf, "customer").select(
        text("customer-", F.col("c_custkey")).alias("class"), text("nation-", F.col("c_nationkey")).alias("parent"))
    return region.unionByName(nation).unionByName(customer)


def searchable(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark documents as catalog entries to search, their whole text the description."""
    n = F.col("doc_id")
    return table(spark, sf, "documents").select(
        text("d", n).alias("doc_id"), F.lit("1.0.0").alias("version"), F.lit("Article").alias("type"),
        F.col("source").alias("name"), F.col("lang").alias("keywords"), F.col("text").alias("description"))


PEOPLE = "https://people.example"
#: Contexts that documents name.
NAMED = {PEOPLE: {"@context": {"called": "foaf:name"}}}


def scoped_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as documents with contexts of their own, lists, sets, reverse properties and a context by name."""
    doc, q = order_doc_id(), lambda *parts: F.concat(F.lit('"'), text(*parts), F.lit('"'))
    context = (f'["{CONTEXT}", {{"kids": {{"@reverse": "isPartOf"}}, "steps": {{"@id": "schema:step", "@container": "@list"}}}}]')
    body = text(
        '{"@context": ', context, ', "@id": ', q(doc), ', "steps": [', q("take ", F.col("o_orderkey")), ', {"name": "send"}], "kids": {"@id": ', q(doc, "/kid"),
        '}, "keywords": {"@set": [', q(F.col("o_orderpriority")), ', ', q("status ", F.col("o_orderstatus")), ']}, "about": {"@context": {"name": "foaf:nick"}, "@id": ', q(doc, "/customer"),
        ', "name": ', q("Customer ", F.col("o_custkey")), f'}}, "author": {{"@context": "{PEOPLE}", "@id": ', q(doc, "/clerk"), ', "called": ', q(F.col("o_orderpriority")),
        '}, "@reverse": {"mentions": {"@id": ', q(doc, "/src"), '}}, "notes": {"@list": []}}')
    return _spread_orders(spark, sf).select("doc_id", F.parse_json(body).alias("body"))
