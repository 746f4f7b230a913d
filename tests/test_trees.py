"""Documents read one at a time against the walk of rows, and what their plans leave out."""

import json
import random

from linkcat.operators import bodies, catalog, graph, nodes
from pyspark.sql import functions as F

KEYS = ["name", "about", "hasPart", "encoding", "filePath", "url", "knows", "steps", "kids", "a.b", "@id", "@type", "@reverse", "@list", "@set", "@value"]
TEXTS = ["a", "ldr:x", "_:b0", "_:z", "http://x.example/a", "/p/q/", "mailto:a@b", "schema:Thing", "x\n", 'é "\\\t', "", 1, -5, 1.5, 2.0, 1e300, 12345678901234567890, True, None]
CONTEXT = {"knows": {"@id": "foaf:knows", "@type": "@id"}, "steps": {"@id": "ex:steps", "@container": "@list"}, "kids": {"@reverse": "isPartOf"}, "ex": "http://ex.example/"}


def some(seed, n=150):
    rng = random.Random(seed)

    def value(depth):
        kind = rng.random()
        if kind < 0.4 or depth > 4:
            return rng.choice(TEXTS)
        if kind < 0.6:
            return [value(depth + 1) for _ in range(rng.randrange(4))]
        return {k: value(depth + 1) for k in rng.sample(KEYS, rng.randrange(5))} | ({"@context": rng.choice([CONTEXT, None])} if rng.random() < 0.2 else {})

    return [
        json.dumps(v | {"@context": CONTEXT}) if isinstance(v, dict) else json.dumps(v) for v in (value(0) for _ in range(n))]


def rows(df, *cols):
    return sorted(map(str, df.select(*cols).collect()))


def test_objects_are_those_of_the_walk(docs):
    given = docs(*some(1))
    shown = ["doc_id", "path", "owner", "prop", F.to_json("value"), F.schema_of_variant("value"), "id"]
    assert rows(nodes.walk_nodes(given), *shown) == rows(nodes.walk_values(given).filter("is_object"), *shown)
    assert rows(nodes.walk_nodes(given, values=False), "doc_id", "path", "id") == rows(nodes.walk_nodes(given), "doc_id", "path", "id")
    walked = nodes.walk_values(given, stop=nodes.is_media).filter("is_object")
    media = walked.filter(F.col("stopped") | ((F.size("path") == 0) & F.coalesce(nodes.has_any_key(F.col("value")), F.lit(False))))
    assert rows(nodes.media_nodes(given), *shown) == rows(media, *shown)


def test_ids_are_those_of_the_walk_in_scope(docs):
    """What is said of an object stands under the id that the walk of rows gives it."""
    given = docs(*some(2))
    walked = graph.walk_values(graph.scoped_docs(given), stop=graph.is_value_object, scope=graph.in_scope())
    owners = walked.filter("owner is not null and not is_list and prop in ('name', 'about', 'url') and not back and (is_object or not is_variant_null(value))").filter(
        ~(F.col("stopped") & F.is_variant_null(F.try_variant_get("value", "$['@value']", "variant")))).select("doc_id", F.col("owner").alias("subject")).distinct()
    said = graph.expand(given).filter("predicate in ('http://schema.org/name', 'http://schema.org/about', 'http://schema.org/url')")
    assert set(rows(owners, "doc_id", "subject")) <= set(rows(said, "doc_id", "subject"))


def test_labels_of_a_document_alone_are_those_of_rows(docs):
    given = docs(*some(3))
    by_rows = graph.label_blank_nodes(graph.statements(given), ["doc_id"]).select("doc_id", graph.nquad_line().alias("line"))
    assert rows(graph.to_quads(given), "doc_id", "line") == rows(by_rows, "doc_id", "line")


def test_documents_of_one_key_are_labelled_together(docs):
    text = [json.dumps({"@context": {}, "@id": "a", "about": {"name": n}, "author": {"name": "x"}}) for n in ("x", "y", "z")]
    given = docs(*text).withColumn("doc_id", F.when(F.col("doc_id") != "d2", F.lit("d")).when(F.lit(False), "doc_id"))
    by_rows = graph.label_blank_nodes(graph.statements(given), ["doc_id"]).select("doc_id", graph.nquad_line().alias("line"))
    assert rows(graph.to_quads(given).filter("doc_id is not null"), "doc_id", "line") == rows(by_rows.filter("doc_id is not null"), "doc_id", "line")
    assert graph.to_quads(given).filter("doc_id is null").count() == 4


def test_doubles_are_written_as_casts_write_them(spark):
    numbers = spark.range(200).select(F.concat(F.lit("d"), "id").alias("doc_id"), (F.rand(4) * F.pow(F.lit(10.0), F.col("id") % 30 - 12)).alias("x"))
    given = numbers.select("doc_id", "x", F.to_variant_object(F.struct(F.lit("a").alias("@id"), "x")).alias("body"))
    assert graph.expand(given).filter("object_kind = 'number' and object <> cast(x as string)").count() == 0
    texts = graph.compact_documents(given.select("doc_id", "body")).join(numbers, "doc_id")
    assert texts.filter(~F.col("document").contains(F.concat(F.lit('"x":'), F.col("x").cast("string")))).count() == 0


def test_reading_documents_takes_no_row_for_each_value(docs):
    """A document is opened in one step: no explode, and no exchange but the one by key that putting together needs."""
    given = docs('{"@context": {}, "@id": "a", "name": "n", "distribution": {"filePath": "f"}}')
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for df in (graph.expand(given), nodes.media_nodes(given), nodes.walk_nodes(given), graph.compact_documents(given)):
        assert "Generate" not in plan(df)
    assert "Aggregate" not in plan(graph.to_quads(given)) + plan(graph.compact_documents(given))
    assert "Generate" not in plan(bodies.set_entries(given, given.select("doc_id", F.array().cast("array<string>").alias("path"), F.create_map(F.lit("k"), F.lit("1")).alias("entries"))))


def test_a_graph_pattern_stores_what_it_asks_for(docs, monkeypatch):
    stored, durable = [], graph.durable
    monkeypatch.setattr(graph, "durable", lambda df: stored.append(durable(df)) or stored[-1])
    given = docs(*[json.dumps({"@context": {}, "@id": f"d{i}", "name": f"n{i}", "about": {"@id": f"x{i}", "name": "y"}, "price": i}) for i in range(20)])
    found = graph.match_bgp(graph.statements(given), [("?d", "http://schema.org/about", "?x"), ("?x", "http://schema.org/name", "?n")])
    assert found.count() == 20 and [s.count() for s in stored] == [60]


def test_media_are_found_once_for_all_that_archiving_writes(docs, spark, monkeypatch):
    calls, walk = [], nodes.media_nodes
    monkeypatch.setattr(nodes, "media_nodes", lambda d: calls.append(1) or walk(d))
    given = docs('{"@id": "a", "distribution": {"filePath": "f"}}')
    files = spark.createDataFrame([("f", 3, b"abc")], "path string, length bigint, content binary").withColumn("mtime", F.lit("2024-01-01").cast("timestamp"))
    from linkcat.operators import media
    changed = catalog.with_archive(given, files.drop("content"), media.checksums(files.select("path", "content")))
    plan = changed._jdf.queryExecution().optimizedPlan().toString()
    assert '"contentSize":3' in changed.select(F.to_json("body")).first()[0] and len(calls) == 1 and plan.count("run(") <= 1


def test_statements_of_a_key_come_once(docs):
    given = docs(*some(4, 60)).withColumn("doc_id", F.when(F.col("doc_id") > "d3", F.lit("d")).when(F.col("doc_id") > "d2", F.col("doc_id")))
    cols = ["doc_id", "subject", "predicate", "object", "object_kind", "datatype", "lang"]
    assert rows(graph.statements(given), *cols) == rows(graph.expand(given).distinct(), *cols)
    assert "Aggregate" not in graph.statements(given)._jdf.queryExecution().optimizedPlan().toString()
