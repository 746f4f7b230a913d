import json

import pytest
from linkcat.operators import graph, nodes, vocab
from pyspark.sql import functions as F

MANIFEST = json.dumps({
    "@id": "tides", "@context": "https://catalog.example", "@type": "Dataset", "license": "http://l.example/open",
    "distribution": [{"filePath": "gauges/2021.csv"}, {"contentUrl": "http://x.example/2020.csv"}],
    "hasPart": [
        {"@type": "Code", "@id": "tides/model", "encoding": {"hasPart": [{"filePath": "model/fit.py"}, {"filePath": "model/plot.py"}, {"name": "no file"}]}},
        {"@type": "MobileApplication", "@id": "tides/viewer", "filePath": "build/viewer.apk"},
        {"@type": "VideoObject", "@id": "tides/flood", "encoding": {"filePath": "film/flood.webm"}}]})
SHOW = '{"name": "harbour", "@context": "https://catalog.example", "@id": "piers"}'


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_golden_media_nodes(spark, docs):
    media = vocab.infer_type(nodes.media_nodes(docs(MANIFEST)), vocab.seed_ranges(spark))
    got = {(r["t"], json.dumps(json.loads(r["v"]), sort_keys=True)) for r in media.select(F.col("type").alias("t"), F.to_json("value").alias("v")).collect()}
    assert got == {
        ("MediaObject", '{"hasPart": [{"filePath": "model/fit.py"}, {"filePath": "model/plot.py"}, {"name": "no file"}]}'),
        ("MobileApplication", '{"@id": "tides/viewer", "@type": "MobileApplication", "filePath": "build/viewer.apk"}'),
        ("MediaObject", '{"filePath": "film/flood.webm"}'),
        ("DataDownload", '{"filePath": "gauges/2021.csv"}'), ("DataDownload", '{"contentUrl": "http://x.example/2020.csv"}')}


def test_media_root_is_walked(docs):
    text = '{"filePath": "a", "hasPart": {"contentUrl": "u", "encoding": {"filePath": "inner"}}, "encoding": {"hasPart": {"filePath": "p"}}, "x": null}'
    assert sorted(r["p"] for r in nodes.media_nodes(docs(text)).select(F.array_join("path", ".").alias("p")).collect()) == ["", "encoding", "hasPart"]


def test_golden_profiles(docs):
    show = docs(SHOW)
    node = lambda p: json.loads(graph.as_profile(show, p).first()["node"])
    assert node("compacted") == {"@id": "ldr:piers", "name": "harbour"}
    assert node("flattened") == {"@id": "ldr:piers", "name": "harbour"}
    assert node("expanded") == {"@id": "https://catalog.example/piers", "http://schema.org/name": [{"@value": "harbour"}]}
    assert [r["line"] for r in graph.as_profile(show, "normalized").collect()] == [
        '<https://catalog.example/piers> <http://schema.org/name> "harbour" .']


def test_walk_is_the_same_at_any_level_split(docs):
    deep = "1"
    for i in range(40):
        deep = f'{{"k{i}": [{deep}, {{"@id": "n{i}"}}]}}' if i % 2 else f'{{"k{i}": {deep}}}'
    pair = docs(deep, MANIFEST)
    flat = lambda n: rows(nodes.walk_values(pair, levels=n).withColumn("p", F.array_join("path", "/")).withColumn(
        "v", F.to_json("value")), "doc_id", "p", "v", "is_object")
    shallow = flat(2)
    assert shallow == flat(0) == flat(6) and max(len(r[1].split("/")) for r in shallow) > 40


def test_key_order_does_not_matter(docs):
    a = '{"@context": "https://catalog.example", "@id": "x", "name": ["b", "a"], "about": {"name": "n"}, "size": 3, "w": 1.5, "ok": true}'
    b = '{"ok": true, "w": 1.5, "size": 3, "about": {"name": "n"}, "name": ["a", "b"], "@id": "ldr:x", "@context": "https://catalog.example"}'
    lines = [[r["line"] for r in graph.order_graph(graph.to_quads(docs(t))).collect()] for t in (a, b)]
    assert lines[0] == lines[1] and len(lines[0]) == 7
    assert '<https://catalog.example/x> <http://schema.org/w> "1.5E0"^^<http://www.w3.org/2001/XMLSchema#double> .' in lines[0]
    assert '_:c14n0 <http://schema.org/name> "n" .' in lines[0]


def test_values_contexts_and_references(docs):
    text = json.dumps({
        "@context": ["https://catalog.example", {"knows": {"@id": "foaf:knows", "@type": "@id"}, "nick": "http://xmlns.com/foaf/0.1/nick"}],
        "@id": "a", "knows": "b", "nick": {"@value": "N", "@language": "en"}, "dc:title": "T\n\"q\"",
        "when": {"@value": "2014", "@type": "xsd:gYear"}, "license": "http://l.example/x", "url": "ldr:y", "whole": 2.0})
    got = {tuple(r) for r in graph.expand(docs(text)).select("predicate", "object", "object_kind", "datatype", "lang").collect()}
    assert got == {
        ("http://xmlns.com/foaf/0.1/knows", "https://catalog.example/b", "iri", None, None),
        ("http://xmlns.com/foaf/0.1/nick", "N", "literal", None, "en"),
        ("http://purl.org/dc/terms/title", "T\n\"q\"", "literal", None, None),
        ("http://schema.org/when", "2014", "literal", "http://www.w3.org/2001/XMLSchema#gYear", None),
        ("http://schema.org/license", "http://l.example/x", "iri", None, None),
        ("http://schema.org/url", "https://catalog.example/y", "iri", None, None),
        ("http://schema.org/whole", "2", "literal", "http://www.w3.org/2001/XMLSchema#integer", None)}
    line = [r["line"] for r in graph.to_quads(docs(text)).filter("line like '%title%'").collect()]
    assert line == ['<https://catalog.example/a> <http://purl.org/dc/terms/title> "T\\n\\"q\\"" .']


def test_compact_undoes_expand(docs):
    compacted = graph.compact(graph.expand(docs(MANIFEST)))
    subjects = {r["subject"] for r in compacted.collect()}
    assert {"ldr:tides", "ldr:tides/viewer"} <= subjects
    assert rows(compacted.filter("predicate = '@type'"), "subject", "object")[0] == ("ldr:tides", "Dataset")


def test_flatten_merges_nodes(docs):
    text = '{"@context": "https://catalog.example", "@id": "a", "p": {"@id": "b", "name": "x"}, "q": {"@id": "b", "name": ["x", "y"]}}'
    got = {r["id"]: json.loads(r["node"]) for r in graph.as_profile(docs(text), "flattened").collect()}
    assert got == {"ldr:a": {"@id": "ldr:a", "p": {"@id": "ldr:b"}, "q": {"@id": "ldr:b"}}, "ldr:b": {"@id": "ldr:b", "name": ["x", "y"]}}


def test_rejects(docs):
    texts = ['{"@id": "a"}', '{"@context": "https://catalog.example", "x": {"@nest": [1]}}',
             '{"@context": {"tag": {"@id": "schema:tag", "@container": "@language"}}, "@id": "b"}', SHOW, '{"@context": {"id": "@id"}, "id": "c"}']
    assert [r["doc_id"] for r in graph.without_context(docs(*texts)).collect()] == ["d0"]
    assert sorted((r["doc_id"], r["reason"]) for r in graph.unsupported(docs(*texts)).collect()) == [("d1", "uses @nest"), ("d2", "indexed container"), ("d4", "keyword under another name")]
    supported, refused = graph.split_supported(docs(*texts))
    assert rows(supported, "doc_id") == [("d3",)]
    assert rows(refused, "doc_id", "reason") == [("d0", "no context"), ("d1", "uses @nest"), ("d2", "indexed container"), ("d4", "keyword under another name")]
    assert graph.expand(docs(*texts)).filter("doc_id in ('d1', 'd2', 'd4')").count() == 0
    assert {r["doc_id"] for r in graph.as_profile(supported, "expanded").collect()} == {"d3"}


def test_ids_and_names_are_escaped(docs):
    text = json.dumps({"@context": "https://catalog.example", "@id": 'a"b\\', "x y": {"@id": "http://q.example/<c d>", 'n"': "v"}})
    for profile in ("expanded", "flattened", "compacted"):
        nodes_ = [json.loads(r["node"]) for r in graph.as_profile(docs(text), profile).collect()]
        assert any(n["@id"].endswith('a"b\\') for n in nodes_)
    lines = [r["line"] for r in graph.to_quads(docs(text)).collect()]
    assert '<https://catalog.example/a\\u0022b\\u005C> <http://schema.org/x\\u0020y> <http://q.example/\\u003Cc\\u0020d\\u003E> .' in lines


def test_patterns(docs):
    st = graph.statements(docs(MANIFEST))
    name = "http://schema.org/"
    assert graph.match_pattern(st, predicate=name + "filePath").count() == 5
    found = graph.match_bgp(st, [("?d", name + "hasPart", "?p"), ("?p", name + "filePath", "?f")])
    assert ("build/viewer.apk",) in rows(found, "f")
    with pytest.raises(ValueError):
        graph.match_bgp(st, [("?a", name + "x", "?b"), ("?c", name + "y", "?d")])


def test_subtree_and_ids(docs):
    assert nodes.subtree(docs(MANIFEST), "ldr:tides/flood").count() == 1
    assert "tides/viewer" in {r["id"] for r in nodes.document_ids(docs(MANIFEST)).collect()}


def test_closure_with_cycle(spark):
    classes = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "c")], "class string, parent string")
    got = {tuple(r) for r in vocab.class_closure(classes).collect()}
    assert {("a", "a"), ("a", "c"), ("c", "b"), ("d", "a")} <= got and len(got) == 13
    typed = spark.createDataFrame([("MobileApplication",), ("DataDownload",), ("Dataset",), ("Nope",)], "type string")
    closure = vocab.class_closure(vocab.seed_classes(spark))
    assert rows(vocab.with_family(typed, closure), "type", "family") == rows(
        typed.withColumn("family", vocab.family_of(F.col("type"))), "type", "family")
    assert rows(vocab.is_subclass(typed, closure, "CreativeWork"), "type") == [("DataDownload",), ("Dataset",), ("MobileApplication",)]


RICH = json.dumps({
    "@context": ["https://catalog.example", {
        "ex": "http://ex.example/", "kids": {"@reverse": "isPartOf"}, "steps": {"@id": "ex:steps", "@container": "@list"},
        "made": {"@id": "ex:made", "@type": "xsd:date"}, "@language": "en"}],
    "@id": "a", "steps": [1, {"name": {"@value": "n"}}], "kids": [{"@id": "k1"}, {"@id": "k2"}], "made": "2014-01-01",
    "about": {"@context": {"name": "ex:label", "@language": None}, "name": "inner"}, "name": "outer",
    "author": {"@context": "https://people.example", "@id": "p:ann", "called": "Ann"},
    "set": {"@set": ["p", {"@value": "q"}]}, "@reverse": {"mentions": {"@id": "m", "name": {"@value": "M"}}}, "none": {"@list": []}, "nested": {"@list": [[1], []]}})
PEOPLE = {"https://people.example": {"@context": {"p": "http://people.example/", "called": "foaf:name"}}}
C, E, O, R = "https://catalog.example/", "http://ex.example/", "http://schema.org/", "http://www.w3.org/1999/02/22-rdf-syntax-ns#"


def test_contexts_lists_sets_and_reverse(docs):
    got = rows(graph.expand(docs(RICH), named=PEOPLE), "subject", "predicate", F.coalesce("object", F.lit("")), F.coalesce("datatype", "lang", F.lit("")))
    integer = "http://www.w3.org/2001/XMLSchema#integer"
    assert got == sorted([
        (C + "a", E + "steps", "_:csteps.@list.0", ""), ("_:csteps.@list.0", R + "first", "1", integer), ("_:csteps.@list.0", R + "rest", "_:csteps.@list.1", ""),
        ("_:csteps.@list.1", R + "first", "_:bsteps.@list.1", ""), ("_:bsteps.@list.1", O + "name", "n", ""), ("_:csteps.@list.1", R + "rest", R + "nil", ""),
        (C + "k1", O + "isPartOf", C + "a", ""), (C + "k2", O + "isPartOf", C + "a", ""), (C + "a", E + "made", "2014-01-01", "http://www.w3.org/2001/XMLSchema#date"),
        (C + "a", O + "about", "_:babout", ""), ("_:babout", E + "label", "inner", ""), (C + "a", O + "name", "outer", "en"),
        (C + "a", O + "author", "http://people.example/ann", ""), ("http://people.example/ann", "http://xmlns.com/foaf/0.1/name", "Ann", "en"),
        (C + "a", O + "set", "p", "en"), (C + "a", O + "set", "q", ""), (C + "m", O + "mentions", C + "a", ""), (C + "m", O + "name", "M", ""),
        (C + "a", O + "none", R + "nil", ""), (C + "a", O + "nested", "_:cnested.@list.0", ""), ("_:cnested.@list.0", R + "first", "_:cnested.@list.0.@list.0", ""),
        ("_:cnested.@list.0.@list.0", R + "first", "1", integer), ("_:cnested.@list.0.@list.0", R + "rest", R + "nil", ""),
        ("_:cnested.@list.0", R + "rest", "_:cnested.@list.1", ""), ("_:cnested.@list.1", R + "first", R + "nil", ""), ("_:cnested.@list.1", R + "rest", R + "nil", "")])


def test_scopes_are_the_same_at_any_level_split(docs, monkeypatch):
    whole = rows(graph.expand(docs(RICH), named=PEOPLE), "subject", "predicate", "object")
    walk = graph.walk_values
    monkeypatch.setattr(graph, "walk_values", lambda *a, **k: walk(*a, **k, levels=0))
    assert rows(graph.expand(docs(RICH), named=PEOPLE), "subject", "predicate", "object") == whole


def test_labels_of_different_places_are_different(docs):
    text = json.dumps({"@context": "https://catalog.example", "@id": "x", "a.b": {"name": "one"}, "a": {"b": {"name": "two"}, "name": "a"},
                       "c": {"@id": "_:ba", "name": "own"}, "d%2Eb": {"name": "three"}, "e": {"@id": "_:uba", "name": "other"}})
    named = graph.expand(docs(text)).filter(F.col("predicate").endswith("name")).groupBy("subject").agg(F.collect_list("object").alias("o"))
    assert sorted(r["o"] for r in named.collect()) == [["a"], ["one"], ["other"], ["own"], ["three"], ["two"]]
    lines = [r["line"] for r in graph.expand(docs(text)).select(graph.nquad_line().alias("line")).collect()]
    assert len({x.split()[0] for x in lines if x.startswith("_:") and "name" in x}) == 6


def test_whole_documents_are_compacted(docs):
    got = [json.loads(r["document"]) for r in graph.compact_documents(docs(SHOW, MANIFEST, RICH, '{"@context": {}, "p": [[], {}], "q": null}'), named=PEOPLE).orderBy("doc_id").collect()]
    assert got[0] == {"@context": "https://catalog.example", "@id": "ldr:piers", "name": "harbour"}
    want = json.loads(MANIFEST)
    want["@id"] = "ldr:tides"
    for part in want["hasPart"]:
        part["@id"] = "ldr:" + part["@id"]
    assert got[1] == want
    assert got[2] == {
        "@context": "https://catalog.example", "@id": "ldr:a", E + "steps": {"@list": [1, {"name": "n"}]}, E + "made": {"@type": "xsd:date", "@value": "2014-01-01"},
        "about": {E + "label": "inner"}, "name": {"@language": "en", "@value": "outer"}, "author": {"@id": "http://people.example/ann", "foaf:name": {"@language": "en", "@value": "Ann"}},
        "set": [{"@language": "en", "@value": "p"}, "q"], "@reverse": {"isPartOf": [{"@id": "ldr:k1"}, {"@id": "ldr:k2"}], "mentions": {"@id": "ldr:m", "name": "M"}},
        "none": {"@list": []}, "nested": {"@list": [{"@list": [1]}, {"@list": []}]}}
    assert got[3] == {"@context": "https://catalog.example", "p": {}}


def test_a_compacted_document_says_what_the_body_says(docs):
    bodies = docs(RICH, MANIFEST)
    again = graph.compact_documents(bodies, named=PEOPLE).select("doc_id", F.parse_json("document").alias("body"))
    lines = lambda d, **k: rows(graph.label_blank_nodes(graph.statements(d, **k), ["doc_id"]).select("doc_id", graph.nquad_line().alias("line")), "doc_id", "line")
    assert lines(again) == lines(bodies, named=PEOPLE)
    assert rows(graph.compact_documents(again), "document") == rows(graph.compact_documents(bodies, named=PEOPLE), "document")
