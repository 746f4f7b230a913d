import base64
import datetime
import hashlib
import json

import pytest
from linkcat.operators import catalog, clone, maintainers, media, nodes, search
from linkcat.sources import readers, writers
from pyspark.sql import functions as F
from test_graph import MANIFEST

T = lambda n: datetime.datetime(2020, 1, 1) + datetime.timedelta(minutes=n)
EMPTY = "doc_id string, version string, body variant, published_at timestamp"


def subs(spark, *rows):
    df = spark.createDataFrame([(i, u, t, T(i)) for i, (u, t) in enumerate(rows)], "submission_id int, username string, t string, published_at timestamp")
    return df.select("submission_id", "username", F.parse_json("t").alias("body"), "published_at")


def doc(at_id, version=None, **more):
    return json.dumps({"@context": "https://catalog.example", "@id": at_id, **({"version": version} if version else {}), **more})


def test_publish(spark):
    stored = spark.createDataFrame([], EMPTY)
    grants = spark.createDataFrame([("a", "ann")], "namespace string, username string")
    first = catalog.publish(subs(
        spark, ("ann", doc("a", "1.0.0")), ("bob", doc("a", "1.1.0")), ("ann", doc("a", "1.0.0", name="again")), ("bob", doc("n")), ("ann", doc("n")),
        ("bob", doc("ldr:n", name="later")), ("ann", '{"@id": "a"}'), ("ann", doc("a", "2.0.0", hasPart={"@id": "b/x"})),
        ("ann", doc("a", "2.0.0", hasPart={"@id": "a/x"}))), stored, grants)
    assert [r["outcome"] for r in first.outcomes.orderBy("submission_id").collect()] == [
        "created", "forbidden", "conflict", "created", "forbidden", "updated", "invalid", "invalid", "created"]
    keys = sorted((r["doc_id"], r["version"] or "", r["n"]) for r in first.catalog.select("doc_id", "version", F.try_variant_get("body", "$.name", "string").alias("n")).collect())
    assert keys == [("a", "1.0.0", None), ("a", "2.0.0", None), ("n", "", "later")]
    assert sorted(tuple(r) for r in first.maintainers.collect()) == [("a", "ann"), ("n", "bob")]
    second = catalog.publish(subs(spark, ("ann", doc("a", "1.0.0")), ("ann", doc("a", "1.5.0-rc.1")), ("bob", doc("n"))), first.catalog, first.maintainers)
    assert [r["outcome"] for r in second.outcomes.orderBy("submission_id").collect()] == ["conflict", "created", "updated"]
    asked = spark.createDataFrame([(r,) for r in ["ldr:a", "a?version=<2.0.0", "a?version=1.5.0-rc.1", "n", "zzz", "a?version=>3.0.0"]], "request string")
    found, missing = catalog.get(second.catalog, asked)
    assert {r["request"]: r["version"] for r in found.collect()} == {
        "ldr:a": "2.0.0", "a?version=<2.0.0": "1.0.0", "a?version=1.5.0-rc.1": "1.5.0-rc.1", "n": None}
    assert {r["request"] for r in missing.collect()} == {"zzz", "a?version=>3.0.0"}
    gone = spark.createDataFrame([("a", "2.0.0"), ("n", None)], "doc_id string, version string")
    assert {r["version"] for r in catalog.unpublish(second.catalog, gone).collect()} == {"1.0.0", "1.5.0-rc.1"}


def fixture_files(spark):
    rows = [("gauges/2021.csv", "t,h\n1,2\n"), ("model/fit.py", "import plot\n"), ("model/plot.py", "x = 1\n")]
    return spark.createDataFrame([(p, bytearray(t.encode()), len(t), T(0)) for p, t in rows], "path string, content binary, length bigint, mtime timestamp")


def test_missing_media(spark):
    files = fixture_files(spark)
    responses = spark.createDataFrame([("http://x.example/a.pdf", 200), ("http://x.example/b.pdf", 500)], "url string, status int")
    grants = spark.createDataFrame([], "namespace string, username string")
    held = {"filePath": "lost.pdf"}
    got = catalog.publish(subs(
        spark, ("u", MANIFEST), ("u", doc("p", distribution={"filePath": "gauges/2021.csv"})), ("u", doc("q", encoding={**held, "contentUrl": "http://x.example/a.pdf"})),
        ("u", doc("r", encoding={**held, "contentUrl": "http://x.example/b.pdf"})), ("u", doc("s", encoding={"contentUrl": "http://x.example/unseen"}))),
        spark.createDataFrame([], EMPTY), grants, files, responses)
    assert [r["outcome"] for r in got.outcomes.orderBy("submission_id").collect()] == [
        "missing_media", "created", "created", "missing_media", "created"]


def test_archive_and_clone(spark, docs, tmp_path):
    files = fixture_files(spark)
    blobs = media.checksums(files.withColumn("bytes", F.col("content"))).withColumnRenamed("bytes", "content")
    sums = {r["path"]: r for r in blobs.collect()}
    raw = sums["gauges/2021.csv"]["content"]
    assert sums["gauges/2021.csv"]["sha1_b64"] == base64.b64encode(hashlib.sha1(raw).digest()).decode()
    assert sums["gauges/2021.csv"]["md5_b64"] == base64.b64encode(hashlib.md5(raw).digest()).decode() and sums["gauges/2021.csv"]["size"] == len(raw) == 8
    found = nodes.media_nodes(docs(MANIFEST))
    kept = {r["p"]: r for r in media.archive(found, blobs).withColumn("p", F.array_join("path", ".")).collect()}
    assert set(kept) == {"distribution.0", "hasPart.0.encoding"}
    assert kept["distribution.0"]["address"] == "r/" + hashlib.sha1(raw).hexdigest() and kept["distribution.0"]["gzip_encoded"]
    assert kept["hasPart.0.encoding"]["content_type"] == "application/x-gtar" and kept["hasPart.0.encoding"]["size"] == 18
    lost = media.refresh_media(found, files).filter("not found")
    assert {r["file_path"] for r in lost.collect()} == {"build/viewer.apk", "film/flood.webm"}

    store = str(tmp_path / "blobs")
    writers.write_blobs(blobs, store)
    writers.write_blobs(blobs, store, spark.read.parquet(store))
    stored = spark.read.parquet(store)
    assert stored.count() == 3
    published = docs(MANIFEST).select(F.lit("tides").alias("doc_id"), F.lit(None).cast("string").alias("version"), "body")
    plan = clone.clone(published, blobs, spark.createDataFrame([("ldr:tides",)], "request string"))
    contents = clone.clone_contents(plan, stored)
    got = {r["target_path"]: bytes(r["content"]) for r in contents.collect()}
    home = "catalog.example/tides/"
    assert set(got) == {home + p for p in ("JSONLD", "gauges/2021.csv", "model/fit.py", "model/plot.py")}
    assert got[home + "gauges/2021.csv"] == raw and json.loads(got[home + "JSONLD"])["@id"] == "tides"
    out = str(tmp_path / "clone")
    writers.write_clone(contents, out)
    with pytest.raises(Exception):
        writers.write_clone(contents, out)
    writers.write_clone(contents, out, force=True)


def test_files_belong_to_documents(spark, docs):
    """Two documents name the same relative path; neither sees the other's file, and a path listed twice is no file."""
    text = lambda i: json.dumps({"@context": "https://catalog.example", "@id": i, "distribution": {"filePath": "data.csv"}, "encoding": {"filePath": "twice"}})
    both = docs(text("a"), text("b"))
    rows = [("d0", "data.csv", b"abc"), ("d1", "data.csv", b"vwxyz"), ("d0", "twice", b"1"), ("d0", "twice", b"2")]
    files = spark.createDataFrame([(d, p, bytearray(c), len(c), T(0)) for d, p, c in rows], "doc_id string, path string, content binary, length bigint, mtime timestamp")
    sums = media.checksums(files)
    kept = {r["doc_id"]: r for r in media.archive(nodes.media_nodes(both), sums).collect()}
    for d, raw in (("d0", b"abc"), ("d1", b"vwxyz")):
        assert (kept[d]["size"], kept[d]["sha1_hex"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert kept[d]["md5_b64"] == base64.b64encode(hashlib.md5(raw).digest()).decode()
    _, twice = media.split_duplicates(files, ["doc_id"])
    assert [tuple(r) for r in twice.collect()] == [("d0", "twice", "listed more than once")]
    seen = {(r["doc_id"], r["file_path"]): r["content_size"] for r in media.refresh_media(nodes.media_nodes(both), files).collect()}
    assert seen == {("d0", "data.csv"): 3, ("d1", "data.csv"): 5, ("d0", "twice"): None, ("d1", "twice"): None}


def test_publish_archives_and_clone_reads_back(spark):
    """Publishing gives blobs, media and files; a clone needs nothing else."""
    files = spark.createDataFrame([(i, "data.csv", bytearray(c), len(c), T(0)) for i, c in ((0, b"one"), (1, b"second"))],
                                  "submission_id int, path string, content binary, length bigint, mtime timestamp")
    blobs = media.checksums(files.withColumn("bytes", F.col("content"))).withColumnRenamed("bytes", "content")
    none = spark.createDataFrame([], "url string, status int")
    got = catalog.publish(subs(spark, ("ann", doc("a/x", "1.0.0", distribution={"filePath": "data.csv"})), ("ann", doc("a/y", distribution={"filePath": "data.csv"}))),
                          spark.createDataFrame([], EMPTY), spark.createDataFrame([("a", "ann")], "namespace string, username string"), files, none, digested=blobs)
    assert got.added.count() == 2 and got.replaced.count() == 1
    assert {(r["doc_id"], r["size"]) for r in got.media.collect()} == {("a/x", 3), ("a/y", 6)}
    store = media.new_blobs(blobs, blobs.limit(0)).select("sha1_hex", "content")
    plan = clone.clone(got.added, got.files, spark.createDataFrame([("ldr:a/x",), ("ldr:a/y",)], "request string"))
    back = {r["target_path"]: bytes(r["content"]) for r in clone.clone_contents(plan, store).collect()}
    assert back["catalog.example/a/x/data.csv"] == b"one" and back["catalog.example/a/y/data.csv"] == b"second" and len(back) == 4


def test_get_reads_only_asked_documents(spark, tmp_path):
    writers.write_catalog(subs(spark, *[("u", doc(f"d{i}", "1.0.0")) for i in range(20)]).select(
        F.concat(F.lit("d"), F.col("submission_id")).alias("doc_id"), F.lit("1.0.0").alias("version"), "body", "published_at"), str(tmp_path / "c"))
    stored = readers.scan_catalog(spark, str(tmp_path / "c"))
    found, _ = catalog.get(stored, spark.createDataFrame([("ldr:d3?version=^1.0.0",)], "request string"))
    assert [r["doc_id"] for r in found.collect()] == ["d3"]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [s for s in plan.split("FileScan")[1:]]
    assert scans and all("doc_id" in s.split("PushedFilters")[1][:200] for s in scans)


def test_sizes_split(spark):
    fits, large = media.split_by_size(fixture_files(spark), limit=8)
    assert fits.count() == 2 and large.first()["reason"] == "too large for one row"


def test_write_and_read(spark, docs, tmp_path):
    from linkcat.operators import graph
    published = docs(MANIFEST).select(F.lit("tides").alias("doc_id"), F.lit("1.0.0").alias("version"), "body", F.lit(T(0)).alias("published_at"))
    writers.write_catalog(published, str(tmp_path / "catalog"))
    back = readers.scan_catalog(spark, str(tmp_path / "catalog"))
    assert (back.first()["doc_id"], back.first()["namespace"]) == ("tides", "tides")
    from linkcat.operators.versions import resolve_range
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    ranged = resolve_range(back, "^1.0.0")
    assert ranged.count() == 1
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters")[1]
    assert "GreaterThanOrEqual(version_key" in pushed and "LessThan(version_key" in pushed
    assert "body" not in plan.split("ReadSchema")[1]
    writers.write_manifests(published, str(tmp_path / "manifests"))
    assert json.loads(spark.read.text(str(tmp_path / "manifests")).first()["value"])["@id"] == "tides"
    good, bad = readers.scan_manifest_lines(spark, str(tmp_path / "manifests"))
    assert good.count() == 1 and bad.count() == 0
    quads = graph.to_quads(docs(MANIFEST))
    writers.write_nquads(quads, str(tmp_path / "quads"))
    assert spark.read.text(str(tmp_path / "quads")).count() == quads.count()
    lines = spark.createDataFrame([("ns/a", 0, 0, "{"), ("ns/a", 2, 0, "}"), ("ns/a", 1, 0, '"x":1')], "doc_id string, pos bigint, sub bigint, line string")
    writers.write_manifest_lines(lines, str(tmp_path / "lines"))
    files = sorted((tmp_path / "lines" / "namespace=ns").glob("*.txt"))
    assert json.loads("".join(f.read_text() for f in files)) == {"x": 1}
    (tmp_path / "responses.json").write_text('{"url": "http://a.example/", "status": 200, "headers": {"content-type": "text/html"}}\n')
    assert readers.scan_url_responses(spark, str(tmp_path / "responses.json")).first()["headers"] == {"content-type": "text/html"}


def test_maintainers(spark):
    person = lambda n: (f"user_{n}", f"ldr:users/user_{n}", "Person", "mailto:user@domain.example")
    users = spark.createDataFrame([person("a"), person("b")], "username string, id string, type string, email string")
    held = spark.createDataFrame([("mt", "user_a")], "namespace string, username string")
    listed = lambda m: [r["person_id"] for r in maintainers.list_maintainers(m, users).collect()]
    assert listed(held) == ["ldr:users/user_a"]
    asked = lambda *rows: maintainers.with_namespace(spark.createDataFrame(list(rows), "username string, curie string"))
    added, refused = maintainers.add_maintainers(held, asked(("user_b", "ldr:mt"), ("user_c", "mt"), (None, "mt")), users)
    assert listed(added) == ["ldr:users/user_a", "ldr:users/user_b"]
    assert sorted(r["reason"] for r in refused.collect()) == ["unknown user", "username and namespace are required"]
    assert listed(maintainers.remove_maintainers(added, asked(("user_b", "mt")))) == ["ldr:users/user_a"]
    new = spark.createDataFrame([("user_a", "mailto:user@domain.example"), ("user_a", "mailto:x"), ("user_z", "mailto:z")], "username string, email string")
    after, outcomes = maintainers.upsert_users(users, new)
    assert after.count() == 3 and sorted(r["outcome"] for r in outcomes.collect()) == ["clash", "created", "existing"]


def test_search(spark):
    docs = spark.createDataFrame([("a", "1", "T", "Blue whale", "sea", "A big FISH?"), ("b", "1", "T", "Red", "sea blue", "x"), ("c", "1", "T", "n", None, None)],
                                 "doc_id string, version string, type string, name string, keywords string, description string")
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    assert ids(search.search(docs, [" Blue", "fish"])) == ["a", "b"] and ids(search.search(docs, ["blue", "fish"], "all")) == ["a"]
    index = search.index_terms(docs)
    assert ids(search.search_index(index, ["BLUE", "fish"], "all")) == ["a"] and ids(search.search_index(index, ["sea"])) == ["a", "b"]
    assert search.search_count(search.search(docs, ["nothing"])).first()["n_results"] == 0
