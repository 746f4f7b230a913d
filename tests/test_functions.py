from linkcat.config import Catalog
from linkcat.functions import headers, mime, semver, text, urls
from pyspark.sql import functions as F


def test_extensions_and_types(one):
    paths = ["a/b.csv", "x.tar.gz", "a/README", ".bashrc", "main.C", "dir.d/", "a.b/c", "x."]
    assert one(mime.file_ext, paths) == [".csv", ".tar.gz", "", "", ".C", ".d", "", "."]
    assert one(lambda c: mime.mime_of(mime.file_ext(c)), paths[:5]) == [
        "text/csv", "application/x-gtar", "application/octet-stream", "application/octet-stream", "text/x-c"]
    assert one(lambda c: mime.patch_mime(c, mime.mime_of(mime.file_ext(c))), ["x/README", "LICENSE", "data"]) == [
        "text/plain", "text/plain", "application/octet-stream"]
    assert one(mime.mime_lookup, ["src/lib.h", "src/c", "a.tar.gz", "b"]) == [
        "text/x-c", "text/x-c", "application/x-gtar", "application/octet-stream"]


def test_classes(one):
    types = ["image/png", "application/postscript", "application/vnd.ms-powerpoint", "video/mp4", "audio/ogg", "text/csv; charset=x",
             "text/x-r", "application/msword", "text/html", "text/x-markdown", "application/pdf", "application/octet-stream", None]
    assert one(mime.classify_mime, types) == [
        "ImageObject", "ImageObject", "ImageObject", "VideoObject", "AudioObject", "Dataset", "Code", "Article", "WebPage", "Readme", None, None, None]
    assert one(mime.programming_language, ["text/x-c", "application/javascript", "text/x-java-source", "text/csv"]) == [
        "c", "javascript", "java", None]
    assert one(mime.is_gzip_encoded, ["text/csv; a=b", "image/png"]) == [True, False]


def test_slugs(one):
    assert one(urls.slug, ["My File.csv", "a/b/ x.tar.gz", "a/", "/"]) == ["my-file", "x", "a", "p"]
    pages = ["http://x.example/en/8.html?q=1", "http://x.example", "http://x.example/a.tar.gz", "http://x.example/b/#top"]
    assert one(urls.url_slug_id, pages) == ["8", "p", "a.tar", "b"]
    assert one(lambda c: urls.slug_id(c, F.lit("ns")), ["A.csv"]) == ["ns/a"]
    assert one(urls.split_typed_spec, ["a.pdf::Article", "b", "c::"]) == [("a.pdf", "Article"), ("b", None), ("c", None)]


def test_repositories(one):
    address = ("tool", "https://github.com/acme/tool", "https://api.github.com/repos/acme/tool/tarball/master")
    specs = ["https://github.com/acme/tool.git", "github:acme/tool.git", "git@github.com:acme/tool.git",
             "git://github.com/acme/tool", "https://example.com/acme/tool", "src/main.c"]
    assert one(urls.repo_address, specs) == [address] * 4 + [None, None]
    assert one(urls.repo_address, ["https://bitbucket.org/acme/tool"]) == [
        ("tool", "https://bitbucket.org/acme/tool", "https://bitbucket.org/acme/tool/get/master.tar.gz")]
    assert one(urls.is_url, ["http://a.example/x", "http://localhost:3000/x", "github:a/b", "*.csv", "a/b"]) == [
        True, True, True, False, False]


def test_curies(one):
    refs = ["ldr:mydoc", "mydoc/", "schema:name", "xsd:int", "nope:x", "http://a.example/b"]
    got = one(urls.resolve_curie, refs)
    assert [r["url"] for r in got] == [
        "https://catalog.example/mydoc", "https://catalog.example/mydoc", "http://schema.org/name", "http://www.w3.org/int", None,
        "http://a.example/b"]
    assert got[4]["error"] == "unsupported CURIE prefix: nope"
    local = Catalog(protocol="http:", hostname="localhost", port=3000)
    assert one(lambda c: urls.resolve_curie(c, local)["url"], ["ldr:a"]) == ["http://localhost:3000/a"]
    assert one(lambda c: urls.resolve_curie(c, Catalog(port=443))["url"], ["ldr:a"]) == ["https://catalog.example/a"]
    assert one(lambda c: urls.resolve_curie(c, keep_prefix_path=True)["url"], ["xsd:int"]) == [
        "http://www.w3.org/2001/XMLSchema#int"]
    assert one(urls.namespace_of, ["ldr:mydoc/data", "mydoc", "http://a.example/b", "schema:x", "https://catalog.example/n/x?y"]) == [
        "mydoc", "mydoc", None, None, "n"]
    assert one(lambda c: urls.doc_root(c, base="/tmp/x/"), ["ldr:a/b"]) == ["/tmp/x/catalog.example/a/b"]


def test_headers(spark):
    rows = [
        ({"content-type": "text/csv", "content-length": "12", "last-modified": "Mon, 16 Jun 2014 13:38:20 GMT"},),
        ({"content-type": "text/html", "content-length": "7", "content-encoding": "gzip"},),
        ({"content-length": "x", "last-modified": "soon"},)]
    df = spark.createDataFrame(rows, "h map<string,string>").select(headers.parse_headers(F.col("h")).alias("p"))
    a, b, c = [r["p"] for r in df.collect()]
    assert (a["encoding_format"], a["content_size"], a["transfer_encoding"]) == ("text/csv", 12, None)
    assert df.select(headers.iso_millis(F.col("p.date_modified")).alias("d")).first()["d"] == "2014-06-16T13:38:20.000Z"
    assert b["content_size"] is None and tuple(b["transfer_encoding"]) == ("gzip", 7)
    assert c["content_size"] is None and c["date_modified"] is None


def test_readme(one):
    texts = ["pkg-test\n===========\n\nA test for data package.\n", "# A title\n  # x\n The Line  \n", "one\ntwo"]
    assert one(text.readme_description, texts) == ["a test for data package", "the Line", None]
    assert one(text.split_keywords, ["a, b  c,", ""]) == [["a", "b", "c"], []]


def test_version_order(spark, one):
    ordered = ["1.0.0-alpha", "1.0.0-alpha.1", "1.0.0-alpha.beta", "1.0.0-beta", "1.0.0-beta.2", "1.0.0-beta.11", "1.0.0-rc.1",
               "1.0.0", "1.0.1", "1.2.0", "1.10.0", "2.0.0-0", "2.0.0"]
    keys = one(semver.version_key, ordered)
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    assert one(semver.version_key, ["x", "1.2", "v1.2.3", "1.2.3+build"]) == [None, None, *one(semver.version_key, ["1.2.3"] * 2)]


def test_ranges(spark):
    cases = [
        ("<2.1.0", "2.0.9", True), ("<2.1.0", "2.1.0", False), ("<2.1.0", "2.0.0-rc.1", False), ("<0.0.1", "0.0.0", True),
        ("^1.2.3", "1.9.0", True), ("^1.2.3", "2.0.0", False), ("^0.2.3", "0.2.9", True), ("^0.2.3", "0.3.0", False),
        ("^0.0.3", "0.0.4", False), ("~1.2.3", "1.2.9", True), ("~1.2.3", "1.3.0", False), ("~1", "1.9.9", True),
        ("1.2.x", "1.2.7", True), ("1.2.x", "1.3.0", False), ("*", "3.0.0", True), ("*", "3.0.0-a", False), ("1.2", "1.2.5", True),
        ("1.0.0 - 1.4.0", "1.4.0", True), ("1.0.0 - 1.4.0", "1.4.1", False), (">=1.0.0 <2.0.0 || >=3.0.0", "3.1.0", True),
        (">=1.0.0 <2.0.0 || >=3.0.0", "2.1.0", False), (">1.2.3-rc.1", "1.2.3-rc.2", True), (">1.2.3-rc.1", "1.2.4-rc.2", False),
        (">1.2.3-rc.1", "1.2.3", True), ("=1.2.3", "1.2.3", True), (">1.2", "1.2.9", False), (">1.2", "1.3.0", True),
        ("<=1.2", "1.2.9", True), ("<1", "0.9.9", True), (">= 1.0.0", "1.0.0", True), ("", "1.0.0", True)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, r string, v string, want boolean")
    got = df.withColumn("got", semver.in_range(semver.version_key(F.col("v")), F.col("r"))).filter("got <> want").collect()
    assert got == []
    from linkcat.operators.versions import range_predicate
    for spec, version, want in cases:
        one_row = spark.createDataFrame([(version,)], "v string").withColumn("k", semver.version_key(F.col("v")))
        assert bool(one_row.filter(range_predicate(one_row, spec, F.col("k"))).count()) == want, (spec, version)
