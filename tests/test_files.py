import datetime
import json
import random

import pytest
from linkcat.operators import paths, resources
from linkcat.sources import readers
from pyspark.sql import functions as F

T0 = datetime.datetime(2019, 3, 2, 4, 5, 6)
#: Extensions with the class, media type and language that the layout rules give their files.
SORTS = {"tsv": ("Dataset", "text/tab-separated-values", None), "ttl": ("Dataset", "text/turtle", None), "rs": ("Code", "text/x-rust", "rust"),
         "jl": ("Code", "text/x-julia", "julia"), "gif": ("ImageObject", "image/gif", None), "jar": (None, "application/java-archive", None)}


def tree(seed):
    """Random paths with sizes: up to three levels of folders, names that differ, all extensions."""
    rng = random.Random(seed)
    folders = ["", *(f"f{i}/" for i in range(3)), *(f"f{i}/g{j}/" for i in range(2) for j in range(2)), "f0/g1/h/"]
    return [(f"{rng.choice(folders)}n{k}.{rng.choice(sorted(SORTS))}", rng.randrange(1, 9999)) for k in range(60)]


TREE = [("pump/JSONLD", 7), ("pump/a.rs", 3), ("pump/b.rs", 4), ("LICENSE", 33), ("wells.csv", 6), ("JSONLD", 2)]


def listing(spark, rows=TREE):
    return spark.createDataFrame([(p, n, T0) for p, n in rows], "path string, length bigint, mtime timestamp")


def sort_of(path):
    return SORTS[path.rsplit(".", 1)[1]]


@pytest.mark.parametrize("seed", [3, 4])
def test_described_files_follow_the_layout_rules(spark, seed):
    rows = tree(seed)
    folder = "f0/" if seed == 3 else "f1/g0/"
    files = listing(spark, rows)
    outside = [(p, n) for p, n in rows if not p.startswith(folder) and p.endswith((".ttl", ".gif"))]
    specs = [(p, None) for p, _ in outside] + [(folder.rstrip("/"), "Code")]
    described = resources.describe_files(paths.match_specs(paths.with_directories(files), specs), files)
    got = {r["ref"]: r for r in described.resources.collect()}
    assert set(got) == {p for p, _ in outside} | {folder}
    for path, size in outside:
        r = got[path]
        assert (r["type"], r["encoding_format"], r["content_size"], r["file_path"], r["base"]) == (*sort_of(path)[:2], size, path, path.split("/")[-1].split(".")[0])
    inside = [(p, n) for p, n in rows if p.startswith(folder)]
    whole = got[folder]
    assert (whole["type"], whole["file_path"], whole["encoding_format"]) == ("Code", None, "application/x-gtar")
    assert sorted(whole["programming_language"]) == sorted({sort_of(p)[2] for p, _ in inside} - {None})
    assert sorted((r["file_path"], r["content_size"]) for r in described.parts.collect()) == sorted(inside)
    assert described.rejects.count() == 0


def test_directory_of_software_is_rejected(spark):
    files = listing(spark)
    matches = paths.match_specs(paths.with_directories(files), [("pump", "MobileApplication"), ("LICENSE", None)])
    described = resources.describe_files(matches, files)
    assert [r["ref"] for r in described.rejects.collect()] == ["pump/"]
    (kept,) = described.resources.collect()
    assert (kept["type"], kept["encoding_format"], kept["base"]) == ("CreativeWork", "text/plain", "license")


def test_pruning_is_per_input(spark):
    every = paths.exclude_manifests(paths.with_directories(listing(spark)))
    got = paths.prune_parent_dirs(paths.match_specs(every, [("**/*", None), ("pump", "Code")]))
    assert {(r["spec_ord"], r["path"]) for r in got.collect() if r["path"].endswith("/")} == {(1, "pump/")}
    assert paths.duplicate_paths(got).count() == 0


def test_globs(spark):
    import re
    hit = lambda glob, path: bool(re.fullmatch(paths.glob_regex(glob), path))
    assert hit("*.csv", "a.csv") and not hit("*.csv", "b/a.csv") and not hit("*.csv", ".csv")
    assert hit("**/*.csv", "a.csv") and hit("**/*.csv", "x/y/a.csv") and not hit("**/*.csv", ".x/a.csv")
    assert hit("src/**", "src/a") and hit("src/**", "src/x/y.c") and not hit("src/**", "srcs/a") and not hit("src/**", "src/.git/a")
    assert hit("a/**/b/*.c", "a/b/x.c") and hit("a/**/b/*.c", "a/q/r/b/x.c") and not hit("a**", "a/b") and hit("a**", "ab")
    assert hit("{a,b{1,2}}.c", "b2.c") and hit("{a,b{1,2}}.c", "a.c") and not hit("{a,b{1,2}}.c", "b.c") and hit("x{}", "x{}")
    assert hit("a?[0-9].{c,h}", "ab3.h") and not hit("a?[!0-9].{c,h}", "ab3.h")


def test_wrap_golden_repository(spark):
    specs = spark.createDataFrame([(0, "https://github.com/acme/tool.git", None), (1, "http://x.example/data", "Readme"),
                                   (2, "http://x.example/code", None), (3, "http://x.example/gone", None)], "spec_ord int, id string, type string")
    tar = "https://api.github.com/repos/acme/tool/tarball/master"
    responses = spark.createDataFrame([
        (tar, 200, {"content-type": "application/x-gzip"}), ("http://x.example/data", 200, {"content-type": "text/plain", "content-length": "5"}),
        ("http://x.example/code", 200, {"content-type": "text/x-python", "content-encoding": "gzip", "content-length": "9"}),
        ("http://x.example/gone", 404, {})], "url string, status int, headers map<string,string>")
    described = resources.describe_urls(specs, responses, "ns")
    files = resources.describe_files(paths.match_specs(listing(spark), [("wells.csv", None)]), listing(spark), "ns").resources
    rows = resources.wrap(files, described.resources).withColumn("json", resources.resource_json())
    got = {r["id"]: json.loads(r["json"]) for r in rows.collect()}
    assert got["tool"] == {"@id": "tool", "@type": "Code", "codeRepository": "https://github.com/acme/tool", "encoding": {
        "@type": "MediaObject", "contentUrl": tar, "encodingFormat": "application/x-gzip"}}
    assert got["ns/wells"]["@type"] == "Dataset" and got["ns/data"]["@type"] == "Readme"
    assert got["ns/code"]["encoding"]["encoding"] == {"@type": "MediaObject", "encodingFormat": "gzip", "contentSize": 9}
    assert got["ns/code"]["programmingLanguage"] == {"name": "python"} and "contentSize" not in got["ns/code"]["encoding"]
    assert [r["reason"] for r in described.rejects.collect()] == ["status 404 from http://x.example/gone"]


def test_scans(spark, tmp_path):
    (tmp_path / "pump").mkdir()
    (tmp_path / "pump" / "motor go.go").write_text("package pump")
    (tmp_path / "JSONLD").write_text('{"@context": "https://catalog.example",\n "@id": "a"}')
    (tmp_path / "pump" / "JSONLD").write_text("{broken")
    files = readers.scan_files(spark, str(tmp_path))
    assert sorted((r["path"], r["length"]) for r in files.filter("path like '%.go'").collect()) == [("pump/motor go.go", 12)]
    blobs, large = readers.scan_blobs(spark, str(tmp_path))
    assert blobs.filter("path like '%.go'").first()["content"] == b"package pump" and large.count() == 0
    fits, large = readers.scan_blobs(spark, str(tmp_path), limit=11)
    assert {r["path"]: r["reason"] for r in large.collect()}["pump/motor go.go"] == "too large for one row" and "content" not in large.columns
    assert fits.count() + large.count() == 3
    good, bad = readers.scan_manifests(spark, str(tmp_path))
    assert [r["path"] for r in good.collect()] == ["JSONLD"] and [r["path"] for r in bad.collect()] == ["pump/JSONLD"]


def test_tree_and_digest(spark):
    tree = {r["prefix"]: (r["n_files"], r["total_size"], r["height"]) for r in paths.path_tree(listing(spark, [("a/b/c", 1), ("a/d", 2)])).collect()}
    assert tree == {"a/": (2, 3, 2), "a/b/": (1, 1, 1)}
    rows = [("d/", "d/x", "aa"), ("d/", "d/y", "bb"), ("e/", "d/y", "bb"), ("e/", "d/x", "aa"), ("f/", "d/x", "bb"), ("f/", "d/y", "aa")]
    df = spark.createDataFrame(rows, "dir string, path string, sha1_hex string")
    got = {r["bundle"]: r["digest"] for r in paths.bundle_digest(df).collect()}
    assert got["d/"] == got["e/"] != got["f/"]
