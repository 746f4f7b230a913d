import json

from linkcat.streaming.publish import read_published, stream_archive, stream_publish
from pyspark.sql import functions as F


def test_stream_publish_and_archive(spark, tmp_path):
    inbox, store, blobs = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "blobs")
    inbox.mkdir()
    put = lambda name, doc: (inbox / name).write_text(json.dumps(doc))
    base = {"@context": "https://catalog.example", "@id": "a"}
    put("1", {**base, "version": "1.0.0"})
    put("2", {"@id": "a", "version": "1.0.0"})
    (inbox / "3").write_text("{broken")
    grants = lambda: spark.createDataFrame([("a", "ann")], "namespace string, username string")
    publish = lambda: stream_publish(spark, str(inbox), store, str(tmp_path / "c1"), grants, "ann").awaitTermination()
    archive = lambda: stream_archive(spark, str(inbox), blobs, str(tmp_path / "c2")).awaitTermination()
    publish()
    archive()
    put("4", {**base, "version": "1.0.0"})
    put("5", {**base, "version": "1.1.0"})
    publish()
    archive()
    put("6", {**base, "@id": "b", "name": "old"})
    publish()
    put("7", {**base, "@id": "b", "name": "new"})
    publish()
    keys = sorted((r["doc_id"], r["version"], r["batch_id"]) for r in spark.read.parquet(f"{store}/documents").filter("version is not null").collect())
    assert keys == [("a", "1.0.0", 0), ("a", "1.1.0", 1)]
    got = read_published(spark, store).filter("version is null").select("doc_id", F.try_variant_get("body", "$.name", "string").alias("n"))
    assert [tuple(r) for r in got.collect()] == [("b", "new")]
    outcomes = [(r["batch_id"], r["outcome"]) for r in spark.read.parquet(f"{store}/outcomes").collect()]
    assert sorted(outcomes) == [(0, "created"), (0, "invalid"), (1, "conflict"), (1, "created"), (2, "created"), (3, "updated")]
    assert spark.read.parquet(f"{store}/rejects").first()["reason"] == "malformed JSON"
    assert [tuple(r)[:2] for r in spark.read.parquet(f"{store}/maintainers").collect()] == [("b", "ann")]
    assert spark.read.parquet(blobs).count() == 4
