"""The stages one after the other, each against the brute-force form on what it got; every query against its SQL."""

import os

import corpus_pipeline
import check
import duckdb
import helpers
import pytest
from linkcat.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no benchmark tables here")


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    seen = [rows(docs)]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == columns, name
            seen.append(rows(docs))
    assert set(seen[1]) < set(seen[0])
    assert sorted(seen[2]) == sorted((d, t) for (d, t), (_, _, c) in zip(seen[1], helpers.near_duplicates(seen[1], 5), strict=True) if c == d)
    assert sorted(seen[3]) == sorted((d, kept if gone else t) for (d, t), (_, _, gone, kept) in zip(seen[2], helpers.cut_repeats(seen[2]), strict=True))
    assert sorted(seen[4]) == sorted((d, t) for (d, t), (_, _, hit, _) in zip(seen[3], helpers.contaminated(seen[3], items), strict=True) if not hit)
    last = docs.collect()
    assert sorted(r["doc_id"] for r in last) == sorted(d for d, _ in seen[4]) and all(r["round_trip"] for r in last)


def test_near_duplicates_keep_one_row_of_a_document(spark):
    long = "one two three four five six seven eight nine ten eleven twelve"
    told = [(2, long, "x"), (2, long, "y"), (1, long, "x"), (1, long, "x"), (3, None, "x"), (3, None, "z"), (4, "", "x"), (None, long, "x"), (None, long, "x"), (5, "other words", "x"), (5, "two texts", "x")]
    docs = spark.createDataFrame(told, "doc_id long, text string, g string")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(map(str, rows(got))) == sorted(map(str, [(1, long), (3, None), (4, ""), (None, long), (None, long), (5, "other words"), (5, "two texts")]))
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), SF).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    db = duckdb.connect()
    for t in check.TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), db.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.digest(got)[0] == check.digest(want)[0]
