"""Documents made of orders are dealt out before they are opened, by document."""

from __future__ import annotations

import datetime

import pytest

from linkcat.operators import graph
from linkcat.plans import views


@pytest.fixture
def orders(spark, tmp_path):
    rows = [(k, k % 7, "O", 10.5, datetime.date(2024, 1, 1), "1-URGENT") for k in range(40)] + [(None, 1, "O", 1.0, None, None)]
    spark.createDataFrame(
        rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
    ).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("build", [views.order_docs, views.scoped_docs])
def test_one_file_gives_many_tasks(spark, orders, build):
    docs = build(spark, orders)
    assert docs.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"]) == sorted(f"c{k % 7}/o{k}" for k in range(40))


def test_statements_stay_with_their_document(spark, orders):
    """Making the statements a set moves none of them: the only exchange is that of the orders."""
    plan = graph.statements(views.order_docs(spark, orders))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
