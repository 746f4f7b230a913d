"""Queries that read their whole tables."""

import os

import pytest
from linkcat.plans import describe, graphs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no benchmark tables here")


def test_headers_of_every_page_are_read(spark):
    got = describe.parsed_headers_of_all(spark, SF).select("page_id")
    assert sorted(got.collect()) == sorted(spark.read.parquet(f"{SF}/pages.parquet").select("page_id").collect())


def test_patterns_see_blank_subjects(spark, monkeypatch):
    seen = []
    match = graphs.graph.match_bgp
    monkeypatch.setattr(graphs.graph, "match_bgp", lambda rows, *rest: seen.append(rows) or match(rows, *rest))
    graphs.matched_graph(spark, SF)
    assert seen[0].filter("subject like '\\_:%'").count() > 0
