"""Toxicity and quality on held-out rows; word features of odd texts."""

import random

import numpy as np
import pyarrow as pa
import pytest
from linkcat.llm import ordinal, toxicity
from linkcat.llm.registry import QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"
BAD = {"en": ["idiot", "fool", "scum"], "de": ["achlichbe", "achlichst", "achlichung"]}


def labelled(n=1500, seed=1):
    rng = random.Random(seed)
    plain = {lang: [lang + str(i) for i in range(300)] for lang in BAD}
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "de"])
        words = [rng.choice(plain[lang]) for _ in range(rng.randrange(5, 80))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD[lang]))
        rows.append((i, " ".join(words), lang, toxic))
    return rows


def auc(scores, y):
    order = np.argsort(np.argsort(scores)) + 1
    y = np.asarray(y)
    return (order[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_toxicity_on_held_out_rows_and_odd_texts(spark):
    rows = labelled()
    docs = spark.createDataFrame([(d, t, lang, 1.5) for d, t, lang, _ in rows], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(d, y) for d, _, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(-1, None, None, 0.0), (-2, "", "xx", 0.0), (None, " \n", "en", 0.0), (-3, "a", "en", 0.0), (-4, "fool " * 30_000, "en", 0.0)], docs.schema)
    scored = toxicity.score(docs.unionByName(odd), model).select("row.doc_id", "score", toxicity.is_held_out(F.col("row.doc_id")).alias("held"))
    got = {r["doc_id"]: (r["score"], r["held"]) for r in scored.collect()}
    truth = {d: y for d, _, _, y in rows}
    held = [d for d in truth if got[d][1]]
    assert len(held) > 250 and all(0 <= s <= 1 for s, _ in got.values())
    assert auc([got[d][0] for d in held], [truth[d] for d in held]) > 0.98
    assert np.mean([(got[d][0] >= 0.3) == truth[d] for d in held]) > 0.95
    assert got[-1][0] == got[-2][0] == got[None][0] and got[-4][0] > 0.5
    kept = toxicity.clean(docs.unionByName(odd), model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {-1, -2, None, -3}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_thresholds_come_from_all_labelled_rows(spark):
    rows = labelled()
    docs = spark.createDataFrame([(d, t, lang) for d, t, lang, _ in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(d, y) for d, _, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, sample=150)
    assert set(model.thresholds) == {"en", "de"}
    scored = toxicity.score(docs, model).select("row.*", "score", toxicity.is_held_out(F.col("row.doc_id")).alias("held")).where("not held").collect()
    truth = {d: y for d, _, _, y in rows}
    for lang, limit in model.thresholds.items():
        mine = [(r["score"], truth[r["doc_id"]]) for r in scored if r["lang"] == lang]
        f1 = lambda t: 2 * sum(y for s, y in mine if s >= t) / (sum(s >= t for s, _ in mine) + sum(y for _, y in mine))  # noqa: E731, B023
        assert f1(limit) >= max(f1(t) for t in np.arange(0.05, 0.951, 0.001)) - 0.005


def test_toxicity_gradients_do_not_cross_texts():
    a, b = toxicity.features(pa.array(["x y", None, "idiot z"])), toxicity.features(pa.array(["x y"]))
    model = toxicity.train(pa.array([t for _, t, _, _ in labelled(400)]), np.array([float(y) for *_, y in labelled(400)]), [lang for _, _, lang, _ in labelled(400)])
    assert np.isclose(model.logits(*a)[0], model.logits(*b)[0])


def test_one_class_only_rejects_nothing(spark):
    docs = spark.createDataFrame([(i, "some text") for i in range(40)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, 0) for i in range(40)], "doc_id long, toxic int"))
    assert toxicity.clean(docs, model).count() == 40
    assert toxicity.clean(docs, toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))).count() == 40


def test_ordinal_grades(spark):
    rng = random.Random(2)
    rows = []
    for i in range(1600):
        grade = rng.randrange(4)
        good = [f"g{rng.randrange(60)}" if rng.random() < 0.15 + 0.22 * grade else f"b{rng.randrange(60)}" for _ in range(rng.randrange(20, 60))]
        rows.append((i, " ".join(good), grade))
    docs = spark.createDataFrame([(d, t, 0.0) for d, t, _ in rows] + [(None, None, 0.0), (-1, "", 0.0), (-1, "", 0.0)], "doc_id long, text string, tail double")
    labels = spark.createDataFrame([(d, g) for d, _, g in rows] + [(3, None)], "doc_id long, quality int")
    model = ordinal.fit(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 3
    got = ordinal.grade(docs, model, at_least=2).select("row.doc_id", "expected_grade", "tail", toxicity.is_held_out(F.col("row.doc_id")).alias("held")).collect()
    truth = {d: g for d, _, g in rows}
    held = [r for r in got if r["held"] and r["doc_id"] in truth]
    assert np.corrcoef([r["expected_grade"] for r in held], [truth[r["doc_id"]] for r in held])[0, 1] > 0.85
    assert np.mean([(r["tail"] >= 0.5) == (truth[r["doc_id"]] >= 2) for r in held]) > 0.85
    assert len(got) == len(rows) + 3 and len({r["tail"] for r in got if r["doc_id"] in (None, -1)}) == 1
    kept = ordinal.select(docs, model, at_least=2)
    assert kept.columns == docs.columns and 0 < kept.count() < len(got)
    assert ordinal.grade(docs.limit(0), model).count() == 0
    flat = ordinal.fit(docs, labels.where("quality = 1"))
    assert {(r["expected_grade"], r["tail"]) for r in ordinal.grade(docs, flat).collect()} == {(1.0, 1.0)}


@pytest.mark.skipif(not __import__("os").path.isdir(SF), reason="no benchmark tables here")
def test_models_on_the_tables(spark):
    labels = {r["doc_id"]: (r["toxic"], r["quality"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    toxic = [r for r in QUERIES["op4_toxicity"](spark, SF).collect() if r["held_out"] and r["doc_id"] in labels]
    truth = np.array([labels[r["doc_id"]][0] for r in toxic])
    assert auc([r["score"] for r in toxic], truth) > 0.95
    said = np.array([r["predicted"] for r in toxic])
    assert (said & truth).sum() / truth.sum() > 0.8 and (said & (1 - truth)).sum() / (1 - truth).sum() < 0.03
    good = [r for r in QUERIES["op8_ordinal_quality"](spark, SF).collect() if r["held_out"] and r["doc_id"] in labels]
    assert auc([r["expected_grade"] for r in good], [labels[r["doc_id"]][1] for r in good]) > 0.95
