import random

import numpy as np
import pytest
from llm_rows import prose

import __spark_entry__ as entry
from clearwell.llm.quality import bradley_terry, features, score_quality

SF = "/root/testdata/sf0.1"


def test_weights_maximise_the_pair_likelihood():
    rng = np.random.default_rng(1)
    better, worse = rng.normal(0.5, 1, (400, 2)), rng.normal(0, 1, (400, 2))

    def loss(w):
        return np.log1p(np.exp(-(better - worse) @ w)).mean() + 0.5e-3 * w @ w

    w = bradley_terry(better, worse)
    for step in (np.array([0.05, 0]), np.array([0, 0.05]), np.array([-0.05, 0.05])):
        assert loss(w) < loss(w + step) and loss(w) < loss(w - step)


def test_features_of_blank_texts():
    blank = features(None)
    assert blank == features("") == features(" \n ") and sum(blank) == 1.0
    assert len(features("a b")) == len(blank) and features("a b")[-1] == 0.0


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        text = prose(rng, 60)
        good = int(i % 4 != 0)
        rows.append((i, text if good else " ".join(f"{w}###" for w in text.split()), good))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_scores_and_awkward_rows(spark, labelled, docs, no_docs):
    labels = labelled.select("doc_id", "quality").unionByName(
        spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int")
    )
    scored = score_quality(labelled.drop("quality"), labels)
    wrong = scored.join(labelled.selectExpr("doc_id", "quality AS label"), "doc_id").where("label != quality.predicted")
    assert scored.count() == 300 and wrong.count() == 0
    awkward = score_quality(docs, labels)
    assert awkward.columns == [*docs.columns, "_quality"] and awkward.count() == docs.count()
    assert awkward.where("_quality.score NOT BETWEEN 0 AND 1").count() == 0
    assert [r["_quality"]["held_out"] for r in awkward.where("doc_id IS NULL").collect()] == [False]
    assert score_quality(no_docs, labels).count() == 0
    only_good = score_quality(docs, labels.where("quality = 1"))
    assert only_good.where("_quality.predicted = 0").count() == 0
    assert score_quality(docs, labels.limit(0)).where("_quality.predicted = 0").count() == 0


def test_held_out_accuracy(spark):
    got = entry.queries()["op5_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = got.join(labels, "doc_id").where("held_out").select("quality", "predicted", "score").collect()
    assert sum(r["quality"] == r["predicted"] for r in rows) / len(rows) > 0.98
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
