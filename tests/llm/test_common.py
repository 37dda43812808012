from clearwell.llm.common import fold, labelled_sample


def test_sample_is_bounded_balanced_and_trained_only(spark):
    labels = spark.range(20_000).selectExpr("id AS doc_id", "CAST(id % 10 = 0 AS INT) AS toxic")
    extra = spark.createDataFrame([(None, 1), (3, None), (10, 0)], "doc_id long, toxic int")
    sample = labelled_sample(labels.unionByName(extra), "toxic", 4, 2, 2_000)
    count = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    assert count == {0: 1_000, 1: 1_000}
    assert sample.where(fold(sample["sample_id"], 4) == 2).isEmpty()
    again = labelled_sample(labels.repartition(7).unionByName(extra), "toxic", 4, 2, 2_000)
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, again.collect()))
    few = labelled_sample(labels.limit(0).unionByName(extra), "toxic", 4, 2, 2_000)
    assert {r["sample_id"] for r in few.collect()} <= {10}
