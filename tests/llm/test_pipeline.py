import random

from llm_rows import prose
from pyspark.sql import functions as F

import corpus_pipeline
from clearwell.llm.decontaminate import PassageIndex
from clearwell.llm.jaccard import jaccard_classes
from clearwell.llm.quality import score_quality
from clearwell.llm.toxicity import fit_toxicity, score_toxicity

SF = "/root/testdata/sf0.001"


def test_each_stage_decides_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5

    def ids(df):
        return sorted(r["doc_id"] for r in df.select("doc_id").collect())

    def step(name, docs):
        from clearwell.llm.common import written

        out = written(stages[name](spark, docs, SF), "test-stage")
        assert out.columns == docs.columns
        return out

    good = step("quality classifier", docs)
    assert ids(good) == ids(score_quality(docs, labels).where("quality.predicted = 1"))
    mild = step("toxicity", good)
    assert ids(mild) == ids(score_toxicity(good, fit_toxicity(good, labels)).where("toxicity.predicted = 0"))
    single = step("n-gram Jaccard join", mild)
    assert ids(single) == ids(jaccard_classes(mild).where("doc_id = class_id"))
    clean = step("benchmark decontamination", single)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    finder = PassageIndex.build(items, 8, 0.1).finder()
    assert ids(clean) == sorted(r["doc_id"] for r in single.collect() if not finder.find(r["text"]))
    mixed = corpus_pipeline.run(spark, SF)
    assert ids(mixed) == ids(clean) and 0 < len(ids(clean)) < docs.count()


def test_awkward_rows(spark, docs, no_docs):
    for table in (docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SF)
            assert out.columns == table.columns, name
            assert out.count() <= table.count()
    kept = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, SF).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(["None", *map(str, [*range(16)])])


def test_duplicates_go_by_row(spark):
    """An id with several texts is several documents; each copy goes, and nothing else."""
    rng = random.Random(21)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    near_a = " ".join([*a.split()[:-2], "other", "end"])
    rows = [(3, a), (5, a), (5, b), (5, b), (-7, c), (9, c), (9, near_a), (9, d), (None, a), (None, a), (11, None), (11, None), (12, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1))
    kept = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, SF)
    want = [(3, a), (5, b), (-7, c), (9, d), (None, a), (None, a), (11, None), (12, "")]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, want))
    assert kept.columns == docs.columns


def test_near_duplicates_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]

    def grams(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {i: grams(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            common = len(sets[i] & sets[j])
            if common and common >= 0.8 * (len(sets[i]) + len(sets[j]) - common):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    kept = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in ids if root(i) == i]
