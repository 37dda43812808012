import random

import numpy as np
import pytest
from llm_rows import prose

import __spark_entry__ as entry
from clearwell.llm.toxicity import (
    FuzzyLexicon,
    context_features,
    distinct_words,
    fit_toxicity,
    logistic,
    monotone_logistic,
    score_toxicity,
)

SF = "/root/testdata/sf0.1"


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j - 1] + (x != y), before[j] + 1, row[-1] + 1))
    return row[-1]


def test_automaton_equals_the_distance():
    rng = random.Random(2)
    terms = ["abcab", "abcabcabca", "bca", "cabba", "aabbccabca", "cccccc"]
    allowed = {t: 2 if len(t) >= 10 else 1 if len(t) >= 5 else 0 for t in terms}
    lexicon = FuzzyLexicon(terms)
    for _ in range(3000):
        word = "".join(rng.choices("abcd", k=rng.randint(0, 12)))
        near = [(edits(word, t), k) for k, t in enumerate(terms) if edits(word, t) <= allowed[t]]
        assert lexicon.match(word) == (min(near) if near else None), word


def test_stems_match_what_begins_with_them():
    lexicon = FuzzyLexicon(["rott*", "rotten"])
    assert lexicon.match("rottweil") == (0, 0) and lexicon.match("rott") == (0, 0)
    assert lexicon.match("xrott") is None and lexicon.match("roten") == (1, 1)


def test_quotation_counts_apart_from_abuse():
    lexicon = FuzzyLexicon(["villain"])
    abuse = context_features("You are a villain and a v1llain", lexicon, [1.0])
    quoted = context_features('The play says "what a villain" in act two', lexicon, [1.0])
    assert abuse[0] > 0 and abuse[2] > 0 and abuse[1] == abuse[3] == 0 and abuse[5] > 0
    assert quoted[0] == 0 and quoted[1] > 0 and quoted[5] == 0
    assert context_features(None, lexicon, [1.0]) == context_features("", lexicon, [1.0]) == [0.0] * 7


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        toxic = int(i % 5 == 0)
        bad = [rng.choice(["villain", "rotter", "blaggard"]) for _ in range(4)] if toxic else []
        words = prose(rng, 40).split() + bad
        rng.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_learns_terms_and_scores_awkward_rows(spark, labelled, docs, no_docs):
    model = fit_toxicity(labelled, labelled.select("doc_id", "toxic"))
    assert set(model.terms) == {"villain", "rotter", "blaggard"}
    scored = score_toxicity(labelled.drop("toxic"), model)
    wrong = scored.join(labelled.select("doc_id", "toxic"), "doc_id").where("toxic != toxicity.predicted")
    assert wrong.count() == 0
    awkward = score_toxicity(docs, model)
    assert awkward.columns == [*docs.columns, "_toxicity"]
    rows = awkward.collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["_toxicity"]["score"] < 0.3 and r["_toxicity"]["predicted"] == 0 for r in rows)
    assert [r["_toxicity"]["held_out"] for r in rows if r["doc_id"] is None] == [False]
    assert score_toxicity(no_docs, model).count() == 0


def test_without_labels_nothing_is_learned(spark, labelled, docs):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    model = fit_toxicity(docs, none)
    assert model.terms == () and score_toxicity(docs, model).where("_toxicity.predicted = 1").count() == 0


def test_held_out_accuracy(spark):
    got = entry.queries()["op3_toxicity"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    hit = sum(r["toxic"] and r["predicted"] for r in rows)
    assert hit / sum(r["toxic"] for r in rows) > 0.85 and hit / sum(r["predicted"] for r in rows) > 0.9
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.fixture(scope="module")
def contextual(spark):
    """Abuse, some of it misspelled, and clean texts that quote the same words."""
    rng = random.Random(12)
    bad, rows = ["villain", "rotter", "blaggard"], []
    for i in range(600):
        words = prose(rng, 30).split()
        if i % 4 == 0:
            for at in rng.sample(range(30), 3):
                word = rng.choice(bad)
                cut = rng.randrange(1, len(word))
                words[at] = word if rng.random() < 0.5 else word[:cut] + rng.choice("qxzwk") + word[cut:]
        elif i % 20 == 1:
            words.insert(5, f'"{prose(rng, 2)} {rng.choice(bad)}"')
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_misspelling_raises_and_quotation_lowers_the_fitted_score(contextual):
    labels = contextual.select("doc_id", "toxic")
    model = fit_toxicity(contextual, labels)
    assert all(w >= 0 for w in model.weights) and model == fit_toxicity(contextual, labels)
    score = model.scorer()
    assert set(model.terms) == {"villain", "rotter", "blaggard"}
    plain = "amber birch cedar delta ember fjord grove heath {} {} {}"
    texts = [("islet", "jetty", "knoll"), ("vilain", "jetty", "knoll"), ("vilain", "rottter", "knoll"), ("vilain", "rottter", "villain")]
    levels = [score(plain.format(*t)) for t in texts]
    assert levels == sorted(set(levels))
    assert score(plain.format('"the', "villain", 'jetty"')) < score(plain.format("the", "villain", "jetty"))
    held_out = score_toxicity(contextual.drop("toxic"), model).where("toxicity.held_out").join(labels, "doc_id")
    assert held_out.where("toxic != toxicity.predicted").count() <= 0.05 * held_out.count()


def test_weights_are_monotone():
    rng = np.random.default_rng(3)
    x = rng.exponential(size=(500, 7))
    y = (x[:, 0] + 2 * x[:, 1] - x[:, 2] - 2 * x[:, 5] + rng.normal(size=500) > 1).astype(float)
    free, _ = logistic(x, y)
    w, intercept = monotone_logistic(x, y)
    assert free[2] < 0 and free[5] < 0 and (w >= 0).all() and w[1] <= w[0] and w[3] <= w[2] and w[0] > 0

    def loss(w):
        z = np.clip(x @ w + intercept, -30, 30)
        return np.log1p(np.exp(z)).mean() - (y * z).mean()

    assert loss(w) < loss(np.zeros(7))


def test_ordinary_words_are_no_misspellings():
    lexicon = FuzzyLexicon(["villain", "rotter"], ordinary=["villein", "rotter"])
    assert lexicon.match("villein") is None and lexicon.match("villian") is None
    assert lexicon.match("vilain") == (1, 0) and lexicon.match("rotter") == (0, 1)
    long_word = "x" * 100_000
    assert lexicon.match(long_word) is None and long_word not in lexicon.known


def test_quotation_is_tracked_along_the_whole_line():
    lexicon = FuzzyLexicon(["villain"])
    far = "grove " * 2000
    for text, quoted in (
        (f'"{far} villain {far}"', True), (f'"{far}" villain {far}"', False), (f'"{far} villain {far}', False),
        (f'"{far}\nvillain "', False), (f"> {far} villain", True), (f'«a» {far} “villain”', True),
    ):
        x = context_features(text, lexicon, [1.0])
        assert (x[1] > 0) == quoted and (x[0] > 0) != quoted, text[:10]


def test_near_copies_fold_by_label_and_least_id(spark):
    text = "amber birch cedar delta ember fjord grove heath islet jetty"
    rows = [(i, text, i % 2) for i in range(20)] + [(99, "other words than those", 1)]
    sample = spark.createDataFrame(rows, "sample_id long, text string, label int")
    got = distinct_words(sample).collect()
    assert sorted(r["label"] for r in got) == [0, 1, 1]
