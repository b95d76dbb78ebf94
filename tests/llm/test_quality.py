import math
import random

import numpy as np
import pytest

from rivalry.llm import quality
from tests.llm.conftest import ODD

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed):
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows, labels = [], []
    for k in range(n):
        split = pick.choices(words, k=pick.randint(20, 80))
        good, rude = pick.random() < 0.8, pick.random() < 0.3
        if rude:
            split[pick.randrange(len(split))] = pick.choice(["vile", "nasty", "awful"])
        if not good:
            split = [w + pick.choice(["***", "&&&"]) for w in split]
        rows.append((k, " ".join(split)))
        labels.append((k, int(good), int(rude)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus(1500, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return quality.fit(docs, spark.createDataFrame(labels, LABELS))


def test_held_out_accuracy(documents, fitted):
    rows, labels = corpus(500, 2)
    rated = quality.select(quality.rate(documents(rows), fitted))
    kept = {r.doc_id: r.kept for r in rated.collect()}
    right = [kept[i] == (q == 1 and t == 0) for i, q, t in labels]
    assert np.mean(right) > 0.97


def test_grades_rise_with_the_rating(documents, fitted):
    assert (np.diff(fitted.thresholds) > 0).all()
    rows = [(1, "w1 w2 w3 w4 " * 9), (2, "w1 w2 nasty w4 " * 9), (3, "w1*** w2&&& nasty*** w4*** " * 9)]
    grade = {r.doc_id: r.expected_grade for r in quality.rate(documents(rows), fitted).collect()}
    assert grade[1] > grade[2] > grade[3]


def test_gradient():
    pick = np.random.default_rng(0)
    features = [(np.sort(pick.choice(50, 8, False)).astype(np.int32), pick.random(8).astype(np.float32)) for _ in range(60)]
    grades = pick.integers(0, 3, 60)
    model = quality.fit_model(features, grades, 3, penalty=1e-3)

    def loss(weights, cuts):
        total = 0.0
        for (i, v), g in zip(features, grades, strict=True):
            z = np.r_[-np.inf, cuts, np.inf] - weights[i] @ v
            p = 1 / (1 + np.exp(-z))
            total -= np.log(p[g + 1] - p[g])
        return total / 60 + 5e-4 * weights @ weights

    weights, cuts = model.weights.astype(float), model.thresholds
    best = loss(weights, cuts)
    for _ in range(40):
        step = np.zeros(quality.DIM)
        step[:50] = pick.normal(size=50) * 0.05 * (weights[:50] != 0)
        assert loss(weights + step, cuts) > best - 1e-4


def test_odd_rows(documents, spark, fitted):
    rated = quality.rate(documents(ODD), fitted)
    assert rated.count() == len(ODD) and all(0 <= r.tail <= 1 for r in rated.toPandas().itertuples())
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (4, 1, 0), (4, 0, 1)], LABELS)
    assert quality.fit(documents(ODD), labels) is not None
    assert quality.fit(documents([]), labels) is None
    assert quality.fit(documents(ODD), labels.limit(0)) is None
    unknown = quality.select(quality.rate(documents(ODD), None)).collect()
    assert len(unknown) == len(ODD) and all(r.kept and r.tail is None for r in unknown)
    assert quality.rate(documents([]), fitted).count() == 0


def rare_language(n, seed):
    """A large language with rude words, a rare one whose rude words are in one row of 960 each."""
    pick = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        rare = k % 30 == 0
        split = pick.choices([f"{'r' if rare else 'w'}{j}" for j in range(200)], k=30)
        rude = k % 240 == 0 if rare else pick.random() < 0.3
        if rude:
            split[pick.randrange(30)] = pick.choice(["r901", "r902", "r903", "r904"] if rare else ["w901", "w902"])
        rows.append((k, " ".join(split), "rr" if rare else "ww"))
        labels.append((k, 1, int(rude)))
    return rows, labels


def test_rude_words_of_a_rare_language_count(spark):
    rows, labels = rare_language(36_000, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = quality.fit(docs, spark.createDataFrame(labels, LABELS))
    more, marks = rare_language(36_000, 4)
    rated = quality.select(quality.rate(spark.createDataFrame(more, docs.schema), model))
    kept = {r.doc_id: r.kept for r in rated.collect()}
    rude = [kept[i] for (i, _, lang), (_, _, toxic) in zip(more, marks, strict=True) if lang == "rr" and toxic]
    assert len(rude) == 150 and np.mean(rude) < 0.1
    clean = [kept[i] for i, _, toxic in marks if not toxic]
    assert np.mean(clean) > 0.95


def test_sample_takes_low_grades_of_rare_languages_first(spark):
    sizes = {("a", 2): 9000, ("a", 1): 900, ("b", 2): 600, ("b", 1): 30, ("b", 0): 3}
    got = quality.quotas(sizes, 1000)
    assert got == {("b", 0): 3, ("b", 1): 30, ("a", 1): 467, ("b", 2): 250, ("a", 2): 250}
    assert quality.quotas({("a", 2): 10, ("a", 0): 5000}, 1000) == {("a", 0): 990, ("a", 2): 10}
    rows = [(k, "t", "b" if k % 100 == 0 else "a") for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(4000)], LABELS)
    chosen = quality.choose(docs, labels, 400).collect()
    assert len(chosen) == 400 and {r.doc_id for r in chosen} >= set(range(0, 4000, 100))
    assert abs(sum(r.n for r in chosen) - 4000) < 400


def test_fit_agrees_with_an_independent_optimiser():
    """Dense likelihood written out, minimised by plain descent on numerical gradients."""
    pick = np.random.default_rng(5)
    n, dim, penalty = 300, 4, 0.01
    x = pick.integers(0, 3, (n, dim)).astype(float)
    chance = 1 / (1 + np.exp(np.array([[-1.0], [1.5]]) - x @ np.array([0.8, -0.6, 0.3, 0.0])))
    grades = (pick.random(n) < chance[0]).astype(int) * (1 + (pick.random(n) < chance[1] / chance[0]))
    features = [(np.flatnonzero(row).astype(np.int32), row[np.flatnonzero(row)].astype(np.float32)) for row in x]
    counts = pick.integers(1, 4, n).astype(float)

    def loss(p):
        total = penalty / 2 * sum(w * w for w in p[:dim])
        for row, g, c in zip(x, grades, counts, strict=True):
            above = [1.0, *(1 / (1 + math.exp(t - float(row @ p[:dim]))) for t in p[dim:]), 0.0]
            total -= c / counts.sum() * math.log(above[g] - above[g + 1])
        return total

    p = np.array([0.0] * dim + [-1.0, 1.0])
    for _ in range(250):
        slope = np.array([(loss(p + e) - loss(p - e)) / 2e-5 for e in 1e-5 * np.eye(len(p))])
        p = p - 1.0 * slope
    model = quality.fit_model(features, grades, 3, penalty=penalty, counts=counts)
    got = np.r_[model.weights[:dim], model.thresholds]
    assert abs(loss(got) - loss(p)) < 1e-4 and np.abs(got - p).max() < 0.05
    # the chances by their definition
    score = model.score(*features[0])
    want = [1 / (1 + math.exp(t - float(x[0] @ got[:dim]))) for t in got[dim:]]
    assert np.allclose(model.at_least(score), want, atol=1e-5)


def test_very_long_texts(documents, spark, fitted):
    words = " ".join(f"word{k % 5000}" for k in range(500_000))
    rows = quality.rate(documents([(1, words), (2, "x" * 3_000_000), (3, words)]), fitted).collect()
    assert all(0 <= r.tail <= 1 for r in rows) and rows[0].tail == rows[2].tail
