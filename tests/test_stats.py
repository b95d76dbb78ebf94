import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from rivalry.operators import sample, stats


def predictions(spark):
    data = [("train", 1, 1), ("train", 1, 0), ("train", 0, 1), ("train", 0, 0), ("train", 1, 1),
            ("test", 0, 0), ("test", 1, 0)]
    return spark.createDataFrame(data, "split string, y int, p int")


def test_metrics(spark):
    got = stats.classification_metrics(predictions(spark), "y", "p", "split")
    table = stats.metrics_table(stats.metrics_long(got, "split"), "split").collect()
    assert [r["split"] for r in table] == ["train", "test"]
    assert table[0].asDict() == {
        "split": "train", "accuracy": 0.6, "f1_score": 0.6667, "precision": 0.6667, "recall": 0.6667,
    }
    assert table[1].asDict() == {
        "split": "test", "accuracy": 0.5, "f1_score": 0.0, "precision": 0.0, "recall": 0.0,
    }


def test_confusion_lists_empty_cells(spark, rows):
    df = predictions(spark).where("split = 'test'")
    assert rows(stats.confusion_matrix(df, "y", "p")) == [(0, 1, 0), (1, 1, 0)]


def test_conditional_rate(spark, rows):
    df = spark.createDataFrame([(1, 2, 1), (2, 1, 1), (1, 3, 0), (None, 1, 1)], "a int, b int, won int")
    got = stats.conditional_rate(df, {"less": F.col("a") < F.col("b"), "never": F.lit(False)}, "won")
    assert rows(got) == [("less", 2, 0.5), ("never", 0, None)]


def pearson(pairs):
    n = len(pairs)
    mx, my = sum(x for x, _ in pairs) / n, sum(y for _, y in pairs) / n
    sxy = sum((x - mx) * (y - my) for x, y in pairs)
    return sxy / math.sqrt(sum((x - mx) ** 2 for x, _ in pairs) * sum((y - my) ** 2 for _, y in pairs))


def test_correlations_and_f_scores(spark):
    rng = random.Random(1)
    data = [(rng.random(), None if i % 4 == 0 else rng.random(), 0.1, i % 2) for i in range(60)]
    df = spark.createDataFrame(data, "a double, b double, fixed double, y int")
    got = {r["feature"]: r["correlation"] for r in
           stats.correlation_with_target(df, ["a", "b", "fixed", "y"], "y").collect()}
    assert got["a"] == pytest.approx(pearson([(d[0], d[3]) for d in data]))
    known = [(d[1], d[3]) for d in data if d[1] is not None]
    assert got["b"] == pytest.approx(pearson(known))
    assert got["fixed"] is None and got["y"] == pytest.approx(1.0)
    scores = {r["feature"]: r["f_score"] for r in stats.f_scores(df, ["a", "b", "fixed"], "y").collect()}
    r = got["b"]
    assert scores["b"] == pytest.approx(r * r / (1 - r * r) * (len(known) - 2))
    assert scores["fixed"] is None


def test_top_bottom(spark):
    df = spark.createDataFrame([(f"f{i:02}", float(i)) for i in range(30)], "feature string, feature_coef double")
    got = stats.top_bottom(df, "feature", "feature_coef", 3).collect()
    assert [r["feature"] for r in got] == ["f29", "f28", "f27", "...", "f02", "f01", "f00"]
    assert [r["position"] for r in got] == list(range(1, 8)) and got[3]["feature_coef"] is None


def tag(seed, *keys):
    return hashlib.md5(":".join([str(seed), *map(str, keys)]).encode()).hexdigest()


@pytest.mark.parametrize("n,frac", [(0, 0.25), (1, 0.25), (10, 0.25), (9146, 0.25), (100, 0.0), (100, 1.0)])
def test_exact_split(spark, n, frac):
    df = spark.range(n).withColumn("half", F.col("id") % 2)
    part, rest = sample.exact_split(df, ["id", "half"], frac, 42)
    got = {r["id"] for r in part.collect()}
    ordered = sorted(range(n), key=lambda i: tag(42, i, i % 2))
    assert got == set(ordered[: round(frac * n)])
    assert {r["id"] for r in rest.collect()} == set(range(n)) - got
    if n == 9146:
        assert len(got) == 2286


def test_split_goes_deeper_for_big_buckets(spark, monkeypatch):
    monkeypatch.setattr(sample, "SMALL", 3)
    monkeypatch.setattr(sample, "DIGITS", 1)
    part, _ = sample.exact_split(spark.range(500), ["id"], 0.3, 1)
    assert {r["id"] for r in part.collect()} == set(sorted(range(500), key=lambda i: tag(1, i))[:150])


def test_split_is_a_plain_filter(spark):
    part, rest = sample.exact_split(spark.range(1000), ["id"], 0.25, 42)
    for df in (part, rest):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan and "Join" not in plan


@pytest.mark.parametrize("small", [10_000, 2])
def test_split_of_tied_and_equal_rows(spark, monkeypatch, small):
    monkeypatch.setattr(sample, "SMALL", small)
    # 60 equal rows, and keys of several rows
    data = [(1, "same")] * 60 + [(2, f"row {i}") for i in range(60)] + [(3, None)] * 3
    df = spark.createDataFrame(data, "id int, text string")
    for seed in range(20):
        part, rest = sample.exact_split(df, ["id"], 0.25, seed)
        a, b = (sorted(map(str, x.collect())) for x in (part, rest))
        assert len(a) == round(0.25 * len(data))
        assert sorted(a + b) == sorted(map(str, df.collect()))


def test_column_totals(spark, rows):
    df = spark.createDataFrame([(1, 0.0), (2, None)], "a int, b double")
    assert rows(stats.column_totals(df, ["a", "b"])) == [
        ("a", 2, 2, 3.0, 1.5, True), ("b", 2, 1, 0.0, 0.0, False),
    ]


def test_exact_split_hashes_rows_of_one_key_only(spark):
    """A row whose key tells its side is not hashed: of the others, no column can be read."""
    import hashlib

    tag = {k: hashlib.md5(f"42:{k}".encode()).hexdigest() for k in range(200)}
    last = sorted(tag.values())[50 - 1]
    near = [k for k in tag if tag[k][: sample.DIGITS] == last[: sample.DIGITS]]
    unread = F.when(~F.col("id").isin(near), F.raise_error(F.lit("read")).cast("int"))
    df = spark.range(200).withColumn("x", unread)
    part, rest = sample.exact_split(df, ["id"], 0.25)
    assert sorted(r["id"] for r in part.select("id").collect()) == [k for k in tag if tag[k] <= last]
    assert rest.select("id").count() == 150
