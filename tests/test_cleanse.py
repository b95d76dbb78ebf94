from collections import Counter

import pytest
from pyspark.sql import functions as F

from rivalry.operators import cleanse as C
from rivalry.operators import encode as E
from rivalry.operators.columns import listed_names
from rivalry.plans.cleansing import clean_contests


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Sig. str.", "Fight ID", "Event Name"])
    named = C.normalize_column_names(df)
    assert named.columns == ["sig_str", "fight_id", "event_name"]
    assert C.prefix_unless(named, "fight_", ["event_", "fight_"]).columns == [
        "fight_sig_str", "fight_id", "event_name",
    ]
    assert C.prefix_columns(named, "x_", ["fight_id"]).columns == ["x_sig_str", "fight_id", "x_event_name"]
    assert C.drop_matching(df, "Event").columns == ["Sig. str.", "Fight ID"]


def test_wide_to_long(spark, rows):
    """Shared columns repeat; a column that one side lacks is null for it."""
    df = spark.createDataFrame(
        [("f1", "n1", "n2", 3)], ["Fight ID", "Fighter1 Name", "Fighter2 Name", "Fighter1_Round 1_Sig. str."]
    )
    got = C.wide_to_long(df, ["Fighter1", "Fighter2"], "Fighter", "slot")
    assert got.columns == ["Fight ID", "slot", "Fighter Name", "Fighter_Round 1_Sig. str."]
    assert rows(got) == [("f1", 1, "n1", 3), ("f1", 2, "n2", None)]


def test_decided_only(spark, rows):
    data = [(1, "W", "L"), (2, "L", "W"), (3, "D", "D"), (4, "NC", None), (5, None, "W")]
    df = spark.createDataFrame(data, ["id", "Fighter1 Status", "Fighter2 Status"])
    kept = C.decided_only(df, ["Fighter1 Status", "Fighter2 Status"])
    assert rows(kept, "id") == [(1,), (2,), (5,)]
    wins = df.select("id", C.is_win(F.col("Fighter1 Status")).alias("w"))
    assert dict(rows(wins)) == {1: True, 2: False, 3: False, 4: False, 5: False}


def texts(spark):
    data = [("10%", "1 of 2", "1:30", "7"), (None, None, "0:05", "8.5"), ("3%", "4 of 9", None, None)]
    return spark.createDataFrame(data, "a string, b string, c string, `d.e` string")


def test_detection(spark, rows):
    got = C.detect_formats(texts(spark), ["a", "b", "c", "d.e"])
    assert rows(got) == [
        ("a", True, False, False),
        ("b", False, True, False),
        ("c", False, False, True),
        ("d.e", False, False, False),
    ]


def test_convert(spark, rows):
    got = C.convert_detected(texts(spark), ["a", "b", "c", "d.e"])
    assert got.columns == ["a", "b_landed", "b_total", "c_seconds", "d.e"]
    assert rows(got) == [
        (0.03, 4.0, 9.0, None, None), (0.1, 1.0, 2.0, 90.0, 7.0), (None, None, None, 5.0, 8.5),
    ]
    junk = spark.createDataFrame([("x",)], "a string")
    assert rows(C.convert_detected(junk, ["a"], strict=False)) == [(None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        C.convert_detected(junk, ["a"]).collect()


def test_percent_only(spark):
    got = C.convert_percent(texts(spark), ["a", "b"])
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["double", "string", "string", "string"]


def test_domain(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string")
    assert C.category_domain(df, "c") == ["a", "b"]
    with pytest.raises(ValueError, match="not a category"):
        C.category_domain(df, "c", max_values=1)


def test_one_hot_keeps_the_domain(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, c string")
    got = E.one_hot(df, {"c": ["a", "b"]})
    assert got.columns == ["id", "c_a", "c_b"]
    assert rows(got) == [(1, 1, 0), (2, 0, 0), (3, 0, 0)]


def test_types(spark, rows):
    df = spark.createDataFrame([(1, True, "x", None)], "a int, b boolean, c string, d double")
    assert E.columns_of_type(df, "number") == ["a", "d"]
    assert E.columns_of_type(df, "bool") == ["b"]
    assert E.columns_of_type(df, "other") == ["c"]
    assert rows(E.bools_to_int(df)) == [(1, 1, "x", None)]
    assert rows(E.numeric_frame(df)) == [(1, 1, 0.0)]


def gaps(spark):
    data = [(1, None, None, 1.0), (2, 4.0, None, None), (3, None, 6.0, None), (4, None, 8.0, None)]
    return spark.createDataFrame(data, "id int, round4_x double, half double, other double")


def test_null_shares(spark, rows):
    got = dict(rows(E.null_fractions(gaps(spark))))
    assert got == {"id": 0.0, "round4_x": 0.75, "half": 0.5, "other": 0.75}
    assert E.sparse_columns(gaps(spark), 0.5) == ["round4_x", "other"]  # a half is not above a half
    assert E.drop_sparse(gaps(spark), 0.5, ["round4", "round5"]).columns == ["id", "half", "other"]
    assert E.drop_sparse(gaps(spark), 0.5, ["nothing"]).columns == gaps(spark).columns


def test_fill_mean(spark, rows):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, None), (3, 4.0, None)], "id int, x double, y double")
    assert rows(E.fill_mean(df, ["x", "y"])) == [(1, 2.0, None), (2, 3.0, None), (3, 4.0, None)]


def test_require_all(spark, rows):
    assert rows(E.require_all(gaps(spark), ["half"]), "id") == [(3,), (4,)]


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_codes_of_a_category_of_many_values(spark, hot_rows):
    values = [f"v{k % 997}" for k in range(4000)] + ["v3"] * 5 + [None] * 7
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, kind string")
    count = Counter(v for v in values if v)
    want = sorted(count, key=lambda v: (-count[v], v))
    codes = E.category_codes(df, "kind", hot_rows)
    assert {r["value"]: (r["code"], r["n"]) for r in codes.collect()} == {v: (i, count[v]) for i, v in enumerate(want)}
    coded = E.encode_category(df, "kind", codes, "code")
    assert [r["code"] for r in coded.orderBy("id").collect()] == [want.index(v) if v else None for v in values]
    for vector, code in E.one_hot_vectors(coded, "code", "hot", len(want)).select("hot", "code").collect():
        assert vector.size == len(want) and vector.indices.tolist() == ([] if code is None else [code])


def test_names_of_columns_are_bounded(spark):
    names = spark.createDataFrame([("b",), ("a",), ("b",)], "name string")
    assert listed_names(names, 2) == ["a", "b"]
    with pytest.raises(ValueError, match="long form"):
        listed_names(names, 1)


def test_raw_contests_are_evaluated_once(spark, rows):
    """The formats and the typed rows come from one reading of the raw table."""
    shared = ["Fight ID", "Event Url", "Event Name", "Bout", "Method", "Round"]
    sides = [f"Fighter{i} {c}" for i in (1, 2) for c in ("Name", "Url", "Status")]
    raw = spark.createDataFrame(
        [("f", "e/1", "E", "Fly Bout", "KO", "2", "A", "p/a", "W", "B", "p/b", "L", "10%")],
        [*shared, *sides, "Fighter1_Overall_KD"],
    ).withColumn("Fighter2_Overall_KD", F.concat(F.col("Fighter1_Overall_KD"), F.lit("MARK")))
    raw = raw.withColumn("Fighter2_Overall_KD", F.replace("Fighter2_Overall_KD", F.lit("MARK"), F.lit("")))
    weights = spark.createDataFrame([("f", "Fly")], ["Fight Url", "Weight Class"])
    got = clean_contests(raw, weights, True)
    assert "MARK" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(got, "fighter_id", "fight_fighter_win", "fight_fighter_overall_kd") == [("a", True, 0.1), ("b", False, 0.1)]
