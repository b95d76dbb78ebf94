import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from rivalry.operators import joins as J
from rivalry.operators.sample import complement
from rivalry.operators.skew import hot_keys, spread_join
from rivalry.session import laid_out, wide_parts

DAY = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def left_and_right(spark, rows=300):
    rng = random.Random(3)
    keys = ["hot"] * 5 + ["a", "b", "c", None]
    left = [(i, rng.choice(keys), day(rng.choice([None, *range(40)]))) for i in range(rows)]
    right = [(1000 + i, rng.choice(keys), day(rng.choice([None, *range(40)]))) for i in range(rows)]
    schema = "{0}id int, key string, {0}day date"
    return (
        spark.createDataFrame(left, schema.format("")),
        spark.createDataFrame(right, schema.format("r")),
        left,
        right,
    )


@pytest.mark.parametrize("hot_rows", [None, 100, 15])
def test_asof_matches_brute_force(spark, rows, hot_rows):
    """Strictly earlier, all ties kept, rows without a match dropped."""
    left, right, a, b = left_and_right(spark)
    got = rows(J.asof_join(left, right, "key", "day", "rday", hot_rows), "id", "rid")
    want = []
    for i, key, at in a:
        past = [r for r in b if key and r[1] == key and at and r[2] and r[2] < at]
        newest = max((r[2] for r in past), default=None)
        want += [(i, r[0]) for r in past if r[2] == newest]
    assert got == sorted(want, key=lambda t: tuple((False, str(v)) for v in t)) and len(got) > 100


def test_asof_plan_has_no_python_and_no_pairs(spark):
    left, right, _, _ = left_and_right(spark)
    plan = J.asof_join(left, right, "key", "day", "rday", None)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def contest_rows(spark):
    data = [
        (1, "a", day(0), True), (1, "b", day(0), False),
        (2, "b", day(1), True), (2, "a", day(1), False),
        (3, "c", day(2), True),  # alone
        (4, "a", day(3), True), (4, "a", day(3), True),  # the same entity twice
        (5, "a", day(4), True), (5, "b", day(4), False), (5, "b", day(4), False),  # a copy
        *[(None, e, day(5), True) for e in "abcab"],  # no contest at all
    ]
    return spark.createDataFrame(data, "contest int, entity_id string, day date, entity_win boolean")


def test_wide_rows_come_in_many_parts(spark):
    """Whatever ``spark.sql.shuffle.partitions`` says: a task sorts its part of the rows."""
    df = spark.createDataFrame([(1, 1), (1, 2)], "contest int, entity_id int")
    paired = J.pair_contestants(df, "contest", "entity_id", ("entity", "opponent"), [])
    parts = wide_parts(spark)
    assert parts >= 16 * 8 and parts % 4 == 0
    assert "hashpartitioning(contest#" in (plan := paired._jdf.queryExecution().executedPlan().toString())
    assert f", {parts})" in plan and plan.count("hashpartitioning") == 1
    table, _ = laid_out(paired, ["entity_id"], ["contest"])
    counted = table.groupBy("entity_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in counted and f"{parts} out of {parts}" in counted


def test_pair_contestants(spark, rows):
    df = contest_rows(spark)
    got = J.pair_contestants(df, "contest", "entity_id", ("entity", "opponent"), ["day"])
    assert got.columns == [*df.columns, "opponent_id", "opponent_win"]
    other = df.select("contest", F.col("entity_id").alias("o_id"), F.col("entity_win").alias("o_win"))
    want = df.join(other, "contest").where("entity_id <> o_id")
    columns = ["contest", "entity_id", "day", "entity_win"]
    assert rows(got, *columns, "opponent_id", "opponent_win") == rows(want, *columns, "o_id", "o_win")


def test_pairs_are_mirrored(spark, rows):
    df = contest_rows(spark).where("contest < 3")
    got = J.pair_contestants(df, "contest", "entity_id", ("entity", "opponent"), ["day"])
    swapped = got.select(
        "contest",
        F.col("opponent_id").alias("entity_id"),
        F.col("entity_id").alias("opponent_id"),
    )
    assert rows(got, "contest", "entity_id", "opponent_id") == rows(swapped, "contest", "entity_id", "opponent_id")
    assert got.count() == 4


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_two_sided(spark, rows, hot_rows):
    """Own row as of the latest time, dropped if it has a null; the opponent's history skips
    rows with nulls before the lookup."""
    past = spark.createDataFrame(
        [
            ("a", day(0), 1.0), ("a", day(5), None),
            ("b", day(1), 2.0), ("b", day(2), 3.0), ("b", day(2), 4.0), ("b", day(4), None),
            ("c", day(3), 5.0),
        ],
        "entity_id string, day date, entity_x double",
    )
    contests = spark.createDataFrame(
        [
            (1, day(3), "a", "b"), (1, day(3), "b", "a"),
            (2, day(6), "b", "a"), (2, day(6), "a", "b"),
            (3, day(5), "c", "b"), (4, day(1), "a", "c"), (5, day(0), "a", "b"),
        ],
        "contest int, day date, entity_id string, opponent_id string",
    )
    got = J.two_sided_asof(
        contests, past, "entity_id", "opponent_id", "day", ("entity_", "opponent_"), hot_rows
    )
    assert rows(got, "contest", "entity_id", "entity_x", "opponent_x") == [
        (1, "a", 1.0, 3.0), (1, "a", 1.0, 4.0), (1, "b", 3.0, 1.0), (1, "b", 4.0, 1.0),
        (3, "c", 5.0, 3.0), (3, "c", 5.0, 4.0),
    ]


def test_two_sided_on_a_wide_table(spark):
    """The plan of a wide history must not grow with every renamed column."""
    wide = spark.range(40).select(
        F.concat(F.lit("e"), (F.col("id") % 4).cast("string")).alias("entity_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
        *[(F.col("id") * i).cast("double").alias(f"entity_x{i}") for i in range(80)],
    )
    contests = spark.createDataFrame(
        [(1, day(60), "e1", "e2")], "contest int, day date, entity_id string, opponent_id string"
    )
    got = J.two_sided_asof(
        contests, wide, "entity_id", "opponent_id", "day", ("entity_", "opponent_")
    ).collect()
    assert len(got) == 1 and got[0]["entity_x2"] == 74.0 and got[0]["opponent_x2"] == 76.0


def test_enrich(spark, rows):
    dim = spark.createDataFrame([(1, "x"), (9, "y")], "k int, name string")
    facts = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    assert rows(J.right_enrich(dim, facts, ["k"]), "k", "name", "v") == [(1, "x", 10), (2, None, 20)]
    assert rows(J.left_enrich(facts, dim, ["k"]), "k", "name", "v") == [(1, "x", 10), (2, None, 20)]


def test_lookup_does_not_multiply(spark, rows):
    facts = spark.createDataFrame([("a", 1), ("b", 2)], ["Fight ID", "v"])
    lookup = spark.createDataFrame([("a", "Light"), ("a", "Light"), ("a", "Heavy")], ["Fight ID", "Weight Class"])
    got = J.enrich_by_derived_key(facts, lookup, "Fight ID", ["Weight Class"])
    assert rows(got) == [("a", 1, "Heavy"), ("b", 2, None)]


def test_frontier_and_complement(spark, rows):
    urls = spark.createDataFrame([("u1",), ("u1",), ("u2",), (None,)], "url string")
    done = spark.createDataFrame([("u2",), ("u3",), ("u2",)], "url string")
    assert rows(J.crawl_frontier(urls, done, "url")) == [("u1",), (None,)]
    assert rows(complement(urls.dropna(), done, ["url"])) == [("u1",), ("u1",)]


def test_natural_join_and_rename(spark, rows):
    left = spark.createDataFrame([(1, 2)], "fighter_id int, opponent_id int")
    names = spark.createDataFrame([(1, "one"), (2, "two")], "fighter_id int, fighter_name string")
    named = J.natural_join(J.natural_join(left, names), J.rename_side(names, "fighter", "opponent"))
    assert rows(named, "fighter_name", "opponent_name") == [("one", "two")]
    with pytest.raises(ValueError):
        J.natural_join(left, names.toDF("x", "y"))


def test_busy_ties_are_dealt_out(spark, rows):
    """The right rows of one entity and time go to several tasks, and nothing is lost."""
    history = spark.range(400).select(
        F.when(F.col("id") < 300, "busy").otherwise(F.concat(F.lit("e"), F.col("id") % 7)).alias("entity_id"),
        F.when(F.col("id") < 300, F.lit(day(1))).otherwise(F.lit(day(2))).alias("day"),
        F.col("id").alias("x"),
    )
    left = spark.createDataFrame(
        [(1, "busy", day(3)), (2, "busy", day(4)), (3, "e1", day(3)), (4, "busy", day(1)), (5, None, day(9))],
        "k int, entity_id string, day date",
    )
    plain = J.asof_join(left, history.withColumnRenamed("day", "was"), "entity_id", "day", "was", None)
    spread = J.asof_join(left, history.withColumnRenamed("day", "was"), "entity_id", "day", "was", 40)
    assert spread.columns == plain.columns
    assert rows(spread, "k", "x") == rows(plain, "k", "x") and spread.count() > 600

    many = hot_keys(history, ["entity_id"], 40)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = history.select("entity_id", "x")
        tasks = spread_join(left.select("k", "entity_id"), right, ["entity_id"], many, 40)
        busy = tasks.where("entity_id = 'busy'").select(F.spark_partition_id()).distinct()
        assert busy.count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_weights_of_copies(spark):
    """Copies multiply, in both directions; three entities meet each other."""
    data = [(1, "a", 1)] * 30 + [(1, "b", 2)] * 20 + [(2, e, 1) for e in "abc"] + [(2, "a", 2)]
    df = spark.createDataFrame(data, "contest int, entity_id string, entity_x int")
    got = J.pair_contestants(df, "contest", "entity_id", ("entity", "opponent"), [])
    count = {(r[0], r[1], r[2]): r[3] for r in got.groupBy("contest", "entity_id", "opponent_id").count().collect()}
    assert count == {
        (1, "a", "b"): 600, (1, "b", "a"): 600,
        (2, "a", "b"): 2, (2, "a", "c"): 2, (2, "b", "a"): 2, (2, "c", "a"): 2, (2, "b", "c"): 1, (2, "c", "b"): 1,
    }
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_previous_own_time(spark, rows):
    data = [("a", day(1)), ("a", day(1)), ("a", day(3)), ("a", day(3)), ("a", day(7)), ("b", day(2)), (None, day(1)), ("a", None)]
    df = spark.createDataFrame(data, "entity_id string, day date")
    own = J.previous_own_time(df, "entity_id", "day", "before")
    looked_up = J.previous_time(df, df, "entity_id", "day", "before", hot_rows=None)
    assert rows(own) == rows(looked_up, *own.columns)


@pytest.mark.parametrize("hot_rows", [1000, 20])
def test_lookups_read_the_buckets_of_a_history(spark, rows, hot_rows):
    """Its wide rows are not shuffled again, unless a contestant of the contests is hot."""
    data = [(e, (e + i) % 7, i, float(e * i)) for e in range(7) for i in range(1, 12)]
    data += [(9, 1, i, 0.5) for i in range(1, 4)]
    history = spark.createDataFrame(data, "fighter_id long, opponent_id long, day long, fighter_x double")
    contests = history.select("fighter_id", "opponent_id", "day")
    contests = contests.unionAll(contests.where("opponent_id = 1")).unionAll(contests.where("opponent_id = 1"))
    past = history.drop("opponent_id")
    table, _ = laid_out(past, ["fighter_id"], ["day"])
    side = ("fighter_", "opponent_")

    def looked_up(df):
        return J.two_sided_asof(contests, df, "fighter_id", "opponent_id", "day", side, hot_rows)

    got = looked_up(table)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("hashpartitioning(__entity" in plan and "__time" in plan) is True
    assert bool(re.search(r"hashpartitioning\(__entity#\d+L?, __time", plan)) == (hot_rows == 20)
    last = {}
    for e, _, day, x in data:
        last[e, day] = x
    want = []
    for e, o, day in [tuple(r) for r in contests.collect()]:
        mine = [d for f, d in last if f == e and d < day]
        theirs = [d for f, d in last if f == o and d < day]
        if mine and theirs:
            want.append((e, o, day, last[e, max(mine)], last[o, max(theirs)]))
    assert rows(got) == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_busy_ties_are_dealt_out_beside_tables_in_buckets(spark):
    """Also in a session in which joins may use rows that come by some of their columns."""
    right = spark.range(400).select(F.when(F.col("id") < 300, "busy").otherwise("e").alias("k"), F.col("id").alias("x"))
    left = spark.createDataFrame([(1, "busy"), (2, "e")], "n int, k string")
    many = hot_keys(right, ["k"], 40)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = spread_join(left, right, ["k"], many, 40)
        assert joined.count() == 400
        assert joined.where("k = 'busy'").select(F.spark_partition_id()).distinct().count() > 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
