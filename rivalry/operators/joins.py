"""Joins of contest tables.

Sides are never broadcast by hint: Spark broadcasts a side whose size it has measured
(``spark.sql.autoBroadcastJoinThreshold``, AQE) and splits skewed partitions otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivalry.functions.text import quoted
from rivalry.operators.encode import require_all
from rivalry.operators.history import Busy, Scan, find_busy, running
from rivalry.operators.skew import HOT_ROWS, hot_keys, spread_join
from rivalry.session import wide_parts


def rename_side(df: DataFrame, old: str, new: str) -> DataFrame:
    """``old`` replaced by ``new`` in every column name."""
    return df.toDF(*[c.replace(old, new) for c in df.columns])


def right_enrich(dimension: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Right outer equi-join: every fact, with its dimension row if there is one."""
    return dimension.join(facts, keys, "right")


def left_enrich(facts: DataFrame, dimension: DataFrame, keys: list[str]) -> DataFrame:
    """Left outer equi-join: every fact, with its dimension row if there is one."""
    return facts.join(dimension, keys, "left")


def enrich_by_derived_key(
    facts: DataFrame, lookup: DataFrame, key: str, columns: list[str]
) -> DataFrame:
    """Left join with a lookup that may list a key more than once.

    The lookup keeps one row per key (the smallest values), so no fact is multiplied.
    """
    row = F.min(F.struct(*[quoted(c) for c in columns])).alias("__row")
    once = lookup.groupBy(quoted(key)).agg(row)
    joined = facts.join(once, [key], "left")
    taken = [F.col("__row").getField(c).alias(c) for c in columns]
    return joined.select(*[quoted(c) for c in facts.columns], *taken)


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in right.columns]


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all shared column names."""
    keys = shared_columns(left, right)
    if not keys:
        raise ValueError("the tables share no column name")
    return left.join(right, keys)


def crawl_frontier(urls: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The listed keys that are not yet stored, each once (null counts as a value)."""
    listed = urls.select(key).distinct()
    stored = done.select(F.col(key).alias("__done")).distinct()
    return listed.join(stored, F.col(key).eqNullSafe(F.col("__done")), "left_anti")


def pair_contestants(
    df: DataFrame,
    contest: str,
    entity: str,
    side: tuple[str, str],
    shared: list[str],
) -> DataFrame:
    """Every row next to the other contestant's row of the same contest.

    The other row's columns, but for ``shared`` and the contest, are added with ``side[0]``
    replaced by ``side[1]`` in their names. A contest of two thus gives two mirrored rows.
    Copies are one row with a weight, and each pair is repeated by the product of its weights at
    the end. Each of two different rows finds the other one row ahead or back; in a contest
    with more, each row takes the list of those of another entity.

    All steps are windows by contest: one shuffle and one sort, no count beforehand and no join.
    The shuffle has partitions enough that a task sorts a small part of the rows; it is left out if
    ``df`` comes in as many partitions by contest.
    A contest of two entities with a and b copies has 2ab rows in the result, one of k different
    rows up to k(k - 1); the task that holds it has the k rows in memory, not the pairs.
    """
    old, new = side
    own = [c for c in df.columns if c not in shared and c != contest]
    renamed = {c: c.replace(old, new) for c in own}
    other = F.struct(F.col("__weight"), *[F.col(c).alias(renamed[c]) for c in own])
    content = [F.xxhash64(*df.columns).alias("__one"), F.hash(*df.columns).alias("__two")]
    row = [entity, "__one", "__two"]
    whole = Window.partitionBy(contest)
    by_order = whole.orderBy(*row)
    # the first window is by contest alone, so that its exchange and sort serve the others
    before = [F.lag(c).over(by_order).eqNullSafe(F.col(c)) for c in row]
    copy = reduce(Column.__and__, before) & (F.row_number().over(by_order) > 1)
    rows = (
        df.where(F.col(contest).isNotNull())
        .repartition(wide_parts(df.sparkSession), contest)
        .select("*", *content)
        .withColumn("__copy", copy)
        .withColumn("__weight", F.count(F.lit(1)).over(Window.partitionBy(contest, *row)))
        .where(~F.col("__copy"))
        .withColumn("__different", F.count(F.lit(1)).over(whole))
    )
    # a list for contests of more than two different rows only
    listed = F.collect_list(F.when(F.col("__different") > 2, other)).over(whole)
    next_ = F.coalesce(F.lead(other).over(by_order), F.lag(other).over(by_order))
    others = F.when(F.col("__different") > 2, listed).otherwise(F.array(next_))
    paired = rows.select(*df.columns, "__weight", others.alias("__others")).select(
        *df.columns, F.col("__weight").alias("__mine"), F.inline("__others")
    )
    times = (F.col("__mine") * F.col("__weight")).cast("int")
    met = paired.where(F.col(entity) != F.col(renamed[entity]))
    return met.select("*", F.explode(F.sequence(F.lit(1), times)).alias("__copy")).select(
        *df.columns, *renamed.values()
    )


def previous_own_time(df: DataFrame, by: str, time: str, out: str) -> DataFrame:
    """``df`` with the latest earlier time of each row's entity in the same table, null if none.

    Two windows by entity, and no exchange if ``df`` reads a table laid out by it. Rows without
    an entity or a time are dropped. It is for tables without hot keys.
    """
    rows = df.where(F.col(time).isNotNull() & F.col(by).isNotNull())
    ordered = Window.partitionBy(by).orderBy(time)
    earlier = rows.withColumn("__lag", F.lag(time).over(ordered))
    # the first row of a time has the time before it; its lag may be the only one that differs
    tied = F.min(F.when(F.col("__lag") < F.col(time), F.col("__lag")))
    return earlier.withColumn(out, tied.over(Window.partitionBy(by, time))).drop("__lag")


def previous_time(
    left: DataFrame,
    right: DataFrame,
    by: str,
    time: str,
    out: str,
    right_by: str | None = None,
    right_time: str | None = None,
    hot_rows: int | None = HOT_ROWS,
    bound: DataFrame | None = None,
) -> DataFrame:
    """``left`` with the latest time at which ``right`` has a row of the entity strictly before.

    Left rows and the distinct right times go through one ordered scan per entity, left rows
    first at equal times; the latest right time seen so far is then strictly earlier. The
    work is linear in both tables: no pair of a left row and an older right row is formed.
    """
    known = F.col(time).isNotNull() & F.col(by).isNotNull()
    times = right.select(
        F.col(right_by or by).alias(by),
        F.col(right_time or time).cast(left.schema[time].dataType).alias(time),
    ).where(known)
    marks = times.distinct().withColumn("__mark", F.lit(1))
    # rows of one entity and time are told apart, so that a chunk need not hold all of them
    spread = F.xxhash64(*[F.col(c) for c in left.columns])
    probes = left.where(known).withColumn("__mark", F.lit(0)).withColumn("__spread", spread)
    both = probes.unionByName(marks, allowMissingColumns=True)
    seen = Scan(last={out: F.when(F.col("__mark") == 1, F.col(time))})
    if bound is None:
        # Counting the right rows before ``distinct`` saves its shuffle; more only seem hot.
        bound = probes.select(by).unionAll(times.select(by))
    scanned = running(both, [by], [time, "__mark", "__spread"], seen, hot_rows, bound)
    return scanned.where(F.col("__mark") == 0).drop("__mark", "__spread")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    time: str,
    right_time: str,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Each left row with the right rows of its entity at the latest strictly earlier time.

    All rows tied at that time are kept; left rows without an earlier row are dropped. The
    right table's time column is called ``right_time`` and stays in the result. The right rows of
    an entity and time with more than ``hot_rows`` are dealt out to several tasks.
    """
    found = previous_time(left, right, by, time, "__before", None, right_time, hot_rows)
    found = found.where(F.col("__before").isNotNull())
    kind = left.schema[time].dataType
    dated = right.withColumn("__before", F.col(right_time).cast(kind))
    ties = dated.select(by, "__before")
    many = hot_keys(ties, [by, "__before"], hot_rows) if hot_rows is not None else None
    return spread_join(found, dated, [by, "__before"], many, hot_rows).drop("__before")


def two_sided_asof(
    contests: DataFrame,
    history: DataFrame,
    entity: str,
    opponent: str,
    time: str,
    side: tuple[str, str],
    hot_rows: int | None = HOT_ROWS,
    own: bool = False,
    busy: Busy | None = None,
) -> DataFrame:
    """Contests with the previous history rows of both contestants.

    ``history`` holds the entity, the time and its features; the opponent's copy has
    ``side[0]`` replaced by ``side[1]`` in its names. Rows with any null are dropped
    after the first lookup, and history rows with any null cannot be found by the second.
    Both times are looked up on the narrow contest rows before the wide features are joined.

    ``own`` says that the contests are the rows of ``history``, and ``busy`` what its hot keys
    are: then the first time is found by windows of the history itself, without an exchange
    if it is laid out by entity.
    """
    features = [c for c in history.columns if c not in (entity, time)]
    renamed = {c: c.replace(*side) for c in features}
    opposing = require_all(history)

    if busy is None:
        busy = find_busy(history, [entity], hot_rows)
    if own and busy.keys is None:
        keyed = previous_own_time(contests, entity, time, "__own")
    else:
        keyed = previous_time(contests, history, entity, time, "__own", hot_rows=hot_rows)
    keyed = keyed.where(F.col("__own").isNotNull())
    # Hot opponents are counted before the first lookup and the null check: no less, and cheap.
    counted = contests.select(opponent).unionAll(history.select(F.col(entity).alias(opponent)))
    keyed = previous_time(
        keyed, opposing, opponent, time, "__opposing", entity, None, hot_rows, counted
    ).where(F.col("__opposing").isNotNull())

    # A history row with a null is found by the first lookup only to be dropped: the rows
    # without one serve both sides.
    kind = contests.schema[time].dataType
    values = [f"__value{i}" for i in range(len(features))]
    past = opposing.select(
        F.col(entity).alias("__entity"),
        F.col(time).cast(kind).alias("__time"),
        *[F.col(c).alias(v) for c, v in zip(features, values, strict=True)],
    )
    at_time = ["__entity", "__time"]
    # Buckets of the entity serve both joins, unless contests have a key too large for a task.
    probed = [opponent] if own and busy.keys is None else [entity, opponent]
    if any(find_busy(contests.select(key), [key], hot_rows).keys is not None for key in probed):
        past = past.repartition(*at_time)
    past = past.hint("merge")  # a wide table in few compressed bytes is no table to broadcast
    ties = history.select(F.col(entity).alias("__entity"), F.col(time).cast(kind).alias("__time"))
    many = hot_keys(ties, at_time, hot_rows) if hot_rows is not None else None
    rows, kept = require_all(keyed), list(contests.columns)
    for key, at, names in ((entity, "__own", features), (opponent, "__opposing", renamed.values())):
        probes = rows.withColumns({"__entity": F.col(key), "__time": F.col(at)})
        joined = spread_join(probes, past, at_time, many, hot_rows).drop(*at_time)
        kept += names
        rows = joined.withColumnsRenamed(dict(zip(values, names, strict=True)))
    return rows.select(*kept)
