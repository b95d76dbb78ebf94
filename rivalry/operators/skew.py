"""Keys that hold too many rows for one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivalry.session import stored

# Rows of one key that a single task may sort. A key above it is cut into chunks.
HOT_ROWS = 1_000_000

# Hot keys that are held as a local list; more of them are stored.
LISTED = 10_000

HOT_ID = "__hot_id"
HOT_COUNT = "__hot_count"


def _hot(key: str) -> str:
    return f"__hot_{key}"


def hot_keys(df: DataFrame, keys: list[str], limit: int = HOT_ROWS) -> DataFrame | None:
    """The keys with more than ``limit`` rows, with a number and a row count each, or None.

    One narrow aggregate (map-side combined) finds them, evaluated once unless there are more
    than :data:`LISTED`. At most rows / limit keys can qualify.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(HOT_COUNT))
    hot = counts.where(F.col(HOT_COUNT) > limit).select(
        *[F.col(k).alias(_hot(k)) for k in keys], HOT_COUNT
    )
    found = hot.limit(LISTED + 1).collect()
    if not found:
        return None
    if len(found) > LISTED:
        return stored(hot.withColumn(HOT_ID, F.monotonically_increasing_id()))
    numbered = [(*row, i) for i, row in enumerate(found)]
    return df.sparkSession.createDataFrame(numbered, hot.schema.add(HOT_ID, "long"))


def _same_keys(keys: list[str]) -> Column:
    """Equality of all keys, null equal to null as in a grouping."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(_hot(k))) for k in keys])


def without_keys(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of all other keys. Spark broadcasts the list if its size, which it knows, is small."""
    return df.join(hot.select(*[_hot(k) for k in keys]), _same_keys(keys), "left_anti")


def with_keys(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the listed keys, with the key's number."""
    joined = df.join(hot.select(*[_hot(k) for k in keys], HOT_ID), _same_keys(keys), "inner")
    return joined.select(*df.columns, HOT_ID)


def spread_join(
    left: DataFrame, right: DataFrame, keys: list[str], many: DataFrame | None, limit: int | None
) -> DataFrame:
    """Inner equi-join on ``keys`` that deals out the right rows of a key with very many.

    ``many`` are the keys with more than ``limit`` right rows, as :func:`hot_keys` finds them. Such
    a key is cut into as many parts as its count asks for: its right rows go to a part by their
    hash, and each left row to all parts. Keys below the limit have one part. No task
    then holds more right rows of a key than about ``limit``, whatever AQE does.
    """
    if many is None:
        return left.join(right, keys)
    parts = many.select(
        *[F.col(_hot(k)).alias(k) for k in keys],
        F.ceil(F.col(HOT_COUNT) / F.lit(limit)).cast("int").alias("__parts"),
    )
    count = F.coalesce("__parts", F.lit(1))
    spread = F.xxhash64(*[F.col(c) for c in right.columns])
    dealt = right.join(parts, keys, "left").withColumn("__part", F.pmod(spread, count).cast("int"))
    every = F.explode(F.sequence(F.lit(0), count - 1))
    copied = left.join(parts, keys, "left").withColumn("__part", every)
    # By all columns: a session with laid out tables takes rows that come by the keys as they are.
    at = [*keys, "__part"]
    joined = copied.drop("__parts").repartition(*at).join(dealt.drop("__parts").repartition(*at), at)
    return joined.drop("__part")
