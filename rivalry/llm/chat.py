"""Chat formatting with collapse of cumulative snapshots.

Logs often hold a conversation again after each turn. A conversation that equals the first turns
of a longer one is dropped before rendering, and of equal conversations the smallest id stays.
Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.operators.history import Scan, find_busy, running
from rivalry.operators.skew import HOT_ROWS

#: Control strings of the rendered text; fixed values.
START, END = "<|im_start|>", "<|im_end|>"


def _turns(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without nulls in role and text; two hashes of the content."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return df.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), text, role).alias("b"),
    )


#: The bits of a hash that one running sum adds up; so many turns of a conversation overflow none.
PART = 1 << 31


def rolling_prefixes(df: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """conv_id, n (turns in all), place (from 1), a, b: 124 bits of the first ``place`` turns.

    The hash of a prefix is the sum of the hashes of its turns, each mixed with its place, in
    four parts, so it rolls on by running sums. Only ids and hashes are shuffled. Turns of
    equal number are ordered by role, then by content hash, null numbers first; repeated rows count
    as turns. A conversation of more than ``hot_rows`` turns is cut into chunks of its order, which
    are summed each by itself, so it is never in one task.
    """
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("\0"))
    turns = _turns(df).select(
        "conv_id", conv.alias("_conv"), F.col("turn").isNotNull().alias("_known"), "turn", "role", "a", "b"
    )
    key, order = ["_conv"], ["_known", "turn", "role", "a", "b"]
    busy = find_busy(turns, key, hot_rows)
    placed = running(turns, key, order, Scan(sums={"place": F.lit(1)}), hot_rows, busy=busy)
    one, two = F.xxhash64(F.lit(3), "place", "a", "b"), F.xxhash64(F.lit(4), "place", "b", "a")
    mixed = {
        "_a": F.pmod(one, F.lit(PART)),
        "_b": F.pmod(F.shiftrightunsigned(one, 31), F.lit(PART)),
        "_c": F.pmod(two, F.lit(PART)),
        "_d": F.pmod(F.shiftrightunsigned(two, 31), F.lit(PART)),
    }
    sums = running(placed, key, order, Scan(sums=mixed), hot_rows, busy=busy)
    sizes = placed.groupBy("_conv").agg(F.max("place").alias("n"))
    return sums.join(sizes, "_conv").select(
        "conv_id", "place", "n", F.xxhash64("_a", "_b").alias("a"), F.xxhash64("_c", "_d").alias("b")
    )


def maximal_conversations(df: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """conv_id, n_turns, n_copies of the conversations that no longer one begins with.

    Distinct prefixes are counted on the map side, so a first turn that a third of all
    conversations share is one row; the anti-join meets each key once on either side.
    """
    prefixes = rolling_prefixes(df, hot_rows)
    whole = (
        prefixes.where(F.col("place") == F.col("n"))
        .groupBy("place", "a", "b")
        .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    )
    begun = prefixes.where(F.col("place") < F.col("n")).select("place", "a", "b").distinct()
    return whole.join(begun, ["place", "a", "b"], "left_anti").select(
        "conv_id", F.col("place").cast("long").alias("n_turns"), "n_copies"
    )


def render(df: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """conv_id, n_turns, n_copies, text of the maximal conversations.

    ``df`` has conv_id, turn, role, text; further columns are ignored. Null role or text counts
    as empty, a null conv_id as one conversation of its own, a null turn comes first. ``<|``
    inside a role or text becomes ``< |``, so no turn can forge a control string. No rows give
    no rows. A conversation that stays is one row of the result, so its turns are gathered in one
    task; those that go are not, see :func:`rolling_prefixes`.
    """
    safe = lambda c: F.replace(F.col(c), F.lit("<|"), F.lit("< |"))
    line = F.concat(F.lit(START), safe("role"), F.lit("\n"), safe("text"), F.lit(END + "\n"))
    kept = maximal_conversations(df, hot_rows).withColumnRenamed("conv_id", "kept_id")
    turns = _turns(df).select("conv_id", F.struct("turn", "role", "a", "b", line.alias("line")).alias("t"))
    return (
        turns.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")))
        .groupBy("conv_id", "n_turns", "n_copies")
        .agg(F.sort_array(F.collect_list("t")).alias("t"))
        .select("conv_id", "n_turns", "n_copies", F.array_join("t.line", "").alias("text"))
    )
