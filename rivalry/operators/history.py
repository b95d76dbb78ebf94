"""Running, rolling and streak values over an ordered history.

A history is a set of rows per key (the entity) in a total order (time, then
contest). All values are inclusive: they cover the current row. For ordinary keys
they are plain window expressions, compiled to one exchange, one sort and one
Window node. A key with too many rows for one task is cut into chunks of its order
by a range partitioning; each chunk is scanned on its own, and a small table with one
row per chunk carries the totals of the earlier chunks forward. Both ways give the
same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from rivalry.operators.skew import (
    HOT_COUNT,
    HOT_ID,
    HOT_ROWS,
    hot_keys,
    with_keys,
    without_keys,
)
from rivalry.session import laid_out, stored

CHUNK = "__chunk"
ROW = "__row"
CARRY = "__carry"


@dataclass(frozen=True)
class Scan:
    """What to compute, as output name -> input expression.

    sums      running sum
    means     running mean of the values that are not null
    last      latest value that is not null, up to this row
    first     earliest value that is not null, of the whole history
    rolling   (expression, n): sum over the last n rows, fewer at the start
    streaks   condition: how many rows in a row it has held, up to this row
    """

    sums: dict[str, Column] = field(default_factory=dict)
    means: dict[str, Column] = field(default_factory=dict)
    last: dict[str, Column] = field(default_factory=dict)
    first: dict[str, Column] = field(default_factory=dict)
    rolling: dict[str, tuple[Column, int]] = field(default_factory=dict)
    streaks: dict[str, Column] = field(default_factory=dict)

    def outputs(self) -> list[str]:
        return [*self.sums, *self.means, *self.last, *self.first, *self.rolling, *self.streaks]


def ordering(order: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


@dataclass(frozen=True)
class Busy:
    """The hot keys of a history, or None if it has none."""

    keys: DataFrame | None


def find_busy(df: DataFrame, keys: list[str], hot_rows: int | None = HOT_ROWS) -> Busy:
    return Busy(None if hot_rows is None else hot_keys(df, keys, hot_rows))


def lay_out(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    hot_rows: int | None = HOT_ROWS,
    busy: Busy | None = None,
) -> tuple[DataFrame, Busy]:
    """``df`` stored once for all steps of a history, and its hot keys.

    The table has buckets of ``keys``: no later window, grouping or scan by them shuffles its rows
    again. The count of the keys reads one column of the stored buckets, so ``df`` itself
    is evaluated once, hot keys or not. A table with hot keys is returned as plain files, as a
    bucket is read by one task. ``busy`` is what an earlier table of the same history had: with it
    ``df`` reads that table, has at most as many rows per key, and needs neither exchange nor count.
    """
    if busy is not None and busy.keys is not None:
        return stored(df), busy
    table, plain = laid_out(df, keys, order, clustered=busy is not None)
    if busy is None:
        busy = find_busy(table, keys, hot_rows)
    return (table if busy.keys is None else plain), busy


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    scan: Scan,
    hot_rows: int | None = HOT_ROWS,
    bound: DataFrame | None = None,
    busy: Busy | None = None,
) -> DataFrame:
    """``df`` with the outputs of ``scan``. ``hot_rows=None`` skips the check for hot keys.

    ``bound`` is a table that is cheaper to count and has at least as many rows per key.
    ``busy`` is what an earlier count of such a table found, for several scans of one history.
    If there are hot keys, ``df`` is stored before it is divided, so that it is evaluated once.
    """
    if busy is None:
        busy = find_busy(df if bound is None else bound, keys, hot_rows)
    hot = busy.keys
    if hot is None:
        return _by_window(df, keys, order, scan)
    df = stored(df)
    cold = _by_window(without_keys(df, hot, keys), keys, order, scan)
    return cold.unionByName(_by_chunks(df, hot, keys, order, scan, hot_rows or HOT_ROWS))


def _streak_sum(name: str) -> str:
    return f"__held_{name}"


def _by_window(df: DataFrame, keys: list[str], order: list[str], scan: Scan) -> DataFrame:
    spec = Window.partitionBy(*keys).orderBy(*ordering(order))
    so_far = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = [F.sum(c).over(so_far).alias(n) for n, c in scan.sums.items()]
    values += [F.avg(c).over(so_far).alias(n) for n, c in scan.means.items()]
    values += [F.last(c, ignorenulls=True).over(so_far).alias(n) for n, c in scan.last.items()]
    values += [F.first(c, ignorenulls=True).over(whole).alias(n) for n, c in scan.first.items()]
    values += [
        F.sum(F.coalesce(c, F.lit(0))).over(spec.rowsBetween(1 - n, Window.currentRow)).alias(name)
        for name, (c, n) in scan.rolling.items()
    ]
    # A streak is the running count of held rows minus that count at the last break.
    values += [
        F.sum(_held(c)).over(so_far).alias(_streak_sum(n)) for n, c in scan.streaks.items()
    ]
    out = df.select("*", *values)
    if scan.streaks:
        streaks = {
            n: F.col(_streak_sum(n))
            - F.coalesce(F.max(F.when(_held(c) == 0, F.col(_streak_sum(n)))).over(so_far), F.lit(0))
            for n, c in scan.streaks.items()
        }
        out = out.select("*", *[c.alias(n) for n, c in streaks.items()])
    return out.select(*df.columns, *scan.outputs())


def _held(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _by_chunks(
    df: DataFrame,
    hot: DataFrame,
    keys: list[str],
    order: list[str],
    scan: Scan,
    hot_rows: int,
) -> DataFrame:
    total = hot.agg(F.sum(HOT_COUNT)).first()[0]
    parts = max(2, -(-2 * total // hot_rows))
    # the same types as by window, whatever the sums of sums below would widen to
    types = {f.name: f.dataType for f in _by_window(df, keys, order, scan).schema}
    rows = (
        with_keys(df, hot, keys)
        .repartitionByRange(parts, F.col(HOT_ID), *ordering(order))
        .withColumn(CHUNK, F.spark_partition_id())
    )
    # The chunk numbers come from a sampled range partitioning: store the scanned chunks once,
    # so that both uses below see the same numbers and none scans or shuffles the rows again.
    local = stored(_local_scan(rows, order, scan, types))
    carry = _carry_over(local, scan)
    joined = local.join(carry, [HOT_ID, CHUNK], "left")
    return joined.select(*df.columns, *_combine(scan, types))


def _local_scan(
    rows: DataFrame, order: list[str], scan: Scan, types: dict[str, DataType]
) -> DataFrame:
    """Each chunk on its own. Kept under ``__`` names, with the row number in the chunk."""
    spec = Window.partitionBy(HOT_ID, CHUNK).orderBy(*ordering(order))
    so_far = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = [F.row_number().over(spec).alias(ROW)]
    values += [F.sum(c).over(so_far).alias(f"__sum_{n}") for n, c in scan.sums.items()]
    for n, c in scan.means.items():
        values += [
            F.sum(c if isinstance(types[n], DecimalType) else c.cast("double"))
            .over(so_far)
            .alias(f"__total_{n}"),
            F.count(c).over(so_far).alias(f"__count_{n}"),
        ]
    values += [
        F.last(c, ignorenulls=True).over(so_far).alias(f"__last_{n}") for n, c in scan.last.items()
    ]
    values += [
        F.first(c, ignorenulls=True).over(whole).alias(f"__first_{n}")
        for n, c in scan.first.items()
    ]
    for name, (c, n) in scan.rolling.items():
        value = F.coalesce(c, F.lit(0))
        values += [
            value.alias(f"__value_{name}"),
            F.sum(value).over(spec.rowsBetween(1 - n, Window.currentRow)).alias(f"__roll_{name}"),
        ]
    values += [
        F.sum(_held(c)).over(so_far).alias(_streak_sum(n)) for n, c in scan.streaks.items()
    ]
    local = rows.select("*", *values)
    breaks = [
        F.max(F.when(_held(c) == 0, F.col(_streak_sum(n)))).over(so_far).alias(f"__break_{n}")
        for n, c in scan.streaks.items()
    ]
    return local.select("*", *breaks) if breaks else local


def _carry_over(local: DataFrame, scan: Scan) -> DataFrame:
    """One row per chunk with what the earlier chunks of its key hand on.

    The values at a chunk's last row are its totals. A key has at most as many chunks
    as there are range partitions, so the windows below are short.
    """
    names = [f"__sum_{n}" for n in scan.sums]
    names += [f"__{kind}_{n}" for n in scan.means for kind in ("total", "count")]
    names += [f"__last_{n}" for n in scan.last]
    names += [f"__first_{n}" for n in scan.first]
    names += [f(n) for n in scan.streaks for f in (_streak_sum, lambda n: f"__break_{n}")]
    totals = (
        local.groupBy(HOT_ID, CHUNK)
        .agg(F.max_by(F.struct(F.col(ROW), *[F.col(n) for n in names]), F.col(ROW)).alias("__t"))
        .select(HOT_ID, CHUNK, "__t.*")
    )
    spec = Window.partitionBy(HOT_ID).orderBy(CHUNK)
    before = spec.rowsBetween(Window.unboundedPreceding, -1)
    whole = spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    added = [f"__sum_{n}" for n in scan.sums]
    added += [f"__{kind}_{n}" for n in scan.means for kind in ("total", "count")]
    added += [_streak_sum(n) for n in scan.streaks]
    carried = [F.sum(n).over(before).alias(CARRY + n) for n in added]
    carried += [
        F.last(f"__last_{n}", ignorenulls=True).over(before).alias(f"{CARRY}__last_{n}")
        for n in scan.last
    ]
    carried += [
        F.first(f"__first_{n}", ignorenulls=True).over(whole).alias(f"{CARRY}__first_{n}")
        for n in scan.first
    ]
    carry = totals.select("*", *carried)
    if scan.streaks:
        carry = carry.select(
            "*",
            *[
                F.max(
                    F.coalesce(F.col(CARRY + _streak_sum(n)), F.lit(0)) + F.col(f"__break_{n}")
                ).over(before).alias(f"{CARRY}__break_{n}")
                for n in scan.streaks
            ],
        )
    carry = carry.select(HOT_ID, CHUNK, *[c for c in carry.columns if c.startswith(CARRY)])
    if scan.rolling:
        carry = carry.join(_carry_tails(local, scan), [HOT_ID, CHUNK], "left")
    return carry


def _carry_tails(local: DataFrame, scan: Scan) -> DataFrame:
    """Per chunk, the last rows before it: as many as the widest rolling sum can reach."""
    reach = max(max(n for _, n in scan.rolling.values()) - 1, 1)
    values = [F.col(f"__value_{name}").alias(name) for name in scan.rolling]
    latest = Window.partitionBy(HOT_ID, CHUNK).orderBy(F.col(ROW).desc())
    tails = (
        local.select(HOT_ID, CHUNK, ROW, F.struct(*values).alias("__values"))
        .withColumn("__back", F.row_number().over(latest))
        .where(F.col("__back") <= reach)
        .groupBy(HOT_ID, CHUNK)
        .agg(F.sort_array(F.collect_list(F.struct(ROW, "__values"))).alias("__tail"))
    )
    spec = Window.partitionBy(HOT_ID).orderBy(CHUNK).rowsBetween(-reach, -1)
    pieces = F.flatten(F.collect_list("__tail").over(spec))
    return tails.select(HOT_ID, CHUNK, pieces.alias("__pieces")).select(
        HOT_ID,
        CHUNK,
        F.slice(
            "__pieces",
            F.greatest(F.size("__pieces") - (reach - 1), F.lit(1)),
            F.lit(reach),
        ).alias(f"{CARRY}_tail"),
    )


def _added(local: str) -> Column:
    """Sum of the local and the carried value; null only if both are."""
    here, there = F.col(local), F.col(CARRY + local)
    return F.coalesce(here + there, here, there)


def _rolled(name: str, n: int, kind: DataType) -> Column:
    """The rolling sum, completed from the carried tail where the chunk is too short."""
    local, tail = F.col(f"__roll_{name}").cast(kind), F.col(f"{CARRY}_tail")
    missing = F.greatest(F.lit(n) - F.col(ROW), F.lit(0))
    reached = F.slice(tail, F.greatest(F.size(tail) - missing + 1, F.lit(1)), missing)
    completed = F.aggregate(
        reached, local, lambda acc, item: (acc + item["__values"][name]).cast(kind)
    )
    return F.when((F.col(ROW) < n) & tail.isNotNull(), completed).otherwise(local)


def _combine(scan: Scan, types: dict[str, DataType]) -> list[Column]:
    out = [_added(f"__sum_{n}").alias(n) for n in scan.sums]
    out += [
        F.try_divide(_added(f"__total_{n}"), _added(f"__count_{n}")).alias(n) for n in scan.means
    ]
    out += [
        F.coalesce(F.col(f"__last_{n}"), F.col(f"{CARRY}__last_{n}")).alias(n) for n in scan.last
    ]
    out += [F.col(f"{CARRY}__first_{n}").alias(n) for n in scan.first]
    out += [_rolled(name, n, types[name]).alias(name) for name, (_, n) in scan.rolling.items()]
    for n in scan.streaks:
        held = _added(_streak_sum(n))
        before = F.coalesce(F.col(CARRY + _streak_sum(n)), F.lit(0))
        broke = F.greatest(before + F.col(f"__break_{n}"), F.col(f"{CARRY}__break_{n}"))
        out.append((held - F.coalesce(broke, F.lit(0))).alias(n))
    return [c.cast(types[n]).alias(n) for c, n in zip(out, scan.outputs(), strict=True)]


def fill_within(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    backward: bool = True,
    hot_rows: int | None = HOT_ROWS,
    busy: Busy | None = None,
) -> DataFrame:
    """Nulls take the latest earlier value of the same key, then the first later one.

    Back filling only reaches the nulls before the first value, so the first value of the
    whole history is the right one. It looks into the future; ``backward=False`` leaves it out.
    """
    scan = Scan(
        last={f"__fill_{c}": F.col(c) for c in columns},
        first={f"__lead_{c}": F.col(c) for c in columns} if backward else {},
    )
    filled = running(df, keys, order, scan, hot_rows, busy=busy)
    value = {
        c: F.coalesce(
            F.col(f"__fill_{c}"), *([F.col(f"__lead_{c}")] if backward else [])
        ).alias(c)
        for c in columns
    }
    return filled.select(*[value.get(c, F.col(c)) for c in df.columns])


def latest_per_group(
    df: DataFrame, keys: list[str], time: str, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """All rows at the latest time of their group, ties included.

    ``rank() = 1`` lets Spark drop the other rows before the shuffle. A hot group, which may
    be all ties, is compared with its (pre-aggregated) maximum without moving its rows.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(time).desc_nulls_last())

    def ranked(rows: DataFrame) -> DataFrame:
        kept = rows.where(F.col(time).isNotNull()).withColumn("__rank", F.rank().over(newest))
        return kept.where(F.col("__rank") == 1).drop("__rank")

    hot = hot_keys(df, keys, hot_rows) if hot_rows is not None else None
    if hot is None:
        return ranked(df)
    busy = with_keys(df, hot, keys)
    top = busy.groupBy(HOT_ID).agg(F.max(time).alias("__top"))
    kept = busy.join(top, HOT_ID).where(F.col(time) == F.col("__top"))
    return ranked(without_keys(df, hot, keys)).unionByName(kept.select(*df.columns))


def first_per_group(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per group, the first in the order.

    Spark keeps one row per group and map task before the shuffle, so hot groups are cheap.
    """
    spec = Window.partitionBy(*keys).orderBy(*ordering(order))
    numbered = df.withColumn("__row", F.row_number().over(spec))
    return numbered.where(F.col("__row") == 1).drop("__row")
