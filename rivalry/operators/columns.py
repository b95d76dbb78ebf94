"""Per-column work on wide tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivalry.functions.text import quoted


def column_cells(
    df: DataFrame,
    columns: list[str],
    value: Callable[[Column], Column],
    keep: dict[str, Column] | None = None,
    name: str = "column_name",
) -> DataFrame:
    """One row (name, value) per row and listed column, with the ``keep`` expressions.

    Grouping these by name takes one scan whatever the number of columns and is combined on the
    map side to a row per column. For moments and pattern tests that is several times faster than
    hundreds of such expressions in one aggregate; for counts, means and bounds
    ``aggregate_columns`` is the faster one.
    """
    cells = [
        F.struct(F.lit(c).alias(name), value(quoted(c)).alias("value")) for c in columns
    ]
    kept = [expression.alias(k) for k, expression in (keep or {}).items()]
    return df.select(*kept, F.inline(F.array(*cells)))


def aggregate_columns(
    df: DataFrame, columns: list[str], aggregates: dict[str, Callable[[Column], Column]]
) -> DataFrame:
    """(column_name, one value per aggregate) for every listed column, in one aggregate row."""
    values = [
        make(quoted(c)).alias(f"{kind}{i}")
        for i, c in enumerate(columns)
        for kind, make in aggregates.items()
    ]
    listed = [
        F.struct(
            F.lit(c).alias("column_name"), *[F.col(f"{kind}{i}").alias(kind) for kind in aggregates]
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*values).select(F.inline(F.array(*listed)))


def with_once(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``df`` with columns whose expressions are evaluated once per row.

    Spark copies the expression of a plain column to the places that use it: into the filter it adds
    below an ``explode``, and into lambdas, which then evaluate it for each element. The one row
    of a generator is a boundary that no expression and no filter crosses.
    """
    kept = [quoted(c) for c in df.columns if c not in values]
    one = F.struct(*[value.alias(name) for name, value in values.items()])
    return df.select(*kept, F.inline(F.array(one)))


def as_double(column: Column) -> Column:
    return column.cast("double")


#: Columns that a table may be widened to by names found in its data.
WIDEST = 10_000


def listed_names(names: DataFrame, most: int = WIDEST) -> list[str]:
    """The sorted distinct names of a one-column table, as a closed list of column names.

    The driver sees ``most`` + 1 names at most. More make no table to be read by columns: that is
    refused, and the long form is to be used instead.
    """
    rows = names.distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} column names; use the long form")
    return sorted(r[0] for r in rows)
