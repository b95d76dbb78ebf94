"""Typing and reshaping of raw text tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivalry.functions import CLOCK, OF_PAIR, parse_clock, parse_of_pair, parse_percent, quoted
from rivalry.operators.columns import column_cells

# Fixed value: the status of a contest's winner.
WON = "W"


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Lower case, spaces to underscores, dots removed."""
    return df.toDF(*[c.lower().replace(" ", "_").replace(".", "") for c in df.columns])


def prefix_columns(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    """``prefix`` before every name but those in ``keep``."""
    return df.toDF(*[c if c in set(keep) else prefix + c for c in df.columns])


def prefix_unless(
    df: DataFrame, prefix: str, marks: Iterable[str], keep: Iterable[str] = ()
) -> DataFrame:
    """``prefix`` before the names that hold none of the marks."""
    marked = [c for c in df.columns if any(m in c for m in marks)]
    return prefix_columns(df, prefix, [*marked, *keep])


def drop_matching(df: DataFrame, fragment: str) -> DataFrame:
    """Without the columns whose name holds the fragment."""
    return df.select(*[quoted(c) for c in df.columns if fragment not in c])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def decided_only(df: DataFrame, statuses: list[str]) -> DataFrame:
    """Contests that somebody won."""
    won = F.lit(False)
    for status in statuses:
        won = won | quoted(status).eqNullSafe(F.lit(WON))
    return df.where(won)


def is_win(status: Column) -> Column:
    return status.eqNullSafe(F.lit(WON))


def require(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is known."""
    return df.where(F.col(column).isNotNull())


def wide_to_long(df: DataFrame, tags: list[str], tag: str, slot: str | None = None) -> DataFrame:
    """One row per contest to one row per contestant, in a single scan.

    Columns whose name holds one of ``tags`` belong to that side and get ``tag`` in its place;
    the others are repeated. A column that only one side has is null for the other.
    ``slot`` names an optional column with the side's number.
    """
    shared = [c for c in df.columns if not any(t in c for t in tags)]
    per_side = [{c.replace(t, tag): c for c in df.columns if t in c} for t in tags]
    names = list(dict.fromkeys(n for side in per_side for n in side))
    types = {n: df.schema[side[n]].dataType for side in reversed(per_side) for n in side}

    def row(number: int, side: dict[str, str]) -> Column:
        fields = [
            (quoted(side[n]) if n in side else F.lit(None)).cast(types[n]).alias(n) for n in names
        ]
        return F.struct(*([F.lit(number).alias(slot)] if slot else []), *fields)

    rows = F.array(*[row(i, side) for i, side in enumerate(per_side, 1)])
    return df.select(*[quoted(c) for c in shared], F.inline(rows))


def detect_formats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Which columns hold percentages, pairs or clocks in any value: one aggregate pass."""
    text = F.col("value")
    tests = {
        "percent": F.contains(text, F.lit("%")),
        "of_pair": text.rlike(OF_PAIR),
        "clock": text.rlike(CLOCK),
    }
    found = [
        F.coalesce(F.bool_or(test), F.lit(False)).alias(kind) for kind, test in tests.items()
    ]
    return column_cells(df, columns, lambda c: c).groupBy("column_name").agg(*found)


def convert_detected(df: DataFrame, columns: list[str], strict: bool = True) -> DataFrame:
    """Type the text columns by what they hold.

    Percentages become fractions; pairs become ``_landed`` and ``_total``; clocks become
    ``_seconds``; the rest become numbers (junk raises when strict, else gives null).
    A column follows the first format found in it, in that order. The driver sees one small
    row per column.
    """
    found = {r["column_name"]: r.asDict() for r in detect_formats(df, columns).collect()}
    plain = {"percent": False, "of_pair": False, "clock": False}  # of a table without rows
    out: list[Column] = []
    for name in df.columns:
        text = quoted(name)
        if name not in columns:
            out.append(text)
        elif found.setdefault(name, plain)["percent"]:
            out.append(parse_percent(text, strict).alias(name))
        elif found[name]["of_pair"]:
            out += [part.alias(f"{name}_{key}") for key, part in parse_of_pair(text).items()]
        elif found[name]["clock"]:
            out.append(parse_clock(text).alias(f"{name}_seconds"))
        else:
            number = text.cast("double") if strict else text.try_cast("double")
            out.append(number.alias(name))
    return df.select(*out)


def convert_percent(df: DataFrame, columns: list[str], strict: bool = True) -> DataFrame:
    """Only the percentages among the text columns become fractions; the others stay text."""
    found = {r["column_name"] for r in detect_formats(df, columns).collect() if r["percent"]}
    return df.select(
        *[
            parse_percent(quoted(c), strict).alias(c) if c in found else quoted(c)
            for c in df.columns
        ]
    )


def category_domain(df: DataFrame, column: str, max_values: int = 10_000) -> list[str]:
    """The sorted distinct values of a category column.

    A category is a closed list; one longer than ``max_values`` is refused, not cut.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    rows = values.limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"{column} has more than {max_values} values; it is not a category")
    return sorted(r[0] for r in rows)
