"""Aggregates over whole tables: one pass each, combined on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivalry.operators.columns import as_double, column_cells

METRICS = ["accuracy", "f1_score", "precision", "recall"]


def column_totals(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row count, known values, sum, mean and whether any value is not 0, per column."""
    x = F.col("value")
    return (
        column_cells(df, columns, as_double)
        .groupBy("column_name")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(x).alias("known"),
            F.sum(x).alias("total"),
            F.avg(x).alias("mean"),
            F.coalesce(F.bool_or(x != 0), F.lit(False)).alias("any_set"),
        )
    )


def conditional_rate(df: DataFrame, conditions: dict[str, Column], target: str) -> DataFrame:
    """How often the target holds where a condition does; an unknown condition does not count."""
    parts = []
    for i, condition in enumerate(conditions.values()):
        held = F.when(condition, F.col(target).cast("double"))
        parts += [F.avg(held).alias(f"r{i}"), F.count(F.when(condition, 1)).alias(f"n{i}")]
    listed = [
        F.struct(
            F.lit(name).alias("condition"),
            F.col(f"n{i}").alias("rows"),
            F.col(f"r{i}").alias("rate"),
        )
        for i, name in enumerate(conditions)
    ]
    return df.agg(*parts).select(F.inline(F.array(*listed)))


def _correlations(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """(feature, rows, correlation), null where a side is constant.

    Only the rows where both sides are known count. ``corr`` itself divides by zero on a
    constant column, so the quotient is guarded here.
    """
    x, y = F.col("value"), F.col("__target")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return (
        column_cells(df, columns, as_double, {"__target": as_double(F.col(target))}, "feature")
        .groupBy("feature")
        .agg(
            F.count(F.when(x.isNotNull() & y.isNotNull(), 1)).alias("rows"),
            F.try_divide(F.covar_pop(x, y), spread).alias("correlation"),
        )
    )


def correlation_with_target(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target, largest first."""
    found = _correlations(df, columns, target).select("feature", "correlation")
    return found.orderBy(F.col("correlation").desc_nulls_last(), "feature")


def f_scores(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Univariate linear-regression F of each column; null for a constant column."""
    r2 = F.col("correlation") * F.col("correlation")
    score = F.try_divide(r2, 1 - r2) * (F.col("rows") - 2)
    return _correlations(df, columns, target).select("feature", score.alias("f_score"))


def classification_metrics(
    df: DataFrame, label: str, prediction: str, split: str | None = None
) -> DataFrame:
    """Accuracy, F1, precision and recall of 0/1 predictions to 4 places, per split.

    A metric without any case to judge is 0.
    """
    actual, guess = F.col(label) == 1, F.col(prediction) == 1

    def cases(condition: Column) -> Column:
        return F.count(F.when(condition, 1)).cast("double")

    hit, false_alarm, miss = cases(actual & guess), cases(~actual & guess), cases(actual & ~guess)
    right = cases(F.col(label) == F.col(prediction))

    def share(part: Column, whole: Column) -> Column:
        return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), 4)

    values = {
        "accuracy": share(right, F.count(F.lit(1))),
        "f1_score": share(2 * hit, 2 * hit + false_alarm + miss),
        "precision": share(hit, hit + false_alarm),
        "recall": share(hit, hit + miss),
    }
    grouped = df.groupBy(split) if split else df.groupBy()
    return grouped.agg(*[values[m].alias(m) for m in METRICS])


def metrics_long(metrics: DataFrame, split: str) -> DataFrame:
    """One (split, metric, value) row per metric."""
    return metrics.unpivot([split], METRICS, "metric", "value")


def metrics_table(long: DataFrame, split: str) -> DataFrame:
    """Splits as rows and metrics as columns, split names descending."""
    wide = long.groupBy(split).pivot("metric", METRICS).agg(F.first("value"))
    return wide.orderBy(F.col(split).desc())


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, classes: tuple[int, ...] = (0, 1)
) -> DataFrame:
    """Counts per actual and predicted class, one row per class, empty cells as 0.

    One aggregate row holds every cell, so classes without rows are listed too.
    """
    cells = [
        F.count(F.when((F.col(label) == a) & (F.col(prediction) == p), 1)).alias(f"c{a}_{p}")
        for a in classes
        for p in classes
    ]
    listed = [
        F.struct(
            F.lit(a).alias("actual"),
            *[F.col(f"c{a}_{p}").alias(f"predicted_{p}") for p in classes],
        )
        for a in classes
    ]
    return df.agg(*cells).select(F.inline(F.array(*listed)))


def top_bottom(df: DataFrame, name: str, value: str, k: int = 10) -> DataFrame:
    """The k largest and the k smallest values, largest first, with a ``...`` row between.

    ``position`` gives the order of the report. Each end is a top-k, never a full sort.
    """
    highest = [F.col(value).desc(), F.col(name)]
    lowest = [F.col(value).asc(), F.col(name).desc()]
    known = df.select(name, value).where(F.col(value).isNotNull())

    def end(order: list[Column], first: int) -> DataFrame:
        spec = Window.orderBy(*highest)  # over k rows
        top = known.orderBy(*order).limit(k)
        return top.withColumn("position", F.row_number().over(spec) + first)

    gap = df.sparkSession.range(1).select(
        F.lit("...").alias(name),
        F.lit(None).cast(df.schema[value].dataType).alias(value),
        F.lit(k + 1).alias("position"),
    )
    return end(highest, 0).unionByName(gap).unionByName(end(lowest, k + 1)).orderBy("position")
