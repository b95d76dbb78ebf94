"""Aggregates, metrics, samples and reports."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from rivalry.operators.history import ordering
from rivalry.operators.learn import classifier_pipeline, min_max_scale
from rivalry.operators.sample import exact_split
from rivalry.operators.stats import (
    classification_metrics,
    column_totals,
    conditional_rate,
    confusion_matrix,
    correlation_with_target,
    f_scores,
    metrics_long,
    metrics_table,
    top_bottom,
)
from rivalry.queries import views as V

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _returned(spark, sf):
    """Line items with the target "returned" and a constant column."""
    return V.table(spark, sf, "lineitem").select(
        *NUMBERS, F.lit(7).alias("fixed"), (F.col("l_returnflag") == "R").cast("int").alias("returned")
    )


RETURNED = """
returned as (select l_quantity, l_extendedprice, l_discount, l_tax, 7 fixed,
                    (l_returnflag = 'R')::int returned from lineitem)"""


def q_column_totals(spark, sf):
    """Totals in hundredths, so that sums are exact in any order."""
    names = [*NUMBERS, "fixed", "returned"]
    cents = {c: F.round(F.col(c) * 100).cast("bigint") for c in names}
    return column_totals(_returned(spark, sf).withColumns(cents), names)


def q_cond_rate(spark, sf):
    """How often a line is returned if it is large, and if it is cheap."""
    conditions = {
        "large": F.col("l_quantity") > 25,
        "discount_above_tax": F.col("l_discount") > F.col("l_tax"),
    }
    out = conditional_rate(_returned(spark, sf), conditions, "returned")
    return out.withColumn("rate", F.round("rate", 8))


def q_corr_target(spark, sf):
    out = correlation_with_target(
        _returned(spark, sf), [*NUMBERS, "fixed", "returned"], "returned"
    )
    return out.withColumn("correlation", F.round("correlation", 8))


def q_f_scores(spark, sf):
    out = f_scores(_returned(spark, sf), [*NUMBERS, "fixed"], "returned")
    return out.withColumn("f_score", F.round("f_score", 4))


def q_select_k(spark, sf):
    """The two columns that tell most about the target."""
    rows = _returned(spark, sf)
    chosen = classifier_pipeline([*NUMBERS, "fixed"], "returned", LogisticRegression(), k=2)
    model = chosen.getStages()[0].fit(rows)
    return spark.createDataFrame([(c,) for c in model.stages[0].getInputCols()], "feature string")


def q_minmax(spark, sf):
    lines = V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", *NUMBERS, F.lit(7).alias("fixed")
    )
    out = min_max_scale(lines, [*NUMBERS, "fixed"])
    return out.withColumns({c: F.round(c, 8) for c in (*NUMBERS, "fixed")})


def _judged(spark, sf):
    """Documents: is the quality flag a guess at "not toxic"? Split by language."""
    documents = V.table(spark, sf, "documents").select("doc_id", "lang")
    labels = V.table(spark, sf, "labels")
    return labels.join(documents, "doc_id").select(
        F.col("lang").alias("split"), (1 - F.col("toxic")).alias("y"), F.col("quality").alias("pred")
    )


def q_confusion(spark, sf):
    return confusion_matrix(_judged(spark, sf), "y", "pred")


def q_metrics(spark, sf):
    """Metrics per split, through the long form and back to a table."""
    metrics = classification_metrics(_judged(spark, sf), "y", "pred", "split")
    return metrics_table(metrics_long(metrics, "split"), "split")


METRICS = """
with judged as (
  select lang split, 1 - toxic y, quality pred from labels join documents using (doc_id)),
cells as (
  select split, count(*) n, count(*) filter (y = 1 and pred = 1) tp,
         count(*) filter (y = 0 and pred = 1) fp, count(*) filter (y = 1 and pred = 0) fn,
         count(*) filter (y = pred) hit
  from judged group by split)
select split, round(hit / n, 4) accuracy, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4)
  f1_score, round(coalesce(tp / nullif(tp + fp, 0), 0), 4) as "precision",
  round(coalesce(tp / nullif(tp + fn, 0), 0), 4) recall
from cells"""


def _split(spark, sf):
    orders = V.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return exact_split(orders, ["o_orderkey"], 0.25, 42)


def q_split_test(spark, sf):
    """An exact quarter of the orders, the same in every run."""
    return _split(spark, sf)[0]


def q_split_train(spark, sf):
    return _split(spark, sf)[1]


SPLIT = """
with numbered as (
  select o_orderkey, o_custkey, o_totalprice,
         row_number() over (order by md5('42:' || o_orderkey::varchar)) rn, count(*) over () n
  from orders)
select o_orderkey, o_custkey, o_totalprice from numbered where rn {} round_even(0.25 * n, 0)"""


def q_top_bottom(spark, sf):
    """The ten customers that spent most and least, small names left out."""
    spent = (
        V.table(spark, sf, "orders")
        .groupBy(F.concat(F.lit("customer_"), F.col("o_custkey").cast("string")).alias("feature"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("feature_coef"))
        .where(~F.col("feature").contains("_99"))
    )
    return top_bottom(spent, "feature", "feature_coef", 10)


TOP_BOTTOM = """
with spent as (
  select 'customer_' || o_custkey::varchar feature, round(sum(o_totalprice), 2) feature_coef
  from orders group by o_custkey),
kept as (select * from spent where feature not like '%\\_99%' escape '\\')
select feature, feature_coef, rn::int as "position" from (
  select *, row_number() over (order by feature_coef desc, feature) rn from kept) where rn <= 10
union all select '...', null, 11
union all
select feature, feature_coef, (22 - rn)::int from (
  select *, row_number() over (order by feature_coef, feature desc) rn from kept) where rn <= 10"""


def q_sort_by_time(spark, sf):
    """Orders by date, then key: the order of a report."""
    orders = V.table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return orders.orderBy(*ordering(["o_orderdate", "o_orderkey"]))


def q_group_max(spark, sf):
    """Latest order date and count per customer."""
    return V.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("latest"), F.count(F.lit(1)).alias("n")
    )


QUERIES = {
    "q_column_totals": q_column_totals,
    "q_cond_rate": q_cond_rate,
    "q_corr_target": q_corr_target,
    "q_f_scores": q_f_scores,
    "q_select_k": q_select_k,
    "q_minmax": q_minmax,
    "q_confusion": q_confusion,
    "q_metrics": q_metrics,
    "q_split_test": q_split_test,
    "q_split_train": q_split_train,
    "q_top_bottom": q_top_bottom,
    "q_sort_by_time": q_sort_by_time,
    "q_group_max": q_group_max,
}


def _per_column(template: str, columns: list[str]) -> str:
    return " union all ".join(template.replace("{c}", c) for c in columns)


_GUARDED = (
    "case when stddev_pop({c}) > 0 and stddev_pop(returned) > 0 "
    "then covar_pop({c}, returned) / (stddev_pop({c}) * stddev_pop(returned)) end"
)
_F = f"""with {RETURNED}, r as ({_per_column(
    f"select '{{c}}' feature, count(*) n, {_GUARDED} r from returned", [*NUMBERS, "fixed"])}),
f as (select feature, r * r / (1 - r * r) * (n - 2) f_score from r)"""

ORACLE = {
    "q_column_totals": f"with {RETURNED} "
    + _per_column(
        "select '{c}' column_name, count(*) as \"rows\", count({c}) known, "
        "sum(round({c} * 100)::bigint)::double total, avg(round({c} * 100)::bigint) mean, "
        "bool_or({c} <> 0) any_set "
        "from returned",
        [*NUMBERS, "fixed", "returned"],
    ),
    "q_cond_rate": f"""with {RETURNED}
select 'large' as "condition", count(*) as "rows", round(avg(returned), 8) rate
from returned where l_quantity > 25
union all
select 'discount_above_tax', count(*), round(avg(returned), 8) from returned
where l_discount > l_tax""",
    "q_corr_target": f"with {RETURNED} "
    + _per_column(
        f"select '{{c}}' feature, round({_GUARDED}, 8) correlation from returned",
        [*NUMBERS, "fixed", "returned"],
    ),
    "q_f_scores": f"{_F} select feature, round(f_score, 4) f_score from f",
    "q_select_k": f"{_F} select feature from f order by f_score desc nulls last, feature limit 2",
    "q_minmax": "select l_orderkey, l_partkey, "
    + ", ".join(
        f"round(({c} - min({c}) over ()) / (max({c}) over () - min({c}) over ()), 8) {c}"
        for c in NUMBERS
    )
    + ", 0.0::double fixed from lineitem",
    "q_confusion": """
with judged as (select 1 - toxic y, quality pred from labels join documents using (doc_id))
select a actual, count(*) filter (y = a and pred = 0) predicted_0,
       count(*) filter (y = a and pred = 1) predicted_1
from (values (0), (1)) t(a) left join judged on y = a group by a""",
    "q_metrics": METRICS,
    "q_split_test": SPLIT.format("<="),
    "q_split_train": SPLIT.format(">"),
    "q_top_bottom": TOP_BOTTOM,
    "q_sort_by_time": "select o_orderdate, o_orderkey from orders order by 1, 2",
    "q_group_max": "select o_custkey, max(o_orderdate) latest, count(*) n from orders group by 1",
}
