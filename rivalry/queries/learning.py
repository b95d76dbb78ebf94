"""Folds, models and reports.

The models are fitted on one-hot groups without an intercept: there a logistic regression has a
closed form, which the SQL states. Each coefficient is its group's log odds, a penalty shrinks
it without changing its sign, and the prediction is the majority of the group's fitted rows.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from rivalry.functions import normalize_category
from rivalry.operators import learn as L
from rivalry.operators.sample import exact_split
from rivalry.plans import modelling
from rivalry.plans import names as N
from rivalry.queries import views as V
from rivalry.session import scratch_path, stored
from rivalry.sources import files, models

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
GROUPS = ["urgent", "high", "medium", "unspecified", "low"]
REGIONS = ["africa", "america", "asia", "europe", "middle_east"]
SINCE = "2000-01-01"
K_CHOICES = [1, 3, 5]


def _plain() -> LogisticRegression:
    """A group of as many wins as losses is predicted 0, whatever the last digit of its odds."""
    return LogisticRegression(
        fitIntercept=False, standardization=False, maxIter=300, tol=1e-12, threshold=0.5 + 1e-7
    )


def _ended(spark, sf):
    """Ended orders, one column for each priority; done ones are won."""
    orders = V.table(spark, sf, "orders").where(F.col("o_orderstatus").isin("F", "O"))
    return orders.select(
        "o_orderkey",
        "o_orderdate",
        *[(F.col("o_orderpriority") == p).cast("int").alias(g) for p, g in zip(PRIORITIES, GROUPS)],
        (F.col("o_orderstatus") == "F").cast("int").alias(N.WIN),
    )


def _split(spark, sf):
    return exact_split(stored(_ended(spark, sf)), ["o_orderkey"], N.TEST_SHARE, N.SEED)


def _fitted(spark, sf):
    test, train = _split(spark, sf)
    return L.classifier_pipeline(GROUPS, N.WIN, _plain()).fit(train), train, test


ENDED = f"""ended as (
  select o_orderkey, o_orderdate, o_orderpriority prio, (o_orderstatus = 'F')::int won,
         row_number() over (order by md5('{N.SEED}:' || o_orderkey::varchar)) rn,
         count(*) over () n
  from orders where o_orderstatus in ('F', 'O')),
split as (
  select *, case when rn <= round_even({N.TEST_SHARE} * n, 0) then 'test' else 'train' end as split
  from ended),
odds as (select prio, avg(won) p from split where split = 'train' group by prio),
scored as (select s.*, (p > 0.5)::int pred from split s join odds using (prio))"""


def q_folds(spark, sf):
    """Five stratified folds of the orders in date order, by whether they are done."""
    orders = V.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", (F.col("o_orderstatus") == "F").cast("int").alias("done")
    )
    out = L.stratified_folds(orders, "done", ["o_orderdate", "o_orderkey"], 5)
    return out.select("o_orderkey", "done", F.col(L.FOLD).alias("fold"))


def _folds_sql(rows: str, folds: int) -> str:
    """Folds of ``rows`` (o_orderkey, o_orderdate, done), as the tables up to ``folded``."""
    return f"""
rows as (
  select *, row_number() over (order by o_orderdate, o_orderkey) pos from ({rows})),
labels as (
  select *, min(pos) over (partition by done) first_pos,
         row_number() over (partition by done order by pos) n from rows),
sorted as (select *, row_number() over (order by first_pos, pos) - 1 place from labels),
dealt as (select done, place % {folds} fold, count(*) size from sorted group by all),
ends as (select done, fold, sum(size) over (partition by done order by fold) stop from dealt),
folded as (
  select o_orderkey, s.done, min(fold)::int fold
  from labels s join ends e on s.done = e.done and s.n <= e.stop group by all)"""


FOLDS = (
    "with "
    + _folds_sql(
        "select o_orderkey, o_orderdate, (o_orderstatus = 'F')::int done from orders", 5
    )
    + " select o_orderkey, done, fold from folded"
)


def q_lr_predict(spark, sf):
    """Predictions for the held-out quarter."""
    model, _, test = _fitted(spark, sf)
    return L.score(test, model).select("o_orderkey", N.WIN, "predicted_win")


def q_model_metrics(spark, sf):
    """Metrics of the model on the rows it saw and on the others."""
    return modelling.evaluate(*_fitted(spark, sf))[0]


def q_model_confusion(spark, sf):
    return modelling.evaluate(*_fitted(spark, sf))[1]


def q_coefs(spark, sf):
    """The strongest coefficients of both signs, and a gap between."""
    model, _, _ = _fitted(spark, sf)
    return modelling.importances(spark, model, 2).withColumn("feature_coef", F.round("feature_coef", 4))


def q_refit(spark, sf):
    """The model fitted again on all rows, saved and loaded, and its predictions."""
    rows = stored(_ended(spark, sf))
    model = L.classifier_pipeline(GROUPS, N.WIN, _plain()).fit(rows)
    path = scratch_path(spark)
    models.save_model(model, path)
    return L.score(rows, models.load_model(path)).select("o_orderkey", "predicted_win")


def q_cv(spark, sf):
    """Accuracy over five folds in date order."""
    rows = stored(_ended(spark, sf))
    pipeline = L.classifier_pipeline(GROUPS, N.WIN, _plain())
    accuracy = L.cross_validate(pipeline, rows, N.WIN, ["o_orderdate", "o_orderkey"])
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("accuracy", F.round(F.lit(accuracy), 9))


def q_search(spark, sf):
    """The best accuracy over three folds of all draws of penalty and number of columns."""
    rows = stored(_ended(spark, sf))
    family = L.Family(_plain(), {"C": [0.1, 1.0, 10.0]})
    found = L.randomized_search(
        rows, GROUPS, N.WIN, ["o_orderdate", "o_orderkey"], family, k_choices=K_CHOICES, draws=9
    )
    best = F.round(F.lit(found["best_score"]), 9)
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("accuracy", best)


def _accuracy_sql(folds: int, choices: list[int]) -> str:
    """Best mean accuracy; a group beyond the k of the highest F score is predicted 0."""
    ended = "select o_orderkey, o_orderdate, (o_orderstatus = 'F')::int done from orders"
    listed = ", ".join(f"('{p}', {i})" for i, p in enumerate(PRIORITIES))
    ks = ", ".join(f"({k})" for k in choices)
    return f"""with {_folds_sql(ended + " where o_orderstatus in ('F', 'O')", folds)},
cases as (
  select f.*, o_orderpriority prio from folded f join orders using (o_orderkey)),
held as (select distinct fold held from folded),
groups as (
  select held, prio, count(*) n_g, sum(done) s_g
  from cases join held on fold <> held group by all),
totals as (select held, sum(n_g) n, sum(s_g) s from groups group by held),
listed as (select * from (values {listed}) t(prio, pos)),
ranked as (
  select held, prio, s_g / n_g > 0.5 majority, row_number() over (partition by held order by
    round(power(s_g / n - (n_g / n) * (s / n), 2) / ((n_g / n) * (1 - n_g / n)), 14) desc,
    listed.pos) place
  from groups join totals using (held) join listed using (prio)),
tried as (
  select k, held, avg((done = (majority and place <= k)::int)::int) accuracy
  from cases join ranked using (prio), (values {ks}) t(k) where fold = held group by all),
means as (select k, avg(accuracy) accuracy from tried group by k)
select (select count(*) from folded) as rows, round(max(accuracy), 9) accuracy from means"""


def _homes(spark, sf):
    """Suppliers with name and region, as contestants."""
    return (
        V.table(spark, sf, "supplier")
        .join(V.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(V.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias(N.ENTITY),
            F.col("s_name").alias("fighter_name"),
            normalize_category("r_name").alias("home"),
        )
    )


def q_report(spark, sf):
    """Predicted winners of the later bouts by region, one row per bout, with names."""
    homes = _homes(spark, sf)
    pairs = V.pairs(spark, sf).select(
        F.col("event_date").alias(N.TIME),
        F.col("contest_id").alias(N.CONTEST),
        F.col("entity_id").alias(N.ENTITY),
        F.col("opponent_id").alias(N.OPPONENT),
        F.col("entity_win").cast("int").alias(N.WIN),
        (F.col("entity_win") | F.col("opponent_win")).alias("decided"),
    )
    regions = [(F.col("home") == r).cast("int").alias(f"home_{r}") for r in REGIONS]
    rows = stored(pairs.join(homes.drop("fighter_name"), N.ENTITY).select("*", *regions))
    columns = [f"home_{r}" for r in REGIONS]
    train = rows.where((F.col(N.TIME) < F.lit(SINCE).cast("date")) & F.col("decided"))
    model = L.classifier_pipeline(columns, N.WIN, _plain()).fit(train)
    upcoming = rows.where(F.col(N.TIME) >= F.lit(SINCE).cast("date")).select(*N.KEYS, *columns)
    return modelling.predict_upcoming(upcoming, model, homes.drop("home"))


REPORT = f"""
with {V.PAIRS},
homes as (
  select s_suppkey, s_name, n_regionkey home from supplier join nation on s_nationkey = n_nationkey),
won as (
  select home, avg(entity_win::int) > 0.5 majority
  from pairs join homes on s_suppkey = entity_id
  where event_date < date '{SINCE}' and (entity_win or opponent_win) group by home),
once as (
  select contest_id, min(entity_id) entity_id, max(entity_id) opponent_id
  from pairs where event_date >= date '{SINCE}' group by contest_id)
select a.s_name fighter_name, b.s_name opponent_name, majority::int predicted_win
from once join homes a on a.s_suppkey = entity_id join homes b on b.s_suppkey = opponent_id
join won on won.home = a.home"""


def q_csv_round_trip(spark, sf):
    """Customers written as CSV and read again: quotes, commas, line breaks, empty cells."""
    customers = V.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.concat(F.col("c_name"), F.lit('\n"of", '), F.col("c_mktsegment")).alias("described"),
        F.when(F.col("c_nationkey") > 5, F.col("c_nationkey").cast("string")).alias("nation"),
    )
    path = scratch_path(spark)
    files.write_csv(customers, path)
    return files.read_raw(spark, path)


CSV = """
select c_custkey::varchar c_custkey, c_name || chr(10) || '"of", ' || c_mktsegment described,
       case when c_nationkey > 5 then c_nationkey::varchar end nation
from customer"""


QUERIES = {
    "q_folds": q_folds,
    "q_lr_predict": q_lr_predict,
    "q_model_metrics": q_model_metrics,
    "q_model_confusion": q_model_confusion,
    "q_coefs": q_coefs,
    "q_refit": q_refit,
    "q_cv": q_cv,
    "q_search": q_search,
    "q_report": q_report,
    "q_csv_round_trip": q_csv_round_trip,
}

ORACLE = {
    "q_folds": FOLDS,
    "q_lr_predict": f"with {ENDED} select o_orderkey, won {N.WIN}, pred predicted_win from scored "
    "where split = 'test'",
    "q_model_metrics": f"""with {ENDED},
cells as (
  select split, count(*) n, count(*) filter (won = 1 and pred = 1) tp,
         count(*) filter (won = 0 and pred = 1) fp, count(*) filter (won = 1 and pred = 0) fn,
         count(*) filter (won = pred) hit
  from scored group by split)
select split, round(hit / n, 4) accuracy,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) f1_score,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 4) as "precision",
  round(coalesce(tp / nullif(tp + fn, 0), 0), 4) recall from cells""",
    "q_model_confusion": f"""with {ENDED}
select a.actual, count(*) filter (pred = 0) predicted_0, count(*) filter (pred = 1) predicted_1
from (values (0), (1)) a(actual) left join (select * from scored where split = 'test') s
  on s.won = a.actual group by a.actual""",
    "q_coefs": f"""with {ENDED},
coefs as (
  select case prio {' '.join(f"when '{p}' then '{g}'" for p, g in zip(PRIORITIES, GROUPS))} end feature,
         ln(p / (1 - p)) coef from odds),
ranked as (
  select *, row_number() over (order by coef desc, feature) up, count(*) over () n from coefs)
select feature, round(coef, 4) feature_coef, up::int position from ranked where up <= 2
union all select '...', null, 3
union all select feature, round(coef, 4), (up - n + 5)::int from ranked where up > n - 2""",
    "q_refit": """
with odds as (
  select o_orderpriority, avg((o_orderstatus = 'F')::int) > 0.5 majority
  from orders where o_orderstatus in ('F', 'O') group by 1)
select o_orderkey, majority::int predicted_win
from orders join odds using (o_orderpriority) where o_orderstatus in ('F', 'O')""",
    "q_cv": _accuracy_sql(5, [5]),
    "q_search": _accuracy_sql(3, K_CHOICES),
    "q_report": REPORT,
    "q_csv_round_trip": CSV,
}
