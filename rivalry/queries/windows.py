"""Running, rolling, streak and fill queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivalry.functions import normalize_category, win_rate
from rivalry.operators.cleanse import category_domain
from rivalry.operators.encode import drop_sparse, fill_mean, null_fractions, require_all
from rivalry.operators.history import (
    Scan,
    fill_within,
    find_busy,
    first_per_group,
    latest_per_group,
    running,
)
from rivalry.operators.joins import left_enrich
from rivalry.queries import views as V

ORDER = ["event_date", "contest_id"]
STREAM_ORDER = ["event_time", "contest_id"]
OVER = "(partition by entity_id order by event_date, contest_id rows"
STREAM_OVER = "(partition by entity_id order by event_time, contest_id rows"
SO_FAR = "between unbounded preceding and current row)"
WIDTHS = [1, 3, 5, 10, 20]
METHODS = ["1_urgent", "2_high", "3_medium", "4_not_specified", "5_low"]
REGIONS = ["africa", "america", "asia", "europe", "middle_east"]


def _flag(condition):
    return F.when(condition, 1).otherwise(0)


def _rate_sql(wins: str, losses: str, default: str) -> str:
    return f"coalesce({wins}::double / nullif({wins} + {losses}, 0), {default})"


def running_totals(df, order=ORDER, busy=None):
    scan = Scan(sums={"wins": _flag(F.col("win")), "losses": _flag(F.col("loss"))})
    return running(df, ["entity_id"], order, scan, busy=busy).withColumn(
        "winrate", win_rate(F.col("wins"), F.col("losses"), F.lit(0.5))
    )


RUNNING = f"""
totals as (
  select *, sum(win::int) over {OVER} {SO_FAR}::bigint wins,
         sum(loss::int) over {OVER} {SO_FAR}::bigint losses
  from history),
run as (select *, {_rate_sql('wins', 'losses', '0.5')} winrate from totals)"""


def q_running_sum(spark, sf):
    return running_totals(V.history(spark, sf)).select(
        "contest_id", "entity_id", "event_date", "wins", "losses", "winrate"
    )


def q_running_mean(spark, sf):
    cents = F.round(F.col("stat") * 100).cast("bigint")
    scan = Scan(means={"mean_cents": cents})
    out = running(V.history(spark, sf), ["entity_id"], ORDER, scan)
    return out.select("contest_id", "entity_id", "mean_cents")


def q_running_mean_events(spark, sf):
    cents = F.round(F.col("value") * 100).cast("bigint")
    scan = Scan(means={"mean_cents": cents})
    out = running(V.stream(spark, sf), ["entity_id"], STREAM_ORDER, scan)
    return out.select("contest_id", "entity_id", "mean_cents")


LINE_KEYS = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"]
ROUNDS = [1, 2, 3, 4, 5]


def q_running_by_round(spark, sf):
    """The line number as the round; a returned line wins, an accepted one loses."""
    lines = V.table(spark, sf, "lineitem").select("l_suppkey", *LINE_KEYS)
    won, lost = F.col("l_returnflag") == "R", F.col("l_returnflag") == "A"
    scan = Scan(
        sums={
            f"round{r}_{kind}": _flag(flag & (F.col("l_linenumber") == r))
            for r in ROUNDS
            for kind, flag in (("wins", won), ("losses", lost))
        }
    )
    out = running(lines, ["l_suppkey"], LINE_KEYS, scan)
    return out.withColumns(
        {
            f"round{r}_winrate": win_rate(
                F.col(f"round{r}_wins"), F.col(f"round{r}_losses"), F.lit(0.5)
            )
            for r in ROUNDS
        }
    )


def _round_sql() -> str:
    over = f"(partition by l_suppkey order by {', '.join(LINE_KEYS)} rows {SO_FAR}"
    sums = [
        f"sum((l_returnflag = '{flag}' and l_linenumber = {r})::int) over {over}::bigint "
        f"round{r}_{kind}"
        for r in ROUNDS
        for kind, flag in (("wins", "R"), ("losses", "A"))
    ]
    rates = [
        f"{_rate_sql(f'round{r}_wins', f'round{r}_losses', '0.5')} round{r}_winrate"
        for r in ROUNDS
    ]
    return (
        f"select *, {', '.join(rates)} from (select l_suppkey, {', '.join(LINE_KEYS)}, "
        f"{', '.join(sums)} from lineitem)"
    )


def _grouped_scan(column, values, prefix, won, lost):
    return Scan(
        sums={
            f"{prefix}_{v}_{kind}": _flag(flag & (F.col(column) == v))
            for v in values
            for kind, flag in (("wins", won), ("losses", lost))
        }
    )


def _grouped_rates(df, values, prefix):
    return df.withColumns(
        {
            f"{prefix}_{v}_winrate": win_rate(
                F.col(f"{prefix}_{v}_wins"), F.col(f"{prefix}_{v}_losses"), F.col("winrate")
            )
            for v in values
        }
    )


def _grouped_outputs(values, prefix):
    return [f"{prefix}_{v}_{k}" for v in values for k in ("wins", "losses", "winrate")]


def q_running_by_category(spark, sf):
    df = V.history(spark, sf).withColumn("method", normalize_category(F.translate("method", "-", " ")))
    methods = category_domain(df, "method")
    scan = _grouped_scan("method", methods, "method", F.col("win"), ~F.col("win"))
    busy = find_busy(df, ["entity_id"])
    out = running(running_totals(df, busy=busy), ["entity_id"], ORDER, scan, busy=busy)
    return _grouped_rates(out, methods, "method").select(
        "contest_id", "entity_id", *_grouped_outputs(methods, "method")
    )


def _grouped_sql(source: str, column: str, values: list[str], prefix: str) -> str:
    sums = [
        f"sum(({test} and {column} = '{v}')::int) over {OVER} {SO_FAR}::bigint {prefix}_{v}_{kind}"
        for v in values
        for kind, test in (("wins", "win"), ("losses", "not win"))
    ]
    rates = [
        f"{_rate_sql(f'{prefix}_{v}_wins', f'{prefix}_{v}_losses', 'winrate')} {prefix}_{v}_winrate"
        for v in values
    ]
    plain = [f"{prefix}_{v}_{kind}" for v in values for kind in ("wins", "losses")]
    return (
        f"select contest_id, entity_id, {', '.join(plain)}, {', '.join(rates)} "
        f"from (select *, {', '.join(sums)} from {source})"
    )


def q_running_by_opponent_category(spark, sf):
    """Totals of suppliers by the opponent's region."""
    nation, region = V.table(spark, sf, "nation"), V.table(spark, sf, "region")
    homes = (
        V.table(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("opponent_id"), normalize_category("r_name").alias("home"))
    )
    rows = V.pairs(spark, sf).withColumnsRenamed({"entity_win": "win", "opponent_win": "loss"})
    rows = left_enrich(rows, homes, ["opponent_id"])
    homes_seen = category_domain(homes, "home")
    scan = _grouped_scan("home", homes_seen, "against", F.col("win"), ~F.col("win"))
    busy = find_busy(rows, ["entity_id"])
    out = running(running_totals(rows, busy=busy), ["entity_id"], ORDER, scan, busy=busy)
    return _grouped_rates(out, homes_seen, "against").select(
        "contest_id", "entity_id", *_grouped_outputs(homes_seen, "against")
    )


OPPONENT_CATEGORY_SQL = f"""with {V.PAIRS},
history as (
  select contest_id, pairs.entity_id, event_date, entity_win win, opponent_win loss,
         replace(lower(r_name), ' ', '_') home
  from pairs join supplier on opponent_id = s_suppkey join nation on s_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey), {RUNNING}
{_grouped_sql('run', 'home', REGIONS, 'against')}"""


def _rolling(df, order):
    scan = Scan(
        rolling={
            f"last{n}_{kind}": (_flag(F.col(flag)), n)
            for n in WIDTHS
            for kind, flag in (("wins", "win"), ("losses", "loss"))
        }
    )
    busy = find_busy(df, ["entity_id"])
    out = running(running_totals(df, order, busy), ["entity_id"], order, scan, busy=busy)
    rates = {
        f"last{n}_winrate": win_rate(
            F.col(f"last{n}_wins"), F.col(f"last{n}_losses"), F.col("winrate")
        )
        for n in WIDTHS
    }
    return out.withColumns(rates).select(
        "contest_id",
        "entity_id",
        *[f"last{n}_{k}" for n in WIDTHS for k in ("wins", "losses", "winrate")],
    )


def _rolling_sql(over: str, source: str) -> str:
    sums = [
        f"sum({flag}::int) over {over} between {n - 1} preceding and current row)::bigint "
        f"last{n}_{kind}"
        for n in WIDTHS
        for kind, flag in (("wins", "win"), ("losses", "loss"))
    ]
    rates = [
        f"{_rate_sql(f'last{n}_wins', f'last{n}_losses', 'winrate')} last{n}_winrate"
        for n in WIDTHS
    ]
    plain = [f"last{n}_{kind}" for n in WIDTHS for kind in ("wins", "losses")]
    return (
        f"select contest_id, entity_id, {', '.join(plain)}, {', '.join(rates)} "
        f"from (select *, {', '.join(sums)} from {source})"
    )


STREAM_RUNNING = RUNNING.replace(OVER, STREAM_OVER).replace("from history", "from stream")


def q_rolling(spark, sf):
    return _rolling(V.history(spark, sf), ORDER)


def q_rolling_events(spark, sf):
    return _rolling(V.stream(spark, sf), STREAM_ORDER)


def _streaks(df, order):
    scan = Scan(streaks={"win_streak": F.col("win"), "loss_streak": F.col("loss")})
    out = running(df, ["entity_id"], order, scan)
    return out.select("contest_id", "entity_id", "win_streak", "loss_streak")


def q_streaks(spark, sf):
    return _streaks(V.history(spark, sf), ORDER)


def q_streaks_events(spark, sf):
    return _streaks(V.stream(spark, sf), STREAM_ORDER)


def _streak_sql(over: str, source: str) -> str:
    """Gaps and islands: rows since the last break of the same entity."""
    return f"""select contest_id, entity_id,
  sum(win::int) over (partition by entity_id, win_island order by rn)::bigint win_streak,
  sum(loss::int) over (partition by entity_id, loss_island order by rn)::bigint loss_streak
from (select *, sum((not win)::int) over (partition by entity_id order by rn) win_island,
             sum((not loss)::int) over (partition by entity_id order by rn) loss_island
      from (select *, count(*) over {over} {SO_FAR} rn from {source}))"""


def q_fill_within(spark, sf):
    df = V.history(spark, sf).select("contest_id", "entity_id", "event_date", "stat")
    return fill_within(df, ["entity_id"], ORDER, ["stat"])


def q_fill_forward(spark, sf):
    df = V.history(spark, sf).select("contest_id", "entity_id", "event_date", "stat")
    return fill_within(df, ["entity_id"], ORDER, ["stat"], backward=False)


FORWARD = f"last_value(stat ignore nulls) over {OVER} {SO_FAR}"
WHOLE = "between unbounded preceding and unbounded following)"
FILLED = f"coalesce({FORWARD}, first_value(stat ignore nulls) over {OVER} {WHOLE})"


def q_fill_mean(spark, sf):
    """Gaps filled within the entity, then with the mean."""
    out = fill_mean(q_fill_within(spark, sf), ["stat"])
    return out.select("contest_id", "entity_id", F.round("stat", 4).alias("stat"))


def _with_gaps(spark, sf):
    orders = V.table(spark, sf, "orders")
    known = F.col("o_orderpriority")
    return orders.select(
        "o_orderkey",
        F.when(known != "5-LOW", F.col("o_totalprice")).alias("round1_stat"),
        F.when(known == "1-URGENT", F.col("o_totalprice")).alias("round4_stat"),
        F.when(known == "2-HIGH", F.col("o_totalprice")).alias("other_stat"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("round5_key"),
    )


GAPS = """gaps as (
  select o_orderkey, case when o_orderpriority <> '5-LOW' then o_totalprice end round1_stat,
         case when o_orderpriority = '1-URGENT' then o_totalprice end round4_stat,
         case when o_orderpriority = '2-HIGH' then o_totalprice end other_stat,
         case when o_orderstatus <> 'P' then o_custkey end round5_key
  from orders)"""


def q_null_fraction(spark, sf):
    return null_fractions(_with_gaps(spark, sf)).select(
        "column_name", F.round("null_fraction", 8).alias("null_fraction")
    )


def q_drop_sparse(spark, sf):
    """Mostly empty late-round columns go; a mostly empty other column stays."""
    return drop_sparse(_with_gaps(spark, sf), 0.5, ["round4", "round5"])


def q_require_all(spark, sf):
    return require_all(_with_gaps(spark, sf), ["round1_stat", "round5_key"])


def q_latest_per_group(spark, sf):
    df = V.history(spark, sf).select("contest_id", "entity_id", "event_date", "stat")
    return latest_per_group(df, ["entity_id"], "event_date")


def q_first_per_group(spark, sf):
    df = V.history(spark, sf).select("contest_id", "entity_id", "event_date", "stat")
    return first_per_group(df, ["entity_id"], ORDER)


QUERIES = {
    "q_running_sum": q_running_sum,
    "q_running_mean": q_running_mean,
    "q_running_mean_events": q_running_mean_events,
    "q_running_by_round": q_running_by_round,
    "q_running_by_category": q_running_by_category,
    "q_running_by_opponent_category": q_running_by_opponent_category,
    "q_rolling": q_rolling,
    "q_rolling_events": q_rolling_events,
    "q_streaks": q_streaks,
    "q_streaks_events": q_streaks_events,
    "q_fill_within": q_fill_within,
    "q_fill_forward": q_fill_forward,
    "q_fill_mean": q_fill_mean,
    "q_null_fraction": q_null_fraction,
    "q_drop_sparse": q_drop_sparse,
    "q_require_all": q_require_all,
    "q_latest_per_group": q_latest_per_group,
    "q_first_per_group": q_first_per_group,
}

_METHOD_HISTORY = V.HISTORY.replace(
    'lower(o_orderpriority) as "method"',
    """replace(replace(lower(o_orderpriority), '-', ' '), ' ', '_') as "method\"""",
)

ORACLE = {
    "q_running_sum": f"with {V.HISTORY}, {RUNNING} "
    "select contest_id, entity_id, event_date, wins, losses, winrate from run",
    "q_running_mean": f"with {V.HISTORY} select contest_id, entity_id, "
    f"avg(round(stat * 100)::bigint) over {OVER} {SO_FAR} mean_cents from history",
    "q_running_mean_events": f"with {V.STREAM} select contest_id, entity_id, "
    f'avg(round("value" * 100)::bigint) over {STREAM_OVER} {SO_FAR} mean_cents from stream',
    "q_running_by_round": _round_sql(),
    "q_running_by_category": f"with {_METHOD_HISTORY}, {RUNNING} "
    + _grouped_sql("run", '"method"', METHODS, "method"),
    "q_running_by_opponent_category": OPPONENT_CATEGORY_SQL,
    "q_rolling": f"with {V.HISTORY}, {RUNNING} {_rolling_sql(OVER, 'run')}",
    "q_rolling_events": f"with {V.STREAM}, {STREAM_RUNNING} {_rolling_sql(STREAM_OVER, 'run')}",
    "q_streaks": f"with {V.HISTORY} {_streak_sql(OVER, 'history')}",
    "q_streaks_events": f"with {V.STREAM} {_streak_sql(STREAM_OVER, 'stream')}",
    "q_fill_within": f"with {V.HISTORY} select contest_id, entity_id, event_date, "
    f"{FILLED} stat from history",
    "q_fill_forward": f"with {V.HISTORY} select contest_id, entity_id, event_date, "
    f"{FORWARD} stat from history",
    "q_fill_mean": f"with {V.HISTORY}, filled as (select contest_id, entity_id, {FILLED} stat "
    "from history) select contest_id, entity_id, "
    "round(coalesce(stat, avg(stat) over ()), 4) stat from filled",
    "q_null_fraction": f"with {GAPS} select column_name, round(null_fraction, 8) null_fraction "
    "from (unpivot (select "
    + ", ".join(
        f"avg(({c} is null)::int) as {c}"
        for c in ("o_orderkey", "round1_stat", "round4_stat", "other_stat", "round5_key")
    )
    + " from gaps) on columns(*) into name column_name value null_fraction)",
    "q_drop_sparse": f"with {GAPS} select o_orderkey, round1_stat, other_stat, round5_key from gaps",
    "q_require_all": f"with {GAPS} select * from gaps "
    "where round1_stat is not null and round5_key is not null",
    "q_latest_per_group": f"with {V.HISTORY} select contest_id, entity_id, event_date, stat "
    "from history h where event_date = "
    "(select max(event_date) from history m where m.entity_id = h.entity_id)",
    "q_first_per_group": f"with {V.HISTORY} select contest_id, entity_id, event_date, stat "
    "from history qualify row_number() over "
    "(partition by entity_id order by event_date, contest_id) = 1",
}
