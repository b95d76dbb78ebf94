"""As-of lookups and the other joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivalry.functions import win_rate
from rivalry.operators.history import Scan, running
from rivalry.operators.joins import (
    asof_join,
    crawl_frontier,
    enrich_by_derived_key,
    left_enrich,
    natural_join,
    rename_side,
    right_enrich,
    two_sided_asof,
)
from rivalry.operators.sample import complement
from rivalry.queries import views as V
from rivalry.session import stored
from rivalry.queries.windows import OVER, RUNNING, SO_FAR, running_totals


def q_asof_prev_form(spark, sf):
    """Each order with its customer's running totals as of the previous order date."""
    past = running_totals(V.history(spark, sf)).select(
        "entity_id",
        F.col("event_date").alias("prev_date"),
        F.col("contest_id").alias("prev_contest_id"),
        F.col("wins").alias("prev_wins"),
        F.col("losses").alias("prev_losses"),
        F.col("winrate").alias("prev_winrate"),
    )
    contests = V.history(spark, sf).select("contest_id", "entity_id", "event_date")
    return asof_join(contests, past, "entity_id", "event_date", "prev_date")


def q_asof_cross(spark, sf):
    """Each shipped line with its supplier's latest earlier bouts, all of that day."""
    past = V.sides(spark, sf).select(
        F.col("entity_id").alias("l_suppkey"),
        F.col("event_date").alias("bout_date"),
        F.col("contest_id").alias("bout_id"),
        "entity_win",
    )
    lines = V.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.to_date("l_shipdate").alias("ship_date"),
    )
    return asof_join(lines, past, "l_suppkey", "ship_date", "bout_date")


def _form(rows):
    """Running totals of contestants, named as features of the entity."""
    scan = Scan(
        sums={
            "entity_wins": F.when(F.col("entity_win"), 1).otherwise(0),
            "entity_losses": F.when(F.col("opponent_win"), 1).otherwise(0),
        }
    )
    out = running(rows, ["entity_id"], ["event_date", "contest_id"], scan)
    rate = win_rate(F.col("entity_wins"), F.col("entity_losses"), F.lit(0.5))
    return out.withColumn("entity_winrate", rate).select(
        "entity_id", "event_date", "entity_wins", "entity_losses", "entity_winrate"
    )


FORM = f"""{V.PAIRS},
totals as (
  select *, sum(entity_win::int) over {OVER} {SO_FAR}::bigint entity_wins,
         sum(opponent_win::int) over {OVER} {SO_FAR}::bigint entity_losses
  from SOURCE),
form as (
  select *, coalesce(entity_wins::double / nullif(entity_wins + entity_losses, 0), 0.5)
    entity_winrate
  from totals)"""

TWO_SIDED = """
own as (
  select c.contest_id, c.event_date, c.entity_id, c.opponent_id,
         f.entity_wins, f.entity_losses, f.entity_winrate
  from contests c join form f on f.entity_id = c.entity_id and f.event_date < c.event_date
  qualify rank() over (partition by c.contest_id, c.entity_id order by f.event_date desc) = 1),
numbered as (select *, row_number() over () n from own)
select o.contest_id, o.event_date, o.entity_id, o.opponent_id, o.entity_wins, o.entity_losses,
       o.entity_winrate, f.entity_wins opponent_wins, f.entity_losses opponent_losses,
       f.entity_winrate opponent_winrate
from numbered o join form f on f.entity_id = o.opponent_id and f.event_date < o.event_date
qualify rank() over (partition by o.n order by f.event_date desc) = 1"""


def q_two_sided(spark, sf):
    """Bouts with both contestants' totals as of their previous bouts."""
    rows = stored(V.pairs(spark, sf))
    contests = rows.select("contest_id", "event_date", "entity_id", "opponent_id")
    return two_sided_asof(
        contests, _form(rows), "entity_id", "opponent_id", "event_date", ("entity_", "opponent_")
    )


def q_two_sided_upcoming(spark, sf):
    """Bouts from 2001 on, looked up in the history before."""
    rows = stored(V.pairs(spark, sf))
    start = F.lit("2001-01-01").cast("date")
    contests = rows.where(F.col("event_date") >= start).select(
        "contest_id", "event_date", "entity_id", "opponent_id"
    )
    past = _form(rows.where(F.col("event_date") < start))
    return two_sided_asof(
        contests, past, "entity_id", "opponent_id", "event_date", ("entity_", "opponent_")
    )


def q_pair_self_join(spark, sf):
    return V.pairs(spark, sf)


def q_right_left_enrich(spark, sf):
    """Nations, customers and orders: right, then left outer join."""
    nation = V.table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation_id"), "n_name")
    customer = V.table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation_id"), "c_custkey", "c_name"
    )
    orders = V.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice"
    )
    return left_enrich(right_enrich(nation, customer, ["nation_id"]), orders, ["c_custkey"])


def q_derived_key(spark, sf):
    """Orders with one line's flags, though an order has many lines."""
    orders = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey")
    lines = V.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("key"), "l_returnflag", "l_linestatus"
    )
    return enrich_by_derived_key(orders, lines, "key", ["l_returnflag", "l_linestatus"])


def q_natural_names(spark, sf):
    """Contestants' and opponents' names by the columns the tables share."""
    names = V.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("entity_name")
    )
    rows = V.pairs(spark, sf).select("contest_id", "entity_id", "opponent_id")
    named = natural_join(natural_join(rows, names), rename_side(names, "entity", "opponent"))
    return named.select("contest_id", "entity_name", "opponent_name")


def q_frontier(spark, sf):
    """Documents not labelled yet."""
    return crawl_frontier(
        V.table(spark, sf, "documents"), V.table(spark, sf, "labels"), "doc_id"
    )


def q_complement(spark, sf):
    """Orders without a line."""
    orders = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey")
    lines = V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"))
    return complement(orders, lines, ["key"])


QUERIES = {
    "q_asof_prev_form": q_asof_prev_form,
    "q_asof_cross": q_asof_cross,
    "q_two_sided": q_two_sided,
    "q_two_sided_upcoming": q_two_sided_upcoming,
    "q_pair_self_join": q_pair_self_join,
    "q_right_left_enrich": q_right_left_enrich,
    "q_derived_key": q_derived_key,
    "q_natural_names": q_natural_names,
    "q_frontier": q_frontier,
    "q_complement": q_complement,
}

ORACLE = {
    "q_asof_prev_form": f"""with {V.HISTORY}, {RUNNING}
select c.contest_id, c.entity_id, c.event_date, p.event_date prev_date,
       p.contest_id prev_contest_id, p.wins prev_wins, p.losses prev_losses, p.winrate prev_winrate
from history c join run p on p.entity_id = c.entity_id and p.event_date < c.event_date
qualify rank() over (partition by c.contest_id order by p.event_date desc) = 1""",
    "q_asof_cross": f"""with {V.SIDES},
lines as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date) ship_date,
         row_number() over () n
  from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, ship_date, event_date bout_date,
       contest_id bout_id, entity_win
from lines join sides on entity_id = l_suppkey and event_date < ship_date
qualify rank() over (partition by n order by event_date desc) = 1""",
    "q_two_sided": f"with {FORM.replace('SOURCE', 'pairs')}, contests as (select * from pairs), "
    f"{TWO_SIDED}",
    "q_two_sided_upcoming": "with "
    + FORM.replace("SOURCE", "pairs where event_date < date '2001-01-01'")
    + ", contests as (select * from pairs where event_date >= date '2001-01-01'), "
    + TWO_SIDED,
    "q_pair_self_join": f"with {V.PAIRS} select * from pairs",
    "q_right_left_enrich": """
select c_custkey, c_nationkey nation_id, n_name, c_name, o_orderkey, o_totalprice
from nation right join customer on n_nationkey = c_nationkey
left join orders on o_custkey = c_custkey""",
    "q_derived_key": """
select o_orderkey as "key", o_custkey, l_returnflag, l_linestatus
from orders left join (
  select l_orderkey, l_returnflag, l_linestatus from lineitem
  qualify row_number() over (partition by l_orderkey order by l_returnflag, l_linestatus) = 1)
on l_orderkey = o_orderkey""",
    "q_natural_names": f"""with {V.PAIRS}
select contest_id, a.s_name entity_name, b.s_name opponent_name
from pairs join supplier a on a.s_suppkey = entity_id join supplier b on b.s_suppkey = opponent_id""",
    "q_frontier": "select doc_id from documents except select doc_id from labels",
    "q_complement": "select o_orderkey as \"key\", o_custkey from orders "
    "where not exists (select 1 from lineitem where l_orderkey = o_orderkey)",
}
