"""Cleansing queries. Texts are made from typed columns of the given tables, so that the
SQL on those columns is a true inverse check."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivalry.functions import (
    age_years,
    file_id,
    hex_to_double,
    normalize_category,
    null_if,
    parse_clock,
    parse_date,
    parse_height,
    parse_of_pair,
    parse_percent,
    parse_reach,
    parse_record,
    parse_weight,
    simple_category,
    split_location,
    url_basename,
)
from rivalry.operators.cleanse import (
    convert_detected,
    decided_only,
    detect_formats,
    distinct_rows,
    drop_matching,
    is_win,
    normalize_column_names,
    prefix_columns,
    prefix_unless,
    require,
)
from rivalry.operators.encode import (
    category_codes,
    columns_of_type,
    encode_category,
    numeric_frame,
    one_hot,
)
from rivalry.operators.joins import rename_side
from rivalry.queries import views as V
from rivalry.sources.files import union_records


def _text(column):
    return F.col(column).cast("string")


def q_wide_to_long(spark, sf):
    return V.sides(spark, sf)


def q_location(spark, sf):
    """Customers' places with city, without, with a comma in the city, and unreadable."""
    nation, region = V.table(spark, sf, "nation"), V.table(spark, sf, "region")
    customers = (
        V.table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    segment = F.col("c_mktsegment")
    place = (
        F.when(segment == "HOUSEHOLD", F.concat_ws(", ", "c_name", "n_name", "r_name"))
        .when(segment == "MACHINERY", F.concat_ws(", ", "n_name", "r_name"))
        .when(segment == "FURNITURE", F.concat_ws(", ", "c_name", segment, "n_name", "r_name"))
        .when(segment == "BUILDING", F.col("n_name"))
    )
    parts = split_location(place)
    return customers.select(
        "c_custkey",
        F.coalesce(parts["city"], F.lit("Unspecified")).alias("city"),
        parts["state"].alias("state"),
        parts["country"].alias("country"),
    )


def q_dates(spark, sf):
    """Order dates in the long and the short format; one priority holds no date."""
    priority, day = F.col("o_orderpriority"), F.col("o_orderdate")
    text = (
        F.when(priority == "1-URGENT", F.date_format(day, "MMMM d, yyyy"))
        .when(priority == "2-HIGH", F.date_format(day, "MMM dd, yyyy"))
        .when(priority == "3-MEDIUM", F.date_format(day, "MMM d, yyyy"))
        .when(priority == "5-LOW", F.lit("--"))
    )
    return V.table(spark, sf, "orders").select("o_orderkey", parse_date(text).alias("day"))


def q_hex(spark, sf):
    ids = V.table(spark, sf, "orders").select("o_orderkey", F.lower(F.hex("o_orderkey")).alias("id"))
    return ids.select("o_orderkey", hex_to_double(F.col("id")).alias("id"))


def q_basename(spark, sf):
    return V.table(spark, sf, "pages").select(
        "page_id",
        url_basename(F.col("url")).alias("base"),
        file_id(F.concat("url", F.lit(".html"))).alias("file_id"),
    )


def q_category(spark, sf):
    raw = F.concat(F.lit("Men's "), "o_orderpriority", F.lit(" - "), "o_orderstatus", F.lit("/KO"))
    return V.table(spark, sf, "orders").select(
        "o_orderkey",
        normalize_category(raw).alias("category"),
        simple_category(F.concat(F.lit("Open "), "o_orderstatus")).alias("stance"),
    )


def q_percent(spark, sf):
    text = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    return V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", parse_percent(text).alias("share")
    )


def q_of_pair(spark, sf):
    text = F.concat(_text("l_linenumber"), F.lit(" of "), F.col("l_quantity").cast("int").cast("string"))
    parts = parse_of_pair(text)
    return V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", parts["landed"].alias("landed"), parts["total"].alias("total")
    )


def q_clock(spark, sf):
    text = F.date_format("ts", "m:ss")
    return V.table(spark, sf, "events").select("event_id", parse_clock(text).alias("seconds"))


def q_record(spark, sf):
    text = F.concat_ws(
        "-", F.hour("ts").cast("string"), F.minute("ts").cast("string"), F.second("ts").cast("string")
    )
    parts = parse_record(text)
    return V.table(spark, sf, "events").select(
        "event_id", *[value.cast("int").alias(name) for name, value in parts.items()]
    )


def q_body(spark, sf):
    """Heights, reaches and weights made of the part size."""
    size = F.col("p_size")
    height = F.concat(
        F.floor(size / 12).cast("string"), F.lit("'"), (size % 12).cast("string"), F.lit('"')
    )
    reach = F.when(size > 5, F.concat(_text("p_size"), F.lit('"'))).otherwise("--")
    return V.table(spark, sf, "part").select(
        "p_partkey",
        parse_height(height).alias("height"),
        parse_reach(reach).alias("reach"),
        parse_weight(F.concat(_text("p_size"), F.lit(" lbs."))).alias("weight"),
        null_if(reach, "--").alias("known_reach"),
    )


TEXTS = ["discount", "landed", "shipped", "quantity"]


def _line_texts(spark, sf):
    """Line items as raw text; a third of the rows give each column its format."""
    lines = V.table(spark, sf, "lineitem")
    flag = F.col("l_returnflag")
    percent = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    pair = F.concat(_text("l_linenumber"), F.lit(" of "), F.col("l_quantity").cast("int").cast("string"))
    return lines.select(
        "l_orderkey",
        "l_partkey",
        F.when(flag != "N", percent).alias("discount"),
        F.when(flag != "A", pair).alias("landed"),
        F.date_format("l_shipdate", "d:MM").alias("shipped"),
        _text("l_quantity").alias("quantity"),
    )


def q_detect_formats(spark, sf):
    return detect_formats(_line_texts(spark, sf), TEXTS)


def q_convert(spark, sf):
    """Each text column typed by the format found in it."""
    return convert_detected(_line_texts(spark, sf), TEXTS)


def q_distinct(spark, sf):
    rows = V.table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus")
    return distinct_rows(rows)


def q_rename(spark, sf):
    """Raw names normalised and prefixed, columns dropped by name, sides renamed."""
    raw = V.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Fight ID"),
        F.col("o_custkey").alias("fighter_id"),
        F.col("o_orderstatus").alias("Sig. str."),
        F.col("o_totalprice").alias("Event Total"),
        F.col("o_orderpriority").alias("Details: judge"),
    )
    named = normalize_column_names(drop_matching(raw, "Details:"))
    return rename_side(prefix_unless(named, "fight_", ["event_", "fight_"], ["fighter_id"]), "fighter", "opponent")


def q_prefix(spark, sf):
    supplier = V.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return prefix_columns(supplier, "opponent_", ["s_suppkey"])


def q_casts(spark, sf):
    """Numbers back out of their text, and rows without a quantity left out."""
    lines = V.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        _text("l_linenumber").alias("round"),
        F.when(F.col("l_returnflag") != "N", _text("l_quantity")).alias("kd"),
    )
    return require(lines, "kd").select(
        "l_orderkey",
        "l_partkey",
        F.col("round").cast("smallint").cast("int").alias("round"),
        F.col("kd").cast("double").alias("kd"),
    )


def q_outcome_filter(spark, sf):
    """Orders that either side won, with the outcome flag."""
    status = F.col("o_orderstatus")
    raw = V.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "F", "W").when(status == "O", "L").otherwise("D").alias("Fighter1 Status"),
        F.when(status == "O", "W").when(status == "F", "L").otherwise("D").alias("Fighter2 Status"),
    )
    kept = decided_only(raw, ["Fighter1 Status", "Fighter2 Status"])
    return kept.select("o_orderkey", is_win(F.col("Fighter1 Status")).alias("win"))


def q_age(spark, sf):
    """Whole years between an order and the end of 2001."""
    born = F.to_date("o_orderdate")
    return V.table(spark, sf, "orders").select(
        "o_orderkey", age_years(F.lit("2001-12-31").cast("date"), born).alias("age")
    )


def q_product(spark, sf):
    return V.table(spark, sf, "part").select(
        "p_partkey", F.round(F.col("p_size") * F.col("p_retailprice"), 4).alias("prod")
    )


def q_one_hot(spark, sf):
    """Order priorities as 0/1 columns; unknown ones are all zeros, unseen ones all zero."""
    priority = F.split("o_orderpriority", "-")[0]
    rows = V.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", priority).alias("priority")
    )
    return one_hot(rows, {"priority": ["1", "2", "3", "4", "5", "6"]})


def q_numeric_frame(spark, sf):
    """Numbers and flags only, unknown ones as 0."""
    rows = V.history(spark, sf).select("contest_id", "win", "method", "event_date", "stat")
    return numeric_frame(rows)


def q_union_records(spark, sf):
    """Customers and suppliers as one list of records; columns one of them lacks are null."""
    customers = V.table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), "c_mktsegment"
    )
    suppliers = V.table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), "s_suppkey"
    )
    return union_records(customers, suppliers)


def q_columns_by_type(spark, sf):
    """How many columns of each kind the line items have."""
    lines = V.table(spark, sf, "lineitem")
    kinds = [(k, len(columns_of_type(lines, k))) for k in ("number", "bool", "other")]
    return lines.agg(
        F.count(F.lit(1)).alias("rows"), *[F.lit(n).alias(f"{k}_columns") for k, n in kinds]
    )


def q_category_codes(spark, sf):
    """Every line's part as a number by how often the part is ordered, whatever the number of parts."""
    lines = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    codes = category_codes(lines, "l_partkey")
    return encode_category(lines, "l_partkey", codes, "code").select("l_orderkey", "l_linenumber", "code")


CODES = """
with codes as (
  select l_partkey, row_number() over (order by count(*) desc, l_partkey) - 1 code
  from lineitem group by l_partkey)
select l_orderkey, l_linenumber, code from lineitem join codes using (l_partkey)"""

QUERIES = {
    "q_category_codes": q_category_codes,
    "q_wide_to_long": q_wide_to_long,
    "q_location": q_location,
    "q_dates": q_dates,
    "q_hex": q_hex,
    "q_basename": q_basename,
    "q_category": q_category,
    "q_percent": q_percent,
    "q_of_pair": q_of_pair,
    "q_clock": q_clock,
    "q_record": q_record,
    "q_body": q_body,
    "q_detect_formats": q_detect_formats,
    "q_convert": q_convert,
    "q_distinct": q_distinct,
    "q_rename": q_rename,
    "q_prefix": q_prefix,
    "q_casts": q_casts,
    "q_outcome_filter": q_outcome_filter,
    "q_age": q_age,
    "q_product": q_product,
    "q_one_hot": q_one_hot,
    "q_numeric_frame": q_numeric_frame,
    "q_union_records": q_union_records,
    "q_columns_by_type": q_columns_by_type,
}

_PRIORITY = "case when o_orderstatus <> 'P' then o_orderpriority[1:1] end"

ORACLE = {
    "q_category_codes": CODES,
    "q_wide_to_long": f"with {V.SIDES} select * from sides",
    "q_location": """
select c_custkey,
  case c_mktsegment when 'HOUSEHOLD' then c_name when 'FURNITURE' then c_name || ', FURNITURE'
       else 'Unspecified' end city,
  case when c_mktsegment in ('HOUSEHOLD', 'MACHINERY', 'FURNITURE') then n_name end state,
  case when c_mktsegment in ('HOUSEHOLD', 'MACHINERY', 'FURNITURE') then r_name end country
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "q_dates": """
select o_orderkey, case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM')
  then cast(o_orderdate as date) end "day" from orders""",
    "q_hex": "select o_orderkey, o_orderkey::double id from orders",
    "q_basename": """
select page_id, regexp_extract(url, '[^/]*$') base,
       replace(regexp_extract(url, '[^/]*$') || '.html', '.html', '') file_id from pages""",
    "q_category": """
select o_orderkey, 'mens_' || lower(replace(o_orderpriority, ' ', '_')) || '_'
  || lower(o_orderstatus) || '_ko' category, 'open_' || lower(o_orderstatus) stance from orders""",
    "q_percent": "select l_orderkey, l_linenumber, l_partkey, round(l_discount * 100) / 100 as share "
    "from lineitem",
    "q_of_pair": "select l_orderkey, l_partkey, l_linenumber::double landed, "
    "trunc(l_quantity)::double total from lineitem",
    "q_clock": "select event_id, (minute(ts) * 60 + second(ts))::double as \"seconds\" from events",
    "q_record": "select event_id, hour(ts)::int wins, minute(ts)::int losses, second(ts)::int ties "
    "from events",
    "q_body": """
select p_partkey, p_size::double height, case when p_size > 5 then p_size::double end reach,
  p_size::double weight, case when p_size > 5 then p_size::varchar || '"' end known_reach
from part""",
    "q_detect_formats": """
with f as (select count(*) filter (l_returnflag <> 'N') a, count(*) filter (l_returnflag <> 'A') b,
                  count(*) c from lineitem)
select 'discount' column_name, a > 0 as "percent", false of_pair, false clock from f
union all select 'landed', false, b > 0, false from f
union all select 'shipped', false, false, c > 0 from f
union all select 'quantity', false, false, false from f""",
    "q_convert": """
select l_orderkey, l_partkey,
  case when l_returnflag <> 'N' then round(l_discount * 100) / 100 end discount,
  case when l_returnflag <> 'A' then l_linenumber::double end landed_landed,
  case when l_returnflag <> 'A' then trunc(l_quantity)::double end landed_total,
  (day(l_shipdate) * 60 + month(l_shipdate))::double shipped_seconds,
  l_quantity quantity from lineitem""",
    "q_distinct": "select distinct l_suppkey, l_returnflag, l_linestatus from lineitem",
    "q_rename": "select o_orderkey fight_id, o_custkey opponent_id, o_orderstatus fight_sig_str, "
    "o_totalprice event_total from orders",
    "q_prefix": "select s_suppkey, s_name opponent_s_name, s_acctbal opponent_s_acctbal from supplier",
    "q_casts": 'select l_orderkey, l_partkey, l_linenumber as "round", l_quantity kd from lineitem '
    "where l_returnflag <> 'N'",
    "q_outcome_filter": "select o_orderkey, o_orderstatus = 'F' win from orders "
    "where o_orderstatus in ('F', 'O')",
    "q_age": "select o_orderkey, round((date '2001-12-31' - cast(o_orderdate as date)) / 365.25) age "
    "from orders",
    "q_product": "select p_partkey, round(p_size * p_retailprice, 4) prod from part",
    "q_one_hot": "select o_orderkey, "
    + ", ".join(
        f"coalesce(({_PRIORITY} = '{v}')::int, 0) priority_{v}" for v in ("1", "2", "3", "4", "5", "6")
    )
    + " from orders",
    "q_numeric_frame": f"with {V.HISTORY} select contest_id, win::int win, coalesce(stat, 0) stat "
    "from history",
    "q_union_records": """
select c_name as "name", c_acctbal balance, c_mktsegment, null::bigint s_suppkey from customer
union all select s_name, s_acctbal, null, s_suppkey from supplier""",
    "q_columns_by_type": """
select (select count(*) from lineitem) as "rows",
  count(*) filter (data_type in ('BIGINT', 'INTEGER', 'DOUBLE'))::int number_columns,
  count(*) filter (data_type = 'BOOLEAN')::int bool_columns,
  count(*) filter (data_type not in ('BIGINT', 'INTEGER', 'DOUBLE', 'BOOLEAN'))::int other_columns
from information_schema.columns where table_name = 'lineitem'""",
}
