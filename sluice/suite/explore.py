"""Projections, filters, screening, ranking and stacking (P1-P15, O1-O5,
W3, W4, U1-U4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.predicates import contains_ci, fill_from, find_col, pick, require, where_in
from sluice.functions.scalars import falsy_or, empty_if_null, percent
from sluice.operators.explore import (assign_ids, screen, screen_preset, sort_if_present, stack,
                                      tagged_stack, tail_by, top_n_per_group, unify_levels, PRESETS)
from sluice.plans.params import optional_eq, run_sql, select_member
from sluice.suite import case
from sluice.suite.common import dec_sum, dec_sum_sql, t


@case("extract_document", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.missing') AS missing
FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL""")
def extract_document(spark, sf_dir):
    ev = t(spark, sf_dir, "events")
    doc = F.try_parse_json("props")
    typed = ev.select("event_id", F.try_variant_get(doc, "$.k", "int").alias("k"),
                      F.try_variant_get(doc, "$.missing", "string").alias("missing"))
    return require(typed, ["k"])


@case("pin_and_filter_level", """
SELECT 'national' AS geography_level, o_orderpriority AS geography_value, o_orderkey, o_totalprice FROM orders""")
def pin_and_filter_level(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(F.lit("national").alias("geography_level"),
                                          F.col("o_orderpriority").alias("geography_value"),
                                          "o_orderkey", "o_totalprice")
    li = t(spark, sf_dir, "lineitem").select(F.lit("state").alias("geography_level"),
                                             F.col("l_returnflag").alias("geography_value"),
                                             F.col("l_orderkey").alias("o_orderkey"),
                                             F.col("l_extendedprice").alias("o_totalprice"))
    # The literal level lets Catalyst drop the lineitem branch entirely.
    return o.unionByName(li).where(F.col("geography_level") == "national")


@case("ids_filter", """
SELECT 'semi' AS how, o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
UNION ALL SELECT 'inline', o_orderkey, o_custkey FROM orders WHERE o_custkey IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)""")
def ids_filter(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ids = t(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "AUTOMOBILE").select("c_custkey")
    semi = where_in(o, "o_custkey", ids).select(F.lit("semi").alias("how"), "o_orderkey", "o_custkey")
    inline = where_in(o, "o_custkey", [1, 2, 3, 5, 8, 13, 21, 34, 55, 89]).select(
        F.lit("inline").alias("how"), "o_orderkey", "o_custkey")
    return semi.unionByName(inline)


@case("contains_ci", "SELECT p_partkey, p_name FROM part WHERE coalesce(lower(p_name) LIKE '%red%', false)")
def contains_ci_q(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    return p.where(contains_ci("p_name", "RED")).select("p_partkey", "p_name")


@case("optional_filters", """
SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE lower(c_mktsegment) = 'building'""")
def optional_filters(spark, sf_dir):
    view = "sluice_customer_params"
    t(spark, sf_dir, "customer").createOrReplaceTempView(view)
    df = run_sql(spark, """
        SELECT c_custkey, c_name, c_mktsegment, c_acctbal, c_nationkey FROM IDENTIFIER(:tbl)
        WHERE (:seg IS NULL OR lower(c_mktsegment) = :seg)
          AND (:min_bal IS NULL OR c_acctbal >= :min_bal)""",
                 {"tbl": view, "seg": "building", "min_bal": ""})
    df = optional_eq(df, "c_mktsegment", " Building ")        # P9: given
    df = optional_eq(df, "c_name", "")                         # P9: empty means all
    df = select_member(df, "c_mktsegment", "building",                           # P10: one member,
                       t(spark, sf_dir, "customer").select("c_mktsegment"))     # validated on the dimension
    return df.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


@case("record_pick", """
SELECT CAST(p_partkey AS VARCHAR) AS symbol, p_name AS name,
       coalesce(CASE WHEN p_type <> 'SMALL' THEN p_type END, 'Unknown') AS sector,
       round(CAST(p_size - 25 AS DOUBLE) / CAST(1000 AS DOUBLE) * 100, 2) AS change_pct,
       CASE WHEN p_size >= 10 THEN p_retailprice ELSE p_retailprice + CAST(1 AS DOUBLE) END AS price,
       '' AS dividend
FROM part""")
def record_pick(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    rec = F.create_map(
        F.lit("symbol"), F.col("p_partkey").cast("string"), F.lit("shortName"), F.col("p_name"),
        F.lit("sector"), F.when(F.col("p_type") != "SMALL", F.col("p_type")),
        F.lit("regularMarketChangePercent"), ((F.col("p_size") - 25).cast("double") / F.lit(1000.0)).cast("string"),
        F.lit("regularMarketPrice"),
        F.when(F.col("p_size") >= 10, F.col("p_retailprice")).otherwise(F.lit(0.0)).cast("string"),
        F.lit("previousClose"), (F.col("p_retailprice") + F.lit(1.0)).cast("string"))
    fields = pick(F.col("rec"), ["symbol", "shortName", "sector", "regularMarketChangePercent",
                                 "regularMarketPrice", "previousClose", "dividendYield"])
    q = p.select(rec.alias("rec")).select(*fields)
    return q.select(F.col("symbol"), F.col("shortName").alias("name"),
                    fill_from("sector", "Unknown").alias("sector"),
                    percent(F.col("regularMarketChangePercent").try_cast("double")).alias("change_pct"),
                    falsy_or(F.col("regularMarketPrice").try_cast("double"),
                             F.col("previousClose").try_cast("double")).alias("price"),
                    empty_if_null("dividendYield").alias("dividend"))


@case("discover_columns", f"""
SELECT o_orderpriority AS offense, {dec_sum_sql('o_totalprice')} AS total FROM orders GROUP BY 1""")
def discover_columns(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    count_col = find_col(o, ["count", "actual", "total"])
    offense_col = find_col(o, ["offense", "crime_type", "priority"])
    return o.groupBy(F.col(offense_col).alias("offense")).agg(dec_sum(count_col).alias("total"))


def part_quotes(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("symbol"), F.col("p_type").alias("sector"),
                    F.col("p_brand").alias("exchange"), F.col("p_size").alias("pe"),
                    F.col("p_retailprice").alias("market_cap"))


SCREEN_TREE = ("and", [("is-in", "exchange", ["Brand#1", "Brand#12", "Brand#23"]),
                       ("btwn", "pe", 5, 30),
                       ("or", [("gt", "market_cap", 990.0), ("lt", "market_cap", 905.0)])])


@case("screen_tree", """
SELECT p_partkey AS symbol, p_type AS sector, p_brand AS exchange, p_size AS pe, p_retailprice AS market_cap
FROM part WHERE p_brand IN ('Brand#1', 'Brand#12', 'Brand#23') AND p_size BETWEEN 5 AND 30
  AND (p_retailprice > 990.0 OR p_retailprice < 905.0)
ORDER BY p_retailprice DESC, p_partkey LIMIT 25""")
def screen_tree(spark, sf_dir):
    return screen(part_quotes(spark, sf_dir), SCREEN_TREE, 25, "market_cap", False, tiebreak=["symbol"])


PRESET_QUOTES_SQL = """(SELECT p_partkey AS symbol, lower(p_type) AS sector, p_size AS pe,
       p_retailprice * CAST(2 AS DOUBLE) AS market_cap, CAST(p_size - 25 AS DOUBLE) / CAST(10 AS DOUBLE) AS change_pct,
       CAST(p_size AS BIGINT) * 1000 AS volume FROM part)"""
PRESET_SQL = " UNION ALL ".join(
    f"(SELECT '{name}' AS preset, * FROM {PRESET_QUOTES_SQL} WHERE {cond} ORDER BY {order}, symbol LIMIT 25)"
    for name, cond, order in [
        ("most_actives", "volume > 0", "volume DESC"),
        ("day_gainers", "change_pct > 3.0", "change_pct DESC"),
        ("day_losers", "change_pct < -2.5", "change_pct ASC"),
        ("undervalued_large_caps", "pe BETWEEN 0 AND 20 AND market_cap >= 1500.0", "market_cap DESC"),
        ("growth_technology_stocks", "sector IN ('technology') AND change_pct > 0.0", "change_pct DESC")])


@case("screen_presets", PRESET_SQL)
def screen_presets(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    quotes = p.select(F.col("p_partkey").alias("symbol"), F.lower("p_type").alias("sector"),
                      F.col("p_size").alias("pe"), (F.col("p_retailprice") * F.lit(2.0)).alias("market_cap"),
                      ((F.col("p_size") - 25).cast("double") / F.lit(10.0)).alias("change_pct"),
                      (F.col("p_size").cast("long") * 1000).alias("volume"))
    return stack([screen_preset(quotes, name, 25, tiebreak=["symbol"]).select(F.lit(name).alias("preset"), "*")
                  for name in PRESETS])


@case("tagged_stack", """
SELECT 'customer' AS source, c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS balance,
       c_mktsegment AS segment FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def tagged_stack_q(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"))
    s = t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("nationkey"), F.col("s_acctbal").alias("balance"))
    out = tagged_stack({"customer": c, "supplier": s}, "source")
    return sort_if_present(out.withColumn("nationkey", F.col("nationkey").cast("int")), ["source", "key"])


@case("unify_levels", f"""
SELECT 'region' AS geography_level, r.r_name AS geography_value, count(*) AS customer_count,
       {dec_sum_sql('c.c_acctbal')} AS total_balance
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name
UNION ALL
SELECT 'nation', n.n_name, count(*), {dec_sum_sql('c.c_acctbal')}
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""")
def unify_levels_q(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    n = t(spark, sf_dir, "nation")
    r = t(spark, sf_dir, "region")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    per_nation = cn.groupBy(F.col("n_name").alias("geography_value")).agg(
        F.count(F.lit(1)).alias("customer_count"), dec_sum("c_acctbal").alias("total_balance"))
    per_region = cn.join(r, n.n_regionkey == r.r_regionkey).groupBy(F.col("r_name").alias("geography_value")).agg(
        F.count(F.lit(1)).alias("customer_count"), dec_sum("c_acctbal").alias("total_balance"))
    u = unify_levels({"region": per_region, "nation": per_nation})
    return u.select("geography_level", "geography_value", "customer_count", "total_balance")


@case("top_n_per_group", """
SELECT c_mktsegment, c_custkey, c_acctbal, rank FROM (
  SELECT c_mktsegment, c_custkey, c_acctbal,
         CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS rank
  FROM customer) WHERE rank <= 5""")
def top_n_per_group_q(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return top_n_per_group(c, "c_mktsegment", [F.col("c_acctbal").desc(), F.col("c_custkey").asc()], 5,
                           rank_name="rank")


@case("assign_ids", """
SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) + 1000 AS id
FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL)""")
def assign_ids_q(spark, sf_dir):
    members = t(spark, sf_dir, "orders").where(F.col("o_custkey").isNotNull()).select("o_custkey").distinct()
    return assign_ids(members, "o_custkey", 1000, "id")


@case("tail_by_date", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""")
def tail_by_date(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return tail_by(o, "o_orderdate", 10, tiebreak=["o_orderkey"])


BARS_SQL = """
WITH bars AS (SELECT CAST(o_orderdate AS DATE) AS bar_date, o_orderpriority AS symbol, max(o_totalprice) AS close
              FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderpriority <> '5-LOW' GROUP BY 1, 2)
"""


def _bars(spark, sf_dir):
    """Daily bars; one symbol lacks some days."""
    o = t(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0 OR o_orderpriority <> '5-LOW'")
    return (o.groupBy(F.to_date("o_orderdate").alias("bar_date"), F.col("o_orderpriority").alias("symbol"))
            .agg(F.max("o_totalprice").alias("close")))


@case("last_days", BARS_SQL + """
SELECT 'together' AS calendar, bar_date, symbol, close FROM
  (SELECT *, dense_rank() OVER (ORDER BY bar_date DESC) AS r FROM bars) WHERE r <= 5
UNION ALL SELECT 'own', bar_date, symbol, close FROM
  (SELECT *, dense_rank() OVER (PARTITION BY symbol ORDER BY bar_date DESC) AS r FROM bars) WHERE r <= 5""")
def last_days_q(spark, sf_dir):
    """The last five days that occur, over all symbols and of each."""
    from sluice.operators.explore import last_days
    bars = _bars(spark, sf_dir)
    return tagged_stack({"together": last_days(bars, "bar_date", 5), "own": last_days(bars, "bar_date", 5, "symbol")}, "calendar")


@case("relative_periods", BARS_SQL + """
, ends AS (SELECT max(bar_date) AS last FROM bars)
SELECT p.period, count(*) AS bars, min(b.bar_date) AS first_day, max(b.bar_date) AS last_day
FROM bars b, ends e, (VALUES ('1mo', 1), ('2y', 24), ('ytd', 0), ('max', -1)) p(period, months)
WHERE CASE p.months WHEN -1 THEN true WHEN 0 THEN b.bar_date >= date_trunc('year', e.last)
      ELSE b.bar_date > CAST(e.last - to_months(CAST(p.months AS INTEGER)) AS DATE) END
GROUP BY 1""")
def relative_periods(spark, sf_dir):
    from sluice.operators.explore import in_period
    bars = _bars(spark, sf_dir)
    cut = tagged_stack({p: in_period(bars, "bar_date", p) for p in ("1mo", "2y", "ytd", "max")}, "period")
    return cut.groupBy("period").agg(F.count("*").alias("bars"), F.min("bar_date").alias("first_day"),
                                     F.max("bar_date").alias("last_day"))


@case("order_by_month", """
SELECT strftime(o_orderdate, '%m-%Y') AS month_text, count(*) AS orders FROM orders
GROUP BY 1 ORDER BY strptime(month_text, '%m-%Y') LIMIT 20""")
def order_by_month_q(spark, sf_dir):
    """O2: months as MM-YYYY texts in the order of time, the first 20 of them."""
    from sluice.operators.explore import order_by_month
    months = t(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "MM-yyyy").alias("month_text")).agg(
        F.count("*").alias("orders"))
    return order_by_month(months, "month_text").limit(20)
