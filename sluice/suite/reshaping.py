"""Nested payloads to long rows, rollups and pivots (S10, S12, R1-R9, A4, A8,
F9, F10, F24, P12, P16, O2, O3).

Payloads are packed from the test tables the way the APIs deliver them, in
request-sized groups (one page holds at most ``PAGE`` records), landed as
parquet and reshaped back; the result must equal the direct relational
answer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.scalars import month_text_year
from sluice.operators.aggregate import annual_total
from sluice.operators.explore import stack, top_k
from sluice.operators.reshape import (close_matrix, explode_with_parent, flatten_agencies, monthly_long,
                                      normalize, object_members, payload_rows, pivot_sum, quotes_table,
                                      split_rejects)
from sluice.session import scratch_path
from sluice.sources.landing import scan_bars, scan_payloads
from sluice.suite import case
from sluice.suite.common import t

PAGE = 64
RUN_TEXT = "2024-02-01T00:00:00"


def _page(col: str):
    return F.floor(F.col(col) / PAGE).cast("long")


def _strip_last(c):
    return F.expr(f"substring({c}, 1, length({c}) - 1)")


# Members of a response that are no groups of agencies, though their texts look like lists and objects.
LOOKALIKES = (r',"_meta":"[{\"s_suppkey\":1}]","notes":["n/a","{not json","{\"s_suppkey\":2}",null,[{}]]}')


def agency_payloads(spark, sf_dir):
    """``{county: [agency...], "_meta": .., "notes": [..]}`` per (state, page).
    The other members hold texts that look like lists and records."""
    s = t(spark, sf_dir, "supplier")
    n = t(spark, sf_dir, "nation")
    r = t(spark, sf_dir, "region")
    sup = (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
           .select(F.col("r_name").alias("state"), F.col("n_name").alias("county"),
                   "s_suppkey", "s_name", "s_acctbal", _page("s_suppkey").alias("page")))
    per_county = (sup.groupBy("state", "page", "county")
                  .agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name", "s_acctbal"))).alias("items")))
    per_page = (per_county.groupBy("state", "page")
                .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("county", "items")))).alias("m")))
    body = F.to_json("m")
    payload = F.concat(_strip_last("__body"), F.lit(LOOKALIKES))
    return (per_page.select("state", "page", body.alias("__body"))
            .select("state", "page", F.lit(RUN_TEXT).alias("extracted_at"), payload.alias("payload")))


def landed_agency_payloads(spark, sf_dir):
    path = scratch_path(spark, "agency_payloads")
    agency_payloads(spark, sf_dir).write.mode("overwrite").parquet(path)
    return scan_payloads(spark, path)


@case("payload_scan", """
SELECT r.r_name AS state, s.s_suppkey // 64 AS page, CAST(count(DISTINCT n.n_name) + 2 AS INTEGER) AS n_members
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2""")
def payload_scan(spark, sf_dir):
    p = landed_agency_payloads(spark, sf_dir)
    return p.select("state", "page", F.size(object_members("payload")).alias("n_members"))


@case("flatten_agencies", f"""
SELECT s.s_suppkey, s.s_name, s.s_acctbal, n.n_name AS county_name, r.r_name AS state,
       '{RUN_TEXT}' AS extracted_at
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")
def flatten_agencies_q(spark, sf_dir):
    p = landed_agency_payloads(spark, sf_dir)
    return flatten_agencies(p, "payload", "s_suppkey BIGINT, s_name STRING, s_acctbal DOUBLE",
                            keep=["state", "extracted_at"])


def arrest_payloads(spark, sf_dir):
    """``{"actuals": {"note": .., "<label>": {"MM-YYYY": n}, "<label> cleared": ..}, "rates": ..}``
    per (flag, status), built from monthly sums of lineitem quantities."""
    li = t(spark, sf_dir, "lineitem")
    monthly = (li.groupBy("l_returnflag", "l_linestatus",
                          F.date_format("l_shipdate", "MM-yyyy").alias("mt"))
               .agg(F.sum("l_quantity").alias("q")))
    per = (monthly.groupBy("l_returnflag", "l_linestatus")
           .agg(F.map_from_entries(F.collect_list(F.struct("mt", "q"))).alias("months"),
                F.map_from_entries(F.collect_list(F.struct("mt", (F.col("q") * 2).alias("q2")))).alias("doubled")))
    label = F.concat("l_returnflag", "l_linestatus", F.lit(" arrests"))
    bad = F.create_map(F.lit("13-2020"), F.lit(1.0), F.lit("bad"), F.lit(2.0), F.lit("1-2-2020"), F.lit(3.0))
    series = F.create_map(label, F.map_concat("months", bad),
                          F.concat(label, F.lit(" cleared")), F.col("doubled"))
    # Some responses give their counts as texts.
    texts = F.transform_values(series, lambda _k, m: F.transform_values(m, lambda _t, q: q.cast("string")))
    per = per.withColumn("__series", F.when(F.col("l_linestatus") == "F", F.to_json(texts)).otherwise(F.to_json(series)))
    # Members that are no objects come first, one of them a text that looks like a series.
    actuals = F.concat(F.lit(r'{"note":"preliminary","copy":" {\"01-1950\":1}","none":null,"list":[{"01-1950":1}],'),
                       F.expr("substring(__series, 2)"))
    rates = F.to_json(F.create_map(F.concat(label, F.lit(" rate")), F.col("doubled")))
    return per.select(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
        F.concat(F.lit('{"actuals":'), actuals, F.lit(',"rates":'), rates, F.lit("}")).alias("payload"))


def monthly(spark, sf_dir):
    return monthly_long(arrest_payloads(spark, sf_dir), "payload", "actuals", keep=["flag", "status"])


@case("monthly_long", """
SELECT l_returnflag AS flag, l_linestatus AS status, l_returnflag || l_linestatus || ' arrests' AS series_label,
       strftime(l_shipdate, '%m-%Y') AS month_text, CAST(date_trunc('month', l_shipdate) AS DATE) AS observation_date,
       sum(l_quantity) AS value
FROM lineitem GROUP BY ALL""")
def monthly_long_q(spark, sf_dir):
    good, _rejects = split_rejects(monthly(spark, sf_dir), ["observation_date"])
    return good


@case("monthly_rejects", """
SELECT DISTINCT l_returnflag AS flag, l_linestatus AS status, m.month_text
FROM lineitem, (VALUES ('13-2020'), ('bad'), ('1-2-2020')) AS m(month_text)""")
def monthly_rejects(spark, sf_dir):
    _good, rejects = split_rejects(monthly(spark, sf_dir), ["observation_date"])
    return rejects.select("flag", "status", "month_text")


@case("annual_total", """
SELECT l_returnflag AS flag, l_linestatus AS status, CAST(year(l_shipdate) AS INTEGER) AS data_year,
       sum(l_quantity) AS value
FROM lineitem GROUP BY ALL""")
def annual_total_q(spark, sf_dir):
    m = monthly(spark, sf_dir)
    return annual_total(m, ["flag", "status"], "observation_date", "value",
                        year=month_text_year("month_text"))


def coercion_payloads(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    s = t(spark, sf_dir, "supplier")
    r = t(spark, sf_dir, "region")
    n = t(spark, sf_dir, "nation")
    rec = lambda k, nm: F.struct(F.col(k).cast("long").alias("key"), F.col(nm).alias("name"))
    as_list = (c.groupBy("c_nationkey", _page("c_custkey").alias("pg"))
               .agg(F.to_json(F.collect_list(rec("c_custkey", "c_name"))).alias("payload"))
               .select(F.lit("list").alias("shape"), "payload"))
    as_dict = (s.groupBy(_page("s_suppkey").alias("pg"))
               .agg(F.to_json(F.collect_list(rec("s_suppkey", "s_name"))).alias("items"))
               .select(F.lit("dict").alias("shape"),
                       F.concat(F.lit(r'{"pagination":{"page":1},"empty":[],"text":" [1]","quoted":"[{\"key\":1}]","results":'), "items",
                                F.lit(',"a_later_list":[{"key":-1}]}')).alias("payload")))
    # A single record whose name looks like a list.
    single = r.select(F.lit("single").alias("shape"), F.to_json(F.struct(
        F.col("r_regionkey").cast("long").alias("key"), F.concat(F.lit("["), "r_name", F.lit("]")).alias("name")))
        .alias("payload"))
    empties = n.select(F.lit("empty").alias("shape"),
                       F.when(F.col("n_nationkey") < 10, F.lit("[]")).when(F.col("n_nationkey") < 15, F.lit('"[1]"'))
                       .when(F.col("n_nationkey") < 20, F.lit("[not json")).otherwise(F.lit("{}")).alias("payload"))
    return stack([as_list, as_dict, single, empties])


@case("payload_coercion", """
SELECT 'list' AS shape, c_custkey AS key, c_name AS name FROM customer
UNION ALL SELECT 'dict', s_suppkey, s_name FROM supplier
UNION ALL SELECT 'single', CAST(r_regionkey AS BIGINT), '[' || r_name || ']' FROM region""")
def payload_coercion(spark, sf_dir):
    rows = payload_rows(coercion_payloads(spark, sf_dir), "payload", keep=["shape"])
    parsed = rows.select("shape", F.from_json("record", "key BIGINT, name STRING").alias("r"))
    return parsed.select("shape", "r.key", "r.name")


@case("normalize_nested", """
SELECT c.c_nationkey AS n_nationkey, n.n_name, c.c_custkey, c.c_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def normalize_nested(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    n = t(spark, sf_dir, "nation")
    child = F.struct("c_custkey", "c_name",
                     F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("n_nationkey"))
    nested = (c.groupBy("c_nationkey", _page("c_custkey").alias("pg"))
              .agg(F.collect_list(child).alias("customers"))
              .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
              .select(F.struct("n_nationkey", "n_name").alias("nation"), "customers"))
    flat = normalize(nested, "nation")
    return explode_with_parent(flat, "customers", "n_nationkey").select(
        "n_nationkey", "n_name", "c_custkey", "c_name")


def _priority_sql(agg: str) -> str:
    pri = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return ", ".join(agg.format(p=p) for p in pri)


@case("pivot_sum", "SELECT CAST(year(o_orderdate) AS INTEGER) AS data_year, " + _priority_sql(
    "CAST(SUM(CASE WHEN o_orderpriority = '{p}' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS \"{p}\"")
    + " FROM orders GROUP BY 1")
def pivot_sum_q(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    long = o.select(F.year("o_orderdate").alias("data_year"), "o_orderpriority",
                    F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    wide = pivot_sum(long, "data_year", "o_orderpriority", "amount")        # members are not known beforehand
    return wide.select("data_year", *[F.col(f"`{m}`").cast("double").alias(m) for m in wide.columns[1:]])


def bars(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    return (o.groupBy(F.to_date("o_orderdate").alias("bar_date"), F.col("o_orderpriority").alias("symbol"))
            .agg(F.max("o_totalprice").alias("close")))


@case("close_matrix", "SELECT CAST(o_orderdate AS DATE) AS bar_date, " + _priority_sql(
    "max(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice END) AS \"{p}\"") + " FROM orders GROUP BY 1")
def close_matrix_q(spark, sf_dir):
    b = bars(spark, sf_dir)
    return close_matrix(b, "bar_date", "symbol", "close")


@case("bars_period", """
SELECT CAST(o_orderdate AS DATE) AS bar_date, o_orderpriority AS symbol, max(o_totalprice) AS close
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND CAST(o_orderdate AS DATE) BETWEEN DATE '2001-07-28' AND DATE '2001-08-01'
GROUP BY 1, 2""")
def bars_period(spark, sf_dir):
    path = scratch_path(spark, "bars")
    bars(spark, sf_dir).write.mode("overwrite").partitionBy("symbol").parquet(path)
    return scan_bars(spark, path, symbols=["1-URGENT", "2-HIGH"], date_col="bar_date",
                     lo="2001-07-28", hi="2001-08-01").select("bar_date", "symbol", "close")


QUOTE_FIELDS = ["symbol", "shortName", "sector", "trailingPE", "marketCap", "dividendYield"]


@case("quotes_table", """
SELECT p_partkey AS symbol, p_name AS shortName, p_type AS sector, p_size AS trailingPE,
       p_retailprice AS marketCap, CAST(NULL AS VARCHAR) AS dividendYield
FROM part ORDER BY p_retailprice DESC, p_partkey ASC LIMIT 10""")
def quotes_table_q(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    quote = F.create_map(F.lit("symbol"), F.col("p_partkey").cast("string"),
                         F.lit("shortName"), F.col("p_name"), F.lit("sector"), F.col("p_type"),
                         F.lit("trailingPE"), F.col("p_size").cast("string"),
                         F.lit("marketCap"), F.col("p_retailprice").cast("string"))
    payloads = (p.groupBy("p_brand", _page("p_partkey").alias("pg"))
                .agg(F.to_json(F.struct(F.collect_list(quote).alias("quotes"))).alias("payload")))
    parsed = payloads.select(F.from_json("payload", "quotes ARRAY<MAP<STRING,STRING>>").alias("d"))
    q = quotes_table(parsed.select("d.quotes"), "quotes", QUOTE_FIELDS)
    typed = q.select(F.col("symbol").try_cast("bigint").alias("symbol"), "shortName", "sector",
                     F.col("trailingPE").try_cast("int").alias("trailingPE"),
                     F.col("marketCap").try_cast("double").alias("marketCap"), "dividendYield")
    return top_k(typed, "marketCap", False, 10, tiebreak=["symbol"])


def offense_payloads(spark, sf_dir):
    """Per (state, year) one response: a bare list of offense records, or the
    list wrapped in an object next to an empty list (alternate years)."""
    li = t(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
    sup = t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nat = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    offense = F.concat(F.col("l_returnflag"),
                       F.when(F.col("l_linestatus") == "F", F.lit(" Violent crime")).otherwise(F.lit(" property")))
    counts = (li.join(sup, "l_suppkey").join(nat, "s_nationkey")
              .groupBy(F.col("n_name").alias("state"), F.year("l_shipdate").alias("year"), offense.alias("offense"))
              .agg(F.count(F.lit(1)).alias("actual_count")))
    per = counts.groupBy("state", "year").agg(
        F.to_json(F.collect_list(F.struct("year", "offense", "actual_count"))).alias("items"))
    wrapped = F.concat(F.lit('{"pagination":{},"empty":[],"data":'), F.col("items"), F.lit("}"))
    return per.select("state", F.when(F.col("year") % 2 == 0, F.col("items")).otherwise(wrapped).alias("payload"))


def _state_members():
    return [f"NATION_{i}" for i in range(25)]


@case("state_offenses_pivot", "WITH c AS (SELECT n.n_name AS state, CAST(year(l.l_shipdate) AS BIGINT) AS year, "
      "l.l_returnflag || CASE WHEN l.l_linestatus = 'F' THEN ' Violent crime' ELSE ' property' END AS offense "
      "FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey) "
      "SELECT year, " + ", ".join(
          f"CAST(SUM(CASE WHEN state = '{m}' AND lower(offense) LIKE '%violent%' THEN 1 END) AS BIGINT) AS \"{m}\""
          for m in _state_members())
      + " FROM c WHERE lower(offense) LIKE '%violent%' GROUP BY year")
def state_offenses_pivot(spark, sf_dir):
    """R4 + U3 + P13 + P6 + R7: coerce each response to records, land them by
    state with their names, find the count and offense columns by those names
    (the records themselves are read once), keep violent offenses, and pivot
    year x state, the states being those that occur."""
    from sluice.functions.predicates import contains_ci, find_col
    from sluice.operators.reshape import member, member_names
    rows = payload_rows(offense_payloads(spark, sf_dir), "payload", keep=["state"])
    path = scratch_path(spark, "offense_records")
    # Each state's records land in its own folder (the tag, U3).
    (rows.select(F.col("state").alias("state_abbr"), F.try_parse_json("record").alias("record"),
                 F.json_object_keys("record").alias("names"))
     .hint("rebalance", "state_abbr").write.partitionBy("state_abbr").parquet(path))
    landed = spark.read.parquet(path)
    names = member_names(landed, "names")                        # reads the column of names alone
    count_col = find_col(names, ["count", "actual"])
    offense_col = find_col(names, ["offense", "crime_type"])
    records = landed.select("state_abbr", member("record", "year", "bigint").alias("year"),
                            member("record", offense_col, "string").alias("offense"),
                            member("record", count_col, "bigint").alias("count"))
    return pivot_sum(records.where(contains_ci("offense", "violent")), "year", "state_abbr", "count")


def agency_month_payloads(spark, sf_dir):
    """One response per (agency, offense code) of the agency-level grid:
    ``{"actuals": {"<code> Arrests": {"MM-YYYY": n}}}`` (bounded by months)."""
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    monthly = (li.join(o, "l_orderkey")
               .groupBy("o_custkey", F.col("l_linenumber").alias("offense_code"),
                        F.date_format("l_shipdate", "MM-yyyy").alias("mt"))
               .agg(F.sum("l_quantity").alias("v")))
    label = F.concat(F.col("offense_code").cast("string"), F.lit(" Arrests"))
    per = monthly.groupBy("o_custkey", "offense_code").agg(
        F.map_from_entries(F.collect_list(F.struct("mt", "v"))).alias("m"))
    return per.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ori"), "offense_code",
                      F.to_json(F.struct(F.create_map(label, F.col("m")).alias("actuals"))).alias("payload"))


@case("agency_monthly_long", """
SELECT 'C' || CAST(o.o_custkey AS VARCHAR) AS ori, l.l_linenumber AS offense_code,
       CAST(l.l_linenumber AS VARCHAR) || ' Arrests' AS series_label, strftime(l.l_shipdate, '%m-%Y') AS month_text,
       CAST(date_trunc('month', l.l_shipdate) AS DATE) AS observation_date, sum(l.l_quantity) AS value
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY ALL""")
def agency_monthly_long(spark, sf_dir):
    """R2 over the full agency-level grid (every agency x offense code)."""
    return monthly_long(agency_month_payloads(spark, sf_dir), "payload", "actuals", keep=["ori", "offense_code"])
