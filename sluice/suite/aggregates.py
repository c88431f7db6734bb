"""Verification aggregates and key quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.scalars import try_date
from sluice.operators.aggregate import coverage, group_count
from sluice.operators.dedupe import duplicate_keys
from sluice.operators.explore import stack
from sluice.operators.joins import grid
from sluice.operators.quality import missing_members, null_counts, overlong
from sluice.suite import case
from sluice.suite.common import t


@case("group_count", """
SELECT n.n_name AS state, count(*) AS agency_count
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name""")
def group_count_q(spark, sf_dir):
    s = t(spark, sf_dir, "supplier")
    n = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"),
                                          F.col("n_name").alias("state"))
    return group_count(s.join(n, "s_nationkey"), "state", "agency_count")


@case("coverage", """
SELECT o_orderstatus AS level, o_orderpriority AS offense, count(*) AS total_rows,
       min(CAST(o_orderdate AS DATE)) AS earliest, max(CAST(o_orderdate AS DATE)) AS latest
FROM orders GROUP BY 1, 2""")
def coverage_q(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("level"), F.col("o_orderpriority").alias("offense"),
                                          F.to_date("o_orderdate").alias("d"))
    return coverage(o, ["level", "offense"], "d")


@case("coverage_distinct", """
SELECT l_returnflag AS state, count(DISTINCT l_suppkey) AS offense_codes,
       min(CAST(l_shipdate AS DATE)) AS earliest_month, max(CAST(l_shipdate AS DATE)) AS latest_month,
       count(*) AS total_rows
FROM lineitem GROUP BY l_returnflag""")
def coverage_distinct(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    raw = li.select(F.col("l_returnflag").alias("state"), "l_suppkey",
                    F.date_format("l_shipdate", "yyyy-MM-dd").alias("obs_text"))
    typed = raw.withColumn("observation_date", try_date("obs_text"))   # V5: dates parsed tolerantly
    return coverage(typed, "state", "observation_date", distinct="l_suppkey",
                    names={"distinct": "offense_codes", "first": "earliest_month",
                           "last": "latest_month", "rows": "total_rows"})


@case("key_quality", """
SELECT 'duplicate_keys' AS check_name, count(*) AS violations FROM
  (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'l_orderkey_nulls', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'l_linenumber_nulls', count(*) FILTER (WHERE l_linenumber IS NULL) FROM lineitem
UNION ALL SELECT 'l_shipdate_nulls', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem
UNION ALL SELECT 'o_orderpriority_overlong', count(*) FILTER (WHERE length(o_orderpriority) > 8) FROM orders
UNION ALL SELECT 'o_orderstatus_overlong', count(*) FILTER (WHERE length(o_orderstatus) > 1) FROM orders""")
def key_quality(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    orders = t(spark, sf_dir, "orders")
    dup = duplicate_keys(li, ["l_orderkey", "l_linenumber"]).groupBy().count() \
        .select(F.lit("duplicate_keys").alias("check_name"), F.col("count").alias("violations"))
    nulls = null_counts(li, ["l_orderkey", "l_linenumber", "l_shipdate"])
    longs = overlong(orders, {"o_orderpriority": 8, "o_orderstatus": 1})

    def to_long(one_row):
        # Unpivot the one-row check frame to (check_name, violations).
        return one_row.unpivot([], one_row.columns, "check_name", "violations")
    return stack([dup, to_long(nulls), to_long(longs)])


@case("missing_members", """
WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_shipdate IS NOT NULL),
     grid AS (SELECT n.n_name AS state, d.day FROM nation n JOIN days d ON true),
     delivered AS (SELECT DISTINCT n.n_name AS state, CAST(l.l_shipdate AS DATE) AS day
                   FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
                   JOIN nation n ON s.s_nationkey = n.n_nationkey)
SELECT g.state, g.day FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM delivered d WHERE d.state = g.state AND d.day = g.day)""")
def missing_members_q(spark, sf_dir):
    """The days of the whole table on which a state delivered nothing."""
    li = t(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"))
    nation = t(spark, sf_dir, "nation")
    g = grid(nation.select(F.col("n_name").alias("state")), li.select("day"), "day")
    sup = t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"),
                                              F.col("s_nationkey").alias("n_nationkey"))
    delivered = (li.join(sup, "l_suppkey").join(nation, "n_nationkey")
                 .select(F.col("n_name").alias("state"), "day"))
    return missing_members(g, delivered, ["state", "day"])
