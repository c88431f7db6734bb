"""Deduplication, merges, grids and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.scalars import run_ts
from sluice.operators.dedupe import assert_unique, distinct_keys, latest_wins
from sluice.operators.joins import enrich
from sluice.operators.merge import merge
from sluice.plans import runbook
from sluice.plans.highwater import seed_grid
from sluice.session import materialize
from sluice.suite import case
from sluice.suite.common import (OLD_SQL, OLD_TS, RUN_SQL, RUN_TS, SOURCE_FROM, TARGET_CUT, t)


def ranked_sql(inner: str, keys: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY {order}) AS rn FROM ({inner})) WHERE rn = 1")


# --- W1 ---------------------------------------------------------------------

def events_obs(ev):
    return ev.withColumn("obs_date", F.to_date("ts"))


EV_KEYS = ["user_id", "event_type", "obs_date"]


def ev_order():
    return [F.col("ts").desc_nulls_last(), F.col("event_id").desc()]

EV_SQL_INNER = "SELECT *, CAST(ts AS DATE) AS obs_date FROM events"
EV_SQL_ORDER = "ts DESC NULLS LAST, event_id DESC NULLS LAST"


@case("latest_wins_events", ranked_sql(EV_SQL_INNER, "user_id, event_type, obs_date", EV_SQL_ORDER))
def latest_wins_events(spark, sf_dir):
    return latest_wins(events_obs(t(spark, sf_dir, "events")), EV_KEYS, ev_order(), tiebreak=None)


@case("latest_wins_lineitem", ranked_sql(
    "SELECT * FROM lineitem", "l_orderkey, l_linenumber",
    "l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, "
    "l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, "
    "l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST"))
def latest_wins_lineitem(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    return latest_wins(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc_nulls_last()])


# --- J1 / J9 / J10 --------------------------------------------------------------

def _snapshot(ev):
    return ev.select(*EV_KEYS, "value", "event_id", F.col("ts").alias("extracted_at"))


def merge_inputs(spark, sf_dir):
    ev = events_obs(t(spark, sf_dir, "events"))
    target = latest_wins(ev.where(F.col("ts") < F.lit(TARGET_CUT).cast("timestamp_ntz")),
                         EV_KEYS, ev_order(), tiebreak=None)
    target = _snapshot(target).withColumn("updated_at", F.col("extracted_at"))
    source = latest_wins(ev.where(F.col("ts") >= F.lit(SOURCE_FROM).cast("timestamp_ntz")),
                         EV_KEYS, ev_order(), tiebreak=None)
    return target, _snapshot(source)


MERGE_SQL_CTE = f"""
WITH t AS (SELECT user_id, event_type, obs_date, value, event_id, ts AS extracted_at, ts AS updated_at
           FROM ({ranked_sql(EV_SQL_INNER + " WHERE ts < TIMESTAMP '" + TARGET_CUT + "'",
                             "user_id, event_type, obs_date", EV_SQL_ORDER)})),
     s AS (SELECT user_id, event_type, obs_date, value, event_id, ts AS extracted_at
           FROM ({ranked_sql(EV_SQL_INNER + " WHERE ts >= TIMESTAMP '" + SOURCE_FROM + "'",
                             "user_id, event_type, obs_date", EV_SQL_ORDER)}))
"""
MERGE_SQL_JOIN = """FROM t FULL OUTER JOIN s ON t.user_id = s.user_id AND t.event_type = s.event_type
     AND t.obs_date = s.obs_date"""


@case("merge_upsert", MERGE_SQL_CTE + f"""
SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.event_type, s.event_type) AS event_type,
       coalesce(t.obs_date, s.obs_date) AS obs_date,
       CASE WHEN s.user_id IS NOT NULL THEN s.value ELSE t.value END AS value,
       CASE WHEN s.user_id IS NOT NULL THEN s.event_id ELSE t.event_id END AS event_id,
       CASE WHEN s.user_id IS NOT NULL THEN s.extracted_at ELSE t.extracted_at END AS extracted_at,
       CASE WHEN s.user_id IS NOT NULL THEN {RUN_SQL} ELSE t.updated_at END AS updated_at
{MERGE_SQL_JOIN}""")
def merge_upsert(spark, sf_dir):
    target, source = merge_inputs(spark, sf_dir)
    # Materialise the merge source once in the shared checkpoint folder: the
    # uniqueness check and the merge both read it instead of recomputing it.
    source = assert_unique(materialize(source), EV_KEYS)
    now = run_ts(RUN_TS)
    return merge(target, source, EV_KEYS,
                 set_update={"value": F.col("s.value"), "event_id": F.col("s.event_id"),
                             "extracted_at": F.col("s.extracted_at"), "updated_at": now},
                 set_insert={"updated_at": now})


# --- J2 / P7 (the curated state snapshot) and V6 ------------------------------------

def state_raw(ev, lo: str | None = None, hi: str | None = None):
    """Arrest-count landing rows derived from events (text dates and times)."""
    if lo:
        ev = ev.where(F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
    if hi:
        ev = ev.where(F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
    return ev.select(
        F.col("event_type").alias("state"), F.col("user_id").cast("string").alias("offense_code"),
        F.date_format("ts", "yyyy-MM-dd").alias("observation_date"), F.col("value"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("extracted_at"),
        F.concat(F.lit("batch_"), F.date_format("ts", "yyyyMMdd")).alias("source_file"),
        F.col("ts").alias("loaded_at"))


def curated_state(spark, sf_dir):
    ev = t(spark, sf_dir, "events")
    target = runbook.initial_snapshot(state_raw(ev, hi=TARGET_CUT))
    return runbook.curate(target, state_raw(ev, lo=SOURCE_FROM), RUN_TS)


STATE_RAW_SQL = """SELECT event_type AS state, CAST(user_id AS INTEGER) AS offense_code,
       CAST(ts AS DATE) AS observation_date, value, ts AS extracted_at,
       'batch_' || strftime(ts, '%Y%m%d') AS source_file, ts AS loaded_at FROM events"""
STATE_ORDER = ("extracted_at DESC NULLS LAST, loaded_at DESC NULLS LAST, value DESC NULLS LAST, "
               "source_file DESC NULLS LAST")
STATE_KEYS = "state, offense_code, observation_date"
CHANGED = "(t.value IS DISTINCT FROM s.value OR t.extracted_at IS DISTINCT FROM s.extracted_at)"
CURATED_SQL = f"""
WITH t AS (SELECT state, offense_code, observation_date, value, extracted_at, source_file, loaded_at,
                  loaded_at AS updated_at
           FROM ({ranked_sql(STATE_RAW_SQL + " WHERE ts < TIMESTAMP '" + TARGET_CUT + "'", STATE_KEYS, STATE_ORDER)})),
     s AS ({ranked_sql(STATE_RAW_SQL + " WHERE ts >= TIMESTAMP '" + SOURCE_FROM + "'", STATE_KEYS, STATE_ORDER)}),
     merged AS (
SELECT coalesce(t.state, s.state) AS state, coalesce(t.offense_code, s.offense_code) AS offense_code,
       coalesce(t.observation_date, s.observation_date) AS observation_date,
       CASE WHEN t.state IS NULL OR (s.state IS NOT NULL AND {CHANGED}) THEN s.value ELSE t.value END AS value,
       CASE WHEN t.state IS NULL OR (s.state IS NOT NULL AND {CHANGED}) THEN s.extracted_at ELSE t.extracted_at END AS extracted_at,
       CASE WHEN t.state IS NULL OR (s.state IS NOT NULL AND {CHANGED}) THEN s.source_file ELSE t.source_file END AS source_file,
       CASE WHEN t.state IS NULL THEN {RUN_SQL} ELSE t.loaded_at END AS loaded_at,
       CASE WHEN t.state IS NULL OR (s.state IS NOT NULL AND {CHANGED}) THEN {RUN_SQL} ELSE t.updated_at END AS updated_at
FROM t FULL OUTER JOIN s ON t.state = s.state AND t.offense_code = s.offense_code
     AND t.observation_date = s.observation_date)
"""


@case("merge_if_changed", CURATED_SQL + "SELECT * FROM merged")
def merge_if_changed(spark, sf_dir):
    return curated_state(spark, sf_dir)


@case("curated_state_verify", CURATED_SQL + """
SELECT state, count(DISTINCT offense_code) AS offense_codes, min(observation_date) AS earliest_month,
       max(observation_date) AS latest_month, count(*) AS total_rows
FROM merged GROUP BY state""")
def curated_state_verify(spark, sf_dir):
    return runbook.verify(curated_state(spark, sf_dir))


# --- J3 / J4 / A5 -------------------------------------------------------------------

@case("merge_insert_only", f"""
WITH t AS (SELECT DISTINCT o_custkey AS member_key FROM orders
           WHERE o_orderdate < TIMESTAMP '1998-01-01' AND o_custkey IS NOT NULL),
     s AS (SELECT DISTINCT o_custkey AS member_key FROM orders WHERE o_custkey IS NOT NULL)
SELECT member_key, {OLD_SQL} AS created_at, {OLD_SQL} AS updated_at FROM t
UNION ALL
SELECT member_key, {RUN_SQL}, {RUN_SQL} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.member_key = s.member_key)""")
def merge_insert_only(spark, sf_dir):
    orders = t(spark, sf_dir, "orders")
    old = run_ts(OLD_TS)
    target = (distinct_keys(orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")),
                            "o_custkey").withColumnRenamed("o_custkey", "member_key")
              .withColumn("created_at", old).withColumn("updated_at", old))
    source = distinct_keys(orders, "o_custkey").withColumnRenamed("o_custkey", "member_key")
    now = run_ts(RUN_TS)
    return merge(target, source, ["member_key"], set_update=None,
                 set_insert={"created_at": now, "updated_at": now})


@case("merge_touch", f"""
WITH t AS (SELECT DISTINCT l_suppkey AS ori FROM lineitem
           WHERE l_shipdate < TIMESTAMP '1998-01-01' AND l_suppkey IS NOT NULL),
     s AS (SELECT DISTINCT l_suppkey AS ori FROM lineitem WHERE l_suppkey IS NOT NULL)
SELECT coalesce(t.ori, s.ori) AS ori,
       CASE WHEN t.ori IS NULL THEN {RUN_SQL} ELSE {OLD_SQL} END AS created_at,
       CASE WHEN s.ori IS NULL THEN {OLD_SQL} ELSE {RUN_SQL} END AS updated_at
FROM t FULL OUTER JOIN s ON t.ori = s.ori""")
def merge_touch(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    old = run_ts(OLD_TS)
    target = (distinct_keys(li.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")),
                            "l_suppkey").withColumnRenamed("l_suppkey", "ori")
              .withColumn("created_at", old).withColumn("updated_at", old))
    source = distinct_keys(li, "l_suppkey").withColumnRenamed("l_suppkey", "ori")
    now = run_ts(RUN_TS)
    return merge(target, source, ["ori"], set_update={"updated_at": now},
                 set_insert={"created_at": now, "updated_at": now})


# --- J5 / H9 --------------------------------------------------------------------------

@case("grid_cross", f"""
WITH codes AS (SELECT DISTINCT l_linenumber AS offense_code FROM lineitem WHERE l_linenumber IS NOT NULL),
     members AS (SELECT 'NATIONAL' AS report_granularity, '<NONE>' AS report_level
                 UNION ALL SELECT 'STATE', n_name FROM nation
                 UNION ALL SELECT 'ORI', 'C' || CAST(c_custkey AS VARCHAR) FROM customer)
SELECT 'ARREST' AS function, m.report_granularity, m.report_level, c.offense_code,
       CASE WHEN m.report_granularity = 'NATIONAL' THEN {OLD_SQL} ELSE {RUN_SQL} END AS created_at,
       CASE WHEN m.report_granularity = 'NATIONAL' THEN {OLD_SQL} ELSE {RUN_SQL} END AS updated_at
FROM members m JOIN codes c ON true""")
def grid_cross(spark, sf_dir):
    """The arrest extraction grid (national level, states, agencies) seeded
    insert-only into marks that already hold the national rows."""
    from sluice.plans.highwater import GRAIN_NATIONAL, GRID_KEYS, arrest_grid
    codes = t(spark, sf_dir, "lineitem").select("l_linenumber")
    states = t(spark, sf_dir, "nation").select("n_name")
    oris = t(spark, sf_dir, "customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ori"))
    g = arrest_grid(spark, codes, states, oris)
    old = run_ts(OLD_TS)
    marks = (g.where(F.col("report_granularity") == GRAIN_NATIONAL)
             .withColumn("created_at", old).withColumn("updated_at", old))
    return seed_grid(marks, g, GRID_KEYS, RUN_TS)


# --- J7 ----------------------------------------------------------------------------------

@case("enrich_metadata", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, coalesce(p.p_name, '') AS p_name, coalesce(p.p_brand, '') AS p_brand,
       coalesce(p.p_type, '') AS p_type
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey AND p.p_size > 5""")
def enrich_metadata(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    # Small parts have no metadata: their observations must stay.
    part = t(spark, sf_dir, "part").where("p_size > 5").select(F.col("p_partkey").alias("l_partkey"), "p_name",
                                           "p_brand", "p_type")
    return enrich(li, part, "l_partkey")


def _state_update():
    now = run_ts(RUN_TS)
    return dict(set_update={"value": F.col("s.value"), "extracted_at": F.col("s.extracted_at"),
                            "source_file": F.col("s.source_file"), "updated_at": now},
                set_insert={"loaded_at": now, "updated_at": now},
                update_when=["value", "extracted_at"], null_keys="drop", spread_nulls=False)


@case("merge_in_place", CURATED_SQL + "SELECT * FROM merged")
def merge_in_place(spark, sf_dir):
    """The curated state snapshot stored partitioned by observation date; the
    run's source touches only the days from the source start, so only those
    slices are read and written anew."""
    from sluice.plans.snapshots import create_partitioned, merge_partitioned, partitioned
    from sluice.session import scratch_path
    ev = t(spark, sf_dir, "events")
    root = scratch_path(spark, "curated_state")
    first = runbook.initial_snapshot(state_raw(ev, hi=TARGET_CUT)).select(*runbook.CURATED_COLS)
    create_partitioned(first, root, "observation_date")
    src = runbook.latest_source(state_raw(ev, lo=SOURCE_FROM)).drop("loaded_at")
    merge_partitioned(root, src, runbook.KEYS, "observation_date", **_state_update())
    return partitioned(spark, root, "observation_date")


@case("replace_slices", f"""
SELECT event_id, CAST(ts AS DATE) AS day, event_type,
       CASE WHEN ts >= TIMESTAMP '{SOURCE_FROM}' THEN value * 2 ELSE value END AS value
FROM events WHERE CAST(ts AS DATE) <> CAST(TIMESTAMP '{SOURCE_FROM}' AS DATE) OR ts >= TIMESTAMP '{SOURCE_FROM}'""")
def replace_slices(spark, sf_dir):
    """K4: the days of a rerun replace those of the snapshot, which the rerun
    itself reads; the other days stay."""
    from sluice.plans.snapshots import create_partitioned, partitioned, replace_partitions
    from sluice.session import scratch_path
    root = scratch_path(spark, "days")
    ev = t(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"), "event_type", "value", "ts")
    create_partitioned(ev, root, "day")
    again = partitioned(spark, root, "day").where(F.col("ts") >= F.lit(SOURCE_FROM).cast("timestamp_ntz"))
    replace_partitions(again.withColumn("value", F.col("value") * 2), root, "day")
    return partitioned(spark, root, "day").drop("ts")


def _bucketed_setup(spark, sf_dir):
    from sluice.plans.snapshots import bytes_at, write_bucketed
    from sluice.session import scratch_path
    ev = t(spark, sf_dir, "events")
    root = scratch_path(spark, "curated_state_bucketed")
    name = f"curated_state_{root.rsplit('-', 1)[-1]}"
    first = runbook.initial_snapshot(state_raw(ev, hi=TARGET_CUT)).select(*runbook.CURATED_COLS)
    landed = scratch_path(spark, "curated_state_first")
    first.write.parquet(landed)
    # Small buckets, so that the test tables have several.
    write_bucketed(spark.read.parquet(landed), f"{name}_v1", runbook.KEYS, f"{root}/v1", bytes_at(spark, landed), 64 << 10)
    return root, name, runbook.typed_source(state_raw(ev, lo=SOURCE_FROM))


def _latest(typed):
    return runbook.latest_rows(typed).drop("loaded_at")


@case("merge_bucketed", CURATED_SQL + "SELECT * FROM merged")
def merge_bucketed_q(spark, sf_dir):
    """The curated state snapshot kept as a table bucketed by its key: the
    merge reads it without a shuffle, ranks the source in its buckets, and
    writes the next version."""
    from sluice.plans.snapshots import merge_bucketed
    root, name, source = _bucketed_setup(spark, sf_dir)
    return merge_bucketed(spark, f"{name}_v1", source, runbook.KEYS, f"{name}_v2", f"{root}/v2", prepare=_latest,
                          **_state_update())


def merge_bucketed_plan(spark, sf_dir):
    """The merge itself (before the write), to show its plan."""
    from sluice.plans.snapshots import bucket_state, merged_buckets
    _root, name, source = _bucketed_setup(spark, sf_dir)
    buckets, _target, _place = bucket_state(spark, f"{name}_v1")
    return merged_buckets(spark, f"{name}_v1", source, runbook.KEYS, buckets, _latest, **_state_update())
