"""High-water-mark extraction over daily series derived from events
(H1-H11, J6, J8, A6, A7, R10, K7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators.aggregate import delta_stats, run_totals
from sluice.operators.reshape import series_rows
from sluice.plans import highwater as hw
from sluice.session import materialize, scratch_path
from sluice.sources import sinks
from sluice.sources.landing import values_df
from sluice.suite import case
from sluice.suite.common import RUN_SQL, RUN_TS, dec_sum, t

# The series configuration (category -> ordered ids), the
# failed series of this run, the default start and the previous run.
CONFIG = [("engagement", 0, ["view", "click  (page views)"]),
          ("commerce", 1, ["purchase", "signup"]),
          ("operations", 2, ["error", "view", "refund"])]
FAILED = ["click", "refund"]
DEFAULT_START = "2024-01-10"
MARK_CUT = "2024-01-20"
PREV_RUN = "2024-01-20 06:00:00"
RUN_ID = "20240201_000000"


def observations(spark, sf_dir):
    ev = t(spark, sf_dir, "events")
    return (ev.groupBy(F.col("event_type").alias("series_id"), F.to_date("ts").alias("observation_date"))
            .agg(dec_sum("value").alias("value")))


def configured(spark):
    cfg = values_df(spark, CONFIG, "category STRING, cat_pos INT, series_ids ARRAY<STRING>")
    return series_rows(cfg)


def meta_of(series):
    return series.select("series_id", F.concat(F.lit("Events: "), "series_id").alias("title"),
                         F.lit("Daily").alias("frequency"), F.lit("USD").alias("units"))


def previous_marks(spark, sf_dir, obs=None):
    prev = F.lit(PREV_RUN).cast("timestamp_ntz")
    obs = observations(spark, sf_dir) if obs is None else obs
    m = (obs.where((F.col("observation_date") < F.lit(MARK_CUT).cast("date"))
                   & (F.col("series_id") != "signup"))
         .groupBy("series_id").agg(F.max("observation_date").alias("last_observation_date")))
    return m.select("series_id", F.concat(F.lit("Events: "), "series_id").alias("title"),
                    F.lit("Daily").alias("frequency"), F.lit("USD").alias("units"),
                    "last_observation_date", prev.alias("last_successful_run"),
                    F.lit(0).cast("int").alias("consecutive_failures"), prev.alias("updated_at"))


def failed_df(spark):
    return values_df(spark, [(s,) for s in FAILED], "series_id STRING")


def scenario(spark, sf_dir):
    series = configured(spark)
    marks = previous_marks(spark, sf_dir)
    plan = hw.plan(series, marks, DEFAULT_START)
    failed = failed_df(spark)
    delta = (hw.delta(observations(spark, sf_dir), plan)
             .join(F.broadcast(failed), "series_id", "left_anti"))      # literal list of failed ids
    stats = delta_stats(delta, "series_id", "observation_date")
    return series, marks, plan, failed, delta, stats


def run_log(spark, sf_dir):
    _series, _marks, plan, failed, _delta, stats = scenario(spark, sf_dir)
    return hw.extraction_log(plan, stats, failed, RUN_ID, RUN_TS,
                             file_of=lambda c: F.concat(F.lit("series_id="), c, F.lit("/"), c,
                                                        F.lit(f"_{RUN_ID}.csv")))


CTE = f"""
WITH cfg_raw(category, cat_pos, pos, raw) AS (VALUES
        ('engagement', 0, 0, 'view'), ('engagement', 0, 1, 'click  (page views)'),
        ('commerce', 1, 0, 'purchase'), ('commerce', 1, 1, 'signup'),
        ('operations', 2, 0, 'error'), ('operations', 2, 1, 'view'), ('operations', 2, 2, 'refund')),
     cfg AS (SELECT category, cat_pos, pos, regexp_split_to_array(trim(raw), '\\s+')[1] AS series_id FROM cfg_raw),
     series AS (SELECT category, cat_pos, pos, series_id FROM
                (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY cat_pos, pos) AS rn FROM cfg) WHERE rn = 1),
     obs AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS observation_date,
                    CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events GROUP BY 1, 2),
     marks AS (SELECT series_id, 'Events: ' || series_id AS title, 'Daily' AS frequency, 'USD' AS units,
                      max(observation_date) AS last_observation_date,
                      TIMESTAMP '{PREV_RUN}' AS last_successful_run, CAST(0 AS INTEGER) AS consecutive_failures,
                      TIMESTAMP '{PREV_RUN}' AS updated_at
               FROM obs WHERE observation_date < DATE '{MARK_CUT}' AND series_id <> 'signup' GROUP BY series_id),
     plan AS (SELECT s.series_id, s.category, s.cat_pos, s.pos,
                     coalesce(m.last_observation_date + 1, DATE '{DEFAULT_START}') AS start_date
              FROM series s LEFT JOIN marks m ON s.series_id = m.series_id),
     failed(series_id) AS (VALUES ('click'), ('refund')),
     delta AS (SELECT o.series_id, o.observation_date, o.value FROM obs o JOIN plan p ON o.series_id = p.series_id
               WHERE o.observation_date >= p.start_date AND o.value IS NOT NULL
                 AND o.series_id NOT IN (SELECT series_id FROM failed)),
     stats AS (SELECT series_id, count(*) AS record_count, max(observation_date) AS end_date FROM delta GROUP BY series_id),
     log AS (SELECT '{RUN_ID}' AS run_id, p.series_id, {RUN_SQL} AS extracted_at,
                    CASE WHEN f.series_id IS NOT NULL THEN 'error' ELSE 'success' END AS status,
                    CAST(CASE WHEN f.series_id IS NULL AND coalesce(st.record_count, 0) > 0
                              THEN st.record_count ELSE 0 END AS INTEGER) AS record_count,
                    CASE WHEN f.series_id IS NOT NULL THEN 'extraction failed'
                         WHEN coalesce(st.record_count, 0) > 0 THEN 'Uploaded delta observations'
                         ELSE 'No new observations' END AS message,
                    CASE WHEN f.series_id IS NULL AND coalesce(st.record_count, 0) > 0
                         THEN 'series_id=' || p.series_id || '/' || p.series_id || '_{RUN_ID}.csv' END AS s3_key,
                    p.start_date,
                    CASE WHEN f.series_id IS NULL AND coalesce(st.record_count, 0) > 0 THEN st.end_date END AS end_date
             FROM plan p LEFT JOIN stats st ON p.series_id = st.series_id
                         LEFT JOIN failed f ON p.series_id = f.series_id)
"""


@case("plan_start_dates", CTE + "SELECT series_id, category, start_date FROM plan")
def plan_start_dates(spark, sf_dir):
    _s, _m, plan, *_ = scenario(spark, sf_dir)
    return plan.select("series_id", "category", "start_date")


@case("delta_rows", CTE + "SELECT series_id, observation_date, value FROM delta")
def delta_rows(spark, sf_dir):
    return scenario(spark, sf_dir)[4]


@case("advance_marks", CTE + f"""
SELECT coalesce(m.series_id, s.series_id) AS series_id,
       CASE WHEN s.series_id IS NOT NULL THEN 'Events: ' || s.series_id ELSE m.title END AS title,
       CASE WHEN s.series_id IS NOT NULL THEN 'Daily' ELSE m.frequency END AS frequency,
       CASE WHEN s.series_id IS NOT NULL THEN 'USD' ELSE m.units END AS units,
       CASE WHEN s.series_id IS NOT NULL THEN s.end_date ELSE m.last_observation_date END AS last_observation_date,
       CASE WHEN s.series_id IS NOT NULL THEN {RUN_SQL} ELSE m.last_successful_run END AS last_successful_run,
       CASE WHEN s.series_id IS NOT NULL THEN CAST(0 AS INTEGER) ELSE m.consecutive_failures END AS consecutive_failures,
       CASE WHEN s.series_id IS NOT NULL THEN {RUN_SQL} ELSE m.updated_at END AS updated_at
FROM marks m FULL OUTER JOIN (SELECT * FROM stats WHERE record_count > 0) s ON m.series_id = s.series_id""")
def advance_marks(spark, sf_dir):
    series, marks, _p, _f, _d, stats = scenario(spark, sf_dir)
    return hw.advance(marks, stats, meta_of(series), RUN_TS)


@case("update_failures", CTE + f"""
SELECT m.series_id, m.title, m.frequency, m.units, m.last_observation_date, m.last_successful_run,
       CASE WHEN f.series_id IS NOT NULL THEN coalesce(m.consecutive_failures, 0) + 1
            ELSE m.consecutive_failures END AS consecutive_failures,
       CASE WHEN f.series_id IS NOT NULL THEN {RUN_SQL} ELSE m.updated_at END AS updated_at
FROM marks m LEFT JOIN failed f ON m.series_id = f.series_id""")
def update_failures(spark, sf_dir):
    marks = previous_marks(spark, sf_dir)
    return hw.bump_failures(marks, failed_df(spark), RUN_TS)


@case("extraction_log", CTE + "SELECT * FROM log")
def extraction_log(spark, sf_dir):
    return run_log(spark, sf_dir)


@case("run_totals", CTE + f"""
SELECT '{RUN_ID}' AS run_id, '2024-02-01T00:00:00+00:00' AS started_at, false AS disable_watermark,
       '{DEFAULT_START}' AS default_start_date, CAST(NULL AS VARCHAR) AS category_filter,
       CAST(NULL AS INTEGER) AS max_series,
       count(*) AS total_series, count(*) FILTER (WHERE status = 'success') AS successful_series,
       count(*) FILTER (WHERE status = 'error') AS failed_series,
       CAST(coalesce(sum(record_count), 0) AS BIGINT) AS rows_uploaded FROM log""")
def run_totals_q(spark, sf_dir):
    totals = run_totals(run_log(spark, sf_dir))
    summary = hw.run_summary(totals, RUN_ID, RUN_TS, DEFAULT_START)
    path = scratch_path(spark, "run_summary")
    sinks.write_summary(summary, path)       # K7
    return spark.read.schema(summary.schema).json(path)


@case("full_refresh", CTE + f"""
SELECT o.series_id, o.observation_date, o.value FROM obs o JOIN series s ON o.series_id = s.series_id
WHERE o.observation_date >= DATE '{DEFAULT_START}' AND o.value IS NOT NULL""")
def full_refresh(spark, sf_dir):
    plan = hw.plan(configured(spark), None, DEFAULT_START, use_marks=False)
    return hw.delta(observations(spark, sf_dir), plan)


@case("plan_subset", CTE + f"""
, chosen AS (SELECT series_id, category, cat_pos, pos FROM
             (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY cat_pos, pos) AS rn FROM cfg
              WHERE lower(category) = 'operations') WHERE rn = 1 ORDER BY cat_pos, pos LIMIT 2)
SELECT c.series_id, c.category, coalesce(m.last_observation_date + 1, DATE '{DEFAULT_START}') AS start_date
FROM chosen c LEFT JOIN marks m ON c.series_id = m.series_id""")
def plan_subset(spark, sf_dir):
    """H11 + P9: one category (case-insensitive), its series without repeats,
    then the first n. A series that another category lists too stays."""
    from sluice.functions.predicates import optional_eq
    cfg = values_df(spark, CONFIG, "category STRING, cat_pos INT, series_ids ARRAY<STRING>")
    chosen = series_rows(optional_eq(cfg, "category", "OPERATIONS")).orderBy("cat_pos", "pos").limit(2)
    return hw.plan(chosen, previous_marks(spark, sf_dir), DEFAULT_START).select("series_id", "category", "start_date")


# The request period of the state-level arrest extraction.
ARREST_FROM, ARREST_TO = "01-1999", "03-2026"


@case("arrest_request_plan", f"""
WITH codes AS (SELECT DISTINCT l_linenumber AS offense_code FROM lineitem WHERE l_linenumber IS NOT NULL),
     grid AS (SELECT n.n_name AS member, c.offense_code FROM nation n JOIN codes c ON true),
     delivered AS (SELECT n.n_name AS member, l.l_linenumber AS offense_code,
                          max(CAST(date_trunc('month', l.l_shipdate) AS DATE)) AS last_month
                   FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
                   JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY 1, 2)
SELECT 'STATE' AS report_granularity, g.member AS report_level, g.offense_code,
       strftime(coalesce(CAST(d.last_month + INTERVAL 1 MONTH AS DATE), DATE '1999-01-01'), '%m-%Y') AS from_month,
       '{ARREST_TO}' AS to_month
FROM grid g LEFT JOIN delivered d ON g.member = d.member AND g.offense_code = d.offense_code""")
def arrest_request_plan(spark, sf_dir):
    """Extraction grid (J5) joined to its month marks (H3): next month to
    request per (state, offense code)."""
    from sluice.operators.joins import grid
    li = t(spark, sf_dir, "lineitem")
    nation = t(spark, sf_dir, "nation")
    g = grid(nation.select(F.col("n_name").alias("member")), li.select("l_linenumber"), "offense_code")
    sup = t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"),
                                              F.col("s_nationkey").alias("n_nationkey"))
    marks = (li.select("l_suppkey", F.col("l_linenumber").alias("offense_code"), "l_shipdate")
             .join(sup, "l_suppkey").join(nation, "n_nationkey")
             .groupBy(F.col("n_name").alias("member"), "offense_code")
             .agg(F.date_format(F.max("l_shipdate"), "MM-yyyy").alias("last_date"))
             .withColumn("first_date", F.lit(None).cast("string")))
    planned = hw.plan_months(g.join(marks, ["member", "offense_code"], "left"), ARREST_FROM, ARREST_TO)
    return planned.select(F.lit(hw.GRAIN_STATE).alias("report_granularity"), F.col("member").alias("report_level"),
                          "offense_code", "from_month", "to_month")


LOOKBACK = 2


def _log_table(root: str) -> str:
    return "extraction_log_" + root.rsplit("-", 1)[-1]


def series_run(spark, sf_dir):
    """One incremental run with a two-day lookback, committed (log first,
    marks last), followed by the load and merge of the landed CSV files."""
    from sluice.plans import series as series_plan
    from sluice.session import materialize, scratch_path
    root = scratch_path(spark, "series_run")
    series = configured(spark)
    obs = materialize(observations(spark, sf_dir))                # marks, delta and target use it
    marks = previous_marks(spark, sf_dir, obs)
    out = hw.run_extraction(obs, series, marks, meta_of(series),
                            default_start=DEFAULT_START, run_ts=RUN_TS, run_id=RUN_ID,
                            landing_root=f"{root}/landing", failed=failed_df(spark),
                            lookback_days=LOOKBACK)
    hw.commit_run(out, f"{root}/log", f"{root}/marks", RUN_ID, RUN_TS)
    hw.ensure_log_table(spark, _log_table(root), f"{root}/log")              # H1
    prev = F.lit(PREV_RUN).cast("timestamp_ntz")
    prev_instant = F.try_to_timestamp(F.lit(PREV_RUN.replace(" ", "T") + "Z"))
    previous = (obs
                .where((F.col("observation_date") < F.lit(MARK_CUT).cast("date"))
                       & (F.col("series_id") != "signup"))
                .join(F.broadcast(series.select("series_id")), "series_id", "left_semi")   # config-sized
                .select("series_id", "observation_date", "value",
                        F.concat(F.lit("Events: "), "series_id").alias("title"), F.lit("Daily").alias("frequency"),
                        F.lit("USD").alias("units"), prev_instant.alias("extracted_at"),
                        F.lit("seed").alias("source_file"), prev.alias("loaded_at"), prev.alias("updated_at")))
    raw = series_plan.load(spark, out.landing_path, RUN_TS)
    return root, series_plan.curate(previous, raw, RUN_TS)


SERIES_CTE = CTE.replace("coalesce(m.last_observation_date + 1,", f"coalesce(m.last_observation_date + {1 - LOOKBACK},") + f""",
     prev AS (SELECT series_id, observation_date, value, 'Events: ' || series_id AS title, 'Daily' AS frequency,
                     'USD' AS units, epoch_us(TIMESTAMP '{PREV_RUN}') AS extracted_us, false AS from_landing,
                     TIMESTAMP '{PREV_RUN}' AS loaded_at, TIMESTAMP '{PREV_RUN}' AS updated_at
              FROM obs WHERE observation_date < DATE '{MARK_CUT}' AND series_id <> 'signup'
                AND series_id IN (SELECT series_id FROM series)),
     curated AS (
        SELECT coalesce(p.series_id, d.series_id) AS series_id,
               coalesce(p.observation_date, d.observation_date) AS observation_date,
               CASE WHEN d.series_id IS NOT NULL THEN d.value ELSE p.value END AS value,
               CASE WHEN d.series_id IS NOT NULL THEN 'Events: ' || d.series_id ELSE p.title END AS title,
               CASE WHEN d.series_id IS NOT NULL THEN 'Daily' ELSE p.frequency END AS frequency,
               CASE WHEN d.series_id IS NOT NULL THEN 'USD' ELSE p.units END AS units,
               CASE WHEN d.series_id IS NOT NULL THEN epoch_us(TIMESTAMP '{RUN_ID[:4]}-{RUN_ID[4:6]}-{RUN_ID[6:8]} 00:00:00')
                    ELSE p.extracted_us END AS extracted_us,
               d.series_id IS NOT NULL AS from_landing,
               CASE WHEN d.series_id IS NOT NULL THEN {RUN_SQL} ELSE p.loaded_at END AS loaded_at,
               CASE WHEN d.series_id IS NOT NULL THEN {RUN_SQL} ELSE p.updated_at END AS updated_at
        FROM prev p FULL OUTER JOIN delta d ON p.series_id = d.series_id AND p.observation_date = d.observation_date)
"""


@case("series_pipeline", SERIES_CTE + "SELECT * FROM curated")
def series_pipeline(spark, sf_dir):
    _root, curated = series_run(spark, sf_dir)
    return curated.select("series_id", "observation_date", "value", "title", "frequency", "units",
                          F.unix_micros("extracted_at").alias("extracted_us"),
                          F.col("source_file").endswith(".csv").alias("from_landing"), "loaded_at", "updated_at")


@case("committed_marks", SERIES_CTE + f"""
SELECT coalesce(m.series_id, s.series_id) AS series_id,
       CASE WHEN s.series_id IS NOT NULL THEN 'Events: ' || s.series_id ELSE m.title END AS title,
       CASE WHEN s.series_id IS NOT NULL THEN 'Daily' ELSE m.frequency END AS frequency,
       CASE WHEN s.series_id IS NOT NULL THEN 'USD' ELSE m.units END AS units,
       CASE WHEN s.series_id IS NOT NULL THEN s.end_date ELSE m.last_observation_date END AS last_observation_date,
       CASE WHEN s.series_id IS NOT NULL THEN {RUN_SQL} ELSE m.last_successful_run END AS last_successful_run,
       CASE WHEN s.series_id IS NOT NULL THEN CAST(0 AS INTEGER)
            WHEN m.series_id IN (SELECT series_id FROM failed) THEN coalesce(m.consecutive_failures, 0) + 1
            ELSE m.consecutive_failures END AS consecutive_failures,
       CASE WHEN s.series_id IS NOT NULL OR m.series_id IN (SELECT series_id FROM failed) THEN {RUN_SQL}
            ELSE m.updated_at END AS updated_at
FROM marks m FULL OUTER JOIN (SELECT * FROM stats WHERE record_count > 0) s ON m.series_id = s.series_id""")
def committed_marks(spark, sf_dir):
    root, _curated = series_run(spark, sf_dir)
    return hw.latest_marks(spark, f"{root}/marks")


@case("committed_log", SERIES_CTE + "SELECT * EXCLUDE (s3_key), s3_key IS NOT NULL AS landed FROM log")
def committed_log(spark, sf_dir):
    root, _curated = series_run(spark, sf_dir)
    log = spark.table(_log_table(root))
    return log.withColumn("landed", F.col("s3_key").isNotNull()).drop("s3_key")


RUN_2, RUN_TS_2 = "20240202_000000", "2024-02-02 00:00:00"


def _one_run(root, obs, series, run_id, run_ts, failed, crash=False, marks=None):
    """A run from the marks committed last (or ``marks``, before any is)."""
    from sluice.plans.snapshots import last_commit
    spark = obs.sparkSession
    if last_commit(spark, f"{root}/marks") is not None:
        marks = hw.latest_marks(spark, f"{root}/marks")
    out = hw.run_extraction(obs, series, marks, meta_of(series), default_start=DEFAULT_START, run_ts=run_ts, run_id=run_id,
                            landing_root=f"{root}/landing", failed=failed)
    if crash:           # the driver is lost after the log, before the marks
        hw.begin_run(spark, f"{root}/log", run_id, run_ts)
        return hw.write_log(out, f"{root}/log", run_id)
    return hw.commit_run(out, f"{root}/log", f"{root}/marks", run_id, run_ts)


@case("run_protocol", CTE + f"""
, ends AS (SELECT coalesce(m.series_id, s.series_id) AS series_id,
                  CASE WHEN s.end_date IS NULL THEN m.last_observation_date
                       ELSE greatest(s.end_date, coalesce(m.last_observation_date, s.end_date)) END AS last_date
           FROM marks m FULL OUTER JOIN (SELECT * FROM stats WHERE record_count > 0) s ON m.series_id = s.series_id),
   start2 AS (SELECT s.series_id, coalesce(e.last_date + 1, DATE '{DEFAULT_START}') AS start_date
              FROM series s LEFT JOIN ends e ON s.series_id = e.series_id),
   stats2 AS (SELECT p.series_id, p.start_date, count(o.value) AS record_count, max(o.observation_date) AS end_date
              FROM start2 p LEFT JOIN obs o ON o.series_id = p.series_id AND o.observation_date >= p.start_date
                AND o.value IS NOT NULL GROUP BY 1, 2)
SELECT run_id, series_id, status, record_count, message, start_date, end_date FROM log
UNION ALL SELECT '{RUN_2}', series_id, 'success', CAST(record_count AS INTEGER),
       CASE WHEN record_count > 0 THEN 'Uploaded delta observations' ELSE 'No new observations' END, start_date, end_date
FROM stats2""")
def run_protocol(spark, sf_dir):
    """H7: a run that dies between log and marks, the same run again, a replay
    of it, and a next run in which no series fails."""
    root = scratch_path(spark, "run_protocol")
    series, obs = configured(spark), materialize(observations(spark, sf_dir))
    first = dict(failed=failed_df(spark), marks=previous_marks(spark, sf_dir, obs))
    _one_run(root, obs, series, RUN_ID, RUN_TS, crash=True, **first)
    _one_run(root, obs, series, RUN_ID, RUN_TS, **first)
    _one_run(root, obs, series, RUN_ID, RUN_TS, **first)
    _one_run(root, obs, series, RUN_2, RUN_TS_2, None)
    return hw.committed_log(spark, f"{root}/log").select(
        "run_id", "series_id", "status", "record_count", "message", "start_date", "end_date")


REFRESH_START = "2024-01-25"


@case("full_refresh_run", CTE + f"""
, rows AS (SELECT s.series_id, count(o.value) AS record_count, max(o.observation_date) AS end_date
           FROM series s LEFT JOIN obs o ON o.series_id = s.series_id AND o.observation_date >= DATE '{REFRESH_START}'
             AND o.value IS NOT NULL GROUP BY 1)
SELECT '{RUN_ID}' AS run_id, series_id, 'success' AS status, CAST(record_count AS INTEGER) AS record_count,
       DATE '{REFRESH_START}' AS start_date, end_date, record_count AS landed_rows, false AS marks_written
FROM rows""")
def full_refresh_run(spark, sf_dir):
    """H10 + H3: a whole run without marks, every series from the start given;
    its log and landed files are written, marks are not."""
    from sluice.plans import series as series_plan
    from sluice.plans.snapshots import last_commit
    root = scratch_path(spark, "full_refresh_run")
    series, obs = configured(spark), materialize(observations(spark, sf_dir))
    out = hw.run_extraction(obs, series, previous_marks(spark, sf_dir, obs), meta_of(series), default_start=DEFAULT_START,
                            run_ts=RUN_TS, run_id=RUN_ID, landing_root=f"{root}/landing", use_marks=False,
                            override_start=REFRESH_START)
    hw.commit_run(out, f"{root}/log", f"{root}/marks", RUN_ID, RUN_TS)
    landed = series_plan.load(spark, out.landing_path, RUN_TS).groupBy("series_id").agg(F.count("*").alias("landed_rows"))
    log = hw.committed_log(spark, f"{root}/log").select("run_id", "series_id", "status", "record_count", "start_date", "end_date")
    return log.join(landed, "series_id", "left").withColumn("landed_rows", F.coalesce("landed_rows", F.lit(0))).withColumn(
        "marks_written", F.lit(last_commit(spark, f"{root}/marks") is not None))


# --- Seeding (W4, S9, J3, J4) and the month plans of all grains ---------------------

SEED_1, SEED_2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def _seeded_twice(target, seed):
    """Seed, then seed again from what the first run wrote."""
    return seed(materialize(seed(materialize(target))))


@case("seed_states", f"""
WITH names AS (SELECT DISTINCT n_name AS state FROM nation),
     old AS (SELECT state, row_number() OVER (ORDER BY state) * 2 AS state_id FROM names WHERE state < 'NATION_2'),
     new AS (SELECT state, (SELECT max(state_id) FROM old) + row_number() OVER (ORDER BY state) AS state_id
             FROM names WHERE state >= 'NATION_2')
SELECT state_id, state, TIMESTAMP '{SEED_1}' AS created_at FROM old
UNION ALL SELECT state_id, state, TIMESTAMP '{SEED_2}' FROM new""")
def seed_states_q(spark, sf_dir):
    """States given twice get one id; ids follow the greatest of the table and
    come from a range claimed once; a second seeding adds nothing."""
    from pyspark.sql import Window
    from sluice.plans import dimensions
    names = t(spark, sf_dir, "nation").select(F.col("n_name").alias("state"))
    place = F.row_number().over(Window.orderBy("state")).cast("bigint") * 2     # one row a nation
    old = names.distinct().where("state < 'NATION_2'").select(place.alias("state_id"), "state",
                                                              F.lit(SEED_1).cast("timestamp_ntz").alias("created_at"))
    ledger = scratch_path(spark, "state_ids")
    return _seeded_twice(old, lambda target: dimensions.seed_states(spark, target, SEED_2, names.union(names), ledger))


@case("seed_codes", f"""
SELECT DISTINCT l_linenumber AS offense_code,
       CASE WHEN l_linenumber <= 3 THEN TIMESTAMP '{SEED_1}' ELSE TIMESTAMP '{SEED_2}' END AS created_at
FROM lineitem WHERE l_linenumber IS NOT NULL""")
def seed_codes_q(spark, sf_dir):
    from sluice.plans import dimensions
    codes = t(spark, sf_dir, "lineitem").select("l_linenumber")
    old = codes.where("l_linenumber <= 3").distinct().select(F.col("l_linenumber").alias("offense_code"),
                                                             F.lit(SEED_1).cast("timestamp_ntz").alias("created_at"))
    return _seeded_twice(old, lambda target: dimensions.seed_codes(spark, target, codes, "offense_code", "INT", SEED_2))


@case("seed_ori", f"""
WITH agencies AS (SELECT DISTINCT CASE WHEN o_custkey % 7 <> 0 THEN 'C' || o_custkey END AS ori FROM orders),
     old AS (SELECT 'C' || c_custkey AS ori FROM customer WHERE c_custkey % 5 = 0)
SELECT coalesce(o.ori, a.ori) AS ori,
       CASE WHEN o.ori IS NOT NULL THEN TIMESTAMP '{SEED_1}' ELSE TIMESTAMP '{SEED_2}' END AS created_at,
       CASE WHEN a.ori IS NOT NULL THEN TIMESTAMP '{SEED_2}' ELSE TIMESTAMP '{SEED_1}' END AS updated_at
FROM old o FULL OUTER JOIN (SELECT ori FROM agencies WHERE ori IS NOT NULL) a ON o.ori = a.ori""")
def seed_ori_q(spark, sf_dir):
    """New agencies inserted, known ones touched, null ones left out."""
    from sluice.plans import dimensions
    code = lambda c: F.concat(F.lit("C"), F.col(c).cast("string"))
    agencies = t(spark, sf_dir, "orders").select(F.when(F.col("o_custkey") % 7 != 0, code("o_custkey")).alias("ori"))
    then = F.lit(SEED_1).cast("timestamp_ntz")
    old = t(spark, sf_dir, "customer").where("c_custkey % 5 = 0").select(code("c_custkey").alias("ori"),
                                                                         then.alias("created_at"), then.alias("updated_at"))
    return _seeded_twice(old, lambda target: dimensions.seed_ori(target, agencies, SEED_2))


@case("arrest_plan_all_grains", f"""
WITH codes AS (SELECT DISTINCT l_linenumber AS offense_code FROM lineitem WHERE l_linenumber IS NOT NULL),
     lines AS (SELECT l.l_linenumber AS offense_code, n.n_name AS state, s.s_name AS ori,
                      CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month
               FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey),
     delivered AS (SELECT 'NATIONAL' AS g, '<NONE>' AS level, offense_code, max(month) AS last FROM lines GROUP BY ALL
                   UNION ALL SELECT 'STATE', state, offense_code, max(month) FROM lines GROUP BY ALL
                   UNION ALL SELECT 'ORI', ori, offense_code, max(month) FROM lines WHERE month < DATE '2000-01-01' GROUP BY ALL),
     members AS (SELECT 'NATIONAL' AS g, '<NONE>' AS level UNION ALL SELECT 'STATE', n_name FROM nation
                 UNION ALL SELECT 'ORI', s_name FROM supplier)
SELECT 'ARREST' AS function, m.g AS report_granularity, m.level AS report_level, c.offense_code,
       strftime(coalesce(CAST(d.last + INTERVAL 1 MONTH AS DATE), DATE '1999-01-01'), '%m-%Y') AS from_month,
       '{ARREST_TO}' AS to_month
FROM members m JOIN codes c ON true
LEFT JOIN delivered d ON d.g = m.g AND d.level = m.level AND d.offense_code = c.offense_code""")
def arrest_plan_all_grains(spark, sf_dir):
    """J5 + H9 + H3: the grid of all three grains seeded into marks that hold
    what was delivered, twice, and the next months to request."""
    li = t(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_linenumber").alias("offense_code"),
                                             F.trunc("l_shipdate", "month").alias("month"))
    sup = t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("ori"), "s_nationkey")
    nat = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("state"))
    from sluice.operators.aggregate import grain_totals
    lines = li.join(sup, "l_suppkey").join(nat, "s_nationkey")
    # All grains from one pass: the months that each has, and the last of them.
    months = grain_totals(lines, {hw.GRAIN_NATIONAL: ["offense_code", "month"], hw.GRAIN_STATE: ["state", "offense_code", "month"],
                                  hw.GRAIN_ORI: ["ori", "offense_code", "month"]}, {"rows": F.lit(1)}, "report_granularity")
    months = months.where((F.col("report_granularity") != hw.GRAIN_ORI) | (F.col("month") < F.lit("2000-01-01").cast("date")))
    level = F.coalesce("state", "ori", F.lit(hw.NATIONAL_LEVEL))
    last = months.groupBy("report_granularity", level.alias("report_level"), "offense_code").agg(
        F.date_format(F.max("month"), "MM-yyyy").alias("last_date"))
    then = F.lit(SEED_1).cast("timestamp_ntz")
    no = lambda kind: F.lit(None).cast(kind)
    marks = last.select(F.lit(hw.GRID_FUNCTION).alias("function"), "report_granularity", "report_level", "offense_code",
                        no("string").alias("first_date"), "last_date", F.lit(0).alias("consecutive_api_failures"),
                        no("timestamp_ntz").alias("last_successful_run"), no("timestamp_ntz").alias("last_attempted_run"),
                        then.alias("created_at"), then.alias("updated_at"))
    grid = hw.arrest_grid(spark, li.select("offense_code"), nat.select("state"), sup.select("ori"))
    seeded = _seeded_twice(marks, lambda target: hw.seed_grid(target, grid, hw.GRID_KEYS, SEED_2))
    return hw.plan_months(seeded, ARREST_FROM, ARREST_TO).select(*hw.GRID_KEYS, "from_month", "to_month")
