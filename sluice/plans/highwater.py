"""High-water-mark incremental extraction.

A "mark" is the last observation date already landed for a series; the next
run starts the day after it. Everything is set-based: the plan is a join of
the configured series to their marks, the delta a join of observations to the
plan, and the book-keeping (marks, failures, log) are merges and joins over
the delta's per-series statistics. ``commit_run`` has the order of writes that
makes a run safe to repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.scalars import run_ts as _run_ts
from sluice.operators.aggregate import delta_stats, run_totals  # noqa: F401
from sluice.operators.merge import merge, update_where

# Status and message texts of the extraction log.
STATUS_OK = "success"
STATUS_ERROR = "error"
MSG_NO_ROWS = "No new observations"
MSG_UPLOADED = "Uploaded delta observations"

# Columns of the marks and of the log.
MARKS_DDL = ("series_id STRING, title STRING, frequency STRING, units STRING, "
             "last_observation_date DATE, last_successful_run TIMESTAMP_NTZ, "
             "consecutive_failures INT, updated_at TIMESTAMP_NTZ")
LOG_DDL = ("run_id STRING, series_id STRING, extracted_at TIMESTAMP_NTZ, status STRING, "
           "record_count INT, message STRING, s3_key STRING, start_date DATE, end_date DATE")


def _ts(v) -> Column:
    return v if isinstance(v, Column) else _run_ts(v)


# H2 + H3 (+ H10 when use_marks is False)
def plan(series: DataFrame, marks: DataFrame | None, default_start: str,
         override_start: str | None = None, use_marks: bool = True,
         lookback_days: int = 0, key: str = "series_id") -> DataFrame:
    """Start date per requested series: mark + 1 day, else the override,
    else the configured default.

    Marks are first cut down to the requested series by a semi join, so the
    side joined back has a row per requested series at most.
    """
    fallback = F.coalesce(F.lit(override_start).cast("date"), F.lit(default_start).cast("date"))
    if not use_marks or marks is None:
        return series.withColumn("start_date", fallback)
    keys = series.select(key).distinct()
    m = marks.select(key, "last_observation_date").join(keys, key, "left_semi")
    j = series.join(m, on=key, how="left")
    start = F.coalesce(F.date_add("last_observation_date", 1 - lookback_days), fallback)
    return j.withColumn("start_date", start).drop("last_observation_date")


# H4
def delta(obs: DataFrame, plan_df: DataFrame, key: str = "series_id",
          date: str = "observation_date", value: str = "value") -> DataFrame:
    """Observations on or after each series' start date, null values dropped.
    The plan has one row per requested series."""
    p = plan_df.select(key, "start_date")
    return (obs.join(p, on=key, how="inner")
            .where((F.col(date) >= F.col("start_date")) & F.col(value).isNotNull())
            .drop("start_date"))


# H5
def advance(marks: DataFrame, stats: DataFrame, meta: DataFrame | None, run_ts,
            key: str = "series_id") -> DataFrame:
    """Merge per-series stats (record_count, end_date) into the marks: new
    last date, failures reset, run time stamped. Series without new rows are
    untouched."""
    now = _ts(run_ts)
    src = stats.where(F.col("record_count") > 0).select(key, "end_date")
    if meta is not None:
        src = src.join(meta.select(key, "title", "frequency", "units"), on=key, how="left")
    else:
        src = src.select(key, "end_date", *[F.lit(None).cast("string").alias(c)
                                            for c in ("title", "frequency", "units")])
    src = src.select(key, F.coalesce("title", F.lit("")).alias("title"),
                     F.coalesce("frequency", F.lit("")).alias("frequency"),
                     F.coalesce("units", F.lit("")).alias("units"),
                     F.col("end_date").alias("last_observation_date"))
    return merge(marks, src, [key],
                 set_update={"title": F.col("s.title"), "frequency": F.col("s.frequency"),
                             "units": F.col("s.units"),
                             # A look-back run may end earlier: a mark never moves back.
                             "last_observation_date": F.greatest("t.last_observation_date", "s.last_observation_date"),
                             "last_successful_run": now,
                             "consecutive_failures": F.lit(0), "updated_at": now},
                 set_insert={"last_successful_run": now, "consecutive_failures": F.lit(0),
                             "updated_at": now},
                 # series_id is the marks table's primary key (NOT NULL).
                 null_keys="drop", spread_nulls=False)


# H6
def bump_failures(marks: DataFrame, failed: DataFrame, run_ts, key: str = "series_id") -> DataFrame:
    """Failure count + 1 for failed series that already have a mark."""
    now = _ts(run_ts)
    return update_where(marks, failed, [key], {
        "consecutive_failures": F.coalesce(F.col("consecutive_failures"), F.lit(0)) + 1,
        "updated_at": now})


# H7
def extraction_log(plan_df: DataFrame, stats: DataFrame, failed: DataFrame | None,
                   run_id: str, run_ts, key: str = "series_id",
                   file_of=None) -> DataFrame:
    """One row per planned series: error, success without rows, or success
    with rows (count, last date and the landed file)."""
    now = _ts(run_ts)
    j = plan_df.select(key, "start_date").join(stats, on=key, how="left")
    if failed is not None:
        j = j.join(failed.select(key).distinct().withColumn("__failed", F.lit(True)),
                   on=key, how="left")
    else:
        j = j.withColumn("__failed", F.lit(None).cast("boolean"))
    err = F.coalesce(F.col("__failed"), F.lit(False))
    rows = F.coalesce(F.col("record_count"), F.lit(0))
    has_rows = ~err & (rows > 0)
    s3_key = file_of(F.col(key)) if file_of else F.lit(None).cast("string")
    return j.select(
        F.lit(run_id).alias("run_id"), F.col(key).alias("series_id"),
        now.alias("extracted_at"),
        F.when(err, F.lit(STATUS_ERROR)).otherwise(F.lit(STATUS_OK)).alias("status"),
        F.when(has_rows, rows).otherwise(F.lit(0)).cast("int").alias("record_count"),
        F.when(err, F.lit("extraction failed"))
         .when(has_rows, F.lit(MSG_UPLOADED)).otherwise(F.lit(MSG_NO_ROWS)).alias("message"),
        F.when(has_rows, s3_key).alias("s3_key"),
        F.col("start_date"),
        F.when(has_rows, F.col("end_date")).alias("end_date"),
    )


# H9 (with J5 + J3)
def seed_grid(marks: DataFrame, grid_df: DataFrame, keys, run_ts) -> DataFrame:
    """Insert-only seeding of the extraction grid into the marks table."""
    now = _ts(run_ts)
    return merge(marks, grid_df, keys, set_update=None,
                 set_insert={"created_at": now, "updated_at": now}, null_keys="drop",
                 spread_nulls=False)   # the grid key is the marks table's primary key


# H3 over the arrest extraction grid (month marks stored as ``MM-YYYY`` text).
def plan_months(grid_marks: DataFrame, default_from: str, to_month: str,
                last_col: str = "last_date", first_col: str = "first_date") -> DataFrame:
    """Request period per grid row: the month after the stored last month,
    else the stored first month, else the default; the end is fixed."""
    from sluice.functions.scalars import month_text_date
    start = F.coalesce(F.add_months(month_text_date(last_col), 1), month_text_date(first_col),
                       month_text_date(F.lit(default_from)))
    return (grid_marks.withColumn("from_month", F.date_format(start, "MM-yyyy"))
            .withColumn("to_month", F.lit(to_month)))


# --- One incremental run, end to end -----------------------------------

# Column order of a landed series CSV (the loader reads by position).
CSV_COLUMNS = ["series_id", "observation_date", "value", "title", "frequency", "units", "extracted_at"]


class RunOutputs:
    """What one run produces; nothing is written until ``commit_run``."""

    def __init__(self, plan_df, rows, stats, log, marks, landing_path):
        self.plan, self.rows, self.stats = plan_df, rows, stats
        self.log, self.marks, self.landing_path = log, marks, landing_path


def run_extraction(obs: DataFrame, series: DataFrame, marks: DataFrame | None, meta: DataFrame, *,
                   default_start: str, run_ts: str, run_id: str, landing_root: str,
                   failed: DataFrame | None = None, use_marks: bool = True, lookback_days: int = 0,
                   override_start: str | None = None, key: str = "series_id") -> RunOutputs:
    """Plan, cut the delta, enrich it with series metadata and land it as one
    CSV folder per series (K1). The enriched delta is checkpointed once, so
    landing, statistics, log and marks all read the same rows (and a lost
    executor re-reads them instead of re-extracting). A full refresh
    (``use_marks=False``) starts every series at ``override_start`` or the
    default and leaves the marks alone."""
    from sluice.functions.scalars import date_text
    from sluice.session import materialize
    from sluice.sources.sinks import write_csv_partitioned
    plan_df = plan(series, marks, default_start, override_start, use_marks=use_marks and marks is not None,
                   lookback_days=lookback_days, key=key)
    d = delta(obs, plan_df, key=key)
    if failed is not None:
        d = d.join(failed.select(key).distinct(), key, "left_anti")
    m = meta.select(key, "title", "frequency", "units").join(
        series.select(key).distinct(), key, "left_semi")
    extracted = F.lit(run_ts.replace(" ", "T") + "+00:00")
    rows = d.join(m, key, "left").select(
        key, "observation_date", "value",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "frequency", "units")],
        extracted.alias("extracted_at"))
    rows = materialize(rows)
    path = f"{landing_root}/{run_id}"
    landed = rows.select(F.col(key).alias("series"), date_text("observation_date").alias("date"),
                         "value", "title", "frequency", "units", "extracted_at", F.col(key))
    write_csv_partitioned(landed, path, key)
    stats = delta_stats(rows, key, "observation_date")
    log = extraction_log(plan_df, stats, failed, run_id, run_ts, key=key,
                         file_of=lambda c: F.concat(F.lit(f"{path}/{key}="), c))
    new_marks = None
    if use_marks and marks is not None:
        new_marks = advance(marks, stats, meta, run_ts, key=key)
        if failed is not None:
            new_marks = bump_failures(new_marks, failed, run_ts, key=key)
    return RunOutputs(plan_df, rows, stats, log, new_marks, path)


# H7: the protocol of a run. ``<log>/run_id=<id>`` holds its log,
# ``<log>-runs/phase=<phase>/run_id=<id>`` an entry for what it has reached. The
# intent comes first, then the log, which a repeated run overwrites, then the marks
# as a new version, then the commit. Wherever a run dies, the same run id given
# again goes on from there, and each series has one log row of each run.
RUN_DDL = "started_at TIMESTAMP_NTZ, phase STRING, run_id STRING"
INTENT, COMMIT = "intent", "commit"


def _enter(spark, log_path: str, run_id: str, phase: str, run_ts) -> None:
    entry = spark.range(1).select(_ts(run_ts).alias("started_at"))
    entry.coalesce(1).write.mode("overwrite").parquet(f"{log_path}-runs/phase={phase}/run_id={run_id}")


def runs(spark, log_path: str) -> DataFrame:
    """``run_id, started_at, committed`` of every run that has an intent."""
    from pyspark.errors import AnalysisException
    try:
        entries = spark.read.schema(RUN_DDL).parquet(f"{log_path}-runs")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        entries = spark.createDataFrame([], RUN_DDL)
    return entries.groupBy("run_id").agg(F.min("started_at").alias("started_at"),
                                         F.bool_or(F.col("phase") == COMMIT).alias("committed"))


def begin_run(spark, log_path: str, run_id: str, run_ts) -> bool:
    """Enter the intent of a run; False when the run is committed already."""
    if not runs(spark, log_path).where((F.col("run_id") == run_id) & F.col("committed")).isEmpty():
        return False
    _enter(spark, log_path, run_id, INTENT, run_ts)
    return True


def write_log(out: RunOutputs, log_path: str, run_id: str) -> None:
    """The log of a run in place of what an earlier try of it left."""
    out.log.drop("run_id").write.mode("overwrite").parquet(f"{log_path}/run_id={run_id}")


def commit_run(out: RunOutputs, log_path: str, marks_root: str, run_id: str, run_ts: str = "1970-01-01 00:00:00") -> bool:
    """Write the log, then the marks, then the commit. A run that is committed
    changes nothing (False); one that died after its marks only gets its commit,
    since its plan would follow from marks that it moved itself."""
    from sluice.plans.snapshots import last_commit, publish
    spark = out.log.sparkSession
    if not begin_run(spark, log_path, run_id, run_ts):
        return False
    last = last_commit(spark, marks_root) if out.marks is not None else None
    if last is None or last["version"] != run_id:
        write_log(out, log_path, run_id)
        if out.marks is not None:
            publish(out.marks, marks_root, run_id)
    _enter(spark, log_path, run_id, COMMIT, run_ts)
    return True


def committed_log(spark, log_path: str) -> DataFrame:
    """The log of all committed runs."""
    log = spark.read.schema(LOG_DDL).parquet(log_path)
    return log.join(runs(spark, log_path).where("committed").select("run_id"), "run_id", "left_semi").select(log.columns)


def latest_marks(spark, marks_root: str) -> DataFrame:
    """The most recent committed marks version."""
    from sluice.plans.snapshots import current
    return current(spark, marks_root)


# H1
def ensure_log_table(spark, name: str, path: str) -> None:
    """The extraction log as a catalog table over its folder (created once),
    and the runs that it has by now."""
    from sluice.sources.sinks import ensure_table
    ensure_table(spark, name, LOG_DDL, path, partitioned_by="run_id")
    spark.catalog.recoverPartitions(name)


# H8 / K7
def run_summary(totals: DataFrame, run_id: str, run_ts: str, default_start: str,
                use_marks: bool = True, category_filter: str | None = None,
                max_series: int | None = None) -> DataFrame:
    """One-row run summary: the run's settings next to its totals."""
    return totals.select(
        F.lit(run_id).alias("run_id"), F.lit(run_ts.replace(" ", "T") + "+00:00").alias("started_at"),
        F.lit(not use_marks).alias("disable_watermark"), F.lit(default_start).alias("default_start_date"),
        F.lit(category_filter).cast("string").alias("category_filter"),
        F.lit(max_series).cast("int").alias("max_series"), "*")


# Keys of the arrest extraction grid.
GRID_FUNCTION = "ARREST"
GRAIN_NATIONAL, GRAIN_STATE, GRAIN_ORI = "NATIONAL", "STATE", "ORI"
NATIONAL_LEVEL = "<NONE>"
GRID_KEYS = ["function", "report_granularity", "report_level", "offense_code"]
# The arrest marks table: grid key, stored month range ("MM-YYYY" text),
# failure counter and run times.
ARREST_MARKS_DDL = ("function STRING, report_granularity STRING, report_level STRING, offense_code INT, "
                    "first_date STRING, last_date STRING, consecutive_api_failures INT, "
                    "last_successful_run TIMESTAMP_NTZ, last_attempted_run TIMESTAMP_NTZ, "
                    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ")


# J5 + H9
def arrest_grid(spark, codes, states: DataFrame, oris: DataFrame) -> DataFrame:
    """All (granularity, level, offense code) requests: one national level,
    every state, every agency, each with every code of the code list or
    one-column frame (a Generate per member, no cross join)."""
    from sluice.operators.explore import stack
    from sluice.operators.joins import grid
    national = spark.createDataFrame([(GRAIN_NATIONAL, NATIONAL_LEVEL)],
                                     "report_granularity STRING, report_level STRING")
    members = stack([
        national,
        states.select(F.lit(GRAIN_STATE).alias("report_granularity"), F.col(states.columns[0]).alias("report_level")),
        oris.select(F.lit(GRAIN_ORI).alias("report_granularity"), F.col(oris.columns[0]).alias("report_level")),
    ])
    return grid(members, codes, "offense_code").select(F.lit(GRID_FUNCTION).alias("function"), *GRID_KEYS[1:])
