"""End-to-end agency directory run: suppliers packed as per-state agency
payloads, flattened, landed per state folder as NDJSON, scanned to VARIANT,
typed, deduplicated and upserted into the previous curated directory."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.scalars import run_ts
from sluice.operators.explore import stack
from sluice.operators.reshape import flatten_agencies
from sluice.plans import agencies
from sluice.session import scratch_path
from sluice.sources import sinks
from sluice.sources.landing import scan_ndjson_variant
from sluice.suite import case
from sluice.suite.common import OLD_SQL, OLD_TS, RUN_SQL, RUN_TS, t

# Fixed values of the fixture: two extracts (the second re-extracts the
# agencies with a balance above 5000, names upper-cased) and a seed time.
EXTRACT_1 = "2024-01-01 00:00:00"
EXTRACT_2 = "2024-01-15 00:00:00"
SEED_EXTRACT = "2023-12-01 00:00:00"
# The previous run was started with a state filter (P10) covering these states.
PREVIOUS_STATES = ["AFRICA", "AMERICA", "ASIA"]
PAGE = 64


def suppliers(spark, sf_dir):
    s = t(spark, sf_dir, "supplier")
    n = t(spark, sf_dir, "nation")
    r = t(spark, sf_dir, "region")
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select("s_suppkey", "s_name", "s_acctbal", "n_name", "r_name", "r_regionkey"))


def _record(name_col):
    bal = F.col("s_acctbal")
    return F.struct(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ori"),
        name_col.alias("agency_name"),
        F.when(bal >= 0, F.lit("City")).otherwise(F.lit("County")).alias("agency_type_name"),
        F.lower("r_name").alias("state_name"),
        F.lit("overwritten").alias("county_name"),
        (bal > 1000).alias("is_nibrs"),
        F.when(bal > 1000, F.lit("2021-01-15")).otherwise(F.lit("unknown")).alias("nibrs_start_date"),
        (bal / F.lit(100.0)).cast("string").alias("latitude"),
        F.when(bal >= 0, (bal / F.lit(-50.0)).cast("string")).alias("longitude"))


def payloads(sup, name_col, extracted_at):
    """``{county: [agency...]}`` per (state, page of at most 64 agencies)."""
    per_county = (sup.groupBy("r_name", F.floor(F.col("s_suppkey") / PAGE).alias("page"), "n_name")
                  .agg(F.collect_list(_record(name_col)).alias("items")))
    per_page = (per_county.groupBy("r_name", "page")
                .agg(F.map_from_entries(F.collect_list(F.struct("n_name", "items"))).alias("m")))
    return per_page.select(F.col("r_name").alias("state"), F.lit(extracted_at).alias("extracted_at"),
                           F.to_json("m").alias("payload"))


RECORD_SCHEMA = ("ori STRING, agency_name STRING, agency_type_name STRING, state_name STRING, "
                 "county_name STRING, is_nibrs BOOLEAN, nibrs_start_date STRING, latitude STRING, "
                 "longitude STRING")


def previous_directory(sup):
    old = run_ts(OLD_TS)
    seed = F.lit(SEED_EXTRACT).cast("timestamp_ntz")
    bal = F.col("s_acctbal")

    def rows(prefix, name):
        return sup.select(
            F.concat(F.lit(prefix), F.col("s_suppkey").cast("string")).alias("ori"),
            name.alias("agency_name"), F.lit("City").alias("agency_type_name"),
            F.col("r_name").alias("state_abbr"), F.lower("r_name").alias("state_name"),
            F.col("n_name").alias("county_name"), F.lit(False).alias("is_nibrs"),
            F.lit(None).cast("date").alias("nibrs_start_date"), (bal / F.lit(100.0)).alias("latitude"),
            F.lit(None).cast("double").alias("longitude"), seed.alias("extracted_at"),
            F.lit("seed").alias("source_file"), old.alias("loaded_at"), old.alias("updated_at"))
    return stack([rows("S", F.col("s_name")).where(F.col("r_name").isin(PREVIOUS_STATES)),
                  rows("R", F.concat(F.lit("retired "), F.col("s_name"))).where(bal < 0)])


def raw_agencies(spark, sf_dir, sup):
    """The landed extracts as the raw table, which every load replaces (K5)."""
    root = scratch_path(spark, "agencies")
    first = payloads(sup, F.col("s_name"), EXTRACT_1)
    second = payloads(sup.where(F.col("s_acctbal") > 5000), F.upper("s_name"), EXTRACT_2)
    table = f"{root}-raw"
    for batch in (first, second):
        flat = flatten_agencies(batch, "payload", RECORD_SCHEMA, keep=["state", "extracted_at"])
        flat = flat.withColumnRenamed("state", "state_abbr")
        # K2: one folder per state; append keeps both extracts (forced reload).
        sinks.write_ndjson(flat.withColumn("state", F.col("state_abbr")), root, by="state", mode="append")
        sinks.land(scan_ndjson_variant(spark, root, pattern="*.json", loaded_at=RUN_TS), table, mode="overwrite")
    return spark.read.parquet(table)


def curated_directory(spark, sf_dir):
    sup = suppliers(spark, sf_dir)
    return agencies.curate(previous_directory(sup), raw_agencies(spark, sf_dir, sup), RUN_TS)


DIRECTORY_SQL = f"""
WITH sup AS (SELECT s.s_suppkey, s.s_name, s.s_acctbal, n.n_name, r.r_name, r.r_regionkey
             FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
             JOIN region r ON n.n_regionkey = r.r_regionkey),
     src AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ori,
                    CASE WHEN s_acctbal > 5000 THEN upper(s_name) ELSE s_name END AS agency_name,
                    CASE WHEN s_acctbal >= 0 THEN 'City' ELSE 'County' END AS agency_type_name,
                    r_name AS state_abbr, lower(r_name) AS state_name, n_name AS county_name,
                    s_acctbal > 1000 AS is_nibrs,
                    CASE WHEN s_acctbal > 1000 THEN DATE '2021-01-15' END AS nibrs_start_date,
                    s_acctbal / CAST(100 AS DOUBLE) AS latitude,
                    CASE WHEN s_acctbal >= 0 THEN s_acctbal / CAST(-50 AS DOUBLE) END AS longitude,
                    CASE WHEN s_acctbal > 5000 THEN TIMESTAMP '{EXTRACT_2}' ELSE TIMESTAMP '{EXTRACT_1}' END AS extracted_at,
                    true AS from_state_folder, {RUN_SQL} AS loaded_at, {RUN_SQL} AS updated_at
             FROM sup),
     retired AS (SELECT 'R' || CAST(s_suppkey AS VARCHAR) AS ori, 'retired ' || s_name AS agency_name,
                        'City' AS agency_type_name, r_name AS state_abbr, lower(r_name) AS state_name,
                        n_name AS county_name, false AS is_nibrs, CAST(NULL AS DATE) AS nibrs_start_date,
                        s_acctbal / CAST(100 AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
                        TIMESTAMP '{SEED_EXTRACT}' AS extracted_at, false AS from_state_folder,
                        {OLD_SQL} AS loaded_at, {OLD_SQL} AS updated_at
                 FROM sup WHERE s_acctbal < 0),
     directory AS (SELECT * FROM src UNION ALL SELECT * FROM retired)
"""


def _compared(df):
    return df.withColumn("from_state_folder", F.col("source_file").contains("state=")).drop("source_file")


@case("curated_agencies", DIRECTORY_SQL + "SELECT * FROM directory")
def curated_agencies(spark, sf_dir):
    return _compared(curated_directory(spark, sf_dir))


@case("curated_agencies_verify", DIRECTORY_SQL +
      "SELECT state_abbr, count(*) AS agency_count FROM directory GROUP BY state_abbr")
def curated_agencies_verify(spark, sf_dir):
    return agencies.verify(curated_directory(spark, sf_dir))


@case("agencies_raw_verify", """
SELECT r.r_name AS state_abbr, count(*) + count(*) FILTER (WHERE s.s_acctbal > 5000) AS agency_count
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1""")
def agencies_raw_verify(spark, sf_dir):
    """V1: agencies by state in the raw load, by path extraction."""
    from sluice.operators.aggregate import group_count
    raw = raw_agencies(spark, sf_dir, suppliers(spark, sf_dir))
    return group_count(raw.select(F.try_variant_get("raw_data", "$.state_abbr", "string").alias("state_abbr")),
                       "state_abbr", "agency_count")


# --- National arrests into the unified table (R2 + lookups, K3, S2, P1-P3, W1, J2, U4, V4)

NAT_E0 = "2023-06-01 00:00:00"
NAT_E1 = "2024-01-01 00:00:00"
NAT_E2 = "2024-01-20 00:00:00"


GRAINS = {"NATIONAL": ["offense_code", "month"], "STATE": ["flag", "offense_code", "month"],
          "ANNUAL": ["offense_code", "data_year"]}


def grain_sums(spark, sf_dir):
    """Monthly sums of both geography levels and annual ones, from one scan of
    lineitem; written, since several steps of a run use them."""
    from sluice.operators.aggregate import grain_totals
    from sluice.session import materialize
    li = t(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_linenumber").alias("offense_code"),
        F.trunc("l_shipdate", "month").alias("month"), F.year("l_shipdate").alias("data_year"), "l_quantity",
        F.col("l_discount").cast("decimal(18,2)").alias("l_discount"))
    return materialize(grain_totals(li, GRAINS, {"v": F.col("l_quantity"), "r": F.col("l_discount"), "p": F.lit(1)}))


@case("grain_totals", """
SELECT 'NATIONAL' AS level, CAST(NULL AS VARCHAR) AS flag, l_linenumber AS offense_code,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(NULL AS INTEGER) AS data_year,
       sum(l_quantity) AS v, count(*) AS p FROM lineitem GROUP BY ALL
UNION ALL SELECT 'STATE', l_returnflag, l_linenumber, CAST(date_trunc('month', l_shipdate) AS DATE), NULL,
       sum(l_quantity), count(*) FROM lineitem GROUP BY ALL
UNION ALL SELECT 'ANNUAL', NULL, l_linenumber, NULL, CAST(year(l_shipdate) AS INTEGER), sum(l_quantity), count(*)
FROM lineitem GROUP BY ALL""")
def grain_totals_q(spark, sf_dir):
    """U4 + R3: national, state and annual rows by GROUPING SETS."""
    return grain_sums(spark, sf_dir).drop("r")


def national_payloads(monthly, extracted_at: str):
    """One payload per offense code: ``{"actuals": {label: {MM-YYYY: v}},
    "rates": {..}, "population": {..}}`` (months bound the map size)."""
    label = F.concat(F.col("offense_code").cast("string"), F.lit(" Arrests"))
    per = monthly.groupBy("offense_code").agg(
        F.map_from_entries(F.collect_list(F.struct("mt", "v"))).alias("mv"),
        F.map_from_entries(F.collect_list(F.struct("mt", "r"))).alias("mr"),
        F.map_from_entries(F.collect_list(F.struct("mt", "p"))).alias("mp"))
    bad = F.create_map(F.lit("13-2020"), F.lit(1.0))
    doc = F.struct(F.create_map(label, F.map_concat("mv", bad)).alias("actuals"),
                   F.create_map(label, F.col("mr")).alias("rates"),
                   F.create_map(label, F.col("mp")).alias("population"))
    return per.select("offense_code", F.lit(extracted_at).alias("extracted_at"), F.to_json(doc).alias("payload"))


def raw_national(spark, monthly):
    """The landed national extracts: a first one, and one of the revised period."""
    from sluice.operators.reshape import monthly_long
    from sluice.functions.scalars import date_text
    root = scratch_path(spark, "arrests_national")
    first = national_payloads(monthly, NAT_E1)
    recent = monthly.where(F.col("yr") >= 2001).withColumn("v", F.col("v") + 1)   # revised period
    second = national_payloads(recent, NAT_E2)
    for batch in (first, second):
        rows = monthly_long(batch, "payload", "actuals", keep=["offense_code", "extracted_at"],
                            lookups={"rate": "rates", "population": "population"})
        landed = rows.select("offense_code", date_text("observation_date").alias("observation_date"),
                             "value", "rate", "population", "extracted_at")
        sinks.write_ndjson(landed, root, mode="append")          # K3: one output set per run
    return scan_ndjson_variant(spark, root, pattern="*.json", loaded_at=RUN_TS)


def national_months(sums):
    return sums.where(F.col("level") == "NATIONAL").select(
        "offense_code", F.date_format("month", "MM-yyyy").alias("mt"), F.year("month").alias("yr"), "month", "v",
        F.col("r").cast("double").alias("r"), "p")


def unified_arrests(spark, sf_dir):
    sums = grain_sums(spark, sf_dir)
    monthly = national_months(sums)
    raw = raw_national(spark, monthly)
    from sluice.operators.quality import assert_not_empty
    assert_not_empty(raw, "national arrest extraction")     # fail when nothing was collected

    old = run_ts(OLD_TS)
    seeded = [F.lit("seed").alias("source_file"), old.alias("loaded_at"), old.alias("updated_at")]
    state = sums.where(F.col("level") == "STATE").select(
        F.lit("STATE").alias("geography_level"), F.col("flag").alias("geography_value"), "offense_code",
        F.col("month").alias("observation_date"), F.col("v").alias("value"), F.lit(None).cast("double").alias("rate"),
        F.col("p").alias("population"), F.lit(NAT_E0).cast("timestamp_ntz").alias("extracted_at"), *seeded)
    national = monthly.select(
        F.lit("NATIONAL").alias("geography_level"), F.lit("National").alias("geography_value"), "offense_code",
        F.col("month").alias("observation_date"),
        F.col("v").alias("value"), F.col("r").alias("rate"), F.col("p").alias("population"),
        F.lit(NAT_E1).cast("timestamp_ntz").alias("extracted_at"), *seeded)
    target = stack([state, national])            # U4: one table, two geography levels
    from sluice.plans.runbook import curate_national
    return curate_national(target, raw, RUN_TS)


UNIFIED_SQL = f"""
WITH m AS (SELECT l_linenumber AS offense_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS observation_date,
                  sum(l_quantity) AS value, CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS rate,
                  count(*) AS population
           FROM lineitem GROUP BY 1, 2),
     nat AS (SELECT 'NATIONAL' AS geography_level, 'National' AS geography_value, offense_code, observation_date,
                    CASE WHEN year(observation_date) >= 2001 THEN value + 1 ELSE value END AS value, rate, population,
                    CASE WHEN year(observation_date) >= 2001 THEN TIMESTAMP '{NAT_E2}' ELSE TIMESTAMP '{NAT_E1}' END AS extracted_at,
                    year(observation_date) >= 2001 AS from_landing,
                    CASE WHEN year(observation_date) >= 2001 THEN {RUN_SQL} ELSE {OLD_SQL} END AS loaded_at,
                    CASE WHEN year(observation_date) >= 2001 THEN {RUN_SQL} ELSE {OLD_SQL} END AS updated_at
             FROM m),
     st AS (SELECT 'STATE' AS geography_level, l_returnflag AS geography_value, l_linenumber AS offense_code,
                   CAST(date_trunc('month', l_shipdate) AS DATE) AS observation_date, sum(l_quantity) AS value,
                   CAST(NULL AS DOUBLE) AS rate, count(*) AS population, TIMESTAMP '{NAT_E0}' AS extracted_at,
                   false AS from_landing, {OLD_SQL} AS loaded_at, {OLD_SQL} AS updated_at
            FROM lineitem GROUP BY 1, 2, 3, 4),
     unified AS (SELECT * FROM nat UNION ALL SELECT * FROM st)
"""


def _landing_flag(df):
    return df.withColumn("from_landing", F.col("source_file").endswith(".json")).drop("source_file")


@case("unified_arrests", UNIFIED_SQL + "SELECT * FROM unified")
def unified_arrests_q(spark, sf_dir):
    return _landing_flag(unified_arrests(spark, sf_dir))


@case("national_verify", UNIFIED_SQL + """
SELECT geography_level, offense_code, count(*) AS month_count, min(observation_date) AS earliest_month,
       max(observation_date) AS latest_month
FROM unified WHERE geography_level = 'NATIONAL' GROUP BY 1, 2""")
def national_verify(spark, sf_dir):
    from sluice.plans.runbook import verify_national
    return verify_national(unified_arrests(spark, sf_dir))


@case("national_raw_verify", """
WITH m AS (SELECT DISTINCT l_linenumber AS offense_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS d FROM lineitem)
SELECT offense_code, count(*) + 1 + count(*) FILTER (year(d) >= 2001) + CAST(max(year(d)) >= 2001 AS INTEGER) AS row_count,
       min(d) AS earliest_month, max(d) AS latest_month
FROM m GROUP BY 1""")
def national_raw_verify(spark, sf_dir):
    """V3: rows and months by offense code in the raw national load, whose rows
    hold months of two extracts and a label that is no month."""
    from sluice.functions.scalars import try_date
    from sluice.operators.aggregate import coverage
    raw = raw_national(spark, national_months(grain_sums(spark, sf_dir)))
    typed = raw.select(F.try_variant_get("raw_data", "$.offense_code", "int").alias("offense_code"),
                       try_date(F.try_variant_get("raw_data", "$.observation_date", "string")).alias("d"))
    return coverage(typed, "offense_code", "d", names={"first": "earliest_month", "last": "latest_month", "rows": "row_count"})


# --- State extraction run (S10, P10, R2, U1, K3, S3, V5) ------------------------------

STATE_EXTRACTED = "2024-02-01T00:00:00+00:00"


def state_payloads(spark, sf_dir):
    """One landed response per (state, offense code) request of the state grid."""
    li = t(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    sup = t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nat = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    monthly = (li.join(sup, "l_suppkey").join(nat, "s_nationkey")
               .groupBy(F.col("n_name").alias("state"), F.col("l_linenumber").alias("offense_code"),
                        F.date_format("l_shipdate", "MM-yyyy").alias("mt"))
               .agg(F.sum("l_quantity").alias("v")))
    label = F.concat(F.col("offense_code").cast("string"), F.lit(" Arrests"))
    per = monthly.groupBy("state", "offense_code").agg(F.map_from_entries(F.collect_list(F.struct("mt", "v"))).alias("m"))
    # A label that is no month, and a month without a count: both are rejects.
    bad = F.create_map(F.lit("bad"), F.lit(0.0), F.lit("01-1950"), F.lit(None).cast("double"))
    return per.select("state", "offense_code",
                      F.to_json(F.struct(F.create_map(label, F.map_concat("m", bad)).alias("actuals"))).alias("payload"))


def state_extraction(spark, sf_dir, member: str = "ALL"):
    from sluice.functions.scalars import date_text
    from sluice.operators.quality import assert_not_empty
    from sluice.operators.reshape import monthly_long, split_rejects
    from sluice.plans.params import select_member
    from sluice.sources.landing import scan_ndjson_typed
    root = scratch_path(spark, "state_extraction")
    path = f"{root}/responses"
    state_payloads(spark, sf_dir).write.parquet(path)                       # landed responses (S10)
    responses = select_member(spark.read.parquet(path), "state", member,
                              t(spark, sf_dir, "nation").select("n_name"))   # P10 state filter
    rows = monthly_long(responses, "payload", "actuals", keep=["state", "offense_code"])
    good, _rejects = split_rejects(rows, ["observation_date", "value"])
    out = good.select("state", date_text("observation_date").alias("observation_date"), "value",
                      "offense_code", F.lit(STATE_EXTRACTED).alias("extracted_at"))
    sinks.write_ndjson(assert_not_empty(out, "state extraction"), f"{root}/landing")   # K3
    schema = "state STRING, observation_date STRING, value DOUBLE, offense_code INT, extracted_at STRING"
    return scan_ndjson_typed(spark, f"{root}/landing", schema, pattern="*.json", loaded_at=RUN_TS)  # S3


STATE_RAW_SQL = f"""
WITH raw AS (SELECT n.n_name AS state, strftime(date_trunc('month', l.l_shipdate), '%Y-%m-%d') AS observation_date,
                    sum(l.l_quantity) AS value, l.l_linenumber AS offense_code, '{STATE_EXTRACTED}' AS extracted_at
             FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
             GROUP BY n.n_name, 2, l.l_linenumber)
"""


@case("state_extraction", STATE_RAW_SQL + f"SELECT *, {RUN_SQL} AS loaded_at FROM raw")
def state_extraction_q(spark, sf_dir):
    return state_extraction(spark, sf_dir).drop("source_file")


@case("state_raw_verify", STATE_RAW_SQL + """
SELECT state, count(DISTINCT offense_code) AS offense_codes, min(CAST(observation_date AS DATE)) AS earliest_month,
       max(CAST(observation_date AS DATE)) AS latest_month, count(*) AS total_rows
FROM raw GROUP BY state""")
def state_raw_verify(spark, sf_dir):
    """V5: raw load verification with tolerantly parsed dates."""
    from sluice.functions.scalars import try_date
    from sluice.operators.aggregate import coverage
    raw = state_extraction(spark, sf_dir).withColumn("observation_date", try_date("observation_date"))
    return coverage(raw, "state", "observation_date", distinct="offense_code",
                    names={"distinct": "offense_codes", "first": "earliest_month", "last": "latest_month",
                           "rows": "total_rows"})
