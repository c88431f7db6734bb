"""Load -> type -> dedupe -> upsert -> verify for keyed monthly facts.

This is the curated-snapshot flow of the state-level arrest counts: raw rows
carry text dates and extract times; the curated table is keyed by
(state, offense_code, observation_date) and only updated when the value or
the extract time changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.predicates import require
from sluice.functions.scalars import run_ts as _run_ts, try_date, try_int, try_instant_ntz
from sluice.operators.aggregate import coverage
from sluice.operators.dedupe import latest_wins
from sluice.operators.merge import merge

KEYS = ["state", "offense_code", "observation_date"]
CURATED_COLS = ["state", "offense_code", "observation_date", "value", "extracted_at",
                "source_file", "loaded_at", "updated_at"]


def type_raw(raw: DataFrame) -> DataFrame:
    """Tolerant typing of the raw landing columns."""
    return raw.select(
        F.col("state"), try_int("offense_code").alias("offense_code"),
        try_date("observation_date").alias("observation_date"),
        F.col("value").try_cast("double").alias("value"),
        try_instant_ntz("extracted_at").alias("extracted_at"),
        F.col("source_file"), F.col("loaded_at"))


def typed_source(raw: DataFrame) -> DataFrame:
    """Raw rows with a complete parsed key."""
    return require(type_raw(raw), KEYS)


def latest_rows(typed: DataFrame) -> DataFrame:
    """The last extract of each key."""
    return latest_wins(typed, KEYS, [F.col("extracted_at").desc_nulls_last(),
                                     F.col("loaded_at").desc_nulls_last()])


def latest_source(raw: DataFrame) -> DataFrame:
    """P3 + W1: the merge source, unique on the parsed key."""
    return latest_rows(typed_source(raw))


def curate(target: DataFrame, raw: DataFrame, run_ts: str) -> DataFrame:
    """Next curated snapshot (update only when value/extract time changed;
    inserts stamp load and update time with the run time)."""
    now = _run_ts(run_ts)
    src = latest_source(raw).drop("loaded_at")
    return merge(target.select(*CURATED_COLS), src, KEYS,
                 set_update={"value": F.col("s.value"), "extracted_at": F.col("s.extracted_at"),
                             "source_file": F.col("s.source_file"), "updated_at": now},
                 set_insert={"loaded_at": now, "updated_at": now},
                 update_when=["value", "extracted_at"], null_keys="drop",
                 # Curated keys are NOT NULL (checked by V8) and the source is
                 # filtered by require(): keep the dedupe's key partitioning.
                 spread_nulls=False)


def initial_snapshot(raw: DataFrame, loaded_at_col: str = "loaded_at") -> DataFrame:
    """First curated snapshot built from a raw batch (load time = update time)."""
    src = latest_source(raw)
    return src.select(*KEYS, "value", "extracted_at", "source_file", "loaded_at",
                      F.col(loaded_at_col).alias("updated_at"))


def verify(curated: DataFrame) -> DataFrame:
    """V6: distinct offense codes, month range and rows per state."""
    return coverage(curated, "state", "observation_date", distinct="offense_code",
                    names={"distinct": "offense_codes", "first": "earliest_month",
                           "last": "latest_month", "rows": "total_rows"})


# --- National level of the unified arrests table ---------------------------------

UNIFIED_KEYS = ["geography_level", "geography_value", "offense_code", "observation_date"]
UNIFIED_COLS = UNIFIED_KEYS + ["value", "rate", "population", "extracted_at", "source_file",
                               "loaded_at", "updated_at"]
# The pinned geography of national rows.
NATIONAL_LEVEL = "NATIONAL"
NATIONAL_VALUE = "National"


def national_source(raw: DataFrame) -> DataFrame:
    """P1 + P2 + P3 + W1: typed national rows pinned to the national level,
    required keys checked on the typed columns, latest extract per key."""
    def g(path, typ="string"):
        return F.try_variant_get("raw_data", f"$.{path}", typ)
    typed = raw.select(
        F.lit(NATIONAL_LEVEL).alias("geography_level"), F.lit(NATIONAL_VALUE).alias("geography_value"),
        g("offense_code", "int").alias("offense_code"),
        try_date(g("observation_date")).alias("observation_date"),
        g("value").try_cast("double").alias("value"), g("rate").try_cast("double").alias("rate"),
        g("population", "bigint").alias("population"),
        try_instant_ntz(g("extracted_at")).alias("extracted_at"), "source_file", "loaded_at")
    typed = require(typed, ["offense_code", "observation_date"])
    return latest_wins(typed, UNIFIED_KEYS, [F.col("extracted_at").desc_nulls_last(),
                                             F.col("loaded_at").desc_nulls_last()])


def curate_national(target: DataFrame, raw: DataFrame, run_ts: str) -> DataFrame:
    """J2 into the unified table: update when value, rate, population or
    extract time changed; other levels of the table are left as they are."""
    now = _run_ts(run_ts)
    changed = ["value", "rate", "population", "extracted_at"]
    return merge(target.select(*UNIFIED_COLS), national_source(raw), UNIFIED_KEYS,
                 set_update={**{c: F.col(f"s.{c}") for c in changed + ["source_file", "loaded_at"]},
                             "updated_at": now},
                 set_insert={"updated_at": now}, update_when=changed, null_keys="drop",
                 spread_nulls=False)


def verify_national(unified: DataFrame) -> DataFrame:
    """V4: months and range per offense at the national level (P5 + A2)."""
    nat = unified.where(F.col("geography_level") == NATIONAL_LEVEL)
    return coverage(nat, ["geography_level", "offense_code"], "observation_date",
                    names={"rows": "month_count", "first": "earliest_month", "last": "latest_month"})
