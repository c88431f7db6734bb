"""Economic series: landed CSV -> raw -> latest-wins -> unconditional upsert
(S1, S4-S7, F1-F3, W1, J1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.scalars import run_ts as _run_ts, try_date, try_timestamp
from sluice.operators.dedupe import latest_wins
from sluice.operators.merge import merge
from sluice.plans.highwater import CSV_COLUMNS
from sluice.sources.landing import scan_csv

KEYS = ["series_id", "observation_date"]
VALUE_COLS = ["value", "title", "frequency", "units", "extracted_at", "source_file", "loaded_at"]
CURATED_COLS = KEYS + VALUE_COLS + ["updated_at"]


def load(spark: SparkSession, landing_root: str, run_ts: str) -> DataFrame:
    """Every ``*.csv`` under the landing root, by position; a malformed
    record aborts the load (as the series runbook does)."""
    return scan_csv(spark, landing_root, CSV_COLUMNS, pattern="*.csv", on_error="abort",
                    loaded_at=run_ts,
                    types={"observation_date": try_date, "value": "double", "extracted_at": try_timestamp})


def curate(target: DataFrame, raw: DataFrame, run_ts: str) -> DataFrame:
    now = _run_ts(run_ts)
    src = latest_wins(raw, KEYS, [F.col("extracted_at").desc_nulls_last(),
                                  F.col("loaded_at").desc_nulls_last()])
    return merge(target.select(*CURATED_COLS), src, KEYS,
                 set_update={**{c: F.col(f"s.{c}") for c in VALUE_COLS}, "updated_at": now},
                 set_insert={"updated_at": now})          # null keys inserted, as SQL MERGE does
