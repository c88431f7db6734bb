"""Agency directory: payloads -> landed NDJSON -> typed -> latest-wins ->
unconditional upsert -> per-state counts (R1, K2, S2, P1, W1, J1, V2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.scalars import run_ts as _run_ts, try_date, try_double, try_instant_ntz
from sluice.operators.aggregate import group_count
from sluice.operators.dedupe import latest_wins
from sluice.operators.merge import merge

VALUE_COLS = ["agency_name", "agency_type_name", "state_abbr", "state_name", "county_name",
              "is_nibrs", "nibrs_start_date", "latitude", "longitude", "extracted_at",
              "source_file", "loaded_at"]
CURATED_COLS = ["ori"] + VALUE_COLS + ["updated_at"]


def typed(raw: DataFrame) -> DataFrame:
    """Path extraction with tolerant casts from the VARIANT document."""
    def g(path, typ="string"):
        return F.try_variant_get("raw_data", f"$.{path}", typ)
    return raw.select(
        g("ori").alias("ori"), g("agency_name").alias("agency_name"),
        g("agency_type_name").alias("agency_type_name"), g("state_abbr").alias("state_abbr"),
        g("state_name").alias("state_name"), g("county_name").alias("county_name"),
        g("is_nibrs", "boolean").alias("is_nibrs"),
        try_date(g("nibrs_start_date")).alias("nibrs_start_date"),
        try_double(g("latitude")).alias("latitude"), try_double(g("longitude")).alias("longitude"),
        try_instant_ntz(g("extracted_at")).alias("extracted_at"), "source_file", "loaded_at")


def curate(target: DataFrame, raw: DataFrame, run_ts: str) -> DataFrame:
    """Latest extract per ORI, then update every matched agency."""
    now = _run_ts(run_ts)
    src = latest_wins(typed(raw), ["ori"], [F.col("extracted_at").desc_nulls_last(),
                                            F.col("loaded_at").desc_nulls_last()])
    return merge(target.select(*CURATED_COLS), src, ["ori"],
                 set_update={**{c: F.col(f"s.{c}") for c in VALUE_COLS}, "updated_at": now},
                 set_insert={"updated_at": now})


def verify(curated: DataFrame) -> DataFrame:
    """V2: agencies per state."""
    return group_count(curated, "state_abbr", "agency_count")
