"""Dimension seeding: states, offense codes and agency identifiers
(S9, J3, J4, W4, A5). Seeding is insert-only, so re-running it is a no-op;
new states get consecutive surrogate ids after the current maximum."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.scalars import run_ts as _run_ts
from sluice.operators.dedupe import distinct_keys
from sluice.operators.merge import merge
from sluice.plans.sequences import seed_members

# The 50 states and DC, the arrest offense codes and the
# supplemental offense codes, in the order the reference seeds them.
STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
    "DC",
]
ARREST_OFFENSE_CODES = [
    310, 110, 50, 60, 101, 330, 290, 260, 150, 158, 157, 160, 159, 156, 153,
    152, 155, 154, 151, 280, 200, 180, 190, 173, 171, 172, 170, 102, 70, 270,
    12, 90, 11, 250, 140, 142, 141, 143, 23, 20, 30, 240, 55, 210, 300,
    220, 230,
]
SUPPLEMENTAL_OFFENSE_CODES = ["NB", "NV", "NMVT", "NROB"]


def seed_codes(spark: SparkSession, target: DataFrame, codes, key: str, key_type: str,
               run_ts: str) -> DataFrame:
    """Insert the codes that are not in the target yet (created_at = run), each
    once. ``codes`` is a list or a one-column frame."""
    if not isinstance(codes, DataFrame):
        codes = spark.createDataFrame([(c,) for c in codes], f"{key} {key_type}")
    source = distinct_keys(codes.toDF(key), key)
    return merge(target, source, [key], set_update=None,
                 set_insert={"created_at": _run_ts(run_ts)}, null_keys="drop", spread_nulls=False)


def seed_states(spark: SparkSession, target: DataFrame, run_ts: str, states=STATES,
                ledger: str | None = None) -> DataFrame:
    """Insert missing states, each once, with surrogate ids (``sequences``).
    ``states`` is a list or a one-column frame."""
    if not isinstance(states, DataFrame):
        states = spark.createDataFrame([(s,) for s in states], "state STRING")
    return seed_members(target.select("state_id", "state", "created_at"), states.toDF("state"), "state", "state_id",
                        {"created_at": _run_ts(run_ts)}, ledger)


def seed_ori(target: DataFrame, agencies: DataFrame, run_ts: str) -> DataFrame:
    """Distinct non-null ORIs of the curated agencies: new ones inserted,
    known ones touched (updated_at = run)."""
    now = _run_ts(run_ts)
    source = distinct_keys(agencies, "ori")
    return merge(target, source, ["ori"], set_update={"updated_at": now},
                 set_insert={"created_at": now, "updated_at": now}, null_keys="drop", spread_nulls=False)
