"""Run parameters: optional filters and parameterised SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.predicates import between, optional_eq  # noqa: F401  (P12, P9)


# Fixed value: the member keyword that keeps every member.
ALL_MEMBERS = "ALL"


# P10
def select_member(df: DataFrame, col: str, value: str | None, members) -> DataFrame:
    """``ALL``/empty keeps every member; otherwise exactly one known member
    (upper-cased); an unknown member is an error before the filtered job runs.
    ``members`` is a list or a one-column dimension DataFrame."""
    if value is None or value.strip() == "" or value.strip().upper() == ALL_MEMBERS:
        return df
    v = value.strip().upper()
    if isinstance(members, DataFrame):
        known = not members.where(F.upper(F.col(members.columns[0]).cast("string")) == v).isEmpty()
    else:
        known = v in {str(m).upper() for m in members}
    if not known:
        raise ValueError(f"unknown member {value!r}")
    return df.where(F.upper(F.col(col)) == F.lit(v))


# P11
def run_sql(spark: SparkSession, text: str, params: dict | None = None) -> DataFrame:
    """Parameterised SQL: identifiers via ``IDENTIFIER(:name)``, values as
    named parameters; an optional clause is written ``(:p IS NULL OR ...)``
    and an empty parameter is passed as null."""
    args = {k: (None if v == "" else v) for k, v in (params or {}).items()}
    return spark.sql(text, args=args)
