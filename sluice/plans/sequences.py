"""Surrogate ids from ranges claimed in a ledger.

A claim is a numbered commit that can be written once; its range follows that of
the claim before. Of two writers that claim beside each other one finds the
number taken and claims the next. A run that dies after its claim leaves a gap
and no id is given twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.explore import assign_ids

CLAIM_DDL = "first_id BIGINT, last_id BIGINT, number INT"
TRIES = 20


def last_claim(spark: SparkSession, ledger: str):
    try:
        return spark.read.schema(CLAIM_DDL).parquet(ledger).orderBy(F.desc("number")).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def claim(spark: SparkSession, ledger: str, count: int, after: int = 0) -> int:
    """Claim ``count`` ids above ``after`` and all those claimed; the first of them."""
    for _ in range(TRIES):
        last = last_claim(spark, ledger)
        first = max(after, last["last_id"] if last else 0) + 1
        entry = spark.createDataFrame([(first, first + count - 1)], "first_id BIGINT, last_id BIGINT").coalesce(1)
        try:
            entry.write.mode("errorifexists").parquet(f"{ledger}/number={last['number'] + 1 if last else 1}")
            return first
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
    raise RuntimeError(f"{ledger}: no claim in {TRIES} tries")


def seed_members(target: DataFrame, source: DataFrame, key: str, id_name: str, set_insert: dict,
                 ledger: str | None = None) -> DataFrame:
    """The target with the members of ``source`` it lacks, each once, null ones
    left out, with consecutive ids in the order of the key: from a claimed range
    where there is a ledger, else after the greatest id of the target."""
    spark = target.sparkSession
    new = (source.where(F.col(key).isNotNull()).select(key).distinct()
           .join(target.select(key), key, "left_anti"))
    greatest = target.agg(F.coalesce(F.max(id_name), F.lit(0))).first()[0]
    if ledger:
        count = new.count()
        if not count:
            return target
        greatest = claim(spark, ledger, count, greatest) - 1
    inserted = assign_ids(new, key, greatest, id_name)
    out = [set_insert[c].alias(c) if c in set_insert else F.col(c) for c in target.columns]
    return target.unionByName(inserted.select(*out))
