"""Snapshots that a run replaces as a whole, by slices, or by buckets.

Every commit has a number, one more than the last one, and its entry is written
after the data; the entry of a number can be written once only, so of two
drivers that commit beside each other one fails. Readers take the greatest
number. A crash before the entry leaves the snapshot as it was, and no folder is
overwritten that a commit names.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.merge import merge

COMMIT_DDL = "version STRING, schema STRING, number INT"


def _commits(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(COMMIT_DDL).parquet(f"{root}-commits")


def last_commit(spark: SparkSession, root: str):
    """The last commit of a snapshot (number, version, schema), None if there is none."""
    try:
        commits = _commits(spark, root)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return commits.orderBy(F.desc("number")).first()


def commit(spark: SparkSession, root: str, number: int, version: str, schema: T.StructType) -> None:
    """Write the entry of a number; an error where it has one."""
    spark.createDataFrame([(version, schema.json())], "version STRING, schema STRING").coalesce(1).write.mode(
        "errorifexists").parquet(f"{root}-commits/number={number}")


# Versioned snapshots: each run writes ``<root>/version=<v>`` and commits it.
def publish(df: DataFrame, root: str, version: str) -> None:
    spark = df.sparkSession
    last = last_commit(spark, root)
    df.write.mode("overwrite").parquet(f"{root}/version={version}")
    commit(spark, root, last["number"] + 1 if last else 1, version, df.schema)


def current(spark: SparkSession, root: str) -> DataFrame:
    """The version committed last; only its folder is read."""
    return spark.read.parquet(f"{root}/version={last_commit(spark, root)['version']}")


# Partitioned snapshots (J2, K4). ``<root>/data/slice=<n>/<column>=<value>`` has the
# slices that commit ``n`` wrote, ``<root>/manifest/number=<n>`` the slice that each
# partition value has as of commit ``n``. A merge writes the slices it touches, once,
# and a manifest; slices that it does not touch keep their folders.
def _slices(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("slice", T.IntegerType())])).parquet(f"{root}/data")


def _manifest(spark: SparkSession, root: str, number: int, schema: T.StructType, by: str) -> DataFrame:
    fields = T.StructType([schema[by], T.StructField("slice", T.IntegerType()), T.StructField("number", T.IntegerType())])
    # A comparison on the number, so that a join with the manifest prunes the folders of data.
    return spark.read.schema(fields).parquet(f"{root}/manifest").where(F.col("number") == number).select(by, "slice")


def _staged(df: DataFrame, root: str, by: str, number: int) -> None:
    # AQE splits a large slice and joins small ones.
    df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(f"{root}/data/slice={number}")


def create_partitioned(df: DataFrame, root: str, by: str) -> None:
    """Write the first version of a snapshot partitioned by ``by``, which holds
    no null (see ``partitioned``)."""
    _replace(df, root, by, None, 0)


def partitioned(spark: SparkSession, root: str, by: str) -> DataFrame:
    """The snapshot as of its last commit. Only the slices its manifest names
    are read, and of them those that a filter on ``by`` leaves."""
    last = last_commit(spark, root)
    schema = T.StructType.fromJson(json.loads(last["schema"]))
    manifest = _manifest(spark, root, last["number"], schema, by)
    return _slices(spark, root, schema).join(manifest, [by, "slice"], "left_semi").select(*schema.names)


def _replace(df: DataFrame, root: str, by: str, last, slices_of: int) -> int:
    """Write ``df`` as new slices and commit a manifest in which they replace
    those of the same partition values."""
    spark = df.sparkSession
    number = slices_of + 1
    present = F.when(F.col(by).isNull(), F.raise_error(F.lit(f"null in the partition column {by}"))).otherwise(F.col(by))
    _staged(df.withColumn(by, present), root, by, number)
    new = (_slices(spark, root, df.schema).where(F.col("slice") == number).select(by).distinct()
           .withColumn("slice", F.lit(number)))
    if last is not None:
        new = _manifest(spark, root, slices_of, df.schema, by).join(new, by, "left_anti").unionByName(new)
    new.write.mode("overwrite").parquet(f"{root}/manifest/number={number}")
    commit(spark, root, number, str(number), df.schema)
    return number


def replace_partitions(df: DataFrame, root: str, by: str) -> int:
    """Replace the partitions present in ``df`` (K4); the others stay. The
    snapshot may be read by ``df`` itself: no slice it reads is written."""
    last = last_commit(df.sparkSession, root)
    schema = T.StructType.fromJson(json.loads(last["schema"]))
    return _replace(df.select(*schema.names), root, by, last, last["number"])


def merge_partitioned(root: str, source: DataFrame, keys, by: str, **merge_kwargs) -> int:
    """MERGE ``source`` into a snapshot partitioned by ``by``, a key column (so
    a row never changes its partition). The source is written once; its
    partition values prune the folders of the snapshot at run time, and the
    merged slices are written once. Returns the number of the commit."""
    if by not in keys:
        raise ValueError("the partition column must be part of the merge key")
    spark = source.sparkSession
    last = last_commit(spark, root)
    number = last["number"] + 1
    source.write.mode("overwrite").parquet(f"{root}/sources/number={number}")
    fields = T.StructType([*source.schema.fields, T.StructField("number", T.IntegerType())])
    staged = spark.read.schema(fields).parquet(f"{root}/sources").where(F.col("number") == number).drop("number")
    if staged.isEmpty():
        return last["number"]
    return replace_partitions(merge(touched_slices(spark, root, staged, by), staged, keys, **merge_kwargs), root, by)


def touched_slices(spark: SparkSession, root: str, source: DataFrame, by: str) -> DataFrame:
    """The rows of the snapshot whose partition value the source has: a semi
    join on the partition column, which Spark turns into a pruning of folders."""
    return partitioned(spark, root, by).join(source.select(by).distinct(), by, "left_semi")


# Bucketed snapshots (J2): a table bucketed by the merge key, so that a merge
# moves the delta alone. The bucket count follows from the bytes.
TARGET_PROPERTY = "sluice.bucket_bytes"
BUCKET_BYTES = 256 << 20


def bytes_at(spark: SparkSession, path: str) -> int:
    """Bytes of the parquet files below a path, by listing them."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("length"))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def buckets_for(size: int, target: int) -> int:
    """A power of two, so that buckets of one count are whole parts of another's."""
    return 1 << max(0, -(-size // target) - 1).bit_length()


def bucket_state(spark: SparkSession, name: str) -> tuple[int, int, str]:
    """Bucket count, bytes wanted in a bucket, and place of a table."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    target = spark.sql(f"SHOW TBLPROPERTIES {name} ('{TARGET_PROPERTY}')").first()["value"]
    return int(about["Num Buckets"]), int(target), about["Location"]


def write_bucketed(df: DataFrame, name: str, keys, path: str, size: int, target: int = BUCKET_BYTES) -> None:
    """Store a snapshot as a table bucketed and sorted by its key: ``size``
    bytes in buckets of about ``target``, which the table keeps as a property."""
    (df.write.mode("overwrite").bucketBy(buckets_for(size, target), *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{TARGET_PROPERTY}' = '{target}')")


def merge_bucketed(spark: SparkSession, now: str, source: DataFrame, keys, next_name: str, next_path: str,
                   prepare: Callable[[DataFrame], DataFrame] = lambda s: s, **merge_kwargs) -> DataFrame:
    """MERGE ``source`` into the bucketed snapshot table ``now`` and store the
    result as the next version ``next_name`` (never over the table being read).
    The target is read bucket by bucket with no shuffle; the source is hashed
    once into the same buckets, and ``prepare`` (such as latest row by key)
    works on it there. When the buckets of ``now`` have outgrown their target
    twofold, the next version has as many as its bytes ask for. Returns the
    new table."""
    buckets, target, place = bucket_state(spark, now)
    size = bytes_at(spark, place)
    grown = size > 2 * buckets * target
    merged = merged_buckets(spark, now, source, keys, buckets, prepare, **merge_kwargs)
    write_bucketed(merged, next_name, keys, next_path, size if grown else buckets * target, target)
    return spark.table(next_name)


def merged_buckets(spark: SparkSession, now: str, source: DataFrame, keys, buckets: int, prepare, **merge_kwargs) -> DataFrame:
    table = spark.table(now)
    return merge(table, prepare(source.repartition(buckets, *keys)), keys, **merge_kwargs).select(*table.columns)
