"""Landing-file scans with provenance and a bad-record policy.

Text formats are read with an all-string schema by position; typing happens
afterwards with the ``try_`` family, so a bad value is a null, while a
malformed record (wrong shape) is governed by ``on_error``:

* ``"continue"``: skip malformed records (``DROPMALFORMED`` / null filter);
* ``"abort"``: fail the whole load (``FAILFAST`` / ``raise_error``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = {"continue": "DROPMALFORMED", "abort": "FAILFAST"}


def _reader(spark: SparkSession, pattern: str | None, recursive: bool, on_error: str):
    if on_error not in MODES:
        raise ValueError("on_error must be 'continue' or 'abort'")
    r = spark.read.option("mode", MODES[on_error])
    if pattern:
        r = r.option("pathGlobFilter", pattern)   # S5
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r


# S4
def with_provenance(df: DataFrame, loaded_at: Column | str | None = None,
                    file_col: str = "source_file", loaded_col: str = "loaded_at") -> DataFrame:
    """Add the file each row came from and the run's load time."""
    if isinstance(loaded_at, str):
        loaded_at = F.lit(loaded_at).cast(T.TimestampNTZType())
    out = df.withColumn(file_col, F.col("_metadata.file_path"))
    if loaded_at is not None:
        out = out.withColumn(loaded_col, loaded_at)
    return out


# S1
def csv_lines(spark: SparkSession, schema, pattern: str | None, recursive: bool, on_error: str, multi_line: bool,
              corrupt: str | None = None):
    """Reader of CSV with one header line, columns by position. With
    ``corrupt`` bad records stay, their text in that column."""
    r = (_reader(spark, pattern, recursive, on_error).schema(schema)
         .option("header", "true").option("enforceSchema", "true")
         .option("quote", '"').option("escape", '"').option("columnPruning", "false")
         .option("multiLine", str(multi_line).lower()))
    return r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt) if corrupt else r


def typed(columns, types: dict | None) -> list[Column]:
    """Each column cast tolerantly with ``types[name]`` (a function Column ->
    Column or a Spark type name)."""
    out = []
    for c in columns:
        kind = (types or {}).get(c)
        out.append(F.col(c) if kind is None else kind(F.col(c)).alias(c) if callable(kind)
                   else F.col(c).try_cast(kind).alias(c))
    return out


def scan_csv(spark: SparkSession, path: str, columns, *, pattern: str | None = None,
             on_error: str = "continue", recursive: bool = True,
             provenance: bool = True, loaded_at=None, types: dict | None = None,
             rebalance: bool = False, multi_line: bool = True) -> DataFrame:
    """CSV with one header line; columns taken by position (header names are
    ignored), each cast as ``typed`` says. A quote inside a quoted field is
    doubled; quoted fields may hold line breaks, so a file is read by one task;
    pass ``multi_line=False`` for large files that hold none, which are then
    split. All columns are parsed whatever is selected, so the bad-record
    policy and counts never depend on it. ``rebalance``: see ``_rebalanced``.
    ``loads.load_csv`` keeps the rejects as well."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = csv_lines(spark, schema, pattern, recursive, on_error, multi_line).csv(path)
    if provenance:
        df = with_provenance(df, loaded_at)
    return _rebalanced(df.select(typed(df.columns, types)), rebalance)


def _rebalanced(df: DataFrame, on: bool) -> DataFrame:
    """A compressed landing file cannot be split, so one task reads it whole;
    the ``rebalance`` hint lets AQE spread the rows read into partitions of
    the advisory size (splitting skewed ones) before the heavy work."""
    return df.hint("rebalance") if on else df


# S2
def scan_ndjson_variant(spark: SparkSession, path: str, *, pattern: str | None = None,
                        on_error: str = "continue", recursive: bool = True,
                        loaded_at=None, doc_col: str = "raw_data", rebalance: bool = False) -> DataFrame:
    """One VARIANT document per line (an outer array is kept as is) plus
    provenance. A line that is not JSON is skipped or aborts the load."""
    r = spark.read
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    lines = r.text(path).where(F.trim("value") != "")
    doc = F.try_parse_json("value")
    if on_error == "abort":     # in a filter: no projection prunes it
        lines = lines.where(F.when(doc.isNull(), F.raise_error(F.lit("malformed JSON line")).cast("boolean"))
                            .otherwise(F.lit(True)))
    df = lines.select(doc.alias(doc_col), F.col("_metadata.file_path").alias("source_file"))
    if loaded_at is not None:
        lit = F.lit(loaded_at).cast(T.TimestampNTZType()) if isinstance(loaded_at, str) else loaded_at
        df = df.withColumn("loaded_at", lit)
    if on_error == "continue":
        df = df.where(F.col(doc_col).isNotNull())
    return _rebalanced(df, rebalance)


# S3
def scan_ndjson_typed(spark: SparkSession, path: str, schema, *, pattern: str | None = None,
                      on_error: str = "continue", recursive: bool = False,
                      provenance: bool = True, loaded_at=None,
                      base_path: str | None = None, rebalance: bool = False) -> DataFrame:
    """NDJSON with fields extracted and cast during the load. Without
    ``recursive``, Hive-style folders (``state=XX/``) become columns (S8)."""
    r = _reader(spark, pattern, recursive, on_error).schema(schema)
    if base_path:
        r = r.option("basePath", base_path)
    df = r.json(path)
    return _rebalanced(with_provenance(df, loaded_at) if provenance else df, rebalance)


# S9
def values_df(spark: SparkSession, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# S10
def scan_payloads(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed API responses: one row per request (request keys + payload text)."""
    return spark.read.format(fmt).load(path)


# S11
def list_tables(spark: SparkSession, db: str | None = None, with_counts: bool = False,
                pattern: str | None = None, names=None) -> DataFrame:
    """Catalog listing sorted by name (``pattern``: shell-style name filter),
    with creation time and optionally row counts: one job that unites a count
    of each table, read from the footers where the table is parquet (no column
    is read). Only catalog metadata passes through the driver."""
    tables = spark.catalog.listTables(db) if db else spark.catalog.listTables()
    if pattern:
        import fnmatch
        tables = [t for t in tables if fnmatch.fnmatchcase(t.name, pattern)]
    if names is not None:
        wanted = set(names)
        tables = [t for t in tables if t.name in wanted]
    full = {t.name: t.name if t.isTemporary or not t.namespace else f"{'.'.join(t.namespace)}.{t.name}" for t in tables}
    rows = [(t.name, t.tableType, bool(t.isTemporary), _created(spark, full[t.name], t.isTemporary)) for t in tables]
    listed = spark.createDataFrame(rows, "table_name STRING, table_type STRING, is_temporary BOOLEAN, created STRING")
    counts = None
    if with_counts:
        for name, path in full.items():
            one = spark.table(path).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            counts = one if counts is None else counts.union(one)
    listed = listed.join(counts, "table_name", "left") if counts is not None else listed.withColumn(
        "row_count", F.lit(None).cast("bigint"))
    return listed.orderBy("table_name")


def _created(spark: SparkSession, name: str, temporary: bool) -> str | None:
    """Creation time from the catalog's table metadata (temp views have none)."""
    if temporary:
        return None
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Created Time").collect()
    return info[0]["data_type"] if info else None


# S12
def scan_bars(spark: SparkSession, path: str, symbols=None, date_col: str = "date",
              lo=None, hi=None, symbol_col: str = "symbol") -> DataFrame:
    """Price bars with symbol and period filters pushed into the parquet scan."""
    df = spark.read.parquet(path)
    if symbols:
        df = df.where(F.col(symbol_col).isin(list(symbols)))
    if lo is not None:
        df = df.where(F.col(date_col) >= F.lit(lo))
    if hi is not None:
        df = df.where(F.col(date_col) <= F.lit(hi))
    return df


# S13
def read_table(spark: SparkSession, db: str | None, name: str) -> DataFrame:
    return spark.table(f"{db}.{name}" if db else name)
