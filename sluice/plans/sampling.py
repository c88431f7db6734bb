"""Schema sampling: list the catalog, sample every table, clean the sample
and export it; a table that fails is skipped (S11, O6, F16, F17, K6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.functions.scalars import clean_strings, drop_zones
from sluice.operators.explore import random_sample
from sluice.sources.landing import list_tables

# The catalog listing is exported under the name "Listing";
# samples are 1,000 rows.
LISTING = "Listing"
SAMPLE_ROWS = 1_000


def sample_catalog(spark: SparkSession, out_root: str, tables: list[str] | None = None,
                   db: str | None = None, n: int = SAMPLE_ROWS,
                   seed: int = 42, parallel: int = 4) -> tuple[list, list]:
    """Write the listing and one cleaned sample per table under ``out_root``.

    A sample is written under its table's name. Returns ``(exported,
    skipped)``: (table, export name) pairs and
    (table, error) pairs, in listing order. Only catalog names pass through
    the driver; every sample is a Spark job written by the executors, and up
    to ``parallel`` of these independent jobs run at the same time.
    """
    from concurrent.futures import ThreadPoolExecutor

    listing = list_tables(spark, db, names=tables)
    listing.write.mode("overwrite").parquet(f"{out_root}/{LISTING}")
    names = tables if tables is not None else [r.table_name for r in listing.collect()]

    # Worker threads carry the caller's job group, description and pool, so
    # the samples are cancelled, scheduled and reported with the caller's work.
    try:
        sc = spark.sparkContext
        props = {k: sc.getLocalProperty(k) for k in
                 ("spark.jobGroup.id", "spark.job.description", "spark.scheduler.pool")}
    except Exception:  # no driver-side context (Spark Connect)
        sc, props = None, {}

    if LISTING in names:
        raise ValueError(f"a table is named like the listing, {LISTING}")

    def one(table):
        for k, v in props.items():
            if v is not None:
                sc.setLocalProperty(k, v)
        try:
            source = spark.table(f"{db}.{table}" if db else table)
            sample = clean_strings(drop_zones(random_sample(source, n, seed)))
            sample.write.mode("overwrite").parquet(f"{out_root}/{table}")
            return table, table, None
        except Exception as exc:  # one bad table must not stop the run
            return table, table, str(exc).splitlines()[0][:200]

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        results = list(pool.map(one, names))
    exported = [(t, e) for t, e, err in results if err is None]
    skipped = [(t, err) for t, _e, err in results if err is not None]
    return exported, skipped


def exported_counts(spark: SparkSession, out_root: str, exported) -> DataFrame:
    """Rows per exported sample, read back from the written files in one scan
    (no schema inference: a column-free read, grouped by the file's folder)."""
    from pyspark.sql import functions as F
    if not exported:
        return spark.createDataFrame([], "table_name STRING, export_name STRING, sampled_rows BIGINT")
    names = spark.createDataFrame([(t, e) for t, e in exported], "table_name STRING, export_name STRING")
    files = spark.read.schema("__unused INT").parquet(*[f"{out_root}/{e}" for _t, e in exported])
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    counts = files.groupBy(folder.alias("export_name")).agg(F.count(F.lit(1)).alias("sampled_rows"))
    return names.join(counts, "export_name", "left").select(
        "table_name", "export_name", F.coalesce("sampled_rows", F.lit(0)).alias("sampled_rows"))
