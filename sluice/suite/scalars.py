"""Scalar text, date and JSON functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.scalars import (clean_strings, date_text, default_if_null, drop_zones, first_token,
                                      full_match, iso_text, next_day, run_ts, sanitize_ident, stamp_text,
                                      strip_quotes, text_date, truncate)
from sluice.suite import case
from sluice.suite.common import RUN_SQL, RUN_TS, t

CTRL_SQL = r"'[\x00-\x08\x0b\x0c\x0e-\x1f]'"


@case("clean_text", f"""
SELECT doc_id, CAST(length(regexp_replace(text, {CTRL_SQL}, '', 'g')) AS INTEGER) AS clean_chars,
       CAST(length(text) - length(regexp_replace(text, {CTRL_SQL}, '', 'g')) AS INTEGER) AS removed_chars,
       regexp_replace(lang, {CTRL_SQL}, '', 'g') AS lang
FROM documents""")
def clean_text(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("raw_chars"), "text", "lang")
    cleaned = clean_strings(d)                      # F16 over every string column, one projection
    return cleaned.select("doc_id", F.length("text").alias("clean_chars"),
                          (F.col("raw_chars") - F.length("text")).alias("removed_chars"), "lang")


@case("sanitize_names", """
SELECT page_id, substr(regexp_replace(url, '[^A-Za-z0-9_-]', '_', 'g'), 1, 31) AS sheet_name,
       CAST(length(regexp_replace(url, '[^A-Za-z0-9_-]', '_', 'g')) AS INTEGER) AS ident_chars
FROM pages""")
def sanitize_names(spark, sf_dir):
    p = t(spark, sf_dir, "pages")
    ident = sanitize_ident("url")
    return p.select("page_id", truncate(ident, 31).alias("sheet_name"), F.length(ident).alias("ident_chars"))


@case("scalar_text", """
SELECT p_partkey, regexp_split_to_array(trim(p_type), '\\s+')[1] AS type_word, upper(p_brand) AS brand_upper,
       lower(trim(p_brand)) AS brand_lower,
       CASE WHEN length(q) >= 2 AND left(q, 1) IN ('"', '''') AND right(q, 1) = left(q, 1)
            THEN substr(q, 2, length(q) - 2) ELSE q END AS name_unquoted,
       regexp_full_match(p_brand, 'Brand#[0-9]{1,2}') AS brand_ok
FROM (SELECT *, '"' || p_name || '"' AS q FROM part)""")
def scalar_text(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    return p.select("p_partkey", first_token("p_type").alias("type_word"),
                    F.upper("p_brand").alias("brand_upper"), F.lower(F.trim("p_brand")).alias("brand_lower"),
                    strip_quotes(F.concat(F.lit('"'), F.col("p_name"), F.lit('"'))).alias("name_unquoted"),
                    full_match("p_brand", "Brand#[0-9]{1,2}").alias("brand_ok"))


@case("dates_and_json", f"""
SELECT event_id, {RUN_SQL} AS run_at, strftime(ts, '%Y-%m-%d') AS obs_text, CAST(ts AS DATE) AS obs_back,
       CAST(ts AS DATE) + 1 AS next_obs, strftime(ts, '%Y%m%d_%H%M%S') AS stamp,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
       CASE WHEN value > 40 THEN value ELSE CAST(0 AS DOUBLE) END AS big_value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k, true AS roundtrip_ok, ts AS ts_local
FROM events""")
def dates_and_json(spark, sf_dir):
    ev = t(spark, sf_dir, "events")
    zoned = ev.withColumn("ts_local", F.col("ts").cast("timestamp"))
    ev = drop_zones(zoned)                                   # F17
    js = F.to_json(F.struct("event_id", "event_type"))       # F23
    back = F.from_json(js, "event_id BIGINT, event_type STRING")
    return ev.select(
        "event_id", run_ts(RUN_TS).alias("run_at"), date_text("ts").alias("obs_text"),
        text_date(date_text("ts")).alias("obs_back"), next_day(F.to_date("ts")).alias("next_obs"),
        stamp_text("ts").alias("stamp"), iso_text("ts").alias("iso"),
        default_if_null(F.when(F.col("value") > 40, F.col("value")), 0.0).alias("big_value"),
        F.from_json("props", "k INT")["k"].alias("props_k"),
        ((back["event_id"] == F.col("event_id")) & (back["event_type"] == F.col("event_type"))).alias("roundtrip_ok"),
        "ts_local")


@case("zoned_text", """
SELECT event_id, epoch_us(ts) - 7200000000 AS instant_us, epoch_us(ts) AS naive_us FROM events""")
def zoned_text(spark, sf_dir):
    """zoned text to an instant (offset honoured), zone-less text as UTC."""
    from sluice.functions.scalars import try_timestamp
    ev = t(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zoned = try_timestamp(F.concat(text, F.lit("+02:00")))
    naive = try_timestamp(F.concat(text, F.lit("Z")))      # zone-less text taken as UTC
    return ev.select("event_id", F.unix_micros(zoned).alias("instant_us"), F.unix_micros(naive).alias("naive_us"))
