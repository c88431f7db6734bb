"""Side-by-side check of a registered Spark query against its DuckDB SQL
(row count, column names, order-insensitive values). Used by tests."""

from __future__ import annotations

import math

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<nan>"
        return repr(v)   # exact: the driver hashes values, so bits must agree
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "smallint": "SMALLINT", "float": "FLOAT"}


def type_mismatches(spark_df, con, sql: str) -> dict:
    """Columns whose Spark type does not map to the DuckDB result type."""
    desc = con.execute(f"DESCRIBE {sql}").fetchall()
    duck_types = {r[0]: r[1] for r in desc}
    out = {}
    for name, dtype in spark_df.dtypes:
        want = SPARK_TO_DUCK.get(dtype, dtype.upper())
        got = duck_types.get(name)
        if got is not None and got != want and not (dtype.startswith("decimal") and got.startswith("DECIMAL")):
            out[name] = (dtype, got)
    return out


def compare(spark_df, con, sql: str) -> dict:
    rows = [r.asDict() for r in spark_df.collect()]
    scols = sorted(spark_df.columns)
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orecs = [dict(zip(ocols, r)) for r in cur.fetchall()]
    res = {"spark_rows": len(rows), "oracle_rows": len(orecs),
           "columns_match": scols == sorted(ocols)}
    bad_types = type_mismatches(spark_df, con, sql)
    if bad_types:
        res["type_mismatch"] = bad_types
    if res["columns_match"]:
        a, b = rows_of(rows, scols), rows_of(orecs, scols)
        res["values_match"] = a == b
        if not res["values_match"]:
            diff = [x for x in a if x not in set(b)][:3]
            res["first_diff"] = {"spark_only": diff, "oracle_only": [x for x in b if x not in set(a)][:3]}
    else:
        res["spark_cols"], res["oracle_cols"] = scols, sorted(ocols)
    return res
