"""Nested payloads to long rows, rollups and pivots.

Payload text is parsed once to a VARIANT, so what a member is (object, list,
text, number) is known from the document and never guessed from how its text
begins. Objects and lists are opened by the ``variant_explode`` table function
(a Generate inside whole-stage codegen: no shuffle, no array of a huge
response). A variant sorts the names of an object; where the order of the
document decides ("first series wins") the names are read from the text.

A text that is not JSON, or an object that repeats a name, gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.scalars import col_of, month_text_date

MAP_V = "map<string,variant>"
LIST_V = "array<variant>"


def _is(kind: str, v) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit(f"{kind}<")), F.lit(False))


def is_object(v) -> Column:
    return _is("OBJECT", v)


def is_list(v) -> Column:
    return _is("ARRAY", v)


def exploded(df: DataFrame, doc: str) -> DataFrame:
    """``df`` with a row for each member (``key``, ``value``) or item (``key``
    null) of the variant column ``doc``; other values give none."""
    return df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(doc).outer()))


def _kept(keep) -> Column:
    """The columns to keep as one struct, so that no name meets those of the walk."""
    return (F.struct(*keep) if keep else F.lit(None).cast("string")).alias("__keep")


def member(v, name: str, kind: str) -> Column:
    """A member of an object, null when absent or not of that kind."""
    return F.try_variant_get(v, f'$["{name}"]', kind)


def object_members(c) -> Column:
    """Object text to a map of member -> variant (null if not an object)."""
    return F.try_variant_get(F.try_parse_json(col_of(c)), "$", MAP_V)


def first_name(names: Column, members: Column, test) -> Column:
    """The first of ``names`` whose member passes ``test``."""
    return F.get(F.filter(names, lambda k: test(F.try_element_at(members, k))), 0)


# R1 + P16
def flatten_agencies(payloads: DataFrame, payload: str, record_schema: str,
                     keep=(), group_name: str = "county_name",
                     rebalance: int | None = None) -> DataFrame:
    """``{group: [record, ...], ...}`` to one row per record.

    Members that are not lists and list items that are not objects are
    skipped (shape guard). Columns in ``keep`` (request keys such as state
    and extract time) overwrite record fields of the same name.

    ``rebalance``: when a few documents hold most of the data, spread their
    members over this many partitions before the lists are opened, so one
    huge response is not exploded by a single task.
    """
    keep = list(keep)
    docs = payloads.select(_kept(keep), F.try_parse_json(col_of(payload)).alias("__doc"))
    groups = (exploded(docs, "__doc").where(F.col("key").isNotNull())
              .select("__keep", F.col("key").alias("__group"), F.col("value").alias("__list")))
    if rebalance:
        groups = groups.repartition(rebalance)
    items = exploded(groups, "__list").where(F.col("key").isNull() & is_object("value"))
    fields = [f for f in T._parse_datatype_string(record_schema).fields if f.name not in keep and f.name != group_name]
    return items.select(*[member("value", f.name, f.dataType.simpleString()).alias(f.name) for f in fields],
                        F.col("__group").alias(group_name), *[F.col(f"__keep.`{c}`").alias(c) for c in keep])


# R2 / R3
def _series(payload, doc: str, section: str) -> tuple[Column, Column]:
    """Name and variant of the first object-valued member of ``section``, in
    the order of the document."""
    members = member(doc, section, MAP_V)
    names = F.json_object_keys(F.from_json(col_of(payload), f"STRUCT<`{section}`: STRING>")[section])
    name = first_name(names, members, is_object)
    return name, F.try_element_at(members, name)


def count_value(v) -> Column:
    """A count as a double: numbers, texts of numbers and booleans (1 and 0);
    null for anything else."""
    return F.coalesce(F.try_variant_get(v, "$", "string").try_cast("double"),
                      F.try_variant_get(v, "$", "boolean").cast("double"))


def monthly_long(payloads: DataFrame, payload: str, section: str = "actuals",
                 keep=(), label_name: str = "series_label", lookups: dict | None = None) -> DataFrame:
    """First object-valued series of ``section`` to monthly rows.

    Output: ``keep`` + label, month text, ``observation_date`` (null for a
    malformed month) and ``value`` (double, null when not a number).
    ``lookups`` maps an output column to another section (e.g. ``rates``):
    its first series is read for the same month key in the same pass, as
    text (cast by the caller).
    """
    keep = list(keep)
    lookups = lookups or {}
    p = col_of(payload)
    docs = payloads.select(_kept(keep), p.alias("__text"), F.try_parse_json(p).alias("__doc"))
    label, series = _series("__text", "__doc", section)
    extra = [F.try_variant_get(_series("__text", "__doc", sec)[1], "$", MAP_V).alias(f"__m_{n}") for n, sec in lookups.items()]
    heads = docs.select("__keep", label.alias("__label"), series.alias("__series"), *extra)
    rows = exploded(heads, "__series")
    return rows.select(*[F.col(f"__keep.`{c}`").alias(c) for c in keep], F.col("__label").alias(label_name),
                       F.col("key").alias("month_text"), month_text_date("key").alias("observation_date"),
                       count_value("value").alias("value"),
                       *[F.try_variant_get(F.try_element_at(f"__m_{n}", F.col("key")), "$", "string").alias(n)
                         for n in lookups])


def split_rejects(df: DataFrame, required) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) by a required-not-null test, one scan each."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.where(ok), df.where(~ok)


# R4
def payload_rows(df: DataFrame, payload: str, keep=()) -> DataFrame:
    """Coerce a payload to record rows (one JSON text per record).

    A list gives its items; an object gives its first non-empty list member
    (in the order of the document), or itself as one row when it has none; an
    empty payload gives nothing.
    """
    keep = list(keep)
    docs = df.select(_kept(keep), col_of(payload).alias("__text"), F.try_parse_json(col_of(payload)).alias("__doc"))
    members = F.try_variant_get("__doc", "$", MAP_V)
    full = first_name(F.json_object_keys("__text"), members,
                      lambda v: F.coalesce(F.size(F.try_variant_get(v, "$", LIST_V)) > 0, F.lit(False)))
    # The document itself, as a list of one, where no member is a list with items.
    alone = F.when(F.size(members) > 0, F.try_parse_json(F.concat(F.lit("["), "__text", F.lit("]"))))
    docs = docs.select("__keep", F.when(F.startswith(F.ltrim("__text"), F.lit("[")), F.col("__doc"))
                       .otherwise(F.coalesce(F.try_element_at(members, full), alone)).alias("__list"))
    return exploded(docs, "__list").select(*[F.col(f"__keep.`{c}`").alias(c) for c in keep],
                                           F.to_json("value").alias("record"))


# R5
def normalize(df: DataFrame, col: str, prefix: str = "") -> DataFrame:
    """Lift the fields of a struct column to top-level columns."""
    others = [c for c in df.columns if c != col]
    fields = df.select(f"{col}.*").columns
    return df.select(*others, *[F.col(f"{col}.{f}").alias(prefix + f) for f in fields])


# R6 + P17
def explode_with_parent(df: DataFrame, list_col: str, parent_key: str,
                        child_key: str | None = None) -> DataFrame:
    """One row per element of an array of structs; the child's key falls back
    to the parent's when absent."""
    child_key = child_key or parent_key
    others = [c for c in df.columns if c != list_col]
    e = df.select(*others, F.explode(list_col).alias("__e"))
    fields = e.select("__e.*").columns
    out = [F.col(c) for c in others if c != parent_key or child_key != parent_key]
    for f in fields:
        if f == child_key:
            out.append(F.coalesce(F.col(f"__e.{f}"), F.col(parent_key)).alias(f))
        else:
            out.append(F.col(f"__e.{f}").alias(f))
    if child_key not in fields:
        out.append(F.col(parent_key).alias(child_key))
    return e.select(out)


# R7 / A8
def pivot_sum(df: DataFrame, rows, col: str, value: str, members=None, agg=F.sum) -> DataFrame:
    """Long to wide with a sum (or another aggregate).

    With ``members`` the columns are those, and it is one job. Without, ``df``
    is read once all the same: its aggregate by row and member is written, the
    column names come from that small table, and each row's members, gathered
    in a map, fill them. A null member is called ``null``, as in Spark's pivot."""
    from sluice.session import materialize
    rows = [rows] if isinstance(rows, str) else list(rows)
    if members is not None:
        return df.groupBy(*rows).pivot(col, list(members)).agg(agg(value))
    long = materialize(df.groupBy(*rows, F.coalesce(F.col(col).cast("string"), F.lit("null")).alias("__member"))
                       .agg(agg(value).alias("__value")))
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    names = [r[0] for r in long.select("__member").distinct().orderBy("__member").limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"{col} has more than {most} members, no table has so many columns (spark.sql.pivotMaxValues)")
    wide = long.groupBy(*rows).agg(F.map_from_entries(F.collect_list(F.struct("__member", "__value"))).alias("__members"))
    return wide.select(*rows, *[F.try_element_at("__members", F.lit(n)).alias(n) for n in names])


# R8
def close_matrix(bars: DataFrame, date: str, symbol: str, close: str, symbols=None) -> DataFrame:
    """Date x symbol matrix of closing prices (bars are unique per date, symbol)."""
    return pivot_sum(bars, date, symbol, close, symbols, F.max)


# P13 over landed records
def member_names(records: DataFrame, names: str) -> list[str]:
    """All member names of records, from their arrays of names: those that
    stand further in front come first."""
    found = records.select(F.posexplode(names).alias("place", "name")).groupBy("name").agg(F.min("place").alias("place"))
    return [r["name"] for r in found.orderBy("place", "name").collect()]


# R9
def quotes_table(df: DataFrame, array_col: str, fields, keep=()) -> DataFrame:
    """Array of quote records (maps) to fixed columns; absent fields null."""
    e = df.select(*keep, F.explode(array_col).alias("__q"))
    return e.select(*keep, *[F.try_element_at("__q", F.lit(f)).alias(f) for f in fields])


# R10
def series_rows(config: DataFrame, category: str = "category", cat_pos: str = "cat_pos",
                ids: str = "series_ids") -> DataFrame:
    """Config rows (category, ordered id list) to one row per series id.

    Ids are reduced to their first whitespace token, the first occurrence
    (by category position, then list position) wins.
    """
    from sluice.functions.scalars import first_token
    from sluice.operators.dedupe import dedupe_ordered
    e = config.select(category, cat_pos, F.posexplode(ids).alias("pos", "__raw"))
    e = e.select(category, cat_pos, "pos", first_token("__raw").alias("series_id"))
    e = e.where(F.col("series_id").isNotNull() & (F.col("series_id") != ""))
    return dedupe_ordered(e, "series_id", [cat_pos, "pos"])
