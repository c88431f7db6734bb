"""Merkle manifest of a dataset, its leaves placed by rank in bitmaps of ids.

Each row is a leaf: the digest of its fields. The leaves of a group (a language)
stand in the order of their ids; two consecutive nodes at a time become their
digest, a single last one too, until one node is left: the group's subroot. The
subroots, in the order of the groups, give the root in the same way.

No sort of the leaves gives their places. The ids of a group are a bitmap in
chunks of 4096; a chunk holds only its words of 64 ids that are not empty, each
with the number of leaves before it in the chunk (a popcount directory), and a
running sum over the chunks gives the leaves before a chunk. Words are merged by
``bit_or`` with partial aggregation. The rank of a leaf is the number before its
word plus the bits below its own. Where ids repeat, a word has more leaves than
bits: there (and for null ids, which stand first) leaves are ordered by id and
digest, by a running sum over ranges of rows, so that one id may hold any share
of the rows. Equal rows are one leaf with a count and fill a run of slots.

Leaves go to slot arrays of 4096 keyed by (group, rank / 4096), where twelve
levels are hashed at once; the arrays' tops are the slots of the next round.
On the way back each array gets the path above it and gives every leaf the
siblings on its way to the root.

Defined cases: a null field is ``-``; a null group is a group of its own, the
first; null ids stand before all others; rows with equal ids are ordered by
their digest; equal rows are leaves of their own beside each other; an empty
table gives no rows; very long texts are hashed whole; further columns don't
matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import scratch_path

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 12                     # levels hashed in a slot array
WORD_BITS = 6
CHUNK_BITS = 12
NONE, LEFT, RIGHT = "0", "1", "2"     # where the sibling stands


def field(value: Column) -> Column:
    """``-``, or the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"merkle-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def running_before(rows: DataFrame, group: list[str], order: list[str], weight: str, out: str) -> DataFrame:
    """``rows`` (a written table, distinct in group and order) with the sum of
    ``weight`` over the rows before in its group. Ranges of rows add up their
    own; the sums of the ranges, a row for each range and group, are added up
    along the ranges."""
    ranged = (rows.repartitionByRange(*group, *order)
              .withColumn("range", F.spark_partition_id()))
    ranged = written(ranged, "ranges")
    totals = ranged.groupBy(*group, "range").agg(F.sum(weight).alias("range_total"))
    earlier = Window.unboundedPreceding, -1
    offsets = totals.select(*group, "range", F.coalesce(F.sum("range_total").over(
        Window.partitionBy(*group).orderBy("range").rowsBetween(*earlier)), F.lit(0)).alias("offset"))
    inside = F.coalesce(F.sum(weight).over(
        Window.partitionBy(*group, "range").orderBy(*order).rowsBetween(*earlier)), F.lit(0))
    return (ranged.withColumn("inside", inside).join(offsets, [*group, "range"])
            .withColumn(out, F.col("offset") + F.col("inside")).drop("range", "inside", "offset"))


def bitmap_index(leaves: DataFrame) -> DataFrame:
    """A row for each (group, chunk): its words, each with bits, leaves and the
    leaves before it in the chunk, and the leaves of the chunk."""
    words = (leaves.groupBy("g", F.expr("coalesce(shiftright(id, 6), -9223372036854775808)").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(id & 63 as int)))").alias("bits"), F.sum("m").alias("n")))
    chunk = F.shiftright("word", CHUNK_BITS - WORD_BITS)
    index = words.groupBy("g", chunk.alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("word", "bits", "n"))).alias("words"), F.sum("n").alias("chunk_n"))
    return index.withColumn("words", F.expr(
        "transform(words, (w, i) -> struct(w.word as word, w.bits as bits, w.n > coalesce(bit_count(w.bits), 0) as crowded,"
        " aggregate(slice(words, 1, i), 0L, (a, x) -> a + x.n) as before))"))


def directory(index: DataFrame) -> DataFrame:
    """A row for each word: ``g, word, bits, crowded`` and the leaves before it
    in its group."""
    based = running_before(index, ["g"], ["chunk"], "chunk_n", "base")
    return based.select("g", "base", F.explode("words").alias("w")).select(
        "g", "w.word", "w.bits", "w.crowded", (F.col("base") + F.col("w.before")).alias("before"))


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` (written: ``g, id, digest, m`` and others) with ``rank``, the
    number of leaves before in the group."""
    index = written(bitmap_index(leaves), "index")
    words = directory(index)
    located = leaves.withColumn("word", F.expr("coalesce(shiftright(id, 6), -9223372036854775808)")).join(
        words, ["g", "word"])
    below = F.expr("bit_count(bits & ~shiftleft(-1L, cast(id & 63 as int)))")
    plain = located.filter("not crowded").withColumn("rank", F.col("before") + below)
    plain = plain.drop("word", "bits", "crowded", "before")
    if index.filter(F.exists("words", lambda w: w["crowded"])).isEmpty():
        return plain
    crowded = written(located.filter("crowded").drop("bits", "crowded"), "crowded")
    crowded = running_before(crowded, ["g", "word"], ["id", "digest"], "m", "inside_word")
    crowded = crowded.withColumn("rank", F.col("before") + F.col("inside_word")).drop("word", "before", "inside_word")
    return plain.unionByName(crowded)


def slots(leaves: DataFrame, levels: int) -> DataFrame:
    """The runs of slots that ranked leaves fill: ``block, slot, run``."""
    cut = leaves.withColumn("block", F.explode(F.sequence(
        F.shiftright("rank", levels), F.shiftright(F.col("rank") + F.col("m") - 1, levels))))
    begin = F.greatest(F.col("rank"), F.shiftleft("block", levels))
    end = F.least(F.col("rank") + F.col("m"), F.shiftleft(F.col("block") + 1, levels))
    return cut.withColumn("slot", (begin - F.shiftleft("block", levels)).cast("int")).withColumn(
        "run", (end - begin).cast("int")).drop("rank", "m")


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def hashed_levels(digests: list[str], alone: bool, most: int) -> list[list[str]]:
    """The nodes of each level of a slot array, its top last. An array that is
    ``alone`` in its group ends at one node, others have all levels."""
    levels = [digests]
    count = (len(digests) - 1).bit_length() if alone else most
    for _ in range(count):
        below = levels[-1]
        levels.append([digest_of("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
    return levels


def slot_array(table: pa.Table) -> tuple[np.ndarray, list[str], bool]:
    """Rows of the table by slot, their digests, and whether the array is the
    only one of its group as far as that matters for its levels."""
    slot = table.column("slot").to_numpy()
    run = table.column("run").to_numpy()
    row = np.empty(int(run.sum()), np.int64)
    first = np.repeat(slot, run)
    row[first + np.arange(len(row)) - np.repeat(np.cumsum(run) - run, run)] = np.repeat(np.arange(len(slot)), run)
    digests = table.column("digest").take(pa.array(row)).to_pylist()
    return row, digests, table.column("block")[0].as_py() == 0


def tops(nodes: DataFrame, levels: int) -> DataFrame:
    """The top of each slot array as a node of the next round."""
    def run(table: pa.Table) -> pa.Table:
        _, digests, alone = slot_array(table)
        top = hashed_levels(digests, alone, levels)[-1][0]
        rank = table.column("block")[0].as_py()
        return pa.table({"g": [table.column("g")[0].as_py()], "block": pa.array([rank >> levels], pa.int64()),
                         "slot": pa.array([rank & ((1 << levels) - 1)], pa.int32()), "run": pa.array([1], pa.int32()),
                         "digest": [top]})
    return (nodes.select("g", "block", "slot", "run", "digest").groupBy("g", "block")
            .applyInArrow(run, "g string, block long, slot int, run int, digest string"))


PATH_FIELDS = "siblings array<string>, sides string"


def paths(nodes: DataFrame, above: DataFrame, others: list[str], levels: int) -> DataFrame:
    """Every slot of ``nodes`` with the siblings on its way up, those of
    ``above`` (one row for each slot array) included, and ``others`` of it."""
    kept = [f for f in nodes.schema.fields if f.name not in ("run", "digest")]
    schema = T.StructType([*kept, nodes.schema["digest"], *[above.schema[c] for c in others],
                           *T._parse_datatype_string(PATH_FIELDS).fields])

    def run(table: pa.Table, up: pa.Table) -> pa.Table:
        if not table.num_rows:
            return empty
        row, digests, alone = slot_array(table)
        below = hashed_levels(digests, alone, levels)[:-1]
        up_siblings, up_sides = up.column("siblings")[0].as_py(), up.column("sides")[0].as_py()
        siblings, sides = [], []
        for i in range(len(digests)):
            own, side = [], []
            for j, level in enumerate(below):
                k = (i >> j) ^ 1
                if k < len(level):
                    own.append(level[k])
                    side.append(LEFT if k & 1 == 0 else RIGHT)
                else:
                    side.append(NONE)
            siblings.append(own + up_siblings)
            sides.append("".join(side) + up_sides)
        out = {f.name: table.column(f.name).take(pa.array(row)) for f in kept}
        out["slot"] = pa.array(np.arange(len(row), dtype=np.int32))
        out["digest"] = pa.array(digests, pa.string())
        for c in others:
            out[c] = pa.array([up.column(c)[0].as_py()] * len(row), pa.string())
        out["siblings"], out["sides"] = pa.array(siblings, pa.list_(pa.string())), pa.array(sides, pa.string())
        return pa.table({name: out[name] for name in schema.names})

    from pyspark.sql.pandas.types import to_arrow_schema
    empty = to_arrow_schema(schema).empty_table()
    return nodes.groupBy("g", "block").cogroup(above.groupBy("g", "block")).applyInArrow(run, schema)


def rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The written nodes of each round; those of the last are one in a group."""
    out = [nodes]
    while True:
        out.append(written(tops(out[-1], levels), f"round-{len(out)}"))
        if out[-1].filter("block > 0 or slot > 0").isEmpty():
            return out


def descended(found: list[DataFrame], above: DataFrame, others: list[str], last: list[str],
              levels: int) -> DataFrame:
    """Paths of the nodes of the first round, ``above`` having those of the
    last (``g``, the path fields and ``others``)."""
    for nodes in reversed(found[:-1]):
        array = F.shiftleft("block", levels) + F.col("slot") if "slot" in above.columns else F.lit(0).cast("long")
        above = paths(nodes, above.select("g", array.alias("block"), "siblings", "sides", *others), others, levels)
    return above.select("g", "block", "slot", *last, "digest", *others, "siblings", "sides")


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple = FIELDS,
             tampered: dict[str, Column] | None = None, where: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """``g`` (the group: empty for null, else ``+`` and its text), ``id``, the
    leaf's place ``position``, ``digest``, ``changed`` (the digest with
    ``tampered`` columns in place where ``where`` holds, else null), ``subroot``,
    ``root``, and the way to the root: ``siblings`` and ``sides`` (for each
    level 0: none, 1: left, 2: right). A slot array has ``levels`` levels."""
    def col(c):
        return F.col(f"`{c}`")
    changed = F.lit(None).cast("string")
    if tampered:
        changed = F.when(where, leaf_digest([tampered.get(c, col(c)) for c in fields]))
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("+"), col(group).cast("string")), F.lit("")).alias("g"),
        col(key).cast("long").alias("id"), leaf_digest([col(c) for c in fields]).alias("digest"),
        changed.alias("changed"))
    leaves = written(leaves.groupBy("g", "id", "digest", "changed").agg(F.count("*").alias("m")), "leaves")
    found = rounds(written(slots(ranked(leaves), levels), "slots"), levels)
    # A row for each group; their order gives the slots of the upper tree.
    subroots = found[-1].select("g", "digest")
    order = F.row_number().over(Window.orderBy("g")) - 1
    named = written(subroots.withColumn("rank", order.cast("long")).select(
        F.lit("").alias("g"), F.col("g").alias("name"), F.shiftright("rank", levels).alias("block"),
        F.col("rank").bitwiseAND((1 << levels) - 1).cast("int").alias("slot"), F.lit(1).alias("run"), "digest"), "groups")
    upper = rounds(named, levels)
    root = upper[-1].select("g", F.col("digest").alias("root"), F.array().cast("array<string>").alias("siblings"),
                            F.lit("").alias("sides"))
    above = written(descended(upper, root, ["root"], ["name"], levels).select(
        F.col("name").alias("g"), "siblings", "sides", F.col("digest").alias("subroot"), "root"), "group-paths")
    out = descended(found, above, ["subroot", "root"], ["id", "changed"], levels)
    return out.select("g", "id", (F.shiftleft("block", levels) + F.col("slot")).alias("position"), "digest", "changed",
                      "subroot", "root", "siblings", "sides")


def folded(leaf: Column, siblings: Column, sides: Column) -> Column:
    """The root that a leaf and its siblings give."""
    start = F.struct(leaf.alias("node"), F.lit(0).alias("used"))

    def step(state, side):
        sibling = F.get(siblings, state["used"])
        text = (F.when(side == LEFT, F.concat(sibling, state["node"]))
                .when(side == RIGHT, F.concat(state["node"], sibling)).otherwise(state["node"]))
        return F.struct(F.sha2(text.cast("binary"), 256).alias("node"),
                        (state["used"] + F.when(side == NONE, 0).otherwise(1)).alias("used"))
    return F.aggregate(F.filter(F.split(sides, ""), lambda s: s != ""), start, step, lambda s: s["node"])


def proof_digest(siblings: Column) -> Column:
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)


def op11_bitmap_rank_manifest(spark, sf_dir: str, levels: int = LEVELS) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = manifest(docs, tampered={"n_chars": F.try_add("n_chars", F.lit(1))}, where=hit, levels=levels)
    rows = rows.withColumn("folded_root", folded(F.coalesce("changed", "digest"), F.col("siblings"), F.col("sides")))
    return rows.select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
                       proof_digest(F.col("siblings")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


# Trees as recursive tables of nodes; the checksum of an id bit by bit.
OP11_SQL = """
WITH RECURSIVE
f AS (
  SELECT doc_id, coalesce('+' || lang, '') AS g,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS chars,
    coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS more_chars,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: CAST(ascii(c) AS BIGINT))), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i:
        CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) AS crc
  FROM documents),
l AS (
  SELECT doc_id, g, sha256(head || chars || tail) AS leaf,
    CASE WHEN crc % 7 = 0 THEN sha256(head || more_chars || tail) ELSE sha256(head || chars || tail) END AS shown FROM f),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY g) AS n FROM l),
nodes(g, level, pos, h, n) AS (
  SELECT g, 0, pos, leaf, n FROM leaves
  UNION ALL
  SELECT g, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM nodes WHERE n > 1
  GROUP BY g, level, pos // 2, n),
tops AS (
  SELECT g, h AS subroot, level AS height, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
upper_nodes(level, pos, h, n) AS (
  SELECT 0, pos, subroot, n FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM upper_nodes WHERE n > 1
  GROUP BY level, pos // 2, n),
way AS (
  SELECT l.g, l.pos, CAST(k AS BIGINT) AS step, s.h, s.pos < (l.pos >> CAST(k AS INT)) AS is_left
  FROM leaves l JOIN tops t USING (g), range(0, 64) r(k)
  LEFT JOIN nodes s ON s.g = l.g AND s.level = k AND s.pos = xor(l.pos >> CAST(k AS INT), 1)
  WHERE k < t.height
  UNION ALL
  SELECT l.g, l.pos, 64 + CAST(k AS BIGINT), s.h, s.pos < (t.pos >> CAST(k AS INT))
  FROM leaves l JOIN tops t USING (g), range(0, 64) r(k)
  LEFT JOIN upper_nodes s ON s.level = k AND s.pos = xor(t.pos >> CAST(k AS INT), 1)
  WHERE k < (SELECT max(level) FROM upper_nodes)),
proofs AS (
  SELECT g, pos, sha256(coalesce(string_agg(h, '' ORDER BY step), '')) AS proof_sha256,
    list(CASE WHEN h IS NULL THEN 'N' WHEN is_left THEN 'L' || h ELSE 'R' || h END ORDER BY step) AS steps
  FROM way GROUP BY g, pos),
folds AS (
  SELECT l.doc_id, l.leaf, t.subroot, (SELECT h FROM upper_nodes WHERE n = 1) AS root,
    coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
    list_reduce(list_prepend(l.shown, coalesce(p.steps, [])), lambda a, s: CASE s[1:1]
      WHEN 'N' THEN sha256(a) WHEN 'L' THEN sha256(s[2:] || a) ELSE sha256(a || s[2:]) END) AS folded_root
  FROM leaves l JOIN tops t USING (g) LEFT JOIN proofs p ON p.g = l.g AND p.pos = l.pos)
SELECT *, folded_root = root AS verified FROM folds
"""
