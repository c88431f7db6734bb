"""Substring removal by seed and extend.

Seeds: every window of ``WINDOW`` words has one anchor, the ``ANCHOR``-gram of
least hash inside it (winnowing), so equal windows have equal anchors at the
same place. Windows in a row with one anchor are a run; a document has about
one run for seven windows. Anchors are counted first, by hash alone and
combined before the shuffle; only runs whose anchor occurs twice go on.

Extend: a run reaches from its anchor as far as its windows do, both ways. Runs
of one anchor with equal reach are a class; all but the first of a class lie
inside a longer repeat and are removed whole, without a look at their windows.
Where an anchor has several classes - the ends of repeats, where contexts part
- the windows of the first run of each class are compared one by one: a window
is removed unless it is the first with its words. Spans join up to the maximal
repeats of at least ``WINDOW`` words.

Words are compared by hashes: two windows count as equal where the 64-bit hash
of their anchor and that of the window (of a run: of its first and last window)
agree. No words are moved for a second look.

First means the smallest (doc_id, start). A window, run or anchor that a third
of all documents share is combined to a count or minimum before the shuffle;
its rows meet that minimum, which is written first, in a join whose skewed
partitions AQE splits. No pairs of documents are formed.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a null or empty
text has none, and a text under ``WINDOW`` words keeps all; texts are read
whole; rows with one doc_id are one document (each loses the words at the
places marked); rows without doc_id are neither sources nor changed; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm import text as tx
from sluice.llm.repetition import covered
from sluice.session import scratch_path

WINDOW = 20
ANCHOR = 6                  # so each window has 15 candidates and a run at most 15 windows
REACH = WINDOW - ANCHOR + 1
PACK = 64                   # places and lengths share a long


def _least_place(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of the next ``width`` hashes, the leftmost of equal ones."""
    n = len(hashes)

    def better(a, b):
        return np.where(hashes[a] <= hashes[b], a, b)

    best, have = np.arange(n), 1
    while have < width:
        step = min(have, width - have)
        best = better(best, best[np.minimum(np.arange(n) + step, n - 1)])
        have += step
    return best


def _starts(w: tx.Words) -> np.ndarray:
    """Places at which a window starts."""
    n = len(w.codes)
    return np.flatnonzero(np.arange(n) + WINDOW <= w.offsets[1:][tx.owners(w.offsets)])


def runs(docs: DataFrame) -> DataFrame:
    """``anchor, reach`` (hashes), ``doc_id`` and ``at`` (first window and
    number of windows) of every run of ``doc_id, text``."""
    def run(batches):
        for batch in tx.slices(batches, "text"):
            w = tx.words(batch.column("text"))
            start = _starts(w)
            words = tx.hashes(w.distinct)[w.codes] if len(w.codes) else np.zeros(0, np.uint64)
            if not len(start):
                continue
            grams = tx.gram_hashes(words, ANCHOR)
            window = tx.gram_hashes(words, WINDOW)
            anchor = _least_place(grams, REACH)[start]
            new = np.concatenate([[True], (np.diff(start) != 1) | (np.diff(anchor) != 0)])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(start)))
            low, q = start[first], anchor[first]
            with np.errstate(over="ignore"):
                reach = (window[low] * np.uint64(0x9E3779B97F4A7C15)) ^ (window[low + count - 1] + (q - low).astype(np.uint64))
                reach = (reach ^ (reach >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + count.astype(np.uint64)
            doc = tx.owners(w.offsets)[low]
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[q].view(np.int64)), pa.array(reach.view(np.int64)),
                 batch.column("doc_id").take(pa.array(doc)), pa.array((low - w.offsets[doc]) * PACK + count)],
                ["anchor", "reach", "doc_id", "at"])

    return docs.filter("doc_id is not null").mapInArrow(run, "anchor long, reach long, doc_id long, at long")


def windows(marked: DataFrame) -> DataFrame:
    """``anchor, window, doc_id, start`` of the windows of the runs listed in
    ``edges`` of ``doc_id, text, edges``."""
    def run(batches):
        for batch in tx.slices(batches, "text"):
            w = tx.words(batch.column("text"))
            words = tx.hashes(w.distinct)[w.codes] if len(w.codes) else np.zeros(0, np.uint64)
            hashes = tx.gram_hashes(words, WINDOW)
            lists = tx.one_array(batch.column("edges"))
            doc = tx.owners(lists.offsets.to_numpy().astype(np.int64))
            flat = lists.flatten()
            at = flat.field("at").to_numpy(zero_copy_only=False)
            low, count = at // PACK, at % PACK
            owner = np.repeat(doc, count)
            total = np.cumsum(count)
            start = np.repeat(low - (total - count), count) + np.arange(total[-1] if len(total) else 0)
            anchor = np.repeat(flat.field("anchor").to_numpy(zero_copy_only=False), count)
            real = start + WINDOW <= np.diff(w.offsets)[owner]      # another row of the same doc_id may be shorter
            owner, start, anchor = owner[real], start[real], anchor[real]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(hashes[w.offsets[owner] + start].view(np.int64)),
                 batch.column("doc_id").take(pa.array(owner)), pa.array(start)], ["anchor", "window", "doc_id", "start"])

    return marked.mapInArrow(run, "anchor long, window long, doc_id long, start long")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _not_first(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
    """``rows`` with ``later``: whether a smaller (doc_id, place) has the keys."""
    first = _written(rows.groupBy(*keys).agg(F.min(F.struct("doc_id", place)).alias("first")), "first")
    return rows.join(first, keys).withColumn(
        "later", (F.col("first.doc_id") != F.col("doc_id")) | (F.col(f"first.{place}") != F.col(place))).drop("first")


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: the removed spans of ``doc_id, text`` (start and
    length in words, packed in a long)."""
    found = runs(docs)
    often = _written(found.groupBy("anchor").count().filter("count > 1").select("anchor"), "often")
    shared = _written(found.join(often, "anchor"), "shared-runs")
    parted = _written(shared.groupBy("anchor").agg((F.min("reach") != F.max("reach")).alias("parted")), "parted")
    placed = _written(_not_first(shared, ["anchor", "reach"], "at").join(parted, "anchor")
                      .filter("later or parted"), "placed-runs")
    edges = (placed.filter("not later").groupBy("doc_id")
             .agg(F.collect_list(F.struct("anchor", "at")).alias("edges")))
    ends = _written(windows(docs.select("doc_id", "text").join(edges, "doc_id")), "edge-windows")
    spans = (placed.filter("later").select("doc_id", (F.expr(f"at div {PACK}") * PACK + F.col("at") % PACK + WINDOW - 1).alias("span"))
             .union(_not_first(ends, ["anchor", "window"], "start").filter("later")
                    .select("doc_id", (F.col("start") * PACK + WINDOW).alias("span"))))
    return spans.groupBy("doc_id").agg(F.collect_list("span").alias("spans"))


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row``, ``n_words``, ``n_removed`` and ``new_text`` (the kept words
    joined by one space; the text itself, null included, if none is removed)."""
    rows = tx.row_and_text(docs, text).withColumn("doc_id", F.col(f"row.`{doc_id}`").cast("long"))
    spans = repeats(rows.select("doc_id", "text"))
    joined = rows.join(spans, "doc_id", "left").select("row", "text", "spans")
    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string("n_words long, n_removed long, new_text string").fields])

    def run(batches):
        for batch in tx.slices(batches, "text"):
            texts = tx.one_array(batch.column("text"))
            w = tx.words(texts)
            lists = tx.one_array(batch.column("spans"))
            n_spans = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(n_spans)), n_spans)
            packed = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            end = w.offsets[1:][owner]
            start = np.minimum(w.offsets[owner] + packed // PACK, end)
            length = np.minimum(packed % PACK, end - start)
            gone = covered(start, length, len(w.codes)) if len(w.codes) else np.zeros(0, bool)
            n_gone = tx.per_text(gone, w.offsets)
            kept = w.codes[~gone]
            cut = w.offsets - np.concatenate([[0], np.cumsum(gone)])[w.offsets]
            strings = pa.DictionaryArray.from_arrays(pa.array(kept.astype(np.int32)), w.distinct).cast(w.distinct.type)
            lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), strings), " ")
            new = pc.if_else(pa.array(n_gone > 0), lines, texts)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.diff(w.offsets)), pa.array(n_gone), new],
                                             schema.names)

    return joined.mapInArrow(run, schema)


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the words of later repeats; ``n_chars``, where
    there is such a column, follows."""
    return removed(docs, doc_id, text).select(*tx.with_text(docs, text))


def op9_seed_and_extend(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words = F.array_join(F.filter(F.split(F.coalesce("new_text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda x: x != ""), " ")
    return removed(docs).select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed",
                                F.sha2(words, 256).alias("kept_sha256"))


OP9_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
p AS (
  SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, words FROM w),
g AS (
  SELECT doc_id, i, sha256(array_to_string(words[i : i + 19], ' ')) AS h FROM p WHERE i + 19 <= len(words)),
f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS nth FROM g),
later AS (
  SELECT doc_id, list(i ORDER BY i) AS starts FROM f WHERE nth > 1 GROUP BY doc_id),
gone AS (
  SELECT doc_id, list_distinct(flatten(list_transform(starts, lambda s: range(s, s + 20)))) AS places FROM later),
k AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
    CASE WHEN places IS NULL THEN words
         ELSE list_transform(list_sort(list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(places, i))), lambda i: words[i]) END AS kept
  FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM k
"""
