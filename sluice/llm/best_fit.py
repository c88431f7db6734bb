"""Best-fit decreasing packing with a segment tree over remaining capacities.

Documents become token ids and an end id. One longer than a window is first cut
into full windows, the rest of it being its last piece. Pieces are then placed
from the longest to the shortest, each into the open window with the least room
that holds it, a new one where none does.

Only the histogram of piece lengths (``max_len`` rows) reaches the driver.
Windows with equal room are ranges of sequence numbers, and a range of windows
takes its pieces of one length at a time: the window that best fit chooses
stays the tightest one until the length fits no more. So the placement is that
of piece-by-piece best fit, and its work depends on the number of lengths, not
on that of the pieces. A range of pieces is named by its length and ranks. The
rank of a piece among those of its length is the number in the tasks before,
plus that in its own task, counted while the pieces are written: no sort, and no
key that a third of the pieces share.

Defined cases: a null or empty text is the end id alone; a document of any
length is cut; equal rows are packed one by one; an empty table gives no rows;
further columns don't matter.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm import text as tx
from sluice.llm import tokens as tk
from sluice.session import scratch_path

MAX_LEN = 2048
END_ID = 1
PIECE_FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, task int, own_rank long"
SLICE_BYTES = 16 << 20


def pieces(docs: DataFrame, text: str = "text", tokenizer: str | None = None, end_id: int = END_ID,
           max_len: int = MAX_LEN) -> DataFrame:
    """``row`` (the input row without its text) and the pieces of its document.
    ``task`` and ``own_rank`` (among the pieces of that length and task) belong
    to one run: write the result before using it."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("string").alias("none")]
    rows = docs.select(F.struct(*others).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    file = tokenizer or tk.default_file()
    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string(PIECE_FIELDS).fields])

    def run(batches):
        encode = tk.byte_encoder(file, added=True)
        task = TaskContext.get().partitionId()
        seen = np.zeros(max_len + 1, np.int64)              # pieces of each length so far
        for batch in tx.slices(batches, "text", SLICE_BYTES):
            offsets, ids = tk.encode_texts(batch.column("text"), encode)
            n_docs = len(offsets) - 1
            ids = np.insert(ids, offsets[1:], np.uint32(end_id)).astype("<u4")
            offsets = offsets + np.arange(n_docs + 1)
            n = np.diff(offsets)
            count = -(-n // max_len)
            owner = np.repeat(np.arange(n_docs), count)
            start = tk.runs(np.zeros(n_docs, np.int64), count) * max_len
            length = np.minimum(max_len, n[owner] - start)
            at = offsets[:-1][owner] + start
            data = memoryview(ids.tobytes())
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            own_rank = seen[length] + earlier_equals(length)
            seen += np.bincount(length, minlength=max_len + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(owner)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                 pa.array(n[owner]), pa.array(np.full(len(owner), task, np.int32)), pa.array(own_rank)], schema.names)

    return rows.mapInArrow(run, schema)


def earlier_equals(values: np.ndarray) -> np.ndarray:
    """For each value the number of equal ones before it."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.searchsorted(ordered, ordered, side="left")
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - first
    return out


class Rooms:
    """Segment tree over the remaining capacities 0 .. ``largest``: each node
    says whether a window with a capacity below it is open."""

    def __init__(self, largest: int):
        self.size = 1 << largest.bit_length()
        self.any = bytearray(2 * self.size)

    def set(self, room: int, is_open: bool) -> None:
        k = self.size + room
        self.any[k] = is_open
        while k > 1:
            k //= 2
            self.any[k] = self.any[2 * k] | self.any[2 * k + 1]

    def tightest(self, need: int) -> int | None:
        """The least open capacity of ``need`` or more."""
        k = self.size + need
        while not self.any[k]:
            while k & 1:                # a right child, or the root: all to the right of it is further up
                k //= 2
            if k == 0:
                return None
            k += 1                      # its right sibling
        while k < self.size:
            k = 2 * k if self.any[2 * k] else 2 * k + 1
        return k - self.size


def best_fit_decreasing(histogram: list[int], max_len: int) -> tuple[dict[int, np.ndarray], int]:
    """Places of ``histogram[l]`` pieces of each length ``l``: for each length
    the rows (first rank, first sequence, offset) of its ranges, whose further
    ranks go to the sequences that follow; and the number of sequences."""
    rooms = Rooms(max_len)
    ranges: list[list[tuple[int, int]]] = [[] for _ in range(max_len + 1)]      # (first sequence, count) by room
    places, sequences = {}, 0

    def put(room: int, first: int, count: int) -> None:
        if count and room:
            ranges[room].append((first, count))
            rooms.set(room, True)

    for length in range(max_len, 0, -1):
        left, rank, rows = int(histogram[length]), 0, []
        while left:
            room = rooms.tightest(length)
            if room is None:
                count = -(-left // (max_len // length))
                put(max_len, sequences, count)
                sequences += count
                continue
            first, count = ranges[room].pop()
            if not ranges[room]:
                rooms.set(room, False)
            each = min(room // length, left)            # pieces a window takes before another is looked at
            used = min(count, left // each)
            for j in range(each):
                rows.append((rank, first, max_len - room + j * length))
                rank += used
            left -= used * each
            put(room, first + used, count - used)
            put(room - each * length, first, used)
        if rows:
            places[length] = np.array(rows, np.int64)
    return places, sequences


def pack(cut: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """The pieces (a written table) with ``sequence_id`` and ``offset``."""
    counts = cut.groupBy("length", "task").count()
    histogram = [0] * (max_len + 1)
    for r in cut.groupBy("length").count().collect():          # at most max_len rows
        histogram[r["length"]] = r["count"]
    places, _ = best_fit_decreasing(histogram, max_len)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first_rank"))
    ranked = cut.join(starts, ["length", "task"]).select(
        "row", "start", "length", "ids_crc32", "doc_tokens", (F.col("first_rank") + F.col("own_rank")).alias("rank"))
    schema = T.StructType([*ranked.schema.fields, *T._parse_datatype_string("sequence_id long, offset long").fields])

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for at in np.split(order, cuts) if len(order) else []:
                rows = places[int(length[at[0]])]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                sequence[at], offset[at] = row[:, 1] + rank[at] - row[:, 0], row[:, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], schema.names)

    return ranked.mapInArrow(place, schema).drop("rank")


def packed(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """``row, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    path = scratch_path(docs.sparkSession, "best-fit-pieces")
    pieces(docs, text, **how).write.parquet(path)
    return pack(docs.sparkSession.read.parquet(path), how.get("max_len", MAX_LEN))


def sequences(placed: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """``sequence_id, tokens, padded``: the tokens a sequence holds and those
    it has after padding to ``max_len``, which a power of two is spared."""
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("tokens")).withColumn(
        "padded", F.when(F.bit_count("tokens") == 1, F.col("tokens")).otherwise(F.lit(max_len).cast("long")))


def op13_best_fit_decreasing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return packed(docs).select(F.col("row.doc_id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens",
                               "sequence_id", "offset")
