"""Best-fit packing of token sequences by non-negative least squares.

Documents become pieces of at most ``max_len`` tokens. The histogram of piece
lengths (at most ``max_len`` rows) goes to the driver, which enumerates all
patterns of up to three lengths that fill a sequence, fits how often to use
each by an active-set non-negative least squares, rounds the counts, and packs
what is left best-fit, largest first, still on the histogram (a pattern is
repeated as often as its lengths last, so the work doesn't grow with the
pieces). A pattern with its count is a range of ranks for each of its lengths:
a piece of rank ``j`` among those of its length reads its sequence and offset
from the plan. Ranks come from counts by (length, bucket) with about
sqrt(pieces) buckets, so that a length which a third of all pieces have is no
hot key.

Defined cases: a null or empty text is the end id alone; a document of any
length is cut, its first piece being the shorter one; equal rows are packed one
by one; an empty table gives no rows; further columns don't matter.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm import text as tx
from sluice.llm import tokens as tk
from sluice.session import scratch_path

MAX_LEN = 1024
END_ID = 2
NNLS_ROUNDS = 40
NNLS_BLOCK = 64             # patterns that may enter the fit in a round
ROUNDINGS = (0.0, 0.25, 0.5, 0.75, 0.999)
PIECE_FIELDS = "piece int, start long, length long, ids_crc32 long, uid long"


def pieces(docs: DataFrame, text: str = "text", tokenizer: str | None = None, end_id: int = END_ID,
           max_len: int = MAX_LEN) -> DataFrame:
    """``row`` (the input row without its text) and the pieces of its document.
    ``uid`` is a random number that orders pieces; write the result before
    using it twice."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("string").alias("none")]
    rows = docs.select(F.struct(*others).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    file = tokenizer or tk.default_file()
    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string(PIECE_FIELDS).fields])

    def run(batches):
        encode = tk.byte_encoder(file, added=True)
        random = np.random.default_rng()
        for batch in tx.slices(batches, "text", 16 << 20):
            offsets, ids = tk.encode_texts(batch.column("text"), encode)
            n_docs = len(offsets) - 1
            ids = np.insert(ids, offsets[1:], np.uint32(end_id)).astype("<u4")
            offsets = offsets + np.arange(n_docs + 1)
            n = np.diff(offsets)
            count = -(-n // max_len)
            owner = np.repeat(np.arange(n_docs), count)
            piece = tk.runs(np.zeros(n_docs, np.int64), count)
            first = (n - 1) % max_len + 1
            start = np.where(piece == 0, 0, first[owner] + (piece - 1) * max_len)
            length = np.where(piece == 0, first[owner], max_len)
            at = offsets[:-1][owner] + start
            data = memoryview(ids.tobytes())
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            uid = random.integers(0, 2 ** 63 - 1, len(owner))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(length), pa.array(crc, pa.int64()), pa.array(uid)], schema.names)

    return rows.mapInArrow(run, schema)


def patterns(lengths: list[int], max_len: int) -> np.ndarray:
    """All non-increasing triples of the lengths (0: none) with sum ``max_len``."""
    have = np.zeros(max_len + 1, bool)
    have[lengths] = True
    have[0] = True
    usable = np.flatnonzero(have)
    a, b = np.meshgrid(usable, usable, indexing="ij")
    c = max_len - a - b
    fits = (a >= b) & (b >= c) & (c >= 0)
    a, b, c = a[fits], b[fits], c[fits]
    real = have[c] & ~((b == 0) & (c > 0))
    return np.stack([a[real], b[real], c[real]], axis=1)


def fit(parts: np.ndarray, histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Patterns with a positive count and these counts: non-negative least
    squares of the histogram by active sets, several patterns entering at once."""
    chosen = np.zeros(0, np.int64)
    x = np.zeros(0)
    scale = max(1.0, float(histogram[1:].max(initial=0)))
    target = histogram / scale
    target[0] = 0

    def columns(which):
        m = np.zeros((len(histogram), len(which)))
        for k in range(3):
            np.add.at(m, (parts[which, k], np.arange(len(which))), 1.0)
        m[0] = 0
        return m

    matrix, gram = columns(chosen), np.zeros((0, 0))
    for _ in range(NNLS_ROUNDS):
        left = target - matrix @ x
        left[0] = 0
        gain = left[parts].sum(axis=1)
        gain[chosen] = -np.inf
        best = np.argsort(-gain)[:8 * NNLS_BLOCK]
        entering, touched = [], set()
        for p in best[gain[best] > 1e-7].tolist():      # those of a round share no length
            own = set(parts[p].tolist()) - {0}
            if not own & touched:
                entering.append(p)
                touched |= own
                if len(entering) == NNLS_BLOCK:
                    break
        if not entering:
            break
        chosen = np.concatenate([chosen, np.array(entering, np.int64)])
        new = columns(np.array(entering))
        cross = matrix.T @ new
        gram = np.block([[gram, cross], [cross.T, new.T @ new + 1e-9 * np.eye(len(entering))]])
        matrix = np.hstack([matrix, new])
        x = np.concatenate([x, np.zeros(len(entering))])
        while len(chosen):
            z = np.linalg.solve(gram, matrix.T @ target)
            if (z > 0).all():
                x = z
                break
            falling = z <= 0
            step = np.min(np.where(falling, x / np.maximum(x - z, 1e-300), np.inf))
            x = x + min(1.0, max(0.0, step)) * (z - x)
            stay = x > 1e-12
            if stay.all():
                stay[np.argmin(z)] = False
            chosen, matrix, gram, x = chosen[stay], matrix[:, stay], gram[np.ix_(stay, stay)], x[stay]
    return chosen, x * scale


def pack_histogram(histogram: list[int], max_len: int) -> list[tuple[list[int], int]]:
    """(lengths, count) of the sequences that hold ``histogram[l]`` pieces of
    each length ``l``: the fitted counts, rounded in a few ways of which the
    one with the fewest sequences holds, and the rest best-fit."""
    full = int(histogram[max_len])
    left = np.array(histogram, np.int64)
    left[max_len] = 0
    parts = patterns(np.flatnonzero(left).tolist(), max_len)
    chosen, x = fit(parts, left.astype(float)) if len(parts) else (np.zeros(0, int), np.zeros(0))
    tried = (rounded(parts[chosen], x, left.copy(), max_len, shift) for shift in ROUNDINGS)
    best = min(tried, key=lambda plan: sum(count for _, count in plan))
    return ([([max_len], full)] if full else []) + best


def rounded(parts: np.ndarray, x: np.ndarray, left: np.ndarray, max_len: int, shift: float) -> list:
    """The patterns with their counts plus ``shift`` rounded down (and cut to
    what is left), then best-fit sequences of the residuals."""
    out = []

    def use(own: list[int], most: int | None = None) -> None:
        need = {v: own.count(v) for v in set(own)}
        count = min(int(left[v]) // k for v, k in need.items())
        count = count if most is None else min(count, most)
        if count > 0:
            out.append((own, count))
            for v, k in need.items():
                left[v] -= k * count

    for p in np.argsort(-x):
        use([int(v) for v in parts[p] if v], int(x[p] + shift))
    have = np.flatnonzero(left).tolist()                # ascending
    while have:
        use(best_fit(have, left, max_len))
        have = [v for v in have if left[v]]
    return out


def best_fit(have: list[int], left: np.ndarray, max_len: int) -> list[int]:
    """A sequence with the largest length left, filled by the best pair of
    others or, if that fills more, by the largest that fit one after another."""
    first = have[-1]
    room = max_len - first
    spare = {first: int(left[first]) - 1}
    many, rest = [], room
    k = bisect_right(have, rest) - 1
    while k >= 0 and rest > 0:
        v = have[k]
        take = min(rest // v, spare.get(v, int(left[v])))
        many += [v] * take
        rest -= v * take
        k = min(k - 1, bisect_right(have, rest) - 1)
    pair, low, high = [], 0, bisect_right(have, room) - 1
    while rest and low <= high:
        a, b = have[low], have[high]
        enough = spare.get(a, int(left[a])) >= 1 and spare.get(b, int(left[b])) >= 1 + (a == b)
        if a + b <= room:
            if enough and room - a - b < rest:
                pair, rest = [b, a], room - a - b
            low += 1
        else:
            high -= 1
    return [first, *(pair or many)]


def slots(plan: list[tuple[list[int], int]], max_len: int) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, first sequence, offset) of its
    ranges of ranks."""
    found: dict[int, list] = {}
    used = [0] * (max_len + 1)
    sequence = 0
    for own, count in plan:
        offset = 0
        for v in own:
            found.setdefault(v, []).append((used[v], sequence, offset))
            used[v] += count
            offset += v
        sequence += count
    return {v: np.array(rows, np.int64) for v, rows in found.items()}


def pack(cut: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """The pieces (a written table) with ``sequence_id`` and ``offset``."""
    counted = cut.groupBy("length").count().collect()       # at most max_len rows
    histogram = [0] * (max_len + 1)
    for r in counted:
        histogram[r["length"]] = r["count"]
    places = slots(pack_histogram(histogram, max_len), max_len)
    buckets = max(1, math.isqrt(sum(histogram)))
    cut = cut.withColumn("bucket", F.pmod("uid", F.lit(buckets)))
    # Pieces of the buckets before, for each length.
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cut.groupBy("length", "bucket").count()
              .select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first_rank")))
    own = Window.partitionBy("length", "bucket").orderBy("uid")
    ranked = (cut.withColumn("own_rank", F.row_number().over(own) - 1).join(starts, ["length", "bucket"])
              .withColumn("rank", F.col("first_rank") + F.col("own_rank"))
              .drop("bucket", "first_rank", "own_rank", "uid"))
    schema = T.StructType([*ranked.schema.fields, *T._parse_datatype_string("sequence_id long, offset long").fields])

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for v in np.unique(length):
                at = np.flatnonzero(length == v)
                rows = places[int(v)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                sequence[at], offset[at] = row[:, 1] + rank[at] - row[:, 0], row[:, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], schema.names)

    return ranked.mapInArrow(place, schema).drop("rank")


def packed(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """``row, piece, start, length, ids_crc32, sequence_id, offset``."""
    path = scratch_path(docs.sparkSession, "pieces")
    pieces(docs, text, **how).write.parquet(path)
    return pack(docs.sparkSession.read.parquet(path), how.get("max_len", MAX_LEN))


def op5_pattern_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return packed(docs).select(F.col("row.doc_id").alias("doc_id"), "piece", "start", "length", "ids_crc32",
                               "sequence_id", "offset")
