"""Word and row helpers shared by the text operators.

Words are the maximal runs ``[^\\x20\\x09-\\x0D]+``. A batch is handled as flat
arrays: the word codes of all its texts one after the other, the offsets of
the texts, and the distinct words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text bytes handled at once: bounds the arrays a task holds. A single longer
# text is still handled whole.
SLICE_BYTES = 4 << 20


class Words(NamedTuple):
    offsets: np.ndarray     # int64, one more than texts
    codes: np.ndarray       # int64 code of each word
    distinct: pa.Array      # the word of each code


def one_array(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0)
    return column


def words(texts: pa.Array) -> Words:
    """Words of each text; a null text has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    encoded = lists.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    empty = pc.index(encoded.dictionary, "").as_py()
    if empty >= 0:          # white space at an end of a text leaves an empty piece
        real = codes != empty
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        codes = codes[real]
    return Words(offsets, codes, encoded.dictionary)


def hashes(values: pa.Array) -> np.ndarray:
    """64-bit hash of each string."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, values.cast(pa.binary()).to_pylist()),
                       dtype=np.uint64, count=len(values))


def owners(offsets: np.ndarray) -> np.ndarray:
    """Index of the text that each word belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (one per word) for each text."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def gram_hashes(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that start at each word (meaningless where
    the array ends earlier). Built by joining runs of doubling length."""
    def mix(a, b):
        with np.errstate(over="ignore"):
            x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x7F4A7C159E3779B9))
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            return x ^ (x >> np.uint64(29))

    def later(a, by):
        out = np.zeros_like(a)
        if by < len(a):
            out[:len(a) - by] = a[by:]
        return out

    run, length, done, out = word_hashes, 1, 0, None
    while True:
        if size & length:
            out = later(run, done) if out is None else mix(out, later(run, done))
            done += length
        if done == size:
            return out
        run, length = mix(run, later(run, length)), length * 2


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` has about ``limit`` bytes in each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def row_and_text(docs: DataFrame, text: str) -> DataFrame:
    """The whole row as one struct beside its text, so that names of further
    columns never meet the names an operator adds."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{text}`").cast("string").alias("text"))


def with_text(docs: DataFrame, text_column: str = "text") -> list:
    """Columns of a frame ``row, new_text, n_chars`` that put the new text (and,
    where there is such a column, its length) into the row."""
    out = []
    for c in docs.columns:
        kind = docs.schema[c].dataType
        if c == text_column:
            out.append(F.col("new_text").cast(kind).alias(c))
        elif c == "n_chars":
            out.append(F.length("new_text").cast(kind).alias(c))
        else:
            out.append(F.col(f"row.`{c}`").alias(c))
    return out
