"""Quality rule: repetition by suffix arrays.

The words of a text are sorted by their suffixes (prefix doubling, only the
suffixes that still tie are sorted again). Neighbours in that order bound the
longest-common-prefix intervals: an interval of value ``l`` is a repeated
substring of ``l`` words that can't be extended to the right at all its
places. A place lies in intervals up to the greater of its two neighbour
values, so the union of the spans of all maximal repeats of at least
``min_words`` words is the union of ``[i, i + l_i)`` over the places with
``l_i >= min_words``.

All texts of a slice are sorted together; a word's code contains its text, so
no interval crosses texts.

Defined cases: a null or empty text has no words, covered fraction 0 and fails
the base rule (under 50 words); texts of any length are handled whole; equal
rows give equal results, one each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm import text as tx

MIN_WORDS = 10              # shortest repeat that counts
MAX_COVERED = 0.40          # share of the word characters inside repeats
MAX_LONGEST = 0.20          # longest repeat, as a share of the words ...
LONG_WORDS = 50             # ... once it has that many words
SYMBOLS = b"#*$%&|<>"

METRICS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "covered_fraction double, longest_repeat long, base_failed boolean, kept boolean")


def suffix_order(keys: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of ``keys`` (suffixes stop at ``ends``) and the ranks by
    the first 1, 2, 4, ... keys. A rank is the first place of its group."""
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if n else np.array([], int)
    sizes = np.diff(np.append(starts, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, sizes)
    levels = [rank]
    active = order[np.repeat(sizes > 1, sizes)]
    step = 1
    while active.size:
        at = active + step
        inside = at < ends[active]
        second = np.zeros(active.size, np.int64)
        second[inside] = rank[at[inside]] + 1
        joint = rank[active] * (n + 1) + second
        order = np.argsort(joint, kind="stable")
        joint, active = joint[order], active[order]
        group = joint // (n + 1)
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new_part = np.concatenate([[True], joint[1:] != joint[:-1]])
        place = np.arange(active.size)
        group_start = np.maximum.accumulate(np.where(new_group, place, 0))
        part_start = np.maximum.accumulate(np.where(new_part, place, 0))
        rank = rank.copy()
        rank[active] = group + part_start - group_start
        levels.append(rank)
        sizes = np.diff(np.append(np.flatnonzero(new_part), active.size))
        active = active[np.repeat(sizes > 1, sizes)]
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def longest_repeats(keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each place, the length of the longest repeated run of keys that
    starts there: the greater of the two neighbour values of the suffix array."""
    n = len(keys)
    best = np.zeros(n + 1, np.int64)
    if n < 2:
        return best[:n]
    order, levels = suffix_order(keys, ends)
    pairs = np.flatnonzero(levels[0][order[:-1]] == levels[0][order[1:]])
    a, b = order[pairs], order[pairs + 1]
    common = np.zeros(len(pairs), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank = np.append(levels[k], [-1])               # a place past the end equals none
        pa_, pb_ = np.minimum(a + common, n), np.minimum(b + common, n)
        same = (rank[pa_] == rank[pb_]) & (pa_ != pb_)
        common += same.astype(np.int64) << k
    np.maximum.at(best, a, common)
    np.maximum.at(best, b, common)
    return best[:n]


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n places lies in one of the spans."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edge)[:n] > 0


def _duplicate_lines(texts: pa.Array) -> np.ndarray:
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    encoded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    blank = pc.equal(pc.ascii_trim_whitespace(encoded.dictionary), "").to_numpy(zero_copy_only=False)
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = ~blank[codes]
    keys = (tx.owners(offsets) * (len(blank) + 1) + codes)[real]
    first = np.unique(keys)
    n_docs = len(offsets) - 1
    return (np.bincount(keys // (len(blank) + 1), minlength=n_docs)
            - np.bincount(first // (len(blank) + 1), minlength=n_docs))


def _symbols(texts: pa.Array) -> np.ndarray:
    plain = pc.fill_null(texts, "")
    plain = pa.concat_arrays([plain])           # a slice's own buffers, from 0
    offsets = np.frombuffer(plain.buffers()[1], np.int32 if plain.type == pa.string() else np.int64)
    offsets = offsets[plain.offset:plain.offset + len(plain) + 1].astype(np.int64)
    data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[:offsets[-1]]
    marked = np.zeros(256, bool)
    marked[list(SYMBOLS)] = True
    places = np.flatnonzero(marked[data])       # single bytes in UTF-8
    return np.searchsorted(places, offsets[1:]) - np.searchsorted(places, offsets[:-1])


def measure(texts: pa.Array, min_words: int, max_covered: float, max_longest: float, long_words: int) -> dict:
    """The metrics of each text as arrays."""
    w = tx.words(texts)
    n_docs, n = len(w.offsets) - 1, len(w.codes)
    doc = tx.owners(w.offsets)
    chars = pc.utf8_length(w.distinct).to_numpy(zero_copy_only=False).astype(np.int64)[w.codes] if n else np.zeros(0, np.int64)
    repeat = longest_repeats(doc * (len(w.distinct) + 1) + w.codes, w.offsets[1:][doc])
    three = np.flatnonzero(repeat >= 3)
    in_three = covered(three, np.full(len(three), 3), n)
    long = np.flatnonzero(repeat >= min_words)
    in_long = covered(long, repeat[long], n)
    n_words, word_chars = np.diff(w.offsets), tx.per_text(chars, w.offsets)
    longest = np.zeros(n_docs, np.int64)
    np.maximum.at(longest, doc, repeat)
    share = tx.per_text(chars * in_long, w.offsets) / np.maximum(word_chars, 1)
    n_repeat = tx.per_text(in_three, w.offsets)
    base_failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    refused = (share > max_covered) | ((longest >= long_words) & (longest > max_longest * n_words))
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": _symbols(texts),
            "n_dup_lines": _duplicate_lines(texts), "n_repeat_words": n_repeat, "covered_fraction": share,
            "longest_repeat": longest, "base_failed": base_failed, "kept": ~base_failed & ~refused}


def repetition(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, max_covered: float = MAX_COVERED,
               max_longest: float = MAX_LONGEST, long_words: int = LONG_WORDS) -> DataFrame:
    """``row`` (the input row) and the metrics of its text, ``kept`` among them."""
    rows = tx.row_and_text(docs, text)

    def run(batches):
        for batch in tx.slices(batches, "text"):
            found = measure(batch.column("text"), min_words, max_covered, max_longest, long_words)
            names = ["row", *found]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, found.values())], names)

    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string(METRICS).fields])
    return rows.mapInArrow(run, schema)


def keep_unrepetitive(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The documents that the rule keeps, with their columns."""
    return repetition(docs, text, **limits).filter("kept").select("row.*")


def op3_suffix_repetition(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return repetition(docs).select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols",
                                   "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_fraction",
                                   "longest_repeat")
