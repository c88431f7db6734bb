"""SentencePiece unigram encoding and decoding.

The pieces of a model file with their log scores make a double-array trie over
the model's characters. The best segmentation of a text is the one whose scores
sum up highest (Viterbi). A text is first escaped: a space becomes the marker
U+2581, one marker goes in front. No piece holds a marker behind another
character, so a segmentation never crosses such a place; the texts of a batch
are cut there, and all distinct chunks are segmented at once, place by place,
with array operations. A character that no piece covers costs the least score
minus a penalty and becomes its UTF-8 bytes' pieces (byte fallback). Decoding
joins the pieces, turns markers into spaces and drops the first.

Of equal segmentations the one whose last piece is longest holds, at every
place. Defined cases: a null or empty text has no ids and decodes to an empty
text; texts are encoded whole; equal rows give equal ids, one each; an empty
table gives no rows; names of further columns don't matter.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm import text as tx
from sluice.llm.tokens import runs

MARK = "▁"
UNKNOWN_PENALTY = 10.0      # fixed value of the format
SLICE = 8 << 20
FIELDS = "ids array<int>, n_tokens long, n_byte_tokens long, ids_crc32 long, decoded string"


class DoubleArray:
    """Trie over strings of symbol codes (from 1): the child of state ``s`` by
    ``c`` is ``base[s] + c`` where ``check`` names ``s``."""

    def __init__(self, words: list[tuple[list[int], int]]) -> None:
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for codes, v in words:
            at = 0
            for c in codes:
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    value.append(-1)
                at = children[at][c]
            value[at] = v
        width = max((max(c) for c in children if c), default=0) + 1
        size = 2 * len(children) + 2 * width
        base, check, out = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken = np.zeros(size, bool)
        taken[0] = True
        place, low, end = {0: 0}, 1, 1
        for node, own in enumerate(children):
            state = place[node]
            out[state] = value[node]
            if not own:
                continue
            codes = np.array(sorted(own), np.int64)
            while taken[low]:
                low += 1
            # Nodes of many children are placed near the end, where there is room.
            start = max(1, (low if len(codes) < 3 else max(low, end - 2048)) - int(codes[0]))
            reach = 256
            while True:             # the first offset at which no child meets a taken place
                if start + reach + width >= size:
                    base, check, out, taken = (np.concatenate([a, np.full(size, f, a.dtype)]) for a, f in
                                               ((base, 0), (check, -1), (out, -1), (taken, False)))
                    size *= 2
                tried = np.arange(start, start + reach)
                fits = np.flatnonzero(~taken[tried[:, None] + codes].any(axis=1))
                if len(fits):
                    break
                start, reach = start + reach, min(2 * reach, 4096)
            offset = start + int(fits[0])
            base[state] = offset
            end = max(end, offset + int(codes[-1]))
            taken[offset + codes] = True
            check[offset + codes] = state
            for c in codes.tolist():
                place[own[c]] = offset + c
        # Codes beyond the end must not leave the arrays.
        self.base = base
        self.check = np.concatenate([check, np.full(size + width, -2, np.int32)])
        self.value = out

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children, -1 where there is none."""
        to = self.base[states] + codes
        return np.where((codes > 0) & (self.check[to] == states), to, -1)


class Unigram:
    def __init__(self, file: str) -> None:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=file)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(n)]
        self.byte_ids = np.full(256, model.unk_id(), np.int32)
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(pieces[i][3:5], 16)] = i
        self.is_byte = np.array([model.is_byte(i) for i in range(n)])
        self.pieces = [(p, i) for i, p in enumerate(pieces) if not special[i]]
        self.score = np.array([model.get_score(i) for i in range(n)], np.float64)
        self.unknown = min(self.score[i] for _, i in self.pieces) - UNKNOWN_PENALTY
        self.alphabet = {c: k for k, c in enumerate(sorted({c for p, _ in self.pieces for c in p}), 1)}
        points = max(map(ord, self.alphabet)) + 1
        self.code = np.zeros(points + 1, np.int32)
        for c, k in self.alphabet.items():
            self.code[ord(c)] = k
        self.trie = DoubleArray([([self.alphabet[c] for c in p], i) for p, i in self.pieces])
        self.longest = max(len(p) for p, _ in self.pieces)
        if any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in self.pieces):
            raise ValueError("a piece with a marker behind another character: texts can't be cut at markers")
        # What each id stands for in a decoded text.
        data = [bytes([int(p[3:5], 16)]) if self.is_byte[i] else b"" if special[i] else p.replace(MARK, " ").encode()
                for i, p in enumerate(pieces)]
        self.data = np.frombuffer(b"".join(data), np.uint8)
        self.sizes = np.array([len(d) for d in data])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids and ids of all chunks (escaped texts)."""
        length = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(-length, kind="stable")
        length = length[order]
        points = np.frombuffer("".join(chunks[i] for i in order.tolist()).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.code[np.minimum(points, len(self.code) - 1)]
        first = np.cumsum(length) - length                  # of each chunk in codes
        node = first + np.arange(len(chunks))               # places between characters, one more than characters
        best = np.full(len(codes) + len(chunks), -np.inf)
        back = np.zeros(len(best), np.int64)                # length of the last piece
        last = np.full(len(best), -1, np.int32)             # its id, -1: unknown character
        best[node] = 0
        for i in range(int(length[0]) if len(length) else 0):
            alive = int(np.searchsorted(-length, -i, side="left"))      # chunks longer than i
            at, state = first[:alive] + i, np.zeros(alive, np.int64)
            here = best[node[:alive] + i]
            # The unknown character, unless a piece does better.
            to = node[:alive] + i + 1
            worse = here + self.unknown > best[to]
            best[to[worse]] = here[worse] + self.unknown
            back[to[worse]], last[to[worse]] = 1, -1
            who = np.arange(alive)
            for k in range(1, self.longest + 1):
                inside = length[who] >= i + k
                if not inside.all():
                    who, state = who[inside], state[inside]
                state = self.trie.step(state, codes[at[who] + k - 1])
                found = state >= 0
                if not found.all():
                    who, state = who[found], state[found]
                if not len(who):
                    break
                piece = self.trie.value[state]
                real = piece >= 0
                if real.any():
                    own, piece = who[real], piece[real]
                    to = node[own] + i + k
                    value = here[own] + self.score[piece]
                    better = value > best[to]
                    to = to[better]
                    best[to], back[to], last[to] = value[better], k, piece[better]
        # Back from the ends, all chunks at once.
        at, ids, owner = node + length, [], []
        alive = np.flatnonzero(length > 0)
        at = at[alive]
        while len(alive):
            ids.append(np.where(last[at] >= 0, last[at], -1 - points[at - alive - 1].astype(np.int64)))
            owner.append(alive)
            at = at - back[at]
            going = at > node[alive]
            alive, at = alive[going], at[going]
        if not ids:
            return np.zeros(len(chunks), np.int64), np.zeros(0, np.int32)
        turn = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        ids, owner = np.concatenate(ids), np.concatenate(owner)
        place = np.lexsort((-turn, order[owner]))
        ids, owner = ids[place], order[owner][place]
        lost = np.flatnonzero(ids < 0)
        if len(lost):               # byte fallback
            bytes_of = [self.byte_ids[list(chr(-1 - p).encode("utf-8", "surrogatepass"))] for p in ids[lost].tolist()]
            count = np.ones(len(ids), np.int64)
            count[lost] = [len(b) for b in bytes_of]
            start = np.cumsum(count) - count
            out = np.repeat(ids, count)
            out[runs(start[lost], count[lost])] = np.concatenate(bytes_of)
            ids, owner = out, np.repeat(owner, count)
        return np.bincount(owner, minlength=len(chunks)), ids.astype(np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of all texts."""
        texts = pc.fill_null(texts, "")
        odd = pc.or_(pc.match_substring_regex(texts, rf"  |^ | $|{MARK}"), pc.equal(texts, ""))
        plain = pc.invert(odd)
        lists = pc.split_pattern(texts.filter(plain), " ")
        cut = lists.offsets.to_numpy().astype(np.int64)
        owner = np.flatnonzero(plain.to_numpy(zero_copy_only=False))[tx.owners(cut - cut[0])]
        chunks = pc.binary_join_element_wise(MARK, lists.flatten(), "")
        rest = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        more = [re.findall(f"{MARK}+[^{MARK}]*", MARK + t.replace(" ", MARK)) if t else [] for t in texts.filter(odd).to_pylist()]
        if any(more):
            chunks = pa.concat_arrays([chunks, pa.array([c for m in more for c in m], chunks.type)])
            owner = np.concatenate([owner, np.repeat(rest, [len(m) for m in more])])
            order = np.argsort(owner, kind="stable")
            chunks, owner = chunks.take(pa.array(order)), owner[order]
        encoded = chunks.dictionary_encode()
        codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        count, ids = self.segment(encoded.dictionary.to_pylist())
        lengths = count[codes]
        per_text = np.bincount(owner, weights=lengths, minlength=len(texts)).astype(np.int64)
        return np.concatenate([[0], np.cumsum(per_text)]), ids[runs((np.cumsum(count) - count)[codes], lengths)]

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> list[str]:
        sizes = self.sizes[ids]
        data = self.data[runs(self.starts[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[offsets].tolist()
        return [data[a:b].decode("utf-8", "replace")[1:] for a, b in zip(ends, ends[1:])]


@functools.lru_cache(maxsize=2)
def unigram(file: str) -> Unigram:
    return Unigram(file)


def default_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def coded(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """``row``, the ids of its text and the text decoded from them."""
    rows = tx.row_and_text(docs, text)
    # Built once, here: a few MB, bounded by the vocabulary.
    built = docs.sparkSession.sparkContext.broadcast(unigram(model or default_file()))
    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string(FIELDS).fields])

    def run(batches):
        coder = built.value
        for batch in tx.slices(batches, "text", SLICE):
            offsets, ids = coder.encode(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            data = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), lists, pa.array(np.diff(offsets)), pa.array(tx.per_text(coder.is_byte[ids], offsets)),
                 pa.array(crc, pa.int64()), pa.array(coder.decode(offsets, ids), pa.string())], schema.names)

    return rows.mapInArrow(run, schema)


def op2_sentencepiece_unigram(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    same = F.col("decoded") == F.coalesce(F.col("row.text"), F.lit(""))
    return coded(docs).select(F.col("row.doc_id").alias("doc_id"), "ids", "n_tokens", "n_byte_tokens", "ids_crc32",
                              same.alias("round_trip"))
