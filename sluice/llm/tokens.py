"""Token ids by a byte-level tokenizer file."""

from __future__ import annotations

import functools
import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def default_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=1)
def byte_symbols() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable bytes are themselves, the others follow from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), ord("\xff") + 1)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def byte_encoder(file: str, added: bool = False) -> Callable[[str], list[int]]:
    """Ids of a text by the vocabulary of a byte-level tokenizer file; the
    strings of added tokens are ordinary text, or with ``added`` their ids, as
    ``tokenizers`` gives them. The merges of such a file are in the order of
    their ids, so the vocabulary gives the ranks."""
    import public_tokenizers
    import tiktoken
    with open(file, encoding="utf-8") as f:
        content = json.load(f)
    vocabulary = content["model"]["vocab"]
    special = {t["content"]: t["id"] for t in content.get("added_tokens", [])} if added else {}
    if added and any(t.get(k) for t in content.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{file}: added tokens that depend on the text beside them")
    symbols = byte_symbols()
    ranks = {bytes(symbols[c] for c in token): i for token, i in vocabulary.items() if all(c in symbols for c in token)}
    ranks = {token: i for token, i in ranks.items() if token != b"<|endoftext|>"}
    encoding = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return functools.partial(encoding.encode, allowed_special="all") if special else encoding.encode_ordinary


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each run, one run after the other."""
    total = np.cumsum(lengths)
    n = int(total[-1]) if len(total) else 0
    return np.arange(n) + np.repeat(starts - total + lengths, lengths)


def encode_texts(texts: pa.Array, encode: Callable[[str], list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and ids of all texts (null: none)."""
    ids = [np.array(encode(t), np.uint32) for t in pc.fill_null(texts, "").to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int64)
    return offsets, np.concatenate(ids) if ids else np.zeros(0, np.uint32)
