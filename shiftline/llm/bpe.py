"""Byte-level BPE encoding and decoding.

Each pre-token starts as a doubly linked list of byte symbols. A heap holds
``(merge rank, position)`` of every adjacent pair that has a merge. The
lowest entry is taken; if the pair at that position has changed since it was
pushed, the entry is stale and skipped, else the right symbol is unlinked and
the two new neighbour pairs are pushed. A word of n bytes costs O(n log n).
Decoding concatenates the vocabulary's byte strings.

Results equal the tokenizers library's with ``add_special_tokens=False`` and
``decode(skip_special_tokens=False)``: added tokens found in a text are split
out before pre-tokenization and keep their own id.

Defined cases: a null or empty text has no ids and decodes to the empty text;
a null id list decodes to the empty text; repeated rows give equal rows. A
word of any length is encoded (only words up to 64 characters that come a
second time are remembered, at most 2**18 of them per Python worker). Memory
per task is one Arrow batch plus the word table.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.llm.common import kept, map_rows

# Letters (L) and numbers (N) that Unicode 16 added to 15.1.
UNICODE_16 = """
1C89-1C8A L, A7CB-A7CD L, A7DA-A7DC L, 105C0-105F3 L, 10D40-10D49 N, 10D4A-10D65 L,
10D6F-10D85 L, 10EC2-10EC4 L, 11380-11389 L, 1138B-1138B L, 1138E-1138E L, 11390-113B5 L,
113B7-113B7 L, 113D1-113D1 L, 113D3-113D3 L, 116D0-116E3 N, 11BC0-11BE0 L, 11BF0-11BF9 N,
13460-143FA L, 16100-1611D L, 16130-16139 N, 16D40-16D6C L, 16D70-16D79 N, 18CFF-18CFF L,
1CCF0-1CCF9 N, 1E5D0-1E5ED L, 1E5F0-1E5F0 L, 1E5F1-1E5FA N
"""
# Fixed value: the white space of the pre-tokenizer (Unicode White_Space).
WHITE_SPACE = "\t-\r \x85\xa0  -     　"
# Code points on which re's own classes agree with the vocabulary's splitter.
PLAIN = "\t-\r -~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧€"

#: Ids are below 2 ** SHIFT; END is no id.
SHIFT = 24
END = (1 << SHIFT) - 1
MAX_CACHED_WORD = 64
MAX_CACHED_WORDS = 1 << 18
#: Flags, by a hash of the word, of words that came once.
FLAGS = 1 << 20


def _class(letter: str) -> str:
    """A regex class body of all code points whose category starts with ``letter``."""
    added = [p.split() for p in UNICODE_16.replace("\n", " ").split(",")]
    spans = [tuple(int(x, 16) for x in span.split("-")) for span, kind in added if kind == letter]
    start = None
    for cp in range(sys.maxunicode + 2):
        inside = cp <= sys.maxunicode and unicodedata.category(chr(cp))[0] == letter
        if inside and start is None:
            start = cp
        elif not inside and start is not None:
            spans.append((start, cp - 1))
            start = None
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


def _splitter(letters: str, numbers: str, other: str, space: str) -> re.Pattern:
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?{letters}+| ?{numbers}+| ?{other}+"
                      f"|{space}+(?!{other}|{letters}|{numbers})|{space}+")


@lru_cache(maxsize=1)
def _full_splitter() -> re.Pattern:
    l, n, s = _class("L"), _class("N"), WHITE_SPACE
    return _splitter(f"[{l}]", f"[{n}]", f"[^{s}{l}{n}]", f"[{s}]")


_PLAIN_SPLITTER = _splitter(r"[^\W\d_]", r"\d", r"(?:[^\s\w]|_)", r"\s")
_NOT_PLAIN = re.compile(f"[^{PLAIN}]")


def pre_tokens(text: str) -> list[str]:
    return (_full_splitter() if _NOT_PLAIN.search(text) else _PLAIN_SPLITTER).findall(text)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Bpe(dict):
    """A vocabulary with its merges; as a mapping, pre-token -> ids as uint32 bytes."""

    def __init__(self, path: str):
        super().__init__()
        self.came = bytearray(FLAGS)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        to_byte = byte_symbols()
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.strings = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(to_byte[c] for c in token)
        for token in spec["added_tokens"]:
            self.strings[token["id"]] = token["content"].encode()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.added_pattern = re.compile(f"({'|'.join(names)})") if names else None
        self.byte_ids = [0] * 256
        for c, b in to_byte.items():
            self.byte_ids[b] = vocab[c]
        #: By rank: the pair, as left id << SHIFT | right id, and the id it becomes.
        self.pairs, self.merged, self.ranks = [], [], {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs.append(vocab[left] << SHIFT | vocab[right])
            self.merged.append(vocab[left + right])
            self.ranks.setdefault(self.pairs[-1], rank)

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.merge([self.byte_ids[b] for b in word.encode()])).tobytes()
        if len(word) <= MAX_CACHED_WORD:
            flag = hash(word) % FLAGS
            if not self.came[flag]:
                self.came[flag] = 1
                return ids
            if len(self) >= MAX_CACHED_WORDS:
                self.clear()
                self.came = bytearray(FLAGS)
            self[word] = ids
        return ids

    def merge(self, symbols: list[int]) -> list[int]:
        n = len(symbols)
        if n == 1:
            return symbols
        rank_of, pairs, bits = self.ranks.get, self.pairs, n.bit_length()
        low = (1 << bits) - 1
        # The list is closed by one end node, n, whose symbol is in no pair.
        symbols.append(END)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        before[0] = n
        # An entry is rank << bits | position: lowest rank first, then leftmost.
        heap, left = [], symbols[0]
        for i in range(1, n):
            right = symbols[i]
            if (r := rank_of(left << SHIFT | right)) is not None:
                heap.append(r << bits | i - 1)
            left = right
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i, rank = entry & low, entry >> bits
            j = after[i]
            if symbols[i] << SHIFT | symbols[j] != pairs[rank]:
                continue                                    # stale
            symbols[i] = merged = self.merged[rank]
            symbols[j] = -1
            after[i] = k = after[j]
            before[k] = i
            if (r := rank_of(merged << SHIFT | symbols[k])) is not None:
                heappush(heap, r << bits | i)
            h = before[i]
            if (r := rank_of(symbols[h] << SHIFT | merged)) is not None:
                heappush(heap, r << bits | h)
        return [s for s in symbols[:n] if s >= 0]

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        if self.added_pattern is None:
            return b"".join(map(self.__getitem__, pre_tokens(text)))
        parts = self.added_pattern.split(text)
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.added[part].to_bytes(4, "little"))
            else:
                out.extend(map(self.__getitem__, pre_tokens(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        strings = map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())
        return b"".join(strings).decode("utf-8", "replace")


def load(path: str) -> Bpe:
    """The vocabulary of this Python worker, with the words it has met."""
    return kept("bpe", path, lambda: Bpe(path))


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``ids array<int>`` of every text."""
    def row(*cells):
        *own, body, vocabulary = cells
        return (*own, np.frombuffer(load(vocabulary).encode(body or ""), "<u4").astype("<i4"))
    names = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)
    return map_rows(docs.select(*keep, text), row, f"{names}, ids array<int>", path, owner="bpe")


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``text`` of every id list."""
    def row(*cells):
        *own, numbers, vocabulary = cells
        return (*own, load(vocabulary).decode(np.array(numbers or [], "<u4").tobytes()))
    names = ", ".join(f"`{c}` {t}" for c, t in encoded.select(*keep).dtypes)
    return map_rows(encoded.select(*keep, ids), row, f"{names}, text string", path, owner="bpe")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text; digests of both (doc_id, n_tokens, ids_sha256, decoded_sha256).

    Ids and decoded text stay inside the task, so no token list is shuffled
    or serialised back to the JVM.
    """
    def row(doc_id, body, vocabulary):
        bpe = load(vocabulary)
        ids = bpe.encode(body or "")
        return (doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), row,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", path, owner="bpe")
