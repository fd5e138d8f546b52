"""Byte-level BPE encoding and decoding with a queue of merges over a linked list.

Text parts into pre-tokens; each pre-token's bytes form a doubly linked list of
symbols, and a heap holds the ranks of mergeable neighbours.  The lowest rank
merges first, ties from the left; entries whose symbols have changed since are
skipped.  Decoding concatenates the vocabulary's byte strings.

Strings of special tokens in the text become their ids.  Null text is empty and
has no ids.  Bytes that are not UTF-8 after decoding become U+FFFD.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.memo import Memo

# The pre-token pattern of this tokenizer family.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_PARTS = 600_000
ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_CODECS: dict[str, ByteBpe] = {}


def byte_letters() -> dict[str, int]:
    """Vocabulary files show a byte as its Latin-1 character if visible, else from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in spec["model"]["vocab"]
               if all(c in letters for c in t)}
        ids = spec["model"]["vocab"]
        self.first = [ids[t] for t in sorted(letters, key=letters.get)]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[a] << 32 | ids[b]] = (rank, ids[a + b])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {ids[t]: raw[t] for t in raw} | {i: t.encode() for t, i in special.items()}
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.parts = regex.compile(PRE_TOKEN).findall
        self.double = regex.compile(r"\s |^ | $").search
        self.after_space = Memo(self.spaced, MEMO_PARTS)
        self.after_none = Memo(self.bare, MEMO_PARTS // 10)

    def merged(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        symbols = [self.first[b] for b in word]
        n, merges = len(symbols), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merges.get(symbols[i] << 32 | symbols[i + 1])
            if found:
                heap.append(found[0] << 32 | i)
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            entry = pop(heap)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if j >= n:
                continue
            found = merges.get(symbols[i] << 32 | symbols[j])
            if symbols[i] < 0 or not found or found[0] != entry >> 32:
                continue  # stale: one of the two has merged since
            new = symbols[i] = found[1]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get(new << 32 | symbols[k])
                if found:
                    push(heap, found[0] << 32 | i)
            h = before[i]
            if h >= 0:
                found = merges.get(symbols[h] << 32 | new)
                if found:
                    push(heap, found[0] << 32 | h)
        return [s for s in symbols if s >= 0]

    def bare(self, part: str) -> bytes:
        """Ids of a pre-token that follows no space, as little-endian 32 bits."""
        return array("I", self.merged(part.encode())).tobytes()

    def spaced(self, stretch: str) -> bytes:
        """Ids of a space and the stretch after it, pre-token by pre-token."""
        if stretch.isalpha():
            return array("I", self.merged(b" " + stretch.encode())).tobytes()
        return self.parted(" " + stretch)

    def parted(self, text: str) -> bytes:
        after, bare = self.after_space, self.after_none
        return b"".join([after[p[1:]] if len(p) > 1 and p[0] == " " and p[1:].isalpha() else bare[p]
                         for p in self.parts(text)])

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        A pre-token starts at every space that follows no white space, so the
        stretches between such spaces are encoded alone and remembered.
        """
        if self.double(text):
            return self.parted(text)
        head, *rest = text.split(" ")
        return self.parted(head) + b"".join(map(self.after_space.__getitem__, rest))

    def ids(self, text: str) -> bytes:
        """Ids of any text, as little-endian 32 bits."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.plain(text)
        return b"".join([self.special[p].to_bytes(4, "little") if p in self.special else self.plain(p)
                         for p in self.cut.split(text)])

    def encode(self, text: str) -> list[int]:
        return array("I", self.ids(text)).tolist()

    def decoded(self, ids: list[int]) -> bytes:
        return b"".join(map(self.strings.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decoded(ids).decode("utf-8", "replace")


def codec(path: str) -> ByteBpe:
    """The codec of a file, read once per Python worker."""
    if path not in _CODECS:
        _CODECS[path] = ByteBpe(path)
    return _CODECS[path]


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text they decode to."""
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # what is remembered has no cycles
        bpe = codec(path)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids = bpe.ids(text.as_py() or "")
                back = bpe.decode(array("I", ids))
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(digests, ENCODED)


def encoded_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids of every text."""
    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # what is remembered has no cycles
        bpe = codec(path)
        for batch in batches:
            got = [bpe.encode(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.int32()))],
                                             ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(ids, "doc_id long, ids array<int>")


def decoded_texts(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of every ``ids`` array."""
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # what is remembered has no cycles
        bpe = codec(path)
        for batch in batches:
            got = [bpe.decode(i.as_py() or []) for i in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.string())],
                                             ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, text string")
