"""Best-fit packing of tokenised documents into sequences of fixed capacity.

A document is its ids followed by id 0; only documents over the capacity are cut.
Which lengths share a sequence is planned on the counts per length, at most
``capacity`` numbers whatever the input: pieces above a third of the capacity
pair at most twice per sequence (largest first, each with the largest that still
fits), smaller ones go, longest first, to the tightest gap.  Pieces then take
their places by their rank within their length, which is found without putting a
length into one task.

Null text is empty and gives one piece holding id 0.  Repeated rows are packed
as often as they occur.  An empty table gives no rows.
"""

from __future__ import annotations

import gc
import itertools
import string
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.arrays import lists
from tastegrid.llm.byte_bpe import byte_letters
from tastegrid.llm.memo import Memo, tidy
from tastegrid.llm.tables import slots, written

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long")
# How this tokenizer family parts a word.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MEMO_WORDS = 150_000
# An apostrophe may begin a part of letters.
MARKS = string.punctuation.replace("'", "")
LAST_PLAIN = "\u024f"  # composed Latin letters end here
# A special token or combining marks: some compose with a small letter only, and the library composes first.
NOT_LOWERED = r"<\||[\x{300}-\x{37F}]"


class WordIds:
    """Little-endian ids of texts by a tokenizer that drops white space.

    Such a tokenizer never joins what white space parts, so words (runs without
    ASCII white space) are encoded one by one and remembered within bounds.  A
    word of Latin letters is lower-cased and parted here, and the library's own
    model encodes the parts; any other word goes through the whole library.  A
    word's lower-case letters are remembered as a word of their own, so that
    case and punctuation around them cost a lookup.

    ASCII letters of a text are lower-cased all at once, unless ``NOT_LOWERED``
    occurs in it.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.parts = regex.compile(PARTS).findall
        self.odd = regex.compile(f"[^\\x00-{LAST_PLAIN}]|<\\|").search
        self.letters = {b: c for c, b in byte_letters().items()}
        self.marks = Memo(self.part, MEMO_WORDS // 16)
        self.words = Memo(self.word, MEMO_WORDS)

    def part(self, part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def word(self, word: str) -> bytes:
        if word.isascii():
            if word.isalpha():
                return self.part(word) if word.islower() else self.words[word.lower()]
            stem = word.rstrip(MARKS)
            if stem.isalpha():
                return self.words[stem] + self.marks[word[len(stem):]]
        low = word.lower()
        plain = low.isalpha()
        if not (plain and max(low) <= LAST_PLAIN) and (self.odd(low) or not low.isprintable()):
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if not plain:
            return b"".join([self.words[p] if p.isalpha() else self.marks[p] for p in self.parts(low)])
        return self.part(low) if low == word else self.words[low]

    def __call__(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of each text; a word is looked up once per column, however often it occurs there."""
        texts = column.fill_null("")
        if not len(texts):
            return
        asis = pc.match_substring_regex(texts, NOT_LOWERED)
        words = pc.ascii_split_whitespace(pc.if_else(asis, texts, pc.ascii_lower(texts)))
        found = words.flatten().dictionary_encode()
        ids = list(map(self.words.__getitem__, found.dictionary.to_numpy(zero_copy_only=False)))
        flat = np.frombuffer(b"".join(ids), np.uint32)
        ids = lists(flat, np.fromiter(map(len, ids), np.int64, len(ids)) // 4, pa.uint32()).take(found.indices)
        cuts = np.asarray(ids.offsets)[np.asarray(words.offsets) - words.offsets[0].as_py()]
        flat = np.asarray(ids.values)
        for start, end in itertools.pairwise(cuts.tolist()):
            yield flat[start:end].tobytes()


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # what is remembered has no cycles
        encode = WordIds(tokenizer_path)  # ends with the task, as idle workers keep what they hold
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                ids += b"\0\0\0\0"
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for col, value in zip(cols, (doc, n, at // 4, len(part) // 4, zlib.crc32(part)),
                                          strict=True):
                        col.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                                                       pa.int64()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
        del encode
        gc.enable()
        gc.collect()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(pieces), PIECES)


class Plan:
    """Places for the pieces of each length, from the counts per length alone."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.left = dict(counts)
        self.rank = dict.fromkeys(counts, 0)
        #: (length, rank_from, rank_to, per_sequence, sequence_from, offset)
        self.places: list[tuple[int, int, int, int, int, int]] = []
        self.gaps: list[int] = []  # sorted gaps that have sequences
        self.runs: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, how many)
        third = capacity // 3
        self.pair([n for n in sorted(counts, reverse=True) if n > third])
        for n in sorted((n for n in counts if n <= third), reverse=True):
            self.fit(n)

    def put(self, n: int, first: int, many: int, per: int, gap: int) -> None:
        """``per`` pieces of length n into each of ``many`` sequences from ``first`` with this gap."""
        took = many * per
        self.places.append((n, self.rank[n], self.rank[n] + took, per, first, self.capacity - gap))
        self.rank[n] += took
        self.left[n] -= took
        self.open(gap - per * n, first, many)

    def open(self, gap: int, first: int, many: int) -> None:
        if gap > 0 and many:
            if gap not in self.runs:
                insort(self.gaps, gap)
            self.runs.setdefault(gap, []).append((first, many))

    def fresh(self, n: int, many: int, per: int) -> None:
        first, self.sequences = self.sequences, self.sequences + many
        self.put(n, first, many, per, self.capacity)

    def pair(self, lengths: list[int]) -> None:
        """Largest first, each with the largest other piece that fits beside it."""
        for n in lengths:
            while self.left[n]:
                mate = next((m for m in lengths if m <= self.capacity - n and m <= n
                             and self.left[m] > (m == n)), None)
                if mate is None:
                    self.fresh(n, self.left[n], 1)
                    break
                if mate == n:
                    self.fresh(n, self.left[n] // 2, 2)
                    continue
                many = min(self.left[n], self.left[mate])
                first, self.sequences = self.sequences, self.sequences + many
                gap = self.capacity - n
                self.places.append((n, self.rank[n], self.rank[n] + many, 1, first, 0))
                self.rank[n] += many
                self.left[n] -= many
                self.put(mate, first, many, 1, gap)

    def fit(self, n: int) -> None:
        """Pieces of length n to the tightest gaps, then to new sequences."""
        while self.left[n]:
            at = bisect_left(self.gaps, n)
            if at == len(self.gaps):
                per = self.capacity // n
                if self.left[n] >= per:
                    self.fresh(n, self.left[n] // per, per)
                else:
                    self.fresh(n, 1, self.left[n])
                continue
            gap = self.gaps[at]
            first, many = self.runs[gap].pop()
            if not self.runs[gap]:
                del self.runs[gap]
                self.gaps.pop(at)
            per = gap // n
            full = min(many, self.left[n] // per)
            if full:
                self.open(gap, first + full, many - full)
                self.put(n, first, full, per, gap)
            else:
                self.open(gap, first + 1, many - 1)
                self.put(n, first, 1, self.left[n], gap)


def packed(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add sequence_id and offset to pieces that have ``length`` from 1 to ``capacity``.

    The plan sent to the tasks depends on the counts per length only.  Every
    place it lists uses up a length or a run of equal sequences, so the list
    stays within a small multiple of ``capacity`` whatever the input.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    plan = Plan(counts, capacity)
    places = spark.createDataFrame(
        plan.places, "length long, _from long, _to long, _per long, _first long, _at long")
    ranked = slots(pieces, "length", F.xxhash64("doc_id", "piece", "ids_crc32"),
                   [F.col("doc_id"), F.col("piece")], "_r")
    p = F.broadcast(places.withColumnRenamed("length", "_length"))
    return (ranked.join(p, (F.col("length") == F.col("_length")) & (F.col("_r") >= F.col("_from"))
                        & (F.col("_r") < F.col("_to")))
            .withColumn("sequence_id", F.col("_first") + F.expr("(_r - _from) div _per"))
            .withColumn("offset", F.col("_at") + F.expr("(_r - _from) % _per") * F.col("length"))
            .drop("_r", "_length", "_from", "_to", "_per", "_first", "_at"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packed(written(token_pieces(docs, tokenizer_path, capacity), "pieces"), capacity)
