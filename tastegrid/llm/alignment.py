"""Alignment of two tokenizers' tokens over the bytes of each text.

Both tokenizers see a space and the text.  Tokens are rows of incidence matrices
in compressed rows: a token-byte matrix each, whose product A B' links the tokens
that share bytes, and a token-group matrix each, whose product links the tokens of
one group.  A group ends where tokens of both end.  Many texts share one byte axis,
as a text's end ends tokens of both.

The corpus count of an id pair is the number of its links in all texts.  Counts
are summed per task before they are shuffled.  Pairs that hold at least one of
``HOT_PAIRS`` parts of all links, of which there can be no more than
``HOT_PAIRS``, are broadcast; all other pairs are looked up by a join, where none
of them can be hot.

Null and empty texts, and texts that either tokenizer does not give back byte by
byte, have no tokens: zeros and an empty ``groups_sha256``.  Rows that repeat are
counted as often as they occur.  An empty table gives no rows.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.arrays import lists, text_chunks
from tastegrid.llm.byte_bpe import PRE_TOKEN, byte_letters
from tastegrid.llm.incidence import covering, member, product, product_sizes
from tastegrid.llm.tables import keyed, written

CHUNK = 1 << 18
HOT_PAIRS = 1 << 20
FLUSH_PAIRS = 1 << 20
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_shared")
ALIGNED = ("doc_id long, _id long, _key long, " + ", ".join(f"{m} long" for m in MEASURES)
           + ", groups_sha256 string, pairs array<long>, counts array<int>")


class ByteTokens:
    """Ids and token bytes of a byte-level vocabulary; special strings are plain text."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if all(c in letters for c in t)}
        self.strings = [b""] * (max(vocab.values()) + 1)
        for string, i in ranks.items():
            self.strings[i] = string
        # the vocabulary is numbered in the order of its merges, so a lower id merges first
        self.encoding = tiktoken.Encoding("byte-level", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class PieceTokens:
    """Ids and token bytes of a piece vocabulary with byte fallback, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.strings = [
            bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
            else self.model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.model.get_piece_size())]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@dataclass(frozen=True)
class Links:
    """What two token rows over one byte axis have in common."""

    row: np.ndarray     # token of A and of B of every link
    column: np.ndarray
    shared: np.ndarray  # bytes in common
    group_a: np.ndarray  # group of every token
    group_b: np.ndarray
    groups: np.ndarray  # end of every group
    mates: np.ndarray   # tokens of B in the group of every token of A


def linked(ends_a: np.ndarray, ends_b: np.ndarray) -> Links:
    """Links and groups of tokens that end at these bytes; both end at the last byte."""
    row, column, shared = product(covering(ends_a), covering(ends_b).transposed())
    groups = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(groups, ends_a), np.searchsorted(groups, ends_b)
    mates = product_sizes(member(group_a, len(groups)), member(group_b, len(groups)).transposed())
    return Links(row, column, shared, group_a, group_b, groups, mates)


def shared_group_links(found: Links) -> tuple[np.ndarray, np.ndarray]:
    """(token of A, token of B) of one group, for all groups: the square of a group's size."""
    n = len(found.groups)
    row, column, _ = product(member(found.group_a, n), member(found.group_b, n).transposed())
    return row, column


class Aligner:
    """Two tokenizers, their token lengths and the written forms of their ids."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.length_a = np.array([len(s) for s in self.a.strings], dtype=np.int64)
        self.length_b = np.array([len(s) for s in self.b.strings], dtype=np.int64)
        self.width = max(len(self.a.strings), len(self.b.strings))
        self.shown = [b"%d%s" % (i, after) for after in (b",", b"|", b";") for i in range(self.width)]

    def tokens(self, texts: list[str]) -> tuple[list[int], list[list[int]], list[list[int]]]:
        """Which texts have tokens, and the ids of those by either tokenizer."""
        asked = [i for i, t in enumerate(texts) if t]
        some = [texts[i] for i in asked]
        kept: tuple[list, list, list] = ([], [], [])
        for i, text, a, b in zip(asked, some, self.a.ids(some), self.b.ids(some), strict=True):
            whole = b" " + text.encode()
            if (b"".join(map(self.a.strings.__getitem__, a)) == whole
                    and b"".join(map(self.b.strings.__getitem__, b)) == whole):
                for out, x in zip(kept, (i, a, b), strict=True):
                    out.append(x)
        return kept

    def written_groups(self, ids_a: np.ndarray, ids_b: np.ndarray, found: Links) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all tokens in written order, and the code position after every group.

        A code is the id plus ``width`` times what follows it: comma, bar or semicolon.
        """
        n = len(found.groups)
        size_a, size_b = np.bincount(found.group_a, minlength=n), np.bincount(found.group_b, minlength=n)
        upto_a, upto_b = np.cumsum(size_a), np.cumsum(size_b)
        codes = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        after = np.zeros(len(ids_a), dtype=np.int64)
        after[upto_a - 1] = 1
        codes[np.arange(len(ids_a)) + (upto_b - size_b)[found.group_a]] = ids_a + self.width * after
        after = np.zeros(len(ids_b), dtype=np.int64)
        after[upto_b - 1] = 2
        codes[np.arange(len(ids_b)) + upto_a[found.group_b]] = ids_b + self.width * after
        return codes, upto_a + upto_b

    def measured(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Measures by text, group digests, and (pairs, their links, how many pairs by text)."""
        n = len(texts)
        measures, digests = np.zeros((len(MEASURES), n), dtype=np.int64), [""] * n
        which, rows_a, rows_b = self.tokens(texts)
        if not which:
            return measures, digests, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n, np.int64)
        docs = np.array(which)
        ids_a, ids_b = (np.fromiter((i for r in rows for i in r), np.int64) for rows in (rows_a, rows_b))
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        found = linked(ends_a, ends_b)
        last_a = np.cumsum([len(r) for r in rows_a])
        last_b = np.cumsum([len(r) for r in rows_b])
        group_end = found.group_a[last_a - 1] + 1
        doc_of_a = np.repeat(np.arange(len(docs)), np.diff(last_a, prepend=0))
        doc = doc_of_a[found.row]
        measures[0, docs], measures[1, docs] = np.diff(last_a, prepend=0), np.diff(last_b, prepend=0)
        measures[2, docs] = np.diff(group_end, prepend=0)
        measures[3, docs] = np.bincount(doc, minlength=len(docs))
        measures[4, docs] = np.add.reduceat(found.mates, last_a - measures[0, docs])
        codes, upto = self.written_groups(ids_a, ids_b, found)
        at = 0
        for i, end in zip(which, upto[group_end - 1].tolist(), strict=True):
            row = b"".join(map(self.shown.__getitem__, codes[at:end].tolist()))
            digests[i], at = hashlib.sha256(row[:-1]).hexdigest(), end
        pairs = len(self.a.strings) * len(self.b.strings)
        pair = ids_a[found.row] * len(self.b.strings) + ids_b[found.column]
        cells, links = np.unique(doc * pairs + pair, return_counts=True)
        sizes = np.zeros(n, dtype=np.int64)
        sizes[docs] = np.bincount(cells // pairs, minlength=len(docs))
        return measures, digests, cells % pairs, links, sizes


def aligned_texts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: measures, group digest, its distinct id pairs and their links."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing kept has cycles
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            column = batch.column(3)
            for first, end, _, _ in text_chunks(column, CHUNK):
                texts = [t or "" for t in column.slice(first, end - first).to_pylist()]
                measures, digests, pairs, links, sizes = aligner.measured(texts)
                ids = [c.slice(first, end - first) for c in batch.columns[:3]]
                yield pa.RecordBatch.from_arrays(
                    [*ids, *(pa.array(m) for m in measures), pa.array(digests, pa.string()),
                     lists(pairs, sizes, pa.int64()), lists(links.astype(np.int32), sizes, pa.int32())],
                    ["doc_id", "_id", "_key", *MEASURES, "groups_sha256", "pairs", "counts"])
        del aligner
        gc.enable()
        gc.collect()

    return (keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "_id", "_key", "text")
            .mapInArrow(rows, ALIGNED))


def _summed(pairs: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links added up per pair."""
    order = np.argsort(pairs, kind="stable")
    pairs, links = pairs[order], links[order]
    heads = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    return pairs[heads], np.add.reduceat(links, heads) if len(heads) else links


def _entries(batch: pa.RecordBatch, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and links of a batch's rows, and the number of pairs in every row."""
    pairs, links = batch.column(first), batch.column(first + 1)
    return (pairs.flatten().to_numpy(zero_copy_only=False),
            links.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            np.diff(pairs.offsets.to_numpy()).astype(np.int64))


def per_row(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over consecutive stretches of these sizes."""
    ends = np.cumsum(sizes)
    upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return upto[ends] - upto[ends - sizes]


def pair_counts(aligned: DataFrame, tokens_b: int) -> DataFrame:
    """(pair, n, best): links of every id pair in the corpus, and whether no other pair of its B id has more.

    An id of B meets at most as many pairs as A has ids, whatever the corpus.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, more, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0

        def merged():
            return _summed(*(np.concatenate([held[k], *[m[k] for m in more]]) for k in (0, 1)))

        def out(pairs, links):
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(links)], ["pair", "n"])

        for batch in batches:
            pairs, links, _ = _entries(batch, 0)
            more.append((pairs, links))
            size += len(pairs)
            if size >= FLUSH_PAIRS:
                held, more, size = merged(), [], 0
                if len(held[0]) >= FLUSH_PAIRS:
                    yield out(*held)
                    held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        yield out(*merged())

    sums = (aligned.select("pairs", "counts").mapInArrow(partial, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))
    sums = written(sums.withColumn("b", F.col("pair") % tokens_b), "pair-links")
    most = sums.groupBy("b").agg(F.max("n").alias("most"))
    return sums.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_shared of every document."""
    spark = docs.sparkSession
    aligned = written(aligned_texts(docs, path_a, path_b), "aligned")
    counts = written(pair_counts(aligned, len(PieceTokens(path_b).strings)), "pair-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # at most hot_pairs pairs can hold one of hot_pairs parts of the links each
    least = -(-total // hot_pairs)
    hot = counts.where(F.col("n") >= least).toArrow().sort_by("pair")
    table = spark.sparkContext.broadcast(tuple(hot.column(c).to_numpy() for c in ("pair", "n", "best")))
    found = ["n_best", "count_sum"]
    names = ["doc_id", "_id", "_key", *MEASURES, "groups_sha256"]

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = table.value
        for batch in batches:
            pairs, links, sizes = _entries(batch, len(names))
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            seen, at = np.where(known, links, 0), np.where(known, at, 0)
            sums = [per_row(seen * c[at] if len(keys) else seen, sizes) for c in (best, n)]
            left = per_row(~known, sizes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], *map(pa.array, sums), lists(pairs[~known], left, pa.int64()),
                 lists(links[~known].astype(np.int32), left, pa.int32())], [*names, *found, "pairs", "counts"])

    schema = ALIGNED.replace(", pairs", ", n_best long, count_sum long, pairs")
    partly = written(aligned.select(*names, "pairs", "counts").mapInArrow(looked_up, schema), "partly-counted")
    rest = (partly.where(F.size("pairs") > 0).select("_id", "_key", "pairs", "counts")
            .dropDuplicates(["_id", "_key"])
            .select("_id", "_key", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("links")))))
    rare = counts.where(F.col("n") < least)
    more = (rest.join(rare, "pair").groupBy("_id", "_key")
            .agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("_best"),
                 F.sum(F.col("links") * F.col("n")).alias("_sum")))
    full = partly.drop("pairs", "counts").join(more, ["_id", "_key"], "left")
    return full.select("doc_id", *MEASURES[:4], (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
                       (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
                       "n_shared")
