"""Positional document fingerprints from closed syncmers.

A window of ``k`` tokens is a closed syncmer when the smallest hash among its
inner runs of ``s`` tokens is the first or the last of them.  The choice depends
on the window alone, not on what stands around it, so an edit changes only the
anchors it touches.  A fingerprint holds the ``keep`` anchors with the smallest
hashes, each with its place.  Likeness counts anchors that both fingerprints
hold within ``shift`` tokens of each other among the smallest of their union,
as 2 j / (1 + j) for the share j, from 0 to 1.

Tokens are words; texts of up to ``short`` characters also get anchors over
their characters, and two texts that both have those are compared by them.
Texts with fewer tokens than a window have all inner runs as anchors, or if
there are none the whole text; empty texts have no anchor, and are like each
other only.

Only DataFrame expressions are used.  Null text is empty and null doc_id comes
last in descending order; repeated rows have fingerprints of their own.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.llm.tables import LAST_ID

RANGES = 4096
SHORT = 512
KEEP = 64
SHIFT = 64


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def code(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 32)


def syncmers(tokens: Column, k: int, s: int, keep: int = KEEP) -> Column:
    """Array of (hash, place) of the anchors with the smallest hashes, smallest first."""
    def of_inner(tokens: Column) -> Column:
        n = F.size(tokens)
        if s == 1:
            inner = F.transform(tokens, lambda w: F.xxhash64(w))
        else:
            inner = F.transform(F.sequence(F.lit(1), n - s + 1), lambda i: F.xxhash64(F.slice(tokens, i, s)))
        return bound(inner, lambda h: F.when(F.size(h) <= k - s, F.transform(
            h, lambda x, i: F.struct(code(x).alias("h"), i.alias("at")))).otherwise(anchors(h)))

    def whole(tokens: Column) -> Column:
        return F.struct(code(F.xxhash64(tokens)).alias("h"), F.lit(0).alias("at"))

    def anchors(h: Column) -> Column:
        span = k - s
        found = F.transform(h, lambda x, i: closed(h, x, i, span))
        return F.filter(found, lambda a: a.isNotNull())

    def closed(h: Column, x: Column, i: Column, span: int) -> Column:
        last = F.get(h, i + span)
        least = F.least(x, *(F.get(h, i + j) for j in range(1, span + 1)))
        anchor = code(F.xxhash64(x, *(F.get(h, i + j) for j in range(1, span + 1))))
        return F.when(last.isNotNull() & ((x == least) | (last == least)),
                      F.struct(anchor.alias("h"), i.alias("at")))

    chosen = bound(tokens, lambda t: F.when(F.size(t) < s, F.when(F.size(t) > 0, F.array(whole(t))).otherwise(
        F.array().cast("array<struct<h:bigint,at:int>>"))).otherwise(of_inner(t)))
    places = bound(F.array_sort(chosen), lambda c: F.filter(
        c, lambda a, i: (i == 0) | (F.get(c, i - 1)["h"] != a["h"])))  # the first place of each hash
    return F.slice(places, 1, keep)


def anchors_of(text: Column) -> Column:
    """Struct of the word anchors and, for short texts, the character anchors."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chars = F.filter(F.split(F.when(F.char_length(text) <= SHORT, text), ""), lambda c: c != "")
    return F.struct(syncmers(words, 3, 1).alias("words"), syncmers(chars, 8, 3).alias("chars"))


def shown(anchors: Column) -> Column:
    """The fingerprint as text: hash:place of each anchor, words before characters."""
    def part(name: str) -> Column:
        return F.concat_ws(" ", F.transform(anchors[name], lambda a: F.concat_ws(
            ":", F.hex(a["h"]), a["at"].cast("string"))))
    return F.concat(part("words"), F.coalesce(F.concat(F.lit("|"), part("chars")), F.lit("")))


def likeness(x: Column, y: Column) -> Column:
    """Likeness of two anchor structs."""
    def alike(x: Column, y: Column) -> Column:
        hx, hy = F.transform(x, lambda a: a["h"]), F.transform(y, lambda a: a["h"])
        smallest = F.slice(F.array_sort(F.array_union(hx, hy)), 1, KEEP)
        both = bound(F.array_intersect(hx, hy), lambda c: F.filter(
            x, lambda a: F.array_contains(c, a["h"]) & F.exists(
                y, lambda b: (a["h"] == b["h"]) & (F.abs(a["at"] - b["at"]) <= SHIFT))))
        hit = F.size(F.array_intersect(F.transform(both, lambda a: a["h"]), smallest))
        share = hit / F.greatest(F.size(smallest), F.lit(1))
        return (F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(1.0))
                .otherwise(share * 2 / (share + 1)))

    short = x["chars"].isNotNull() & y["chars"].isNotNull()
    return F.when(short, alike(x["chars"], y["chars"])).otherwise(alike(x["words"], y["words"]))


def ranged(rows: DataFrame, parts: int = RANGES) -> DataFrame:
    """Add ``_range``: ranges of near equal row counts, larger for larger doc_ids and then for smaller text hashes.

    Cuts are approximate quantiles of the ids, about the root of the number of
    rows and at most ``parts``.  An id that fills whole ranges by itself, and null,
    are cut further by the hash of the text.
    """
    n, nulls = rows.agg(F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull())).first()
    parts = max(1, min(parts, int(n ** 0.5)))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5],
                                        10 * parts)).first()[0] or []
    hot = {v: c for v, c in Counter(cuts).items() if c > 1}
    edges = sorted(set(cuts) | {v + 1 for v in hot if v < LAST_ID})
    edge_list = F.array(*map(F.lit, edges)).cast("array<long>")
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(edges).bit_length()))))  # a binary search
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(edge_list, at + step - 1) <= F.col("doc_id"), at + step).otherwise(at))
    split = F.when(F.col("doc_id").isNull(), F.lit(-(-nulls * parts // max(n, 1))))
    if hot:
        parts_of = F.create_map(*(F.lit(x).cast("long") for kv in hot.items() for x in kv))
        split = F.coalesce(split, F.try_element_at(parts_of, F.col("doc_id")))
    # the upper 31 bits of the hash, from the smallest up
    upper = F.shiftright(F.xxhash64("text"), 33) + F.lit(1 << 30)
    inner = F.shiftright(upper * F.coalesce(split, F.lit(1)), 31)
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(place)
    return rows.withColumn("_range", bucket.cast("long") * (2 * RANGES) - inner)


def with_next(rows: DataFrame, columns: tuple[str, ...], make, parts: int = RANGES) -> DataFrame:
    """``make(rows)`` with ``next_*`` columns of the row with the next smaller doc_id.

    After the smallest id comes the largest.  Each range of ids is a window of
    its own, and its last row takes what follows it from a table of the ranges'
    first rows, of which there are a few times ``parts`` at most.
    """
    cut = ranged(rows, parts)
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    marked = make(cut).withColumn("_next", F.lead(F.struct(*columns)).over(
        Window.partitionBy("_range").orderBy(*order)))
    heads = cut.groupBy("_range").agg(F.max("doc_id").alias("_top"))
    ring = Window.orderBy(F.col("_range").desc())  # one short row per range
    heads = heads.select("_range", "_top", F.lag("_range").over(ring).alias("_before"),
                         F.min("_range").over(Window.partitionBy()).alias("_lowest"))
    heads = heads.select("_range", "_top", F.coalesce("_before", "_lowest").alias("_before"))
    first = cut.join(F.broadcast(heads), "_range").where(F.col("doc_id").eqNullSafe(F.col("_top")))
    first = first.withColumn("_n", F.row_number().over(Window.partitionBy("_before").orderBy(F.xxhash64("text"))))
    after = make(first.where("_n = 1").drop("_n", "_top", "_range")).select(
        F.col("_before").alias("_range"), F.struct(*columns).alias("_head"))
    joined = marked.join(after, "_range", "left").withColumn("_next", F.coalesce("_next", "_head"))
    return joined.select("*", *(F.col(f"_next.{c}").alias(f"next_{c}") for c in columns)).drop(
        "_next", "_head", "_range")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprints of each text and of its edited text, and their likenesses.

    The edited text has the last third of the code points replaced by the first
    ones of the next document in descending doc_id.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    pairs = with_next(rows, ("text", "own"), lambda df: df.withColumn("own", anchors_of(F.col("text"))))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third),
                      F.substring(F.col("next_text"), F.lit(1), third))
    out = pairs.select("doc_id", "own", "next_own", n.cast("long").alias("n_chars"), bound(
        edited, lambda t: F.struct(F.sha2(t, 256).alias("sha"), anchors_of(t).alias("anchors"))).alias("e"))
    return out.select("doc_id", "n_chars", F.col("e.sha").alias("edited_sha256"),
                      shown(F.col("own")).alias("fingerprint"),
                      shown(F.col("e.anchors")).alias("edited_fingerprint"),
                      likeness(F.col("own"), F.col("e.anchors")).alias("near_edited"),
                      likeness(F.col("own"), F.col("next_own")).alias("near_next"))
