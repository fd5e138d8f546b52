"""Scores of factor models, block by block: the best items per user, and ranks of given items (RC10, RC14).

A factor table is (id, vec); the score of a user and an item is the product of
their vectors.  Items are cut into blocks by falling length of their vectors, users
into blocks by hash, and a pair of blocks is one task's work: matrix products of at
most ``CELLS`` scores at a time, so wide blocks, which travel less often, take no
more memory.  Only the ``k`` best of each user and block leave a task; no table of all users
times all items is ever made.

Score ties go by item id, in the order of its text form for text and of numbers
for numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.ranking import top_k_per_group
from tastegrid.session import task_slots

BLOCK_ITEMS = 131_072
BLOCK_USERS = 131_072
LEAST_USERS = 512  # blocks of users are not cut finer than this to occupy all tasks
CELLS = 1 << 20
TILE_ITEMS, TILE_USERS = 8_192, 64  # a tile of single-precision scores stays near its core, in one place of memory
LANES = 128  # so many marks can be added up byte by byte, eight at once
WHOLE = 2.0 ** 22  # products of whole numbers up to here are exact in single precision, halves between them too
CLOSE_SHARE = 64  # where more than one score in so many is too close to tell in single precision, all are doubles
TEST_ITEMS = 1_024
MANY = 24  # from so many test items of a user on, one sort is cheaper than a pass for each
DIGITS = 9  # scores are compared rounded, so that the order of a sum does not show


def length(vec: str | Column) -> Column:
    """Euclidean length of a vector."""
    return F.sqrt(F.aggregate(F.col(vec) if isinstance(vec, str) else vec, F.lit(0.0), lambda a, x: a + x * x))


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def item_blocks(items: DataFrame, item: str, block_items: int = BLOCK_ITEMS) -> tuple[DataFrame, list[float]]:
    """(item, vec, ib) and the greatest length in each block, falling from block 0 on.

    The cuts are quantiles of the lengths, one number per block.  Where many
    items have one length, their block is cut further by hash.
    """
    sized = items.select(item, F.col("vec").cast("array<double>").alias("vec")).withColumn("_len", length("vec"))
    blocks = max(1, math.ceil(items.count() / block_items))
    cuts = sorted(set(sized.approxQuantile("_len", [i / blocks for i in range(1, blocks)], 0.1 / blocks)), reverse=True) \
        if blocks > 1 else []
    coarse = sized.withColumn("_coarse", F.size(F.filter(F.lit(cuts).cast("array<double>"), lambda c: c > F.col("_len"))))
    sizes = (coarse.groupBy("_coarse").agg(F.count(F.lit(1)).alias("n"), F.max("_len").alias("most"))
             .orderBy("_coarse").collect())
    first, parts, most = {}, {}, []
    for row in sizes:
        first[row["_coarse"]], parts[row["_coarse"]] = len(most), math.ceil(row["n"] / block_items)
        most += [row["most"]] * parts[row["_coarse"]]
    if not sizes:
        return coarse.select(item, "vec", F.lit(0).alias("ib")), []
    of = lambda table: F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.col("_coarse")]
    fine = of(first) + F.pmod(F.xxhash64(item), of(parts)).cast("int")
    return coarse.select(item, "vec", fine.alias("ib")), most


def in_block_pairs(users: DataFrame, items: DataFrame, user: str, item: str, work: Callable, schema: str,
                   block_users: int = BLOCK_USERS, blocks: int = 1) -> DataFrame:
    """Run ``work(user rows, item rows)`` on every pair of blocks that meet.

    ``users`` has one row per user and item block it asks for, with ``ib``; the
    users of an item block are cut by hash into parts of about ``block_users``, or
    smaller ones where the ``blocks`` of items are too few to occupy all tasks.
    """
    rows = F.count(F.lit(1))
    least = -(-2 * task_slots(users.sparkSession) // max(1, blocks))
    parts = users.groupBy("ib").agg(F.greatest(F.ceil(rows / block_users), F.least(F.ceil(rows / LEAST_USERS), F.lit(least)))
                                    .cast("int").alias("_parts"))
    left = users.join(F.broadcast(parts), "ib").withColumn("ub", F.pmod(F.xxhash64(user), F.col("_parts")).cast("int"))
    right = items.join(F.broadcast(parts), "ib").withColumn("ub", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return (left.drop("_parts").groupBy("ib", "ub").cogroup(right.drop("_parts").groupBy("ib", "ub"))
            .applyInArrow(lambda a, b: work(a, b), schema))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as the rows of a matrix."""
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(np.float64)


def in_chunks(rows: int, columns: int, cells: int | None = None) -> Iterator[slice]:
    """Slices of rows of which each has about ``cells`` numbers."""
    step = max(1, (CELLS if cells is None else cells) // max(1, columns))
    return (slice(at, min(at + step, rows)) for at in range(0, rows, step))


def _best_places(scores: np.ndarray, bar: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, rounded score) of the ``k`` best of each row, ties by column; none below the row's ``bar``."""
    rows, columns = scores.shape
    # the k-th of the greatest scores of stretches is reached by k scores at least
    cuts = np.arange(0, columns, max(1, columns // max(4 * k, 256)))
    if k < len(cuts):
        low = np.partition(np.maximum.reduceat(scores, cuts, axis=1), len(cuts) - k, axis=1)[:, len(cuts) - k]
        bar = np.maximum(bar, low)
    row, column = np.nonzero(scores >= (bar - 2 * 10.0 ** -DIGITS)[:, None])
    value = np.round(scores[row, column], DIGITS)
    real = value > -np.inf
    row, column, value = row[real], column[real], value[real]
    # items come in the order of ties, and a stable sort keeps it
    order = np.lexsort((-value, row))
    row, column, value = row[order], column[order], value[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k], value[place < k]


def _best(user: str, item: str, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by(item)
        names = [user, item, "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table({user: left[user].slice(0, 0), item: right[item].slice(0, 0),
                             "score": pa.array([], pa.float64())})
        users, items = matrix(left["vec"]), matrix(right["vec"])
        bar = left["_bar"].to_numpy() if "_bar" in left.column_names else np.full(len(users), -np.inf)
        seen = left["seen"].combine_chunks()
        at = pc.index_in(seen.flatten(), value_set=right[item].combine_chunks())
        hidden = at.is_valid().to_numpy(zero_copy_only=False)
        who = np.repeat(np.arange(len(users)), pc.list_value_length(seen).to_numpy())[hidden]
        at = at.drop_null().to_numpy()
        tiles = Tiles(users, items)
        found = []
        # beyond single precision all scores are doubles
        groups = (slice(first, first + TILE_USERS) for first in range(0, len(users), TILE_USERS)) if tiles.fit \
            else in_chunks(len(users), len(items))
        for part in groups:
            of = slice(*np.searchsorted(who, [part.start, part.stop]))
            mine = who[of] - part.start, at[of]
            if tiles.fit:
                row, column, value = _best_of_tiles(tiles, part, bar[part], *mine, k)
            else:
                scores = users[part] @ items.T
                scores[mine] = -np.inf
                row, column, value = _best_places(scores, bar[part], k)
            found.append((row + part.start, column, value))
        row, column, value = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table([left[user].take(pa.array(row)), right[item].take(pa.array(column)), pa.array(value)], names=names)
    return best


class Tiles:
    """Scores of users and items in single precision, tile by tile, and how far each user's can be off.

    Products of whole numbers are exact as long as none is over ``WHOLE``.
    """

    def __init__(self, users: np.ndarray, items: np.ndarray):
        self.users, self.items = users, items
        lengths = np.sqrt(np.einsum("ij,ij->i", users, users))
        longest = np.sqrt(np.einsum("ij,ij->i", items, items).max())
        most = max(lengths.max(), 1.0) * max(longest, 1.0)
        self.fit = bool(most < 1e30)  # else beyond single precision, or no number
        if not self.fit:
            return
        self.whole = bool(most < WHOLE and (users == np.rint(users)).all() and (items == np.rint(items)).all())
        # no sum of rounded products is farther off than this
        self.slack = (users.shape[1] + 4) * 2.0 ** -24 * lengths * longest + 0.5 * 10.0 ** -DIGITS
        self.small = users.astype(np.float32)
        self.tiles = [(begin, np.ascontiguousarray(items[begin:begin + TILE_ITEMS].T, dtype=np.float32))
                      for begin in range(0, len(items), TILE_ITEMS)]
        self._scores = np.empty((TILE_USERS, TILE_ITEMS), dtype=np.float32)
        self._masks = np.zeros((TILE_USERS, -(-TILE_ITEMS // (8 * LANES)) * 8 * LANES), dtype=bool)

    def of(self, users: np.ndarray | slice) -> Iterator[tuple[int, np.ndarray]]:
        """(first item, scores) of every tile; the scores hold until the next tile."""
        small = self.small[users]
        for begin, tile in self.tiles:
            yield begin, np.matmul(small, tile, out=self._scores[:len(small), :tile.shape[1]])

    def over(self, scores: np.ndarray, bars: np.ndarray) -> np.ndarray:
        """Which scores are over the bar of their row, with nothing behind them."""
        rows, columns = scores.shape
        self._masks[:rows, columns:] = False
        np.greater(scores, bars[:, None], out=self._masks[:rows, :columns])
        return self._masks[:rows]


def _counted(mask: np.ndarray) -> np.ndarray:
    """How many marks each row has."""
    lanes = mask.view(np.uint64).reshape(len(mask), -1, LANES).sum(axis=2)
    return lanes.view(np.uint8).sum(axis=1, dtype=np.int64)


def _downward(bars: np.ndarray) -> np.ndarray:
    """In single precision, and no higher; the least number stays."""
    least = np.finfo(np.float32).min
    return np.nextafter(np.maximum(bars, least).astype(np.float32), least)


def _best_of_tiles(tiles: Tiles, part: slice, bar: np.ndarray, hidden: np.ndarray, at: np.ndarray,
                   k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_best_places`` of the users ``part``, without the ``hidden`` users' items ``at``.

    What a user has found so far is the bar for the next tile.  Candidates by
    single precision are scored again in doubles.
    """
    users, slack = tiles.users[part], tiles.slack[part]
    least = np.finfo(np.float32).min
    # a score from elsewhere may be met, one found here before must be passed
    floor = bar - (0.5 if tiles.whole else slack + 10.0 ** -DIGITS)
    floor = np.where(floor > least, floor, least)
    order = np.argsort(at, kind="stable")
    hidden, at = hidden[order], at[order]
    row, column, value = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for begin, scores in tiles.of(part):
        columns = scores.shape[1]
        of = slice(*np.searchsorted(at, [begin, begin + columns]))
        scores[hidden[of], at[of] - begin] = -np.inf
        rows = np.flatnonzero(scores.max(axis=1) > _downward(floor))
        if not len(rows):
            continue
        near, low = scores[rows], floor[rows].copy()
        # the k-th of the greatest scores of stretches is reached by k scores at least
        cuts, fresh = np.arange(0, columns, max(1, columns // max(4 * k, 256))), np.flatnonzero(low == least)
        if k < len(cuts) and len(fresh):
            reached = np.partition(np.maximum.reduceat(near[fresh], cuts, axis=1), len(cuts) - k, axis=1)[:, len(cuts) - k]
            low[fresh] = np.maximum(least, reached - (0.5 if tiles.whole else 2 * slack[rows[fresh]] + 10.0 ** -DIGITS))
        r, c = np.divmod(np.flatnonzero(near > _downward(low)[:, None]), columns)
        score = np.round(np.einsum("ij,ij->i", users[rows[r]], tiles.items[begin + c]), DIGITS)
        again = np.zeros(len(users), dtype=bool)
        again[rows] = True
        again = again[row]
        who = np.concatenate([row[again], rows[r]])
        where = np.concatenate([column[again], begin + c])
        score = np.concatenate([value[again], score])
        # items come in the order of ties, and a stable sort keeps it
        by = np.lexsort((-score, who))
        who, where, score = who[by], where[by], score[by]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        last = place == k - 1
        floor[who[last]] = np.maximum(floor[who[last]], score[last] + (0.5 if tiles.whole else -slack[who[last]] - 10.0 ** -DIGITS))
        row, column, value = (np.concatenate([old[~again], new[place < k]])
                              for old, new in ((row, who), (column, where), (value, score)))
    by = np.lexsort((column, -value, row))
    return row[by], column[by], value[by]


def top_scores(users: DataFrame, items: DataFrame, user: str, item: str, k: int, seen: DataFrame | None = None,
               block_items: int = BLOCK_ITEMS, block_users: int = BLOCK_USERS) -> DataFrame:
    """(user, pos, item, score): the ``k`` best unseen items of each user over all items.

    A first pass takes the block of the longest item vectors.  The score of any
    item is at most the product of the lengths, so a user asks only for further
    blocks where that can still reach the user's k-th score.  ``seen`` holds
    (user, item); a user with fewer than ``k`` unseen items gets them all.
    Users are asked for once each; null ids take no part.
    """
    blocked, most = item_blocks(items.where(F.col(item).isNotNull()), item, block_items)
    asked = (users.where(F.col(user).isNotNull()).dropDuplicates([user])
             .select(user, F.col("vec").cast("array<double>").alias("vec")))
    types = dict(items.dtypes)
    schema = f"{user} {dict(users.dtypes)[user]}, {item} {types[item]}, score double"
    rows = needed_blocks(asked, None, user, most, k)
    first = _ask(rows.where("ib = 0"), blocked, user, item, k, seen, schema, block_users, 1)
    if len(most) > 1:
        from tastegrid.operators.stored import written
        first = written(first, "first-block")
        rest = needed_blocks(asked, first, user, most, k).where("ib > 0")
        first = first.unionByName(_ask(rest, blocked, user, item, k, seen, schema, block_users, len(most) - 1))
    best = top_k_per_group(first, user, [F.desc("score"), F.asc(item)], k)
    return best.select(user, F.col("pos").cast("int").alias("pos"), item, "score")


def needed_blocks(asked: DataFrame, found: DataFrame | None, user: str, most: list[float], k: int) -> DataFrame:
    """(user, vec, _bar, ib): the blocks that can still hold one of a user's ``k`` best items, and what these must reach."""
    if found is None:
        bar = asked.withColumn("_bar", F.lit(float("-inf")))
    else:
        reached = found.groupBy(user).agg(F.min("score").alias("_low"), F.count(F.lit(1)).alias("_n"))
        bar = (asked.join(reached, user, "left")
               .withColumn("_bar", F.when(F.col("_n") >= k, F.col("_low")).otherwise(F.lit(float("-inf")))))
    # lengths fall from block to block, so what is needed is a run of blocks from the first on
    edges = F.lit([float(m) for m in most]).cast("array<double>")
    slack = F.lit(10.0 ** -DIGITS)
    count = F.size(F.filter(edges, lambda m: m * F.col("_len") + slack >= F.col("_bar")))
    return (bar.withColumn("_len", length("vec")).withColumn("_blocks", count).where("_blocks > 0")
            .select(user, "vec", "_bar", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("ib")))


def _ask(rows: DataFrame, blocked: DataFrame, user: str, item: str, k: int, seen: DataFrame | None, schema: str,
         block_users: int, blocks: int = 1) -> DataFrame:
    """The ``k`` best unseen items of every (user, block) row."""
    if seen is None:
        rows = rows.withColumn("seen", F.array().cast(f"array<{dict(blocked.dtypes)[item]}>"))
    else:  # a user's seen items, block by block
        hidden = (seen.select(user, item).join(blocked.select(item, "ib"), item)
                  .groupBy(user, "ib").agg(F.collect_set(item).alias("seen")))
        rows = rows.join(hidden, [user, "ib"], "left").withColumn(
            "seen", F.coalesce("seen", F.array().cast(f"array<{dict(blocked.dtypes)[item]}>")))
    return in_block_pairs(rows, blocked, user, item, _best(user, item, k), schema, block_users, blocks)


def _above(scores: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
    """How many scores, rounded, are over each of ``at``, or equal to it and before its ``place``."""
    half = 0.5 * 10.0 ** -DIGITS
    if len(at) < MANY:
        return np.array([np.count_nonzero(scores[:p] >= v - half) + np.count_nonzero(scores[p:] > v + half)
                         for v, p in zip(at, place, strict=True)], dtype=np.int64)
    line = np.sort(scores)
    over = len(line) - np.searchsorted(line, at + half, side="right")
    tied = np.flatnonzero(len(line) - np.searchsorted(line, at - half, side="left") > over)
    over[tied] += [np.count_nonzero(np.abs(scores[:place[t]] - at[t]) <= half) for t in tied]
    return over


def _many_above(users: np.ndarray, items: np.ndarray, at: np.ndarray, place: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``_above`` of every user's own stretch of ``at`` and ``place``, over all items.

    Scores are formed in single precision, tile by tile.  One that is nearer to a
    test item's than rounding allows to tell is formed again in double precision.
    Whole numbers are exact in both.  Where many are near otherwise, the rest is
    done in doubles.
    """
    n_above = np.zeros(len(at), dtype=np.int64)
    tiles = Tiles(users, items)
    done = _surely_above(n_above, tiles, at, place, offsets) if tiles.fit else 0
    turned = items.T
    for part in in_chunks(len(users) - done, len(items)):
        part = slice(part.start + done, part.stop + done)
        scores = users[part] @ turned
        for line, begin, end in zip(scores, offsets[part.start:part.stop], offsets[part.start + 1:part.stop + 1], strict=True):
            n_above[begin:end] = _above(line, at[begin:end], place[begin:end])
    return n_above


def _surely_above(n_above: np.ndarray, tiles: Tiles, at: np.ndarray, place: np.ndarray, offsets: np.ndarray) -> int:
    """Fill ``n_above`` by single precision for as many users as that pays for, and give their number."""
    half = 0.5 * 10.0 ** -DIGITS
    users, items = tiles.users, tiles.items
    gap = np.repeat(tiles.slack, np.diff(offsets))
    low, high = (np.nextafter((at + g).astype(np.float32), np.float32(to)) for g, to in ((-gap, -np.inf), (gap, np.inf)))
    for first in range(0, len(users), TILE_USERS):
        last = min(first + TILE_USERS, len(users))
        asked = slice(offsets[first], offsets[last])
        sizes = np.diff(offsets[first:last + 1])
        # the users of few test items first, those of most of them in front: a turn compares one item of each at once
        few = sizes < MANY
        rows = np.lexsort((-sizes, ~few)) + first
        turns = [offsets[rows[:n]] + t for t in range(sizes[few].max(initial=0)) if (n := np.count_nonzero(few & (sizes > t)))]
        many = [(i, slice(offsets[u], offsets[u + 1])) for i, u in enumerate(rows) if not few[u - first]]
        near, close, compared = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0, 0
        for begin, scores in tiles.of(rows):
            columns = scores.shape[1]
            if tiles.whole:
                _whole_above(n_above, tiles, scores, at, place - begin, turns, many)
                continue
            compared += columns * (asked.stop - asked.start)
            for tests in turns:
                sure = _counted(tiles.over(scores[:len(tests)], high[tests]))
                n_above[tests] += sure
                maybe = tiles.over(scores[:len(tests)], low[tests])
                rows_near = np.flatnonzero(_counted(maybe) > sure)
                if len(rows_near):
                    between = maybe[rows_near, :columns]
                    between &= scores[rows_near] <= high[tests[rows_near], None]
                    i, items_near = np.divmod(np.flatnonzero(between), columns)
                    near.append((tests[rows_near[i]], items_near + begin))
                    close += len(items_near)
            for i, mine in many:  # one sort counts for all, and tells which have a score too near
                line = scores[i]
                ordered = np.sort(line)
                upto = np.searchsorted(ordered, high[mine], side="right")
                n_above[mine] += len(line) - upto
                for t in mine.start + np.flatnonzero(np.searchsorted(ordered, low[mine], side="right") < upto):
                    items_near = np.flatnonzero((line > low[t]) & ~(line > high[t]))
                    near.append((np.full(len(items_near), t), items_near + begin))
                    close += len(items_near)
            if close > min(CELLS, compared // CLOSE_SHARE):
                n_above[asked] = 0
                return first
        t, at_item = (np.concatenate(x) for x in zip(*near, strict=True))
        user = np.searchsorted(offsets, t, side="right") - 1
        scores = np.einsum("ij,ij->i", users[user], items[at_item])
        stands = np.where(at_item < place[t], scores >= at[t] - half, scores > at[t] + half)
        n_above[asked] += np.bincount(t[stands] - asked.start, minlength=asked.stop - asked.start)
    return len(users)


def _whole_above(n_above: np.ndarray, tiles: Tiles, scores: np.ndarray, at: np.ndarray, place: np.ndarray,
                 turns: list[np.ndarray], many: list[tuple[int, slice]]) -> None:
    """Add what stands above in a tile of exact scores; ``place`` counts from its first item."""
    columns = scores.shape[1]
    for tests in turns:
        # an equal score stands above where the whole tile comes before the test item
        found = _counted(tiles.over(scores[:len(tests)], (at[tests] + np.where(place[tests] >= columns, -0.5, 0.5)).astype(np.float32)))
        for i in np.flatnonzero((place[tests] > 0) & (place[tests] < columns)):
            found[i] += np.count_nonzero(scores[i, :place[tests[i]]] == np.float32(at[tests[i]]))
        n_above[tests] += found
    for i, mine in many:
        n_above[mine] += _above(scores[i], at[mine], np.clip(place[mine], 0, columns))


def ranks_among_all(users: DataFrame, items: DataFrame, test: DataFrame, user: str, item: str,
                    block_items: int = BLOCK_ITEMS, block_users: int = BLOCK_USERS) -> DataFrame:
    """(user, item, rank, n): the place of each test pair among all items scored for the user.

    Pairs of an unknown user or item have a null rank.  Tasks count the items
    that stand above a test item and return one number per pair and block.
    """
    blocked, most = item_blocks(items.where(F.col(item).isNotNull()), item, block_items)
    n = items.where(F.col(item).isNotNull()).count()
    pairs = test.select(user, item).distinct()
    known = (pairs.join(users.select(user, F.col("vec").alias("_u")), user)
             .join(items.select(item, F.col("vec").alias("_i")), item)
             .select(user, item, F.round(dot("_u", "_i"), DIGITS).alias("score")))
    # a user's test items travel in lists of bounded length
    parts = known.groupBy(user).agg(F.ceil(F.count(F.lit(1)) / TEST_ITEMS).alias("_parts"))
    lists = (known.join(parts, user).groupBy(user, F.pmod(F.xxhash64(item), F.col("_parts")).alias("_part"))
             .agg(F.sort_array(F.collect_list(F.struct("score", item))).alias("asked")))
    rows = (users.select(user, F.col("vec").cast("array<double>").alias("vec")).join(lists, user)
            .select(user, "vec", F.col("asked.score").alias("at"), F.col(f"asked.{item}").alias("of"),
                    F.explode(F.sequence(F.lit(0), F.lit(max(len(most) - 1, 0)))).alias("ib")))

    def above(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by(item)
        asked = left["of"].combine_chunks()
        sizes = pc.list_value_length(asked).to_numpy() if left.num_rows and right.num_rows else np.zeros(0, np.int64)
        if not len(sizes):
            return pa.table([left[user].slice(0, 0), right[item].slice(0, 0), pa.array([], pa.int64())],
                            names=[user, item, "n_above"])
        names = asked.flatten()
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        at = left["at"].combine_chunks().flatten().to_numpy()
        # of equal scores, the items before this place are the ones that stand above
        place = np.searchsorted(right[item].to_numpy(), names.to_numpy(zero_copy_only=False))
        n_above = _many_above(matrix(left["vec"]), matrix(right["vec"]), at, place, offsets)
        return pa.table([left[user].take(pa.array(np.repeat(np.arange(len(sizes)), sizes))), names, pa.array(n_above)],
                        names=[user, item, "n_above"])

    schema = f"{user} {dict(users.dtypes)[user]}, {item} {dict(items.dtypes)[item]}, n_above long"
    counted = (in_block_pairs(rows, blocked, user, item, above, schema, block_users, len(most))
               .groupBy(user, item).agg((F.sum("n_above") + 1).alias("rank")))
    return (pairs.join(counted, [user, item], "left")
            .select(user, item, "rank", F.when(F.col("rank").isNotNull(), F.lit(n).cast("long")).alias("n")))
