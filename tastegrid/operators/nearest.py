"""Nearest vectors by cosine (RC14).

Exact: the asked vectors against all, in blocks (``serving.top_scores``); on vectors
of length 1 the product is the cosine.  By cells: centres are fitted on a bounded
sample, every vector goes to its nearest centre, and an asked vector is compared
with the vectors of its ``probes`` nearest cells.  The best are then ranked by exact
cosine.  A large cell is cut into blocks of rows, so no task holds a whole cell.

A vector without length has no cosine: it takes no part.  Null ids take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.operators import serving
from tastegrid.operators.ranking import top_k_per_group

FIT_ROWS = 100_000


def unit_vectors(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(key, vec) with length 1."""
    wide = vectors.where(F.col(key).isNotNull()).select(key, F.col(column).cast("array<double>").alias("_v"))
    sized = wide.withColumn("_l", serving.length("_v")).where("_l > 0")
    return sized.select(key, F.transform("_v", lambda x: x / F.col("_l")).alias("vec"))


def nearest_exact(vectors: DataFrame, asked: DataFrame, key: str, k: int = 10, **blocks: int) -> DataFrame:
    """(key, pos, neighbour, cosine) of unit vectors: the ``k`` nearest others of every asked one."""
    others = vectors.select(F.col(key).alias("neighbour"), "vec")
    itself = asked.select(key, F.col(key).alias("neighbour"))
    found = serving.top_scores(asked, others, key, "neighbour", k, itself, **blocks)
    return found.withColumnRenamed("score", "cosine")


def centres(vectors: DataFrame, key: str, cells: int, seed: int = 42, most: int = FIT_ROWS) -> np.ndarray:
    """Centres of unit vectors, fitted on at most ``most`` of them, chosen by hash; one row per cell."""
    sample = vectors.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(most).select(array_to_vector("vec").alias("features"))
    found = KMeans(k=cells, seed=seed, maxIter=10, initMode="random", distanceMeasure="cosine").fit(sample)
    return np.array(found.clusterCenters())


def in_cells(vectors: DataFrame, key: str, middle: np.ndarray, probes: int = 1) -> DataFrame:
    """(key, vec, ib) with the ``probes`` nearest cells of every vector, one row each."""
    kind = dict(vectors.dtypes)[key]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            wide = serving.matrix(pa.chunked_array([batch.column(1)]))
            near = np.concatenate([np.argsort(-(wide[part] @ middle.T), axis=1, kind="stable")[:, :probes]
                                   for part in serving.in_chunks(len(wide), len(middle))])
            rows = pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(near.ravel().astype(np.int32))],
                [key, "vec", "ib"])

    return vectors.select(key, "vec").mapInArrow(placed, f"{key} {kind}, vec array<double>, ib int")


def nearest_by_cells(vectors: DataFrame, asked: DataFrame, key: str, k: int = 10, cells: int | None = None,
                     probes: int = 8, seed: int = 42, block_items: int = serving.BLOCK_ITEMS,
                     block_users: int = serving.BLOCK_USERS) -> DataFrame:
    """(key, pos, neighbour, cosine): nearest others among the vectors of each asked one's nearest cells.

    All vectors are indexed.  By default there are about as many cells as the root
    of the vectors, at most 4,096; more probes find more and cost more.
    """
    if cells is None:
        cells = int(min(4096, max(1, vectors.count() ** 0.5)))
    kind = dict(vectors.dtypes)[key]
    schema = f"{key} {kind}, neighbour {kind}, score double"
    if cells < 2 or vectors.isEmpty():
        return nearest_exact(vectors, asked, key, k)
    middle = centres(vectors, key, cells, seed)
    # a cell's rows are cut by hash into blocks; an asked vector meets all blocks of its cells
    indexed = in_cells(vectors, key, middle).withColumnRenamed(key, "neighbour")
    parts = indexed.groupBy("ib").agg(F.ceil(F.count(F.lit(1)) / block_items).cast("int").alias("_n"))
    placed = (indexed.join(F.broadcast(parts), "ib").withColumn("_b", F.pmod(F.xxhash64("neighbour"), F.col("_n")).cast("int"))
              .select("neighbour", "vec", F.struct("ib", "_b").alias("ib")))
    rows = (in_cells(asked, key, middle, probes).join(F.broadcast(parts), "ib")
            .withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
            .select(key, "vec", F.array(F.col(key)).alias("seen"), F.struct("ib", "_b").alias("ib")))
    found = serving.in_block_pairs(rows, placed, key, "neighbour", serving._best(key, "neighbour", k), schema, block_users, cells)
    best = top_k_per_group(found, key, [F.desc("score"), F.asc("neighbour")], k)
    return best.select(key, F.col("pos").cast("int").alias("pos"), "neighbour", F.col("score").alias("cosine"))


def recall(found: DataFrame, exact: DataFrame, key: str) -> DataFrame:
    """One row: the share of the exact neighbours that were found."""
    hits = exact.join(found.select(key, "neighbour", F.lit(1).alias("_hit")), [key, "neighbour"], "left")
    return hits.agg(F.round(F.avg(F.coalesce("_hit", F.lit(0))), 6).alias("recall"), F.count(F.lit(1)).alias("neighbours"))
