"""Random forest on encoded rows, and how much its features matter (EV10, SRT7).

A frame is (key, features, label) with features as an array in the order of a list
of names.  Trees are grown level by level from grouped histograms by Spark's own
forest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.functions import hashing
from tastegrid.operators.encode import id_map
from tastegrid.operators.stored import written


def encoded(frame: DataFrame, key: str, label: str, numbers: Sequence[str], choices: dict[str, Sequence[object]]
            ) -> tuple[DataFrame, list[str]]:
    """((key, features, label), names): numbers with nulls as 0, then one 0/1 feature per value of each choice.

    A value outside its list has no feature of its own, so all of the choice's
    features are 0.  Rows without a label are left out.
    """
    parts = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numbers]
    parts += [F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)) for c, values in choices.items() for v in values]
    names = [*numbers, *(f"{c}_{v}" for c, values in choices.items() for v in values)]
    rows = frame.where(F.col(label).isNotNull())
    return rows.select(key, F.array(*parts).alias("features"), F.col(label).cast("double").alias("label")), names


def fit(rows: DataFrame, trees: int = 20, depth: int = 6, seed: int = 42) -> RandomForestClassificationModel:
    """A forest on (features, label); every tree sees all rows and a random part of the features at each split."""
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, bootstrap=False, cacheNodeIds=False)
    return forest.fit(rows.select(array_to_vector("features").alias("features"), "label"))


def predicted(model: RandomForestClassificationModel, rows: DataFrame) -> DataFrame:
    """The rows with ``prediction``."""
    wide = rows.withColumn("_v", array_to_vector("features"))
    return model.setFeaturesCol("_v").transform(wide).drop("_v", "rawPrediction", "probability")


def importances(model: RandomForestClassificationModel, names: Sequence[str], spark) -> DataFrame:
    """(pos, feature, importance), most important first: the share of impurity that splits on the feature remove."""
    values = model.featureImportances.toArray().tolist()
    ranked = sorted(zip(names, values, strict=True), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame([(i, n, float(v)) for i, (n, v) in enumerate(ranked, 1)],
                                 "pos int, feature string, importance double")


def permutation_importances(model: RandomForestClassificationModel, rows: DataFrame, key: str, names: Sequence[str],
                            seed: int = 42) -> DataFrame:
    """(pos, feature, importance), most important first: the accuracy lost when a feature's values change rows.

    All features are tried in one pass.  The rows are numbered in hash order; for
    each feature a row takes the value of the row a fixed way further on, round the
    end, which is the same on every run and any partitioning.
    """
    n = rows.count()
    if not n:
        return rows.sparkSession.createDataFrame([], "pos int, feature string, importance double")
    hashed = rows.select(F.struct(F.col(key)).alias("_k"), "features", "label")
    marked = hashed.withColumn("_id", hashing.draw(F.to_json("_k"), seed))
    numbered = written(marked.join(id_map(marked, "_id").withColumnRenamed("raw_id", "_id"), "_id")
                       .select("idx", "features", "label"), "numbered")
    # steps differ by feature and are never a whole round
    step = F.pmod(F.xxhash64("f", F.lit(seed)), F.lit(max(n - 1, 1))) + 1
    tried = numbered.select("idx", "features", "label", F.explode(F.sequence(F.lit(0), F.lit(len(names)))).alias("f"))
    given = numbered.select(F.col("idx").alias("_from"), F.col("features").alias("_other"))
    changed = tried.withColumn("_from", F.pmod(F.col("idx") + step, F.lit(n))).join(given, "_from")
    # the last "feature" changes nothing: the accuracy to compare with
    mixed = F.transform("features", lambda v, i: F.when(i == F.col("f"), F.col("_other")[i]).otherwise(v))
    right = (predicted(model, changed.select("f", mixed.alias("features"), "label"))
             .groupBy("f").agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("right")))
    share = {r.f: r.right for r in right.collect()}  # one number per feature
    lost = sorted(((share[len(names)] - share[i], name) for i, name in enumerate(names)), key=lambda x: (-x[0], x[1]))
    return rows.sparkSession.createDataFrame([(p, name, float(v)) for p, (v, name) in enumerate(lost, 1)],
                                             "pos int, feature string, importance double")
