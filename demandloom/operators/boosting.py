"""Boosted regression trees that stop when the validation error does.

Each round fits one Spark ML tree to what the trees before it leave over. The tree sees a share of the
rows and of the columns. Its leaves then get the penalised mean of their rows, sum / (count + l2), from one
aggregation by leaf, which also gives the new errors of both periods. Rows carry the sum of the trees so far
(the margin): it is written out again after each block of rounds, so a plan never holds more than one block of
trees, and lost executors repeat no more than that. Fitting ends ``patience`` rounds after the best one.
"""

from __future__ import annotations

import math
import random
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorSlicer
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.session import shared_folder


@dataclass(frozen=True)
class BoostingParams:
    """Defaults are fixed values; tests and benchmarks pass smaller ones.

    ``block`` is the number of rounds between two written margins, ``categories`` the largest number
    of values of a column that is split by subsets of them.
    """

    rounds: int = 200
    patience: int = 20
    depth: int = 8
    step: float = 0.05
    min_rows_per_leaf: int = 5
    row_share: float = 0.8
    column_share: float = 0.8
    l2: float = 1.0
    bins: int = 256
    categories: int = 64
    smoothing: float = 20.0
    block: int = 10
    seed: int = 42


@dataclass(frozen=True)
class Boosted:
    """``model`` holds the base value and the trees up to ``best_round``; errors are of all fitted rounds."""

    model: GBTRegressionModel
    best_round: int
    train_rmse: list[float]
    validation_rmse: list[float]


def best_round(errors: list[float], patience: int) -> int:
    """Number of rounds to keep: the best one, looking until ``patience`` rounds bring nothing."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def columns_of_round(groups: Sequence[Sequence[int]], share: float, seed: int, number: int) -> list[int]:
    """Vector places that a round's tree may use: those of ⌈share · groups⌉ groups, drawn by seed and round."""
    drawn = random.Random(seed * 1_000_003 + number).sample(range(len(groups)), math.ceil(share * len(groups)))
    return sorted(place for g in drawn for place in groups[g])


def in_sample(share: float, seed: int, number: int) -> Column:
    """True for the rows that a round's tree is fitted on; needs the stored ``row`` number."""
    return F.pmod(F.xxhash64("row", F.lit(seed), F.lit(number)), F.lit(1 << 20)) < int(share * (1 << 20))


class _Trees:
    """Builds Spark ML trees from parts of fitted ones."""

    def __init__(self, spark: SparkSession) -> None:
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.nodes = self.jvm.org.apache.spark.ml.tree
        self.regression = self.jvm.org.apache.spark.ml.regression

    def tree(self, root, columns: int):
        return self.regression.DecisionTreeRegressionModel(f"dtr_{uuid.uuid4().hex[:12]}", root, columns)

    def leaf(self, value: float, like):
        return self.nodes.LeafNode(float(value), float(like.impurity()), like.impurityStats())

    def rewritten(self, node, places: list[int], values: Iterator[float]):
        """A copy with other leaf values, from left to right, and with places of the whole vector."""
        if node.numDescendants() == 0:
            return self.leaf(next(values), node)
        left, right = (self.rewritten(n, places, values) for n in (node.leftChild(), node.rightChild()))
        split = node.split()
        place = places[split.featureIndex()]
        if split.getClass().getSimpleName() == "CategoricalSplit":
            split = self.nodes.CategoricalSplit(place, split.leftCategories(), split.numCategories())
        else:
            split = self.nodes.ContinuousSplit(place, split.threshold())
        return self.nodes.InternalNode(
            node.prediction(), node.impurity(), node.gain(), left, right, split, node.impurityStats()
        )

    def ensemble(self, trees: list, weights: list[float]) -> GBTRegressionModel:
        held = self.gateway.new_array(self.regression.DecisionTreeRegressionModel, len(trees))
        shares = self.gateway.new_array(self.gateway.jvm.double, len(trees))
        for i, (tree, weight) in enumerate(zip(trees, weights)):
            held[i], shares[i] = tree, float(weight)
        return GBTRegressionModel(self.regression.GBTRegressionModel(f"gbtr_{uuid.uuid4().hex[:12]}", held, shares))


class _Rows:
    """Rows with their margins: written before the first round and after each block."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder, self.copies = spark, f"{shared_folder(spark).rstrip('/')}/margins-{uuid.uuid4().hex}", 0

    def write(self, rows: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.copies}"
        rows.write.partitionBy("fitted").parquet(path)
        if self.copies:
            self._delete(f"{self.folder}/{self.copies - 1}")
        self.copies += 1
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop(self) -> None:
        self._delete(self.folder)

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def boost(
    train: DataFrame,
    validation: DataFrame,
    params: BoostingParams | None = None,
    groups: Sequence[Sequence[int]] | None = None,
) -> Boosted:
    """Fit on ``train``, stop and cut on ``validation``; both have ``features`` (a vector) and ``target``.

    ``groups`` are the vector places that belong to one column each (default: every place is a column). The
    model starts with the mean target; each tree counts ``params.step``. Rows without a target don't count.
    """
    params = params or BoostingParams()
    spark = train.sparkSession
    own, stored = _Trees(spark), _Rows(spark)
    parts = [df.select("features", F.col("target").cast("double").alias("target"), F.lit(k).alias("fitted")) for df, k in ((train, 1), (validation, 0))]
    known = parts[0].unionByName(parts[1]).where("target IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    base = train.agg(F.avg(F.col("target").cast("double"))).first()[0]
    rows = stored.write(known.withColumn("margin", F.lit(float(base))))
    width = len(rows.select("features").first()["features"])
    groups = groups or [[i] for i in range(width)]

    trees: list = []
    first = None
    errors: tuple[list[float], list[float]] = ([], [])
    for number in range(params.rounds):
        block = trees[number - number % params.block :]
        left = _with_residual(rows, own.ensemble(block, [params.step] * len(block)) if block else None)
        places = columns_of_round(groups, params.column_share, params.seed, number)
        sliced = VectorSlicer(inputCol="features", outputCol="used", indices=places).transform(left)
        sliced = sliced.withColumn("sampled", (F.col("fitted") == 1) & in_sample(params.row_share, params.seed, number))
        # a fit reads its rows several times; what an executor loses is made again from the stored margins
        sliced = sliced.select("used", "residual", "fitted", "sampled").persist()
        tree = DecisionTreeRegressor(
            featuresCol="used",
            labelCol="residual",
            predictionCol="guess",
            leafCol="leaf",
            maxDepth=params.depth,
            maxBins=params.bins,
            minInstancesPerNode=params.min_rows_per_leaf,
            seed=params.seed + number,
        ).fit(sliced.where("sampled"))
        totals = _leaf_totals(tree.transform(sliced))
        sliced.unpersist()
        values = [0.0] * tree._java_obj.numLeave()
        for r in totals:
            if r["fitted"] == 1:
                values[int(r["leaf"])] = (r["sampled_sum"] or 0.0) / (r["sampled_count"] + params.l2)
        first = first or tree._java_obj.rootNode()
        trees.append(own.tree(own.rewritten(tree._java_obj.rootNode(), places, iter(values)), width))
        for kind in (0, 1):
            errors[kind].append(_rmse([r for r in totals if r["fitted"] == kind], values, params.step))
        if best_round(errors[0], params.patience) + params.patience <= number + 1:
            break
        if (number + 1) % params.block == 0 and number + 1 < params.rounds:
            block = trees[-params.block :]
            moved = _with_residual(rows, own.ensemble(block, [params.step] * len(block)))
            rows = stored.write(moved.select("features", "target", "fitted", "row", (F.col("target") - F.col("residual")).alias("margin")))
    stored.drop()
    keep = best_round(errors[0], params.patience)
    base_tree = own.tree(own.leaf(base, first), width)
    model = own.ensemble([base_tree, *trees[:keep]], [1.0] + [params.step] * keep)
    return Boosted(model, keep, errors[1], errors[0])


def _with_residual(rows: DataFrame, block: GBTRegressionModel | None) -> DataFrame:
    """``residual``: the target less the stored margin and less the trees of the running block."""
    if block is None:
        return rows.withColumn("residual", F.col("target") - F.col("margin"))
    moved = block.setPredictionCol("moved").transform(rows)
    return moved.withColumn("residual", F.col("target") - F.col("margin") - F.col("moved")).drop("moved")


def _leaf_totals(placed: DataFrame) -> list:
    """One row for each leaf and period: a tree's leaves bound what reaches the driver."""
    sampled = F.when(F.col("sampled"), F.col("residual"))
    return (
        placed.groupBy("fitted", "leaf")
        .agg(
            F.sum(sampled).alias("sampled_sum"),
            F.count(sampled).alias("sampled_count"),
            F.sum("residual").alias("sum"),
            F.count("residual").alias("count"),
            F.sum(F.col("residual") * F.col("residual")).alias("squares"),
        )
        .collect()
    )


def _rmse(totals: list, values: list[float], step: float) -> float:
    """Error once every leaf adds ``step`` times its value."""
    error = count = 0.0
    for r in totals:
        move = step * values[int(r["leaf"])]
        error += r["squares"] - 2 * move * r["sum"] + move * move * r["count"]
        count += r["count"]
    return math.sqrt(max(error, 0.0) / count) if count else math.nan
