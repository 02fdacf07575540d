import math
import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from demandloom.operators import boosting
from demandloom.operators.boosting import BoostingParams, boost
from demandloom.session import pin

SMALL_FIT = BoostingParams(rounds=6, patience=6, depth=3, step=0.3, bins=32, block=2, row_share=0.7)


def rows(spark, n, seed, width=5):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = [rng.random() for _ in range(width)]
        out.append((Vectors.dense(x), 10 * (x[0] > 0.5) + 5 * x[1] + rng.gauss(0, 0.3)))
    return pin(spark.createDataFrame(out, ["features", "target"]).repartition(3, "target"), "rows")


@pytest.fixture(scope="module")
def train(spark):
    return rows(spark, 2000, 1)


@pytest.fixture(scope="module")
def validation(spark):
    return rows(spark, 400, 2)


def tree_of(node):
    """A fitted tree as nested tuples."""
    if node.numDescendants() == 0:
        return node.prediction()
    split = node.split()
    return split.featureIndex(), split.threshold(), tree_of(node.leftChild()), tree_of(node.rightChild())


def leaf_of(tree, x, path=()):
    while isinstance(tree, tuple):
        place, cut, left, right = tree
        tree, path = (left, (*path, 0)) if x[place] <= cut else (right, (*path, 1))
    return path, tree


def trees(model):
    return [tree_of(t.rootNode()) for t in model._java_obj.trees()]


def test_leaves_are_penalised_means_as_in_plain_python(spark, train, validation):
    """Every leaf of every round, from the residuals of the trees before it."""
    params = BoostingParams(**{**SMALL_FIT.__dict__, "row_share": 1.0})
    fitted = boost(train, validation, params)
    data = [(r.features.toArray(), r.target) for r in train.collect()]
    base, *later = trees(fitted.model)
    assert base == pytest.approx(sum(y for _, y in data) / len(data), rel=1e-12)
    margin = [base] * len(data)
    for tree, rmse in zip(later, fitted.train_rmse):
        sums: dict = {}
        for (x, y), m in zip(data, margin):
            path, value = leaf_of(tree, x)
            total = sums.setdefault(path, [0.0, 0, value])
            total[0] += y - m
            total[1] += 1
        for total, count, value in sums.values():
            assert value == pytest.approx(total / (count + params.l2), rel=1e-9, abs=1e-12)
        margin = [m + params.step * leaf_of(tree, x)[1] for (x, _), m in zip(data, margin)]
        assert rmse == pytest.approx(math.sqrt(sum((y - m) ** 2 for (_, y), m in zip(data, margin)) / len(data)), rel=1e-9)
    assert list(fitted.model.treeWeights) == [1.0] + [params.step] * len(later)
    assert len(later) == fitted.best_round == 6


def test_fitting_stops_after_patience_and_keeps_the_same_prefix(spark, train):
    """Noise only: a longer fit has the same first trees."""
    noise = pin(train.withColumn("target", F.rand(5)), "noise")
    other = pin(train.limit(300).withColumn("target", F.rand(6)), "noise")
    short = boost(noise, other, BoostingParams(rounds=40, patience=3, depth=4, bins=32, step=0.5))
    assert len(short.validation_rmse) == short.best_round + 3 < 40
    assert short.best_round == boosting.best_round(short.validation_rmse, 3)
    long = boost(noise, other, BoostingParams(rounds=short.best_round + 5, patience=40, depth=4, bins=32, step=0.5))
    assert long.validation_rmse[: len(short.validation_rmse)] == pytest.approx(short.validation_rmse, rel=1e-9)
    for a, b in zip(trees(short.model), trees(long.model)):
        assert str(a)[:40] == str(b)[:40]


def test_a_fit_that_gains_goes_through_all_rounds(train, validation):
    fitted = boost(train, validation, SMALL_FIT)
    assert len(fitted.validation_rmse) == 6 and fitted.validation_rmse == sorted(fitted.validation_rmse, reverse=True)


def test_margins_by_block_change_nothing(train, validation):
    one = boost(train, validation, BoostingParams(**{**SMALL_FIT.__dict__, "block": 1}))
    all_ = boost(train, validation, BoostingParams(**{**SMALL_FIT.__dict__, "block": 100}))
    assert one.validation_rmse == pytest.approx(all_.validation_rmse, rel=1e-9)


def test_each_tree_uses_its_share_of_columns(spark, train, validation):
    groups = [[0], [1, 2], [3], [4]]
    params = BoostingParams(**{**SMALL_FIT.__dict__, "column_share": 0.5, "depth": 5})
    fitted = boost(train, validation, params, groups)

    def used(tree):
        return {tree[0]} | used(tree[2]) | used(tree[3]) if isinstance(tree, tuple) else set()

    draws = [boosting.columns_of_round(groups, 0.5, params.seed, k) for k in range(6)]
    assert len({tuple(d) for d in draws}) > 1
    for draw, tree in zip(draws, trees(fitted.model)[1:]):
        assert sum(any(p in draw for p in g) for g in groups) == 2
        assert used(tree) <= set(draw)
    # the model on whole vectors scores as its trees do in plain Python
    scored = fitted.model.transform(validation).select("features", "prediction").collect()
    for r in scored[:100]:
        x = r.features.toArray()
        base, *later = trees(fitted.model)
        assert r.prediction == pytest.approx(base + sum(params.step * leaf_of(t, x)[1] for t in later), rel=1e-9)


def test_row_samples_differ_by_round_and_hold_their_share(train):
    numbered = pin(train.withColumn("row", F.monotonically_increasing_id()), "numbered")
    shares = numbered.agg(*[F.avg(boosting.in_sample(0.8, 1, k).cast("int")).alias(f"s{k}") for k in range(2)]).first()
    both = numbered.agg(F.avg((boosting.in_sample(0.8, 1, 0) & boosting.in_sample(0.8, 1, 1)).cast("int"))).first()[0]
    assert all(abs(s - 0.8) < 0.04 for s in shares) and abs(both - 0.64) < 0.05


def test_subsets_of_values_are_split_and_survive_storage(spark, validation, tmp_path):
    """Values 1, 4 and 6 of a nominal column are large: no threshold on the number separates them."""
    attribute = {"ml_attr": {"type": "nominal", "name": "code", "num_vals": 8}}
    from pyspark.ml.feature import VectorAssembler

    plain = spark.range(1200).select(
        (F.col("id") % 8).cast("double").alias("code", metadata=attribute),
        F.rand(1).alias("other"),
        F.when((F.col("id") % 8).isin(1, 4, 6), 100.0).otherwise(0.0).alias("target"),
    )
    table = pin(VectorAssembler(inputCols=["code", "other"], outputCol="features").transform(plain).select("features", "target"), "codes")
    params = BoostingParams(rounds=1, depth=1, step=1.0, row_share=1.0, column_share=1.0, l2=0.0)
    fitted = boost(table, table, params)
    assert fitted.train_rmse[0] < 1e-9
    fitted.model.write().overwrite().save(str(tmp_path / "m"))
    from pyspark.ml.regression import GBTRegressionModel

    again = GBTRegressionModel.load(str(tmp_path / "m"))
    split = again._java_obj.trees()[1].rootNode().split()
    assert split.getClass().getSimpleName() == "CategoricalSplit"
    sides = {frozenset(split.leftCategories()), frozenset(split.rightCategories())}
    assert sides == {frozenset({1.0, 4.0, 6.0}), frozenset({0.0, 2.0, 3.0, 5.0, 7.0})}


def test_rows_without_a_target_are_left_out(train, validation):
    holes = train.unionByName(train.limit(50).withColumn("target", F.lit(None).cast("double")))
    assert boost(holes, validation, BoostingParams(rounds=1, depth=2)).train_rmse[0] > 0
