import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from demandloom.operators import evaluation, model, splits
from demandloom.session import pin
from demandloom.verification.queries import SPEC, TRAINING, Tables, score_facts


@pytest.mark.parametrize(
    "errors, patience, rounds",
    [([3.0, 2.0, 1.0], 20, 3), ([3.0, 1.0, 2.0, 2.0, 0.5], 2, 2), ([1.0], 5, 1), ([1.0, 2.0, 0.5], 2, 3)],
)
def test_patience_rule(errors, patience, rounds):
    assert model.best_round(errors, patience) == rounds


@pytest.fixture(scope="module")
def table(spark):
    return pin(Tables(spark, SMALL).features, "features")


@pytest.fixture(scope="module")
def fitted(table):
    params = model.BoostingParams(rounds=4, patience=2, depth=3, step=0.3, bins=64)
    return model.fit_demand_model(table, SPEC, params)


def test_model_beats_the_mean(table, fitted):
    scored = fitted.score(splits.select_period(table, SPEC.validation))
    assert set(scored.columns) == {*table.columns, "predicted"}
    mean = splits.select_period(table, SPEC.train).agg(F.avg("target")).first()[0]
    constant = splits.select_period(table, SPEC.validation).withColumn("predicted", F.lit(mean))
    assert (
        evaluation.forecast_metrics(scored).first().rmse
        < evaluation.forecast_metrics(constant).first().rmse
    )


def test_scoring_keeps_every_row_and_never_gives_null(table, fitted):
    strange = table.limit(50).withColumns(
        {"item_code": F.lit(999999), "dept_code": F.lit(12345), "price": F.lit(None).cast("double")}
    )
    scored = fitted.score(strange)
    assert scored.count() == 50 and scored.where("predicted IS NULL").count() == 0


def test_saved_model_scores_the_same(spark, table, fitted, tmp_path):
    fitted.save(str(tmp_path / "model"))
    loaded = model.DemandModel.load(spark, str(tmp_path / "model"))
    assert loaded.best_round == fitted.best_round
    keys = ["date", "store_id", "item_id"]
    test = splits.select_period(table, SPEC.test)
    left = fitted.score(test).select(*keys, "predicted")
    right = loaded.score(test).select(*keys, F.col("predicted").alias("again"))
    assert left.join(right, keys).where("predicted <> again").count() == 0


def test_empty_training_period_fails(table):
    with pytest.raises(RuntimeError, match="no rows found for train period"):
        model.fit_demand_model(table.where("false"), SPEC)


def test_no_row_is_coded_with_its_own_target(spark, table):
    """Targets of a single-row item stay out of its own training code."""
    rows = table.limit(400).withColumn("item_code", F.monotonically_increasing_id().cast("int"))
    rows = pin(rows.withColumn("target", F.rand(3) * 100), "random-targets")
    effects = pin(model.code_effects(rows, 1.0), "effects")
    subsets = model.code_subsets(effects, 64)
    own = model.tree_input(rows, effects, subsets, training=True)
    again = model.tree_input(rows, effects, subsets)
    assert own.agg(F.stddev("item_code_effect")).first()[0] < 1e-6
    assert again.agg(F.corr("target", "item_code_effect")).first()[0] > 0.99


def test_wide_labels_are_coded_like_narrow_ones(spark, table):
    rows = pin(table.limit(3000).withColumn("dept_code", (F.monotonically_increasing_id() % 300).cast("int")), "wide")
    effects = pin(model.code_effects(rows, 1.0), "effects")
    assert effects.where("field = 'dept_code' AND fold IS NULL").count() == 300
    shaped = model.tree_input(rows, effects, model.code_subsets(effects, 64))
    assert shaped.count() == 3000 and shaped.where("dept_code_effect IS NULL").count() == 0
    groups = {r[0] for r in shaped.select("dept_code_group").distinct().collect()}
    assert groups <= set(range(1, 64)) and len(groups) > 10
    # groups follow the effects
    ranges = shaped.groupBy("dept_code_group").agg(F.min("dept_code_effect"), F.max("dept_code_effect")).orderBy(F.min("dept_code_effect")).collect()
    assert all(a[2] <= b[1] and a[0] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_history_is_saved_and_the_prefix_scores_alone(spark, table, fitted, tmp_path):
    fitted.save(str(tmp_path / "model"))
    loaded = model.DemandModel.load(spark, str(tmp_path / "model"))
    assert loaded.history.count() == 4 and loaded.history.where("kept").first()["round"] == fitted.best_round
    assert fitted.stages.stages[-1].getNumTrees == 1 + fitted.best_round  # the mean and the trees


def categorical_splits(node):
    if node.numDescendants() == 0:
        return []
    split = node.split()
    own = [split] if split.getClass().getSimpleName() == "CategoricalSplit" else []
    return own + categorical_splits(node.leftChild()) + categorical_splits(node.rightChild())


def test_stored_models_split_codes_by_subsets(spark, table, tmp_path):
    """Demand depends on a scattered set of department codes; codes never seen count as unknown."""
    code = F.pmod(F.xxhash64("date", "item_id", "store_id"), F.lit(12)).cast("int")
    target = F.when(code.isin(0, 3, 7, 8), 50.0).otherwise(0.0)
    made = pin(table.withColumn("dept_code", code).withColumn("target", target), "codes")
    params = model.BoostingParams(rounds=2, patience=2, depth=2, step=1.0, column_share=1.0)
    fitted = model.fit_demand_model(made, SPEC, params)
    fitted.save(str(tmp_path / "model"))
    loaded = model.DemandModel.load(spark, str(tmp_path / "model"))
    tree = loaded.stages.stages[-1]._java_obj.trees()[1].rootNode()
    place = [n for names in model.inputs(loaded.subsets) for n in names].index("dept_code_group")
    found = [s for s in categorical_splits(tree) if s.featureIndex() == place]
    assert found and {1.0, 4.0, 8.0, 9.0} in [set(s.leftCategories()) & set(range(1, 13)) for s in found] + [
        set(s.rightCategories()) & set(range(1, 13)) for s in found
    ]
    few = made.limit(20)
    unknown = [loaded.score(few.withColumn("dept_code", F.lit(c).cast("int"))).select("predicted").collect() for c in (None, 500)]
    assert unknown[0] == unknown[1]


@pytest.mark.parametrize("large", [True, False])
def test_missing_values_go_to_the_side_that_fits(spark, large):
    """Missing counts like the largest prices, or like the smallest: one split is enough for either."""
    price = F.when(F.col("id") % 3 > 0, (F.col("id") % 50).cast("double"))
    high = (price >= 25) | price.isNull() if large else (price >= 25) & price.isNotNull()
    rows = spark.range(900).select(
        *[F.coalesce(price, F.lit(end)).alias(name) for name, end in (("low", model.BELOW), ("high", model.ABOVE))],
        F.when(high, 7.0).otherwise(1.0).alias("target"),
    )
    from pyspark.ml.feature import VectorAssembler

    rows = pin(VectorAssembler(inputCols=["low", "high"], outputCol="features").transform(rows).select("features", "target"), "ends")
    params = model.BoostingParams(rounds=1, depth=1, step=1.0, row_share=1.0, column_share=1.0, l2=0.0)
    assert model.boost(rows, rows, params, [[0, 1]]).train_rmse[0] < 1e-9


def test_every_model_column_is_one_group_of_places(fitted):
    columns = model.inputs(fitted.subsets)
    groups = model.input_groups(columns)
    assert len(groups) == 25 and sorted(p for g in groups for p in g) == list(range(sum(map(len, columns))))


def test_training_query_takes_the_operators_settings():
    own = model.BoostingParams()
    assert (own.rounds, own.patience) == (200, 20) and TRAINING == model.BoostingParams(patience=5)
