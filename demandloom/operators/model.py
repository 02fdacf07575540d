"""Boosted-tree demand model on Spark ML: input, early-stopped fit, scoring, storage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.operators.boosting import BoostingParams, best_round, boost  # noqa: F401
from demandloom.operators.features import model_input, require_rows
from demandloom.operators.splits import select_period
from demandloom.schemas import CALENDAR_COLUMNS, CATEGORICAL_COLUMNS, NUMERIC_COLUMNS, SplitSpec
from demandloom.session import pin

# Numbers that can be missing. Each goes in twice, once with the missing rows below all others and once
# above, so a split puts them on the side that fits better.
NULLABLE = tuple(c for c in NUMERIC_COLUMNS if c not in CALENDAR_COLUMNS)
BELOW, ABOVE = -1e30, 1e30
# Training rows are coded from the days of the other folds, so no row sees its own target.
EFFECT_FOLDS = 5
EFFECTS = {c: f"{c}_effect" for c in CATEGORICAL_COLUMNS}
GROUPS = {c: f"{c}_group" for c in CATEGORICAL_COLUMNS}


@dataclass(frozen=True)
class DemandModel:
    """A fitted model with the code effects and groups it was trained on and its error by round."""

    stages: PipelineModel
    effects: DataFrame
    subsets: DataFrame
    best_round: int
    history: DataFrame

    def score(self, features: DataFrame) -> DataFrame:
        """Add ``predicted`` to feature rows; vectors do not appear in the result."""
        keep = [F.col(f"_row.{c}").alias(c) for c in features.columns]
        prepared = tree_input(features.withColumn("_row", F.struct(*features.columns)), self.effects, self.subsets)
        scored = self.stages.transform(prepared)
        return scored.select(*keep, F.col("prediction").alias("predicted"))

    def save(self, path: str) -> None:
        self.stages.write().overwrite().save(f"{path}/stages")
        self.effects.write.mode("overwrite").parquet(f"{path}/effects")
        self.subsets.write.mode("overwrite").parquet(f"{path}/subsets")
        self.history.write.mode("overwrite").parquet(f"{path}/history")

    @staticmethod
    def load(spark, path: str) -> "DemandModel":
        stages = PipelineModel.load(f"{path}/stages")
        rounds = stages.stages[-1].getNumTrees - 1  # the first tree is the mean
        tables = [spark.read.parquet(f"{path}/{name}") for name in ("effects", "subsets", "history")]
        return DemandModel(stages, *tables[:2], rounds, tables[2])


def _fold() -> Column:
    return F.pmod(F.xxhash64("date"), F.lit(EFFECT_FOLDS)).cast("int")


def code_effects(train: DataFrame, smoothing: float) -> DataFrame:
    """``field, code, fold, effect``: smoothed mean target of each code of each categorical.

    They stand in for the codes at any number of values. Fold NULL is over all training rows, for
    scoring; fold k leaves the days of fold k out, for the training rows of those days. Code NULL carries the
    mean, for codes that training does not know.
    """
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("int").alias("code")) for c in CATEGORICAL_COLUMNS])
    known = train.select("target", _fold().alias("fold"), F.inline(fields)).where("code IS NOT NULL AND code >= 0")
    sums = pin(
        known.groupBy("field", "code", "fold").agg(F.sum("target").alias("sum"), F.count(F.lit(1)).alias("n")),
        "code-sums",
    )
    overall = train.agg(F.avg("target").alias("mean"))
    mean = overall.scalar()
    every = sums.groupBy("field", "code").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))
    apart = (
        every.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(EFFECT_FOLDS - 1))))
        .join(sums.select("field", "code", "fold", F.col("sum").alias("own_sum"), F.col("n").alias("own_n")), ["field", "code", "fold"], "left")
        .select(
            "field", "code", "fold",
            (F.col("sum") - F.coalesce("own_sum", F.lit(0.0))).alias("sum"),
            (F.col("n") - F.coalesce("own_n", F.lit(0))).alias("n"),
        )
    )
    whole = every.select("field", "code", F.lit(None).cast("int").alias("fold"), "sum", "n")
    effect = ((F.col("sum") + mean * smoothing) / (F.col("n") + smoothing)).alias("effect")
    unknown = overall.select(
        F.lit(None).cast("string").alias("field"), F.lit(None).cast("int").alias("code"), F.lit(None).cast("int").alias("fold"),
        F.col("mean").alias("effect"),
    )
    return whole.unionByName(apart).select("field", "code", "fold", effect).unionByName(unknown)


def code_subsets(effects: DataFrame, most: int) -> DataFrame:
    """``field, values, cuts``: how each categorical is split by subsets of at most ``most`` values.

    Value 0 is for codes that training does not know. A field whose codes all fit keeps them, each as the code
    plus one, and has no cuts. Codes of a larger field are put into groups of about as many codes each, by
    their mean effect; ``cuts`` are the effects where the groups end.
    """
    known = effects.where("field IS NOT NULL AND fold IS NULL")
    shares = F.array(*[F.lit((i + 1) / (most - 1)) for i in range(most - 2)])
    fits = F.max("code") + 2 <= most
    return known.groupBy("field").agg(
        F.when(fits, F.max("code") + 2).otherwise(F.lit(most)).cast("int").alias("values"),
        F.when(fits, F.array().cast("array<double>"))
        .otherwise(F.array_distinct(F.percentile_approx("effect", shares, 10_000)))
        .alias("cuts"),
    )


def tree_input(features: DataFrame, effects: DataFrame, subsets: DataFrame, training: bool = False) -> DataFrame:
    """Numbers without NULLs for the assembler: both ends for missing ones, code effects, code subsets.

    A training row gets the effect, and by it the group, from the days of the other folds. ``subsets`` has a
    row for each categorical.
    """
    extra = [c for c in ("_row", "target", "date") if c in features.columns]
    shaped = model_input(features, extra)
    mean = effects.where("field IS NULL").select("effect").scalar()
    ends = {f"{c}_{end}": F.coalesce(F.col(c).cast("double"), F.lit(value)) for c in NULLABLE for end, value in (("low", BELOW), ("high", ABOVE))}
    shaped = shaped.withColumns(ends).drop(*NULLABLE)
    if training:
        shaped = shaped.withColumn("_fold", _fold())
    plans = {r["field"]: r for r in subsets.collect()}
    # Rows without a code get keys of their own that match nothing, instead of meeting under one.
    apart = -1 - F.pmod(F.xxhash64("date", "store_id"), F.lit(4096)).cast("int")
    for column, name in EFFECTS.items():
        part = effects.where((F.col("field") == column) & (F.col("fold").isNotNull() if training else F.col("fold").isNull()))
        lookup = part.select((F.col("code") + 1).alias("_code"), F.col("fold").alias("_fold"), F.col("effect").alias(name))
        keys = ["_code", "_fold"] if training else ["_code"]
        shaped = shaped.withColumn("_code", F.when(F.col(column) > 0, F.col(column)).otherwise(apart)).join(
            lookup if training else lookup.drop("_fold"), keys, "left"
        )
        plan = plans.get(column)
        if plan is None:
            group, values = F.lit(0), 1
        elif plan["cuts"]:
            ends = F.array(*[F.lit(x) for x in plan["cuts"]])
            group, values = 1 + F.size(F.filter(ends, lambda x: x < F.col(name))), plan["values"]
        else:
            group, values = F.col(column), plan["values"]
        group = F.when(F.col(name).isNotNull(), group).otherwise(F.lit(0)).cast("double")
        attribute = {"ml_attr": {"type": "nominal", "name": GROUPS[column], "num_vals": values}}
        shaped = shaped.withColumns(
            {GROUPS[column]: group.alias(GROUPS[column], metadata=attribute), name: F.coalesce(name, mean)}
        )
    return shaped.drop("_code", "_fold")


def inputs(subsets: DataFrame) -> list[tuple[str, ...]]:
    """Vector places by model column: missing numbers at both ends, every code as what subsets can split.

    A field with more codes than that is there by its effect too.
    """
    wide = {r["field"] for r in subsets.select("field", F.size("cuts").alias("cuts")).collect() if r["cuts"]}
    return [
        *[(c,) for c in CALENDAR_COLUMNS],
        *[(f"{c}_low", f"{c}_high") for c in NULLABLE],
        *[(GROUPS[c], EFFECTS[c]) if c in wide else (GROUPS[c],) for c in CATEGORICAL_COLUMNS],
    ]


def input_groups(columns: list[tuple[str, ...]]) -> list[list[int]]:
    """The places in the vector of each model column, which a tree uses together or not at all."""
    groups, place = [], 0
    for names in columns:
        groups.append(list(range(place, place + len(names))))
        place += len(names)
    return groups


def fit_demand_model(
    features: DataFrame, spec: SplitSpec, params: BoostingParams | None = None
) -> DemandModel:
    """Fit on the train period, choose the number of rounds on the validation period.

    The encoded rows are pinned once; fitting ends ``patience`` rounds after the best one, and the kept
    model is the prefix of the trees up to it.
    """
    params = params or BoostingParams()
    spark = features.sparkSession
    train = require_rows(select_period(features, spec.train), "train period")
    validation = require_rows(select_period(features, spec.validation), "validation period")
    effects = pin(code_effects(train, params.smoothing), "code-effects")
    subsets = pin(code_subsets(effects, min(params.categories, params.bins)), "code-subsets")
    columns = inputs(subsets)
    assembler = VectorAssembler(inputCols=[name for names in columns for name in names], outputCol="features")

    def encoded(part: DataFrame, label: str, training: bool) -> DataFrame:
        shaped = tree_input(part, effects, subsets, training)
        return pin(assembler.transform(shaped).select("features", "target"), label)

    fitted = boost(encoded(train, "train-rows", True), encoded(validation, "validation-rows", False), params, input_groups(columns))
    history = spark.createDataFrame(
        [(i + 1, a, b, i + 1 == fitted.best_round) for i, (a, b) in enumerate(zip(fitted.train_rmse, fitted.validation_rmse))],
        "round int, train_rmse double, validation_rmse double, kept boolean",
    )
    return DemandModel(PipelineModel([assembler, fitted.model]), effects, subsets, fitted.best_round, history)
