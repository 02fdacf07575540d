"""Error analysis of scored rows (``target``, ``predicted`` and their keys)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.scoring import (
    DEMAND_RANGES,
    UNBUCKETED,
    demand_range,
    floored_ratio,
    overall_bias_label,
    percentage,
    prediction_ratio_bucket,
    range_bias_label,
    regression_metrics,
    sse_share_label,
)
from demandloom.operators.checks import fold_rows
from demandloom.operators.quantiles import exact_median, exact_quantiles
from demandloom.operators.splits import select_period, split_label
from demandloom.schemas import Period, SplitSpec

ACTUAL, PREDICTED = "target", "predicted"
SIGNED_PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)
ABSOLUTE_PERCENTILES = (50, 90, 95, 99)
DEMAND_PERCENTILES = (10, 25, 50, 75, 90, 95, 99)


def naive_forecast(features: DataFrame) -> DataFrame:
    """Last week's mean, else yesterday's demand, else 0."""
    return features.withColumn(PREDICTED, F.coalesce("rolling_mean_7", "lag_1", F.lit(0.0)))


def with_errors(scored: DataFrame) -> DataFrame:
    error = F.col(PREDICTED) - F.col(ACTUAL)
    return scored.withColumns(
        {"error": error, "abs_error": F.abs(error), "squared_error": error * error}
    )


def forecast_metrics(scored: DataFrame) -> DataFrame:
    return scored.agg(*regression_metrics())


def metrics_by_split(scored: DataFrame, spec: SplitSpec) -> DataFrame:
    return scored.groupBy(split_label(spec).alias("split")).agg(*regression_metrics())


def evaluate_period(scored: DataFrame, period: Period) -> DataFrame:
    """Metrics of one period; the job fails if the period holds no rows."""
    message = F.lit(f"no rows found for {period.name} period")
    metrics = forecast_metrics(select_period(scored, period))
    return metrics.withColumn(
        "rows", F.when(F.col("rows") > 0, F.col("rows")).otherwise(F.raise_error(message).cast("long"))
    )


def metrics_by_store(scored: DataFrame) -> DataFrame:
    return scored.groupBy("store_id").agg(*regression_metrics())


def _stacked(df: DataFrame, columns: list[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")


def error_distribution(scored: DataFrame) -> DataFrame:
    """One row: moments, exact percentiles, and over/under/exact counts of the errors."""
    errors = with_errors(scored)
    e, a = F.col("error"), F.col("abs_error")
    rows = F.count(F.lit(1))
    moments = errors.agg(
        rows.alias("rows"),
        F.avg(e).alias("mean_error"),
        F.stddev_pop(e).alias("std_error"),
        F.min(e).alias("min_error"),
        F.max(e).alias("max_error"),
        F.avg(a).alias("mean_abs_error"),
        F.max(a).alias("max_abs_error"),
        F.count_if(e > 0).alias("overpredictions"),
        F.count_if(e < 0).alias("underpredictions"),
        F.count_if(e == 0).alias("exact_matches"),
        percentage(F.count_if(e > 0), rows).alias("overprediction_pct"),
        percentage(F.count_if(e < 0), rows).alias("underprediction_pct"),
        percentage(F.count_if(e == 0), rows).alias("exact_match_pct"),
    )
    probs = [p / 100 for p in SIGNED_PERCENTILES]
    quantiles = exact_quantiles(
        _stacked(errors, ["error", "abs_error"]), "value", probs, ["metric"], few_groups=True
    )

    def named(metric: str, prefix: str, percents: tuple[int, ...]) -> list[Column]:
        wanted = F.col("metric") == metric
        return [
            F.max(F.when(wanted & (F.col("prob") == p / 100), F.col("quantile"))).alias(f"{prefix}p{p}")
            for p in percents
        ]

    percentiles = quantiles.agg(
        *named("error", "error_", SIGNED_PERCENTILES),
        *named("abs_error", "abs_error_", ABSOLUTE_PERCENTILES),
    )
    return fold_rows(moments, percentiles)


def demand_distribution(scored: DataFrame) -> DataFrame:
    """Actual against predicted: one row ``(statistic, actual, predicted)`` per statistic."""
    y, p = F.col(ACTUAL), F.col(PREDICTED)
    names = {
        "mean": (F.avg(y), F.avg(p)),
        "std_dev": (F.stddev_pop(y), F.stddev_pop(p)),
        "min": (F.min(y), F.min(p)),
        "max": (F.max(y), F.max(p)),
        "zero_or_near_zero": (F.count_if(y == 0), F.count_if(F.abs(p) < 0.5)),
        "zero_or_near_zero_pct": (
            percentage(F.count_if(y == 0), F.count(F.lit(1))),
            percentage(F.count_if(F.abs(p) < 0.5), F.count(F.lit(1))),
        ),
        "negative": (F.count_if(y < 0), F.count_if(p < 0)),
    }
    moments = scored.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("statistic"),
                    actual.cast("double").alias("actual"),
                    predicted.cast("double").alias("predicted"),
                )
                for name, (actual, predicted) in names.items()
            ]
        ).alias("rows")
    ).select(F.explode("rows").alias("row"))
    quantiles = exact_quantiles(
        _stacked(scored, [ACTUAL, PREDICTED]),
        "value",
        [q / 100 for q in DEMAND_PERCENTILES],
        ["metric"],
        few_groups=True,
    )
    percentiles = quantiles.groupBy(
        F.concat(F.lit("p"), F.round(F.col("prob") * 100).cast("int").cast("string")).alias("statistic")
    ).agg(
        F.max(F.when(F.col("metric") == ACTUAL, F.col("quantile"))).alias("actual"),
        F.max(F.when(F.col("metric") == PREDICTED, F.col("quantile"))).alias("predicted"),
    )
    return moments.select("row.*").unionByName(percentiles)


def demand_totals(scored: DataFrame) -> DataFrame:
    """One row: means and totals of actual and predicted demand, differences and ratios."""
    y, p = F.col(ACTUAL), F.col(PREDICTED)
    totals = scored.agg(
        F.avg(y).alias("mean_actual"),
        F.avg(p).alias("mean_predicted"),
        F.sum(y).alias("total_actual"),
        F.sum(p).alias("total_predicted"),
    )
    zero = F.lit(0.0)
    return totals.withColumns(
        {
            "mean_difference": F.col("mean_predicted") - F.col("mean_actual"),
            "mean_ratio": F.col("mean_predicted") / F.nullif("mean_actual", zero),
            "total_difference": F.col("total_predicted") - F.col("total_actual"),
            "total_ratio": F.col("total_predicted") / F.nullif("total_actual", zero),
        }
    )


def bias_summary(scored: DataFrame) -> DataFrame:
    """One row: mean and median error, and the direction of the mean."""
    errors = with_errors(scored)
    return fold_rows(
        errors.agg(F.avg("error").alias("mean_bias")),
        exact_median(errors, "error", name="median_bias", few_groups=True),
    ).withColumn("direction", overall_bias_label(F.col("mean_bias")))


def metrics_by_range(scored: DataFrame) -> DataFrame:
    """Metrics per demand range; ranges without rows are listed with 0 rows."""
    measured = (
        with_errors(scored)
        .groupBy(demand_range(F.col(ACTUAL)).alias("demand_range"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg("abs_error").alias("mae"),
            F.sqrt(F.avg("squared_error")).alias("rmse"),
            F.avg(ACTUAL).alias("mean_actual"),
            F.avg(PREDICTED).alias("mean_pred"),
            F.avg("error").alias("bias"),
        )
    )
    names = F.array(*[F.lit(name) for name, _, _ in DEMAND_RANGES], F.lit(UNBUCKETED))
    listed = scored.sparkSession.range(1).select(F.explode(names).alias("demand_range"))
    over_ranges = Window.partitionBy(F.lit(0))  # six rows
    return (
        measured.join(listed, "demand_range", "right")
        .withColumn("rows", F.coalesce("rows", F.lit(0)))
        .withColumn("pct", percentage(F.col("rows"), F.sum("rows").over(over_ranges)))
        .withColumn("direction", range_bias_label(F.col("bias")))
    )


def sse_by_range(scored: DataFrame) -> DataFrame:
    """Share of rows and of squared error per demand range that has rows."""
    measured = (
        with_errors(scored)
        .groupBy(demand_range(F.col(ACTUAL)).alias("demand_range"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("squared_error").alias("sse"),
            F.sqrt(F.avg("squared_error")).alias("rmse"),
        )
    )
    over_ranges = Window.partitionBy(F.lit(0))  # six rows
    return measured.withColumns(
        {
            "pct_rows": percentage(F.col("rows"), F.sum("rows").over(over_ranges)),
            "pct_sse": percentage(F.col("sse"), F.sum("sse").over(over_ranges)),
        }
    ).withColumn("comment", sse_share_label(F.col("pct_rows"), F.col("pct_sse")))


def high_demand_report(scored: DataFrame, above: float = 20.0) -> DataFrame:
    """One row about rows whose actual demand is above a threshold."""
    high = with_errors(scored.where(F.col(ACTUAL) > above)).withColumn(
        "ratio", floored_ratio(F.col(PREDICTED), F.col(ACTUAL), 1e-6)
    )
    rows = F.count(F.lit(1))
    bucket = prediction_ratio_bucket(F.col("ratio"))
    measured = high.agg(
        rows.alias("rows"),
        F.count_if(F.col("error") < 0).alias("underpredicted"),
        F.count_if(F.col("error") > 0).alias("overpredicted"),
        percentage(F.count_if(F.col("error") < 0), rows).alias("underpredicted_pct"),
        percentage(F.count_if(F.col("error") > 0), rows).alias("overpredicted_pct"),
        F.avg(ACTUAL).alias("mean_actual"),
        F.avg(PREDICTED).alias("mean_pred"),
        F.avg("error").alias("mean_bias"),
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg("squared_error")).alias("rmse"),
        F.avg("ratio").alias("ratio_mean"),
        F.count_if(bucket == "< 0.5").alias("ratio_below_0_5"),
        F.count_if(bucket == "0.5-0.8").alias("ratio_0_5_to_0_8"),
        F.count_if(bucket == "0.8-1.2").alias("ratio_0_8_to_1_2"),
        F.count_if(bucket == "> 1.2").alias("ratio_above_1_2"),
    )
    return fold_rows(measured, exact_median(high, "ratio", name="ratio_median", few_groups=True))


def top_errors(scored: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` rows with the largest absolute error, ranked; ties by date, store, item."""
    order = [F.desc("abs_error"), F.asc("date"), F.asc("store_id"), F.asc("item_id")]
    largest = with_errors(scored).orderBy(*order).limit(n)
    return largest.withColumns(
        {
            "rank": F.row_number().over(Window.orderBy(*order)),  # over n rows
            "target_date": F.date_add("date", 1),
        }
    )


def top_error_share(scored: DataFrame, n: int = 30) -> DataFrame:
    """One row: overall metrics, and how much of the squared error the top rows hold."""
    top = top_errors(scored, n)
    return fold_rows(
        with_errors(scored).agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.avg("abs_error").alias("mae"),
            F.sqrt(F.avg("squared_error")).alias("rmse"),
            (F.sum("abs_error") / F.nullif(F.sum(F.abs(ACTUAL)), F.lit(0.0)) * 100.0).alias("wape"),
            F.sum("squared_error").alias("total_sse"),
        ),
        top.agg(
            F.count(F.lit(1)).alias("top_rows"),
            F.sum("squared_error").alias("top_sse"),
            F.min("abs_error").alias("top_min_abs_error"),
            F.max("abs_error").alias("top_max_abs_error"),
            F.min(ACTUAL).alias("top_min_actual"),
            F.max(ACTUAL).alias("top_max_actual"),
            F.min(PREDICTED).alias("top_min_predicted"),
            F.max(PREDICTED).alias("top_max_predicted"),
        ),
    ).withColumn("top_sse_share_pct", percentage(F.col("top_sse"), F.col("total_sse")))


def sample_predictions(scored: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` scored rows by store, item and date."""
    return (
        scored.select(
            "store_id",
            "item_id",
            "date",
            F.col(ACTUAL).alias("actual"),
            PREDICTED,
            F.abs(F.col(ACTUAL) - F.col(PREDICTED)).alias("abs_error"),
        )
        .orderBy("store_id", "item_id", "date")
        .limit(n)
    )
