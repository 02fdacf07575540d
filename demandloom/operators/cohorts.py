"""Cold-start audit: overlapping cohorts of scored rows, and items never seen in training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.scoring import percentage, safe_r2
from demandloom.operators.catalog import first_per_item
from demandloom.operators.splits import select_period
from demandloom.schemas import Period

NOT_IN_CATALOG = "NOT IN CATALOG"


def items_in_period(prepared: DataFrame, period: Period) -> DataFrame:
    """Distinct items with a row in the period, in any store."""
    return select_period(prepared, period).select("item_id").where(F.col("item_id").isNotNull()).distinct()


def cohort_rules(anomaly_item: str) -> dict[str, Column]:
    """Cohort name -> test over ``seen`` (item in training), ``item_id`` and ``young``."""
    seen, young = F.col("seen"), F.col("young")
    anomaly = F.col("item_id").eqNullSafe(anomaly_item)
    # Cohort names.
    return {
        "All Test Records (Baseline)": F.lit(True),
        "Seen in Training (All)": seen,
        "Unseen in Training (All Cold-Start)": ~seen,
        f"Unseen in Training (Excl. {anomaly_item})": ~seen & ~anomaly,
        f"Product {anomaly_item} Alone": anomaly,
        "In First 28 Days (lag_28 is NaN)": young,
        "Mature History (lag_28 is Available)": ~young,
        "Seen in Training & Mature (lag_28 Available)": seen & ~young,
        "Seen in Training & Incomplete (lag_28 is NaN)": seen & young,
    }


def _per_item(scored: DataFrame, *more: str) -> DataFrame:
    """Mergeable error sums per item (and ``more`` columns): all that the cohorts need."""
    y, p = F.col("target"), F.col("predicted")
    return scored.groupBy("item_id", *more).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(y).alias("sum_y"),
        F.sum(F.abs(y)).alias("sum_abs_y"),
        F.avg(y).alias("mean_y"),
        (F.var_pop(y) * F.count(y)).alias("dev_y"),
        F.sum(p).alias("sum_p"),
        F.sum(F.abs(p - y)).alias("sum_abs_err"),
        F.sum((p - y) * (p - y)).alias("sum_sq_err"),
    )


def cohort_metrics(
    scored: DataFrame, training_items: DataFrame, anomaly_item: str
) -> DataFrame:
    """Regression metrics of nine overlapping cohorts, and their share of squared error.

    Rows are first reduced to sums per item and history state. Membership in training is
    looked up per item, and only these few sums are copied into the cohorts they belong to.
    """
    rules = cohort_rules(anomaly_item)
    sums = _per_item(scored.withColumn("young", F.col("lag_28").isNull()), "young")
    known = training_items.select("item_id").distinct().withColumn("seen", F.lit(True))
    marked = sums.join(known, "item_id", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
    names = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    members = marked.withColumn("cohort", F.explode(names))

    n, sum_y, sse = F.sum("n"), F.sum("sum_y"), F.sum("sum_sq_err")
    # Squared deviations within items, plus those of the item means. The means are taken from
    # the overall mean first, so that large values do not cancel.
    centre = sums.agg(F.sum("sum_y") / F.sum("n")).scalar()
    off = F.col("mean_y") - F.coalesce(centre, F.lit(0.0))
    between = F.sum(F.col("n") * off * off) - F.sum(F.col("n") * off) * F.sum(F.col("n") * off) / n
    measured = members.groupBy("cohort").agg(
        n.alias("rows"),
        F.count_distinct("item_id").alias("unique_products"),
        (F.sum("sum_abs_err") / n).alias("mae"),
        F.sqrt(sse / n).alias("rmse"),
        safe_r2(sse, F.sum("dev_y") + between, n).alias("r2"),
        (F.sum("sum_abs_err") / F.nullif(F.sum("sum_abs_y"), F.lit(0.0)) * 100.0).alias("wape"),
        (sum_y / n).alias("mean_actual"),
        (F.sum("sum_p") / n).alias("mean_pred"),
        ((F.sum("sum_p") - sum_y) / n).alias("bias"),
        sse.alias("sse"),
    )
    listed = scored.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(name) for name in rules])).alias("cohort")
    )
    full = measured.join(listed, "cohort", "right").withColumns(
        {
            "rows": F.coalesce("rows", F.lit(0)),
            "unique_products": F.coalesce("unique_products", F.lit(0)),
            "sse": F.coalesce("sse", F.lit(0.0)),
        }
    )
    baseline = next(iter(rules))
    total = full.where(F.col("cohort") == baseline).select(F.col("sse").alias("total")).limit(1)
    return full.withColumn(
        "sse_share_pct", F.col("sse") / F.greatest(total.scalar(), F.lit(1e-6)) * 100.0
    )


def unseen_items(scored: DataFrame, training_items: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per scored item that training never saw, by total demand."""
    y, p = F.col("target"), F.col("predicted")
    per_item = scored.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_distinct("store_id").alias("stores_count"),
        F.sum(y).alias("total_demand"),
        F.avg(y).alias("mean_actual"),
        F.avg(p).alias("mean_pred"),
        F.avg(F.abs(p - y)).alias("mae"),
        F.sqrt(F.avg((p - y) * (p - y))).alias("rmse"),
        (F.sum(F.abs(p - y)) / F.greatest(F.sum(y), F.lit(1e-6)) * 100.0).alias("wape"),
        percentage(F.count_if(F.col("lag_28").isNull()), F.count(F.lit(1))).alias("lag28_null_pct"),
    )
    labels = first_per_item(catalog.select("item_id", "row_order", "dept_name", "class_name"))
    catalogued = labels.withColumn("_found", F.lit(True))
    fallback = F.when(F.col("_found").isNull(), F.lit(NOT_IN_CATALOG))
    return (
        per_item.join(training_items, "item_id", "left_anti")
        .join(catalogued, "item_id", "left")
        .select(
            *per_item.columns,
            F.coalesce(fallback, "dept_name").alias("dept_name"),
            F.coalesce(fallback, "class_name").alias("class_name"),
        )
        .orderBy(F.desc("total_demand"), "item_id")
    )


def shared_items(left: DataFrame, right: DataFrame) -> DataFrame:
    """Items that occur in both tables."""
    return left.select("item_id").distinct().join(right.select("item_id").distinct(), "item_id", "left_semi")


def items_only_left(left: DataFrame, right: DataFrame) -> DataFrame:
    """Items of ``left`` that ``right`` does not hold."""
    return left.select("item_id").distinct().join(right.select("item_id").distinct(), "item_id", "left_anti")
