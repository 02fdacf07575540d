"""Long-form reports: every figure of a report's sections as rows ``(section, entry, metric, value, text)``.

``entry`` names what a figure belongs to within its section: a case, a cohort, an item. Numbers and flags
(0 and 1) are values; dates, labels and lists of days are texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.calendar import iso_text
from demandloom.operators import cohorts, evaluation, investigation

_NUMBERS = ("double", "float", "int", "bigint", "boolean")


def _cell(name: str, kind: str) -> Column | None:
    """One figure as ``(metric, value, text)``; other types have none."""
    value, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    if kind in _NUMBERS:
        value = F.col(name).cast("double")
    elif kind == "date":
        text = iso_text(F.col(name))
    elif kind == "string":
        text = F.col(name)
    elif kind == "array<double>":
        text = F.array_join(F.transform(name, lambda x: F.round(x, 6).cast("decimal(28,6)").cast("string")), ",")
    else:
        return None
    return F.struct(F.lit(name).alias("metric"), value.alias("value"), text.alias("text"))


def long_form(section: str, df: DataFrame, entry: Column) -> DataFrame:
    """A result as report rows: a row of ``df`` becomes one for each of its columns."""
    cells = [cell for name, kind in df.dtypes if (cell := _cell(name, kind)) is not None]
    return df.select(F.lit(section).alias("section"), entry.cast("string").alias("entry"), F.inline(F.array(*cells)))


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def investigation_report(scored: DataFrame, investigated: DataFrame, top_n: int = 30) -> DataFrame:
    """The report on the largest errors: overall figures, classes, and each case with all its figures.

    ``scored`` holds the test period, ``investigated`` its cases (pin them: two sections read them).
    """
    classes = investigation.classification_counts(investigated)
    return _stack(
        [
            long_form("summary", evaluation.top_error_share(scored, top_n), F.lit("test")),
            long_form("classification", classes.withColumnRenamed("classification", "_label"), F.col("_label")).where("metric <> '_label'"),
            long_form("case", investigated, F.col("rank")),
        ]
    )


def cold_start_report(scored: DataFrame, training_items: DataFrame, catalog: DataFrame, anomaly_item: str) -> DataFrame:
    """The report on items new to the model: how many there are, each cohort's metrics, each unseen item."""
    known = training_items.select("item_id").distinct()
    active = scored.select("item_id").distinct()
    counts = (
        active.join(known.withColumn("_seen", F.lit(1)), "item_id", "full_outer")
        .join(active.withColumn("_active", F.lit(1)), "item_id", "left")
        .agg(
            F.count("_seen").alias("training_items"),
            F.count("_active").alias("active_items"),
            F.count_if(F.col("_seen").isNull()).alias("unseen_items"),
        )
    )
    cohort = cohorts.cohort_metrics(scored, training_items, anomaly_item).withColumnRenamed("cohort", "_label")
    unseen = cohorts.unseen_items(scored, training_items, catalog).withColumnRenamed("item_id", "_label")
    return _stack(
        [
            long_form("overview", counts, F.lit("test")),
            *[
                long_form(name, df, F.col("_label")).where("metric <> '_label'")
                for name, df in (("cohort", cohort), ("unseen_item", unseen))
            ],
        ]
    )
