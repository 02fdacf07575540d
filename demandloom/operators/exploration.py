"""First look at the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.quantiles import exact_quantiles, quantile_columns


def column_types(df: DataFrame) -> DataFrame:
    """Column names and types; needs the schema only."""
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, data_type string")


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of numeric columns."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    values = df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")
    moments = values.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = quantile_columns(
        exact_quantiles(values, "value", [0.25, 0.5, 0.75], ["column_name"], few_groups=True),
        {0.25: "q25", 0.5: "q50", 0.75: "q75"},
        ["column_name"],
    )
    return moments.join(quartiles, "column_name", "left")


def distinct_counts(sales: DataFrame) -> DataFrame:
    """Products and stores that sold, counted over distinct pairs instead of rows."""
    pairs = sales.select("store_id", "item_id").distinct()
    return pairs.agg(
        F.count_distinct("item_id").alias("unique_products"),
        F.count_distinct("store_id").alias("unique_stores"),
    )


def sales_with_catalog(sales: DataFrame, catalog: DataFrame) -> DataFrame:
    """The plain left join, a row per catalog copy; for previews.

    The totals below give what a grouping of this join gives, without building it.
    """
    return sales.join(catalog, "item_id", "left")


def quantity_by_item(sales: DataFrame, catalog: DataFrame) -> DataFrame:
    """Quantity per item over the sales-catalog join.

    A product listed k times in the catalog counts k times, as in that join. The join itself
    runs on one row per item from either side.
    """
    sold = sales.where(F.col("item_id").isNotNull()).groupBy("item_id").agg(F.sum("quantity").alias("_sold"))
    listed = catalog.groupBy("item_id").agg(F.count(F.lit(1)).alias("_listed"))
    return sold.join(listed, "item_id", "left").select(
        "item_id",
        F.coalesce(F.col("_sold") * F.coalesce("_listed", F.lit(1)), F.lit(0.0)).alias("total_quantity"),
    )


def top_items(sales: DataFrame, catalog: DataFrame, n: int = 10) -> DataFrame:
    return quantity_by_item(sales, catalog).orderBy(F.desc("total_quantity"), "item_id").limit(n)


def department_sales(sales: DataFrame, catalog: DataFrame, n: int | None = 15) -> DataFrame:
    """Quantity per department over the sales-catalog join, largest first; no NULL department.

    Sales shrink to one row per item, the catalog to one row per item and department.
    """
    sold = sales.groupBy("item_id").agg(F.sum("quantity").alias("_sold"))
    listed = (
        catalog.where(F.col("dept_name").isNotNull())
        .groupBy("item_id", "dept_name")
        .agg(F.count(F.lit(1)).alias("_listed"))
    )
    totals = (
        sold.join(listed, "item_id")
        .groupBy("dept_name")
        .agg(F.coalesce(F.sum(F.col("_sold") * F.col("_listed")), F.lit(0.0)).alias("total_quantity"))
        .orderBy(F.desc("total_quantity"), "dept_name")
    )
    return totals if n is None else totals.limit(n)


def joined_row_count(sales: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows of the sales-catalog left join, without materialising it."""
    sold = sales.groupBy("item_id").agg(F.count(F.lit(1)).alias("_rows"))
    listed = catalog.groupBy("item_id").agg(F.count(F.lit(1)).alias("_listed"))
    return sold.join(listed, "item_id", "left").agg(
        F.sum(F.col("_rows") * F.coalesce("_listed", F.lit(1))).alias("rows")
    )
