"""Retail tables derived from the TPC-H-like test tables.

One sale per order line, the brand (or another item rule) as item, four stores. The two
launch brands, the near-zero price, the returns and the bad prices give every operator
something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.schemas import SplitSpec

ANOMALY_ITEM = "Brand#7"
LAUNCH_ITEMS = ("Brand#7", "Brand#13")
#: Launch items are sold under another id before this day.
LAUNCH, BEFORE_LAUNCH = "2001-07-01", "/old"

VIEW_SPLITS = SplitSpec.of(
    train=("1995-01-01", "2001-01-31"),
    validation=("2001-02-01", "2001-05-31"),
    test=("2001-06-01", "2001-12-31"),
)


def _item(rule: str) -> Column:
    """Brands for checks, the finer rules for benchmarks."""
    if rule == "brand":
        return F.col("p_brand")
    if rule == "mid":
        return F.concat_ws("/", "p_brand", "p_type")
    if rule == "wide":
        return F.col("l_partkey").cast("string")
    raise ValueError(f"unknown item rule: {rule}")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sales_view(
    spark: SparkSession, folder: str, rule: str = "brand", days: tuple[str, str] | None = None
) -> DataFrame:
    """One sale per order line, all of them; ``days`` keeps a period (benchmarks only)."""
    day = F.col("l_shipdate").cast("date")
    lines = _table(spark, folder, "lineitem")
    if days:
        lines = lines.where(day.between(*(F.lit(d).cast("date") for d in days)))
    early = F.col("item_id").isin(*LAUNCH_ITEMS) & (day < F.lit(LAUNCH).cast("date"))
    base = (
        lines.join(_table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("item_id", _item(rule))
        .withColumn("item_id", F.when(early, F.concat("item_id", F.lit(BEFORE_LAUNCH))).otherwise(F.col("item_id")))
    )
    anomaly = F.col("item_id") == ANOMALY_ITEM
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") >= 6)
    return base.select(
        day.alias("date"),
        ((F.col("l_suppkey") % 4).cast("int") + 1).alias("store_id"),
        "item_id",
        F.when(anomaly, F.col("l_quantity") * 100)
        .when(returned, -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
        .alias("quantity"),
        F.when(anomaly, F.lit(0.01))
        .when(F.col("l_orderkey") % 97 == 0, -F.col("p_retailprice"))
        .otherwise(F.col("p_retailprice"))
        .alias("price_base"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("sum_total"),
    )


def catalog_view(spark: SparkSession, folder: str, rule: str = "brand") -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    part = _table(spark, folder, "part").withColumn("l_partkey", key)
    return part.select(
        _uncatalogued(_item(rule)).alias("item_id"),
        key.alias("row_order"),
        F.when(key % 11 != 0, F.col("p_type")).alias("dept_name"),
        F.concat(F.col("p_type"), F.lit("-"), (size % 5).cast("string")).alias("class_name"),
        F.concat(F.lit("S"), (size % 10).cast("string")).alias("subclass_name"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("item_type"),
        F.when(key % 10 == 0, F.lit("n/a")).otherwise(size.cast("string")).alias("weight_volume"),
        (size * 2).cast("string").alias("weight_netto"),
        F.when(key % 3 != 0, (size % 4).cast("string")).alias("fatness"),
    )


def _uncatalogued(item: Column) -> Column:
    """The anomaly item has no rows of its own in the other tables: they go to its old id."""
    return F.when(item == ANOMALY_ITEM, F.concat(item, F.lit(BEFORE_LAUNCH))).otherwise(item)


def price_history_view(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").select(
        F.col("p_brand").alias("item_id"),
        F.lit("1999-07-01").cast("date").alias("date"),
        F.col("p_retailprice").alias("price"),
    )


def discounts_history_view(spark: SparkSession, folder: str) -> DataFrame:
    """Items with large parts; the others stand under ids that no sale has."""
    item = _uncatalogued(F.col("p_brand"))
    listed = F.when(F.col("p_size") > 45, item).otherwise(F.concat(item, F.lit("/plain")))
    return _table(spark, folder, "part").select(listed.alias("item_id")).distinct()
