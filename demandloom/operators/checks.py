"""Counts of nulls, duplicates and key violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_count_columns(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]


def null_counts(df: DataFrame) -> DataFrame:
    """One row ``(column_name, null_count)`` per column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], list(df.columns), "column_name", "null_count")


def duplicate_rows(df: DataFrame, ignore: Sequence[str] = ("Unnamed: 0",)) -> DataFrame:
    """Rows that repeat an earlier row, counted without the index column of a text export.

    Copies collapse before the shuffle, so a row repeated a billion times costs no more
    than one that is repeated twice.
    """
    columns = [c for c in df.columns if c not in ignore]
    copies = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_records"),
    ).withColumn(
        "duplicate_pct",
        F.when(
            F.col("total_records") > 0, F.col("duplicate_records") / F.col("total_records") * 100.0
        ).otherwise(F.lit(0.0)),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the number of rows beyond the first per key."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_keys"))


def unique_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, failing at run time if a key occurs twice."""
    rest = [c for c in df.columns if c not in keys]
    message = F.concat_ws(" ", F.lit("duplicate key:"), *[F.col(k).cast("string") for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_copies"), F.first(F.struct(*rest)).alias("_row"))
        .withColumn("_row", F.when(F.col("_copies") == 1, F.col("_row")).otherwise(F.raise_error(message)))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def fold_rows(*single_rows: DataFrame) -> DataFrame:
    """Merge one-row results with different columns into one row, without a cross join."""
    stacked = single_rows[0]
    for row in single_rows[1:]:
        stacked = stacked.unionByName(row, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
