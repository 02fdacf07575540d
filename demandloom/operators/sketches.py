"""Mergeable summaries of the raw sales: distinct counts and quantiles of any period without a rescan.

One pass over the sales gives a small row of sketches for each day and store. A period, a store or the whole
history is the union of its rows. Exact counts and quantiles stay the default elsewhere; these are for when
the rows are too many to read again for each question.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the registers of a distinct-count sketch, and the level of a quantile sketch.
HLL_BITS, KLL_LEVEL = 14, 400
#: Sketched columns: what is counted, and what has quantiles.
COUNTED, MEASURED = ("item_id", "store_id"), ("quantity", "price_base")


def count_error(bits: int = HLL_BITS) -> float:
    """Three standard errors of an estimated distinct count, as a share of the true one."""
    return 3 * 1.04 / math.sqrt(1 << bits)


def rank_error(level: int = KLL_LEVEL) -> float:
    """Largest usual distance of an estimated quantile's rank from the wanted one, as a share of all values.

    The published bound of a two-sided rank query at 99 %, which falls as 1 / level ** 0.9021.
    """
    return 2.446 / level**0.9021


def _measure(column: str) -> Column:
    """Finite values only, as the exact quantiles take them."""
    value = F.col(column).cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def sales_sketches(sales: DataFrame, by: Sequence[str] = ("date", "store_id"), hll_bits: int = HLL_BITS, kll_level: int = KLL_LEVEL) -> DataFrame:
    """One row of sketches for each ``by``: ``rows``, ``{column}_distinct`` and ``{column}_values``.

    Sketches are merged where the rows are, so a hot day or store moves a few sketches, not its rows. NULLs count
    in no sketch; the sketch of a group without any value is NULL.
    """
    return sales.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.when(F.count(c) > 0, F.hll_sketch_agg(F.col(c).cast("string"), hll_bits)).alias(f"{c}_distinct")
            for c in COUNTED
        ],
        *[F.when(F.count(_measure(c)) > 0, F.kll_sketch_agg_double(_measure(c), kll_level)).alias(f"{c}_values") for c in MEASURED],
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """The same summaries of larger groups (none: of everything), from the stored rows alone."""
    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        *[F.hll_union_agg(f"{c}_distinct").alias(f"{c}_distinct") for c in COUNTED],
        *[F.when(F.count(f"{c}_values") > 0, F.kll_merge_agg_double(f"{c}_values")).alias(f"{c}_values") for c in MEASURED],
    )


def distinct_estimates(merged: DataFrame) -> DataFrame:
    """``{column}_distinct`` as numbers (0 without a sketch); quantile sketches are dropped."""
    counts = {f"{c}_distinct": F.coalesce(F.hll_sketch_estimate(f"{c}_distinct"), F.lit(0).cast("long")) for c in COUNTED}
    return merged.withColumns(counts).drop(*[f"{c}_values" for c in MEASURED])


def quantile_estimates(merged: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, prob, quantile)`` as the exact quantiles give, for each row of ``merged`` with any value."""
    wanted = F.array(*[F.lit(float(p)) for p in sorted(set(probs))])
    sketch = F.col(f"{value}_values")
    return (
        merged.where(sketch.isNotNull())
        .select(*by, F.arrays_zip(wanted.alias("prob"), F.kll_sketch_get_quantile_double(sketch, wanted).alias("quantile")).alias("pairs"))
        .select(*by, F.inline("pairs").alias("prob", "quantile"))
    )


def month(date: str = "date") -> Column:
    return F.date_format(date, "yyyy-MM").alias("month")


def counts_within_bound(sales: DataFrame, estimates: DataFrame, by: Sequence[Column], keys: Sequence[str], hll_bits: int = HLL_BITS) -> DataFrame:
    """Exact distinct counts next to whether the estimates lie within ``count_error`` of them."""
    exact = sales.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_distinct(c).alias(f"{c}_exact") for c in COUNTED]
    )
    near = [
        (F.abs(F.col(f"{c}_distinct") - F.col(f"{c}_exact")) <= count_error(hll_bits) * F.col(f"{c}_exact")).alias(f"{c}_within")
        for c in COUNTED
    ]
    return exact.join(estimates.drop("rows"), list(keys)).select(*keys, "rows", *[f"{c}_exact" for c in COUNTED], *near)


def ranks_within_bound(values: DataFrame, value: str, estimates: DataFrame, by: Sequence[str], error: float) -> DataFrame:
    """``(*by, prob, values, within)``: whether each estimate's rank is within ``error`` of its probability.

    An estimate that occurs many times has a range of ranks; any of them may be the right one.
    """
    x, guess = F.col("_x"), F.col("quantile")
    rows = values.select(*by, F.col(value).cast("double").alias("_x")).where(F.abs("_x") < float("inf"))
    # equal values count once with their number
    counted = rows.groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_n"))
    guesses = estimates.groupBy(*by).agg(F.collect_list(F.struct("prob", "quantile")).alias("_guesses"))
    placed = counted.join(guesses, list(by)).select(*by, "_x", "_n", F.inline("_guesses"))
    ranks = placed.groupBy(*by, "prob").agg(
        F.sum("_n").alias("values"),
        F.sum(F.when(x < guess, F.col("_n")).otherwise(0)).alias("_below"),
        F.sum(F.when(x <= guess, F.col("_n")).otherwise(0)).alias("_upto"),
    )
    low, high = F.col("_below") / F.col("values") - error, F.col("_upto") / F.col("values") + error
    return ranks.select(*by, "prob", "values", F.col("prob").between(low, high).alias("within"))
