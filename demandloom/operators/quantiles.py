"""Exact quantiles that never gather a whole group in one task.

The built-in ``percentile`` keeps one map of all distinct values per group, in one task. Here values
are counted in buckets that never overlap and grow with the value, nested in ``LEVELS``: a bucket of one level is cut
into at most 8,192 of the next. From the coarsest level down only the buckets with a wanted position are
opened, so a window sees the buckets inside one bucket. The finest hold values that agree in their
first 37 bits or so: no more than ``FINEST`` doubles exist in one of them, and only those of the wanted ones
are put in order, whatever range the values come from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of the finest bucket number that each level drops, coarsest first.
LEVELS = (26, 13, 0)
#: The finest buckets are ``2 ** -FINE_BITS`` of a value wide.
FINE_BITS = 37
#: Doubles in a finest bucket, at most.
FINEST = 1 << 16
# ln of the smallest positive double is about -745, so the shift keeps magnitudes positive.
_SHIFT = 746 << FINE_BITS


def _bucket(value: Column) -> Column:
    """Number of the finest bucket; it never decreases as the value grows."""
    magnitude = F.floor(F.ln(F.abs(value)) * (1 << FINE_BITS)) + _SHIFT
    return F.when(value == 0, F.lit(0).cast("long")).when(value > 0, magnitude).otherwise(-magnitude)


def _level(dropped: int) -> Column:
    return F.shiftright("_b", dropped) if dropped else F.col("_b")


def _explode_probs(counts: DataFrame, within: list[str], probs: Sequence[float]) -> DataFrame:
    """Coarsest buckets with the 1-based positions of the order statistics around p * (n - 1) that they hold."""
    whole = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    up_to_here = whole.orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    position = F.col("_prob") * (F.col("_n") - 1)
    return (
        counts.withColumn("_n", F.sum("_w").over(whole))
        .withColumn("_before", F.sum("_w").over(up_to_here) - F.col("_w"))
        .withColumn("_prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("_low", F.floor(position) + 1)
        .withColumn("_high", F.ceil(position) + 1)
        .withColumn("_share", position - F.floor(position))
    )


def _with_wanted(rows: DataFrame, by: list[str]) -> DataFrame:
    """Buckets that hold a wanted position, each once with its positions; counts start before it."""
    hit = (F.col("_high") > F.col("_before")) & (F.col("_low") <= F.col("_before") + F.col("_w"))
    return (
        rows.where(hit)
        .groupBy(*by, F.col("_at").alias("_parent"))
        .agg(F.first("_before").alias("_start"), F.collect_list(F.struct("_prob", "_low", "_high", "_share")).alias("_targets"))
    )


def _opened(rows: DataFrame, wanted: DataFrame, by: list[str], parent: Column) -> DataFrame:
    """Rows inside the wanted buckets with the count before each row and the positions asked for."""
    inside = Window.partitionBy(*by, "_parent").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_parent", parent)
        .join(wanted, [*by, "_parent"])
        .withColumn("_before", F.col("_start") + F.sum("_w").over(inside) - F.col("_w"))
        .select(*by, "_at", "_w", "_before", F.explode("_targets").alias("_t"))
        .select(*by, "_at", "_w", "_before", "_t.*")
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    few_groups: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles: one row ``(*by, prob, quantile)`` per group and prob.

    NULL, NaN and infinite values are left out, and so are groups without any other value.

    ``few_groups=True`` says that the number of groups is fixed by the program (for example
    metric names), not by the data. The wanted buckets are then a handful of rows, broadcast
    to a second scan of ``df``, and nothing but counts of coarse buckets and of what the wanted ones hold is
    shuffled. Otherwise ``df`` is first reduced to counts per distinct value, which all levels share.
    """
    by = list(by)
    probs = sorted(set(probs))
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.abs("_v") < float("inf"))
    rows = rows.withColumn("_v", F.col("_v") + F.lit(0.0))  # -0.0 and 0.0 are one value
    if few_groups:
        weighted = rows.withColumn("_w", F.lit(1).cast("long"))
    else:
        weighted = rows.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_w"))
    weighted = weighted.withColumn("_b", _bucket(F.col("_v")))

    def counted(rows: DataFrame, dropped: int) -> DataFrame:
        return rows.groupBy(*by, _level(dropped).alias("_at")).agg(F.sum("_w").alias("_w"))

    if few_groups:
        # at most two buckets per group and prob and level
        top = F.broadcast(_with_wanted(_explode_probs(counted(weighted, LEVELS[0]), by, probs), by))
        values = (
            weighted.withColumn("_parent", _level(LEVELS[0]))
            .join(top.select(*by, "_parent"), [*by, "_parent"], "left_semi")
            .groupBy(*by, "_parent", "_b", "_v")
            .agg(F.sum("_w").alias("_w"))
        )
    else:
        top, values = None, weighted
    # each level is counted from the one below it
    counts = {}
    finer = values
    for dropped in reversed(LEVELS):
        if dropped != LEVELS[-1]:
            finer = finer.withColumn("_b", F.shiftleft("_at", previous))
        previous = dropped
        finer = counts[dropped] = counted(finer, dropped)
    wanted = top if few_groups else _with_wanted(_explode_probs(counts[LEVELS[0]], by, probs), by)
    for above, dropped in zip(LEVELS, LEVELS[1:]):
        opened = _opened(counts[dropped], wanted, by, F.shiftright("_at", above - dropped))
        wanted = _with_wanted(opened, by)
        if few_groups:
            wanted = F.broadcast(wanted)
    ranked = _opened(values.select(*by, "_b", F.col("_v").alias("_at"), "_w"), wanted, by, F.col("_b")).withColumnRenamed("_at", "_v")

    def holds(rank: str) -> Column:
        return F.col(rank).between(F.col("_before") + 1, F.col("_before") + F.col("_w"))

    low = F.max(F.when(holds("_low"), F.col("_v")))
    high = F.max(F.when(holds("_high"), F.col("_v")))
    return (
        ranked.where(holds("_low") | holds("_high"))
        .groupBy(*by, F.col("_prob").alias("prob"))
        .agg(low.alias("_lo"), high.alias("_hi"), F.max("_share").alias("_share"))
        .select(
            *by,
            "prob",
            (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_share")).alias("quantile"),
        )
    )


def exact_median(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    name: str = "median",
    few_groups: bool = False,
) -> DataFrame:
    return exact_quantiles(df, value, [0.5], by, few_groups).select(
        *by, F.col("quantile").alias(name)
    )


def quantile_columns(quantiles: DataFrame, names: dict[float, str], by: Sequence[str] = ()) -> DataFrame:
    """Turn the long result into one row per group with a column per prob."""
    picks = [
        F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("quantile"))).alias(name)
        for p, name in names.items()
    ]
    return quantiles.groupBy(*by).agg(*picks)
