import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from demandloom.operators import quantiles
from demandloom.operators.quantiles import exact_median, exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def as_dict(df, by):
    return {(*(r[b] for b in by), r["prob"]): r["quantile"] for r in df.collect()}


@pytest.mark.parametrize("few_groups", [True, False])
def test_matches_numpy_on_mixed_magnitudes(spark, few_groups):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(0, 1, 500), rng.normal(0, 1e6, 200), rng.normal(0, 1e-9, 200), np.zeros(300)])
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    found = as_dict(exact_quantiles(df, "v", PROBS, few_groups=few_groups), [])
    for p in PROBS:
        assert found[(p,)] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-15)


@pytest.mark.parametrize("few_groups", [True, False])
def test_groups_with_one_hot_group_and_nulls(spark, few_groups):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(
        {
            "g": ["hot"] * 4000 + ["a"] * 3 + ["b"] * 2 + ["one"],
            "v": [*np.round(rng.exponential(20, 4000), 2), 1.0, 2.0, 4.0, -5.0, 5.0, 9.0],
        }
    )
    df = spark.createDataFrame(frame).unionByName(spark.sql("SELECT 'empty' AS g, CAST(NULL AS DOUBLE) AS v"))
    found = as_dict(exact_quantiles(df, "v", PROBS, ["g"], few_groups), ["g"])
    expected = frame.groupby("g")["v"].quantile(PROBS)
    assert set(found) == set(expected.index)
    for key, value in found.items():
        assert value == pytest.approx(expected[key], rel=1e-12)


@pytest.mark.parametrize("few_groups", [True, False])
def test_a_narrow_range_is_opened_until_it_is_small(spark, few_groups):
    """Half a million distinct values within 0.2: no bucket that is put in order holds more than FINEST."""
    n = 500_000
    df = spark.range(n, numPartitions=4).select((1000.0 + 0.2 * F.col("id") / n).alias("v"))
    values = 1000.0 + 0.2 * np.arange(n) / n
    found = as_dict(exact_quantiles(df, "v", PROBS, few_groups=few_groups), [])
    for p in PROBS:
        assert found[(p,)] == pytest.approx(np.quantile(values, p), rel=1e-14)
    finest = df.select(quantiles._bucket(F.col("v")).alias("b")).groupBy("b").count().agg(F.max("count")).first()[0]
    assert finest <= 2


def test_neighbouring_doubles_fill_a_finest_bucket_at_most(spark):
    """Consecutive doubles, the densest values there are."""
    for start in (1.0, 1000.0, 3.7e-200, 1.9999):
        x = start + np.spacing(start) * np.arange(300_000)
        b = spark.createDataFrame(pd.DataFrame({"v": x})).select(quantiles._bucket(F.col("v")).alias("b"), "v")
        assert b.groupBy("b").count().agg(F.max("count")).first()[0] <= quantiles.FINEST
        assert b.groupBy("b").agg(F.min("v").alias("low"), F.max("v").alias("high")).selectExpr(
            "low <= coalesce(lag(high) OVER (ORDER BY b), -1) AS overlaps"
        ).where("overlaps").count() == 0


def test_negative_zero_is_zero(spark):
    df = spark.createDataFrame([(-0.0,), (0.0,), (0.0,)], "v double")
    assert exact_median(df, "v", few_groups=True).collect()[0][0] == 0.0


def test_empty_input_has_no_median(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_median(df, "v", few_groups=True).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e12, 1e12, allow_subnormal=False), min_size=1, max_size=40))
def test_any_list_of_numbers(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = as_dict(exact_quantiles(df, "v", [0.25, 0.5, 0.9]), [])
    for (p,), value in found.items():
        assert value == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)
