"""Gapless series and the features on top of them."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandloom.operators import demand, features
from demandloom.schemas import DAY_KEYS, FEATURE_TABLE_COLUMNS

START = dt.date(2024, 1, 1)


def random_daily(make_demand, seed=1, series=6, days=90):
    rng = random.Random(seed)
    rows = []
    for s in range(series):
        for d in sorted(rng.sample(range(days), rng.randint(1, days))):
            price = None if rng.random() < 0.2 else round(rng.uniform(1, 9), 2)
            rows.append((d, s % 2, f"item{s}", rng.choice([-3.0, 0.0, 1.0, 2.5, 7.0, 100.0]), price))
    return make_demand(rows), rows


def expected_prepared(rows):
    """Calendar grid, left join, fill: the other way to the same series."""
    frame = pd.DataFrame(rows, columns=["day", "store_id", "item_id", "daily_demand", "price"])
    parts = []
    for (store, item), group in frame.groupby(["store_id", "item_id"]):
        full = group.set_index("day").reindex(range(group.day.min(), group.day.max() + 1))
        full["daily_demand"] = full["daily_demand"].clip(lower=0).fillna(0.0)
        full["price"] = full["price"].ffill()
        full["store_id"], full["item_id"] = store, item
        parts.append(full.reset_index())
    return pd.concat(parts)


def test_prepared_equals_grid_join(make_demand):
    daily, rows = random_daily(make_demand)
    found = demand.prepare_demand(daily).toPandas()
    found["day"] = (pd.to_datetime(found["date"]) - pd.Timestamp(START)).dt.days
    order = ["store_id", "item_id", "day"]
    columns = [*order, "daily_demand", "price"]
    left = found.sort_values(order)[columns].reset_index(drop=True)
    right = expected_prepared(rows).sort_values(order)[columns].reset_index(drop=True)
    pd.testing.assert_frame_equal(left, right, check_dtype=False)


def test_preparing_twice_changes_nothing(make_demand):
    daily, _ = random_daily(make_demand, seed=5)
    once = demand.prepare_demand(daily)
    twice = demand.prepare_demand(once, partitions=3)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_row_count_is_known_beforehand(make_demand):
    daily, _ = random_daily(make_demand, seed=9)
    assert demand.prepared_row_count(daily).first()[0] == demand.prepare_demand(daily).count()


def test_leading_missing_price_stays_missing_and_observed_one_is_repaired(make_demand):
    daily = make_demand([(0, 1, "a", 1.0, None), (1, 1, "a", 1.0, 5.0), (4, 1, "a", 1.0, None), (5, 1, "a", 2.0, 6.0)])
    rows = demand.prepare_demand(daily).orderBy("date").collect()
    assert [r.price for r in rows] == [None, 5.0, 5.0, 5.0, 5.0, 6.0]
    assert [r.daily_demand for r in rows] == [1.0, 1.0, 0.0, 0.0, 1.0, 2.0]


def test_missing_demand_counts_as_zero(make_demand):
    daily = make_demand([(0, 1, "a", None, 1.0), (1, 1, "a", -1.0, 1.0)])
    assert [r.daily_demand for r in demand.prepare_demand(daily).collect()] == [0.0, 0.0]


def pandas_features(rows):
    frame = expected_prepared(rows).sort_values(["store_id", "item_id", "day"])
    grouped = frame.groupby(["store_id", "item_id"])["daily_demand"]
    frame["target"] = grouped.shift(-1)
    for k in (1, 7, 14, 28):
        frame[f"lag_{k}"] = grouped.shift(k)
    before = grouped.shift(1).groupby([frame["store_id"], frame["item_id"]])
    for n in (7, 14, 28):
        frame[f"rolling_mean_{n}"] = before.transform(lambda s, n=n: s.rolling(n).mean())
    for n in (7, 28):
        frame[f"rolling_std_{n}"] = before.transform(lambda s, n=n: s.rolling(n).std())
    frame["price_change"] = frame["price"] - frame.groupby(["store_id", "item_id"])["price"].shift(1)
    return frame[frame["target"].notna()]


def test_series_features_match_pandas(make_demand):
    daily, rows = random_daily(make_demand, seed=2)
    found = features.series_features(demand.prepare_demand(daily)).toPandas()
    found["day"] = (pd.to_datetime(found["date"]) - pd.Timestamp(START)).dt.days
    expected = pandas_features(rows)
    order = ["store_id", "item_id", "day"]
    columns = [*order, *[c for c in expected.columns if c in found.columns and c not in order]]
    pd.testing.assert_frame_equal(
        found.sort_values(order)[columns].reset_index(drop=True),
        expected.sort_values(order)[columns].reset_index(drop=True),
        check_dtype=False,
        atol=1e-9,
    )


def test_other_windows_slide_over_frames(make_demand):
    daily, _ = random_daily(make_demand, seed=4)
    prepared = demand.prepare_demand(daily)
    odd = features.add_rolling(prepared, (5, 7), (7,))
    blocks = features.add_rolling(prepared, (7,), (7,))
    joined = odd.alias("o").join(blocks.alias("b"), list(DAY_KEYS))
    for name in ("rolling_mean_7", "rolling_std_7"):
        left, right = F.col(f"o.{name}"), F.col(f"b.{name}")
        differs = (left.isNull() != right.isNull()) | (F.abs(left - right) > 1e-9)
        assert joined.where(differs).count() == 0
    assert odd.where("rolling_mean_5 IS NOT NULL").count() > 0


@pytest.mark.parametrize("days, defined", [(7, 0), (8, 1)])
def test_first_full_week_is_the_eighth_row(make_demand, days, defined):
    daily = make_demand([(d, 1, "a", 1.0, 1.0) for d in range(days)])
    prepared = features.add_rolling(demand.prepare_demand(daily))
    assert prepared.where("rolling_mean_7 IS NOT NULL").count() == defined
    assert prepared.where("rolling_std_7 = 0").count() == defined


def test_one_day_series_has_no_feature_row(make_demand):
    daily = make_demand([(0, 1, "a", 1.0, 1.0)])
    assert features.series_features(demand.prepare_demand(daily)).count() == 0


def test_todays_demand_leaks_into_no_feature_of_today(make_demand):
    rows = [(d, 1, "a", float(d % 5), 2.0) for d in range(60)]
    changed = [(d, s, i, 999.0 if d == 40 else q, p) for d, s, i, q, p in rows]

    def at(data):
        built = features.series_features(demand.prepare_demand(make_demand(data)))
        return built.where(F.col("date") == START + dt.timedelta(40)).first().asDict()

    assert at(rows) == at(changed)
    assert "daily_demand" not in at(rows)


def test_feature_table_layout_and_unknown_items(spark, make_demand):
    prepared = demand.prepare_demand(make_demand([(d, 1, "a", 1.0, 1.0) for d in range(5)]))
    items = spark.createDataFrame([("b", 0)], "item_id string, item_code int")
    codes = spark.createDataFrame(
        [("b", 0, 0, 0, 0, 1.0, 1.0, 1.0)],
        "item_id string, dept_code int, class_code int, subclass_code int, item_type_code int, "
        "weight_volume double, weight_netto double, fatness double",
    )
    built = features.build_features(prepared, items, codes)
    assert tuple(built.columns) == FEATURE_TABLE_COLUMNS and len(built.columns) == 28
    row = built.first()
    assert (row.item_code, row.dept_code) == (-1, None)
    shaped = features.model_input(built).first()
    assert (shaped.item_code, shaped.dept_code, shaped.store_id) == (0, 0, 2)
    with pytest.raises(Exception, match="duplicate key"):
        features.build_features(prepared, items, codes.union(codes)).collect()


def test_category_below_minus_one_fails(spark):
    columns = features.MODEL_COLUMNS
    row = spark.range(1).select(*[F.lit(0).alias(c) for c in columns]).withColumn("dept_code", F.lit(-2))
    with pytest.raises(Exception, match="value below -1 in categorical column dept_code"):
        features.model_input(row, []).collect()


def test_empty_feature_set_is_an_error(make_demand):
    with pytest.raises(RuntimeError, match="no rows found"):
        features.require_rows(make_demand([]), "feature table")
