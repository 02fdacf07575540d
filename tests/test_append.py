import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from demandloom.operators import catalog, demand, features
from demandloom.plans import append
from demandloom.plans.runs import StageFolder
from demandloom.schemas import CATALOG, DEMAND, SERIES_KEYS

START = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def daily(spark):
    """Six series over 75 days: steady, sparse, silent for 40 days, new on day 70, without prices, negative."""
    rng = random.Random(4)
    rows = []
    for day in range(75):
        rows.append((day, 1, "a", float(rng.randrange(9)), 2.0 + day % 3))
        if day % 9 == 0 or day in (71, 73):
            rows.append((day, 2, "a", float(rng.randrange(9)), None if day < 20 else 3.0))
        if day < 30 or day == 72:
            rows.append((day, 1, "b", float(rng.randrange(9)), 1.5))
        if day >= 70:
            rows.append((day, 1, "c", float(day), None))
        if day % 2:
            rows.append((day, 3, "b", -1.0 if day % 5 == 0 else 2.5, 4.0))
    data = [(START + dt.timedelta(d), *rest) for d, *rest in rows]
    return spark.createDataFrame(data, DEMAND)


@pytest.fixture(scope="module")
def dimensions(spark, daily):
    labels = [("a", "d", "c", "s", "t", "1", "2", "3"), ("b", "e", "c", "s", "t", "x", "2", None)]
    table = spark.createDataFrame(labels, CATALOG).withColumn("row_order", F.monotonically_increasing_id())
    return catalog.item_codes(daily), catalog.catalog_codes(table)


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rounded(df):
    """Sums of windows are put together in the same order, so few digits are enough."""
    return df.select(*[F.round(c, 9).alias(c) if k in ("double", "float") else F.col(c) for c, k in df.dtypes])


def test_days_one_by_one_equal_one_full_run(spark, daily, dimensions, tmp_path):
    stages = StageFolder(str(tmp_path))
    first, last = 69, 74
    day_of = lambda k: START + dt.timedelta(k)
    history = demand.prepare_demand(daily.where(F.col("date") <= F.lit(day_of(first))))
    built = features.build_features(history, *dimensions)
    append.start_appending(spark, stages, day_of(first), history, built)
    for k in range(first + 1, last + 1):
        day = day_of(k)
        append.append_day(spark, stages, day, daily.where(F.col("date") == F.lit(day)), *dimensions)

    prepared = demand.prepare_demand(daily)
    whole = features.build_features(prepared, *dimensions)
    once = ordered(rounded(append.appended(spark, stages).drop("run_date").select(*whole.columns)))
    assert once == ordered(rounded(whole))
    stored = append.appended(spark, stages, append.PREPARED).drop("run_date").select(*prepared.columns)
    assert ordered(stored) == ordered(prepared)

    # a day that is run again changes nothing
    state = ordered(spark.read.parquet(str(tmp_path / append.STATE)))
    again = append.append_day(spark, stages, day_of(last), daily.where(F.col("date") == F.lit(day_of(last))), *dimensions)
    assert ordered(rounded(append.appended(spark, stages).drop("run_date").select(*whole.columns))) == once
    assert ordered(spark.read.parquet(str(tmp_path / append.STATE))) == state
    assert again["state"].groupBy(*SERIES_KEYS).count().agg(F.max("count")).first()[0] == append.STATE_DAYS


def test_a_run_reads_its_day_and_the_state_only(spark, daily, dimensions, tmp_path):
    stages = StageFolder(str(tmp_path))
    day, later = START + dt.timedelta(40), START + dt.timedelta(41)
    append.start_appending(spark, stages, day, demand.prepare_demand(daily.where(F.col("date") <= F.lit(day))))
    (tmp_path / append.PREPARED).rename(tmp_path / "history-away")
    found = append.append_day(spark, stages, later, daily.where(F.col("date") == F.lit(later)), *dimensions)
    # each series that sold on the day has rows from the day its last row got a target
    assert {r[0] for r in found["features"].select("date").distinct().collect()} <= {day - dt.timedelta(d) for d in range(9)}


def test_beginning_with_nothing(spark, daily, dimensions, tmp_path):
    stages = StageFolder(str(tmp_path))
    none = demand.prepare_demand(daily.where("false"))
    append.start_appending(spark, stages, START - dt.timedelta(1), none)
    for k in range(3):
        day = START + dt.timedelta(k)
        append.append_day(spark, stages, day, daily.where(F.col("date") == F.lit(day)), *dimensions)
    short = daily.where(F.col("date") < F.lit(START + dt.timedelta(3)))
    whole = features.build_features(demand.prepare_demand(short), *dimensions)
    assert ordered(rounded(append.appended(spark, stages).drop("run_date").select(*whole.columns))) == ordered(rounded(whole))


def test_wrong_days_are_refused(spark, daily, dimensions, tmp_path):
    stages = StageFolder(str(tmp_path))
    with pytest.raises(RuntimeError, match="start_appending"):
        append.append_day(spark, stages, START, daily, *dimensions)
    append.start_appending(spark, stages, START, demand.prepare_demand(daily.where("false")))
    with pytest.raises(ValueError, match="other days"):
        append.append_day(spark, stages, START + dt.timedelta(2), daily, *dimensions)
