import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import cohorts, evaluation, investigation, reports, sketches
from demandloom.schemas import SALES
from demandloom.session import pin


def sales_of(spark, values):
    """One row a value over 30 days and 3 stores, with as many items as values."""
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(i % 30), i % 3, f"item{i}", float(v), 1.0, 1.0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SALES)


DISTRIBUTIONS = {
    "uniform": lambda rng: rng.random(20_000),
    "heavy tail": lambda rng: np.exp(rng.normal(0, 3, 20_000)),
    "few values": lambda rng: rng.integers(0, 5, 20_000).astype(float),
}


@pytest.mark.parametrize("name", DISTRIBUTIONS)
def test_merged_quantiles_keep_their_rank_error(spark, name):
    values = np.sort(DISTRIBUTIONS[name](np.random.default_rng(1)))
    stored = pin(sketches.sales_sketches(sales_of(spark, values[np.random.default_rng(2).permutation(len(values))])), "sketches")
    assert stored.count() == 30  # a day has one store here
    merged = sketches.merge_sketches(stored)
    probs = [0.0, 0.01, 0.1, 0.5, 0.9, 0.99, 1.0]
    found = {r["prob"]: r["quantile"] for r in sketches.quantile_estimates(merged, "quantity", probs).collect()}
    assert set(found) == set(probs)
    for p, x in found.items():
        low, high = np.searchsorted(values, x, "left") / len(values), np.searchsorted(values, x, "right") / len(values)
        assert low - 2 * sketches.rank_error() <= p <= high + 2 * sketches.rank_error()


def test_counts_of_any_period_come_from_stored_rows(spark):
    stored = pin(sketches.sales_sketches(sales_of(spark, range(30_000))), "sketches")
    week = stored.where(F.col("date") < "2024-01-08")
    for part, items in ((stored, 30_000), (week, 7_000)):
        found = sketches.distinct_estimates(sketches.merge_sketches(part)).first()
        assert abs(found.item_id_distinct - items) <= sketches.count_error() * items
        assert found.rows == items
    by_store = sketches.distinct_estimates(sketches.merge_sketches(stored, ["store_id"])).collect()
    assert len(by_store) == 3 and all(r.store_id_distinct == 1 for r in by_store)


def test_nulls_and_infinities_are_in_no_sketch(spark):
    rows = [(dt.date(2024, 1, 1), 1, None, None, float("nan"), 1.0), (dt.date(2024, 1, 2), 1, "a", 2.0, float("inf"), 1.0)]
    stored = sketches.sales_sketches(spark.createDataFrame(rows, SALES))
    merged = sketches.merge_sketches(stored)
    assert sketches.distinct_estimates(merged).first().item_id_distinct == 1
    assert [r.quantile for r in sketches.quantile_estimates(merged, "quantity", [0.5]).collect()] == [2.0]
    assert sketches.quantile_estimates(merged, "price_base", [0.5]).count() == 0
    empty = sketches.sales_sketches(spark.createDataFrame([], SALES))
    assert sketches.merge_sketches(empty, ["store_id"]).count() == 0


@pytest.fixture(scope="module")
def series(spark):
    """A hot series of 1,500 days and a short one."""
    rng = random.Random(6)
    start = dt.date(2020, 1, 1)
    rows = [(start + dt.timedelta(d), 1, "hot", float(rng.choice([0, 0, 3, 150, 700])), 1.0) for d in range(1500)]
    rows += [(start + dt.timedelta(d), 2, "new", float(d), 1.0) for d in range(5)]
    return pin(spark.createDataFrame(rows, "date date, store_id int, item_id string, daily_demand double, price double"), "series")


def cases_of(series):
    return series.select(F.xxhash64("date", "item_id").alias("rank"), "store_id", "item_id", F.col("date").alias("target_date"))


def test_bins_give_the_surroundings_of_each_case(series):
    cases = pin(cases_of(series.where("day(date) = 3 OR item_id = 'new'")), "cases")
    order = lambda df: sorted(df.collect(), key=lambda r: r["rank"])
    plain, binned = order(investigation.spike_context(cases, series)), order(investigation.spike_context_by_bins(cases, series))
    assert len(plain) == cases.count() == len(binned)
    for a, b in zip(plain, binned):
        assert {k: (pytest.approx(v) if isinstance(v, float) else v) for k, v in b.asDict().items()} == a.asDict()


def test_all_rows_as_cases_equal_the_rolling_context(series):
    binned = investigation.spike_context_by_bins(pin(cases_of(series), "cases"), series)
    rolling = investigation.rolling_context(series).withColumn("rank", F.xxhash64("date", "item_id"))
    names = [c for c in rolling.columns if c.startswith(("prior_", "post_"))]
    other = rolling.select("rank", *[F.col(c).alias(f"_{c}") for c in names])
    joined = binned.join(other, "rank")
    assert joined.count() == series.count()
    assert joined.where(" OR ".join(f"abs({c} - _{c}) > 1e-9" for c in names)).count() == 0


def test_no_case_meets_its_whole_series(series):
    """The band join's rows are days of two bins a case, not the series times its cases."""
    binned = investigation.spike_context_by_bins(pin(cases_of(series), "cases"), series)
    binned.collect()
    plan = binned._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_bin" in plan


def test_reports_list_each_figure_once(spark):
    rows = [(dt.date(2024, 6, 1) + dt.timedelta(i), 1, f"i{i % 3}", float(i), float(i + i % 4), 1.0 if i > 5 else None) for i in range(12)]
    scored = spark.createDataFrame(rows, "date date, store_id int, item_id string, target double, predicted double, lag_28 double")
    known = spark.createDataFrame([("i0",), ("old",)], "item_id string")
    labels = spark.createDataFrame([("i1", 1, "d", "c")], "item_id string, row_order long, dept_name string, class_name string")
    report = reports.cold_start_report(scored, known, labels, "i2")
    figures = {(r.section, r.entry, r.metric): r.value if r.text is None else r.text for r in report.collect()}
    assert report.count() == len(figures)
    assert [figures["overview", "test", f"{c}_items"] for c in ("training", "active", "unseen")] == [2.0, 3.0, 2.0]
    assert figures["unseen_item", "i1", "dept_name"] == "d" and figures["unseen_item", "i2", "dept_name"] == "NOT IN CATALOG"
    assert figures["cohort", "Product i2 Alone", "rows"] == 4.0
    assert figures["unseen_item", "i1", "first_date"] == "2024-06-02"
    assert {e for s, e, _ in figures if s == "cohort"} == {r.cohort for r in cohorts.cohort_metrics(scored, known, "i2").collect()}
    assert evaluation.top_error_share(scored, 3).count() == 1
