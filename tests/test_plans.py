"""Physical plans: what must be in them, and what must not."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from demandloom.operators import cleaning, cohorts, evaluation, features, investigation, splits
from demandloom.operators.demand import aggregate_daily_demand, daily_demand_from_raw, prepare_demand
from demandloom.session import pin
from demandloom.verification.queries import SPEC, Tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(text: str, node: str) -> int:
    return len(re.findall(rf"[-+:] *(?:\*\(\d+\) )?{node}\b", text))


@pytest.fixture(scope="module", autouse=True)
def untruncated_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SMALL)


def test_date_range_reaches_the_scan(tables):
    text = plan(Tables(tables.spark, SMALL, days=("1999-07-02", "2001-07-31")).sales)
    assert "GreaterThanOrEqual(l_shipdate,1999-07-02" in text and "LessThan(l_shipdate,2001-08-01" in text


def test_views_keep_every_row(tables):
    spark = tables.spark
    assert tables.sales.count() == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    parts = spark.read.parquet(f"{SMALL}/part.parquet").count()
    assert tables.catalog.count() == parts and tables.price_history.count() == parts


def test_audit_shuffles_counters_only(tables):
    assert count(plan(cleaning.audit_sales(tables.sales)), "Exchange") == 1
    assert "SinglePartition" in plan(cleaning.audit_sales(tables.sales))


def test_series_features_need_one_shuffle(tables):
    daily = pin(aggregate_daily_demand(tables.sales), "daily")
    text = plan(features.series_features(prepare_demand(daily)))
    assert count(text, "Exchange") == 1
    assert count(text, "Sort") == 2


def test_repairing_prices_leaves_good_rows_unshuffled(tables):
    text = plan(cleaning.correct_negative_prices(pin(tables.sales, "sales")))
    untouched = text.split("Union", 1)[1].split("SortMergeJoin")[0].split("BroadcastHashJoin")[0]
    first_branch = untouched.split(":- ", 1)[1].split("\n   +- ")[0]
    assert "Exchange" not in first_branch


def test_period_filter_is_pushed_to_the_stage(tables):
    stage = pin(tables.scored, "scored")
    text = plan(splits.select_period(stage, SPEC.test).groupBy("store_id").agg(F.count("target")))
    assert "GreaterThanOrEqual(date,2001-06-01)" in text and "LessThanOrEqual(date,2001-12-31)" in text
    assert "ReadSchema: struct<date:date,store_id:int,target:double>" in text


def test_scoring_a_period_reads_its_days_only(tables):
    stage = pin(tables.prepared, "prepared")
    few = features.features_for_period(stage, SPEC.test)
    text = plan(few)
    assert "GreaterThanOrEqual(date,2001-05-04)" in text and "LessThanOrEqual(date,2002-01-01)" in text
    whole = splits.select_period(features.series_features(stage), SPEC.test)
    assert few.count() == whole.count() > 0
    assert few.exceptAll(whole).isEmpty() and whole.exceptAll(few).isEmpty()


def test_top_errors_are_taken_without_a_global_sort(tables):
    text = plan(evaluation.top_errors(pin(tables.test, "test")))
    assert "TakeOrderedAndProject" in text or "TakeOrdered" in text
    assert "rangepartitioning" not in text


def test_cases_are_broadcast_because_they_are_small(tables):
    cases = pin(evaluation.top_errors(tables.test), "cases")
    prepared = pin(tables.prepared, "prepared")
    text = plan(investigation.spike_context(cases, prepared))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_training_items_meet_item_sums_not_rows(tables):
    """Rows are aggregated before the join with the training items."""
    test = pin(tables.test, "test")
    known = pin(cohorts.items_in_period(tables.prepared, SPEC.train), "known")
    text = plan(cohorts.cohort_metrics(test, known, "x"))
    join = text.index("LeftOuter")
    assert "partial_sum" in text[join:]


def test_a_hot_series_is_reduced_before_it_is_shuffled(spark, make_sales):
    """A third of all rows in one series: the shuffles carry its days and prices, not its rows."""
    hot = [(d % 30, 1, "hot", 1.0, float(d % 7 - 1), 1.0) for d in range(6000)]
    rest = [(d % 30, 1 + d % 4, f"i{d % 500}", 1.0, 2.0, 2.0) for d in range(12000)]
    sales = pin(make_sales(hot + rest).coalesce(2), "hot")
    daily = daily_demand_from_raw(sales)
    rows = {r.date.day: r for r in daily.where("item_id = 'hot'").collect()}
    assert len(rows) == 30 and sum(r.daily_demand for r in rows.values()) == 6000.0
    text = plan(daily)
    for below_exchange in text.split("Exchange hashpartitioning(date")[1:]:
        assert "partial_sum(quantity" in below_exchange.split("\n", 2)[1]
    for below_exchange in text.split("Exchange hashpartitioning(store_id")[1:]:
        assert "Scan parquet" not in below_exchange.split("\n", 2)[1]


def test_no_broadcast_is_forced_on_item_tables(tables, spark):
    """With broadcasting switched off, the item dimension is shuffled and the result holds."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = tables.features
        assert "BroadcastHashJoin" not in plan(built)
        assert built.count() == tables.series_features.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
