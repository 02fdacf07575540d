import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandloom.operators import cohorts, evaluation, exploration, investigation, reconciliation, splits
from demandloom.schemas import Period, SplitSpec
from demandloom.verification import oracle, queries

DAY = dt.date(2024, 7, 10)


@pytest.fixture
def scored(spark):
    rows = [
        (DAY, 1, "a", 0.5, 1.0),
        (DAY, 1, "b", 5.5, 5.0),
        (DAY, 2, "c", 20.5, 30.5),
        (DAY, 2, "d", 0.0, 0.0),
        (DAY, 3, "e", 21.0, 11.0),
    ]
    df = spark.createDataFrame(rows, "date date, store_id int, item_id string, target double, predicted double")
    return df.withColumn("lag_28", F.when(F.col("store_id") == 1, 1.0))


def test_fractions_fall_between_the_ranges(scored):
    rows = {r.demand_range: r for r in evaluation.metrics_by_range(scored).collect()}
    assert rows["unbucketed"].rows == 3
    assert rows["demand 1-5"].rows == 0 and rows["demand 1-5"].mae is None
    assert sum(r.pct for r in rows.values()) == pytest.approx(100.0)
    assert rows["demand = 0"].direction == "underpredicts"


def test_sse_shares_add_up(scored):
    rows = evaluation.sse_by_range(scored).collect()
    assert sum(r.pct_sse for r in rows) == pytest.approx(100.0)
    assert sum(r.rows for r in rows) == 5


def test_equal_errors_are_ranked_by_key(scored):
    top = evaluation.top_errors(scored, 2).orderBy("rank").collect()
    assert [r.item_id for r in top] == ["c", "e"]
    assert evaluation.top_errors(scored, 1).first().item_id == "c"
    assert top[0].target_date == DAY + dt.timedelta(1)


def test_r2_needs_spread_and_rows(spark):
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "target double, predicted double")
    assert evaluation.forecast_metrics(flat).first().r2 is None
    assert evaluation.forecast_metrics(flat.limit(1)).first().r2 is None


def test_wape_of_zero_demand_is_missing(spark):
    zero = spark.createDataFrame([(0.0, 2.0), (0.0, 0.0)], "target double, predicted double")
    row = evaluation.forecast_metrics(zero).first()
    assert row.wape is None and row.mae == 1.0


def test_empty_period_fails(scored):
    period = Period("test", dt.date(2030, 1, 1), dt.date(2030, 2, 1))
    with pytest.raises(Exception, match="no rows found for test period"):
        evaluation.evaluate_period(scored, period).collect()


def test_high_demand_report_of_nothing(scored):
    row = evaluation.high_demand_report(scored, above=1e9).first()
    assert row.rows == 0 and row.ratio_median is None


def test_split_rows_are_all_accounted_for(spark):
    days = spark.createDataFrame([(dt.date(2022, 8, 27) + dt.timedelta(d),) for d in range(800)], "date date")
    spec = SplitSpec()
    row = splits.split_checks(days, spec, expected_rows=800).first()
    assert row.accounting_ok and row.ordering_ok and row.no_overlap_ok and row.expected_total_ok
    rows = {r.split: r for r in splits.split_summary(days, spec).collect()}
    assert sum(r.rows for r in rows.values()) == 800
    assert rows["train"].rows == 582 and rows["validation"].rows == 91 and rows["test"].rows == 87
    assert not splits.split_checks(days, spec, expected_rows=1).first().expected_total_ok


def test_overlapping_splits_are_reported(spark, scored):
    spec = SplitSpec.of(("2024-01-01", "2024-03-01"), ("2024-02-01", "2024-04-01"), ("2024-05-01", "2024-06-01"))
    row = splits.split_checks(scored, spec).first()
    assert not row.ordering_ok and not row.no_overlap_ok


def test_cohorts_overlap_and_partition(spark, scored):
    known = spark.createDataFrame([("a",), ("c",), ("d",)], "item_id string")
    rows = {r.cohort: r for r in cohorts.cohort_metrics(scored, known, "e").collect()}
    assert len(rows) == 9
    everything = rows["All Test Records (Baseline)"]
    seen, unseen = rows["Seen in Training (All)"], rows["Unseen in Training (All Cold-Start)"]
    young, mature = rows["In First 28 Days (lag_28 is NaN)"], rows["Mature History (lag_28 is Available)"]
    assert everything.rows == 5 == seen.rows + unseen.rows == young.rows + mature.rows
    assert everything.sse == pytest.approx(seen.sse + unseen.sse)
    assert rows["Product e Alone"].rows == 1 and rows["Unseen in Training (Excl. e)"].rows == 1
    direct = evaluation.forecast_metrics(scored).first()
    for name in ("mae", "rmse", "r2", "wape", "bias"):
        assert everything[name] == pytest.approx(direct[name])


def test_cohort_without_rows_is_listed(spark, scored):
    known = spark.createDataFrame([(i,) for i in "abcde"], "item_id string")
    rows = {r.cohort: r for r in cohorts.cohort_metrics(scored, known, "zz").collect()}
    row = rows["Unseen in Training (All Cold-Start)"]
    assert (row.rows, row.unique_products, row.mae, row.sse) == (0, 0, None, 0.0)


def test_unseen_items_tell_missing_label_from_missing_item(spark, scored):
    known = spark.createDataFrame([("a",), ("b",), ("c",)], "item_id string")
    catalog = spark.createDataFrame(
        [("d", 1, None, "k")], "item_id string, row_order long, dept_name string, class_name string"
    )
    rows = {r.item_id: r for r in cohorts.unseen_items(scored, known, catalog).collect()}
    assert (rows["d"].dept_name, rows["d"].class_name) == (None, "k")
    assert (rows["e"].dept_name, rows["e"].class_name) == ("NOT IN CATALOG", "NOT IN CATALOG")
    assert rows["e"].lag28_null_pct == 100.0


CASE = dict(
    target=1000.0,
    price=1.0,
    price_change=0.0,
    raw_price_base=5.0,
    raw_sum_total=10.0,
    prior_28d_mean=1.0,
    prior_28d_max=2.0,
    post_7d_mean=1.0,
    post_7d_max=3.0,
    times_exceeded_500=1,
    times_exceeded_1000=1,
    spikes_same_weekday=1,
)


def classify(spark, **changes):
    values = {**CASE, **changes}
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return investigation.classify_spikes(row).first()


@pytest.mark.parametrize(
    "changes, label, evidence",
    [
        (
            dict(times_exceeded_500=25, spikes_same_weekday=3),
            "Repeated on particular days / recurrent spikes",
            "recurrent (times_exceeded_500=25, spikes_same_weekday=3)",
        ),
        (
            dict(post_7d_mean=600.0),
            "Part of a sustained increase",
            "sustained (prior_28d_mean=1.00, post_7d_mean=600.00)",
        ),
        (
            {},
            "Sudden and isolated",
            "above both sides (spike_vs_prior_max=500.00, prior_28d_max=2.00, spike_vs_post_mean=1000.00, post_7d_mean=1.00)",
        ),
        (
            dict(prior_28d_max=400.0, prior_28d_mean=50.0),
            "Sudden and isolated",
            "gone at once (spike_vs_prior_mean=20.00, prior_28d_mean=50.00, post_7d_mean=1.00)",
        ),
        (
            dict(prior_28d_max=400.0, prior_28d_mean=200.0, post_7d_mean=250.0),
            "Sudden spike with elevated surrounding activity",
            "elevated (prior_28d_max=400.00, post_7d_max=3.00)",
        ),
    ],
)
def test_classification_rules(spark, changes, label, evidence):
    row = classify(spark, **changes)
    assert (row.classification, row.evidence) == (label, evidence)


def test_every_anomaly_flag(spark):
    row = classify(spark, target=4000.0, raw_price_base=0.01, raw_sum_total=-1.0, price_change=-0.75)
    assert row.evidence.endswith(
        "); low price (raw_price_base=0.01); no revenue (raw_sum_total=-1.00); "
        "only peak (times_exceeded_1000=1); price jump (price_change=-0.75)"
    )


def test_reconciliation_sees_rows_missing_on_either_side(make_sales, make_demand):
    sales = make_sales([(0, 1, "a", 2.0, 3.0, 6.0), (1, 1, "a", 1.0, 3.0, 3.0), (3, 1, "a", 1.0, 3.0, 3.0)])
    daily = make_demand([(0, 1, "a", 2.0, 3.0), (1, 1, "a", 1.5, 3.0), (2, 1, "a", 9.0, 3.0)])
    row = reconciliation.reconcile_daily_by_item(sales, daily).first()
    assert (row.raw_rows, row.daily_rows, row.only_raw, row.only_daily) == (3, 3, 1, 1)
    assert row.qty_discrepancy and not row.price_discrepancy and row.row_parity
    prepared = make_demand([(0, 1, "a", 2.0, 3.0), (1, 1, "a", 1.5, 3.0), (4, 1, "a", 0.0, 3.0)])
    row = reconciliation.reconcile_prepared_by_item(daily, prepared).first()
    assert (row.only_daily, row.only_prepared, row.qty_discrepancy, row.inserted_rows) == (1, 1, False, 0)


def test_near_zero_price_item_audit(make_sales):
    """A 25-day, 4-store item whose totals are a little below quantity times 0.01."""
    rows = [(d, s, "x", 100.0 * s + d, 0.01, round((100.0 * s + d) * 0.0085, 2)) for d in range(25) for s in (1, 2, 3, 4)]
    sales = make_sales(rows)
    stats = reconciliation.item_statistics(sales).first()
    assert (stats.tx_rows, stats.distinct_dates, stats.distinct_stores, stats.distinct_prices) == (100, 25, 4, 1)
    assert stats.qty_sum == sum(r[3] for r in rows)
    assert not stats.arithmetic_ok and stats.max_unit_price < 0.01
    assert reconciliation.transaction_granularity(sales).first().already_daily
    by_store = {r.store_id: r for r in reconciliation.item_by_store(sales).collect()}
    assert by_store[4].record_count == 25 and by_store[4].qty_max == 424.0


def test_catalog_copies_count_as_in_the_plain_join(spark, make_sales):
    sales = make_sales([(0, 1, "a", 2.0, 1.0, 2.0), (1, 1, "a", 3.0, 1.0, 3.0), (0, 1, "b", 7.0, 1.0, 7.0), (0, 1, None, 9.0, 1.0, 9.0)])
    catalog = spark.createDataFrame([("a", "D1"), ("a", "D1"), ("a", "D2"), ("c", "D3")], "item_id string, dept_name string")
    joined = exploration.sales_with_catalog(sales, catalog)
    assert exploration.joined_row_count(sales, catalog).first().rows == joined.count() == 8
    for key, totals in (
        ("item_id", exploration.top_items(sales, catalog)),
        ("dept_name", exploration.department_sales(sales, catalog)),
    ):
        expected = joined.where(f"{key} IS NOT NULL").groupBy(key).agg(F.sum("quantity")).collect()
        assert dict(map(tuple, totals.collect())) == dict(map(tuple, expected))


def test_series_of_a_case_keep_fractions(spark):
    row = spark.sql("SELECT array(0.5D, 2.0D, 1.25D) AS s, CAST(array() AS array<double>) AS none")
    found = row.select(queries._series_text("s").alias("s"), queries._series_text("none").alias("none")).first()
    assert (found.s, found.none) == ("0.500000,2.000000,1.250000", "")


def test_series_are_compared_in_both_spike_queries():
    sql = oracle.statements()
    for name in ("spike_windows", "spike_classification"):
        assert "prior_28d_series" in sql[name] and "AS BIGINT) AS VARCHAR), ',' ORDER BY" not in sql[name]
