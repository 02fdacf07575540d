import pytest

from demandloom.operators import checks, cleaning, demand
from demandloom.schemas import DAY_KEYS


@pytest.fixture
def tricky(make_sales):
    return make_sales(
        [
            (0, 1, "neg", 1.0, -5.0, 5.0),
            (1, 1, "neg", 1.0, -6.0, 6.0),
            (0, 1, "zero", 1.0, 0.0, 0.0),
            (1, 1, "zero", 1.0, -2.0, 2.0),
            (2, 1, "zero", 1.0, 8.0, 8.0),
            (3, 1, "zero", 1.0, 9.0, 9.0),
            (0, 2, "zero", 1.0, 100.0, 1.0),
            (0, 1, None, 2.0, 3.0, 6.0),
            (0, 1, "gone", None, 3.0, 6.0),
            (1, 1, "gone", -2.0, 3.0, -6.0),
            (1, 1, "gone", 0.0, 3.0, 0.0),
            (None, 1, "gone", 4.0, 3.0, 12.0),
        ]
    )


def prices(df):
    return {(str(r.date), r.store_id, r.item_id): r.price_base for r in df.where("item_id in ('neg', 'zero')").collect()}


def test_negative_prices_take_the_positive_median_of_their_store_and_item(tricky):
    found = prices(cleaning.correct_negative_prices(tricky))
    assert found[("2024-01-01", 1, "neg")] is None and found[("2024-01-02", 1, "neg")] is None
    assert found[("2024-01-01", 1, "zero")] == 0.0
    assert found[("2024-01-02", 1, "zero")] == 8.5


def test_correction_keeps_every_row(tricky):
    assert cleaning.correct_negative_prices(tricky).count() == tricky.count()


def test_report_counts(tricky):
    row = cleaning.price_correction_report(tricky).first()
    assert (row.total_negative_prices, row.imputed_count, row.unmatched_count) == (3, 1, 2)
    assert cleaning.unmatched_prices(tricky).count() == 2
    assert cleaning.imputed_price_sample(tricky).first().old_price == -2.0


def test_report_without_negative_prices(tricky):
    row = cleaning.price_correction_report(tricky.where("price_base > 0")).first()
    assert (row.total_negative_prices, row.imputed_count, row.unmatched_count) == (0, 0, 0)


def test_audit_counts(tricky):
    row = cleaning.audit_sales(tricky).first()
    assert row.total_records == 12
    assert (row.negative_quantity_count, row.zero_quantity_count) == (1, 1)
    assert (row.negative_price_count, row.zero_price_count, row.negative_sum_total_count) == (3, 1, 1)
    assert (row.null_date, row.null_item_id, row.null_quantity) == (1, 1, 1)
    assert row.negative_price_pct == pytest.approx(25.0)


def test_audit_of_an_empty_table(tricky):
    row = cleaning.audit_sales(tricky.where("false")).first()
    assert (row.total_records, row.negative_price_count, row.negative_price_pct) == (0, 0, 0.0)


def test_returns_switch_also_drops_missing_quantities(tricky):
    kept = cleaning.without_returns(tricky)
    assert kept.where("quantity IS NULL OR quantity < 0").count() == 0
    assert kept.count() == 10


def test_index_column_hides_duplicates_unless_ignored(spark):
    df = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b")], "`Unnamed: 0` int, item_id string")
    assert checks.duplicate_rows(df).first().duplicate_records == 1
    assert checks.duplicate_rows(df, ignore=()).first().duplicate_records == 0
    assert cleaning.drop_index_column(df).columns == ["item_id"]


def test_fused_daily_demand_equals_clean_then_aggregate(tricky):
    fused = demand.daily_demand_from_raw(tricky).orderBy(*DAY_KEYS).collect()
    staged = demand.aggregate_daily_demand(cleaning.clean_sales(tricky)).orderBy(*DAY_KEYS).collect()
    assert [tuple(r) for r in fused] == [tuple(r) for r in staged]


def test_daily_demand_drops_missing_keys_and_sums_nothing_to_zero(tricky):
    rows = {(r.item_id, str(r.date)): r for r in demand.daily_demand_from_raw(tricky).collect()}
    assert all(item is not None for item, _ in rows)
    assert rows[("gone", "2024-01-01")].daily_demand == 0.0
    assert rows[("gone", "2024-01-02")].daily_demand == -2.0
    assert rows[("neg", "2024-01-01")].price is None
    assert demand.daily_demand_from_raw(tricky, partitions=3).count() == 9


def test_unique_by_rejects_a_second_row(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert sorted(map(tuple, checks.unique_by(df, ["k"]).collect())) == [("a", 1), ("b", 2)]
    with pytest.raises(Exception, match="duplicate key: a"):
        checks.unique_by(df.union(df.where("k = 'a'")), ["k"]).collect()
