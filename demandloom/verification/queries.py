"""One Spark query per operator, over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions import parsing
from demandloom.functions.calendar import iso_text
from demandloom.operators import (
    catalog,
    checks,
    cleaning,
    cohorts,
    demand,
    evaluation,
    exploration,
    features,
    investigation,
    model,
    reconciliation,
    reports,
    sketches,
    splits,
)
from demandloom.plans import append, runs
from demandloom.schemas import DAY_KEYS, SALES, SERIES_KEYS
from demandloom.session import pin, shared_folder
from demandloom.sources import readers, sinks, views

SPEC = views.VIEW_SPLITS
Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """The retail tables and stages of one test folder, as lazy plans."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        rule: str = "brand",
        partitions: int | None = None,
        days: tuple[str, str] | None = None,
    ):
        self.spark, self.folder, self.rule, self.partitions, self.days = spark, folder, rule, partitions, days

    @cached_property
    def sales(self) -> DataFrame:
        return views.sales_view(self.spark, self.folder, self.rule, self.days)

    @cached_property
    def catalog(self) -> DataFrame:
        return views.catalog_view(self.spark, self.folder, self.rule)

    @cached_property
    def price_history(self) -> DataFrame:
        return views.price_history_view(self.spark, self.folder)

    @cached_property
    def discounts_history(self) -> DataFrame:
        return views.discounts_history_view(self.spark, self.folder)

    @cached_property
    def daily(self) -> DataFrame:
        return demand.daily_demand_from_raw(self.sales, partitions=self.partitions)

    @cached_property
    def prepared(self) -> DataFrame:
        return demand.prepare_demand(self.daily)

    @cached_property
    def series_features(self) -> DataFrame:
        return features.series_features(self.prepared)

    @cached_property
    def features(self) -> DataFrame:
        return features.build_features(
            self.prepared, catalog.item_codes(self.sales.dropna(subset=list(DAY_KEYS))), catalog.catalog_codes(self.catalog), trusted=True
        )

    @cached_property
    def scored(self) -> DataFrame:
        """Naive forecasts of every split."""
        return evaluation.naive_forecast(self.series_features)

    @cached_property
    def test(self) -> DataFrame:
        return evaluation.naive_forecast(features.features_for_period(self.prepared, SPEC.test))

    # Stored stages, for queries that read one of them more than once.

    @cached_property
    def stored_daily(self) -> DataFrame:
        return pin(self.daily, "daily")

    @cached_property
    def stored_prepared(self) -> DataFrame:
        return pin(demand.prepare_demand(self.stored_daily), "prepared")

    @cached_property
    def stored_test(self) -> DataFrame:
        return pin(evaluation.naive_forecast(features.features_for_period(self.stored_prepared, SPEC.test)), "test")

    @cached_property
    def cases(self) -> DataFrame:
        return pin(evaluation.top_errors(self.stored_test), "cases")

    @cached_property
    def training_items(self) -> DataFrame:
        return cohorts.items_in_period(self.stored_prepared, SPEC.train)


def tidy(df: DataFrame, **digits: int) -> DataFrame:
    """Round doubles so that summation order does not show; 6 places unless given."""
    rounded = {
        f.name: F.round(F.col(f.name).cast("double"), digits.get(f.name, 6))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(rounded) if rounded else df


_REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def query(**digits: int) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _REGISTRY[build.__name__] = lambda tables: tidy(build(tables), **digits)
        return build

    return register


def over(tables: Tables, name: str) -> DataFrame:
    """One query over given tables; several queries may share their stored stages."""
    return _REGISTRY[name](tables)


def registered() -> dict[str, Query]:
    """Name -> query over a folder, each with stages of its own."""

    def bind(name: str) -> Query:
        return lambda spark, folder: over(Tables(spark, folder), name)

    return {name: bind(name) for name in _REGISTRY}


# --- cleaning -----------------------------------------------------------------------------


@query()
def sales_audit(t: Tables) -> DataFrame:
    return cleaning.audit_sales(t.sales)


@query()
def null_counts(t: Tables) -> DataFrame:
    return checks.null_counts(t.catalog)


@query()
def duplicate_rows(t: Tables) -> DataFrame:
    """Whole rows; the large sales of one store are there twice."""
    again = t.sales.where((F.col("store_id") == 2) & (F.col("quantity") > 45))
    return cleaning.sales_duplicates(t.sales.unionByName(again))


@query()
def price_correction(t: Tables) -> DataFrame:
    return cleaning.clean_sales(t.sales)


@query()
def sales_without_returns(t: Tables) -> DataFrame:
    return cleaning.clean_sales(t.sales, keep_returns=False, repair_prices=False)


@query()
def price_correction_report(t: Tables) -> DataFrame:
    return cleaning.price_correction_report(t.sales)


@query()
def imputed_price_sample(t: Tables) -> DataFrame:
    return cleaning.imputed_price_sample(t.sales)


@query()
def unmatched_prices(t: Tables) -> DataFrame:
    """Bad prices of one brand stand under an id of their own, which has no good price."""
    bad = (F.col("item_id") == "Brand#1") & (F.col("price_base") < 0)
    item = F.when(bad, F.lit("Brand#1/bad")).otherwise(F.col("item_id"))
    return cleaning.unmatched_prices(t.sales.withColumn("item_id", item))


@query()
def csv_sales_item(t: Tables) -> DataFrame:
    """All sales as CSV with an index column, read back strictly, one item looked up."""
    path = f"{shared_folder(t.spark).rstrip('/')}/sales-csv-{uuid.uuid4().hex}"
    indexed = t.sales.withColumn(cleaning.INDEX_COLUMN, F.monotonically_increasing_id())
    sinks.export_csv(indexed.select(cleaning.INDEX_COLUMN, *t.sales.columns), path)
    return readers.extract_item(t.spark, path, views.ANOMALY_ITEM, SALES)


@query()
def sales_column_types(t: Tables) -> DataFrame:
    """Types of the sales columns, and how many values of each are there."""
    counts = t.sales.agg(*[F.count(c).alias(c) for c in t.sales.columns]).unpivot(
        [], t.sales.columns, "column_name", "values_found"
    )
    return exploration.column_types(t.sales).join(counts, "column_name")


@query()
def lenient_parse(t: Tables) -> DataFrame:
    key = F.col("l_orderkey")
    text = t.spark.read.parquet(f"{t.folder}/lineitem.parquet").select(
        "l_orderkey",
        "l_linenumber",
        F.when(key % 50 == 0, "not a date")
        .when(key % 53 != 0, iso_text(F.col("l_shipdate")))
        .alias("date_text"),
        F.when(key % 31 == 0, "n/a")
        .when(key % 37 == 0, F.concat(F.col("l_quantity").cast("string"), F.lit("kg")))
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("number_text"),
    )
    return text.select(
        "l_orderkey",
        "l_linenumber",
        parsing.lenient_date(F.col("date_text")).alias("parsed_date"),
        parsing.lenient_double(F.col("number_text")).alias("parsed_number"),
        parsing.strict_date(F.when(F.col("date_text") != "not a date", F.col("date_text"))).alias("strict_date"),
        parsing.blank_to_null(F.col("number_text")).alias("number_text"),
    )


# --- daily and prepared demand ------------------------------------------------------------


@query()
def daily_demand(t: Tables) -> DataFrame:
    return t.daily


@query()
def daily_demand_from_clean(t: Tables) -> DataFrame:
    return demand.aggregate_daily_demand(cleaning.clean_sales(t.sales))


@query()
def daily_profile(t: Tables) -> DataFrame:
    return checks.fold_rows(demand.daily_profile(t.stored_daily), demand.demand_median(t.stored_daily))


@query()
def market_trend(t: Tables) -> DataFrame:
    return demand.market_trend(t.daily)


@query()
def series_bounds(t: Tables) -> DataFrame:
    return demand.series_bounds(t.daily)


@query()
def prepared_demand(t: Tables) -> DataFrame:
    return t.prepared


@query()
def preparation_report(t: Tables) -> DataFrame:
    return demand.preparation_report(t.stored_daily, t.stored_prepared)


@query()
def preparation_by_store(t: Tables) -> DataFrame:
    return demand.preparation_report(t.stored_daily, t.stored_prepared, ["store_id"])


@query()
def stage_roundtrip(t: Tables) -> DataFrame:
    """Write the prepared stage as Parquet (per store) and CSV, read both back, compare."""
    folder = f"{shared_folder(t.spark).rstrip('/')}/roundtrip-{uuid.uuid4().hex}"
    sinks.write_stage(t.prepared, f"{folder}/parquet", ("item_id", "date"), ("store_id",))
    stored = readers.read_demand(t.spark, f"{folder}/parquet")
    sinks.export_csv(stored, f"{folder}/csv")
    exported = readers.read_demand(t.spark, f"{folder}/csv", "csv")

    def summary(df: DataFrame, source: str) -> DataFrame:
        return df.groupBy("store_id").agg(
            F.lit(source).alias("source"),
            F.count(F.lit(1)).alias("rows"),
            F.sum("daily_demand").alias("total_demand"),
            F.avg("price").alias("mean_price"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
        )

    return summary(stored, "parquet").unionByName(summary(exported, "csv"))


# --- features -----------------------------------------------------------------------------


@query()
def catalog_codes(t: Tables) -> DataFrame:
    return catalog.catalog_codes(t.catalog)


@query()
def item_codes(t: Tables) -> DataFrame:
    return catalog.item_codes(t.stored_prepared)


@query()
def lag_features(t: Tables) -> DataFrame:
    return features.add_lags(features.add_target(t.prepared)).drop("price")


@query()
def rolling_features(t: Tables) -> DataFrame:
    return features.add_rolling(t.prepared).drop("price")


@query()
def price_features(t: Tables) -> DataFrame:
    return features.add_price_change(t.prepared).drop("daily_demand")


@query()
def calendar_features(t: Tables) -> DataFrame:
    return features.add_calendar(t.prepared.select("date", *SERIES_KEYS))


@query()
def features_full(t: Tables) -> DataFrame:
    return t.features


@query()
def features_appended(t: Tables) -> DataFrame:
    """The feature table from a full run and then the last three days one by one, the last of them twice."""
    stages = runs.StageFolder(f"{shared_folder(t.spark).rstrip('/')}/append-{uuid.uuid4().hex}")
    items = pin(catalog.item_codes(t.sales.dropna(subset=list(DAY_KEYS))), "items")
    codes = pin(catalog.catalog_codes(t.catalog), "codes")
    days = [r["date"] for r in t.stored_daily.select("date").distinct().orderBy(F.desc("date")).limit(4).collect()]
    history = demand.prepare_demand(t.stored_daily.where(F.col("date") <= F.lit(days[3])))
    append.start_appending(t.spark, stages, days[3], history, features.build_features(history, items, codes, trusted=True))
    for day in (days[2], days[1], days[0], days[0]):
        append.append_day(t.spark, stages, day, t.stored_daily.where(F.col("date") == F.lit(day)), items, codes)
    return append.appended(t.spark, stages).drop("run_date")


@query(price=3, price_change=3)
def model_input(t: Tables) -> DataFrame:
    return features.model_input(t.features)


@query()
def target_stats(t: Tables) -> DataFrame:
    return features.feature_report(
        t.stored_prepared, features.series_features(t.stored_prepared)
    )


@query()
def split_summary(t: Tables) -> DataFrame:
    return splits.split_summary(t.series_features, SPEC)


@query()
def split_checks(t: Tables) -> DataFrame:
    return splits.split_checks(t.series_features, SPEC)


# --- evaluation ---------------------------------------------------------------------------


@query(sse=2)
def forecast_metrics(t: Tables) -> DataFrame:
    return evaluation.metrics_by_split(t.scored, SPEC)


@query(sse=2)
def evaluate_validation(t: Tables) -> DataFrame:
    return evaluation.evaluate_period(t.scored, SPEC.validation)


@query()
def error_distribution(t: Tables) -> DataFrame:
    return evaluation.error_distribution(t.stored_test)


@query()
def actual_vs_predicted(t: Tables) -> DataFrame:
    return evaluation.demand_distribution(t.stored_test)


@query()
def demand_totals(t: Tables) -> DataFrame:
    return evaluation.demand_totals(t.test)


@query()
def bias_summary(t: Tables) -> DataFrame:
    return evaluation.bias_summary(t.stored_test)


@query()
def metrics_by_range(t: Tables) -> DataFrame:
    return evaluation.metrics_by_range(t.test)


@query(sse=2)
def sse_by_range(t: Tables) -> DataFrame:
    return evaluation.sse_by_range(t.test)


@query()
def high_demand(t: Tables) -> DataFrame:
    return evaluation.high_demand_report(t.stored_test)


@query(sse=2)
def metrics_by_store(t: Tables) -> DataFrame:
    return evaluation.metrics_by_store(t.test)


@query(squared_error=2)
def top_errors(t: Tables) -> DataFrame:
    return evaluation.top_errors(t.test).select(
        "rank", "date", "target_date", *SERIES_KEYS, "target", "predicted", "error", "abs_error", "squared_error"
    )


@query(total_sse=2, top_sse=2)
def top_error_sse_share(t: Tables) -> DataFrame:
    return evaluation.top_error_share(t.stored_test)


@query()
def sample_predictions(t: Tables) -> DataFrame:
    return evaluation.sample_predictions(t.test)


# --- investigation and cohorts ------------------------------------------------------------


def _series_text(name: str):
    """The values of a list with 6 places; as decimals, which print alike in Spark and DuckDB."""
    return F.array_join(F.transform(name, lambda x: F.round(x, 6).cast("decimal(28,6)").cast("string")), ",")


def _with_series_text(context: DataFrame) -> DataFrame:
    series = ("prior_28d_series", "post_7d_series")
    return context.withColumns({c: _series_text(c) for c in series})


@query()
def spike_windows(t: Tables) -> DataFrame:
    return _with_series_text(investigation.spike_context(t.cases, t.stored_prepared))


@query()
def spike_windows_by_bins(t: Tables) -> DataFrame:
    """The surroundings of every row of the test period, each a case of its own."""
    rows = t.stored_test.withColumns({"rank": F.xxhash64(*DAY_KEYS), "target_date": F.date_add("date", 1)})
    rows = pin(rows.select("rank", *DAY_KEYS, "target_date"), "all-cases")
    found = investigation.spike_context_by_bins(rows, t.stored_prepared).drop("prior_28d_series", "post_7d_series")
    return found.join(rows.select("rank", *DAY_KEYS), "rank").drop("rank")


@query(value=3)
def investigation_report_long(t: Tables) -> DataFrame:
    found = pin(investigation.investigate_errors(t.cases, t.stored_prepared, t.sales, t.catalog), "investigated")
    return reports.investigation_report(t.stored_test, found)


@query(value=3)
def cold_start_report_long(t: Tables) -> DataFrame:
    return reports.cold_start_report(t.stored_test, t.training_items, t.catalog, views.ANOMALY_ITEM)


@query()
def rolling_context(t: Tables) -> DataFrame:
    return investigation.rolling_context(t.prepared)


@query(raw_sum_total=4)
def spike_classification(t: Tables) -> DataFrame:
    found = investigation.investigate_errors(t.cases, t.stored_prepared, t.sales, t.catalog)
    return _with_series_text(found)


@query()
def classification_counts(t: Tables) -> DataFrame:
    return investigation.classification_counts(
        investigation.investigate_errors(t.cases, t.stored_prepared, t.sales, t.catalog)
    )


@query(sse=2)
def cohort_metrics(t: Tables) -> DataFrame:
    return cohorts.cohort_metrics(t.stored_test, t.training_items, views.ANOMALY_ITEM)


@query()
def unseen_items(t: Tables) -> DataFrame:
    return cohorts.unseen_items(t.stored_test, t.training_items, t.catalog)


@query()
def common_keys(t: Tables) -> DataFrame:
    shared = cohorts.shared_items(t.sales, t.catalog).withColumn("found_in", F.lit("both"))
    alone = cohorts.items_only_left(t.sales, t.catalog).withColumn("found_in", F.lit("sales"))
    return shared.unionByName(alone)


# --- reconciliation -----------------------------------------------------------------------


@query()
def tx_granularity(t: Tables) -> DataFrame:
    return reconciliation.transaction_granularity(t.sales)


@query(total_sum=4, total_min=4, total_max=4, max_arithmetic_diff=4)
def item_stats(t: Tables) -> DataFrame:
    return reconciliation.item_statistics(t.sales)


@query()
def item_prices(t: Tables) -> DataFrame:
    return reconciliation.item_prices(t.sales)


@query(revenue=4)
def item_by_store(t: Tables) -> DataFrame:
    return reconciliation.item_by_store(t.sales)


@query(effective_unit_price=9)
def arithmetic_check(t: Tables) -> DataFrame:
    return reconciliation.with_arithmetic(t.sales)


@query(raw_sum_total=4)
def reconcile_daily(t: Tables) -> DataFrame:
    return reconciliation.reconcile_daily(t.sales, t.daily)


@query()
def reconcile_daily_by_item(t: Tables) -> DataFrame:
    return reconciliation.reconcile_daily_by_item(t.sales, t.daily)


@query()
def reconcile_prepared(t: Tables) -> DataFrame:
    return reconciliation.reconcile_prepared(t.stored_daily, t.stored_prepared)


@query()
def reconcile_prepared_by_item(t: Tables) -> DataFrame:
    return reconciliation.reconcile_prepared_by_item(t.stored_daily, t.stored_prepared)


@query(sum_total=4)
def sales_listing(t: Tables) -> DataFrame:
    return reconciliation.sales_listing(t.sales, t.prepared)


@query()
def item_presence(t: Tables) -> DataFrame:
    return reconciliation.item_presence(t.sales, t.catalog, t.price_history, t.discounts_history)


@query(value=4)
def audit_report_long(t: Tables) -> DataFrame:
    return reconciliation.audit_report(
        t.sales, t.stored_daily, t.stored_prepared, t.catalog, t.price_history, t.discounts_history
    )


# --- exploration --------------------------------------------------------------------------


@query(sum=4, max=4, min=4)
def sales_profile(t: Tables) -> DataFrame:
    return exploration.describe_columns(t.sales, ["store_id", "quantity", "price_base", "sum_total"])


@query()
def sales_shape(t: Tables) -> DataFrame:
    """Rows, columns, products and stores of the sales table, and rows of its catalog join."""
    return reduce(
        checks.fold_rows,
        [
            exploration.table_shape(t.sales),
            exploration.distinct_counts(t.sales),
            exploration.joined_row_count(t.sales, t.catalog).withColumnRenamed("rows", "joined_rows"),
        ],
    )


@query()
def approx_counts_by_month(t: Tables) -> DataFrame:
    """Distinct items and stores of each month from sketches by day and store, against the exact counts."""
    stored = pin(sketches.sales_sketches(t.sales), "sketches")
    estimates = sketches.distinct_estimates(sketches.merge_sketches(stored, [sketches.month()]))
    return sketches.counts_within_bound(t.sales, estimates, [sketches.month()], ["month"])


@query()
def approx_quantiles_by_store(t: Tables) -> DataFrame:
    """Quantiles of the quantities of each store, by the rank that the estimates have among all rows."""
    stored = pin(sketches.sales_sketches(t.sales), "sketches")
    merged = sketches.merge_sketches(stored, ["store_id"])
    estimates = sketches.quantile_estimates(merged, "quantity", [0.01, 0.25, 0.5, 0.75, 0.99], ["store_id"])
    # a merge of many sketches errs more often than the bound of one says: twice that is asked for
    return sketches.ranks_within_bound(t.sales, "quantity", estimates, ["store_id"], 2 * sketches.rank_error())


@query()
def top_items(t: Tables) -> DataFrame:
    return exploration.top_items(t.sales, t.catalog)


@query()
def department_sales(t: Tables) -> DataFrame:
    return exploration.department_sales(t.sales, t.catalog)


# --- model --------------------------------------------------------------------------------


# The operator's own settings, but for a patience of 5 rounds instead of 20: README gives the time of either.
TRAINING = model.BoostingParams(patience=5)


def score_facts(scored: DataFrame, rounds_ok: bool) -> DataFrame:
    """Facts on each split of scored rows that SQL can state.

    ``beats_train_mean`` says that the error on the train period is smaller than that of its mean. The
    made-up demand has nothing that carries over to a later period, where the mean may do better: there
    it is NULL, and ``near_train_mean_or_better`` only rules out gross errors.
    """
    scored = scored.withColumn("split", splits.split_label(SPEC))
    error = F.col("predicted") - F.col("target")
    constant = scored.where(F.col("split") == SPEC.train.name).agg(F.avg("target")).scalar() - F.col("target")
    own, least = F.avg(error * error), F.avg(constant * constant)
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.sum("target"), 2).alias("total_target"),
        F.count_if(F.col("predicted").isNull()).alias("null_scores"),
        F.when(F.col("split") == SPEC.train.name, own < least).alias("beats_train_mean"),
        (own < 1.25 * least).alias("near_train_mean_or_better"),
        F.lit(rounds_ok).alias("rounds_ok"),
    )


@query()
def gbt_train_score(t: Tables) -> DataFrame:
    """Fit on the whole train period and score everything."""
    table = pin(t.features, "features")
    fitted = model.fit_demand_model(table, SPEC, TRAINING)
    folder = f"{shared_folder(t.spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    fitted.save(folder)
    stored = model.DemandModel.load(t.spark, folder)
    scored = pin(stored.score(table), "scored")
    return score_facts(scored, stored.best_round == fitted.best_round and 1 <= stored.best_round <= TRAINING.rounds)
