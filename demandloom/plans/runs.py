"""End-to-end runs. Each stage is written once and read back, as a new lineage root."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.operators import catalog as cat
from demandloom.operators import (
    cleaning,
    cohorts,
    demand,
    evaluation,
    features,
    investigation,
    model,
    reconciliation,
    splits,
)
from demandloom.operators.checks import fold_rows
from demandloom.schemas import DAY_KEYS, SERIES_KEYS, SplitSpec
from demandloom.session import pin
from demandloom.sources import readers, sinks


@dataclass(frozen=True)
class StageFolder:
    """Where the stages of one run live."""

    root: str

    def path(self, stage: str) -> str:
        return f"{self.root.rstrip('/')}/{stage}"


def run_daily_demand(
    spark: SparkSession,
    sales_path: str,
    stages: StageFolder,
    format: str = "csv",
    keep_returns: bool = True,
    repair_prices: bool = True,
) -> dict[str, DataFrame]:
    """Raw sales to the daily stage, with its audit, price report, validation and trend.

    Text is parsed once: the typed rows become the ``sales`` stage, which this and all later
    runs scan by column.
    """
    has_index = cleaning.INDEX_COLUMN in readers.column_names(spark, sales_path, format)
    sinks.write_stage(readers.read_sales(spark, sales_path, format), stages.path("sales"))
    sales = readers.read_sales(spark, stages.path("sales"), "parquet")
    kept = sales if keep_returns else cleaning.without_returns(sales)
    daily = (
        demand.daily_demand_from_raw(kept)
        if repair_prices
        else demand.aggregate_daily_demand(kept)
    )
    sinks.write_stage(daily, stages.path("daily_demand"), sort=DAY_KEYS)
    daily = readers.read_demand(spark, stages.path("daily_demand"))
    return {
        "daily_demand": daily,
        "audit": cleaning.audit_sales(sales).withColumn("has_index_column", F.lit(has_index)),
        "duplicates": cleaning.sales_duplicates(sales),
        "price_correction": cleaning.price_correction_report(kept),
        "unmatched_prices": cleaning.unmatched_prices(kept),
        "validation": fold_rows(demand.daily_profile(daily), demand.demand_median(daily)),
        "market_trend": demand.market_trend(daily),
    }


ROWS_PER_TASK = 1_000_000


def _series_partitions(daily: DataFrame) -> int:
    """Tasks for the gapless table, from its exact row count."""
    rows = demand.prepared_row_count(daily).first()["prepared_rows"]
    return max(rows // ROWS_PER_TASK + 1, daily.sparkSession.sparkContext.defaultParallelism)


def run_prepare_demand(
    spark: SparkSession, stages: StageFolder, files_per_store: int = 0
) -> dict[str, DataFrame]:
    """Daily stage to gapless series, with the preparation report."""
    daily = readers.read_demand(spark, stages.path("daily_demand"))
    sinks.write_stage(
        demand.prepare_demand(daily, _series_partitions(daily)),
        stages.path("prepared_demand"),
        sort=("item_id", "date"),
        partition_by=("store_id",),
        files_per_partition=files_per_store,
    )
    prepared = readers.read_demand(spark, stages.path("prepared_demand"))
    return {
        "prepared_demand": prepared,
        "report": demand.preparation_report(daily, prepared),
        "report_by_store": demand.preparation_report(daily, prepared, ["store_id"]),
    }


def run_features(
    spark: SparkSession,
    catalog_path: str,
    stages: StageFolder,
    catalog_format: str = "csv",
    files_per_month: int = 0,
) -> dict[str, DataFrame]:
    """Prepared series and catalog to the feature stage.

    By default each task writes its rows in date order, so a period is found by Parquet
    statistics without another shuffle. ``files_per_month`` instead gives one folder per
    month with at most that many files.
    """
    prepared = readers.read_demand(spark, stages.path("prepared_demand"))
    codes = cat.catalog_codes(readers.read_catalog(spark, catalog_path, catalog_format))
    built = features.build_features(prepared, cat.item_codes(prepared), codes, trusted=True)
    if files_per_month:
        sinks.write_stage(
            built.withColumn("feature_month", F.date_format("date", "yyyy-MM")),
            stages.path("features"),
            sort=(*SERIES_KEYS, "date"),
            partition_by=("feature_month",),
            files_per_partition=files_per_month,
        )
    else:
        sinks.write_stage(built, stages.path("features"), sort=("date", *SERIES_KEYS))
    table = features.require_rows(spark.read.parquet(stages.path("features")), "feature table")
    return {"features": table, "report": features.feature_report(prepared, table)}


def run_split_inspection(
    spark: SparkSession, stages: StageFolder, spec: SplitSpec, expected_rows: int | None = None
) -> dict[str, DataFrame]:
    table = spark.read.parquet(stages.path("features"))
    return {
        "summary": splits.split_summary(table, spec),
        "checks": splits.split_checks(table, spec, expected_rows),
    }


def run_training(
    spark: SparkSession,
    stages: StageFolder,
    spec: SplitSpec,
    params: model.BoostingParams | None = None,
) -> dict[str, DataFrame]:
    """Fit, store the model, and write the scores of validation and test once."""
    table = spark.read.parquet(stages.path("features"))
    fitted = model.fit_demand_model(table, spec, params)
    fitted.save(stages.path("model"))
    scored = fitted.score(table.where(splits.split_label(spec).isin("validation", "test")))
    sinks.write_stage(scored, stages.path("predictions"))
    predictions = spark.read.parquet(stages.path("predictions"))
    return {
        "predictions": predictions,
        "validation": evaluation.evaluate_period(predictions, spec.validation),
        "test": evaluation.evaluate_period(predictions, spec.test),
        "sample": evaluation.sample_predictions(splits.select_period(predictions, spec.test)),
    }


def run_error_analysis(spark: SparkSession, stages: StageFolder, spec: SplitSpec) -> dict[str, DataFrame]:
    """All sections of the error report, from the stored scores of the test period."""
    test = splits.select_period(spark.read.parquet(stages.path("predictions")), spec.test)
    return {
        "metrics": evaluation.forecast_metrics(test),
        "error_distribution": evaluation.error_distribution(test),
        "demand_distribution": evaluation.demand_distribution(test),
        "by_range": evaluation.metrics_by_range(test),
        "high_demand": evaluation.high_demand_report(test),
        "by_store": evaluation.metrics_by_store(test),
        "top_errors": evaluation.top_errors(test),
        "totals": evaluation.demand_totals(test),
        "bias": evaluation.bias_summary(test),
        "sse_by_range": evaluation.sse_by_range(test),
    }


def run_investigation(
    spark: SparkSession,
    catalog_path: str,
    stages: StageFolder,
    spec: SplitSpec,
    top_n: int = 30,
    format: str = "csv",
) -> dict[str, DataFrame]:
    """Largest test errors, each with its surroundings and a classification."""
    test = splits.select_period(spark.read.parquet(stages.path("predictions")), spec.test)
    cases = pin(evaluation.top_errors(test, top_n), "cases")
    found = investigation.investigate_errors(
        cases,
        readers.read_demand(spark, stages.path("prepared_demand")),
        readers.read_sales(spark, stages.path("sales"), "parquet"),
        readers.read_catalog(spark, catalog_path, format),
    )
    sinks.write_stage(found, stages.path("extreme_errors"))
    found = spark.read.parquet(stages.path("extreme_errors"))
    sinks.write_report(found.orderBy("rank"), stages.path("extreme_errors_csv"))
    return {
        "cases": found,
        "classification": investigation.classification_counts(found),
        "share": evaluation.top_error_share(test, top_n),
    }


def run_cold_start_audit(
    spark: SparkSession,
    catalog_path: str,
    stages: StageFolder,
    spec: SplitSpec,
    anomaly_item: str,
    format: str = "csv",
) -> dict[str, DataFrame]:
    test = splits.select_period(spark.read.parquet(stages.path("predictions")), spec.test)
    known = cohorts.items_in_period(
        readers.read_demand(spark, stages.path("prepared_demand")), spec.train
    )
    metrics = cohorts.cohort_metrics(test, known, anomaly_item)
    sinks.write_report(metrics, stages.path("cohorts_csv"))
    return {
        "cohorts": metrics,
        "unseen_items": cohorts.unseen_items(test, known, readers.read_catalog(spark, catalog_path, format)),
    }


def run_item_audit(
    spark: SparkSession,
    paths: dict[str, str],
    stages: StageFolder,
    item_id: str | None = None,
    format: str = "csv",
) -> dict[str, DataFrame]:
    """Data-quality audit of one item, or of all.

    ``paths`` names the files of ``catalog``, ``price_history`` and ``discounts_history``; the
    last two may be missing.
    """
    tables = {
        "sales": readers.read_sales(spark, stages.path("sales"), "parquet"),
        "daily": readers.read_demand(spark, stages.path("daily_demand")),
        "prepared": readers.read_demand(spark, stages.path("prepared_demand")),
        "catalog": readers.read_catalog(spark, paths["catalog"], format),
        "price_history": readers.read_price_history(spark, paths["price_history"], format),
        "discounts_history": readers.read_discounts_history(spark, paths["discounts_history"], format),
    }
    if item_id is not None:
        tables = {name: reconciliation.for_item(df, item_id) for name, df in tables.items()}
    return {
        "report": reconciliation.audit_report(**tables),
        "by_store": reconciliation.item_by_store(tables["sales"]),
        "prices": reconciliation.item_prices(tables["sales"]),
        "listing": reconciliation.sales_listing(tables["sales"], tables["prepared"]),
    }
