"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

``*_wide`` takes every part as an item of its own, which at sf0.1 gives about 19 million
prepared rows. ``score_test_wide`` scores the days of the test period from the stored series: it reads those
days and the ones before them that its windows need, not the whole history.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from demandloom.operators import cohorts, evaluation, exploration, features, investigation, reconciliation
from demandloom.operators import catalog as cat
from demandloom.operators import cleaning
from demandloom.session import local_session, pin
from demandloom.sources.views import ANOMALY_ITEM
from demandloom.schemas import SplitSpec
from demandloom.verification.queries import Tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# 761 days, cut like the published splits: 582 to train, 91 to tune, 87 to test.
DAYS = ("1999-07-02", "2001-07-31")
SPEC = SplitSpec.of(
    train=("1999-07-02", "2001-02-02"), validation=("2001-02-03", "2001-05-04"), test=("2001-05-05", "2001-07-30")
)


def run(df: DataFrame) -> None:
    """Compute every row and column, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def plans(wide: Tables) -> dict[str, Callable[[], DataFrame]]:
    """Plans over the raw tables: each query reads them anew."""
    return {
        "sales_audit_wide": lambda: cleaning.audit_sales(wide.sales),
        "price_correction_wide": lambda: cleaning.clean_sales(wide.sales),
        "daily_demand_wide": lambda: wide.daily,
        "features_wide": lambda: features.build_features(
            wide.prepared, cat.item_codes(wide.sales), cat.catalog_codes(wide.catalog), trusted=True
        ),
        "item_stats_wide": lambda: reconciliation.item_statistics(wide.sales),
        "department_sales_wide": lambda: exploration.department_sales(wide.sales, wide.catalog),
    }


def diagnostics(
    wide: Tables, prepared: DataFrame, scored: DataFrame
) -> dict[str, Callable[[], DataFrame]]:
    """Plans over the stored series and the stored scores of the test period."""
    known = cohorts.items_in_period(prepared, SPEC.train)
    return {
        "forecast_metrics_wide": lambda: evaluation.forecast_metrics(scored),
        "error_distribution_wide": lambda: evaluation.error_distribution(scored),
        "metrics_by_range_wide": lambda: evaluation.metrics_by_range(scored),
        "top_errors_wide": lambda: evaluation.top_errors(scored),
        "cohort_metrics_wide": lambda: cohorts.cohort_metrics(scored, known, ANOMALY_ITEM),
        "unseen_items_wide": lambda: cohorts.unseen_items(scored, known, wide.catalog),
        "spike_classification_wide": lambda: investigation.investigate_errors(
            pin(evaluation.top_errors(scored), "cases"), prepared, wide.sales, wide.catalog
        ),
    }


def main() -> None:
    spark = local_session(CPUS)
    timings: dict[str, float] = {}

    def measure(name: str, build: Callable[[], DataFrame]) -> None:
        """Median of up to five runs; a query that takes long is run less often."""
        runs: list[float] = []
        while len(runs) < 5 and sum(runs) < 8:
            started = time.perf_counter()
            run(build())
            runs.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(runs), 3)

    # A wide series sells on a few days only, so its gapless form is about a hundred times
    # larger than what the planner sees when it sizes the tasks.
    # The days are those of 761, the horizon of the published data volumes.
    wide = Tables(
        spark, FOLDER, "wide", partitions=4 * spark.sparkContext.defaultParallelism, days=DAYS
    )
    run(wide.daily)  # warm-up
    for name, build in plans(wide).items():
        measure(name, build)

    def store(name: str, df: DataFrame) -> DataFrame:
        started = time.perf_counter()
        stored = pin(df, name)
        timings[name] = round(time.perf_counter() - started, 3)
        return stored

    prepared = store("prepared_demand_wide", wide.prepared)
    scored = store("score_test_wide", evaluation.naive_forecast(features.features_for_period(prepared, SPEC.test)))
    for name, build in diagnostics(wide, prepared, scored).items():
        measure(name, build)

    scale = re.search(r"sf([0-9.]+)", FOLDER)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
