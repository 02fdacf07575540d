"""The whole chain from CSV files to diagnosis, on a small market."""

import datetime as dt
import random

import pytest

from demandloom.operators.model import BoostingParams
from demandloom.plans import runs
from demandloom.schemas import SplitSpec

SPEC = SplitSpec.of(("2024-01-01", "2024-03-31"), ("2024-04-01", "2024-04-20"), ("2024-04-21", "2024-05-28"))
PARAMS = BoostingParams(rounds=3, patience=2, depth=3, step=0.3, bins=32)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("market")
    rng = random.Random(11)
    start = dt.date(2024, 1, 1)
    lines = ["Unnamed: 0,date,item_id,quantity,price_base,sum_total,store_id"]
    for d in range(150):
        for s in (1, 2):
            for i in range(6):
                if i == 5 and d < 120:
                    continue
                if rng.random() < 0.4 and d not in (0, 149):
                    continue
                q = rng.choice([-1, 0, 1, 2, 3, 5]) * (100 if i == 5 else 1)
                price = -2.0 if rng.random() < 0.03 else 2.0 + i
                lines.append(f"{len(lines)},{start + dt.timedelta(d)},item{i},{q},{price},{q * price},{s}")
    (folder / "sales.csv").write_text("\n".join(lines) + "\n")
    labels = [f"item{i},D{i % 2},C{i},S,T{i % 3},{i}.5,x,{i}" for i in range(5)]
    header = "item_id,dept_name,class_name,subclass_name,item_type,weight_volume,weight_netto,fatness"
    (folder / "catalog.csv").write_text("\n".join([header, *labels, labels[0]]) + "\n")
    return folder


def test_chain(spark, files):
    sales, catalog = str(files / "sales.csv"), str(files / "catalog.csv")
    stages = runs.StageFolder(str(files / "stages"))

    daily = runs.run_daily_demand(spark, sales, stages)
    assert daily["validation"].first().duplicate_combinations == 0
    assert daily["audit"].first().total_records > daily["daily_demand"].count() - 1
    assert daily["audit"].first().has_index_column
    assert daily["price_correction"].first().unmatched_count == daily["unmatched_prices"].count()

    prepared = runs.run_prepare_demand(spark, stages, files_per_store=2)
    report = prepared["report"].first()
    assert report.prepared_rows == report.original_rows + report.inserted_rows
    assert report.negative_demand_after == 0 and report.duplicate_keys == 0
    assert sum(r.prepared_rows for r in prepared["report_by_store"].collect()) == report.prepared_rows

    built = runs.run_features(spark, catalog, stages)
    counts = built["report"].first()
    assert counts.input_rows == report.prepared_rows
    assert counts.rows_without_target == 12
    assert len(built["features"].columns) == 28

    inspection = runs.run_split_inspection(spark, stages, SPEC, counts.output_rows)
    checks = inspection["checks"].first()
    assert checks.accounting_ok and checks.expected_total_ok

    trained = runs.run_training(spark, stages, SPEC, PARAMS)
    assert trained["test"].first().rows > 0 and trained["validation"].first().rows > 0

    sections = runs.run_error_analysis(spark, stages, SPEC)
    assert {name: df.count() > 0 for name, df in sections.items()} == dict.fromkeys(sections, True)

    found = runs.run_investigation(spark, catalog, stages, SPEC, top_n=5)
    assert found["cases"].count() == 5
    assert sum(r.cases for r in found["classification"].collect()) == 5

    audit = runs.run_cold_start_audit(spark, catalog, stages, SPEC, "item5")
    assert [r.item_id for r in audit["unseen_items"].collect()] == ["item5"]
    assert audit["unseen_items"].first().dept_name == "NOT IN CATALOG"
    assert audit["cohorts"].count() == 9

    paths = {
        "catalog": catalog,
        "price_history": str(files / "price_history.csv"),
        "discounts_history": str(files / "discounts_history.csv"),
    }
    one = runs.run_item_audit(spark, paths, stages, "item5")
    values = {(r.section, r.metric): r.value for r in one["report"].collect()}
    assert values[("presence", "in_catalog")] == 0.0 and values[("presence", "price_history_rows")] == 0.0
    assert values[("raw_vs_daily", "qty_discrepancy")] == 0.0
    assert one["listing"].count() == values[("statistics", "tx_rows")]


def test_features_by_month(spark, files):
    stages = runs.StageFolder(str(files / "stages"))
    built = runs.run_features(spark, str(files / "catalog.csv"), stages, files_per_month=2)
    assert "feature_month" in built["features"].columns
    months = list((files / "stages" / "features").glob("feature_month=*"))
    assert len(months) == 5 and all(len(list(m.glob("*.parquet"))) <= 2 for m in months)
