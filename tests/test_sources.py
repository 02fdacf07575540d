import pytest

from demandloom.functions import parsing
from demandloom.schemas import DISCOUNTS_HISTORY, PRICE_HISTORY, SALES
from demandloom.sources import readers, sinks

from pyspark.sql import functions as F

CSV = """Unnamed: 0,date,item_id,quantity,price_base,sum_total,store_id
0,2024-01-01,a1,2.0,3.5,7.0,1
1,2024-01-02,a1,-1,,,2
2,2024-01-03,b2,nan,-4,4,3
"""


@pytest.fixture
def sales_file(tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_is_read_by_name_with_types_and_without_the_index(spark, sales_file):
    sales = readers.read_sales(spark, sales_file)
    assert sales.schema == SALES
    rows = sales.orderBy("date").collect()
    assert rows[0].store_id == 1 and rows[0].price_base == 3.5
    assert rows[1].price_base is None and rows[1].quantity == -1.0
    assert rows[2].quantity is None


def test_projection_reaches_the_file(spark, sales_file):
    narrow = readers.read_sales(spark, sales_file, columns=["date", "item_id"])
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<date:string,item_id:string>" in plan


def test_malformed_date_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(CSV.replace("2024-01-02", "yesterday"))
    with pytest.raises(Exception, match="yesterday"):
        readers.read_sales(spark, str(path)).collect()


def test_missing_required_input_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_sales(spark, str(tmp_path / "none.csv"))


def test_missing_optional_input_is_empty(spark, tmp_path):
    history = readers.read_price_history(spark, str(tmp_path / "none.csv"))
    assert history.schema == PRICE_HISTORY and history.count() == 0
    assert readers.read_discounts_history(spark, str(tmp_path / "none.csv")).schema == DISCOUNTS_HISTORY


def test_point_lookup(spark, sales_file, tmp_path):
    assert readers.extract_item(spark, sales_file, "a1", SALES, columns=["date", "quantity"]).count() == 2
    assert readers.extract_item(spark, sales_file, "zz", SALES).count() == 0
    assert readers.extract_item(spark, str(tmp_path / "none.csv"), "a1", SALES).count() == 0


def test_catalog_remembers_file_order(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_text(
        "item_id,dept_name,class_name,subclass_name,item_type,weight_volume,weight_netto,fatness\n"
        "a,D1,C,S,T,1,2,3\na,D2,C,S,T,1,2,3\nb,n/a,C,S,T,,x,3\n"
    )
    catalog = readers.read_catalog(spark, str(path))
    rows = catalog.orderBy("row_order").collect()
    assert [(r.item_id, r.dept_name) for r in rows] == [("a", "D1"), ("a", "D2"), ("b", None)]
    assert rows[2].weight_volume is None and rows[2].weight_netto == "x"


def test_lenient_parsers(spark):
    texts = ["1.5", " 2 ", "1e3", "3d", "4F", "NaN", "x", None, "2024-01-05", "2024-13-01"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    numbers = [r[0] for r in df.select(parsing.lenient_double(F.col("t"))).collect()]
    assert numbers == [1.5, 2.0, 1000.0, None, None, None, None, None, None, None]
    dates = [r[0] for r in df.select(parsing.lenient_date(F.col("t"))).collect()]
    assert [str(d) for d in dates if d] == ["2024-01-05"]


def test_stage_per_store_has_a_bounded_number_of_files(spark, make_demand, tmp_path):
    daily = make_demand([(d, s, f"i{d}", 1.0, 1.0) for d in range(40) for s in (1, 2)])
    path = tmp_path / "stage"
    sinks.write_stage(daily.repartition(16), str(path), ("item_id",), ("store_id",), files_per_partition=3)
    for folder in path.glob("store_id=*"):
        assert 1 <= len(list(folder.glob("*.parquet"))) <= 3
    assert readers.read_demand(spark, str(path)).exceptAll(daily).count() == 0


def test_csv_export_round_trip(spark, make_demand, tmp_path):
    daily = make_demand([(d, 1, "a", d * 0.1, None if d == 2 else 1.25) for d in range(5)])
    sinks.export_csv(daily, str(tmp_path / "out"))
    back = readers.read_demand(spark, str(tmp_path / "out"), "csv")
    assert back.exceptAll(daily).count() == 0 and back.count() == 5
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert "2024-01-01" in text and text.startswith("date,store_id,item_id,daily_demand,price")
