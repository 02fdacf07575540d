from pyspark.sql import functions as F

from demandloom.operators.catalog import catalog_codes
from demandloom.operators.ordinals import label_ordinals, ordinal_codes


def test_positions_follow_sort_order_over_many_partitions(spark):
    names = sorted({f"{(i * 7919) % 100003:x}" for i in range(3000)})
    df = spark.createDataFrame([(n,) for n in reversed(names)] * 2 + [(None,)], "item_id string")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        codes = ordinal_codes(df.repartition(13), "item_id", "code")
        assert codes.select(F.spark_partition_id()).distinct().count() > 1
        found = dict(codes.collect())
    finally:
        spark.conf.unset(coalesce)
    assert found == {name: i for i, name in enumerate(names)}


def test_labels_count_from_zero_per_field(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", "y")], "dept string, kind string")
    found = {(r.field, r.label): r.code for r in label_ordinals(df, ["dept", "kind"]).collect()}
    assert found == {("dept", "a"): 0, ("dept", "b"): 1, ("kind", "x"): 0, ("kind", "y"): 1}


def test_catalog_keeps_first_row_and_parses_junk(spark):
    rows = [
        ("i1", 2, "Z", "c", "s", "t", "9", "9", "9"),
        ("i1", 1, "A", None, "s", "t", "1.5", "n/a", "3d"),
        ("i2", 3, None, "c", "s", "u", None, " 2 ", "1e1"),
        (None, 4, "Q", "q", "q", "q", "1", "1", "1"),
    ]
    schema = (
        "item_id string, row_order long, dept_name string, class_name string, subclass_name string, "
        "item_type string, weight_volume string, weight_netto string, fatness string"
    )
    found = {r.item_id: r for r in catalog_codes(spark.createDataFrame(rows, schema)).collect()}
    assert set(found) == {"i1", "i2"}
    first = found["i1"]
    assert (first.dept_code, first.class_code, first.item_type_code) == (0, -1, 0)
    assert (first.weight_volume, first.weight_netto, first.fatness) == (1.5, None, None)
    second = found["i2"]
    assert (second.dept_code, second.class_code, second.item_type_code) == (-1, 0, 1)
    assert (second.weight_volume, second.weight_netto, second.fatness) == (None, 2.0, 10.0)
