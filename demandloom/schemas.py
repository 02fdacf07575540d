"""Column layouts of the staged tables, and the description of a time split."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Window, WindowSpec
from pyspark.sql import types as T

SERIES_KEYS = ("store_id", "item_id")
DAY_KEYS = ("date", "store_id", "item_id")


def series_window() -> WindowSpec:
    """Days of one series in order, the one window of all series operators.

    The item comes first because it tells rows apart sooner than the store when they are sorted.
    """
    return Window.partitionBy("item_id", "store_id").orderBy("date")



SALES = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("price_base", T.DoubleType()),
        T.StructField("sum_total", T.DoubleType()),
    ]
)

DEMAND = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("daily_demand", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
    ]
)

# The catalog's columns. Raw text on disk: the physical attributes hold numbers or junk and are parsed leniently.
CATALOG = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "item_id",
            "dept_name",
            "class_name",
            "subclass_name",
            "item_type",
            "weight_volume",
            "weight_netto",
            "fatness",
        )
    ]
)

PRICE_HISTORY = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("price", T.DoubleType()),
    ]
)

DISCOUNTS_HISTORY = T.StructType([T.StructField("item_id", T.StringType())])

# Catalog label -> name of its ordinal code, and the physical attributes.
LABEL_CODES = {
    "dept_name": "dept_code",
    "class_name": "class_code",
    "subclass_name": "subclass_code",
    "item_type": "item_type_code",
}
PHYSICAL_ATTRIBUTES = ("weight_volume", "weight_netto", "fatness")

# The model's input columns, in order.
MODEL_COLUMNS = (
    "price",
    "lag_1",
    "lag_7",
    "lag_14",
    "lag_28",
    "rolling_mean_7",
    "rolling_mean_14",
    "rolling_mean_28",
    "rolling_std_7",
    "rolling_std_28",
    "price_change",
    "day_of_week",
    "day_of_month",
    "month",
    "week_of_year",
    "is_weekend",
    "store_id",
    "item_code",
    "dept_code",
    "class_code",
    "subclass_code",
    "item_type_code",
    "weight_volume",
    "weight_netto",
    "fatness",
)
CATEGORICAL_COLUMNS = ("store_id", "item_code", *LABEL_CODES.values())
CALENDAR_COLUMNS = ("day_of_week", "day_of_month", "month", "week_of_year", "is_weekend")
NUMERIC_COLUMNS = tuple(c for c in MODEL_COLUMNS if c not in CATEGORICAL_COLUMNS)
FEATURE_TABLE_COLUMNS = ("date", "item_id", *MODEL_COLUMNS, "target")


@dataclass(frozen=True)
class Period:
    """An inclusive range of days."""

    name: str
    start: dt.date
    end: dt.date


@dataclass(frozen=True)
class SplitSpec:
    """Three consecutive inclusive periods for fitting, tuning and final scoring."""

    # The default periods.
    train: Period = field(
        default_factory=lambda: Period("train", dt.date(2022, 8, 28), dt.date(2024, 3, 31))
    )
    validation: Period = field(
        default_factory=lambda: Period("validation", dt.date(2024, 4, 1), dt.date(2024, 6, 30))
    )
    test: Period = field(
        default_factory=lambda: Period("test", dt.date(2024, 7, 1), dt.date(2024, 9, 25))
    )

    @property
    def periods(self) -> tuple[Period, Period, Period]:
        return (self.train, self.validation, self.test)

    @classmethod
    def of(cls, train: tuple[str, str], validation: tuple[str, str], test: tuple[str, str]) -> "SplitSpec":
        """Build from ISO date strings."""

        def period(name: str, bounds: tuple[str, str]) -> Period:
            return Period(name, *(dt.date.fromisoformat(b) for b in bounds))

        return cls(period("train", train), period("validation", validation), period("test", test))
