"""One compact, numeric row per catalog item, and item codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.parsing import lenient_double, nan_to_null
from demandloom.operators.ordinals import label_ordinals, ordinal_codes
from demandloom.schemas import LABEL_CODES, PHYSICAL_ATTRIBUTES


def first_per_item(catalog: DataFrame, order: str = "row_order") -> DataFrame:
    """First row of each item by ``order``.

    ``min_by`` combines before the shuffle, so an item with a huge number of copies is not
    gathered and sorted the way ``row_number() = 1`` would.
    """
    columns = [c for c in catalog.columns if c not in ("item_id", order)]
    return (
        catalog.where(F.col("item_id").isNotNull())
        .groupBy("item_id")
        .agg(F.min_by(F.struct(*columns), F.col(order)).alias("_row"))
        .select("item_id", "_row.*")
    )


def catalog_codes(catalog: DataFrame, order: str = "row_order") -> DataFrame:
    """Labels as ordinal codes (missing -1) and physical attributes as numbers or NULL."""
    items = first_per_item(
        catalog.select("item_id", order, *LABEL_CODES, *PHYSICAL_ATTRIBUTES), order
    )
    # Missing labels stay out of the lookup: they would all meet under one key.
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("label")) for c in LABEL_CODES])
    labels = items.select("item_id", F.inline(fields)).where(F.col("label").isNotNull())
    found = (
        labels.join(label_ordinals(items, list(LABEL_CODES)), ["field", "label"])
        .groupBy("item_id")
        .agg(*[F.max(F.when(F.col("field") == label, F.col("code"))).alias(code) for label, code in LABEL_CODES.items()])
    )
    return items.join(found, "item_id", "left").select(
        "item_id",
        *[F.coalesce(code, F.lit(-1)).alias(code) for code in LABEL_CODES.values()],
        *[nan_to_null(lenient_double(F.col(c))).alias(c) for c in PHYSICAL_ATTRIBUTES],
    )


def item_codes(prepared: DataFrame) -> DataFrame:
    """``(item_id, item_code)``: place of each item in the sorted list of all items."""
    return ordinal_codes(prepared, "item_id", "item_code")
