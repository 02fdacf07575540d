"""Strict and lenient conversions from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that stand for "missing" in delimited files.
MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def blank_to_null(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_MARKERS), text)


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def strict_date(text: Column) -> Column:
    """ISO date; anything else fails the job."""
    return F.to_date(text, "yyyy-MM-dd")


def lenient_date(text: Column) -> Column:
    """ISO date; anything else is NULL."""
    return F.try_to_date(text, "yyyy-MM-dd")


def lenient_double(text: Column) -> Column:
    """Number; anything else is NULL.

    A plain ``try_cast`` would also take Java literals such as ``1d``, ``2F`` and ``NaN``.
    """
    number = text.cast("string").try_cast("double")
    return F.when(~text.cast("string").rlike(r"[A-Za-z]\s*$"), number)


def shifted_category(code: Column, name: str = "category") -> Column:
    """Category code moved up by one so that missing is 0; codes below -1 fail the job."""
    shifted = F.coalesce(lenient_double(code).cast("int"), F.lit(-1)) + 1
    message = F.concat(F.lit(f"value below -1 in categorical column {name}: "), code.cast("string"))
    return F.when(shifted < 0, F.raise_error(message).cast("int")).otherwise(shifted)
