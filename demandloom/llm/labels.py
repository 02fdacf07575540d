"""Labelled rows that classifiers may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """True for the fold that is kept for testing: crc32 of the id as text, modulo ``folds``."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(False))


def training_labels(labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """One ``(doc_id, label)`` a document outside the held-out fold.

    Rows without an id or a label are left out. A document that is labelled both ways is left out too.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    agreed = (
        known.filter(~held_out("doc_id", folds, fold))
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
    )
    return agreed.filter("label = other").select("doc_id", "label")
