"""Writers of stages and reports: one distributed write each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.calendar import iso_text


def write_stage(
    df: DataFrame,
    path: str,
    sort: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    files_per_partition: int = 0,
    format: str = "parquet",
) -> None:
    """Overwrite one stage table.

    ``sort`` orders rows inside each file, for tight row-group statistics; no global sort.
    With ``partition_by`` and ``files_per_partition`` rows are first spread by a hash of the
    whole row, so each folder gets at most that many files and a hot store several writers.
    """
    if partition_by and files_per_partition:
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
        df = df.repartition(*partition_by, spread)
    if sort:
        df = df.sortWithinPartitions(*partition_by, *sort)
    writer = df.write.mode("overwrite").format(format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Text export with a header and ISO dates."""
    dates = {f.name: iso_text(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, T.DateType)}
    flat = df.withColumns(dates) if dates else df
    flat.write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, path: str, format: str = "csv") -> None:
    """A report table; nested columns are left out of text exports."""
    if format == "csv":
        nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
        export_csv(df.drop(*nested), path)
    else:
        df.write.mode("overwrite").format(format).save(path)
