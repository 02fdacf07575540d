"""Typed scans of the raw and staged tables.

Delimited files are read by header name, never with type inference, and converted strictly:
a malformed date or number fails the job. Spark splits large files by itself, which is all
the chunking there is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.parsing import blank_to_null, nan_to_null, strict_date
from demandloom.schemas import CATALOG, DEMAND, DISCOUNTS_HISTORY, PRICE_HISTORY, SALES


def _typed(name: str, kind: T.DataType) -> Column:
    text = blank_to_null(F.col(name))
    if isinstance(kind, T.DateType):
        return strict_date(text).alias(name)
    if isinstance(kind, T.DoubleType):
        return nan_to_null(text.cast(kind)).alias(name)
    if isinstance(kind, T.IntegerType):
        # "3" and "3.0" are both written for whole numbers; "3.7" is none.
        number = text.cast("double")
        wrong = F.raise_error(F.concat(F.lit(f"{name} is not a whole number: "), text))
        return F.when(number == F.floor(number), number.cast(kind)).when(number.isNotNull(), wrong.cast(kind)).alias(name)
    return text.cast(kind).alias(name)


def _csv(spark: SparkSession, path: str) -> DataFrame:
    """Text columns of CSV files that all have the same header.

    A file whose header differs, and a row with too few or too many fields, end the read with an
    error. That needs whole rows parsed, so columns are not pruned here.
    """
    names = spark.read.option("header", True).csv(path).schema
    strict = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    return strict.option("columnPruning", False).schema(names).csv(path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "csv",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The columns of ``schema`` (or some of them); other columns of the file are not read.

    A missing path raises Spark's ``PATH_NOT_FOUND``.
    """
    fields = [f for f in schema.fields if columns is None or f.name in columns]
    if format == "csv":
        return _csv(spark, path).select(*[_typed(f.name, f.dataType) for f in fields])
    return spark.read.format(format).load(path).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]
    )


def column_names(spark: SparkSession, path: str, format: str = "csv") -> list[str]:
    """All columns of a table on disk, known or not; reads no rows."""
    return spark.read.option("header", True).format(format).load(path).columns


def read_sales(spark: SparkSession, path: str, format: str = "csv", columns: Sequence[str] | None = None) -> DataFrame:
    """Point-of-sale rows; an index column in the file is left out."""
    return read_table(spark, path, SALES, format, columns)


def read_catalog(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """Catalog rows with ``row_order``: the place in the files, which decides among duplicates.

    A staged table must bring an order column of its own under that name.
    """
    if format == "csv":
        place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
        return _csv(spark, path).select(*[_typed(f.name, f.dataType) for f in CATALOG.fields], place.alias("row_order"))
    return spark.read.format(format).load(path)


def read_demand(spark: SparkSession, path: str, format: str = "parquet", columns: Sequence[str] | None = None) -> DataFrame:
    """A daily or prepared demand stage."""
    return read_table(spark, path, DEMAND, format, columns)


def read_price_history(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    return read_optional(spark, path, PRICE_HISTORY, format)


def read_discounts_history(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    return read_optional(spark, path, DISCOUNTS_HISTORY, format)


def read_optional(spark: SparkSession, path: str, schema: T.StructType, format: str = "csv") -> DataFrame:
    """Like ``read_table``, but a missing path is an empty table."""
    try:
        return read_table(spark, path, schema, format)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def extract_item(
    spark: SparkSession,
    path: str,
    item_id: str,
    schema: T.StructType,
    format: str = "csv",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of one item; empty if the table is missing or holds none."""
    table = read_optional(spark, path, schema, format).where(F.col("item_id") == item_id)
    return table if columns is None else table.select(*columns)


def partition_days(spark: SparkSession, path: str, column: str) -> list[dt.date]:
    """Days that a stage has folders ``column=<day>`` for, in order; reads names only."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted(dt.date.fromisoformat(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}="))
