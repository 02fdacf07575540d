"""Appending runs: a new day of demand becomes prepared rows and features without rereading the history.

A state table holds the last days of each series: all that the lags and windows of a later day can
look at. A run reads the state before its day, fills each series that sold up to the day, features the rows
whose next day is now known, and writes these, the filled days and the new state to a folder of its own,
``run_date=<day>``. Running a day again overwrites that folder with the same rows. A day that is run again with
other rows, or late, needs the runs of later days again, in order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.operators import demand, features
from demandloom.plans.runs import StageFolder
from demandloom.schemas import DEMAND, FEATURE_TABLE_COLUMNS, SERIES_KEYS
from demandloom.sources import readers, sinks

#: Days of a series that its next rows look at: the longest lag, and the last day itself.
STATE_DAYS = max(*features.LAGS, *features.MEAN_WINDOWS, *features.STD_WINDOWS) + 1
PREPARED, FEATURES, STATE = "prepared_by_run", "features_by_run", "series_state"
COLUMNS = [f.name for f in DEMAND.fields]


def last_days(prepared: DataFrame, days: int = STATE_DAYS) -> DataFrame:
    """The last ``days`` rows of each gapless series."""
    last = prepared.groupBy(*SERIES_KEYS).agg(F.max("date").alias("_last"))
    return (
        prepared.join(last, list(SERIES_KEYS))
        .where(F.col("date") > F.date_sub("_last", days))
        .select(*COLUMNS)
    )


def _folder(stages: StageFolder, stage: str, day: dt.date) -> str:
    return f"{stages.path(stage)}/run_date={day.isoformat()}"


def start_appending(
    spark: SparkSession, stages: StageFolder, day: dt.date, prepared: DataFrame, built: DataFrame | None = None
) -> None:
    """Begin after a full run that ended with ``day``: its rows become the run of that day, once.

    ``prepared`` are the gapless series of the whole history (no rows: begin with nothing), ``built`` their features.
    """
    sinks.write_stage(prepared.select(*COLUMNS), _folder(stages, PREPARED, day), sort=("item_id", "store_id", "date"))
    sinks.write_stage(last_days(readers.read_demand(spark, _folder(stages, PREPARED, day))), _folder(stages, STATE, day))
    if built is not None:
        sinks.write_stage(built.select(*FEATURE_TABLE_COLUMNS), _folder(stages, FEATURES, day), sort=("date", *SERIES_KEYS))


def append_day(
    spark: SparkSession, stages: StageFolder, day: dt.date, daily: DataFrame, items: DataFrame, codes: DataFrame
) -> dict[str, DataFrame]:
    """Take in the demand of ``day``: one row per series that sold, as the daily stage has them.

    ``items`` and ``codes`` are the item dimensions of the model in use; items that they lack are unknown. Series that
    did not sell keep their state as it is, whatever their number of days without a sale.
    """
    before = [d for d in readers.partition_days(spark, stages.path(STATE), "run_date") if d < day]
    if not before:
        raise RuntimeError(f"no state before {day}: call start_appending first")
    state = readers.read_demand(spark, _folder(stages, STATE, max(before)))
    sold = daily.select(*COLUMNS)
    if not sold.where(F.col("date") != F.lit(day)).isEmpty():
        raise ValueError(f"rows of other days than {day}")
    running = sold.select(*SERIES_KEYS)
    active = state.join(running, list(SERIES_KEYS), "left_semi")

    # state rows are gapless and priced already, so preparing them again leaves them as they are
    filled = demand.prepare_demand(active.unionByName(sold))
    ended = active.groupBy(*SERIES_KEYS).agg(F.max("date").alias("_ended"))
    keys = list(SERIES_KEYS)
    fresh = filled.join(ended, keys, "left").where(F.col("_ended").isNull() | (F.col("date") > F.col("_ended")))
    sinks.write_stage(fresh.select(*COLUMNS), _folder(stages, PREPARED, day), sort=("item_id", "store_id", "date"))
    fresh = readers.read_demand(spark, _folder(stages, PREPARED, day))

    # the last row of the state had no target yet
    series = active.unionByName(fresh)
    known = features.series_features(series).join(ended, keys, "left")
    due = known.where(F.col("_ended").isNull() | (F.col("date") >= F.col("_ended"))).drop("_ended")
    built = features.attach_items(due, items, codes).select(*FEATURE_TABLE_COLUMNS)
    sinks.write_stage(built, _folder(stages, FEATURES, day), sort=("date", *SERIES_KEYS))

    resting = state.join(running, keys, "left_anti")
    sinks.write_stage(resting.unionByName(last_days(series)), _folder(stages, STATE, day))
    return {
        "prepared": fresh,
        "features": spark.read.schema(built.schema).parquet(_folder(stages, FEATURES, day)),
        "state": readers.read_demand(spark, _folder(stages, STATE, day)),
    }


def appended(spark: SparkSession, stages: StageFolder, stage: str = FEATURES) -> DataFrame:
    """All rows of a stage that the runs have written, with the ``run_date`` of each."""
    return spark.read.option("basePath", stages.path(stage)).parquet(f"{stages.path(stage)}/run_date=*")
