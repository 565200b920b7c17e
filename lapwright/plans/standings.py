"""Finishing and grid order worked out from lap times, where none were recorded."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapwright.plans.common import ENTRY


def _placed(laps: DataFrame, *order) -> DataFrame:
    per_driver = laps.where("lap_duration is not null").groupBy(*ENTRY).agg(
        F.count(F.lit(1)).alias("driven"), F.min("lap_duration").alias("best")
    )
    # One row per driver of a session is left to order.
    within = Window.partitionBy("session_key").orderBy(*order, "best", "driver_number")
    return per_driver.withColumn("position", F.row_number().over(within)).select(*ENTRY, "position")


def final_positions(laps: DataFrame) -> DataFrame:
    """Most timed laps first, then the best time."""
    return _placed(laps, F.desc("driven"))


def grid_positions(laps: DataFrame) -> DataFrame:
    """Best time first."""
    return _placed(laps)
