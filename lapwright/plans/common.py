"""Frames that several answers start from."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]

ENTRY = ["session_key", "driver_number"]
RACE_TYPES = ("Race", "Sprint")


def only(df: DataFrame, **wanted) -> DataFrame:
    """Rows whose columns equal, or are among, the given values; None asks nothing."""
    for column, value in wanted.items():
        if value is None:
            continue
        many = isinstance(value, Iterable) and not isinstance(value, str)
        df = df.where(F.col(column).isin(list(value)) if many else F.col(column) == value)
    return df


def names(tables: Tables) -> DataFrame:
    """Driver and team name per session and driver."""
    return tables["silver_drivers"].select(*ENTRY, "full_name", "team_name")


def clear_laps(tables: Tables) -> DataFrame:
    """Laps with a time, known not to start from the pit lane.

    A lap whose flag is unknown is not among them.
    """
    return tables["silver_laps"].where(F.col("lap_duration").isNotNull() & ~F.col("is_pit_out_lap"))


def chosen_sessions(
    tables: Tables,
    columns: Sequence[str],
    year: int | None = None,
    session_key: int | None = None,
    session_type: str | Sequence[str] | None = None,
) -> DataFrame:
    """Sessions by year, key and type, with the listed columns beside the key.

    A session key takes the place of the type condition.
    """
    kind = None if session_key is not None else session_type
    picked = only(tables["silver_sessions"], year=year, session_key=session_key, session_type=kind)
    return picked.select("session_key", *columns)


def entrants(tables: Tables, sessions: DataFrame) -> DataFrame:
    """Drivers of the given sessions with the session columns.

    Joining these two small tables first leaves one join for the large table, on
    session and driver, where a busy session is spread over its drivers.
    """
    return names(tables).join(sessions, "session_key")


def null_last(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]
