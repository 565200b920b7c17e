"""Partial aggregates that merge: what the aggregate tables are made from, kept from update to update.

Of a table without key, new rows are aggregated alone and merged into the kept state. In a table with a key, a corrected copy may
replace a row, which a minimum or a best row cannot give back. To tell such rows takes a join on the key of all rows now
and before; one partial aggregation of the changed buckets, which the update has just written, costs far less.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwright.functions.measures import parts_of_mean, parts_of_spread
from lapwright.plans.common import ENTRY, Tables
from lapwright.schemas import TABLES

_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def _clear() -> Column:
    return F.col("lap_duration").isNotNull() & ~F.col("is_pit_out_lap")


@dataclass(frozen=True)
class State:
    """Aggregates of a cleaned table per group. Each part has an aggregate and the way in which two of its values merge."""

    endpoint: str
    by: tuple[str, ...]
    parts: Callable[[], Mapping[str, tuple[Column, str]]]
    where: Callable[[], Column] = lambda: F.lit(True)
    renamed: Mapping[str, str] = field(default_factory=dict)

    @property
    def silver(self) -> str:
        return TABLES[self.endpoint].silver

    def of(self, rows: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        """State of some rows; ``more`` names further columns that depend on the group."""
        rows = rows.withColumnsRenamed(dict(self.renamed)).where(self.where())
        return rows.groupBy(*self.by, *more).agg(*[c.alias(n) for n, (c, _) in self.parts().items()])

    def merged(self, states: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        """One state per group from several."""
        return states.groupBy(*self.by, *more).agg(*[_MERGE[how](n).alias(n) for n, (_, how) in self.parts().items()])


def _count(condition: Column | None = None) -> tuple[Column, str]:
    return F.count(F.lit(1)) if condition is None else F.count_if(condition), "sum"


def _pace() -> dict[str, tuple[Column, str]]:
    traps = {f"max_speed_{t}": (F.max(f"{t}_speed"), "max") for t in ("i1", "i2", "st")}
    return {
        "total_laps": _count(), "fastest_lap_time": (F.min("lap_duration"), "min"),
        **{n: (c, "sum") for n, c in parts_of_spread("lap_duration").items()}, **traps,
    }


def _best() -> dict[str, tuple[Column, str]]:
    return {"best": (F.min(F.struct("lap_duration", "lap_number")), "min")}


def _race() -> dict[str, tuple[Column, str]]:
    return {
        "total_laps": (F.max("lap_number"), "max"), "fastest_lap": (F.min("lap_duration"), "min"),
        "total_pit_stops": _count(F.col("is_pit_out_lap")),
    }


def _stops() -> dict[str, tuple[Column, str]]:
    return {
        "stops": _count(), "fastest_pit_stop": (F.min("pit_duration"), "min"),
        **{n: (c, "sum") for n, c in parts_of_mean("pit_duration").items()},
    }


# Messages that are counted, as fixed values of their columns.
SHOWN = {"yellow_flags": ("flag", "YELLOW"), "red_flags": ("flag", "RED"), "safety_cars": ("category", "SafetyCar")}


def _messages() -> dict[str, tuple[Column, str]]:
    return {n: _count(F.col(c) == value) for n, (c, value) in SHOWN.items()}


def _weather() -> dict[str, tuple[Column, str]]:
    means = {}
    for c in ("air_temperature", "track_temperature"):
        means |= {f"{c}_{n}": (part, "sum") for n, part in parts_of_mean(c).items()}
    return {**means, "rainfall_detected": (F.max("rainfall"), "max")}


STATES = {
    "state_pace": State("laps", tuple(ENTRY), _pace, where=_clear),
    "state_best_lap": State("laps", tuple(ENTRY), _best, where=_clear),
    "state_race_laps": State("laps", ("session_key",), _race, where=lambda: F.col("lap_duration").isNotNull()),
    "state_pit": State("pit", tuple(ENTRY), _stops),
    "state_messages": State("race_control", ("session_key",), _messages),
    "state_weather": State("weather", ("session_key",), _weather),
    "state_overtakes": State(
        "overtakes", (*ENTRY, "meeting_key"), lambda: {"overtakes_made": _count()},
        renamed={"overtaking_driver_number": "driver_number"},
    ),
}


def state(tables: Tables, name: str) -> DataFrame:
    """A stored state, or the state of the cleaned table where none is stored."""
    return tables[name] if name in tables else STATES[name].of(tables[STATES[name].silver])


def advanced(
    kind: State, kept: DataFrame, rows: DataFrame, fresh: DataFrame, before: DataFrame | None, more: Sequence[str] = ()
) -> DataFrame:
    """State after an update of its cleaned table.

    ``kept`` is the state before, ``rows`` the cleaned rows now, ``fresh`` those among them that the update wrote, and
    ``before`` the cleaned rows before; None for a table without key, to which rows are only added. Where rows may have been
    replaced, the state is that of all rows, read once and grouped by map task.
    """
    if before is None:
        return kind.merged(kept.unionByName(kind.of(fresh, more)), more)
    return kind.of(rows, more)
