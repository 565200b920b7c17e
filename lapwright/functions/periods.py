"""Calendar conditions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def since_days(start: Column, days: int, as_of: str | dt.date | None = None) -> Column:
    """Condition: ``start`` is no earlier than ``days`` before ``as_of`` (today by default)."""
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return start >= F.date_sub(day, days)
