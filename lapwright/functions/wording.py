"""Labels and number formats shown to users."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label and upper bound of each band; a bound belongs to the band it closes,
# except the first, which ends just below it.
COLD, MODERATE, WARM, HOT = "Cold (<30°C)", "Moderate (30-40°C)", "Warm (40-50°C)", "Hot (>50°C)"
BANDS = (COLD, MODERATE, WARM, HOT)


def track_temperature_band(celsius: Column) -> Column:
    return (
        F.when(celsius < 30, COLD)
        .when(celsius.between(30, 40), MODERATE)
        .when(celsius.between(40, 50), WARM)
        .otherwise(HOT)
    )


def band_order(label: Column) -> Column:
    """Position of a band label, coldest first."""
    return F.array_position(F.array(*[F.lit(b) for b in BANDS]), label)


def rain_label(rainfall: Column) -> Column:
    return F.when(rainfall > 0, "Yes").otherwise("No")


def session_label(location: Column, session_type: Column, start: Column) -> Column:
    """Menu entry for a session: place, kind and start."""
    return F.concat(
        location, F.lit(" - "), session_type, F.lit(" ("), F.date_format(start, "yyyy-MM-dd HH:mm:ss"), F.lit(")")
    )


def fixed_point(value: Column, places: int) -> Column:
    """Number as text with a fixed count of places and no digit grouping."""
    return F.round(value.cast("decimal(28,10)"), places).cast(f"decimal(28,{places})").cast("string")
