"""Weather categories of the analytical queries.

Labels and thresholds are fixed values of the reference queries; NULL weather
falls into the last category, as in SQL ``CASE``. The tables below are read from
the top: the first lower bound that a value reaches gives its label.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rain categories (mm/h) from their lower bounds.
RAIN = [
    (7.6, "4. Heavy Rain (≥ 7.6 mm/h)"),
    (2.5, "3. Moderate Rain (2.5-7.6 mm/h)"),
    (0.2, "2. Light Rain (0.2-2.5 mm/h)"),
]
RAIN_DRY = "1. Dry/Normal (< 0.2 mm/h)"

# Temperature categories (°C); cold is below its bound.
TEMP_COLD_BELOW = 5
TEMP_COLD = "1. Cold (< 5°C)"
TEMP_HOT_FROM = 30
TEMP_HOT = "3. Hot (> 30°C)"
TEMP_NORMAL = "2. Normal (5°C - 30°C)"

# Wind categories (km/h) from their lower bounds.
WIND = [
    (36, "1. Strong (≥ 36 km/h)"),
    (20, "2. Moderate (20-36 km/h)"),
]
WIND_LIGHT = "3. Light (< 20 km/h)"

# Shootout weather categories; the thresholds differ from the others.
SHOOTOUT_RAIN_ABOVE = 7.6
SHOOTOUT_COLD_BELOW = 5
SHOOTOUT_HOT_FROM = 25
SHOOTOUT_EXTREME = "1. Extreme Weather (Heavy Rain/Extreme Temp)"
SHOOTOUT_NORMAL = "2. Normal Weather"


def _from_lower_bounds(value: Column, table: list[tuple[float, str]], rest: str) -> Column:
    out = F
    for bound, label in table:
        out = out.when(value >= bound, F.lit(label))
    return out.otherwise(F.lit(rest))


def rain_category(precip: Column) -> Column:
    return _from_lower_bounds(precip, RAIN, RAIN_DRY)


def temperature_category(temp: Column) -> Column:
    return (
        F.when(temp < TEMP_COLD_BELOW, F.lit(TEMP_COLD))
        .when(temp >= TEMP_HOT_FROM, F.lit(TEMP_HOT))
        .otherwise(F.lit(TEMP_NORMAL))
    )


def wind_category(wind: Column) -> Column:
    return _from_lower_bounds(wind, WIND, WIND_LIGHT)


def shootout_weather_category(precip: Column, temp: Column) -> Column:
    """Extreme is heavy rain, cold or hot."""
    extreme = (precip > SHOOTOUT_RAIN_ABOVE) | (temp < SHOOTOUT_COLD_BELOW) | (temp >= SHOOTOUT_HOT_FROM)
    return F.when(extreme, F.lit(SHOOTOUT_EXTREME)).otherwise(F.lit(SHOOTOUT_NORMAL))
