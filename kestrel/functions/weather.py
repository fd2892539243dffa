"""Weather expressions: daylight flag, freeze/snow risks, code recoding,
severity classes, hourly-array access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weather-code groups (WMO codes as used by the source).
RAIN_CODES = [61, 63, 65]
SNOW_CODES = [71, 73, 75]
DRIZZLE_CODES = [51, 53, 55]
CLOUDY_CODES = [1, 2, 3]
CLEAR_CODES = [0]
# Recoded labels, in source order.
RECODE_LABELS = [(RAIN_CODES, "Pluie"), (SNOW_CODES, "Neige"), (DRIZZLE_CODES, "Bruine"),
                 (CLOUDY_CODES, "Nuageux"), (CLEAR_CODES, "Ciel clair")]


def daylight(ts: Column, sunrise: Column, sunset: Column) -> Column:
    """1 when ``sunrise <= ts <= sunset``; 0 otherwise, also when sun is NULL."""
    return F.coalesce(((ts >= sunrise) & (ts <= sunset)).cast("int"), F.lit(0))


def weather_risks(temp: Column, code: Column, precipitation: Column | None = None,
                  snowfall: Column | None = None, rule: str = "code") -> dict[str, Column]:
    """Freeze-rain, freeze-snow and sleet flags.

    ``rule='code'`` uses the weather code (pipeline); ``rule='amount'`` uses
    precipitation / snowfall amounts (notebook variant).
    """
    if rule == "code":
        rain, snow = code.isin(*RAIN_CODES), code.isin(*SNOW_CODES)
    else:
        rain = (precipitation > 0) & (F.coalesce(snowfall, F.lit(0.0)) == 0)
        snow = snowfall > 0
    return {
        "risque_gel_pluie": F.coalesce(((temp <= 0) & rain).cast("int"), F.lit(0)),
        "risque_gel_neige": F.coalesce(((temp <= 0) & snow).cast("int"), F.lit(0)),
        "neige_fondue": F.coalesce(((temp > 0) & snow).cast("int"), F.lit(0)),
    }


def recode(code: Column) -> Column:
    """Code -> label for known groups, other codes unchanged (as text)."""
    out = code.cast("string")
    for codes, label in reversed(RECODE_LABELS):
        out = F.when(code.isin(*codes), F.lit(label)).otherwise(out)
    return out


def severity(code: Column) -> Column:
    """0-3 Normal, 51-65 Precipitation, 71-75 Ice/Snow, else Other."""
    return (F.when(code.between(0, 3), "Normal")
            .when(code.between(51, 65), "Precipitation")
            .when(code.between(71, 75), "Ice/Snow")
            .otherwise("Other"))


def hourly_value(arr: Column, hour: Column) -> Column:
    """Element of a 24-slot hourly array at ``hour`` (0-based); NULL if absent."""
    return F.try_element_at(arr, (hour + 1).cast("int"))
