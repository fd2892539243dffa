"""SQL surface: register the calendar / weather / delay-bin expressions as
temporary SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN expr``),
so SQL users get them without any Python UDF on the execution path."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The function bodies are the same rules as the Column builders in
# kestrel.functions.calendar / weather and kestrel.plans.transit.
_FUNCTIONS = {
    "school_holiday": ("d DATE", "INT", """CAST(weekofyear(d) IN (9, 15, 44) OR weekofyear(d) BETWEEN 24 AND 33
        OR (month(d) = 12 AND day(d) >= 21) OR (month(d) = 1 AND day(d) <= 8) AS INT)"""),
    "weather_recode": ("code INT", "STRING", """CASE WHEN code IN (61, 63, 65) THEN 'Pluie'
        WHEN code IN (71, 73, 75) THEN 'Neige' WHEN code IN (51, 53, 55) THEN 'Bruine'
        WHEN code IN (1, 2, 3) THEN 'Nuageux' WHEN code = 0 THEN 'Ciel clair' ELSE CAST(code AS STRING) END"""),
    "weather_severity": ("code INT", "STRING", """CASE WHEN code BETWEEN 0 AND 3 THEN 'Normal'
        WHEN code BETWEEN 51 AND 65 THEN 'Precipitation' WHEN code BETWEEN 71 AND 75 THEN 'Ice/Snow' ELSE 'Other' END"""),
    "delay_bin": ("s DOUBLE", "STRING", """CASE WHEN s > -500 AND s <= 0 THEN 'Avance'
        WHEN s > 0 AND s <= 60 THEN '0-1 min' WHEN s > 60 AND s <= 120 THEN '1-2 min'
        WHEN s > 120 AND s <= 300 THEN '2-5 min' WHEN s > 300 AND s <= 600 THEN '5-10 min'
        WHEN s > 600 AND s <= 3000 THEN '>10 min' END"""),
    "round_hour": ("t TIMESTAMP_NTZ", "TIMESTAMP_NTZ", "CAST(date_trunc('hour', t + INTERVAL 30 MINUTES) AS TIMESTAMP_NTZ)"),
    "score_band": ("s DOUBLE", "STRING", "CASE WHEN s > 0.9 THEN 'block' WHEN s > 0.7 THEN 'challenge' ELSE 'approve' END"),
}


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the temporary SQL functions; returns their names."""
    names = []
    for name, (args, ret, body) in _FUNCTIONS.items():
        full = f"{prefix}{name}"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {full}({args}) RETURNS {ret} RETURN {body}")
        names.append(full)
    return names
