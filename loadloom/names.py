"""Column contract of the load series.

Fixed values: names and types that stored tables and their users rely on.
"""

from __future__ import annotations

from pyspark.sql import types as T

TIME = "DateTime"
KEY = "id"
STAMP = "update_timestamp_utc"
LEFTOVER = "_rescued_data"

WEATHER = ["Temperature", "Humidity", "Wind_Speed"]
FLOWS = ["general_diffuse_flows", "diffuse_flows"]
CALENDAR = ["Hour", "Day", "Month"]
CATEGORIES = ["DayOfWeek", "IsWeekend"]
TARGETS = [
    "Zone_1_Power_Consumption",
    "Zone_2_Power_Consumption",
    "Zone_3_Power_Consumption",
]
PREDICTED = [
    "Predicted_PowerConsumption_Zone_1",
    "Predicted_PowerConsumption_Zone_2",
    "Predicted_PowerConsumption_Zone_3",
]

NUMERIC_FEATURES = WEATHER + CALENDAR + FLOWS
INDICATORS = [
    "DayOfWeek_1",
    "DayOfWeek_2",
    "DayOfWeek_3",
    "DayOfWeek_4",
    "DayOfWeek_5",
    "DayOfWeek_6",
    "IsWeekend_1",
]
MODEL_INPUTS = NUMERIC_FEATURES + INDICATORS
INTERACTION = "weather_interaction"

# Declared levels of the two categorical columns; the first one has no indicator.
DOMAINS = {"DayOfWeek": [0, 1, 2, 3, 4, 5, 6], "IsWeekend": [0, 1]}


def _schema(*groups: tuple[list[str], T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for names, t in groups for n in names])


RAW_SCHEMA = _schema(
    (WEATHER, T.DoubleType()),
    (CALENDAR, T.IntegerType()),
    (FLOWS, T.DoubleType()),
    (CATEGORIES, T.IntegerType()),
    (TARGETS, T.DoubleType()),
)

PREPARED_SCHEMA = _schema(
    (WEATHER, T.DoubleType()),
    (CALENDAR, T.IntegerType()),
    (FLOWS, T.DoubleType()),
    (INDICATORS, T.IntegerType()),
    (TARGETS, T.DoubleType()),
)

FEATURE_TABLE_SCHEMA = T.StructType(
    [T.StructField(KEY, T.StringType(), False), T.StructField(TIME, T.TimestampType(), True)]
    + _schema((WEATHER + FLOWS, T.DoubleType()), (INDICATORS, T.IntegerType())).fields
)
