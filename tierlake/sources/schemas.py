"""Declared landing schemas of the six bronze sources.

Fixed values: the field names, order and types below must equal the reference's
declared landing schemas, since CSV binds by position and JSON binds by name.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values: declared landing schemas -------------------------------------
CIRCUITS_SCHEMA = StructType([
    StructField("circuitId", StringType(), True),
    StructField("url", StringType(), True),
    StructField("circuitName", StringType(), True),
    StructField("lat", DoubleType(), True),
    StructField("long", DoubleType(), True),
    StructField("locality", StringType(), True),
    StructField("country", StringType(), True),
])

RACES_SCHEMA = StructType([
    StructField("season", IntegerType(), False),
    StructField("round", StringType(), True),
    StructField("url", StringType(), True),
    StructField("raceName", StringType(), True),
    StructField("date", DateType(), True),
    StructField("circuitId", StringType(), True),
])

CONSTRUCTORS_DDL = "constructorId STRING, name STRING, nationality STRING, url STRING"

DRIVER_NAME_SCHEMA = StructType([
    StructField("givenName", StringType(), True),
    StructField("familyName", StringType(), True),
])

DRIVERS_SCHEMA = StructType([
    StructField("driverId", StringType(), True),
    StructField("name", DRIVER_NAME_SCHEMA),
    StructField("dateOfBirth", DateType(), True),
    StructField("nationality", StringType(), True),
    StructField("url", StringType(), True),
])


def _result_fields(date_type):
    return [
        StructField("date", date_type, True),
        StructField("raceName", StringType(), True),
        StructField("round", IntegerType(), True),
        StructField("season", IntegerType(), True),
        StructField("url", StringType(), True),
        StructField("constructorId", StringType(), True),
        StructField("driverId", StringType(), True),
        StructField("grid", IntegerType(), True),
        StructField("laps", IntegerType(), True),
        StructField("number", IntegerType(), True),
        StructField("points", FloatType(), True),
        StructField("position", IntegerType(), True),
        StructField("positionText", StringType(), True),
        StructField("status", StringType(), True),
    ]


RESULTS_SCHEMA = StructType(_result_fields(DateType()))
# Sprints land their date as text and parse it in silver.
SPRINTS_SCHEMA = StructType(_result_fields(StringType()))
# --- end fixed values ------------------------------------------------------------

LANDING_SCHEMAS = {
    "circuits": CIRCUITS_SCHEMA,
    "races": RACES_SCHEMA,
    "constructors": CONSTRUCTORS_DDL,
    "drivers": DRIVERS_SCHEMA,
    "results": RESULTS_SCHEMA,
    "sprints": SPRINTS_SCHEMA,
}
