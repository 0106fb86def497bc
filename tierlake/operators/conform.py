"""Silver conformance: project, rename, flatten, require keys, dedupe, normalise.

Each ``conform_*`` mirrors one source's bronze -> silver step.  All are pure
projections plus one aggregate (the dedupe), so Catalyst collapses the chain
into a single scan -> partial aggregate -> exchange -> final aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.functions.dates import parse_date
from tierlake.functions.text import initcap_columns
from tierlake.operators.dedupe import dedupe

# --- fixed values: silver column names by landing name, and the lineage columns -----
LINEAGE = ("ingested_at", "source_file")
CIRCUIT_NAMES = {"circuitId": "circuit_id", "circuitName": "circuit_name", "lat": "latitude", "long": "longitude"}
RACE_NAMES = {"circuitId": "circuit_id", "raceName": "race_name", "date": "race_date"}
CONSTRUCTOR_NAMES = {"constructorId": "constructor_id", "name": "constructor_name"}
DRIVER_NAMES = {"driverId": "driver_id", "dateOfBirth": "date_of_birth"}
PERSON_NAMES = {"givenName": "first_name", "familyName": "last_name"}
RESULT_NAMES = {"raceName": "race_name", "constructorId": "constructor_id", "driverId": "driver_id",
                "positionText": "position_text"}
# --- end fixed values ---------------------------------------------------------------


def select_present(df: DataFrame, cols: list[str]) -> DataFrame:
    """``select`` of the listed columns, skipping lineage columns the frame lacks."""
    return df.select(*[c for c in cols if c in df.columns or c not in LINEAGE])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``withColumnsRenamed``; names absent from the frame are ignored."""
    return df.withColumnsRenamed(mapping)


def flatten_struct(df: DataFrame, col: str, mapping: dict[str, str]) -> DataFrame:
    """Lift struct fields to top-level columns (``mapping`` field -> new name), drop the struct."""
    return df.withColumns({new: F.col(f"{col}.{field}") for field, new in mapping.items()}).drop(col)


def require_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows whose listed columns are all non-NULL (pushed to the scan as IsNotNull)."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.filter(cond)


def conform_circuits(bronze: DataFrame) -> DataFrame:
    df = select_present(bronze, ["circuitId", "circuitName", "lat", "long", "locality", "country",
                                 "ingested_at", "source_file"])
    df = rename_columns(df, CIRCUIT_NAMES)
    df = require_not_null(df, ["circuit_id"])
    df = dedupe(df, ["circuit_id"])
    return initcap_columns(df, ["circuit_name", "locality"])


def conform_races(bronze: DataFrame) -> DataFrame:
    df = select_present(bronze, ["season", "round", "raceName", "date", "circuitId",
                                 "ingested_at", "source_file"])
    df = rename_columns(df, RACE_NAMES)
    # Landing ``round`` is text; make it the integer key results use *before* the
    # dedupe so '1' and '01' are one race (a malformed round fails under ANSI).
    df = df.withColumn("round", F.col("round").cast("int"))
    df = dedupe(df, ["season", "round"])
    return initcap_columns(df, ["race_name"])


def conform_constructors(bronze: DataFrame) -> DataFrame:
    df = bronze.drop("url")
    df = rename_columns(df, CONSTRUCTOR_NAMES)
    df = dedupe(df, ["constructor_id"])
    return initcap_columns(df, ["nationality"])


def conform_drivers(bronze: DataFrame) -> DataFrame:
    df = flatten_struct(bronze, "name", PERSON_NAMES).drop("url")
    df = rename_columns(df, DRIVER_NAMES)
    df = dedupe(df, ["driver_id"])
    return initcap_columns(df, ["first_name", "last_name", "nationality"])


def conform_results(bronze: DataFrame) -> DataFrame:
    df = rename_columns(bronze.drop("url"), RESULT_NAMES)
    df = dedupe(df, ["season", "round", "driver_id"])
    return initcap_columns(df, ["race_name", "status"])


def conform_sprints(bronze: DataFrame, strict_dates: bool = True) -> DataFrame:
    df = rename_columns(bronze.drop("url"), RESULT_NAMES)
    df = dedupe(df, ["season", "round", "driver_id"])
    df = initcap_columns(df, ["race_name", "status"])
    return parse_date(df, "date", "yyyy-MM-dd", strict=strict_dates)


CONFORMERS = {
    "circuits": conform_circuits,
    "races": conform_races,
    "constructors": conform_constructors,
    "drivers": conform_drivers,
    "results": conform_results,
    "sprints": conform_sprints,
}
