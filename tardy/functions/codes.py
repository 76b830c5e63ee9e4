"""Code normalisation (upper + trim) for the fact and both dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tardy.schema import AIRLINE_RENAMES, AIRPORT_RENAMES, CODE_COLUMNS


def normalized_code(c: Column | str) -> Column:
    """Upper-case, then strip spaces. Idempotent; a blank code becomes '' (not null)."""
    return F.trim(F.upper(F.col(c) if isinstance(c, str) else c))


def normalize_flight_codes(df: DataFrame) -> DataFrame:
    """Normalise AIRLINE, ORIGIN_AIRPORT and DESTINATION_AIRPORT in one projection."""
    return df.withColumns({c: normalized_code(c) for c in CODE_COLUMNS if c in df.columns})


def airline_dimension(raw: DataFrame) -> DataFrame:
    """Airline CSV -> (AIRLINE_CODE, AIRLINE_NAME), code normalised, name trimmed."""
    return (
        raw.withColumnsRenamed(AIRLINE_RENAMES)
        .select(
            normalized_code("AIRLINE_CODE").alias("AIRLINE_CODE"),
            F.trim("AIRLINE_NAME").alias("AIRLINE_NAME"),
        )
    )


def airport_dimension(raw: DataFrame) -> DataFrame:
    """Airport CSV -> (AIRPORT_CODE, AIRPORT_NAME, CITY_NAME, STATE_CODE); other columns dropped."""
    return (
        raw.withColumnsRenamed(AIRPORT_RENAMES)
        .select(
            normalized_code("AIRPORT_CODE").alias("AIRPORT_CODE"),
            F.trim("AIRPORT_NAME").alias("AIRPORT_NAME"),
            F.trim("CITY_NAME").alias("CITY_NAME"),
            F.trim("STATE_CODE").alias("STATE_CODE"),
        )
    )
