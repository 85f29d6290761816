"""Lookup tables that turn codes into text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from riskloom.schemas import ADMISSION_SOURCES, ADMISSION_TYPES, DISCHARGE_DISPOSITIONS

ENCOUNTER_LOOKUPS: dict[str, Mapping[int, str]] = {
    "admission_type_id": ADMISSION_TYPES,
    "discharge_disposition_id": DISCHARGE_DISPOSITIONS,
    "admission_source_id": ADMISSION_SOURCES,
}


def lookup_values(values: Mapping[int, str]) -> str:
    """The rows of a lookup as a SQL VALUES list."""
    return ", ".join("({}, '{}')".format(code, text.replace("'", "''")) for code, text in values.items())


def lookup_frame(spark: SparkSession, values: Mapping[int, str], code: str = "code", text: str = "text") -> DataFrame:
    """A lookup as an inline table.

    Spark knows the exact size of an inline table and so decides by itself to
    broadcast it; a large lookup from storage goes through the usual join choice.
    """
    return spark.sql(f"SELECT * FROM VALUES {lookup_values(values)} AS t({code}, {text})")
