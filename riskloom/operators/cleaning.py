"""Cleaning: sentinels, missing-rate profile, fills, exclusions, decoding."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import flag, keep_or_default, null_if, percent
from riskloom.operators.ranking import exact_quantiles
from riskloom.schemas import (
    CATEGORY_FILL_COLUMNS,
    EXCLUDED_DISCHARGES,
    GENDERS,
    LABEL,
    MEDIAN_FILL_COLUMNS,
    MISSING_INDICATOR,
    MISSING_THRESHOLD,
    POSITIVE_OUTCOME,
    UNKNOWN,
)


# Rank error of approximate medians is 1 / accuracy. Each task sends a sketch of about
# this many values per column, so a finer one costs more where there are many tasks.
MEDIAN_ACCURACY = 200


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def replace_missing_indicators(df: DataFrame, indicator: str = MISSING_INDICATOR) -> DataFrame:
    """NULL for the sentinel, in every string column; other types cannot hold it."""
    text = set(string_columns(df))
    return df.select(*[null_if(c, indicator) if c in text else F.col(c) for c in df.columns])


def create_target_variable(
    df: DataFrame, outcome: str = "readmitted", positive: str = POSITIVE_OUTCOME, label: str = LABEL
) -> DataFrame:
    """Add the 0/1 label; a NULL outcome is 0."""
    return df.withColumn(label, flag(F.col(outcome) == positive))


def remove_invalid_records(
    df: DataFrame,
    exclude_ids: Sequence[int] = EXCLUDED_DISCHARGES,
    column: str = "discharge_disposition_id",
) -> DataFrame:
    """Keep rows whose code is known and not excluded; a NULL code is removed too."""
    return df.filter(~F.col(column).isin(*exclude_ids))


def exclusion_report(
    df: DataFrame,
    exclude_ids: Sequence[int] = EXCLUDED_DISCHARGES,
    column: str = "discharge_disposition_id",
) -> DataFrame:
    """One row: rows before, kept, removed and the removed share in percent."""
    kept = F.count_if(~F.col(column).isin(*exclude_ids))
    counts = df.agg(F.count(F.lit(1)).alias("rows_before"), kept.alias("rows_kept"))
    removed = F.col("rows_before") - F.col("rows_kept")
    return counts.select(
        "rows_before", "rows_kept", removed.alias("rows_removed"),
        percent(removed, F.col("rows_before")).alias("removed_pct"),
    )


def clean_category(
    df: DataFrame, column: str, allowed: Sequence[str], default: str = UNKNOWN
) -> DataFrame:
    return df.withColumn(column, keep_or_default(column, allowed, default))


def clean_gender_column(df: DataFrame) -> DataFrame:
    return clean_category(df, "gender", GENDERS)


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: NULLs, rows and missing percentage, from a single pass."""
    columns = list(columns) if columns is not None else df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(columns)],
    )
    per_column = F.explode(
        F.array(*[
            F.struct(F.lit(c).alias("column_name"), (F.col("_rows") - F.col(f"_c{i}")).alias("null_count"))
            for i, c in enumerate(columns)
        ])
    )
    return counts.select("_rows", per_column.alias("_p")).select(
        "_p.column_name",
        "_p.null_count",
        F.col("_rows").alias("n_rows"),
        F.try_divide(F.col("_p.null_count") * F.lit(100.0), F.col("_rows")).alias("missing_pct"),
    )


def identify_high_missing_columns(df: DataFrame, threshold: float = MISSING_THRESHOLD) -> list[str]:
    """Columns with more than ``threshold`` percent NULLs; none for an empty table."""
    over = missing_profile(df).filter(F.col("missing_pct") > threshold)
    found = {row["column_name"] for row in over.select("column_name").collect()}
    return [c for c in df.columns if c in found]


def drop_high_missing_columns(
    df: DataFrame, threshold: float = MISSING_THRESHOLD, protect: Collection[str] = ()
) -> DataFrame:
    """Drop the columns found above, except the protected ones."""
    return df.drop(*[c for c in identify_high_missing_columns(df, threshold) if c not in set(protect)])


def fill_categories(
    df: DataFrame, columns: Sequence[str] = CATEGORY_FILL_COLUMNS, value: str = UNKNOWN
) -> DataFrame:
    """Fill NULL categories, in the listed columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.fillna(value, subset=present) if present else df


def counts_and_medians(
    df: DataFrame,
    count_columns: Sequence[str],
    median_columns: Sequence[str],
    exact: bool = False,
    accuracy: int = MEDIAN_ACCURACY,
) -> tuple[int, dict[str, int], dict[str, float]]:
    """Rows, NULLs per column, and the median of every number column, with NULLs or without.

    Counts and approximate medians come from one pass; such a median is a value of
    the column whose rank is off by at most 1/accuracy of the rows. Exact medians
    interpolate between the two middle values and are ranked in a second step. A
    column without any value has no median.
    """
    per_median = [] if exact else [
        F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(f"_m_{c}") for c in median_columns
    ]
    columns = list(dict.fromkeys([*count_columns, *median_columns]))
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_c_{c}") for c in columns], *per_median).first()
    nulls = {c: row["_rows"] - row[f"_c_{c}"] for c in columns}
    if exact:
        medians = exact_medians(df, median_columns) if median_columns else {}
    else:
        medians = {c: row[f"_m_{c}"] for c in median_columns}
    return row["_rows"], nulls, {c: v for c, v in medians.items() if v is not None}


def exact_medians(
    df: DataFrame, columns: Sequence[str], cuts: Sequence[float] | None = None
) -> dict[str, float]:
    """Exact median per column; all columns are ranked together.

    Pass no cuts (``[]``) where columns are known to have few distinct values: this
    saves the pass that looks for cut points.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    rows = exact_quantiles(long, ["column_name"], "value", {"median": 0.5}, cuts).collect()
    return {row["column_name"]: row["median"] for row in rows}


def approx_medians(df: DataFrame, columns: Sequence[str], relative_error: float = 0.01) -> dict[str, float]:
    """Approximate median per column that has values, in one pass for all columns."""
    found = df.approxQuantile(list(columns), [0.5], relative_error)
    return {c: values[0] for c, values in zip(columns, found) if values}


def fill_values(df: DataFrame, values: Mapping[str, float], keep_type: bool = False) -> DataFrame:
    """Fill NULL numbers. A filled column becomes double unless ``keep_type``."""
    types = dict(df.dtypes)
    filled = {}
    for column, value in values.items():
        result = F.coalesce(F.col(column).cast("double"), F.lit(float(value)))
        filled[column] = result.cast(types[column]) if keep_type else result
    return df.withColumns(filled) if filled else df


def fill_medians(
    df: DataFrame,
    columns: Sequence[str] = MEDIAN_FILL_COLUMNS,
    exact: bool = False,
    keep_type: bool = False,
) -> DataFrame:
    """Fill NULL numbers with the median of their column, in the listed columns that exist."""
    present = [c for c in columns if c in df.columns]
    return fill_values(df, counts_and_medians(df, [], present, exact)[2], keep_type) if present else df


def fill_missing_values(df: DataFrame, exact: bool = False, keep_type: bool = False) -> DataFrame:
    """Category and median fills together."""
    return fill_medians(fill_categories(df), exact=exact, keep_type=keep_type)


def decode_codes(df: DataFrame, lookup: DataFrame, column: str, output: str) -> DataFrame:
    """Add the text of a code by a left join; an unknown code gives NULL.

    ``lookup`` has the columns ``code`` (unique) and ``text``.
    """
    renamed = lookup.select(F.col("code").alias("_code"), F.col("text").alias(output))
    return df.join(renamed, F.col(column) == F.col("_code"), "left").drop("_code")
