"""Built-in column expressions; none of them needs a Python worker."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.schemas import RISK_BANDS, UNKNOWN


def require_columns(df: DataFrame, columns: Iterable[str], step: str) -> None:
    """Name what is missing up front, before Spark reports an unresolved column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{step} needs the columns {missing}, which the input lacks")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is NULL."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def null_if(column: str, sentinel: str) -> Column:
    return F.nullif(F.col(column), F.lit(sentinel)).alias(column)


def keep_or_default(column: str, allowed: Sequence[str], default: str = UNKNOWN) -> Column:
    """The value if allowed, else the default; NULL gives the default."""
    return F.when(F.col(column).isin(*allowed), F.col(column)).otherwise(F.lit(default))


def lookup_map(values: Mapping[object, object]) -> Column:
    """A literal map; Spark folds it to a constant."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def code_group(column: str, groups: Mapping[str, Sequence[int]], default: str) -> Column:
    """Group name of a code; codes outside all groups and NULL give the default."""
    by_code = {code: name for name, codes in groups.items() for code in codes}
    return F.coalesce(lookup_map(by_code)[F.col(column)], F.lit(default))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, 0 where the divisor is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(safe_ratio(part, whole) * 100, digits)


def positive_probability(vector: str | Column = "probability") -> Column:
    """Probability of class 1 out of a class-probability vector; NULL stays NULL."""
    return vector_to_array(F.col(vector) if isinstance(vector, str) else vector)[1]


def risk_band(score: str | Column, bands: Sequence[tuple[float | None, str]] = RISK_BANDS) -> Column:
    """Name of the half-open band a score falls in; NULL stays NULL."""
    value = F.col(score) if isinstance(score, str) else score
    band = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, name in bands:
        if upper is None:
            return band.otherwise(F.lit(name))
        band = band.when(value < upper, F.lit(name))
    return band
