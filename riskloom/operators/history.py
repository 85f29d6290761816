"""Visit history per entity: counts in the past year, and what the next visit says.

A window over all visits of one entity would put a very frequent entity into one
task. Both operators therefore work on one row per entity and day, which is made
with partial aggregation and bounds an entity by the number of days in the data.
The result is joined back on entity and day, so that the visits of one entity stay
spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_number(at: str) -> Column:
    """Days since 1970-01-01."""
    return F.datediff(F.col(at), F.lit("1970-01-01").cast("date"))


def _on_days(df: DataFrame, entity: str, at: str, per_day: list[Column], over_days: Mapping[str, Column]) -> DataFrame:
    """Aggregate per entity and day, derive window columns, and attach them to the rows."""
    dated = df.withColumn("_day", day_number(at))
    days = dated.groupBy(F.col(entity).alias("_entity"), F.col("_day").alias("_on")).agg(*per_day)
    days = days.select("_entity", "_on", *[c.alias(name) for name, c in over_days.items()])
    same_day = F.col(entity).eqNullSafe(F.col("_entity")) & F.col("_day").eqNullSafe(F.col("_on"))
    return dated.join(days, same_day, "left").drop("_entity", "_on")


def _prior_counts(kinds: Mapping[str, Column], days: int) -> tuple[list[Column], dict[str, Column]]:
    past = Window.partitionBy("_entity").orderBy("_on").rangeBetween(-days, -1)
    per_day = [F.count_if(condition).alias(f"_n_{name}") for name, condition in kinds.items()]
    over = {name: F.coalesce(F.sum(f"_n_{name}").over(past), F.lit(0)).cast("int") for name in kinds}
    return per_day, over


def with_prior_visits(
    df: DataFrame,
    entity: str,
    at: str,
    kinds: Mapping[str, Column],
    days: int = 365,
) -> DataFrame:
    """Add per kind the number of visits of the same entity in the ``days`` days before.

    The visit's own day does not count. ``kinds`` maps a new column to the
    condition that a visit is of that kind.
    """
    per_day, over = _prior_counts(kinds, days)
    return _on_days(df, entity, at, per_day, over).drop("_day")


def _next_visit(at: str, row_key: str) -> tuple[list[Column], dict[str, Column]]:
    timeline = Window.partitionBy("_entity").orderBy("_on")
    per_day = [F.max(F.struct(at, row_key)).alias("_last")]
    over = {"_last_of_day": F.col("_last"), "_next_on": F.lead("_on").over(timeline)}
    return per_day, over


def _next_label(at: str, row_key: str, within: int) -> Column:
    """A later visit on the same day is 0 days away, else the next day with a visit counts."""
    gap = F.when(F.struct(at, row_key) < F.col("_last_of_day"), F.lit(0)).otherwise(
        F.col("_next_on") - F.col("_day")
    )
    return F.when(gap.isNull(), "NO").when(gap < within, f"<{within}").otherwise(f">{within}")


def with_next_visit_label(
    df: DataFrame,
    entity: str,
    at: str,
    row_key: str,
    column: str = "readmitted",
    within: int = 30,
) -> DataFrame:
    """Add ``<30`` / ``>30`` / ``NO``: days until the entity's next visit, in order of time and key."""
    per_day, over = _next_visit(at, row_key)
    labelled = _on_days(df, entity, at, per_day, over).withColumn(column, _next_label(at, row_key, within))
    return labelled.drop("_day", "_last_of_day", "_next_on")


def with_visit_history(
    df: DataFrame,
    entity: str,
    at: str,
    row_key: str,
    kinds: Mapping[str, Column],
    column: str = "readmitted",
    days: int = 365,
    within: int = 30,
) -> DataFrame:
    """Both of the above, with one aggregation and one join."""
    per_day, over = _prior_counts(kinds, days)
    more_per_day, more_over = _next_visit(at, row_key)
    both = _on_days(df, entity, at, per_day + more_per_day, over | more_over).withColumn(column, _next_label(at, row_key, within))
    return both.drop("_day", "_last_of_day", "_next_on")
