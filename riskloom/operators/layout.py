"""How rows are dealt to tasks for work that passes over them many times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a training table that one task works on in each pass of a fit, until there are ``ENOUGH_TASKS``.
ROWS_PER_TASK = 12_500
#: From so many tasks on, tasks get more rows instead, up to ``MOST_ROWS``: each task of a pass over a forest
#: sends the statistics of all open nodes, and each task of the thousands of passes of a fit its result to the driver.
ENOUGH_TASKS = 48
#: Rows of a training table that one task keeps in memory at most.
MOST_ROWS = 500_000
#: Beyond so many tasks a pass only gets more overhead, whatever the rows.
MOST_TASKS = 20_000


def task_count(rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """A number of tasks that depends on the number of rows alone."""
    wanted = -(-rows // rows_per_task)
    if wanted > ENOUGH_TASKS:
        wanted = max(ENOUGH_TASKS, -(-rows // max(rows_per_task, MOST_ROWS)))
    return max(1, min(MOST_TASKS, wanted))


def dealt(df: DataFrame, columns: Sequence[str], rows: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows in tasks of about equal size, the same whatever files they came from.

    A row's task and its place there follow from a hash of ``columns``, so that
    learners which draw rows by task and place draw the same ones again, on any
    cluster and after a lost executor. With a unique key among the columns no task
    gets more than its share; rows alike in all columns share a task. One shuffle.
    """
    key = "_dealt"
    placed = df.withColumn(key, F.xxhash64(*columns)).repartition(task_count(rows, rows_per_task), key)
    return placed.sortWithinPartitions(key, *columns).drop(key)
