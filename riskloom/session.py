"""Session helpers: building a local session and finding shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of a generated method: Spark's default limit, and what HotSpot still compiles.
SPARK_METHOD_LIMIT, COMPILED_METHOD_LIMIT = "65535", "8000"


def build_session(app_name: str = "riskloom", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the library is tested with.

    On a cluster leave ``master`` unset and size ``spark.sql.shuffle.partitions``
    there; adaptive execution then merges small partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without that setting a fresh temporary folder serves local sessions only: on
    a cluster other machines could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="riskloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; no two calls give the same one."""
    return f"{shared_dir(spark).rstrip('/')}/riskloom/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` and the tree learners' checkpoints usable."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def keep_methods_compiled(spark: SparkSession) -> None:
    """Let Spark generate no method that the JVM would only interpret, unless the session has a limit of its own.

    HotSpot compiles no method above 8,000 bytes. Cleaning, the check for missing features and the assembler in one
    whole-stage method are beyond that; without whole-stage generation Spark splits them. Results are the same.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit) == SPARK_METHOD_LIMIT:
        spark.conf.set(limit, COMPILED_METHOD_LIMIT)


def local_frame(spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: T.StructType) -> DataFrame:
    """A few rows held on the driver (a report) as a DataFrame; absent fields are NULL.

    Arrow makes a local relation of them, which needs no Python worker to read.
    """
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), schema=to_arrow_schema(schema)), schema)
