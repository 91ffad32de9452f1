"""Staged tables: cut lineage by writing Parquet to storage every executor can reach.

The folder is the one the cluster names in ``spark.checkpoint.dir``. A private
temporary folder is used only when Spark itself runs in local mode and names none.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCK = threading.Lock()
_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Root of this application's staged data."""
    app = spark.sparkContext.applicationId
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/tillwise/{app}"
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    with _LOCK:
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tillwise-")
        return f"{_LOCAL_DIRS[app]}/{app}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    then: Callable[[DataFrame], DataFrame] = lambda df: df,
    rebalance: bool = True,
) -> DataFrame:
    """Write ``df`` once and read it back.

    With ``partition_by`` the rows are first rebalanced on those columns: adaptive
    execution splits an oversized value over several writers and merges tiny ones,
    so neither a hot month nor eighty small ones decide the file layout. ``then`` adds
    columns as rows are written, so that they are not shuffled. Without ``rebalance`` rows are
    written where they are: for those dealt by ranges that begin with these columns.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    out = df
    if partition_by and rebalance:
        out = df.hint("rebalance", *[F.col(c) for c in partition_by])
    out = then(out)
    writer = out.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(out.schema).parquet(path).select(*out.columns)
