"""Where the library may write intermediate tables."""

from __future__ import annotations

import atexit
import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_made: dict[str, SparkSession] = {}
_CHECKPOINT_KEY = "spark.checkpoint.dir"
# Rows of a few narrow columns: some megabytes at most.
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. A session on one machine that names none, as
    in tests, gets a folder in its warehouse.
    """
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(
        _CHECKPOINT_KEY, None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder all executors can reach")
    made = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    spark.conf.set(_CHECKPOINT_KEY, made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, deleted when the program ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made[path] = spark
    return path


def delete_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of a session, once its results are written elsewhere."""
    context = spark.sparkContext
    for path in [p for p, s in _made.items() if s is spark]:
        del _made[path]
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _delete_all() -> None:
    for spark in {id(s): s for s in _made.values()}.values():
        try:
            delete_scratch(spark)
        except Exception:  # the session may be gone already; nothing more can be done
            continue


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Iterative fits read the written table, so a lost executor costs one
    re-read and not a recomputation of everything before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_checked(
    df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "inner", limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Join a large table to a derived one that is usually tiny.

    The derived side is written and counted first. Up to ``limit`` rows it is broadcast,
    so the large side does not move; beyond, Spark joins by shuffle and splits hot keys.
    """
    stored = cut_lineage(side, "side")
    small = stored.count() <= limit
    return df.join(F.broadcast(stored) if small else stored, list(on), how)
