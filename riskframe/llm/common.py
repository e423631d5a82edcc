"""Small things several operators share."""

from __future__ import annotations

import atexit
import ctypes
import gc
import uuid
from collections.abc import Sequence

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.session import shared_dir

_made: dict[str, SparkSession] = {}


def store(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Later jobs read files instead of recomputing, whatever executors were lost meanwhile. The
    folder goes when ``discard`` is called, or at the latest when the program ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    _made[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for table in tables:
        _delete(table._stored_at)


def _delete(path: str) -> None:
    spark = _made.pop(path, None)
    if spark is None or spark.sparkContext._jsc is None:
        return
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _delete_all() -> None:
    for path in list(_made):
        try:
            _delete(path)
        except Exception:  # the session may be gone already; nothing more can be done
            return


def release_memory() -> None:
    """Give a Python worker's free memory back to the system; Spark keeps workers for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        return


def free_finished(spark: SparkSession) -> None:
    """Let go of what finished jobs hold: memory of the driver, and shuffle files on the executors, which
    Spark deletes only when the driver's garbage collection finds their plans unused.

    The driver's C library keeps what its compilers and hundreds of short-lived threads gave back, too,
    some 200 MB after a join; the JVM can return that to the system.
    """
    release_memory()
    jvm = spark.sparkContext._jvm
    jvm.System.gc()
    beans = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    # By the interface: the class of ``beans`` is not open to calls from outside its module.
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    arguments = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
    arguments[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    arguments[1] = "systemTrimNativeHeap"
    try:
        invoke.invoke(beans, arguments)
    except Py4JJavaError:  # a JVM without that command
        return


def crc32_text(column: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes, as a long."""
    return F.crc32(column.cast("binary"))


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """True for rows whose crc32(id as text) is divisible by ``folds``; null ids are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(True))


def class_sample(
    df: DataFrame, id_col: str, label_col: str, text_col: str, rows: int, least: int, seed: int = 17
) -> DataFrame:
    """At most ``rows`` rows with an id and a label, always the same ones: up to ``least`` of every
    label first, in turns, then those with the smallest hashed ids.

    Of rows that share an id the ones with the least label count, and of these the one with the least
    hashed text. Ids and labels alone are ranked, so texts do not move for it, and each task passes on
    no more than ``rows`` of a label; the rows come by a join with at most ``rows`` ids.
    """
    keyed = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    ids = keyed.groupBy(F.col(id_col).alias("__id")).agg(F.min(F.col(label_col)).alias("__label"))
    ids = ids.withColumn("order", F.xxhash64(F.col("__id"), F.lit(seed)))
    rank = F.row_number().over(Window.partitionBy("__label").orderBy("order", "__id"))
    ranked = ids.withColumn("rank", rank).where(F.col("rank") <= rows)
    chosen = ranked.orderBy(F.least("rank", F.lit(least + 1)), "order", "__id").limit(rows)
    # ``rows`` bounds the broadcast side.
    chosen = F.broadcast(chosen.select("__id", "__label"))
    # By id alone first: that join reaches below the one that brought the labels.
    found = df.join(chosen.select("__id"), F.col(id_col) == F.col("__id"), "left_semi")
    found = found.join(chosen, (F.col(id_col) == F.col("__id")) & (F.col(label_col) == F.col("__label")), "left_semi")
    return found.groupBy(id_col).agg(F.min_by(F.struct(*df.columns), F.xxhash64(text_col)).alias("__row")).select("__row.*")


# What a derived side of a join may hold when it is broadcast.
BROADCAST_BYTES = 16 << 20


def small_side(stored: DataFrame, size: Column) -> DataFrame:
    """A stored side of a join, broadcast if its rows have at most BROADCAST_BYTES together (``size``
    is that of a row); beyond, Spark joins by shuffle."""
    total = stored.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(stored) if total <= BROADCAST_BYTES else stored


def passages(text: Column, characters: int, pieces: int = 8) -> Column:
    """A text, or of a longer one evenly spaced passages of ``characters`` in all."""
    n, size = F.char_length(text), characters // pieces
    at = [F.floor(n * k / pieces).cast("int") + 1 for k in range(pieces)]
    return F.when(n > characters, F.concat_ws(" ", *[F.substring(text, a, F.lit(size)) for a in at])).otherwise(text)
