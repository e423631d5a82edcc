"""Contiguous shards of nearly equal bytes, cut from global prefix sums.

Rows are ordered by (crc32 of the text, id), so equal texts lie side by side, and the order is cut
into ranges. Every range reports its total bytes and rows; prefix sums over these totals (one row
per range) turn running sums inside a range into global positions. A row goes to the shard in
which the middle of its bytes falls, so shard sizes differ from the target by less than one row.

A text that a third of all rows share is spread over many ranges by its ids; rows that agree in
both are spread by their place in the input. No task sees more than its range.

Defined results: null text has size 1 and crc32 0. Null ids sort first. Repeated rows take places
next to each other. An empty table gives an empty table. Only id and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import crc32_text, store


def shard_by_bytes(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shards: int = 8, ranges: int | None = None
) -> DataFrame:
    """Per row: id, size, text_crc32, law, shard, slot (its rank in the shard), grown_shard (null)."""
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(crc32_text(F.col(text_col)), F.lit(0).cast("bigint")).alias("crc"),
    ).withColumn("tie", F.monotonically_increasing_id())
    # Stored twice, without texts: ranges are sampled from the same rows that are then dealt out,
    # and totals, positions and shards all read the same ranges.
    rows = store(rows, "sizes")
    order = ["crc", "id", "tie"]
    ranged = store(rows.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "ranges")

    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    totals = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    inside = Window.partitionBy("range").orderBy(*order)
    shard = F.expr(f"cast((2 * (bytes_before + running) - size) * {shards} div (2 * all_bytes) as int)")
    placed = (
        ranged.withColumns({"running": F.sum("size").over(inside), "rank": F.row_number().over(inside)})
        .join(F.broadcast(totals), "range")  # one row per range
        .withColumn("place", F.col("rows_before") + F.col("rank") - 1)
        .withColumn("shard", F.least(shard, F.lit(shards - 1)))
    )
    first = placed.groupBy("shard").agg(F.min("place").alias("first_place"))
    return placed.join(F.broadcast(first), "shard").select(  # one row per shard
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first_place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
