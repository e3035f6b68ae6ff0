"""Contiguous shards of near equal byte size, by global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muster.llm.tables import stored, table

ROW_OVERHEAD = 8
SHARDS = 24


def _running(rows: DataFrame, totals: DataFrame, part: str, order: list[str]) -> DataFrame:
    """Adds the bytes and rows before a row in the global order, and the bytes of all rows."""
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition: this window's size does not follow the number of rows.
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        part,
        F.coalesce(F.sum("part_bytes").over(ahead), F.lit(0)).alias("bytes_ahead"),
        F.coalesce(F.sum("part_rows").over(ahead), F.lit(0)).alias("rows_ahead"),
        F.sum("part_bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    local = rows.select(
        "*",
        F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("bytes_inside"),
        F.row_number().over(Window.partitionBy(part).orderBy(*order)).alias("row_inside"),
    )
    return local.join(F.broadcast(offsets), part).select(
        *rows.columns,
        (F.col("bytes_ahead") + F.col("bytes_inside")).alias("before"),
        (F.col("rows_ahead") + F.col("row_inside") - 1).alias("position"),
        "all_bytes",
    )


def shard(documents: DataFrame, shards: int = SHARDS, partitions: int | None = None) -> DataFrame:
    """Shard and slot of every document, law ``bytes``.

    Documents are ranged by ``doc_id`` (null first; then by text checksum and size). With ``before``
    the bytes of all documents ahead of one, its shard is the one in which its middle byte falls when
    all bytes are cut into ``shards`` equal pieces: shards are contiguous in ``doc_id`` and differ in
    size from the target by at most one document. ``slot`` numbers the documents of a shard from 0.

    Only (doc_id, size, checksum, place of the row) is shuffled. The rows are ranged once and stored with the number of
    their range partition, so that totals and running sums see the same partitions; the totals, one
    row per range partition, and the first positions, one row per shard, are broadcast.

    Null text: no bytes (size 8) and checksum 0. A very long text is one document of its size, and may make
    its shard larger than the target. Empty table: no rows. Repeated rows: each gets its
    own slot. A shard stays empty if no document's middle byte falls into it. Extra columns are not
    read, whatever their names.
    """
    spark = documents.sparkSession
    # Rows equal in all that counts are told apart by their place, so that ranges can part them.
    order = ["doc_id", "text_crc32", "size", "place"]
    count = partitions or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    slim = documents.select(
        F.col("doc_id"),
        (F.length(text).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("place"),
    )
    ranged = stored(
        slim.repartitionByRange(count, *order).select("*", F.spark_partition_id().alias("part")),
        "shard-ranges",
    )
    totals = ranged.groupBy("part").agg(
        F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows")
    )
    placed = _running(ranged, totals, "part", order)
    # Twice the middle byte over twice the total keeps the cut in whole numbers.
    cut = F.expr(f"((2 * before + size) * {shards}) div (2 * all_bytes)")
    sharded = stored(placed.withColumn("shard", cut.cast("int")), "shards")
    firsts = sharded.groupBy("shard").agg(F.min("position").alias("first"))
    return sharded.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 23."""
    return shard(table(spark, folder, "documents"))


