"""Deterministic samples, splits, shards and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import id_hash
from .stored import written


def numbered(df: DataFrame, order: list, name: str = "place") -> DataFrame:
    """``df`` with its place (from 0) in a total order, without bringing all rows to one task.

    Rows are range-partitioned by the order; each partition's size is counted, and a row's place is
    its place in the partition plus the sizes before.  The sizes are one number a partition.  The dealt
    rows are written, so that both steps see the same cuts even if an executor is lost in between.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt = dealt.withColumn("_part", F.shiftright("_at", 33)).withColumn("_in", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    dealt = written(dealt, "dealt")
    sizes = dealt.groupBy("_part").agg((F.max("_in") + 1).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return dealt.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_in")).drop("_at", "_part", "_in", "_before")


def hash_sample(df: DataFrame, size: int, seed: int = 42, ids: DataFrame | None = None) -> DataFrame:
    """The ``size`` rows with the smallest hashes of seed and entity_id, of those in ``ids`` (a column entity_id) if given.

    Each task keeps its own smallest ``size`` rows, and these are merged.
    """
    if ids is not None:
        df = df.join(ids.select("entity_id").distinct(), "entity_id", "left_semi")
    return df.orderBy(id_hash(F.col("entity_id"), seed), "entity_id").limit(size)


def scan_and_sample(df: DataFrame, scan_rows: int, size: int, seed: int = 42, ids: DataFrame | None = None) -> tuple[DataFrame, int]:
    """hash_sample of the first ``scan_rows`` rows by ``ord``, and how many rows were scanned."""
    window = df.orderBy("ord", "entity_id").limit(scan_rows)
    scanned = window.count()
    if ids is not None and not window.join(ids.select("entity_id").distinct(), "entity_id", "left_semi").limit(1).count():
        raise ValueError(f"No validation S1 IDs were found in the first {scan_rows} rows; raise --pilot-scan-rows")
    return hash_sample(window, size, seed, ids), scanned


def entity_splits(ids: DataFrame, ratios: tuple[float, float, float] = (0.70, 0.15, 0.15), seed: int = 42) -> DataFrame:
    """entity_id, split ("train", "calibration" or "validation"): by the order of hashes, each part of int(n * ratio), the rest in the last."""
    if abs(sum(ratios) - 1) > 1e-9:
        raise ValueError("ratios must sum to 1")
    distinct = ids.select("entity_id").where("entity_id is not null").distinct()
    n = distinct.count()
    a = int(n * ratios[0])
    b = a + int(n * ratios[1])
    at = numbered(distinct.withColumn("_h", id_hash(F.col("entity_id"), seed)), ["_h", "entity_id"])
    split = F.when(F.col("place") < a, "train").when(F.col("place") < b, "calibration").otherwise("validation")
    return at.select("entity_id", split.alias("split"))


def split_summary(splits: DataFrame) -> DataFrame:
    """split, n, first_ids: how many, and the five smallest ids, comma-joined."""
    five = F.row_number().over(Window.partitionBy("split").orderBy("entity_id"))
    first = splits.withColumn("_r", five).where("_r <= 5").groupBy("split").agg(F.array_join(F.array_sort(F.collect_list("entity_id")), ",").alias("first_ids"))
    return splits.groupBy("split").agg(F.count("*").alias("n")).join(first, "split")


def assign_shards(targets: DataFrame, shard_size: int = 2_000_000) -> DataFrame:
    """``targets`` with shard_id: ``shard_size`` rows each in the order of ``ord`` and entity_id."""
    return numbered(targets, ["ord", "entity_id"]).withColumn("shard_id", F.floor(F.col("place") / shard_size).cast("int")).drop("place")


def assign_batches(queries: DataFrame, batch_size: int = 25_000, ids: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """``queries`` (those in ``ids``, the first ``limit`` of them) with batch_id: ``batch_size`` rows each, in the order of s1_id."""
    if ids is not None:
        queries = queries.join(ids.select(F.col("entity_id").alias("s1_id")).distinct(), "s1_id", "left_semi")
    at = numbered(queries, ["s1_id"])
    at = at.where(F.col("place") < limit) if limit else at
    return at.withColumn("batch_id", F.floor(F.col("place") / batch_size).cast("int")).drop("place")
