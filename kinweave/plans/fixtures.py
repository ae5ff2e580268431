"""Business entities derived from the test tables' documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_text, with_normalized


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, source, ord, business_name, business_address, country, and their normalised forms, of each document; two fifths of the names say what kind of firm it is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    part = F.split(normalize_text(F.col("text")), " ", 10)  # the first nine words, and the rest as one
    got = docs.select("doc_id", "lang", "n_chars", part.alias("t"))
    kind = F.col("doc_id") % 3 + 1
    firm = F.when(F.col("doc_id") % 5 == 0, ", LLC.").when(F.col("doc_id") % 5 == 3, " (Holdings)").otherwise("")
    got = got.select(
        F.concat(F.lit("S"), kind, F.lit("-"), "doc_id").alias("entity_id"), F.concat(F.lit("source"), kind).alias("source"), F.col("doc_id").alias("ord"),
        F.concat(F.array_join(F.slice("t", 1, 5), " "), firm).alias("business_name"),
        F.trim(F.concat_ws(" ", (F.col("n_chars") % 97).cast("string"), F.array_join(F.slice("t", 6, 4), " "))).alias("business_address"),
        F.col("lang").alias("country"),
    )
    return with_normalized(got)


def queries_and_targets(spark: SparkSession, sf_dir: str, n_shards: int = 1, every: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Source 1 with s1_id; sources 2 and 3 with shard_id.  ``every`` are the entities, if they are written already."""
    every = entities(spark, sf_dir) if every is None else every
    s1 = every.where("source = 'source1'").withColumnRenamed("entity_id", "s1_id")
    return s1, every.where("source != 'source1'").withColumn("shard_id", (F.col("ord") % n_shards).cast("int"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s1_id, ids: targets whose whole normalised text is equal."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kind = F.col("doc_id") % 3 + 1
    each = docs.select(F.concat(F.lit("S"), kind, F.lit("-"), "doc_id").alias("entity_id"), kind.alias("kind"), F.md5(normalize_text(F.col("text")).cast("binary")).alias("m"))
    ids = F.array_sort(F.collect_set(F.when(F.col("kind") > 1, F.col("entity_id"))))
    both = each.groupBy("m").agg(F.collect_list(F.when(F.col("kind") == 1, F.col("entity_id"))).alias("s1"), ids.alias("ids"))
    return both.select(F.explode("s1").alias("s1_id"), "ids")
