"""Profiles of sources, truth and normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_profile(df: DataFrame, prefix: str) -> DataFrame:
    """One row: rows, nulls of each column, distinct and duplicate ids, ids without ``prefix``, missing countries."""
    columns = ("entity_id", "business_name", "business_address", "country")
    blank = [F.count_if(F.col(c).isNull() | (F.col(c) == "")).alias(f"missing_{c}") for c in columns]
    got = df.agg(F.count("*").alias("rows"), F.countDistinct("entity_id").alias("ids"), F.count_if(~F.col("entity_id").startswith(prefix)).alias("odd_prefix"), *blank)
    return got.withColumn("duplicates", F.col("rows") - F.col("ids"))


def country_counts(df: DataFrame) -> DataFrame:
    """country, n; a null or empty country is "<MISSING>"."""
    c = F.when(F.col("country").isNull() | (F.col("country") == ""), "<MISSING>").otherwise(F.col("country"))
    return df.groupBy(c.alias("country")).agg(F.count("*").alias("n"))


def truth_profile(truth: DataFrame) -> DataFrame:
    """One row: entities, those with and without matches, matches, distinct entities."""
    n = F.size("ids")
    return truth.agg(
        F.count("*").alias("rows"), F.countDistinct("s1_id").alias("ids"), F.count_if(n == 0).alias("empty"),
        F.count_if(n > 0).alias("non_empty"), F.sum(n).alias("matches"),
    )


def normalization_profile(df: DataFrame) -> DataFrame:
    """One row: names, addresses and countries that are missing before and after normalisation."""
    out = []
    for c in ("business_name", "business_address", "country"):
        out += [F.count_if(F.col(c).isNull() | (F.col(c) == "")).alias(f"{c}_before"), F.count_if(F.col(f"{c}_norm") == "").alias(f"{c}_after")]
    return df.agg(F.count("*").alias("rows"), *out)


def row_size(df: DataFrame) -> DataFrame:
    """One row: mean and 90th percentile of a row's bytes as tab-separated text, and the larger of the mean and a quarter and the latter."""
    n = F.octet_length(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])) + 1
    got = df.select(n.alias("n")).agg(F.avg("n").alias("mean_bytes"), F.percentile("n", F.lit(0.9)).alias("p90_bytes"))
    return got.withColumn("row_bytes", F.greatest(F.col("mean_bytes") * 1.25, "p90_bytes"))
