"""Tab-separated sources and sinks.

Only the empty field is null; "NA" and "null" are text.  Quotes are doubled within quotes.
Addresses are never split at commas; identifier lists are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import parse_id_list, serialize_id_list

SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
TRUTH_COLUMNS = ["source1_entity_id", "matched_entity_ids"]
CANDIDATE_COLUMNS = ["source1_entity_id", "candidate_entity_ids"]


def read_tsv(spark: SparkSession, path: str, expected: list[str], n_rows: int | None = None) -> DataFrame:
    """The columns of a file with a header, as strings; a missing one is an error, more are kept."""
    reader = spark.read.option("sep", "\t").option("quote", '"').option("escape", '"')
    header = reader.option("header", True).csv(path).columns
    if missing := [c for c in expected if c not in header]:
        raise ValueError(f"{path} lacks the columns {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = reader.option("header", True).schema(schema).csv(path)
    return df.limit(n_rows) if n_rows is not None else df


def read_source(spark: SparkSession, path: str, source: str, n_rows: int | None = None) -> DataFrame:
    """A source file with its name in ``source`` and an order in ``ord``."""
    return read_tsv(spark, path, SOURCE_COLUMNS, n_rows).withColumn("source", F.lit(source)).withColumn("ord", F.concat_ws("|", F.lit(source), "entity_id"))


def read_truth(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    """s1_id, ids: the true matches, of the entities in ``ids`` if given."""
    got = read_tsv(spark, path, TRUTH_COLUMNS).select(F.col("source1_entity_id").alias("s1_id"), parse_id_list(F.col("matched_entity_ids")).alias("ids"))
    return got if ids is None else got.join(ids.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """entity_id: a text file's lines, trimmed, without blank ones."""
    return spark.read.text(path).select(F.trim("value").alias("entity_id")).where("entity_id != ''")


def training_data(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three sources and the truth of a folder."""
    return test_data(spark, folder) | {"ground_truth": read_truth(spark, f"{folder}/ground_truth.tsv")}


def test_data(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three sources of a folder."""
    return {s: read_source(spark, f"{folder}/{s}.tsv", s) for s in ("source1", "source2", "source3")}


def write_tsv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The columns of ``df`` with a header; Spark's commit makes the folder whole or absent."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"there are no columns {missing}")
    df.select(*columns).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


def write_id_map(queries: DataFrame, lists: DataFrame, path: str, column: str) -> None:
    """One line for each query (s1_id), in order, with its sorted list of ``lists`` (s1_id, ids), or nothing."""
    got = queries.select("s1_id").join(lists, "s1_id", "left").orderBy("s1_id")
    write_tsv(got.select(F.col("s1_id").alias("source1_entity_id"), serialize_id_list(F.coalesce("ids", F.array().cast("array<string>"))).alias(column)), path, ["source1_entity_id", column])


def write_splits(splits: DataFrame, folder: str) -> None:
    """A folder of sorted ids for each split, and a summary."""
    from ..operators.sampling import split_summary

    splits.repartition("split").sortWithinPartitions("split", "entity_id").write.mode("overwrite").partitionBy("split").text(f"{folder}/ids")
    split_summary(splits).write.mode("overwrite").json(f"{folder}/summary")


def write_summary(row: DataFrame, path: str) -> None:
    """A one-row report as JSON."""
    row.coalesce(1).write.mode("overwrite").json(path)
