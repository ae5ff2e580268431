"""Checks of candidate and match lists against what they should hold; only counts and a few samples reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import has_target_prefix

_CHECKS = {
    "columns": "{n} lines have more than two columns",
    "empty_id": "{n} lines have no Source 1 ID",
    "duplicate_id": "{n} Source 1 IDs occur more than once",
    "duplicate_target": "{n} lines name a target twice",
    "bad_prefix": "{n} target IDs have a wrong prefix",
    "unknown_target": "{n} target IDs are unknown",
    "missing": "Missing {n} expected Source 1 IDs",
    "unexpected": "{n} unexpected Source 1 IDs",
    "not_candidate": "{n} matches are not among the candidates",
}


def violations(lists: DataFrame, expected: DataFrame, candidates: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """check, n, sample: one row for each check, by counting; ``sample`` is the smallest offender.

    ``lists`` has s1_id, raw (an array of identifiers as they stand) and n_columns; ``expected`` and ``known`` have
    entity_id; ``candidates`` has s1_id and ids.
    """
    each = lists.where("s1_id != ''").select("s1_id", F.explode("raw").alias("t"))
    found = {
        "columns": lists.where("n_columns > 2").select(F.col("s1_id").alias("x")),
        "empty_id": lists.where("s1_id = ''").select(F.lit("").alias("x")),
        "duplicate_id": lists.where("s1_id != ''").groupBy("s1_id").count().where("count > 1").select(F.col("s1_id").alias("x")),
        "duplicate_target": lists.where(F.size(F.array_distinct("raw")) < F.size("raw")).select(F.col("s1_id").alias("x")),
        "bad_prefix": each.where(~has_target_prefix(F.col("t"))).select(F.col("t").alias("x")),
        "missing": expected.select("entity_id").distinct().join(lists.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_anti").select(F.col("entity_id").alias("x")),
        "unexpected": lists.where("s1_id != ''").select(F.col("s1_id").alias("entity_id")).distinct().join(expected, "entity_id", "left_anti").select(F.col("entity_id").alias("x")),
    }
    if known is not None:
        found["unknown_target"] = each.where(has_target_prefix(F.col("t"))).join(known.select(F.col("entity_id").alias("t")), "t", "left_anti").select(F.col("t").alias("x"))
    if candidates is not None:
        pairs = candidates.select("s1_id", F.explode("ids").alias("t"))
        found["not_candidate"] = each.join(pairs, ["s1_id", "t"], "left_anti").select(F.concat_ws(" ", "s1_id", "t").alias("x"))
    out = None
    for check, rows in found.items():
        row = rows.agg(F.count("*").alias("n"), F.min("x").alias("sample")).select(F.lit(check).alias("check"), "n", "sample")
        out = row if out is None else out.unionByName(row)
    return out


def read_lists(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """The header and the lines (s1_id, raw, n_columns) of a tab-separated file with two columns."""
    lines = spark.read.text(path)
    head = lines.first()
    header = head["value"].split("\t") if head else []
    part = F.split("value", "\t")
    raw = F.filter(F.transform(F.split(F.coalesce(F.get(part, F.lit(1)), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    body = lines.where(F.col("value") != F.lit(head["value"] if head else "")).select(F.trim(F.get(part, F.lit(0))).alias("s1_id"), raw.alias("raw"), F.size(part).alias("n_columns"))
    return header, body


def validate_file(spark: SparkSession, path: str, expected: DataFrame, column: str = "matched_entity_ids", candidate_path: str | None = None, known: DataFrame | None = None) -> tuple[bool, list[str]]:
    """Whether a file is right, and what is wrong with it."""
    header, lists = read_lists(spark, path)
    errors = [] if header == ["source1_entity_id", column] else [f"Header is {header}, not {['source1_entity_id', column]}"]
    candidates = read_lists(spark, candidate_path)[1].select("s1_id", F.col("raw").alias("ids")) if candidate_path else None
    for row in violations(lists, expected, candidates, known).collect():
        if row["n"]:
            errors.append(_CHECKS[row["check"]].format(n=row["n"]) + (f" (first: {row['sample']})" if row["sample"] else ""))
    return not errors, errors


def candidate_report(lists: DataFrame, expected: DataFrame) -> DataFrame:
    """One row of counts over candidate lists: rows, duplicates, missing, unexpected, bad identifiers."""
    v = violations(lists, expected)
    counts = v.groupBy().pivot("check", list(c for c in _CHECKS if c not in ("unknown_target", "not_candidate"))).agg(F.first("n"))
    return counts.withColumn("_k", F.lit(1)).join(lists.agg(F.count("*").alias("rows")).withColumn("_k", F.lit(1)), "_k").drop("_k")
