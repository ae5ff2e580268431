"""Recall of candidates and F-measures of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stored import written


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def candidate_stats(queries: DataFrame, pairs: DataFrame, cap: int = 250) -> DataFrame:
    """One row: mean, median, p90, p95, p99 and max of candidates a query, and how many have none or the full number."""
    n = queries.select("s1_id").join(pairs.groupBy("s1_id").agg(F.count("*").alias("n")), "s1_id", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    row = n.agg(
        F.count("*").alias("queries"), F.avg("n").alias("mean"), F.percentile("n", F.array(*[F.lit(x) for x in (0.5, 0.9, 0.95, 0.99)])).alias("p"),
        F.max("n").cast("long").alias("most"), F.count_if(F.col("n") == 0).alias("empty"), F.count_if(F.col("n") >= cap).alias("full"),
    )
    p = [F.col("p")[i].alias(x) for i, x in enumerate(("median", "p90", "p95", "p99"))]
    return row.select("queries", "mean", *p, "most", "empty", _ratio(F.col("empty"), F.col("queries")).alias("empty_rate"), "full", _ratio(F.col("full"), F.col("queries")).alias("full_rate"))


def recall_metrics(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: true pairs and how many are candidates, in all and by source, and entities found in full.

    ``truth`` has s1_id and ids (an array).  Entities without true matches count in
    ``empty_truth`` and, if they have candidates, ``empty_truth_with_candidates``, and nowhere else.
    """
    want = truth.select("s1_id", F.explode("ids").alias("candidate_id"))
    hit = want.join(pairs.select("s1_id", "candidate_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "candidate_id"], "left")
    each = hit.groupBy("s1_id").agg(
        F.count("*").alias("n"), F.count("hit").alias("found"),
        *[F.count_if(F.col("candidate_id").startswith(p)).alias(f"n_{p[:2].lower()}") for p in ("S2-", "S3-")],
        *[F.count_if(F.col("candidate_id").startswith(p) & F.col("hit").isNotNull()).alias(f"found_{p[:2].lower()}") for p in ("S2-", "S3-")],
    )
    total = each.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "found", "n_s2", "found_s2", "n_s3", "found_s3")],
        F.count("*").alias("entities"), F.count_if(F.col("n") == F.col("found")).alias("full"),
    )
    empty = truth.where(F.size("ids") == 0).join(pairs.select("s1_id").distinct().withColumn("has", F.lit(1)), "s1_id", "left")
    empty = empty.agg(F.count("*").alias("empty_truth"), F.count("has").alias("empty_truth_with_candidates"))
    both = total.withColumn("_k", F.lit(1)).join(empty.withColumn("_k", F.lit(1)), "_k")
    return both.select(
        F.col("n").alias("total_pairs"), F.col("found").alias("found_pairs"), _ratio(F.col("found"), F.col("n")).alias("pair_recall"),
        _ratio(F.col("found_s2"), F.col("n_s2")).alias("s2_recall"), _ratio(F.col("found_s3"), F.col("n_s3")).alias("s3_recall"),
        "entities", _ratio(F.col("full"), F.col("entities")).alias("full_coverage"), "empty_truth", "empty_truth_with_candidates",
    )


def entity_metrics(df: DataFrame, beta: float = 0.5) -> DataFrame:
    """``df`` with p, r and f of the arrays ``truth`` and ``pred``.

    Nothing true and nothing predicted is perfect; predictions where nothing is true have precision 0 and recall 1; no
    predictions where something is true have precision 1 and recall 0.
    """
    t, p = F.size("truth"), F.size("pred")
    hit = F.size(F.array_intersect("truth", "pred"))
    precision = F.when(p == 0, 1.0).when(t == 0, 0.0).otherwise(hit / p)
    recall = F.when(t == 0, 1.0).when(p == 0, 0.0).otherwise(hit / t)
    f = F.when((t == 0) & (p == 0), 1.0).when((t == 0) | (p == 0) | (hit == 0), 0.0).otherwise((1 + beta**2) * precision * recall / (beta**2 * precision + recall))
    return df.withColumns({"tp": hit, "p": precision, "r": recall, "f": f})


def evaluate_predictions(truth: DataFrame, predictions: DataFrame, beta: float = 0.5) -> DataFrame:
    """One row: macro and micro measures over the entities of ``truth`` (s1_id, ids); who has no prediction predicts nothing."""
    joined = truth.select("s1_id", F.col("ids").alias("truth")).join(predictions.select("s1_id", F.col("ids").alias("pred")), "s1_id", "left")
    each = entity_metrics(joined.withColumn("pred", F.coalesce("pred", F.array().cast("array<string>"))), beta)
    single = F.size("truth") == 0
    total = each.agg(
        F.count("*").alias("entities"), F.avg("p").alias("macro_precision"), F.avg("r").alias("macro_recall"), F.avg("f").alias("macro_f"),
        F.sum("tp").alias("tp"), F.sum(F.size("pred")).alias("predicted"), F.sum(F.size("truth")).alias("true"),
        F.count_if(single).alias("singletons"), F.count_if(single & (F.size("pred") == 0)).alias("right"),
    )
    return total.select(
        "entities", "macro_precision", "macro_recall", "macro_f", _ratio(F.col("tp"), F.col("predicted")).alias("micro_precision"),
        _ratio(F.col("tp"), F.col("true")).alias("micro_recall"), F.when(F.col("singletons") == 0, 1.0).otherwise(F.col("right") / F.col("singletons")).alias("singleton_accuracy"),
    )


def cumulative_rules(queries: DataFrame, targets: DataFrame, truth: DataFrame, candidates, rules: list[str], cfg) -> DataFrame:
    """A row for each prefix of ``rules``: what ``candidates`` finds with these rules alone.

    ``candidates`` is asked for those among the true pairs and, so that every query with any is known, for those of queries without true ones.
    """
    from dataclasses import replace

    truth = written(truth, "truth")
    only = written(truth.select("s1_id", F.explode("ids").alias("candidate_id")).distinct(), "want")
    alone = truth.where(F.size("ids") == 0).select("s1_id")
    out = None
    for i in range(1, len(rules) + 1):
        found = candidates(queries, targets, replace(cfg, rules=tuple(rules[:i])), only=only, alone=alone)
        row = recall_metrics(truth, found).select(F.lit(i).alias("n_rules"), F.lit(rules[i - 1]).alias("added"), "*")
        out = row if out is None else out.unionByName(row)
    return out
