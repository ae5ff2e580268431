"""Features of candidate pairs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_number, tokens
from .stored import written


def _jaccard(a: Column, b: Column) -> Column:
    x, y = F.array_distinct(a), F.array_distinct(b)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / union)


def jaro_winkler(a: str, b: str, weight: float = 0.1) -> float:
    """Jaro similarity, raised for up to four equal first letters."""
    if a == b:
        return 1.0 if a else 0.0
    reach = max(len(a), len(b)) // 2 - 1
    used, first = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                first.append(c)
                break
    m = len(first)
    if not m:
        return 0.0
    second = [c for c, u in zip(b, used, strict=True) if u]
    moved = sum(x != y for x, y in zip(first, second, strict=True)) / 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * weight * (1 - jaro)


def _winkler(a: str, b: str) -> Column:
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([jaro_winkler(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    return F.pandas_udf(run, "double")(a, b)


def _cosine(pairs: DataFrame, records: DataFrame, column: str, words: DataFrame, n: int, name: str) -> DataFrame:
    """``pairs`` (r1, r2) with the cosine of the TF-IDF vectors of two ``records`` (r); frequencies are those of ``words`` over ``n`` rows."""
    tf = records.select("r", F.explode(column).alias("token")).groupBy("r", "token").agg(F.count("*").alias("tf"))
    df_ = words.select(F.explode(F.array_distinct(column)).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    raw = tf.join(df_, "token").withColumn("w", F.col("tf") * (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1))
    norm = raw.groupBy("r").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    w = written(raw.join(norm, "r").select("r", "token", (F.col("w") / F.col("norm")).alias("w")), "weights")
    both = pairs.select("r1", "r2").join(w.select(F.col("r").alias("r1"), "token", F.col("w").alias("a")), "r1")
    both = both.join(w.select(F.col("r").alias("r2"), "token", F.col("w").alias("b")), ["r2", "token"])
    cos = both.groupBy("r1", "r2").agg(F.sum(F.col("a") * F.col("b")).alias(name))
    return pairs.join(cos, ["r1", "r2"], "left").withColumn(name, F.coalesce(name, F.lit(0.0)))


def pair_features(pairs: DataFrame, entities: DataFrame, with_jaro_winkler: bool = True, digits: int | None = None) -> DataFrame:
    """s1_id, candidate_id and the features of names and addresses, rounded to ``digits``; ``entities`` has entity_id and the normalised columns.

    Entities of equal name and address are one record: features are worked out once for two records, however many pairs have them.
    """
    side = written(entities.select("entity_id", F.col("business_name_norm").alias("name"), F.col("business_address_norm").alias("addr")), "sides")
    n = side.count()
    # An entity's words, over all of its rows if it has several.
    words = side.groupBy("entity_id").agg(*[F.array_sort(F.flatten(F.collect_list(tokens(F.col(c))))).alias(f"{c}_words") for c in ("name", "addr")])
    words = written(words, "words")
    what = ["name", "addr", "name_words", "addr_words"]
    rows = written(side.join(words, "entity_id"), "rows")
    records = written(rows.select(*what).distinct().withColumn("r", F.monotonically_increasing_id()), "records")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in what]
    members = written(rows.alias("a").join(records.alias("b"), same[0] & same[1] & same[2] & same[3]).select("entity_id", "r"), "members")
    ids = pairs.select("s1_id", "candidate_id").distinct()
    ids = ids.join(members.select(F.col("entity_id").alias("s1_id"), F.col("r").alias("r1")), "s1_id")
    ids = written(ids.join(members.select(F.col("entity_id").alias("candidate_id"), F.col("r").alias("r2")), "candidate_id"), "ids")
    wanted = written(ids.select("r1", "r2").distinct(), "wanted")
    both = wanted.join(records.select("r", "name", "addr").toDF("r1", "n1", "a1"), "r1").join(records.select("r", "name", "addr").toDF("r2", "n2", "a2"), "r2")
    n1, n2, a1, a2 = (F.col(c) for c in ("n1", "n2", "a1", "a2"))
    longest = F.greatest(F.length(n1), F.length(n2))

    def numbers(x: Column) -> Column:
        return F.transform(F.filter(tokens(x), lambda t: F.regexp_like(t, F.lit(r"\p{Nd}"))), clean_number)

    got = both.select(
        "r1", "r2", "n1", "n2",
        ((n1 == n2) & (n1 != "")).cast("int").alias("name_exact_match"), _jaccard(tokens(n1), tokens(n2)).alias("name_token_jaccard"),
        F.when(longest == 0, 0.0).otherwise(1 - F.levenshtein(n1, n2) / longest).alias("name_levenshtein_ratio"),
        ((a1 == a2) & (a1 != "")).cast("int").alias("addr_exact_match"), _jaccard(tokens(a1), tokens(a2)).alias("addr_token_jaccard"),
        F.arrays_overlap(numbers(a1), numbers(a2)).cast("int").alias("addr_number_match"),
        F.abs(F.length(n1) - F.length(n2)).alias("name_len_diff"), F.abs(F.length(a1) - F.length(a2)).alias("addr_len_diff"),
    )
    if with_jaro_winkler:
        got = got.withColumn("name_jw_distance", 1 - _winkler("n1", "n2"))
    got = got.drop("n1", "n2")
    got = _cosine(got, records, "name_words", words, n, "name_tfidf_cosine")
    got = _cosine(got, records, "addr_words", words, n, "addr_tfidf_cosine")
    if digits is not None:
        got = got.withColumns({c: F.round(c, digits) for c, k in got.dtypes if k == "double"})
    return ids.join(written(got, "features"), ["r1", "r2"]).drop("r1", "r2")


def fused(scores: DataFrame, threshold: float) -> DataFrame:
    """s1_id, ids: the candidates whose mean of match_score reaches the threshold."""
    mean = scores.groupBy("s1_id", "candidate_id").agg(F.avg("match_score").alias("s"))
    return mean.where(F.col("s") >= threshold).groupBy("s1_id").agg(F.array_sort(F.collect_set("candidate_id")).alias("ids"))


def best_threshold(scores: DataFrame, truth: DataFrame, grid: list[float], beta: float = 0.5) -> DataFrame:
    """threshold, macro_f: of each value of the grid, best first."""
    from .evaluate import evaluate_predictions

    out = None
    for t in grid:
        row = evaluate_predictions(truth, fused(scores, t), beta).select(F.lit(float(t)).alias("threshold"), "macro_f")
        out = row if out is None else out.unionByName(row)
    return out.orderBy(F.desc("macro_f"), "threshold")
