"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source that is to give ``target`` of its ``source_size`` words is wanted
``target / source_size`` times.  The whole part of that is taken at once; the fraction is a
probability, and the fractions of a source are rounded together: two documents meet, and words move
from one to the other, at random and without bias, until one of the two fractions is 0 or 1.  The
other document carries what is left to the next meeting.  Each meeting keeps the words taken
together, so a source misses its target by less than one document, while each document keeps its
own expected number of copies.

Meetings happen in a tree: buckets of a source first, then the buckets' leftover documents, one for
each bucket, in buckets of their own, until a source has one document left, which a coin decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import unused, written

WORD = r"[^\x20\x09-\x0D]+"
_COLUMNS = "doc_id string, source string, size long, source_size long, target double, key long, n_buckets long, bucket long, whole long, fraction double, decided boolean"


def with_sizes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``: the number of runs of anything but ASCII white space (null text: 0)."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0).cast("long")))


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, rows_per_bucket: int = 1024) -> DataFrame:
    """One row a source: source, source_size, n_docs, target, n_buckets.

    Sources in code point order, null last, take ``weights`` in turn and share the whole size.  A
    target stops at ``most`` times its source's size, and the excess goes to the others by weight
    until none is above: the targets are ``min(most * source_size, level * weight)`` for the one
    level that uses up the total.  Sorted by ``most * source_size / weight``, the sources that stop
    are a prefix, so running sums give the level.  These windows see one row a source, not documents.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = ((F.row_number().over(order) - 1) % len(weights)).cast("int")
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    rise = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = rise.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = per.withColumn("above", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    per = per.withColumn("level", left / F.col("above"))
    # The first source that its level does not bring to its cap, and all after it, share that level.
    place = F.row_number().over(rise)
    per = per.withColumn("place", place).withColumn("first", F.min(F.when(F.col("level") * F.col("weight") < F.col("cap"), F.struct("place", "level"))).over(every))
    per = per.withColumn("level", F.when(F.col("place") >= F.col("first.place"), F.col("first.level")))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / rows_per_bucket)).cast("long")
    return per.select("source", "source_size", "n_docs", target.alias("target"), buckets.alias("n_buckets"))


def _coins(keys: np.ndarray, seed: int, level: int) -> np.ndarray:
    """A number in [0, 1) from each key: the same in every run."""
    x = keys.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + level * 0xD1B54A32D192ED03) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53


def meet(p: float, a: int, q: float, b: int, coin: float) -> tuple[float, float]:
    """Move words between a document of size ``a`` wanted ``p`` times and one of size ``b`` wanted
    ``q`` times until one of the fractions is whole.  Both keep their expectation, and
    ``a * p + b * q`` stays as it is."""
    up, down = min(a * (1 - p), b * q), min(a * p, b * (1 - q))
    if coin * (up + down) < down:
        return (1.0, q - up / b) if up == a * (1 - p) else (p + up / a, 0.0)
    return (0.0, q + down / b) if down == a * p else (p - down / a, 1.0)


def _round(level: int, last: bool, seed: int):
    """A function for mapInPandas over rows sorted by source and bucket, one bucket after the other."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, at = None, None
        for df in batches:
            n = len(df)
            whole, fraction, decided = df["whole"].to_numpy(copy=True), df["fraction"].to_numpy(copy=True), np.ones(n, bool)
            size, coin = df["size"].to_numpy(), _coins(df["key"].to_numpy(np.int64), seed, level)
            group = list(zip(df["source"].where(df["source"].notna(), None), df["bucket"], strict=True))
            ready = []

            def close(row: dict, index: int | None, whole=whole, fraction=fraction, decided=decided, ready=ready) -> None:
                """A bucket's last document: its coin falls, or it goes on to the next level."""
                up = int(last and _coins(np.array([row["key"]], np.int64), seed + 1, level)[0] < row["fraction"])
                if index is None:
                    ready.append(row | {"whole": row["whole"] + up, "fraction": 0.0 if last else row["fraction"], "decided": last})
                else:
                    whole[index] += up
                    fraction[index] = 0.0 if last else row["fraction"]
                    decided[index] = last

            # ``held`` is [source and bucket, place in this batch or None, fraction, size, row of an earlier batch]
            for i in range(n):
                if held and held[0] != group[i]:
                    row = held[4] | {"fraction": held[2]} if held[1] is None else {"key": int(df["key"].iat[held[1]]), "fraction": held[2], "whole": int(whole[held[1]])}
                    close(row, held[1])
                    held = None
                f = fraction[i]
                if f <= 1e-12 or f >= 1 - 1e-12:
                    whole[i] += int(f > 0.5)
                    fraction[i] = 0.0
                    continue
                if size[i] <= 0:  # it weighs nothing: no other document's words depend on it
                    whole[i] += int(coin[i] < f)
                    fraction[i] = 0.0
                    continue
                if held is None:
                    held = [group[i], i, f, int(size[i]), None]
                    continue
                p, q = meet(held[2], held[3], f, int(size[i]), coin[i])
                if p <= 1e-12 or p >= 1 - 1e-12:
                    if held[1] is None:
                        ready.append(held[4] | {"whole": held[4]["whole"] + int(p > 0.5), "fraction": 0.0, "decided": True})
                    else:
                        whole[held[1]] += int(p > 0.5)
                        fraction[held[1]] = 0.0
                    held = None
                    if q <= 1e-12 or q >= 1 - 1e-12:
                        whole[i] += int(q > 0.5)
                        fraction[i] = 0.0
                    else:
                        held = [group[i], i, q, int(size[i]), None]
                else:
                    whole[i] += int(q > 0.5)
                    fraction[i] = 0.0
                    held[2] = p
            out = df.assign(whole=whole, fraction=fraction, decided=decided)
            if held and held[1] is not None:
                held[4] = out.iloc[held[1]].to_dict()
                out = out.drop(out.index[held[1]])
                held[1] = None
            if ready:
                yield pd.DataFrame(ready)[list(df.columns) + ["decided"]]
            yield out
        if held:
            row = held[4] | {"fraction": held[2]}
            up = int(last and _coins(np.array([row["key"]], np.int64), seed + 1, level)[0] < row["fraction"])
            yield pd.DataFrame([row | {"whole": int(row["whole"]) + up, "fraction": 0.0 if last else row["fraction"], "decided": last}])

    return run


def copies(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, seed: int = 7, rows_per_bucket: int = 1024, fan_in: int = 256) -> DataFrame:
    """doc_id, key, source, size, source_size, target, copies: how often the mix takes each row of ``docs``.

    ``docs`` has doc_id, text and source; other columns are not looked at.  A null text has size 0, a
    null source is a source of its own, a source without words has target 0 and gives nothing.  Rows
    that are equal in all three columns are taken one by one and keep their own rows here.  An empty
    table gives an empty one.  ``key`` is a hash of the three columns.  The result depends on the
    rows and the seed alone.
    """
    key = F.xxhash64("doc_id", F.coalesce("source", F.lit("\0null")), F.coalesce("text", F.lit("\0null")))
    sized = written(with_sizes(docs.select("doc_id", "text", "source")).select(F.col("doc_id").cast("string"), "source", "size", key.alias("key")), "sizes")
    per = written(source_targets(sized, weights, most, rows_per_bucket), "targets")
    deepest = per.agg(F.max("n_buckets")).first()[0] or 1
    ratio = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    rows = sized.join(per.drop("n_docs").withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = rows.withColumn("whole", F.floor(ratio).cast("long")).withColumn("fraction", ratio - F.floor(ratio))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), "n_buckets"))
    done, level = [], 0
    while True:
        last = deepest <= 1
        names = [c.split()[0] for c in _COLUMNS.split(", ")][:-1]
        # The longest documents meet first: what is left over at the end of a bucket is short.
        dealt = rows.select(*names).repartition("source", "bucket").sortWithinPartitions("source", "bucket", F.desc("size"), "key", "doc_id")
        step = written(dealt.mapInPandas(_round(level, last, seed), _COLUMNS), f"round{level}")
        done.append(step.where("decided"))
        if last:
            break
        deepest, level = -(-deepest // fan_in), level + 1
        rows = step.where("not decided").withColumn("bucket", F.floor(F.col("bucket") / fan_in).cast("long"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType), "key", "source", "size", "source_size", "target", F.col("whole").alias("copies"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``copies`` says, with all its columns.

    Rows are matched with their copies by the hash of doc_id, source and text and, among rows that
    are equal in these, by their number, so that repeated rows keep what each of them was given.
    """
    key, total, rows, number, times = (unused(docs, x) for x in ("key", "total", "rows", "number", "times"))
    taken = copies(docs, **how).groupBy(F.col("key").alias(key)).agg(F.sum("copies").alias(total), F.count("*").alias(rows))
    taken = taken.where(F.col(total) > 0)
    of = F.xxhash64("doc_id", F.coalesce("source", F.lit("\0null")), F.coalesce("text", F.lit("\0null")))
    # Both sides grow with the corpus: a sort-merge join at every size, instead of a shuffle of the texts that is begun and dropped.
    out = docs.withColumn(key, of).join(taken.hint("merge"), key)
    # Equal rows are interchangeable: each gets the whole part of the mean, the first ones one more.
    several = taken.where(F.col(rows) > 1).limit(1).count() > 0
    out = out.withColumn(number, F.row_number().over(Window.partitionBy(key).orderBy("doc_id")) if several else F.lit(1))
    each = F.floor(F.col(total) / F.col(rows)) + F.when(F.col(number) <= F.col(total) % F.col(rows), 1).otherwise(0)
    out = out.withColumn(times, each.cast("int")).where(F.col(times) > 0)
    return out.withColumn(number, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
