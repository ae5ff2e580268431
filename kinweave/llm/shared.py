"""What the operators of this subpackage share: durable intermediate tables and connected groups."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..operators.stored import forget, forget_own, shared_folder, written

__all__ = ["connected_groups", "forget", "forget_own", "let", "shared_folder", "tidy", "unused", "written"]


def tidy(df: DataFrame) -> DataFrame:
    """``df``, after the driver let go of shuffles that no plan refers to any more, so that executors delete their files."""
    for _ in range(2):  # the last query is let go of a little later than those before
        gc.collect()
        df.sparkSession._jvm.System.gc()
        time.sleep(0.2)
    return df


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def connected_groups(edges: DataFrame, node: str = "node", root: str = "root", rounds: int | None = None) -> DataFrame:
    """Each node of ``edges`` (columns ``u`` and ``v``, any orderable type) with its group's smallest node.

    Alternating large-star and small-star steps: every step is an aggregate and an equi-join on the
    edges that are left, the number of edges never grows, and the number of rounds grows with the
    logarithm of the longest chain.  Nothing but two numbers a round reaches the driver.
    A hub's edges are aggregated on the map side first; the join that follows is an inner equi-join
    which adaptive execution can split.  Null nodes are left out; no edges give no rows.  After ``rounds`` it ends:
    nodes of one root are connected then, and those of two may be.  The frame's ``kinweave_edges`` (u, v) still connect all that was.
    """

    def stamp(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first())

    low, high = F.least("u", "v"), F.greatest("u", "v")
    now = written(
        edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .select(high.alias("u"), low.alias("v")).distinct(),
        "edges",
    )
    before = stamp(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        forget(now)
        now, mark = after, stamp(after)
        if mark == before:
            break
        before = mark
        if rounds is not None:
            rounds -= 1
            if not rounds:
                break
    left = now
    if rounds == 0:
        now = now.groupBy("u").agg(F.min("v").alias("v"))
    star = now.select(F.col("u").alias(node), F.col("v").alias(root))
    if rounds == 0:  # a root may have one of its own
        out = star.unionByName(now.select(F.col("v").alias(node), F.col("v").alias(root))).groupBy(node).agg(F.min(root).alias(root))
    else:
        out = star.unionByName(now.select(F.col("v").alias(node), F.col("v").alias(root)).distinct())
    out.kinweave_folder, out.kinweave_edges = left.kinweave_folder, left
    return out
