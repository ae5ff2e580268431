"""Exact top-k inner products, by vectors in the order of their length.

Vectors are rotated so that the first coordinates hold most of their length (the right singular
vectors, from the sum of outer products), and stand in blocks of descending length.  A block of
queries goes through the blocks: the product of the leading coordinates plus the product of the
remaining lengths bounds a score (Cauchy-Schwarz), and only pairs whose bound reaches the query's
k-th best score so far are computed in full.  A block whose longest vector can't reach any query's
k-th score ends the walk, as all later ones are shorter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import written

_TOP = "query_id long, vec_id long, score long"
_EXACT = float(1 << 53)


def whole_vectors(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, v (array of long): floor(scale * x) of each component.  Rows whose vec_id or vector is null, or
    whose vector holds a null, an infinity or no number, take no part."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    v = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).select("vec_id", v.alias("v"))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def rotation(whole: DataFrame, width: int) -> np.ndarray:
    """The right singular vectors of all rows, largest first, from ``width * width`` sums."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram = np.zeros((width, width))
        for df in batches:
            m = _matrix(df["v"], width)
            gram += m.T @ m
        yield pd.DataFrame({"at": np.arange(width * width), "x": gram.ravel()})

    gram = np.zeros(width * width)
    for r in whole.select("v").mapInPandas(run, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
        gram[r["at"]] = r["x"]
    values, turned = np.linalg.eigh(gram.reshape(width, width))
    return turned[:, np.argsort(-values)]


def _blocks(rows: DataFrame, width: int, size: int) -> DataFrame:
    """Rows of (longest, ids, vectors): ``size`` vectors each, in descending order of length within and across tasks.

    ``ids`` and ``vectors`` are little-endian 64-bit integers.
    """
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vecs, norms = [], [], []

        def block(n: int) -> pd.DataFrame:
            m = np.zeros((n, width), "<i8")
            for i, r in enumerate(vecs[:n]):
                m[i, : len(r)] = r
            out = pd.DataFrame({"longest": [float(np.sqrt(norms[0]))], "ids": [np.array(ids[:n], "<i8").tobytes()], "vectors": [m.tobytes()]})
            del ids[:n], vecs[:n], norms[:n]
            return out

        for df in batches:
            ids += df["vec_id"].tolist()
            vecs += list(df["v"])
            norms += df["square"].tolist()
            while len(ids) >= size:
                yield block(size)
        if ids:
            yield block(len(ids))

    dealt = rows.withColumn("square", square).repartitionByRange(F.desc("square"), F.xxhash64("vec_id")).sortWithinPartitions(F.desc("square"), "vec_id")
    return dealt.mapInPandas(pack, "longest double, ids binary, vectors binary")


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The places of each query's ``k`` best: larger score, then smaller id."""
    order = np.lexsort((ids, -score, query))
    first = np.r_[True, query[order][1:] != query[order][:-1]] if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < k]


class Search:
    """A block of queries and its best candidates so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floor: np.ndarray, turn: np.ndarray, head: int, k: int) -> None:
        self.ids, self.vectors, self.k, self.turn, self.head = ids, vectors, k, turn, head
        turned = vectors.astype(np.float64) @ turn
        self.lead, self.rest = turned[:, :head], np.sqrt((turned[:, head:] ** 2).sum(1))
        self.length = np.sqrt((turned**2).sum(1))
        self.floor = floor.astype(np.float64)  # the k-th score so far, or -inf
        self.at, self.found, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def reaches(self, longest: float) -> np.ndarray:
        """Which queries a vector of that length may still serve."""
        return self.length * longest * (1 + 1e-9) + 1e-6 >= self.floor

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        turned = vectors.astype(np.float64) @ self.turn
        rest, length = np.sqrt((turned[:, self.head :] ** 2).sum(1)), np.sqrt((turned**2).sum(1))
        live = np.flatnonzero(self.reaches(length.max()))
        if not len(live):
            return
        bound = self.lead[live] @ turned[:, : self.head].T
        bound += self.rest[live][:, None] * rest[None]
        slack = 1e-6 + 1e-9 * self.length[live].max() * length.max()
        may = bound + slack >= self.floor[live][:, None]
        del bound
        if self.length[live].max() * length.max() >= _EXACT / 4:
            self._exact(live, may, ids, vectors)
            return
        n = int(may.sum())
        if n > may.size // 8:
            score = self.vectors[live].astype(np.float64) @ vectors.T.astype(np.float64)
            may &= score >= self.floor[live][:, None]
            may &= self.ids[live][:, None] != ids[None]
            if len(ids) > self.k:  # a query's k-th score here is a floor too, its own id apart
                kth = np.partition(np.where(may, score, -np.inf), len(ids) - self.k, axis=1)[:, len(ids) - self.k]
                may &= score >= kth[:, None]
            q, c = np.nonzero(may)
            s = score[q, c].astype(np.int64)
        else:
            q, c = np.nonzero(may)
            s = np.empty(len(q), np.int64)
            for a in range(0, len(q), 1 << 16):
                b = slice(a, a + (1 << 16))
                s[b] = np.einsum("ij,ij->i", self.vectors[live[q[b]]], vectors[c[b]])
            good = (s >= self.floor[live[q]]) & (self.ids[live[q]] != ids[c])
            q, c, s = q[good], c[good], s[good]
        self._merge(live[q], ids[c], s)

    def _exact(self, live: np.ndarray, may: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Products that may not fit in a double: by Python's integers."""
        q, c = np.nonzero(may & (self.ids[live][:, None] != ids[None]))
        s = [sum(int(x) * int(y) for x, y in zip(self.vectors[live[i]], vectors[j], strict=True)) for i, j in zip(q, c, strict=True)]
        if s and max(map(abs, s)) >= 1 << 63:
            raise ValueError("an inner product does not fit in 64 bits")
        self._merge(live[q], ids[c], np.array(s, np.int64))

    def _merge(self, q: np.ndarray, ids: np.ndarray, s: np.ndarray) -> None:
        q, ids, s = np.concatenate([self.at, q]), np.concatenate([self.found, ids]), np.concatenate([self.score, s])
        keep = _best(q, ids, s, self.k)
        self.at, self.found, self.score = q[keep], ids[keep], s[keep]
        full = np.bincount(self.at, minlength=len(self.ids)) >= self.k
        least = np.full(len(self.ids), np.inf)
        np.minimum.at(least, self.at, self.score)
        self.floor = np.where(full, np.maximum(self.floor, least), self.floor)

    def result(self) -> pd.DataFrame:
        return pd.DataFrame({"query_id": self.ids[self.at], "vec_id": self.found, "score": self.score})


def _numbered(scalars: DataFrame, by: str, name: str, size: int) -> DataFrame:
    """``scalars`` in runs of ``size`` in descending order of a column.  There is one row of two numbers for each block of vectors."""
    at = Window.orderBy(F.desc(by), "id")
    return scalars.withColumn(name, F.floor((F.row_number().over(at) - 1) / size).cast("int"))


def top_inner_products(vectors: DataFrame, is_query, k: int = 20, scale: int = 64, block: int = 2048, query_block: int = 1024, blocks_per_task: int = 32, head: float = 0.25) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` largest inner products with the other rows.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on vec_id.  Ties go to the
    smaller vec_id; a query with fewer candidates gets them all.  Vectors of different lengths are
    filled up with zeros, empty ones too.  Rows that repeat a vec_id count as one, that with the
    smallest vector.  No rows, or no queries, give no rows.

    The longest candidates go first, alone; a query's k-th score there, by its own length, is the least length that can
    serve it.  Blocks are grouped by these lengths, ``blocks_per_task`` queries' and as many candidates' blocks to a task, and
    pairs of groups that can't serve each other are dropped while they are numbers, before any vector moves.  So a candidate moves
    once for 32,768 queries that it may serve.  What the tasks find is cut to ``k`` rows a query each.
    """
    whole = written(whole_vectors(vectors, scale).groupBy("vec_id").agg(F.min("v").alias("v")), "whole")
    width = max(1, whole.agg(F.max(F.size("v"))).first()[0] or 0)
    spark = vectors.sparkSession
    turn = spark.sparkContext.broadcast(rotation(whole, width))  # width * width numbers
    lead = max(1, int(width * head))
    number = F.monotonically_increasing_id().alias("id")
    candidates = written(_blocks(whole, width, block).select(number, "longest", "ids", "vectors"), "candidates")
    queries = written(_blocks(whole.where(is_query), width, query_block).select(number, "ids", "vectors"), "asked")
    top = spark.sparkContext.broadcast(candidates.orderBy(F.desc("longest"), "ids").select("ids", "vectors").first())  # one block

    def search_of(ids: bytes, vectors: bytes, floors: bytes | None) -> Search:
        at = np.frombuffer(ids, "<i8")
        floor = np.full(len(at), -np.inf) if floors is None else np.frombuffer(floors, "<f8")
        return Search(at, np.frombuffer(vectors, "<i8").reshape(-1, width), floor, turn.value, lead, k)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, key = [], None
        for df in batches:
            for r in df.itertuples(index=False):
                if key != (r.part, r.task):
                    yield from (x.result() for x in now)
                    key, now = (r.part, r.task), []
                if r.floors is not None:
                    now.append(search_of(r.ids, r.vectors, r.floors))
                    continue
                live = [x for x in now if x.reaches(r.longest).any()]
                if live:
                    ids, vectors = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.vectors, "<i8").reshape(-1, width)
                    for x in live:
                        x.add(ids, vectors)
        yield from (x.result() for x in now)

    def floors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The k-th scores among the longest candidates, and the least length that can serve any of a block's queries."""
        for df in batches:
            for r in df.itertuples(index=False):
                now = search_of(r.ids, r.vectors, None)
                now.add(np.frombuffer(top.value["ids"], "<i8"), np.frombuffer(top.value["vectors"], "<i8").reshape(-1, width))
                need = np.where(now.floor > 0, now.floor / np.maximum(now.length, 1e-300), -1.0)
                yield pd.DataFrame({"id": [r.id], "ids": [r.ids], "vectors": [r.vectors], "floors": [now.floor.astype("<f8").tobytes()], "need": [float(need.min()) if len(need) else np.inf]})

    seeded = written(queries.mapInPandas(floors, "id long, ids binary, vectors binary, floors binary, need double"), "floors")
    parts = written(_numbered(seeded.select("id", "need"), "need", "part", blocks_per_task), "parts")
    tasks = written(_numbered(candidates.select("id", "longest"), "longest", "task", blocks_per_task), "tasks")
    last = tasks.agg(F.max("task")).first()[0]
    lengths = tasks.groupBy("task").agg(F.max("longest").alias("longest"))
    needs = parts.groupBy("part").agg(F.min("need").alias("need")).withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(last or 0))))
    met = needs.join(lengths, "task").where(F.col("longest") * (1 + 1e-6) + 1e-6 >= F.col("need")).select("part", "task")
    met = written(met, "met")
    asked = seeded.join(parts.select("id", "part"), "id").join(met, "part").select("part", "task", F.lit(None).cast("double").alias("longest"), "ids", "vectors", "floors")
    served = candidates.join(tasks.select("id", "task"), "id").join(met, "task").select("part", "task", "longest", "ids", "vectors", F.lit(None).cast("binary").alias("floors"))
    # A task's queries come before its candidates, and these in descending length.
    walk = asked.unionByName(served).repartition("part", "task").sortWithinPartitions("part", "task", F.col("longest").desc_nulls_first())
    found = walk.mapInPandas(search, _TOP)
    ranked = found.selectExpr("query_id", "vec_id", "score", "row_number() over (partition by query_id order by score desc, vec_id) as rank")
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
