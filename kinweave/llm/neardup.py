"""Near duplicates among documents by SimHash, found by hashing balls that meet in the middle.

Two fingerprints that differ in at most 2 bits have a value within 1 bit of both.  Each distinct
fingerprint goes to the 65 values within 1 bit of it; those that come to one value are at most 2
bits apart, and every pair at most 2 bits apart comes to one.  No more than 65 fingerprints are
within 1 bit of a value, so a meeting is small however large a group of copies is: copies have one
fingerprint, which is dealt out once.

Fingerprints of 2 bits find little beyond exact copies.  ``similar_groups`` groups documents by the Jaccard similarity
of their shingles: documents meet on their smallest shingles' hashes, and the whole sets of those that meet are compared.  The pipeline
takes the links of both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .meet import FEW, few_pairs, meetings, neighbours, rare_pairs, unresolved
from .shared import connected_groups, forget, tidy, written

_CHUNK = 1 << 16


def simhash(text: str, width: int = 3, seed: int = 42) -> int:
    """Of the ``width``-word shingles of ``text`` in lower case (A-Z only), as an unsigned number.

    Words are runs of anything but ASCII white space.  A text with fewer words has one shingle of
    them all; one without words has fingerprint 0.  A bit is 1 if it is set in over half the
    shingles' XXH64 hashes.  A long text's hashes are counted in chunks.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        part = words[at : min(n, at + _CHUNK) + width - 1]
        shingles = zip(*[part[k:] for k in range(width)], strict=False) if len(part) >= width else [part]
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(x), seed) for x in shingles], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with ``fingerprint``, as a signed 64-bit number (null text: as empty)."""

    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([simhash(t, width, seed) for t in batch], np.uint64).astype(np.int64))

    return docs.withColumn("fingerprint", F.pandas_udf(of, "long")(F.coalesce("text", F.lit(""))))


def _flips(col: str, radius: int):
    """All 64-bit numbers within ``radius`` (0, 1 or 2) bits of a column."""
    masks = [0] + [1 << i for i in range(64)] * (radius > 0) + [1 << i | 1 << j for i in range(64) for j in range(i)] * (radius > 1)
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in signed]), lambda m: m.bitwiseXOR(F.col(col)))


def linked_fingerprints(distinct: DataFrame, bits: int = 2) -> DataFrame:
    """Edges u, v over the distinct values of column ``fingerprint``: their connected groups are those
    of all pairs at most ``bits`` (0 to 4) bits apart.

    At each value that several fingerprints come to, each is linked to the smallest.  If ``bits`` is
    even, any two there are near enough, so nothing is lost by leaving out the other pairs.  If it
    is odd, every pair is formed and checked instead; a meeting is bounded then too.
    """
    if not 0 <= bits <= 4:
        raise ValueError("bits must be from 0 to 4")
    near = distinct.select("fingerprint", F.explode(_flips("fingerprint", (bits + 1) // 2)).alias("variant"))
    far = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    if bits % 2 == 0:
        at = Window.partitionBy("variant")
        met = near.select(F.col("fingerprint").alias("u"), F.min("fingerprint").over(at).alias("v"))
        return met.where((F.col("u") != F.col("v")) & (far <= bits)).distinct()
    other = near.select(F.col("fingerprint").alias("v"), "variant")
    return near.withColumnRenamed("fingerprint", "u").join(other, "variant").where((F.col("u") > F.col("v")) & (far <= bits)).select("u", "v").distinct()


def components(docs: DataFrame, bits: int = 2, width: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id: one row for each row of ``docs``.

    ``docs`` has doc_id and text; other columns are not looked at.  component_id is the smallest
    doc_id that links lead to, the document's own included.  Null texts count as empty; texts
    without words have fingerprint 0, which links like any other.  A null doc_id is never the
    smallest unless a group has no other.  Repeated rows give repeated rows; no rows give none.
    """
    prints = written(fingerprints(docs.select("doc_id", "text"), width, seed).select("doc_id", "fingerprint"), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    groups = connected_groups(linked_fingerprints(distinct.select("fingerprint"), bits), "fingerprint", "root")
    roots = distinct.join(groups, "fingerprint", "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    of = roots.join(smallest, "root").select("fingerprint", "component_id")
    got = prints.join(of, "fingerprint")
    return got.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def shingle_sets(docs: DataFrame, width: int = 5) -> DataFrame:
    """``docs`` with shingles: the distinct ``width``-word shingles of each text in lower case, as ascending hashes, instead of its text.

    Words are runs of anything but ASCII white space.  A text with fewer words has one shingle of them all (null text: as empty).
    Every select is a step of its own, so that nothing is computed twice.
    """
    columns = [c for c in docs.columns if c != "text"]
    words = F.array_remove(F.split(F.translate(F.lower(F.coalesce("text", F.lit(""))), "\t\n\x0b\x0c\r", "     "), " "), "")
    got = docs.select(*columns, F.transform(words, lambda w: F.xxhash64(w)).alias("hashes"))
    places = F.sequence(F.lit(0), F.greatest(F.size("hashes") - width, F.lit(0)))
    each = F.transform(places, lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(width)]))
    return got.select(*columns, F.sort_array(F.array_distinct(each)).alias("shingles"))


def ball_links(sets: DataFrame, bits: int) -> DataFrame:
    """u, v: edges that connect all h of ``sets`` (h, fingerprint) whose fingerprints are in one group of those at most ``bits`` bits apart."""
    sets = sets.select("h", "fingerprint").distinct()
    groups = connected_groups(linked_fingerprints(sets.select("fingerprint").distinct(), bits), "fingerprint", "root")
    of = sets.join(groups, "fingerprint", "left").select("h", F.coalesce("root", "fingerprint").alias("root"))
    return of.join(of.groupBy("root").agg(F.min("h").alias("v")), "root").where("h != v").select(F.col("h").alias("u"), "v")


def similar_groups(docs: DataFrame, width: int = 5, similarity: float = 0.8, most: int = 8, bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """doc_id, t, h of each row of ``docs`` (t: a hash of the text, h: of its set of shingles), and the connected groups (h, root) of the sets.

    Sets link if their Jaccard similarity is ``similarity`` at least.  They meet if one of their ``most`` smallest hashes
    is the same, which two sets that similar miss with a chance of (1 - similarity) ** most: 3 in a million.  Sets on hashes that over
    ``FEW`` share meet again on their rarest hashes, where they are not connected.  With ``bits``, documents whose SimHash fingerprints
    are that near link as well, as in ``components``.
    """
    prints = [] if bits is None else ["fingerprint"]
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit("\0null"))).alias("t"), "text")
    sets = shingle_sets(rows if bits is None else fingerprints(rows), width)
    sets = written(sets.select("doc_id", "t", *prints, F.xxhash64("shingles").alias("h"), F.size("shingles").cast("long").alias("la"), F.slice("shingles", 1, most).alias("some")), "sets")
    distinct = sets.groupBy("h").agg(F.min(F.struct("t", "doc_id")).alias("o"), F.first("la").alias("la"), F.first("some").alias("some"))
    distinct = tidy(written(distinct, "distinct"))
    met = tidy(written(meetings(distinct.select(F.explode("some").alias("key"), "h", "la")), "meetings"))
    near = F.least("la", "lb") >= F.lit(similarity) * F.greatest("la", "lb")
    pairs = neighbours(met, near)
    asked = met.where("n > 2").select("h").unionByName(pairs.select("h")).unionByName(pairs.select(F.col("g").alias("h"))).distinct()
    want = distinct.join(asked, "h").select("h", F.col("o.doc_id").alias("d"), F.col("o.t").alias("x"))
    own = docs["doc_id"].eqNullSafe(F.col("d")) & (F.xxhash64(F.coalesce("text", F.lit("\0null"))) == F.col("x"))
    whole = tidy(written(shingle_sets(docs.select("doc_id", "text").join(want.hint("merge"), own).select("h", "text"), width).dropDuplicates(["h"]), "whole"))

    def similar(pairs: DataFrame) -> DataFrame:
        both = pairs.join(whole, "h").join(whole.select(F.col("h").alias("g"), F.col("shingles").alias("others")), "g")
        both = both.withColumn("both", F.size(F.array_intersect("shingles", "others")))
        return both.where(F.col("both") >= F.lit(similarity) * (F.size("shingles") + F.size("others") - F.col("both")) - 1e-9).select(F.col("h").alias("u"), F.col("g").alias("v"))

    links = written(similar(pairs), "links")
    some = connected_groups(links, "h", "root")
    of = written(unresolved(met, some), "mixed")
    hot = of.where(F.col("n") > FEW).select("h", "root").distinct()
    lose = F.size("shingles") - F.ceil(F.lit(similarity) * F.size("shingles") - 1e-9)  # what is common is a share of either set
    items = whole.join(hot, "h").select("h", "root", F.size("shingles").alias("la"), lose.alias("lose"), F.col("shingles").alias("parts"))
    rest = tidy(written(few_pairs(of, near).unionByName(rare_pairs(items, near)).distinct(), "rest"))
    edges = some.kinweave_edges.unionByName(similar(rest))
    if bits is not None:
        edges = edges.unionByName(ball_links(sets, bits))
    groups = connected_groups(edges, "h", "root")
    for table in (distinct, met, whole, links, some, of, rest):
        forget(table)
    return sets.select("doc_id", "t", "h"), tidy(groups)


def first_of_each(docs: DataFrame, width: int = 5, similarity: float = 0.8, most: int = 8, bits: int | None = None) -> DataFrame:
    """One row of ``docs`` for each group that ``similar_groups`` finds: that with the smallest doc_id, then text hash (null doc_id last).

    Rows are told apart by doc_id and text, so unlike texts under one doc_id, or under none, stay.  Of rows equal in
    both one stays.  Null texts count as empty ones and are a group with them.  No rows give none.
    """
    sets, groups = similar_groups(docs, width, similarity, most, bits)
    rows = sets.groupBy("doc_id", "t", "h").agg(F.count("*").alias("n")).join(groups, "h", "left")
    rows = rows.select("doc_id", "t", "n", F.coalesce("root", "h").alias("root"), F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "t").alias("o"))
    least = rows.groupBy("root").agg(F.min("o").alias("least"))
    rows = rows.join(least, "root").select(F.col("doc_id").alias("d"), F.col("t").alias("x"), "n", F.col("o").eqNullSafe(F.col("least")).alias("first"))
    rows = written(rows.where("not first or n > 1"), "rows")
    own = F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64(F.coalesce("text", F.lit("\0null"))) == F.col("x"))
    # Both sides grow with the corpus: a sort-merge join at every size.
    kept = docs.join(rows.select("d", "x").hint("merge"), own, "left_anti")
    again = rows.where("first").select("d", "x")
    if again.limit(1).count():
        kept = kept.unionByName(docs.join(again.hint("merge"), own, "left_semi").dropDuplicates(["doc_id", "text"]))
    return kept
