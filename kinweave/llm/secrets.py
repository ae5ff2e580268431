"""Secrets in texts, and how widely each candidate is owned across the corpus.

Patterns give candidate spans.  Candidates' hashes are counted by distinct documents (the
repositories) and distinct sources (the owners): one that many owners have is an example that was
copied around; one that a single owner has looks live.  Patterns that are too loose to trust alone
count as secrets only where that ownership speaks for them, and a value that was assigned to a
secret's name somewhere is a secret of the same owner where it stands bare.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

# The base patterns, with the least length of the secret.
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # [0-9a-f]+ matches whole runs, so those of 24 and more are these
BASE = ("assign", "access", "hex")
# Further kinds.  A loose one counts only if few own it.
_BEARER = re.compile(r"\b[Bb]earer\x20+([A-Za-z0-9._~+/-]{16,}=*)")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----")
_PREFIXED = re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|sk_live_[A-Za-z0-9]{16,}|(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})")
_LOOSE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_-]{12,}={0,2}(?![A-Za-z0-9+/_=-])")
KINDS = (*BASE, "bearer", "pem", "prefixed", "loose")
_RANK = {k: i for i, k in enumerate(KINDS)}
_FOUND = "array<struct<start: int, end: int, kind: string, value_hash: string, sure: boolean>>"


def entropy(text: str) -> float:
    """Bits a character."""
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def candidates(text: str) -> list[tuple[int, int, str, str, bool]]:
    """start, end (exclusive), kind, the secret's value, whether the pattern alone suffices; by start, then kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(*m.span(), "assign", m[2], True) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(*m.span(), "access", m[0], True) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(*m.span(), "hex", m[0], True) for m in _HEX.finditer(text)]
    if "earer" in text:
        out += [(*m.span(), "bearer", m[1], True) for m in _BEARER.finditer(text)]
    if "PRIVATE KEY-----" in text:
        out += [(*m.span(), "pem", m[0], True) for m in _PEM.finditer(text)]
    if "gh" in text or "xox" in text or "AIza" in text or "sk_live_" in text or "eyJ" in text:
        out += [(*m.span(), "prefixed", m[0], True) for m in _PREFIXED.finditer(text)]
    if any(c in text for c in "0123456789"):
        taken = sorted((a, b) for a, b, *_ in out)
        k = 0
        for m in _LOOSE.finditer(text):
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            if k < len(taken) and taken[k][0] < m.end():
                continue  # part of a span already
            if any(c.isalpha() for c in m[0]):
                out.append((*m.span(), "loose", m[0], False))
    return sorted(out, key=lambda x: (x[0], _RANK[x[2]], x[1]))


def find(docs: DataFrame) -> DataFrame:
    """row, doc_id, source, found (an array of spans with hashes of the secrets, not the secrets): one row for each of ``docs``."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for text in batch:
                spans = candidates(text)
                out.append([
                    {"start": a, "end": b, "kind": k, "value_hash": hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()[:32], "sure": sure or (b - a >= 20 and entropy(v) >= 3.5)}
                    for a, b, k, v, sure in spans
                ])
            yield pd.Series(out)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "text")
    return rows.select("row", "doc_id", "source", F.pandas_udf(run, _FOUND)(F.coalesce("text", F.lit(""))).alias("found"))


def ownership(found: DataFrame) -> DataFrame:
    """value_hash, n_docs, n_owners, assigned: of every candidate.  A null source is an owner of its own.

    Two aggregates, by (value, owner) and by value: a value that a third of the corpus has is
    summed up in each task before it moves.
    """
    each = found.select("doc_id", F.coalesce("source", F.lit("\0null")).alias("owner"), F.explode("found").alias("c")).select("doc_id", "owner", "c.value_hash", (F.col("c.kind") != "loose").alias("named"))
    by = each.groupBy("value_hash", "owner", "doc_id").agg(F.max("named").alias("named"))
    by = by.groupBy("value_hash", "owner").agg(F.count("*").alias("n_docs"), F.max("named").alias("named"))
    return by.groupBy("value_hash").agg(F.sum("n_docs").alias("n_docs"), F.count("*").alias("n_owners"), F.max("named").alias("named"))


def secrets(docs: DataFrame, owners_of_example: int = 3, docs_of_example: int = 10) -> DataFrame:
    """doc_id, source, spans: array of (start, end, kind, value_hash, n_docs, n_owners, live), by start and kind.

    ``docs`` has doc_id, text and source; one row for each of its rows, with an empty array where
    nothing was found or the text is null.  Places are code points, ends exclusive.  A value with at
    least ``owners_of_example`` owners and ``docs_of_example`` documents is an example; any other is live.  Base spans
    always stay; a loose one stays if its value is live and either looks random or is assigned to a
    secret's name somewhere.  A credential leaks from one owner into some documents of their own, while what examples and
    licenses print is copied: by three owners it has been copied twice, and ten documents leave out a few forks of one.
    Columns of ``docs`` other than the three are not looked at; without ``source`` it raises Spark's error.
    """
    found = written(find(docs), "secrets")
    owned = written(ownership(found), "owners")
    c = found.where(F.size("found") > 0).select("row", F.explode("found").alias("c")).select("row", "c.*")
    c = c.join(owned, "value_hash")
    example = (F.col("n_owners") >= owners_of_example) & (F.col("n_docs") >= docs_of_example)
    c = c.withColumn("live", ~example).where((F.col("kind") != "loose") | (F.col("live") & (F.col("sure") | F.col("named"))))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "end", "kind", "value_hash", "n_docs", "n_owners", "live")
    spans = c.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return found.select("row", "doc_id", "source").join(spans, "row", "left").select("doc_id", "source", F.coalesce("spans", empty).alias("spans"))
