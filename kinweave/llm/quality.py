"""Quality rules: counts on each text, and a likelihood ratio between a trusted target and the raw corpus.

Both are multinomials over hashed 1- and 2-grams.  The target is estimated on documents labelled as
good, the raw distribution on all documents.  A text's score is the mean over its n-grams of
log(target / raw); a fixed threshold, not a draw, decides on each document.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

BUCKETS = 1 << 16
_GRAM = re.compile(r"\w+|[^\w\s]+")
_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_ratio double"


def gram_buckets(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each 1-gram and each 2-gram of a text: lower-case runs of letters and digits, and runs of marks."""
    one = np.array([zlib.crc32(w) for w in (" ".join(_GRAM.findall(text.lower()))).encode("utf-8", "surrogatepass").split(b" ") if w], np.uint64)
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ one[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(20)
    return (np.concatenate([one, two]) % np.uint64(buckets)).astype(np.int64)


def repeated_words(words: list, width: int = 5) -> int:
    """How many words are in a window of ``width`` words that the text has twice or more."""
    windows = list(zip(*[words[k:] for k in range(width)], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    end = total = 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            total += i + width - max(i, end)
            end = i + width
    return total


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text.

    Words are runs of anything but ASCII white space.
    """
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def gram_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: over all of ``docs``.  Each task sums its own, so that ``buckets`` rows at most leave it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(buckets, np.int64)
        for df in batches:
            for text in df["text"]:
                n += np.bincount(gram_buckets(text, buckets), minlength=buckets) if len(text) > 20_000 else 0
                if len(text) <= 20_000:
                    np.add.at(n, gram_buckets(text, buckets), 1)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"bucket": at, "n": n[at]})

    return docs.select("text").where("text is not null").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smooth: float = 5.0) -> np.ndarray:
    """log(target / raw) for each bucket: as many numbers as ``buckets``, whatever the corpus."""
    both = gram_counts(docs, buckets).withColumn("of", F.lit(0)).unionByName(gram_counts(trusted, buckets).withColumn("of", F.lit(1)))
    n = np.zeros((2, buckets))
    for r in both.collect():  # at most 2 * buckets rows
        n[r["of"], r["bucket"]] = r["n"]
    return ratios_of(n[0], n[1], smooth)


def ratios_of(raw: np.ndarray, target: np.ndarray, smooth: float = 5.0) -> np.ndarray:
    """log(target / raw) of two arrays of counts.

    A bucket's count in the target is compared with what the raw corpus leads one to expect there;
    ``smooth`` is added to both, so that buckets with few expected grams say little, in a corpus of any size.
    """
    expected = raw * (target.sum() / max(raw.sum(), 1))
    return np.log((target + smooth) / (expected + smooth))


def judged(docs: DataFrame, ratios: np.ndarray, threshold: float, name: str = "quality") -> DataFrame:
    """``docs`` with a struct column: the counts, log_ratio, base_failed and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = shared.value
        for batch in texts:
            rows = []
            for text in batch:
                grams = gram_buckets(text, len(of))
                rows.append((*counts(text), float(of[grams].mean()) if len(grams) else 0.0))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _STATS.split(", ")])

    q = F.pandas_udf(run, _STATS)(F.coalesce("text", F.lit("")))
    out = docs.withColumn(name, q)
    failed = (F.col(f"{name}.n_words") < 10) | (100 * F.col(f"{name}.n_repeat_words") > 20 * F.col(f"{name}.n_words"))
    out = out.withColumn(name, F.col(name).withField("base_failed", failed))
    return out.withColumn(name, F.col(name).withField("kept", ~F.col(f"{name}.base_failed") & (F.col(f"{name}.log_ratio") >= threshold)))


def trusted_sample(docs: DataFrame, labels: DataFrame, at_most: int = 50_000) -> DataFrame:
    """Documents labelled with quality 1: those with the ``at_most`` smallest hashes of doc_id."""
    good = labels.where("quality = 1").select(F.col("doc_id").alias("of")).distinct().orderBy(F.xxhash64("of"), "of").limit(at_most)
    return docs.join(F.broadcast(good), F.col("doc_id") == F.col("of"), "left_semi").select("text")  # at_most numbers


def quality(docs: DataFrame, labels: DataFrame, threshold: float = -0.35, at_most: int = 50_000, buckets: int = BUCKETS, name: str = "quality") -> DataFrame:
    """``docs`` with the column ``name``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    log_ratio, base_failed, kept.

    Null texts count as empty; they, and texts without words, have zeros and fail the base rules.
    Repeated rows are judged alike, and count as often as they occur in the raw distribution.
    A ratio equal to ``threshold`` is kept.  At -0.35 a text's n-grams are on average 0.7 times as likely in the target
    as in the corpus: prose of any subject stays above that, runs of boilerplate and marks fall below.
    """
    return judged(docs, log_ratios(docs, trusted_sample(docs, labels, at_most), buckets), threshold, name)
