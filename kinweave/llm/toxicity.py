"""Toxicity of texts after a noisy channel is undone.

A writer hides words by digits and signs for letters, by letters said several times, and by spaces
or marks between letters.  A word that looks so becomes a lattice: each character may stand for some
letters at a cost, a repeated one may be dropped, a gap may be read over or end a word.  Viterbi finds the
reading that is likeliest under a character trigram model of the corpus and the channel's costs.
The text restored this way is scored by a linear model over words and their beginnings.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

# Letters that a sign can stand for.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
LETTERS = " abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
_PLACE = {c: i for i, c in enumerate(LETTERS)}
_OTHER = len(LETTERS)
_N = _OTHER + 1
_WORD = re.compile(r"[^\W\d_]+")
_SIGN = re.escape("".join(SIGNS))
_MARK = rf"(?:_|[^\w\s{_SIGN}])"
#: Letters next to signs; two equal letters in a row; marks between letters.
_NOISY = re.compile(rf"[^\W\d_][{_SIGN}]|[{_SIGN}]+[^\W\d_]|([^\W\d_])\1|[^\W\d_]{_MARK}+[\w{_SIGN}]|[\w{_SIGN}]{_MARK}+[^\W\d_]", re.I)
_END = "!?.,;:\"')]}»”…"
_REPLACE, _DROP, _SAME = -1.0, -0.7, -2.5
#: Dropping one of two equal letters, in a word with one such pair (who doubles letters does so throughout); reading on over a mark; a word's end at a gap, where all letters stand alone.
_PAIR, _SKIP, _BREAK = -8.0, -2.0, -2.0


def place(c: str) -> int:
    return _PLACE.get(c, _OTHER)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """at, n: how often each three characters follow each other within words of all of ``docs``, two spaces before each word.

    Words are summed up in each task and then over tasks; what they gather grows with the corpus's vocabulary.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for df in batches:
            for text in df["text"]:
                seen.update(text.split())
            if len(seen) > 200_000:
                yield from words_of(seen)
                seen.clear()
        yield from words_of(seen)

    def words_of(seen: Counter) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        for part, n in seen.items():
            for w in _WORD.findall(part.lower()):
                words[w] += n
        if words:  # an empty list would make a column of floating point numbers
            yield pd.DataFrame({"word": list(words), "n": list(words.values())})

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(_N**3)
        for df in batches:
            for word, n in zip(df["word"], df["n"], strict=True):
                p = [0, 0, *map(place, word), 0]
                for i in range(len(p) - 2):
                    total[(p[i] * _N + p[i + 1]) * _N + p[i + 2]] += n
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at].astype(np.int64)})

    words = docs.select("text").where("text is not null").mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.mapInPandas(grams, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))


def _spelt(run: list[str]) -> bool:
    """Whether lone letters and signs in a row can spell a word."""
    return len(run) > 1 and any(x.isalpha() for x in run)


class Language:
    """log P(c | a, b) of characters: trigrams smoothed by bigrams by single ones, in an array of a fixed size."""

    def __init__(self, counts: dict[int, int]) -> None:
        n = np.zeros(_N**3)
        n[list(counts)] = list(counts.values())
        n = n.reshape(_N, _N, _N)
        one = (n.sum((0, 1)) + 0.5) / (n.sum() + 0.5 * _N)
        two = (n.sum(0) + 20 * one) / (n.sum((0, 2))[:, None] + 20)
        self.log = np.log((n + 20 * two) / (n.sum(2)[:, :, None] + 20)).astype(np.float32)

    def decode(self, noisy: str) -> str:
        """The likeliest reading of a noisy word, in letters."""
        log, paths = self.log, {(0, 0): (0.0, None)}  # of the last two letters: cost, and what was said as (before, last)
        low = noisy.lower()
        gap = [not (c.isalnum() or c in SIGNS) for c in low]
        spaced = len(low) > 2 and all(g == i % 2 for i, g in enumerate(gap))
        skip, end = (0.0, _BREAK) if spaced else (_SKIP, 0.0)
        runs = [(c, len(list(same))) for c, same in groupby(c for c, g in zip(low, gap, strict=True) if not g)]
        pair = _PAIR / max(1, sum(n == 2 for _, n in runs))
        drops = iter([_DROP if n > 2 else pair for _, n in runs for _ in range(n)])
        before = ""
        for c, between in zip(low, gap, strict=True):
            if between:
                # Either the word goes on, or it ends here and the next begins.
                new = {at: (cost + skip, said) for at, (cost, said) in paths.items() if at != (0, 0)}
                ends = [(cost + (end + float(log[a, b, 0]) if (a, b) != (0, 0) else 0.0), said) for (a, b), (cost, said) in paths.items()]
                cost, said = max(ends, key=lambda x: x[0])
                new[0, 0] = (cost, (said, c))
                paths = new
                continue
            drop = next(drops)
            options = [(x, _REPLACE) for x in SIGNS.get(c, "")]
            if c.isalpha():
                options.append((c, 0.0))
            elif not options:
                options.append((c, _SAME))
            new: dict = {}
            for (a, b), (cost, said) in paths.items():
                for x, extra in options:
                    k = place(x)
                    got = cost + extra + float(log[a, b, k])
                    if got > new.get((b, k), (-1e30,))[0]:
                        new[b, k] = (got, (said, x))
                if c == before and (a, b) != (0, 0):
                    got = cost + drop
                    if got > new.get((a, b), (-1e30,))[0]:
                        new[a, b] = (got, said)
            paths, before = new, c
        _, said = max(((cost + (float(log[a, b, 0]) if (a, b) != (0, 0) else 0.0), said) for (a, b), (cost, said) in paths.items()), key=lambda x: x[0])
        out = []
        while said:
            said, x = said
            out.append(x)
        return "".join(reversed(out))


class Restorer:
    """Restores texts; what parts of texts become is kept for ``room`` parts at most."""

    def __init__(self, language: Language, room: int = 300_000) -> None:
        self.language, self.room = language, room
        self.known: dict[str, tuple[str, ...]] = {}

    def part(self, part: str) -> str:
        """A part without white space, restored."""
        core = part.rstrip(_END)
        return self.language.decode(core) if len(core) > 1 and _NOISY.search(core) else part

    def text(self, text: str) -> str:
        """A text, restored: its parts one by one, and runs of lone letters and signs as the words they spell."""
        out, run = [], []
        for x in [*text.split(), ""]:
            if len(x) == 1 and (x.isalnum() or x in SIGNS):
                run.append(x)
                continue
            out += [self.language.decode(" ".join(run))] if _spelt(run) else run
            run = []
            out.append(self.part(x) if x else "")
        return " ".join(out).strip()

    def _features(self, word: str) -> tuple[str, ...]:
        out = []
        for w in _WORD.findall(word.lower()):
            out.append(w)
            out += [w[:k] + "-" for k in (4, 5, 6) if len(w) > k]
        return tuple(out)

    def features(self, text: str) -> set[str]:
        """The words of the restored text, and the first 4 to 6 letters of longer ones.

        The order of parts matters only to runs of lone letters, so each distinct part is looked up once.
        """
        parts = text.split()
        known, found = self.known, set()
        distinct = set(parts)
        for x in distinct:
            got = known.get(x)
            if got is None:
                if len(known) >= self.room:
                    known.clear()
                got = known[x] = self._keep(self._features(self.part(x)))
            if got:
                found.update(got)
        if sum(len(x) == 1 for x in distinct) > 1:
            run: list[str] = []
            for x in [*parts, ""]:
                if len(x) == 1 and (x.isalnum() or x in SIGNS):
                    run.append(x)
                else:
                    if _spelt(run):
                        found.update(self._keep(self._features(self.language.decode(" ".join(run)))))
                    run = []
        return found

    def _keep(self, features: tuple) -> tuple:
        return features


class Scorer(Restorer):
    """Restores texts and keeps only the numbers of the features that a model uses."""

    def __init__(self, language: Language, numbers: dict[int, int], buckets: int) -> None:
        super().__init__(language)
        self.numbers, self.buckets = numbers, buckets

    def _keep(self, features: tuple) -> tuple:
        got = (self.numbers.get(_number(f, self.buckets)) for f in features)
        return tuple(k for k in got if k is not None)


def _number(feature: str, buckets: int) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % buckets


def training_rows(docs: DataFrame, labels: DataFrame, at_most: int) -> DataFrame:
    """text, toxic: labelled rows whose crc32(doc_id as text) mod 3 is not 1; those with the ``at_most`` smallest hashes, one row (the least text) a doc_id."""
    good = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("of")).agg(F.max("toxic").alias("toxic"))
    good = good.where(F.crc32(F.col("of").cast("string").cast("binary")) % 3 != 1).orderBy(F.xxhash64("of"), "of").limit(at_most)
    # at_most rows of two numbers
    rows = docs.where("text is not null").join(F.broadcast(good), F.col("doc_id") == F.col("of")).select("of", "text", "toxic")
    return rows.groupBy("of").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")


class Model:
    """The probability of toxicity from the features that tell the classes apart."""

    def __init__(self, scorer: Scorer, weights: np.ndarray, bias: float) -> None:
        self.scorer, self.weights, self.bias = scorer, weights, bias

    def score(self, text: str) -> float:
        total = self.bias + sum(self.weights[k] for k in sorted(self.scorer.features(text)))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def fit(train: DataFrame, restorer: Restorer, buckets: int = 1 << 22, keep: int = 4096, least_gain: float = 5.0) -> Model:
    """Count features by class, keep the ``keep`` that tell most, and fit their weights and a bias.

    The features kept are those with the largest log-likelihood ratio, ``least_gain`` at least, between
    their frequencies in the two classes.  Logistic regression over them sees the training rows' hits only.
    """
    spark = train.sparkSession
    shared = spark.sparkContext.broadcast(restorer)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = (Counter(), Counter())
        for df in batches:
            for text, toxic in zip(df["text"], df["toxic"], strict=True):
                seen[int(toxic > 0)].update({_number(f, buckets) for f in shared.value.features(text)})
        keys = list(seen[0].keys() | seen[1].keys())
        yield pd.DataFrame({"f": keys, "clean": [seen[0][k] for k in keys], "toxic": [seen[1][k] for k in keys]}, dtype="int64")

    n = {r["t"]: r["n"] for r in train.groupBy((F.col("toxic") > 0).cast("int").alias("t")).agg(F.count("*").alias("n")).collect()}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    if not clean or not toxic:
        return Model(Scorer(restorer.language, {}, buckets), np.zeros(0), float(np.log((toxic + 0.5) / (clean + 0.5))))
    counts = train.mapInPandas(run, "f long, clean long, toxic long").groupBy("f").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))

    def term(k, of):
        return F.when(k > 0, k * F.log(k / of)).otherwise(0.0)

    c, t = F.col("c").cast("double"), F.col("t").cast("double")
    both = c + t
    gain = term(t, both) + term(c, both) - t * np.log(toxic / (clean + toxic)) - c * np.log(clean / (clean + toxic))
    chosen = [r["f"] for r in counts.where((t / toxic > c / clean) & (gain >= least_gain)).orderBy(gain.desc(), "f").limit(keep).collect()]
    scorer = Scorer(restorer.language, {f: i for i, f in enumerate(chosen)}, buckets)
    scoring = spark.sparkContext.broadcast(scorer)

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            yield pd.DataFrame({"toxic": (df["toxic"] > 0).astype("int64"), "at": [sorted(scoring.value.features(x)) for x in df["text"]]})

    # Rows with the same hits are one with a weight.
    rows = train.mapInPandas(hits, "toxic long, at array<int>").groupBy("at").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).orderBy("at").collect()
    row = np.repeat(np.arange(len(rows)), [len(r["at"]) for r in rows])
    col = np.array([k for r in rows for k in r["at"]], np.int64)
    t, n = np.array([r["t"] for r in rows], float), np.array([r["n"] for r in rows], float)
    w, bias, rate = np.zeros(len(chosen)), float(np.log(toxic / clean)), np.zeros(len(chosen) + 1) + 1e-8
    for _ in range(400):  # AdaGrad on the whole sample
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(row, w[col], len(rows)), -30, 30)))
        error = n * p - t
        g = np.append(np.bincount(col, error[row], len(chosen)) + 0.05 * w, error.sum())
        rate += g * g
        step = 0.5 * g / np.sqrt(rate)
        w -= step[:-1]
        bias -= step[-1]
    return Model(scorer, w, bias)


def toxicity(docs: DataFrame, labels: DataFrame, at_most: int = 20_000, threshold: float = 0.7, name: str = "toxicity") -> DataFrame:
    """``docs`` with the column ``name``: score (0 to 1) and predicted (1 if the score is at least ``threshold``).

    Null and empty texts get the score of a text without any feature.  Repeated rows get equal
    scores.  ``at_most`` bounds the labelled rows that the model is fitted on.  Without labels of both classes every
    text has the same score.  No rows give none.  Texts and their parts are decoded whole, however long.
    """
    spark = docs.sparkSession
    counts = {r["at"]: r["n"] for r in trigram_counts(docs).collect()}  # at most (letters + 1) ** 3 rows
    restorer = Restorer(Language(counts))
    train = written(training_rows(docs, labels, at_most), "train")
    shared = spark.sparkContext.broadcast(fit(train, restorer))

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shared.value.score(x) for x in batch], dtype="float64")

    score = F.pandas_udf(run, "double")(F.coalesce("text", F.lit("")))
    out = docs.withColumn(name, F.struct(score.alias("score")))
    return out.withColumn(name, F.col(name).withField("predicted", (F.col(f"{name}.score") >= threshold).cast("int")))
