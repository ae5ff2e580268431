"""MinHash signatures over character n-grams, in 64-bit integers that any SQL engine can follow."""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import char_ngrams, let

PRIME = (1 << 31) - 1


def permutations(n: int, seed: int = 42) -> list[tuple[int, int]]:
    """``n`` pairs (a, b) of h -> (a * h + b) mod PRIME.  With 28-bit h the product stays within 63 bits."""
    draw = random.Random(seed)
    return [(draw.randrange(1, PRIME), draw.randrange(PRIME)) for _ in range(n)]


def shingle_hashes(text: Column, n: int = 3) -> Column:
    """28 bits of MD5 of each distinct n-gram."""
    return F.transform(F.array_distinct(char_ngrams(text, n)), lambda g: F.conv(F.substring(F.md5(g.cast("binary")), 1, 7), 16, 10).cast("long"))


def signature(hashes: Column, n_permutations: int = 32, seed: int = 42) -> Column:
    """The least value of each permutation."""
    return F.array(*[F.array_min(_permuted(hashes, a, b)) for a, b in permutations(n_permutations, seed)])


def _permuted(hashes: Column, a: int, b: int) -> Column:
    return F.transform(hashes, lambda h: (h * F.lit(a).cast("long") + F.lit(b).cast("long")) % F.lit(PRIME).cast("long"))


def band_keys(text: Column, n_permutations: int = 32, n_bands: int = 8, n: int = 3, seed: int = 42) -> Column:
    """An array with a key for each band: its number and its part of the signature."""
    rows = n_permutations // n_bands

    def cut(sig: Column) -> Column:
        return F.array(*[F.concat_ws("_", F.lit(b).cast("string"), *[sig[b * rows + k].cast("string") for k in range(rows)]) for b in range(n_bands)])

    return let(shingle_hashes(text, n), lambda hashes: let(signature(hashes, n_permutations, seed), cut))
