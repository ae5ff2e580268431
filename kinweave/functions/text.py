"""Normalised names and addresses, and the keys that come from them."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ADDRESS_STOPWORDS, ID_PREFIXES, LEGAL_TERMS


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it; a lambda's parts would each compute it again."""
    return F.transform(F.array(value), f)[0]


def _words(names: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in names])


def normalize_text(text: Column) -> Column:
    """Lower case, "ß" as "ss", every mark, symbol and control as a space, one space between words; null as ""."""
    low = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("ß"), F.lit("ss"))
    return F.trim(F.regexp_replace(F.regexp_replace(low, r"[\p{P}\p{S}\p{C}]", " "), r"(?U)\s+", " "))


def fold(text: str | None) -> str:
    """The same for one string by Unicode's own rules: compatibility forms composed, case folded."""
    if text is None or text != text:
        return ""
    low = unicodedata.normalize("NFKC", str(text)).casefold()
    return " ".join("".join(" " if unicodedata.category(c)[0] in "PSC" else c for c in low).split())


def normalize_exact(text: Column) -> Column:
    """``fold`` as a column function: the slow path, for text with compatibility forms."""

    def run(batch: pd.Series) -> pd.Series:
        return batch.map(fold, na_action=None)

    return F.pandas_udf(run, "string")(text)


def normalize_country(country: Column) -> Column:
    """Lower case without outer white space; what is inside stays."""
    return F.lower(F.regexp_replace(F.coalesce(country, F.lit("")), r"(?U)^\s+|\s+$", ""))


def with_normalized(df: DataFrame) -> DataFrame:
    """``df`` with business_name_norm, business_address_norm and country_norm; a column that it lacks counts as empty."""
    have = {c: F.col(c) if c in df.columns else F.lit("") for c in ("business_name", "business_address", "country")}
    return df.withColumns({
        "business_name_norm": normalize_text(have["business_name"]),
        "business_address_norm": normalize_text(have["business_address"]),
        "country_norm": normalize_country(have["country"]),
    })


def tokens(norm: Column) -> Column:
    """The words of a normalised text; none of an empty one."""
    return F.filter(F.split(norm, " "), lambda t: t != "")


def core_name(name: Column) -> Column:
    """``name`` without words for the kind of firm; itself if nothing else is left."""
    core = F.array_join(F.filter(tokens(name), lambda t: ~F.array_contains(_words(LEGAL_TERMS), t)), " ")
    return let(core, lambda c: F.when(c == "", name).otherwise(c))


def compact_name(name: Column) -> Column:
    """The core name without spaces."""
    return F.replace(core_name(name), F.lit(" "), F.lit(""))


def clean_number(token: Column) -> Column:
    """A token without leading zeros; "0" if it has nothing else."""
    return F.regexp_replace(token, "^0+(?=.)", "")


def address_keys(address: Column) -> Column:
    """Keys from the first two numbers and first two words of an address.

    A word has four letters or more, no digit, and is no stop word.  Each of the numbers with each of the words; the
    two numbers; the two words, if there is no number.
    """
    digit = r"\p{Nd}"

    def keys(numbers: Column, words: Column) -> Column:
        crossed = F.flatten(F.transform(numbers, lambda n: F.transform(words, lambda w: F.concat(F.lit("a_nw:"), n, F.lit("_"), w))))
        empty = F.array().cast("array<string>")
        pair = F.when(F.size(numbers) >= 2, F.array(F.concat(F.lit("a_nn:"), F.array_join(numbers, "_")))).otherwise(empty)
        bare = F.when((F.size(numbers) == 0) & (F.size(words) >= 2), F.array(F.concat(F.lit("a_ww:"), F.array_join(words, "_")))).otherwise(empty)
        return F.concat(crossed, pair, bare)

    def of(parts: Column) -> Column:
        numbers = F.slice(F.transform(F.filter(parts, lambda t: F.regexp_like(t, F.lit(digit))), clean_number), 1, 2)
        plain = F.filter(parts, lambda t: (F.length(t) >= 4) & ~F.regexp_like(t, F.lit(digit)) & ~F.array_contains(_words(ADDRESS_STOPWORDS), t))
        return let(numbers, lambda n: let(F.slice(plain, 1, 2), lambda w: keys(n, w)))

    return let(tokens(address), of)


def char_ngrams(text: Column, n: int = 3) -> Column:
    """Substrings of ``n`` characters of "^text$"; that string itself if it is shorter."""
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    last = F.length(padded) - (n - 1)
    return F.when(last < 1, F.array(padded)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(padded, i, F.lit(n))))


def token_pairs(words: Column) -> Column:
    """Pairs "a_b" of the first four of some distinct words in order: six at most."""

    def of(four: Column) -> Column:
        return F.flatten(F.transform(four, lambda a, i: F.transform(F.filter(four, lambda b, j: j > i), lambda b: F.concat(a, F.lit("_"), b))))

    return let(F.slice(F.array_sort(F.array_distinct(words)), 1, 4), of)


def parse_id_list(raw: Column) -> Column:
    """The identifiers of a comma-separated list: trimmed, without blanks, each once, in their order."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""))


def serialize_id_list(ids: Column) -> Column:
    """A list of identifiers as text: each once, sorted, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.transform(ids, lambda x: F.trim(x)), lambda x: x != ""))), ",")


def has_target_prefix(ident: Column) -> Column:
    """Whether an identifier can be a target's."""
    out = F.lit(False)
    for p in ID_PREFIXES:
        out = out | ident.startswith(p)
    return out


def id_hash(ident: Column, seed: int) -> Column:
    """A number that orders identifiers at random, and the same in every run: SHA-256 of seed and identifier, as hexadecimal."""
    return F.sha2(F.concat(F.lit(f"{seed}_"), ident), 256)
