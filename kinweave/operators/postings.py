"""Blocking keys in long form, their frequencies, and bounded postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import BlockingConfig
from ..functions import minhash, text
from .stored import written

#: Rules whose keys are dropped when too many records have them.
FREQUENCY_RULES = ("rare_token", "token_pair", "address_key")


def _each(rule: str, keys: Column) -> Column:
    return F.transform(keys, lambda k: F.struct(F.lit(rule).alias("rule"), k.alias("key")))


def _one(key: Column, when: Column) -> Column:
    return F.when(when, F.array(key)).otherwise(F.array().cast("array<string>"))


def long_tokens(name: Column, cfg: BlockingConfig) -> Column:
    """The distinct words of a name that are long enough to be keys."""
    return F.array_distinct(F.filter(text.tokens(name), lambda t: F.length(t) >= cfg.blocking_min_token_len))


def target_keys(targets: DataFrame, cfg: BlockingConfig) -> DataFrame:
    """rule, key and the columns of ``targets``, for all rules but MinHash: one explode of one array.

    Names give their own text, the core if it differs, the compact core from 5 letters on, distinct
    words, word pairs and a 4-letter prefix; addresses give their keys, repeats included.
    """
    name, address = F.col("business_name_norm"), F.col("business_address_norm")
    core, compact = text.core_name(name), text.compact_name(name)
    words = long_tokens(name, cfg)
    every = {
        "exact_name": _one(name, name != ""),
        "core_name": _one(core, (core != "") & (core != name)),
        "compact_name": _one(compact, F.length(compact) >= 5),
        "rare_token": words,
        "token_pair": text.token_pairs(words),
        "address_key": text.address_keys(address),
        "prefix_safety_net": _one(F.substring(name, 1, 4), F.length(name) >= 4),
    }
    chosen = [_each(rule, keys) for rule, keys in every.items() if rule in cfg.rules]
    if not chosen:
        return targets.select(*targets.columns, F.lit("").alias("rule"), F.lit("").alias("key")).limit(0)
    return targets.select(*targets.columns, F.explode(F.concat(*chosen)).alias("k")).select(*targets.columns, "k.rule", "k.key")


def query_keys(queries: DataFrame, cfg: BlockingConfig) -> DataFrame:
    """s1_id, rule, key of the query side: every rule that needs no frequencies.  Word pairs come from
    all distinct words here, short ones too."""
    name, address = F.col("business_name_norm"), F.col("business_address_norm")
    core, compact = text.core_name(name), text.compact_name(name)
    every = {
        "exact_name": _one(name, name != ""),
        "core_name": _one(core, core != ""),
        "compact_name": _one(compact, compact != ""),
        "token_pair": text.token_pairs(text.tokens(name)),
        "address_key": text.address_keys(address),
    }
    chosen = [_each(rule, keys) for rule, keys in every.items() if rule in cfg.rules]
    if not chosen:
        return queries.select("s1_id", F.lit("").alias("rule"), F.lit("").alias("key")).limit(0)
    return queries.select("s1_id", F.explode(F.array_distinct(F.concat(*chosen))).alias("k")).select("s1_id", "k.rule", "k.key")


def key_frequencies(keys: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """df: how many rows a key has, within ``scope``.  A plain aggregate, so tasks sum up before they shuffle."""
    return keys.groupBy(*scope, "rule", "key").agg(F.count("*").alias("df"))


def first_rows(keys: DataFrame, by: list[str], order: list, most: int) -> DataFrame:
    """The first ``most`` rows of each group.  The limit is a literal, so Spark cuts each task's groups before the shuffle."""
    return keys.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rank") <= most).drop("_rank")


def postings(targets: DataFrame, cfg: BlockingConfig, scope: tuple[str, ...] = (), keys: DataFrame | None = None) -> DataFrame:
    """target_keys without over-frequent keys, and of each key the first postings in the order of ``ord`` and entity_id.

    The keys to drop are aggregated first and removed by an anti-join, so that no group of a window
    is as large as the most frequent word's.  ``keys`` are the targets' keys, if they are written already.
    """
    keys = written(target_keys(targets, cfg), "keys") if keys is None else keys
    limit = F.create_map(*[x for rule, n in (("rare_token", cfg.blocking_max_token_doc_freq), ("token_pair", cfg.blocking_max_pair_token_freq), ("address_key", cfg.blocking_max_addr_key_freq)) for x in (F.lit(rule), F.lit(n))])
    often = key_frequencies(keys.where(F.col("rule").isin(*FREQUENCY_RULES)), scope).where(F.col("df") > limit[F.col("rule")]).drop("df")
    kept = keys.join(often, [*scope, "rule", "key"], "left_anti")
    caps = {"token_pair": cfg.blocking_max_pair_token_freq, "prefix_safety_net": cfg.blocking_safety_net_max_bucket}
    at = Window.partitionBy(*scope, "rule", "key").orderBy("ord", "entity_id")
    # The largest cap is a literal, which cuts each task's groups before the shuffle; a rule's own cap follows.
    ranked = kept.withColumn("_rank", F.row_number().over(at)).where(F.col("_rank") <= max(cfg.blocking_max_posting_len, *caps.values()))
    own = F.when(F.col("rule") == "token_pair", caps["token_pair"]).when(F.col("rule") == "prefix_safety_net", caps["prefix_safety_net"]).otherwise(cfg.blocking_max_posting_len)
    return ranked.where(F.col("_rank") <= own).drop("_rank")


def bands(df: DataFrame, column: Column, cfg: BlockingConfig) -> DataFrame:
    """``df`` with a row for each band: band (its number) and key.  Empty text has none."""
    keys = minhash.band_keys(column, cfg.lsh_num_permutations, cfg.lsh_num_bands, cfg.lsh_shingle_n)
    return df.where(column != "").select(*df.columns, F.posexplode(keys).alias("band", "key"))


def band_buckets(targets: DataFrame, cfg: BlockingConfig, scope: tuple[str, ...] = (), column: str = "business_name_norm") -> DataFrame:
    """MinHash postings: reach ("country" or "global"), country, band, key, entity_id; of each bucket the first."""
    rows = written(bands(targets, F.col(column), cfg).select(*scope, "entity_id", "ord", F.col("country_norm").alias("country"), "band", "key"), "bands")
    near = first_rows(rows, [*scope, "country", "band", "key"], ["ord", "entity_id"], cfg.lsh_max_bucket_size).withColumn("reach", F.lit("country"))
    far = first_rows(rows, [*scope, "band", "key"], ["ord", "entity_id"], cfg.lsh_max_bucket_size).withColumn("reach", F.lit("global"))
    return near.unionByName(far).drop("ord")
