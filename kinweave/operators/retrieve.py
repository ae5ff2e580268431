"""Candidates of queries: every rule is one equi-join on (rule, key) against bounded postings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import RULE_SCORES, BlockingConfig
from ..functions import text
from .postings import band_buckets, bands, first_rows, key_frequencies, long_tokens, postings, query_keys, target_keys
from .stored import written

SCOPE = ("shard_id",)


def _scored(df: DataFrame) -> DataFrame:
    scores = F.create_map(*[x for rule, n in RULE_SCORES.items() for x in (F.lit(rule), F.lit(n))])
    return df.withColumn("score", scores[F.col("rule")])


def rare_tokens(queries: DataFrame, frequencies: DataFrame, cfg: BlockingConfig, scope: tuple[str, ...] = SCOPE) -> DataFrame:
    """s1_id, rule, key and scope: a query's rarest words that targets have, by (frequency, word)."""
    words = queries.select("s1_id", *[c for c in scope if c in queries.columns], F.explode(long_tokens(F.col("business_name_norm"), cfg)).alias("key"))
    on = ["key", *[c for c in scope if c in words.columns]]
    seen = words.join(frequencies.where("rule = 'rare_token'"), on)
    seen = first_rows(seen, ["s1_id", *scope], ["df", "key"], cfg.blocking_max_rare_tokens_per_s1)
    return seen.where(F.col("df") <= cfg.blocking_max_token_doc_freq).select("s1_id", *scope, "rule", "key")


def _until_full(found: DataFrame, cfg: BlockingConfig, scope: tuple[str, ...], start: str | None = None) -> DataFrame:
    """Of (s1_id, entity_id, band) the bands in order until ``lsh_max_candidates`` entities are there."""
    first = found.groupBy(*scope, "s1_id", "entity_id").agg(F.min("band").alias("band"), *([F.first(start).alias(start)] if start else []))
    before = Window.partitionBy(*scope, "s1_id").orderBy("band").rangeBetween(Window.unboundedPreceding, -1)
    have = F.coalesce(F.count("entity_id").over(before), F.lit(0)) + (F.col(start) if start else F.lit(0))
    return first.withColumn("_have", have).where(F.col("_have") < cfg.lsh_max_candidates).drop("_have", "band")


def lsh_candidates(queries: DataFrame, targets: DataFrame, cfg: BlockingConfig, scope: tuple[str, ...] = SCOPE, column: str = "business_name_norm") -> DataFrame:
    """scope, s1_id, entity_id: entities that share a band's bucket.

    Bands of the query's country come first, one after the other, until enough are found.  If there
    are very few, buckets of all countries are gone through in the same way.  Of too many the smallest ids stay.
    """
    buckets = band_buckets(targets, cfg, scope, column)
    asked = written(bands(queries.select("s1_id", F.col("country_norm").alias("country"), F.col(column)), F.col(column), cfg).select("s1_id", "country", "band", "key"), "asked")
    near = asked.where("country != ''").join(buckets.where("reach = 'country'").drop("reach"), ["country", "band", "key"]).select(*scope, "s1_id", "entity_id", "band")
    near = written(_until_full(near, cfg, scope), "near")
    got = near
    if cfg.blocking_soft_country_mode:
        counts = near.groupBy(*scope, "s1_id").agg(F.count("*").alias("start"))
        far = asked.join(buckets.where("reach = 'global'").drop("reach", "country"), ["band", "key"]).select(*scope, "s1_id", "entity_id", "band")
        far = far.join(counts, [*scope, "s1_id"], "left").withColumn("start", F.coalesce("start", F.lit(0))).where(F.col("start") < cfg.lsh_min_before_fallback)
        far = far.join(near, [*scope, "s1_id", "entity_id"], "left_anti")
        got = near.unionByName(_until_full(far, cfg, scope, "start").drop("start"))
    return first_rows(got, [*scope, "s1_id"], ["entity_id"], cfg.lsh_max_candidates)


def scored_matches(queries: DataFrame, targets: DataFrame, cfg: BlockingConfig | None = None) -> DataFrame:
    """shard_id, s1_id, candidate_id, source_dataset, rule_name, score: each candidate's best rule in each shard.

    ``queries`` has s1_id and the normalised columns; ``targets`` has entity_id, source, ord, shard_id
    and the normalised columns.  Frequencies, caps and the prefix rule's trigger are per shard.
    """
    cfg = cfg or BlockingConfig()
    targets = written(targets.select("shard_id", "entity_id", "source", "ord", "business_name_norm", "business_address_norm", "country_norm"), "targets")
    queries = written(queries.select("s1_id", "business_name_norm", "business_address_norm", "country_norm"), "queries")
    rows = targets.drop("source")
    keys = written(target_keys(rows, cfg), "keys")
    posted = written(postings(rows, cfg, SCOPE, keys).select(*SCOPE, "rule", "key", "entity_id"), "postings")
    plain = query_keys(queries, cfg).join(posted.where("rule != 'prefix_safety_net'"), ["rule", "key"]).select(*SCOPE, "s1_id", "entity_id", "rule")
    found = [plain]
    if "rare_token" in cfg.rules:
        frequencies = key_frequencies(keys.where("rule = 'rare_token'"), SCOPE)
        found.append(rare_tokens(queries, frequencies, cfg).join(posted, [*SCOPE, "rule", "key"]).select(*SCOPE, "s1_id", "entity_id", "rule"))
    if "minhash_lsh" in cfg.rules:
        found.append(lsh_candidates(queries, rows, cfg).withColumn("rule", F.lit("minhash_lsh")))
    best = _best(reduce(DataFrame.unionByName, found))
    if "prefix_safety_net" in cfg.rules:
        best = written(best, "best")
        # Queries with few candidates, none included: all queries with all shards, less those that have enough.
        enough = best.groupBy(*SCOPE, "s1_id").agg(F.count("*").alias("n")).where(F.col("n") >= cfg.blocking_fuzzy_min_cands)
        name = F.col("business_name_norm")
        prefix = queries.where(name != "").select("s1_id", F.substring(name, 1, 4).alias("key"))
        more = prefix.join(posted.where("rule = 'prefix_safety_net'"), "key").join(enough, [*SCOPE, "s1_id"], "left_anti")
        best = _best(best.select(*SCOPE, "s1_id", "entity_id", "rule").unionByName(more.select(*SCOPE, "s1_id", "entity_id", "rule")))
    sources = targets.select("shard_id", "entity_id", "source")
    return best.join(sources, [*SCOPE, "entity_id"]).select(*SCOPE, "s1_id", F.col("entity_id").alias("candidate_id"), F.col("source").alias("source_dataset"), F.col("rule").alias("rule_name"), "score")


def _best(matches: DataFrame) -> DataFrame:
    """One row a candidate: its highest score and that score's rule (all rules' scores differ)."""
    return _scored(matches).groupBy(*SCOPE, "s1_id", "entity_id").agg(F.max_by("rule", "score").alias("rule"), F.max("score").alias("score"))


def shard_capped(matches: DataFrame, cfg: BlockingConfig | None = None) -> DataFrame:
    """The best candidates of each query in each shard, by score and id."""
    cfg = cfg or BlockingConfig()
    return first_rows(matches, ["shard_id", "s1_id"], [F.desc("score"), "candidate_id"], cfg.blocking_per_shard_candidate_cap)


def merged_candidates(matches: DataFrame, cfg: BlockingConfig | None = None) -> DataFrame:
    """s1_id, candidate_id, source_dataset, rule_name, score over all shards: the highest score, the earliest
    shard of equal ones, and the best candidates of each query by score and id."""
    cfg = cfg or BlockingConfig()
    one = first_rows(matches, ["s1_id", "candidate_id"], [F.desc("score"), "shard_id"], 1)
    return first_rows(one, ["s1_id"], [F.desc("score"), "candidate_id"], cfg.blocking_max_candidates_per_s1).drop("shard_id")


#: Rules that drop no key for its frequency and give a target one key at most.
_PLAIN = {"exact_name", "core_name", "compact_name"}


def scored_candidates(queries: DataFrame, targets: DataFrame, cfg: BlockingConfig | None = None, only: DataFrame | None = None, alone: DataFrame | None = None) -> DataFrame:
    """scored_matches, capped for each shard and merged.

    With ``only`` (s1_id, candidate_id) those of its pairs, and of the queries ``alone`` (s1_id) one candidate each, if they have any.  Where
    no bound can be reached, others are not formed: a query has no more candidates, and a key no more postings, than there are targets.
    """
    cfg = cfg or BlockingConfig()
    if only is None:
        return merged_candidates(shard_capped(scored_matches(queries, targets, cfg), cfg), cfg)
    alone = queries.select("s1_id").limit(0) if alone is None else alone
    least = min(cfg.blocking_max_posting_len, cfg.blocking_per_shard_candidate_cap, cfg.blocking_max_candidates_per_s1)
    if not _PLAIN.issuperset(cfg.rules) or targets.count() > least:
        got = written(scored_candidates(queries, targets, cfg), "candidates")
        one = first_rows(got.join(alone.distinct(), "s1_id", "left_semi"), ["s1_id"], ["candidate_id"], 1)
        return got.join(only, ["s1_id", "candidate_id"], "left_semi").unionByName(one).distinct()
    columns = ("business_name_norm", "business_address_norm")
    keys = written(target_keys(targets.select(*SCOPE, "entity_id", "source", *columns), cfg).drop(*columns), "keys")
    asked = written(query_keys(queries.select("s1_id", *columns), cfg), "asked")
    least = keys.groupBy("rule", "key").agg(F.min("entity_id").alias("candidate_id"))
    one = asked.join(alone.distinct(), "s1_id").join(least, ["rule", "key"]).groupBy("s1_id").agg(F.min("candidate_id").alias("candidate_id"))
    pairs = only.select("s1_id", "candidate_id").unionByName(one).distinct()
    found = pairs.join(asked, "s1_id").join(keys.withColumnRenamed("entity_id", "candidate_id"), ["candidate_id", "rule", "key"])
    best = _scored(found).groupBy(*SCOPE, "s1_id", "candidate_id", F.col("source").alias("source_dataset")).agg(F.max_by("rule", "score").alias("rule_name"), F.max("score").alias("score"))
    return merged_candidates(best, cfg)


def _union_keys(df: DataFrame, cfg: BlockingConfig, is_query: bool) -> DataFrame:
    """Keys of the union engine, by country: id, country_norm, rule, space (whose postings a key asks), key."""
    name, address = F.col("business_name_norm"), F.col("business_address_norm")
    core, compact = text.core_name(name), text.compact_name(name)

    def entry(rule: str, space: str, keys):
        return F.transform(keys, lambda k: F.struct(F.lit(rule).alias("rule"), F.lit(space).alias("space"), k.alias("key")))

    def one(key, when):
        return F.when(when, F.array(key)).otherwise(F.array().cast("array<string>"))

    parts = [
        entry("exact_name", "exact", one(name, name != "")),
        entry("core_name", "core", one(core, (core != "") & (F.lit(is_query) | (core != name)))),
        entry("compact_name", "compact", one(compact, F.length(compact) >= 5)),
        entry("address_key", "address", text.address_keys(address)),
        entry("prefix_safety_net", "prefix", one(F.substring(core, 1, 4), F.length(core) >= 4)),
    ]
    if is_query:  # a core name also asks for targets whose whole name it is
        parts.append(entry("core_name", "exact", one(core, core != "")))
    return df.select("id", "country_norm", *(["ord"] if not is_query else []), F.explode(F.concat(*parts)).alias("k")).select("id", "country_norm", *(["ord"] if not is_query else []), "k.*")


def union_candidates(queries: DataFrame, targets: DataFrame, cfg: BlockingConfig | None = None) -> DataFrame:
    """s1_id, candidate_id, source_dataset, provenance_rules (sorted, comma-joined), truncated: the union of all rules within a country.

    Over the cap the candidates with the smallest ids stay.
    """
    cfg = cfg or BlockingConfig()
    q = written(queries.select(F.col("s1_id").alias("id"), "country_norm", "business_name_norm", "business_address_norm"), "queries")
    targets = written(targets.select("entity_id", "source", "ord", "country_norm", "business_name_norm", "business_address_norm"), "targets")
    t = targets.select(F.col("entity_id").alias("id"), "ord", "country_norm", "business_name_norm", "business_address_norm")
    by = ["country_norm", "space", "key"]
    keys = written(_union_keys(t, cfg, False), "keys")
    often = keys.where("space = 'address'").groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") > cfg.blocking_max_addr_key_freq)
    wide = keys.where("space = 'prefix'").groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") > cfg.blocking_safety_net_max_bucket)
    keys = keys.join(often.unionByName(wide).drop("n"), by, "left_anti")
    keys = first_rows(keys, by, ["ord", "id"], cfg.blocking_max_posting_len).select(*by, F.col("id").alias("cid"))
    asked = _union_keys(q, cfg, True)
    found = asked.where("space != 'prefix'").join(keys, by).select("id", "cid", "rule")
    # Words: frequencies count every word of a target, short ones too.
    words = t.select("id", "ord", "country_norm", F.explode(F.array_distinct(text.tokens(F.col("business_name_norm")))).alias("key"))
    df = words.groupBy("country_norm", "key").agg(F.count("*").alias("df"))
    rare = words.where(F.length("key") >= cfg.blocking_min_token_len).join(df.where(F.col("df") <= cfg.blocking_max_token_doc_freq), ["country_norm", "key"])
    rare = first_rows(rare, ["country_norm", "key"], ["ord", "id"], cfg.blocking_max_posting_len).select("country_norm", "key", F.col("id").alias("cid"))
    own = q.select("id", "country_norm", F.explode(long_tokens(F.col("business_name_norm"), cfg)).alias("key")).join(df, ["country_norm", "key"])
    own = first_rows(own, ["id"], ["df", "key"], cfg.blocking_max_rare_tokens_per_s1).where(F.col("df") <= cfg.blocking_max_token_doc_freq)
    found = found.unionByName(own.join(rare, ["country_norm", "key"]).select("id", "cid", F.lit("rare_token").alias("rule")))
    # Word pairs: of words that are not too frequent, unseen ones included.
    too = df.where(F.col("df") > cfg.blocking_max_pair_token_freq).select("country_norm", "key")

    def pairs(x: DataFrame, extra: list[str]) -> DataFrame:
        each = x.select("id", "country_norm", *extra, F.explode(long_tokens(F.col("business_name_norm"), cfg)).alias("key")).join(too, ["country_norm", "key"], "left_anti")
        four = each.groupBy("id", "country_norm", *extra).agg(F.collect_set("key").alias("w"))
        return four.select("id", "country_norm", *extra, F.explode(text.token_pairs(F.col("w"))).alias("key"))

    posted = first_rows(pairs(t, ["ord"]), ["country_norm", "key"], ["ord", "id"], cfg.blocking_max_posting_len).select("country_norm", "key", F.col("id").alias("cid"))
    found = found.unionByName(pairs(q, []).join(posted, ["country_norm", "key"]).select("id", "cid", F.lit("token_pair").alias("rule")))
    # MinHash on core names; a country's index holds its own targets only, so the wider buckets add nothing else.
    core = text.core_name(F.col("business_name_norm"))
    lsh = lsh_candidates(
        q.withColumnRenamed("id", "s1_id").withColumn("core", core), t.withColumnRenamed("id", "entity_id").withColumn("core", core).withColumn("shard_id", F.col("country_norm")),
        cfg, ("shard_id",), "core",
    )
    lsh = lsh.join(q.select(F.col("id").alias("s1_id"), F.col("country_norm").alias("shard_id")), ["s1_id", "shard_id"])
    found = found.unionByName(lsh.select(F.col("s1_id").alias("id"), F.col("entity_id").alias("cid"), F.lit("minhash_lsh").alias("rule")))
    found = written(found.where(F.col("rule").isin(*cfg.rules)).distinct(), "found")
    if "prefix_safety_net" in cfg.rules:
        enough = found.groupBy("id").agg(F.countDistinct("cid").alias("n")).where(F.col("n") >= cfg.blocking_fuzzy_min_cands)
        found = found.unionByName(asked.where("space = 'prefix'").join(enough, "id", "left_anti").join(keys, by).select("id", "cid", "rule"))
    each = found.groupBy("id", "cid").agg(F.array_join(F.array_sort(F.collect_set("rule")), ",").alias("provenance_rules"))
    counts = each.groupBy("id").agg(F.count("*").alias("n"))
    kept = first_rows(each, ["id"], ["cid"], cfg.blocking_max_candidates_per_s1).join(counts, "id")
    sources = targets.select(F.col("entity_id").alias("cid"), F.col("source").alias("source_dataset"))
    return kept.join(sources, "cid").select(F.col("id").alias("s1_id"), F.col("cid").alias("candidate_id"), "source_dataset", "provenance_rules", (F.col("n") > cfg.blocking_max_candidates_per_s1).alias("truncated"))


def candidate_lists(queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """source1_entity_id, candidate_entity_ids: one row for each query, its sorted candidates joined by commas, "" for none."""
    lists = pairs.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("candidate_id")), ",").alias("ids"))
    return queries.select("s1_id").join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("candidate_entity_ids"))
