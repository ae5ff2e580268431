"""One query for each operator, over entities derived from the test tables, with its oracle.

Caps are small enough here that they fire on the smallest tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BlockingConfig
from ..functions import minhash, text
from ..operators import evaluate, features, postings, profile, retrieve, sampling, validate
from ..operators.stored import written
from . import fixtures, oracle

SMALL = BlockingConfig(
    blocking_max_token_doc_freq=20, blocking_max_posting_len=10, blocking_max_pair_token_freq=30, blocking_max_addr_key_freq=5,
    lsh_max_bucket_size=10, lsh_max_candidates=8, blocking_safety_net_max_bucket=6, blocking_per_shard_candidate_cap=5, blocking_max_candidates_per_s1=6,
)
SHARDS = 2
_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    def put(f):
        _QUERIES[f.__name__] = (f, sql)
        return f

    return put


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.entities(spark, sf_dir).withColumns({"name": F.col("business_name_norm"), "addr": F.col("business_address_norm")})


@query(f"WITH {oracle.ENT} SELECT entity_id, name AS business_name_norm, addr AS business_address_norm FROM ent")
def normalize_name(spark, sf_dir):
    return _entities(spark, sf_dir).select("entity_id", "business_name_norm", "business_address_norm")


@query(None)
def normalize_exact(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", text.normalize_exact(F.col("text")).alias("norm"))


@query("SELECT doc_id, lower(trim(lang)) AS country_norm FROM documents")
def normalize_country(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", text.normalize_country(F.concat(F.lit("  "), F.upper("lang"), F.lit(" "))).alias("country_norm"))


@query(f"WITH {oracle.KEYED} SELECT entity_id, core AS core_name, compact AS compact_name FROM k")
def core_compact_name(spark, sf_dir):
    return _entities(spark, sf_dir).select("entity_id", text.core_name(F.col("name")).alias("core_name"), text.compact_name(F.col("name")).alias("compact_name"))


@query(f"WITH {oracle.KEYED} SELECT entity_id, array_to_string(akeys, '|') AS keys FROM k")
def address_keys(spark, sf_dir):
    return _entities(spark, sf_dir).select("entity_id", F.array_join(text.address_keys(F.col("addr")), "|").alias("keys"))


@query(f"WITH {oracle.KEYED} SELECT entity_id, array_to_string({oracle._NGRAMS.format('name')}, '|') AS grams FROM k")
def char_ngrams(spark, sf_dir):
    return _entities(spark, sf_dir).select("entity_id", F.array_join(text.char_ngrams(F.col("name")), "|").alias("grams"))


@query("""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(lang || ', ' || source || ' ,,' || lang, ','), lambda x: trim(x)), lambda x: x <> ''))), ',') AS ids FROM documents""")
def parse_serialize_ids(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = F.concat("lang", F.lit(", "), "source", F.lit(" ,,"), "lang")
    return docs.select("doc_id", text.serialize_id_list(text.parse_id_list(raw)).alias("ids"))


def _targets(spark, sf_dir, shards: int = 1) -> DataFrame:
    rows = fixtures.queries_and_targets(spark, sf_dir, shards)[1]
    return rows.select("shard_id", "entity_id", "ord", "business_name_norm", "business_address_norm", "country_norm")


def _frequency(rule: str):
    def run(spark, sf_dir):
        return postings.key_frequencies(postings.target_keys(_targets(spark, sf_dir), BlockingConfig()).where(F.col("rule") == rule)).select("key", "df")

    return run


for _name, _rule in (("token_doc_freq", "rare_token"), ("pair_doc_freq", "token_pair"), ("addr_key_freq", "address_key")):
    _QUERIES[_name] = (_frequency(_rule), f"WITH {oracle.target_keys(1)} SELECT key, df FROM freq WHERE rule = '{_rule}'")


@query(f"WITH {oracle.posted(SMALL, SHARDS)} SELECT shard_id, rule, key, entity_id FROM post")
def posting_cap(spark, sf_dir):
    return postings.postings(_targets(spark, sf_dir, SHARDS), SMALL, ("shard_id",)).select("shard_id", "rule", "key", "entity_id")


def _rule(rule: str):
    cfg = BlockingConfig(**{**SMALL.__dict__, "rules": (rule,)})

    def run(spark, sf_dir):
        q, t = fixtures.queries_and_targets(spark, sf_dir)
        return retrieve.scored_matches(q, t, cfg).select("s1_id", "candidate_id")

    return run


_SMALL_MATCHES = oracle.matched(SMALL, 1)
for _name, _one in (("rule_exact", "exact_name"), ("rule_core", "core_name"), ("rule_compact", "compact_name"), ("rule_address", "address_key"), ("rule_rare_token", "rare_token"), ("rule_token_pair", "token_pair"), ("rule_lsh_soft_country", "minhash_lsh")):
    _QUERIES[_name] = (_rule(_one), f"WITH {_SMALL_MATCHES} SELECT s1_id, entity_id AS candidate_id FROM m0 WHERE rule = '{_one}'")


@query(f"WITH {_SMALL_MATCHES} SELECT s1_id, cid AS candidate_id FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, shard_id ORDER BY cid) AS rn FROM near) WHERE rn <= {SMALL.lsh_max_candidates}")
def rule_lsh(spark, sf_dir):
    q, t = fixtures.queries_and_targets(spark, sf_dir)
    hard = BlockingConfig(**{**SMALL.__dict__, "blocking_soft_country_mode": False, "lsh_max_candidates": SMALL.lsh_max_candidates})
    return retrieve.lsh_candidates(q, t, hard).select("s1_id", F.col("entity_id").alias("candidate_id"))


@query(f"WITH {_SMALL_MATCHES} SELECT id AS entity_id, band, key FROM bnd")
def minhash_bands(spark, sf_dir):
    rows = _entities(spark, sf_dir).select("entity_id", "name")
    return postings.bands(rows, F.col("name"), BlockingConfig()).select("entity_id", "band", "key")


@query(f"WITH {_SMALL_MATCHES} SELECT s1_id, entity_id AS candidate_id FROM m WHERE rule = 'prefix_safety_net' AND (s1_id, entity_id) NOT IN (SELECT s1_id, entity_id FROM m0)")
def rule_prefix_net(spark, sf_dir):
    q, t = fixtures.queries_and_targets(spark, sf_dir)
    return retrieve.scored_matches(q, t, SMALL).where("rule_name = 'prefix_safety_net'").select("s1_id", "candidate_id")


_SHARDED = oracle.matched(SMALL, SHARDS)


@query(f"WITH {_SHARDED} SELECT shard_id, s1_id, candidate_id, source_dataset, rule_name, score FROM shardcap")
def shard_capped_candidates(spark, sf_dir):
    q, t = fixtures.queries_and_targets(spark, sf_dir, SHARDS)
    return retrieve.shard_capped(retrieve.scored_matches(q, t, SMALL), SMALL)


@query(f"WITH {_SHARDED} SELECT s1_id, candidate_id, source_dataset, rule_name, score FROM merged")
def scored_candidates_topk(spark, sf_dir):
    q, t = fixtures.queries_and_targets(spark, sf_dir, SHARDS)
    return retrieve.scored_candidates(q, t, SMALL)


@query(f"WITH {oracle.matched(BlockingConfig(), 1)} SELECT s1_id, candidate_id, source_dataset, rule_name, score FROM merged")
def scored_candidates_default(spark, sf_dir):
    q, t = fixtures.queries_and_targets(spark, sf_dir)
    return retrieve.scored_candidates(q, t)


@query(f"WITH {oracle.unioned(SMALL)} SELECT s1_id, candidate_id, source_dataset, provenance_rules, truncated FROM kept")
def union_candidates_provenance(spark, sf_dir):
    q, t = fixtures.queries_and_targets(spark, sf_dir)
    return retrieve.union_candidates(q, t, SMALL)


_EXACT_PAIRS = f"WITH {oracle.KEYED}, q AS (SELECT entity_id AS s1_id, * FROM k WHERE source = 'source1'), p AS (SELECT q.s1_id, t.entity_id AS candidate_id FROM q JOIN k t ON t.source <> 'source1' AND t.name = q.name AND q.name <> '')"


def _written_entities(spark, sf_dir) -> DataFrame:
    rows = fixtures.entities(spark, sf_dir)
    return written(rows.select("entity_id", "source", "ord", "business_name_norm", "business_address_norm", "country_norm"), "entities")


def _exact_pairs(spark, sf_dir, every: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    q, t = fixtures.queries_and_targets(spark, sf_dir, every=every)
    pairs = q.where("business_name_norm != ''").select("s1_id", "business_name_norm").join(t.select(F.col("entity_id").alias("candidate_id"), "business_name_norm"), "business_name_norm")
    return q, pairs.select("s1_id", "candidate_id")


@query(_EXACT_PAIRS + " SELECT q.s1_id AS source1_entity_id, coalesce(string_agg(candidate_id, ',' ORDER BY candidate_id), '') AS candidate_entity_ids FROM q LEFT JOIN p USING (s1_id) GROUP BY q.s1_id")
def candidate_pairs_list(spark, sf_dir):
    return retrieve.candidate_lists(*_exact_pairs(spark, sf_dir))


@query(_EXACT_PAIRS + """, n AS (SELECT q.s1_id, count(candidate_id) AS n FROM q LEFT JOIN p USING (s1_id) GROUP BY ALL)
SELECT count(*) AS queries, round(avg(n), 6) AS mean, quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.9) AS p90, quantile_cont(n, 0.95) AS p95, quantile_cont(n, 0.99) AS p99, max(n) AS most,
  count_if(n = 0) AS empty, round(count_if(n = 0) / count(*), 6) AS empty_rate, count_if(n >= 5) AS "full", round(count_if(n >= 5) / count(*), 6) AS full_rate FROM n""")
def candidate_stats(spark, sf_dir):
    got = evaluate.candidate_stats(*_exact_pairs(spark, sf_dir), 5)
    return got.withColumns({c: F.round(c, 6) for c in ("mean", "empty_rate", "full_rate")})


@query(_EXACT_PAIRS + f""", {oracle.TRUTH}, w AS (SELECT s1_id, unnest(ids) AS candidate_id FROM tr),
h AS (SELECT w.s1_id, w.candidate_id, p.candidate_id IS NOT NULL AS hit FROM w LEFT JOIN (SELECT DISTINCT * FROM p) p ON p.s1_id = w.s1_id AND p.candidate_id = w.candidate_id),
e AS (SELECT s1_id, bool_and(hit) AS all_hit FROM h GROUP BY 1)
SELECT count(*) AS total_pairs, count_if(hit) AS found_pairs, round(count_if(hit) / count(*), 6) AS pair_recall,
  round(count_if(hit AND candidate_id LIKE 'S2-%') / count_if(candidate_id LIKE 'S2-%'), 6) AS s2_recall, round(count_if(hit AND candidate_id LIKE 'S3-%') / count_if(candidate_id LIKE 'S3-%'), 6) AS s3_recall,
  (SELECT count(*) FROM e) AS entities, round((SELECT count_if(all_hit) / count(*) FROM e), 6) AS full_coverage,
  (SELECT count(*) FROM tr WHERE len(ids) = 0) AS empty_truth, (SELECT count(*) FROM tr WHERE len(ids) = 0 AND s1_id IN (SELECT s1_id FROM p)) AS empty_truth_with_candidates FROM h""")
def recall_metrics(spark, sf_dir):
    got = evaluate.recall_metrics(fixtures.truth(spark, sf_dir), _exact_pairs(spark, sf_dir)[1])
    return got.withColumns({c: F.round(c, 6) for c in ("pair_recall", "s2_recall", "s3_recall", "full_coverage")})


@query(_EXACT_PAIRS + f""", {oracle.TRUTH}, pl AS (SELECT s1_id, list(DISTINCT candidate_id) AS pred FROM p GROUP BY 1),
j AS (SELECT tr.s1_id, len(ids) AS t, coalesce(len(pred), 0) AS n, coalesce(len(list_intersect(ids, pred)), 0) AS tp FROM tr LEFT JOIN pl USING (s1_id)),
x AS (SELECT *, CASE WHEN n = 0 THEN 1.0 WHEN t = 0 THEN 0.0 ELSE tp / n END AS pr, CASE WHEN t = 0 THEN 1.0 WHEN n = 0 THEN 0.0 ELSE tp / t END AS rc FROM j),
y AS (SELECT *, CASE WHEN t = 0 AND n = 0 THEN 1.0 WHEN t = 0 OR n = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * pr * rc / (0.25 * pr + rc) END AS f FROM x)
SELECT count(*) AS entities, round(avg(pr), 6) AS macro_precision, round(avg(rc), 6) AS macro_recall, round(avg(f), 6) AS macro_f,
  round(sum(tp) / sum(n), 6) AS micro_precision, round(sum(tp) / sum(t), 6) AS micro_recall, round(count_if(t = 0 AND n = 0) / count_if(t = 0), 6) AS singleton_accuracy FROM y""")
def entity_macro_f05(spark, sf_dir):
    pairs = _exact_pairs(spark, sf_dir)[1].groupBy("s1_id").agg(F.collect_set("candidate_id").alias("ids"))
    got = evaluate.evaluate_predictions(fixtures.truth(spark, sf_dir), pairs)
    return got.withColumns({c: F.round(c, 6) for c in got.columns if c != "entities"})


@query(f"""WITH {oracle.TRUTH}, l AS (SELECT s1_id, ids FROM tr WHERE CAST(substr(s1_id, 4) AS BIGINT) % 2 = 0 UNION ALL SELECT 'S1-x', ['S9-1', 'S2-1', 'S2-1']),
v AS (SELECT s1_id, unnest(ids) AS t FROM l)
SELECT 'columns' AS "check", 0 AS n, NULL AS sample UNION ALL SELECT 'empty_id', 0, NULL UNION ALL SELECT 'duplicate_id', 0, NULL
UNION ALL SELECT 'duplicate_target', 1, 'S1-x' UNION ALL SELECT 'bad_prefix', 1, 'S9-1'
UNION ALL SELECT 'missing', count(*), min(s1_id) FROM tr WHERE s1_id NOT IN (SELECT s1_id FROM l)
UNION ALL SELECT 'unexpected', count(*), min(s1_id) FROM (SELECT DISTINCT s1_id FROM l) WHERE s1_id NOT IN (SELECT s1_id FROM tr)
UNION ALL SELECT 'not_candidate', 3, 'S1-x S2-1'""")
def validate_candidates(spark, sf_dir):
    truth = fixtures.truth(spark, sf_dir)
    half = truth.where(F.get(F.split("s1_id", "-"), F.lit(1)).try_cast("long") % 2 == 0).select("s1_id", F.col("ids").alias("raw"))
    lists = half.unionByName(spark.sql("SELECT 'S1-x' AS s1_id, array('S9-1', 'S2-1', 'S2-1') AS raw")).withColumn("n_columns", F.lit(2))
    return validate.violations(lists, truth.select(F.col("s1_id").alias("entity_id")), truth)


@query(f"WITH {oracle.ENT} SELECT entity_id FROM ent ORDER BY sha256('42_' || entity_id), entity_id LIMIT 100")
def hash_sample(spark, sf_dir):
    return sampling.hash_sample(fixtures.entities(spark, sf_dir), 100).select("entity_id")


_SPLIT = f"WITH {oracle.ENT}, o AS (SELECT entity_id, row_number() OVER (ORDER BY sha256('42_' || entity_id), entity_id) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT entity_id FROM ent WHERE source = 'source1')), sp AS (SELECT entity_id, CASE WHEN i < CAST(floor(n * 0.7) AS BIGINT) THEN 'train' WHEN i < CAST(floor(n * 0.7) AS BIGINT) + CAST(floor(n * 0.15) AS BIGINT) THEN 'calibration' ELSE 'validation' END AS split FROM o)"


@query(_SPLIT + " SELECT * FROM sp")
def entity_split(spark, sf_dir):
    return sampling.entity_splits(fixtures.entities(spark, sf_dir).where("source = 'source1'"))


@query(_SPLIT + " SELECT split, count(*) AS n, array_to_string(list_slice(list_sort(list(entity_id)), 1, 5), ',') AS first_ids FROM sp GROUP BY split")
def split_summary(spark, sf_dir):
    return sampling.split_summary(sampling.entity_splits(fixtures.entities(spark, sf_dir).where("source = 'source1'")))


@query(f"WITH {oracle.ENT} SELECT entity_id, CAST((row_number() OVER (ORDER BY ord, entity_id) - 1) // 100 AS INTEGER) AS shard_id FROM ent WHERE source <> 'source1'")
def shard_assignment(spark, sf_dir):
    return sampling.assign_shards(fixtures.entities(spark, sf_dir).where("source != 'source1'"), 100).select("entity_id", "shard_id")


@query(f"WITH {oracle.ENT} SELECT entity_id AS s1_id, CAST((row_number() OVER (ORDER BY entity_id) - 1) // 50 AS INTEGER) AS batch_id FROM ent WHERE source = 'source1'")
def batch_assignment(spark, sf_dir):
    return sampling.assign_batches(fixtures.queries_and_targets(spark, sf_dir)[0], 50).select("s1_id", "batch_id")


@query(f"""WITH {oracle.ENT} SELECT count(*) AS rows, count(DISTINCT entity_id) AS ids, count_if(NOT starts_with(entity_id, 'S2-')) AS odd_prefix,
 count_if(entity_id IS NULL OR entity_id = '') AS missing_entity_id, count_if(name IS NULL OR name = '') AS missing_business_name, count_if(addr IS NULL OR addr = '') AS missing_business_address,
 count_if(country IS NULL OR country = '') AS missing_country, count(*) - count(DISTINCT entity_id) AS duplicates FROM ent""")
def source_profile(spark, sf_dir):
    return profile.source_profile(fixtures.entities(spark, sf_dir), "S2-")


@query(f"WITH {oracle.ENT} SELECT coalesce(nullif(country, ''), '<MISSING>') AS country, count(*) AS n FROM ent GROUP BY 1")
def country_counts(spark, sf_dir):
    return profile.country_counts(fixtures.entities(spark, sf_dir))


@query(f"WITH {oracle.TRUTH} SELECT count(*) AS rows, count(DISTINCT s1_id) AS ids, count_if(len(ids) = 0) AS empty, count_if(len(ids) > 0) AS non_empty, CAST(sum(len(ids)) AS BIGINT) AS matches FROM tr")
def gt_profile(spark, sf_dir):
    return profile.truth_profile(fixtures.truth(spark, sf_dir))


@query(f"WITH {oracle.ENT} SELECT count(*) AS rows, count_if(name = '') AS business_name_before, count_if(name = '') AS business_name_after, count_if(addr = '') AS business_address_before, count_if(addr = '') AS business_address_after, count_if(country = '') AS country_before, count_if(country = '') AS country_after FROM ent")
def normalization_profile(spark, sf_dir):
    return profile.normalization_profile(fixtures.entities(spark, sf_dir))


@query(f"WITH {oracle.ENT}, n AS (SELECT strlen(entity_id || chr(9) || name || chr(9) || addr || chr(9) || country) + 1 AS n FROM ent), a AS (SELECT avg(n) AS m, quantile_cont(n, 0.9) AS p FROM n) SELECT round(m, 6) AS mean_bytes, round(p, 6) AS p90_bytes, round(greatest(m * 1.25, p), 6) AS row_bytes FROM a")
def row_size_profile(spark, sf_dir):
    rows = fixtures.entities(spark, sf_dir).select("entity_id", "business_name_norm", "business_address_norm", "country_norm")
    got = profile.row_size(rows)
    return got.withColumns({c: F.round(c, 6) for c in got.columns})


_TFIDF = """w{0} AS (SELECT entity_id, token, tf * (ln((1.0 + (SELECT count(*) FROM ent)) / (1.0 + df)) + 1) AS w FROM (SELECT entity_id, unnest(list_filter(string_split({1}, ' '), lambda x: x <> '')) AS token, 1 AS one FROM ent) x
  JOIN (SELECT token, count(DISTINCT entity_id) AS df FROM (SELECT entity_id, unnest(list_filter(string_split({1}, ' '), lambda x: x <> '')) AS token FROM ent) GROUP BY 1) USING (token)
  JOIN (SELECT entity_id AS e2, token AS t2, count(*) AS tf FROM (SELECT entity_id, unnest(list_filter(string_split({1}, ' '), lambda x: x <> '')) AS token FROM ent) GROUP BY ALL) ON e2 = x.entity_id AND t2 = token GROUP BY ALL),
n{0} AS (SELECT entity_id, sqrt(sum(w * w)) AS norm FROM w{0} GROUP BY 1),
c{0} AS (SELECT p.s1_id, p.candidate_id, sum(a.w * b.w) / max(na.norm * nb.norm) AS cos FROM p JOIN w{0} a ON a.entity_id = p.s1_id JOIN w{0} b ON b.entity_id = p.candidate_id AND a.token = b.token JOIN n{0} na ON na.entity_id = p.s1_id JOIN n{0} nb ON nb.entity_id = p.candidate_id GROUP BY ALL)"""
_JACCARD = "CASE WHEN len(list_distinct(list_concat({0}, {1}))) = 0 THEN 0.0 ELSE len(list_intersect(list_distinct({0}), list_distinct({1}))) / len(list_distinct(list_concat({0}, {1}))) END"


def _side(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda x: x <> '')"


def _digits(c: str) -> str:
    return rf"list_transform(list_filter({_side(c)}, lambda x: regexp_matches(x, '\p{{Nd}}')), lambda x: regexp_replace(x, '^0+(.)', '\1'))"


@query(_EXACT_PAIRS.replace(", p AS (", ", p AS (SELECT DISTINCT s1_id, candidate_id FROM (", 1) + "), " + _TFIDF.format(1, "name") + ", " + _TFIDF.format(2, "addr") + f"""
SELECT p.s1_id, p.candidate_id, CAST(a.name = b.name AND a.name <> '' AS INTEGER) AS name_exact_match, round({_JACCARD.format(_side('a.name'), _side('b.name'))}, 6) AS name_token_jaccard,
  round(CASE WHEN greatest(length(a.name), length(b.name)) = 0 THEN 0.0 ELSE 1 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name)) END, 6) AS name_levenshtein_ratio,
  CAST(a.addr = b.addr AND a.addr <> '' AS INTEGER) AS addr_exact_match, round({_JACCARD.format(_side('a.addr'), _side('b.addr'))}, 6) AS addr_token_jaccard,
  CAST(list_has_any({_digits('a.addr')}, {_digits('b.addr')}) AS INTEGER) AS addr_number_match, CAST(abs(length(a.name) - length(b.name)) AS INTEGER) AS name_len_diff, CAST(abs(length(a.addr) - length(b.addr)) AS INTEGER) AS addr_len_diff,
  round(coalesce(c1.cos, 0.0), 6) AS name_tfidf_cosine, round(coalesce(c2.cos, 0.0), 6) AS addr_tfidf_cosine
FROM p JOIN ent a ON a.entity_id = p.s1_id JOIN ent b ON b.entity_id = p.candidate_id LEFT JOIN c1 ON c1.s1_id = p.s1_id AND c1.candidate_id = p.candidate_id LEFT JOIN c2 ON c2.s1_id = p.s1_id AND c2.candidate_id = p.candidate_id""")
def pair_features(spark, sf_dir):
    every = _written_entities(spark, sf_dir)
    return features.pair_features(_exact_pairs(spark, sf_dir, every)[1], every, with_jaro_winkler=False, digits=6)


@query(_EXACT_PAIRS + " SELECT DISTINCT p.s1_id, p.candidate_id, round(1 - jaro_winkler_similarity(a.name, b.name), 6) AS name_jw_distance FROM p JOIN ent a ON a.entity_id = p.s1_id JOIN ent b ON b.entity_id = p.candidate_id")
def pair_features_jaro_winkler(spark, sf_dir):
    return features.pair_features(_exact_pairs(spark, sf_dir)[1], fixtures.entities(spark, sf_dir)).select("s1_id", "candidate_id", F.round("name_jw_distance", 6).alias("name_jw_distance"))


@query(_EXACT_PAIRS.replace("WITH", "WITH", 1) + f""", {oracle.TRUTH}, w AS (SELECT s1_id, unnest(ids) AS t FROM tr), cp AS (SELECT q.s1_id, t.entity_id AS t FROM q JOIN k t ON t.source <> 'source1' AND t.core = q.core AND q.core <> '')
SELECT 1 AS n_rules, 'exact_name' AS added, (SELECT count(*) FROM w) AS total_pairs, (SELECT count(*) FROM w WHERE EXISTS (SELECT 1 FROM p WHERE p.s1_id = w.s1_id AND p.candidate_id = w.t)) AS found_pairs
UNION ALL SELECT 2, 'compact_name', (SELECT count(*) FROM w), (SELECT count(*) FROM w WHERE EXISTS (SELECT 1 FROM p WHERE p.s1_id = w.s1_id AND p.candidate_id = w.t)
  OR EXISTS (SELECT 1 FROM q JOIN k t ON t.compact = q.compact AND length(q.compact) >= 5 WHERE q.s1_id = w.s1_id AND t.entity_id = w.t))""")
def cumulative_rule_report(spark, sf_dir):
    q, t = fixtures.queries_and_targets(spark, sf_dir, every=_written_entities(spark, sf_dir))
    wide = BlockingConfig(blocking_max_posting_len=1_000_000, blocking_max_candidates_per_s1=1_000_000, blocking_per_shard_candidate_cap=1_000_000)
    got = evaluate.cumulative_rules(q, t, fixtures.truth(spark, sf_dir), retrieve.scored_candidates, ["exact_name", "compact_name"], wide)
    return got.select("n_rules", "added", "total_pairs", "found_pairs")


@query(f"WITH {oracle.matched(BlockingConfig(), 1)} SELECT s1_id, candidate_id, source_dataset, rule_name, score FROM merged")
def streaming_batches(spark, sf_dir):
    from ..streaming.batches import candidates_of_stream

    q, t = fixtures.queries_and_targets(spark, sf_dir)
    return candidates_of_stream(spark, q, t, BlockingConfig())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
