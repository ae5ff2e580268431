"""The queries' oracles in DuckDB's SQL, written independently of the operators."""

from __future__ import annotations

from ..config import ADDRESS_STOPWORDS, LEGAL_TERMS, RULE_SCORES, BlockingConfig
from ..functions.minhash import PRIME, permutations


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_NORM = r"trim(regexp_replace(regexp_replace(replace(lower(coalesce({0}, '')),'ß','ss'),'[\p{{P}}\p{{S}}\p{{C}}]',' ','g'),'[\s\p{{Z}}]+',' ','g'))"
ENT = f"""ent AS (
  SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, 'source' || (doc_id % 3 + 1) AS source, doc_id AS ord,
         trim(array_to_string(list_slice(t, 1, 5), ' ') || CASE doc_id % 5 WHEN 0 THEN ' llc' WHEN 3 THEN ' holdings' ELSE '' END) AS name,
         trim((n_chars % 97) || ' ' || array_to_string(list_slice(t, 6, 9), ' ')) AS addr, lang AS country
  FROM (SELECT *, string_split({_NORM.format('text')}, ' ') AS t FROM documents)
)"""
_WORDS = "list_filter(string_split({0}, ' '), lambda x: x <> '')"
_CORE = f"CASE WHEN len(list_filter({_WORDS.format('name')}, lambda x: NOT list_contains({_list(LEGAL_TERMS)}, x))) = 0 THEN name ELSE array_to_string(list_filter({_WORDS.format('name')}, lambda x: NOT list_contains({_list(LEGAL_TERMS)}, x)), ' ') END"
_NUMBERS = rf"list_slice(list_transform(list_filter({_WORDS.format('addr')}, lambda x: regexp_matches(x, '\p{{Nd}}')), lambda x: regexp_replace(x, '^0+(.)', '\1')), 1, 2)"
_PLACES = rf"list_slice(list_filter({_WORDS.format('addr')}, lambda x: length(x) >= 4 AND NOT regexp_matches(x, '\p{{Nd}}') AND NOT list_contains({_list(ADDRESS_STOPWORDS)}, x)), 1, 2)"
_NGRAMS = "CASE WHEN length({0}) + 2 < 3 THEN ['^' || {0} || '$'] ELSE list_transform(range(1, length({0}) + 1), lambda i: substr('^' || {0} || '$', i, 3)) END"
_HASHES = "list_transform(list_distinct(" + _NGRAMS + "), lambda g: CAST(list_sum(list_transform(range(1, 8), lambda i: (instr('0123456789abcdef', substr(md5(g), i, 1)) - 1) * (1 << (4 * (7 - i))))) AS BIGINT))"
_PERMS = "[" + ", ".join(f"[{a}, {b}]" for a, b in permutations(32)) + "]::BIGINT[][]"
KEYED = f"""{ENT},
k0 AS (SELECT *, {_CORE} AS core, {_NUMBERS} AS nums, {_PLACES} AS places, list_distinct(list_filter({_WORDS.format('name')}, lambda x: length(x) >= 3)) AS words, list_distinct({_WORDS.format('name')}) AS every FROM ent),
k1 AS (SELECT *, replace(core, ' ', '') AS compact, list_slice(list_sort(words), 1, 4) AS four, list_slice(list_sort(every), 1, 4) AS four_any,
  list_concat(flatten(list_transform(nums, lambda n: list_transform(places, lambda w: 'a_nw:' || n || '_' || w))),
    CASE WHEN len(nums) >= 2 THEN ['a_nn:' || nums[1] || '_' || nums[2]] ELSE [] END,
    CASE WHEN len(nums) = 0 AND len(places) >= 2 THEN ['a_ww:' || places[1] || '_' || places[2]] ELSE [] END) AS akeys FROM k0),
k AS (SELECT *, flatten(list_transform(range(1, len(four) + 1), lambda i: list_transform(list_slice(four, i + 1, len(four)), lambda b: four[i] || '_' || b))) AS pairs,
  flatten(list_transform(range(1, len(four_any) + 1), lambda i: list_transform(list_slice(four_any, i + 1, len(four_any)), lambda b: four_any[i] || '_' || b))) AS pairs_any FROM k1)"""


def target_keys(n_shards: int) -> str:
    return f"""{KEYED},
t AS (SELECT *, CAST(ord % {n_shards} AS INTEGER) AS shard_id FROM k WHERE source <> 'source1'),
q AS (SELECT *, entity_id AS s1_id FROM k WHERE source = 'source1'),
tk AS (
  SELECT shard_id, entity_id, ord, 'exact_name' AS rule, name AS key FROM t WHERE name <> ''
  UNION ALL SELECT shard_id, entity_id, ord, 'core_name', core FROM t WHERE core <> '' AND core <> name
  UNION ALL SELECT shard_id, entity_id, ord, 'compact_name', compact FROM t WHERE length(compact) >= 5
  UNION ALL SELECT shard_id, entity_id, ord, 'rare_token', unnest(words) FROM t
  UNION ALL SELECT shard_id, entity_id, ord, 'token_pair', unnest(pairs) FROM t
  UNION ALL SELECT shard_id, entity_id, ord, 'address_key', unnest(akeys) FROM t
  UNION ALL SELECT shard_id, entity_id, ord, 'prefix_safety_net', substr(name, 1, 4) FROM t WHERE length(name) >= 4),
freq AS (SELECT shard_id, rule, key, count(*) AS df FROM tk GROUP BY ALL)"""


def posted(cfg: BlockingConfig, n_shards: int) -> str:
    return f"""{target_keys(n_shards)},
post AS (
  SELECT shard_id, entity_id, ord, rule, key FROM (
    SELECT tk.*, row_number() OVER (PARTITION BY tk.shard_id, tk.rule, tk.key ORDER BY tk.ord, tk.entity_id) AS rn
    FROM tk JOIN freq USING (shard_id, rule, key)
    WHERE NOT (rule = 'rare_token' AND df > {cfg.blocking_max_token_doc_freq}) AND NOT (rule = 'token_pair' AND df > {cfg.blocking_max_pair_token_freq})
      AND NOT (rule = 'address_key' AND df > {cfg.blocking_max_addr_key_freq}))
  WHERE rn <= CASE rule WHEN 'token_pair' THEN {cfg.blocking_max_pair_token_freq} WHEN 'prefix_safety_net' THEN {cfg.blocking_safety_net_max_bucket} ELSE {cfg.blocking_max_posting_len} END)"""


def matched(cfg: BlockingConfig, n_shards: int) -> str:
    most = cfg.lsh_max_candidates
    score = "CASE rule " + " ".join(f"WHEN '{r}' THEN {s}" for r, s in RULE_SCORES.items()) + " END"
    return f"""{posted(cfg, n_shards)},
qk AS (
  SELECT s1_id, 'exact_name' AS rule, name AS key FROM q WHERE name <> ''
  UNION SELECT s1_id, 'core_name', core FROM q WHERE core <> ''
  UNION SELECT s1_id, 'compact_name', compact FROM q WHERE compact <> ''
  UNION SELECT s1_id, 'token_pair', unnest(pairs_any) FROM q
  UNION SELECT s1_id, 'address_key', unnest(akeys) FROM q),
qw AS (SELECT s1_id, unnest(words) AS key FROM q),
rare AS (SELECT * FROM (SELECT s1_id, shard_id, key, df, row_number() OVER (PARTITION BY s1_id, shard_id ORDER BY df, key) AS rn FROM qw JOIN freq USING (key) WHERE rule = 'rare_token')
         WHERE rn <= {cfg.blocking_max_rare_tokens_per_s1} AND df <= {cfg.blocking_max_token_doc_freq}),
sig AS (SELECT s1_id AS id, NULL AS shard_id, 0 AS ord, country, {_HASHES.format('name')} AS hs FROM q WHERE name <> ''
        UNION ALL SELECT entity_id, shard_id, ord, country, {_HASHES.format('name')} FROM t WHERE name <> ''),
mins AS (SELECT id, shard_id, ord, country, list_transform({_PERMS}, lambda p: list_min(list_transform(hs, lambda h: (h * p[1] + p[2]) % {PRIME}))) AS m FROM sig),
bnd AS (SELECT id, shard_id, ord, country, b.band, b.band || '_' || array_to_string(list_slice(m, b.band * 4 + 1, b.band * 4 + 4), '_') AS key FROM mins CROSS JOIN (SELECT CAST(unnest(range(0, 8)) AS INTEGER) AS band) b),
tb AS (SELECT *, row_number() OVER (PARTITION BY shard_id, country, key ORDER BY ord, id) AS rc, row_number() OVER (PARTITION BY shard_id, key ORDER BY ord, id) AS rg FROM bnd WHERE shard_id IS NOT NULL),
qb AS (SELECT id AS s1_id, country, band, key FROM bnd WHERE shard_id IS NULL),
near0 AS (SELECT s1_id, tb.shard_id, tb.id AS cid, min(tb.band) AS band FROM qb JOIN tb ON qb.key = tb.key AND qb.country = tb.country WHERE rc <= {cfg.lsh_max_bucket_size} AND qb.country <> '' GROUP BY ALL),
near AS (SELECT s1_id, shard_id, cid FROM (SELECT *, (SELECT count(*) FROM near0 b WHERE b.s1_id = a.s1_id AND b.shard_id = a.shard_id AND b.band < a.band) AS have FROM near0 a) WHERE have < {most}),
cnt AS (SELECT s1_id, shard_id, count(*) AS n FROM near GROUP BY ALL),
far0 AS (SELECT qb.s1_id, tb.shard_id, tb.id AS cid, min(tb.band) AS band, max(coalesce(cnt.n, 0)) AS n0 FROM qb JOIN tb ON qb.key = tb.key LEFT JOIN cnt ON cnt.s1_id = qb.s1_id AND cnt.shard_id = tb.shard_id
         WHERE rg <= {cfg.lsh_max_bucket_size} AND coalesce(cnt.n, 0) < {cfg.lsh_min_before_fallback} AND NOT EXISTS (SELECT 1 FROM near z WHERE z.s1_id = qb.s1_id AND z.shard_id = tb.shard_id AND z.cid = tb.id) GROUP BY ALL),
far AS (SELECT s1_id, shard_id, cid FROM (SELECT *, n0 + (SELECT count(*) FROM far0 b WHERE b.s1_id = a.s1_id AND b.shard_id = a.shard_id AND b.band < a.band) AS have FROM far0 a) WHERE have < {most}),
lsh AS (SELECT s1_id, shard_id, cid FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, shard_id ORDER BY cid) AS rn FROM (SELECT * FROM near UNION ALL SELECT * FROM far)) WHERE rn <= {most}),
m0 AS (
  SELECT post.shard_id, s1_id, entity_id, rule FROM qk JOIN post USING (rule, key)
  UNION SELECT post.shard_id, s1_id, entity_id, 'rare_token' FROM rare JOIN post ON post.rule = 'rare_token' AND post.key = rare.key AND post.shard_id = rare.shard_id
  UNION SELECT shard_id, s1_id, cid, 'minhash_lsh' FROM lsh),
few AS (SELECT q.s1_id, s.shard_id FROM q CROSS JOIN (SELECT DISTINCT shard_id FROM t) s LEFT JOIN m0 ON m0.s1_id = q.s1_id AND m0.shard_id = s.shard_id
        GROUP BY ALL HAVING count(DISTINCT m0.entity_id) < {cfg.blocking_fuzzy_min_cands}),
m AS (SELECT * FROM m0 UNION SELECT post.shard_id, q.s1_id, post.entity_id, 'prefix_safety_net' FROM few JOIN q USING (s1_id) JOIN post ON post.rule = 'prefix_safety_net' AND post.key = substr(q.name, 1, 4) AND post.shard_id = few.shard_id),
best AS (SELECT shard_id, s1_id, entity_id AS candidate_id, arg_max(rule, {score}) AS rule_name, CAST(max({score}) AS INTEGER) AS score FROM m GROUP BY ALL),
labelled AS (SELECT best.*, t.source AS source_dataset FROM best JOIN t ON t.entity_id = candidate_id AND t.shard_id = best.shard_id),
shardcap AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY shard_id, s1_id ORDER BY score DESC, candidate_id) AS rn FROM labelled) WHERE rn <= {cfg.blocking_per_shard_candidate_cap}),
merged0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, candidate_id ORDER BY score DESC, shard_id) AS r1 FROM shardcap) WHERE r1 = 1),
merged AS (SELECT * EXCLUDE (r2) FROM (SELECT s1_id, candidate_id, source_dataset, rule_name, score, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, candidate_id) AS r2 FROM merged0) WHERE r2 <= {cfg.blocking_max_candidates_per_s1})"""


def unioned(cfg: BlockingConfig) -> str:
    most = cfg.lsh_max_candidates
    return f"""{KEYED},
t AS (SELECT * FROM k WHERE source <> 'source1'),
q AS (SELECT *, entity_id AS s1_id FROM k WHERE source = 'source1'),
uk AS (
  SELECT country, entity_id, ord, 'exact' AS space, name AS key FROM t WHERE name <> ''
  UNION ALL SELECT country, entity_id, ord, 'core', core FROM t WHERE core <> '' AND core <> name
  UNION ALL SELECT country, entity_id, ord, 'compact', compact FROM t WHERE length(compact) >= 5
  UNION ALL SELECT country, entity_id, ord, 'address', unnest(akeys) FROM t
  UNION ALL SELECT country, entity_id, ord, 'prefix', substr(core, 1, 4) FROM t WHERE length(core) >= 4),
up AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY country, space, key) AS n, row_number() OVER (PARTITION BY country, space, key ORDER BY ord, entity_id) AS rn FROM uk)
       WHERE rn <= {cfg.blocking_max_posting_len} AND NOT (space = 'address' AND n > {cfg.blocking_max_addr_key_freq}) AND NOT (space = 'prefix' AND n > {cfg.blocking_safety_net_max_bucket})),
tw AS (SELECT country, entity_id, ord, unnest(every) AS key FROM t),
df AS (SELECT country, key, count(*) AS df FROM tw GROUP BY ALL),
wp AS (SELECT * FROM (SELECT tw.*, row_number() OVER (PARTITION BY tw.country, tw.key ORDER BY ord, entity_id) AS rn FROM tw JOIN df USING (country, key) WHERE length(key) >= 3 AND df <= {cfg.blocking_max_token_doc_freq}) WHERE rn <= {cfg.blocking_max_posting_len}),
qr AS (SELECT * FROM (SELECT s1_id, country, key, df, row_number() OVER (PARTITION BY s1_id ORDER BY df, key) AS rn FROM (SELECT s1_id, country, unnest(words) AS key FROM q) JOIN df USING (country, key)) WHERE rn <= {cfg.blocking_max_rare_tokens_per_s1} AND df <= {cfg.blocking_max_token_doc_freq}),
pw AS (SELECT entity_id, source, ord, country, list_slice(list_sort(list(w.key)), 1, 4) AS four FROM (SELECT entity_id, source, ord, country, unnest(words) AS key FROM k) w
       LEFT JOIN df USING (country, key) WHERE coalesce(df, 0) <= {cfg.blocking_max_pair_token_freq} GROUP BY ALL),
pk AS (SELECT entity_id, source, ord, country, unnest(flatten(list_transform(range(1, len(four) + 1), lambda i: list_transform(list_slice(four, i + 1, len(four)), lambda b: four[i] || '_' || b)))) AS key FROM pw),
pp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, key ORDER BY ord, entity_id) AS rn FROM pk WHERE source <> 'source1') WHERE rn <= {cfg.blocking_max_posting_len}),
mins AS (SELECT entity_id, source, ord, country, list_transform({_PERMS}, lambda p: list_min(list_transform(hs, lambda h: (h * p[1] + p[2]) % {PRIME}))) AS m FROM (SELECT *, {_HASHES.format('core')} AS hs FROM k WHERE core <> '')),
bnd AS (SELECT entity_id, source, ord, country, b.band, b.band || '_' || array_to_string(list_slice(m, b.band * 4 + 1, b.band * 4 + 4), '_') AS key FROM mins CROSS JOIN (SELECT CAST(unnest(range(0, 8)) AS INTEGER) AS band) b),
tb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, key ORDER BY ord, entity_id) AS rn FROM bnd WHERE source <> 'source1') WHERE rn <= {cfg.lsh_max_bucket_size}),
l0 AS (SELECT qb.entity_id AS s1_id, tb.entity_id AS cid, min(tb.band) AS band FROM bnd qb JOIN tb ON qb.key = tb.key AND qb.country = tb.country WHERE qb.source = 'source1' AND qb.country <> '' GROUP BY ALL),
l1 AS (SELECT s1_id, cid FROM (SELECT *, (SELECT count(*) FROM l0 b WHERE b.s1_id = a.s1_id AND b.band < a.band) AS have FROM l0 a) WHERE have < {most}),
lsh AS (SELECT s1_id, cid FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY cid) AS rn FROM l1) WHERE rn <= {most}),
u0 AS (
  SELECT s1_id, up.entity_id AS cid, 'exact_name' AS rule FROM q JOIN up ON up.space = 'exact' AND up.key = q.name AND up.country = q.country
  UNION SELECT s1_id, up.entity_id, 'core_name' FROM q JOIN up ON up.space IN ('exact', 'core') AND up.key = q.core AND up.country = q.country
  UNION SELECT s1_id, up.entity_id, 'compact_name' FROM q JOIN up ON up.space = 'compact' AND up.key = q.compact AND up.country = q.country AND length(q.compact) >= 5
  UNION SELECT s1_id, up.entity_id, 'address_key' FROM (SELECT s1_id, country, unnest(akeys) AS key FROM q) a JOIN up ON up.space = 'address' AND up.key = a.key AND up.country = a.country
  UNION SELECT s1_id, wp.entity_id, 'rare_token' FROM qr JOIN wp ON wp.key = qr.key AND wp.country = qr.country
  UNION SELECT a.entity_id, pp.entity_id, 'token_pair' FROM pk a JOIN pp ON pp.key = a.key AND pp.country = a.country WHERE a.source = 'source1'
  UNION SELECT s1_id, cid, 'minhash_lsh' FROM lsh),
few AS (SELECT q.s1_id FROM q LEFT JOIN u0 ON u0.s1_id = q.s1_id GROUP BY ALL HAVING count(DISTINCT u0.cid) < {cfg.blocking_fuzzy_min_cands}),
u AS (SELECT * FROM u0 UNION SELECT s1_id, up.entity_id, 'prefix_safety_net' FROM few JOIN q USING (s1_id) JOIN up ON up.space = 'prefix' AND up.key = substr(q.core, 1, 4) AND length(q.core) >= 4 AND up.country = q.country),
each AS (SELECT s1_id, cid, array_to_string(list_sort(list(rule)), ',') AS provenance_rules, count(*) OVER (PARTITION BY s1_id) AS n, row_number() OVER (PARTITION BY s1_id ORDER BY cid) AS rn FROM u GROUP BY s1_id, cid),
kept AS (SELECT s1_id, cid AS candidate_id, t.source AS source_dataset, provenance_rules, n > {cfg.blocking_max_candidates_per_s1} AS truncated FROM each JOIN t ON t.entity_id = cid WHERE rn <= {cfg.blocking_max_candidates_per_s1})"""


TRUTH = rf"""tr0 AS (SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, doc_id % 3 + 1 AS kind, md5({_NORM.format('text')}) AS h FROM documents),
tr AS (SELECT s.entity_id AS s1_id, list_sort(list_filter(list(t.entity_id), lambda x: x IS NOT NULL)) AS ids FROM tr0 s LEFT JOIN tr0 t ON t.h = s.h AND t.kind > 1 WHERE s.kind = 1 GROUP BY ALL)"""
