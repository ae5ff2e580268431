import pytest
from pyspark.sql import functions as F

from kinweave.config import BlockingConfig
from kinweave.functions.text import with_normalized
from kinweave.operators import evaluate, features, retrieve, sampling, validate
from kinweave.sources import tables


def sources(spark, s1, targets):
    """Frames of (id, name, address, country) rows."""
    q = with_normalized(spark.createDataFrame(s1, "s1_id string, business_name string, business_address string, country string"))
    t = with_normalized(spark.createDataFrame(targets, "entity_id string, business_name string, business_address string, country string"))
    source = F.when(F.col("entity_id").startswith("S2"), "source2").otherwise("source3")
    return q, t.withColumns({"source": source, "ord": F.col("entity_id"), "shard_id": F.lit(0)})


def found(df, *more):
    return {(r["s1_id"], r["candidate_id"], *(r[m] for m in more)) for r in df.collect()}


def pipeline_set(spark):
    s1 = [(f"S1-{i:03d}", f"Acme Corp {i}", f"{100 + i} Market Street", "us") for i in range(1, 21)]
    t = [(f"S2-{i:03d}", f"Acme Corp {i} LLC", f"{100 + i} Market St", "us") for i in range(1, 61)]
    t += [(f"S3-{i:03d}", f"Acme Corp {i} Inc", f"{100 + i} Market Street", "us") for i in range(1, 61)]
    return sources(spark, s1, t)


def test_both_engines_find_all_true_pairs(spark):
    q, t = pipeline_set(spark)
    truth = q.select("s1_id", F.array(F.replace("s1_id", F.lit("S1"), F.lit("S2")), F.replace("s1_id", F.lit("S1"), F.lit("S3"))).alias("ids"))
    for got in (retrieve.scored_candidates(q, t), retrieve.union_candidates(q, t)):
        row = evaluate.recall_metrics(truth, got).first()
        assert (row["total_pairs"], row["found_pairs"], row["full_coverage"]) == (40, 40, 1.0)
    lists = retrieve.candidate_lists(q, retrieve.scored_candidates(q, t))
    assert lists.count() == 20


def test_country_partition_and_empty_records(spark):
    q, t = sources(
        spark, [("S1-1", "Alpha Bistro", "1 Main", "us"), ("S1-2", "", "", "us"), ("S1-3", "Alpha Bistro", "1 Main", "fr"), ("S1-4", None, None, None)],
        [("S2-1", "Alpha Bistro", "1 Main", "us"), ("S3-1", "Alpha Bistro LLC", "1 Main", "us"), ("S2-3", "Alpha Bistro", "1 Main", "fr"), ("S2-9", None, None, "us")],
    )
    assert found(retrieve.union_candidates(q, t)) == {("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-3", "S2-3")}
    lists = {r[0]: r[1] for r in retrieve.candidate_lists(q, retrieve.union_candidates(q, t)).collect()}
    assert lists == {"S1-1": "S2-1,S3-1", "S1-2": "", "S1-3": "S2-3", "S1-4": ""}


def test_caps_and_ties(spark):
    q, t = sources(spark, [("S1-1", "general store", "", "us")], [(f"S2-{i:02d}", "general store", "", "us") for i in range(25)])
    cfg = BlockingConfig(blocking_per_shard_candidate_cap=5, blocking_max_candidates_per_s1=3)
    matches = retrieve.scored_matches(q, t, cfg)
    assert matches.count() == 25
    assert found(retrieve.shard_capped(matches, cfg)) == {("S1-1", f"S2-{i:02d}") for i in range(5)}
    assert found(retrieve.scored_candidates(q, t, cfg), "rule_name", "score") == {("S1-1", f"S2-{i:02d}", "exact_name", 100) for i in range(3)}
    union = retrieve.union_candidates(q, t, BlockingConfig(blocking_max_posting_len=5, blocking_max_candidates_per_s1=3, lsh_max_candidates=1))
    assert found(union, "truncated") == {("S1-1", f"S2-{i:02d}", True) for i in range(3)}


def test_lsh_and_prefix_reach_typos(spark):
    q, t = sources(spark, [("S1-1", "orele barbershop", "", "us"), ("S1-2", "bistro de paris", "", "germany")], [("S2-100", "orelee barbershop", "", "us"), ("S2-200", "acme manufacturing", "", "us"), ("S3-300", "bistro de paris", "", "france")])
    got = found(retrieve.scored_candidates(q, t, BlockingConfig(rules=("minhash_lsh",))))
    assert got == {("S1-1", "S2-100"), ("S1-2", "S3-300")}
    hard = BlockingConfig(rules=("minhash_lsh",), blocking_soft_country_mode=False)
    assert found(retrieve.scored_candidates(q, t, hard)) == {("S1-1", "S2-100")}
    assert found(retrieve.scored_candidates(q, t, BlockingConfig(rules=("prefix_safety_net",)))) == {("S1-1", "S2-100"), ("S1-2", "S3-300")}


def test_frequency_cap_does_not_depend_on_order(spark):
    rows = [("S2-1", "Alpha Beta Gamma", "", "us"), ("S2-2", "Alpha Delta", "", "us"), ("S2-3", "Alpha Beta", "", "us")]
    cfg = BlockingConfig(rules=("rare_token",), blocking_max_token_doc_freq=2)
    for order in (rows, rows[::-1]):
        q, t = sources(spark, [("S1-1", "alpha", "", "us"), ("S1-2", "beta", "", "us")], order)
        assert found(retrieve.scored_matches(q, t, cfg)) == {("S1-2", "S2-1"), ("S1-2", "S2-3")}


def test_measures(spark):
    rows = [("a", [], []), ("b", [], ["S2-1"]), ("c", ["S2-1"], []), ("d", ["S2-1"], ["S2-1", "S3-2"])]
    df = spark.createDataFrame(rows, "s1_id string, truth array<string>, pred array<string>")
    got = {r["s1_id"]: (r["p"], r["r"], r["f"]) for r in evaluate.entity_metrics(df).collect()}
    assert got == {"a": (1, 1, 1), "b": (0, 1, 0), "c": (1, 0, 0), "d": (0.5, 1, pytest.approx(0.625 / 1.125))}


def test_splits_shards_and_samples(spark):
    ids = spark.range(1000).select(F.concat(F.lit("S1-"), "id").alias("entity_id"))
    split = sampling.entity_splits(ids)
    counts = {r["split"]: r["n"] for r in sampling.split_summary(split).collect()}
    assert counts == {"train": 700, "calibration": 150, "validation": 150}
    assert {tuple(r) for r in split.collect()} == {tuple(r) for r in sampling.entity_splits(ids.repartition(7)).collect()}
    with pytest.raises(ValueError):
        sampling.entity_splits(ids, (0.5, 0.1, 0.1))
    placed = ids.withColumn("ord", F.substring("entity_id", 4, 9).cast("long"))
    shards = sampling.assign_shards(placed, 300).groupBy("shard_id").agg(F.min("ord").alias("a"), F.count("*").alias("n")).orderBy("shard_id").collect()
    assert [tuple(r) for r in shards] == [(0, 0, 300), (1, 300, 300), (2, 600, 300), (3, 900, 100)]
    rows, scanned = sampling.scan_and_sample(placed, 20, 10)
    assert scanned == 20 and rows.count() == 10 and rows.agg(F.max("ord")).first()[0] < 20
    with pytest.raises(ValueError, match="--pilot-scan-rows"):
        sampling.scan_and_sample(placed, 20, 10, ids=ids.where("entity_id = 'S1-999'"))


def test_files_and_validation(spark, tmp_path):
    raw = spark.createDataFrame([("S2-1", "Shop", "Plot 12, Floor 3, MG Road, Bangalore", "NA"), ("S2-2", 'A "b"', "", "us")], "entity_id string, business_name string, business_address string, country string")
    tables.write_tsv(raw, f"{tmp_path}/source2.tsv", tables.SOURCE_COLUMNS)
    back = {r["entity_id"]: r for r in tables.read_source(spark, f"{tmp_path}/source2.tsv", "source2").collect()}
    assert back["S2-1"]["business_address"] == "Plot 12, Floor 3, MG Road, Bangalore" and back["S2-1"]["country"] == "NA"
    assert back["S2-2"]["business_name"] == 'A "b"'
    with pytest.raises(ValueError):
        tables.read_tsv(spark, f"{tmp_path}/source2.tsv", ["nothing"])
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-10,S3-30\nS1-2\t\n")
    (tmp_path / "m.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS3-40\nS1-9\tS9-1,S2-1,S2-1\n")
    expected = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    assert validate.validate_file(spark, f"{tmp_path}/c.tsv", expected, "candidate_entity_ids") == (True, [])
    ok, errors = validate.validate_file(spark, f"{tmp_path}/m.tsv", expected, candidate_path=f"{tmp_path}/c.tsv")
    text = " | ".join(errors)
    assert not ok and "Missing 1 expected Source 1 IDs" in text and "1 unexpected Source 1 IDs" in text and "twice" in text and "not among" in text and "prefix" in text


def test_batches_of_some_queries(spark):
    q = spark.createDataFrame([(f"S1-{i:02d}",) for i in range(30)], "s1_id string")
    ids = spark.createDataFrame([(f"S1-{i:02d}",) for i in range(0, 30, 2)] * 2 + [("S1-99",)], "entity_id string")
    got = {r["s1_id"]: r["batch_id"] for r in sampling.assign_batches(q, 4, ids).collect()}
    assert got == {f"S1-{2 * k:02d}": k // 4 for k in range(15)}
    assert sampling.assign_batches(q, 4, ids, limit=5).count() == 5


def test_id_map_and_reports(spark, tmp_path):
    q = spark.createDataFrame([("S1-2",), ("S1-1",), ("S1-3",)], "s1_id string")
    lists = spark.createDataFrame([("S1-1", ["S3-2", "S2-1", "S2-1"]), ("S1-3", [])], "s1_id string, ids array<string>")
    tables.write_id_map(q, lists, f"{tmp_path}/map", "matched_entity_ids")
    got = {r["s1_id"]: r["ids"] for r in tables.read_truth(spark, f"{tmp_path}/map").collect()}
    assert got == {"S1-1": ["S2-1", "S3-2"], "S1-2": [], "S1-3": []}
    raw = spark.createDataFrame([("S1-1", ["S2-1", "S2-1"], 2), ("S1-9", ["X-1"], 3), ("S1-1", [], 2), ("", [], 1)], "s1_id string, raw array<string>, n_columns int")
    report = validate.candidate_report(raw, q.withColumnRenamed("s1_id", "entity_id")).first().asDict()
    assert report == {"columns": 1, "empty_id": 1, "duplicate_id": 1, "duplicate_target": 1, "bad_prefix": 1, "missing": 2, "unexpected": 1, "rows": 4}


def test_fused_scores_and_threshold(spark):
    scores = spark.createDataFrame([("S1-1", "S2-1", 0.9), ("S1-1", "S2-1", 0.5), ("S1-1", "S2-2", 0.4), ("S1-2", "S2-3", 0.8)], "s1_id string, candidate_id string, match_score double")
    assert {r["s1_id"]: r["ids"] for r in features.fused(scores, 0.7).collect()} == {"S1-1": ["S2-1"], "S1-2": ["S2-3"]}
    truth = spark.createDataFrame([("S1-1", ["S2-1"]), ("S1-2", [])], "s1_id string, ids array<string>")
    best = features.best_threshold(scores, truth, [0.3, 0.75, 0.95]).collect()
    # By hand: 0.3 gives (1 + 0.5 * ...) and a false list, 0.75 one false list and a miss, 0.95 a miss alone.
    f = {r["threshold"]: r["macro_f"] for r in best}
    assert f[0.3] == pytest.approx((1.25 * 0.5 / (0.25 * 0.5 + 1)) / 2) and f[0.75] == 0.0 and f[0.95] == pytest.approx(0.5)
    assert best[0]["threshold"] == 0.95


def test_candidates_asked_for_are_those_among_all(spark):
    """With bounds out of reach and with bounds that fire, true pairs and queries without any get what all candidates hold."""
    from pyspark.sql import functions as F

    from kinweave.config import BlockingConfig
    from kinweave.operators import retrieve

    sides = [(f"S{k % 3 + 1}-{k}", f"source{k % 3 + 1}", k, ("north star", "north star llc", "northstar", "south")[k % 4], "1 road", "en") for k in range(60)]
    every = spark.createDataFrame(sides, "entity_id string, source string, ord long, business_name_norm string, business_address_norm string, country_norm string")
    q = every.where("source = 'source1'").withColumnRenamed("entity_id", "s1_id")
    t = every.where("source != 'source1' and ord % 4 != 3").withColumn("shard_id", F.lit(0))
    only = q.select("s1_id").crossJoin(t.where("ord % 5 = 1").select(F.col("entity_id").alias("candidate_id"))).where("s1_id != 'S1-0'")
    alone = q.where("s1_id in ('S1-0', 'S1-3')").select("s1_id")
    for most in (1000, 7):
        cfg = BlockingConfig(blocking_max_posting_len=most, blocking_max_candidates_per_s1=most, blocking_per_shard_candidate_cap=most, rules=("exact_name", "compact_name"))
        rows = {tuple(r) for r in retrieve.scored_candidates(q, t, cfg).collect()}
        got = {tuple(r) for r in retrieve.scored_candidates(q, t, cfg, only=only, alone=alone).collect()}
        asked = {tuple(r) for r in only.collect()}
        assert got <= rows and {r for r in rows if r[:2] in asked} <= got and len({r for r in got if r[0] == "S1-0"}) == 1
        assert {r[0] for r in got if r[:2] not in asked} == {"S1-0"}


def test_pairs_of_equal_records_share_features(spark):
    from kinweave.operators import features

    rows = [("a", "x y", "1 b"), ("b", "x y", "1 b"), ("c", "x y", "01 c"), ("d", "x y", "1 b"), ("e", "", ""), ("f", "z", None)]
    entities = spark.createDataFrame(rows, "entity_id string, business_name_norm string, business_address_norm string")
    pairs = spark.createDataFrame([("a", "c"), ("b", "c"), ("a", "d"), ("a", "d"), ("e", "f")], "s1_id string, candidate_id string")
    got = {(r["s1_id"], r["candidate_id"]): tuple(r)[2:] for r in features.pair_features(pairs, entities, with_jaro_winkler=False, digits=3).collect()}
    assert set(got) == {("a", "c"), ("b", "c"), ("a", "d"), ("e", "f")} and got["a", "c"] == got["b", "c"] != got["a", "d"]
    assert got["a", "d"] == (1, 1.0, 1.0, 1, 1.0, 1, 0, 0, 1.0, 1.0) and got["e", "f"][-2:] == (0.0, 0.0)
