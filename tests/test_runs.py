import pytest
from pyspark.sql import functions as F

from kinweave.config import BlockingConfig
from kinweave.plans import runs
from kinweave.sources import tables


def test_disk_projection():
    cfg, size = BlockingConfig(), runs.RowBytes()
    assert runs.disk_needed(330_000, 10_300_000, cfg, size, True) == pytest.approx(69.84, abs=0.05)
    assert runs.disk_needed(330_000, 10_300_000, cfg, size, False) == pytest.approx(9.29, abs=0.05)
    assert runs.disk_needed(1_730_000, 10_000_000, cfg, size, True) == pytest.approx(322.11, abs=0.2)
    assert runs.disk_needed(10, 10, cfg, size, True) == cfg.min_free_disk_gb


def test_preflight(tmp_path):
    def said(**how):
        return runs.preflight(str(tmp_path), 1000, 1000, **{"bytes_per_target": 500.0, "free_disk": 100.0, "memory": 64.0, **how})

    assert said()[0]
    assert "bytes per target" in said(bytes_per_target=None)[2] and "disk" in said(free_disk=1.0)[2]
    assert "unknown" in said(memory=None)[2] and "0.10 GiB of memory" in said(memory=0.1)[2]


def test_pilot_and_evaluation(spark, tmp_path):
    def write(name, prefix, n, suffix):
        rows = [(f"{prefix}-{i:03d}", f"Lantern {i} Mills{suffix}", f"{300 + i} Harbour Row", "nl") for i in range(1, n + 1)]
        tables.write_tsv(spark.createDataFrame(rows, tables.SOURCE_COLUMNS), f"{tmp_path}/{name}.tsv", tables.SOURCE_COLUMNS)

    write("source1", "S1", 30, "")
    write("source2", "S2", 50, " BV")
    write("source3", "S3", 50, " NV")
    truth = spark.createDataFrame([(f"S1-{i:03d}", f"S2-{i:03d},S3-{i:03d}" if i <= 20 else "") for i in range(1, 31)], tables.TRUTH_COLUMNS)
    tables.write_tsv(truth, f"{tmp_path}/ground_truth.tsv", tables.TRUTH_COLUMNS)
    ids = spark.createDataFrame([(f"S1-{i:03d}",) for i in range(5, 16)], "entity_id string")
    assert runs.pilot(spark, str(tmp_path), f"{tmp_path}/pilot", ids, queries=5, targets=50) == (True, [])
    pairs, report = runs.run(spark, str(tmp_path), f"{tmp_path}/out", "eval", ids)
    row = report.first()
    assert (row["total_pairs"], row["found_pairs"]) == (22, 22) and pairs.select("s1_id").distinct().count() == 11
    # Other ids and changed files make another folder; the same ones go on from what was written.
    folders = lambda: sorted(p.name for p in (tmp_path / "out").iterdir())
    before = folders()
    assert runs.run(spark, str(tmp_path), f"{tmp_path}/out", "eval", ids)[1].first() == row and folders() == before
    runs.run(spark, str(tmp_path), f"{tmp_path}/out", "eval", ids.limit(3))
    assert len(folders()) == len(before) + 1
    write("source3", "S3", 49, " NV")
    assert runs.run(spark, str(tmp_path), f"{tmp_path}/out", "eval", ids)[1].first() == row and len(folders()) == len(before) + 2
    assert runs.run(spark, str(tmp_path), f"{tmp_path}/out", "test", limit=3)[0].select(F.countDistinct("s1_id")).first()[0] == 3
    with pytest.raises(ValueError):
        runs.run(spark, str(tmp_path), f"{tmp_path}/out", "other")


def test_command_line(spark, tmp_path, capsys):
    from kinweave.__main__ import main

    for k in (1, 2, 3):
        rows = [(f"S{k}-{i}", f"Kiln {i} Works", f"{i} Quay", "nl") for i in range(20)]
        tables.write_tsv(spark.createDataFrame(rows, tables.SOURCE_COLUMNS), f"{tmp_path}/source{k}.tsv", tables.SOURCE_COLUMNS)
    assert main(["split", str(tmp_path), f"{tmp_path}/splits"], spark) == 0
    assert {p.name for p in (tmp_path / "splits/ids").iterdir() if p.is_dir()} == {"split=train", "split=calibration", "split=validation"}
    assert tables.read_ids(spark, f"{tmp_path}/splits/ids").count() == 20
    lists = spark.createDataFrame([(f"S1-{i}", f"S2-{i}") for i in range(19)], ["source1_entity_id", "matched_entity_ids"])
    tables.write_tsv(lists, f"{tmp_path}/lists", lists.columns)
    assert main(["validate", str(tmp_path), f"{tmp_path}/lists"], spark) == 1 and "Missing 1" in capsys.readouterr().out
    assert main(["run", "--mode", "test", str(tmp_path), f"{tmp_path}/out"], spark) == 0
    found = next((tmp_path / "out").glob("test-*/candidate_pairs"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(found)).count() == 20
    with pytest.raises(SystemExit):
        main(["other"], spark)
