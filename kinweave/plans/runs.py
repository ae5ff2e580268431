"""Whole runs: a pilot over samples, an evaluation or test over everything, and what they need to have before they begin."""

from __future__ import annotations

import math
import os
import shutil
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BlockingConfig
from ..functions.text import with_normalized
from ..operators import evaluate, retrieve, sampling, validate
from ..sources import tables
from ..streaming.batches import fingerprint, hash_of, state_of

GIB = 1024**3


# The row sizes that the projections are stated for.
@dataclass(frozen=True)
class RowBytes:
    """Bytes of rows on disk, with a margin of a quarter: targets, queries, matches, provenance, and a list's own and each entry's."""

    target: float = 130 * 1.25
    query: float = 110 * 1.25
    match: float = 70 * 1.25
    provenance: float = 80 * 1.25
    list_base: float = 15 * 1.25
    list_entry: float = 15 * 1.25


def disk_needed(n_queries: int, n_targets: int, cfg: BlockingConfig, size: RowBytes, full: bool) -> float:
    """GiB at the peak of a run that writes shards, batches, matches, merged batches and the final files.

    ``full`` reckons with every cap reached; otherwise with 20 matches a query and shard and 36 candidates a query.
    """
    shards = max(1, math.ceil(n_targets / max(cfg.shard_size_targets, 1)))
    matches = cfg.blocking_per_shard_candidate_cap if full else min(cfg.blocking_per_shard_candidate_cap, 20)
    final = cfg.blocking_max_candidates_per_s1 if full else min(cfg.blocking_max_candidates_per_s1, 36)
    inputs = n_targets * size.target + n_queries * size.query
    merged = n_queries * (size.list_base + final * (size.list_entry + size.provenance))
    peak = inputs + n_queries * shards * matches * size.match + 3 * merged  # batches, final files, and these while they are written
    return max(cfg.min_free_disk_gb, round(peak / GIB + 0.5, 2))


def free_memory() -> float | None:
    """GiB that Linux says are available, if it says so."""
    try:
        with open("/proc/meminfo") as f:
            for line in f:
                if line.startswith("MemAvailable:"):
                    return int(line.split()[1]) / 1024**2
    except OSError:
        pass
    return None


def preflight(folder: str, n_queries: int, n_targets: int, cfg: BlockingConfig | None = None, bytes_per_target: float | None = None, size: RowBytes | None = None, worst_case: bool = False, free_disk: float | None = None, memory: float | None = -1.0) -> tuple[bool, dict, str]:
    """Whether a run has the disk and memory it needs, the figures, and what is wrong."""
    cfg, size = cfg or BlockingConfig(), size or RowBytes()
    os.makedirs(folder, exist_ok=True)
    free = shutil.disk_usage(folder).free / GIB if free_disk is None else free_disk
    memory = free_memory() if memory == -1.0 else memory
    worst, usual = (disk_needed(n_queries, n_targets, cfg, size, full) for full in (True, False))
    need = worst if worst_case else usual
    got = {"free_disk_gib": round(free, 2), "conservative_gib": worst, "empirical_gib": usual, "required_disk_gib": need, "available_ram_gib": memory, "required_ram_gib": None}
    if bytes_per_target is None:
        return False, got, "The bytes per target were not measured"
    got["required_ram_gib"] = max(cfg.min_free_ram_gb, round(cfg.shard_size_targets * bytes_per_target * cfg.ram_safety_margin / GIB + 0.5, 2))
    if free < need:
        return False, got, f"The disk has {free:.2f} GiB free where {need:.2f} GiB are needed"
    if memory is None:
        return False, got, "How much memory is free is unknown"
    if memory < got["required_ram_gib"]:
        return False, got, f"{memory:.2f} GiB of memory are free where {got['required_ram_gib']:.2f} GiB are needed"
    return True, got, "Disk and memory suffice"


def _sides(data: dict[str, DataFrame], ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Normalised queries, of those in ``ids`` only, and targets in one shard."""
    s1 = data["source1"] if ids is None else data["source1"].join(ids.select("entity_id"), "entity_id", "left_semi")
    targets = data["source2"].unionByName(data["source3"])
    return with_normalized(s1).withColumnRenamed("entity_id", "s1_id"), with_normalized(targets).withColumn("shard_id", F.lit(0))


def done(spark: SparkSession, path: str) -> bool:
    """Whether Spark has written a folder whole."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def run(spark: SparkSession, folder: str, out: str, mode: str = "eval", ids: DataFrame | None = None, cfg: BlockingConfig | None = None, limit: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Candidates of all queries of a folder (mode "test"), or of those in ``ids`` with their recall (mode "eval").

    Writes pairs with their rules, lists and a summary below ``out``, in a folder that the inputs' files, the ids and the parameters
    name.  A run that was broken off goes on after the pairs, if these were written whole.
    """
    if mode not in ("eval", "test"):
        raise ValueError(f"unknown mode {mode}")
    cfg = cfg or BlockingConfig()
    q, t = _sides(tables.test_data(spark, folder), ids)
    if limit:
        q = q.orderBy("s1_id").limit(limit)
    inputs = {f: state_of(spark, f"{folder}/{f}.tsv") for f in ("source1", "source2", "source3", *(["ground_truth"] if mode == "eval" else []))}
    to = f"{out}/{mode}-{fingerprint(mode, {**inputs, 'limit': str(limit), 'ids': hash_of(ids)}, cfg)}"
    if not done(spark, f"{to}/pairs"):
        retrieve.scored_candidates(q, t, cfg).write.mode("overwrite").parquet(f"{to}/pairs")
    pairs = spark.read.parquet(f"{to}/pairs")
    tables.write_tsv(retrieve.candidate_lists(q, pairs), f"{to}/candidate_pairs", tables.CANDIDATE_COLUMNS)
    provenance = pairs.selectExpr("s1_id AS source1_entity_id", "candidate_id AS candidate_entity_id", "source_dataset", "rule_name", "score")
    tables.write_tsv(provenance, f"{to}/candidate_provenance", provenance.columns)
    if mode == "test":
        tables.write_summary(evaluate.candidate_stats(q, pairs, cfg.blocking_max_candidates_per_s1), f"{to}/summary")
        return pairs, None
    truth = tables.read_truth(spark, f"{folder}/ground_truth.tsv", q.select(F.col("s1_id").alias("entity_id")))
    report = evaluate.recall_metrics(truth, pairs)
    tables.write_summary(report, f"{to}/summary")
    return pairs, report


def pilot(spark: SparkSession, folder: str, out: str, ids: DataFrame, scan_rows: int = 250_000, queries: int = 1000, targets: int = 5000, cfg: BlockingConfig | None = None) -> tuple[bool, list[str]]:
    """The union engine over samples of the sources; whether the lists that it wrote are right."""
    cfg = cfg or BlockingConfig()
    data = tables.test_data(spark, folder)
    s1, _ = sampling.scan_and_sample(data["source1"], scan_rows, queries, cfg.pilot_seed, ids)
    some = {"source1": s1.join(ids.select("entity_id"), "entity_id", "left_semi")}
    some |= {s: sampling.scan_and_sample(data[s], scan_rows, targets, cfg.pilot_seed)[0] for s in ("source2", "source3")}
    q, t = _sides(some)
    pairs = retrieve.union_candidates(q, t, cfg)
    tables.write_tsv(retrieve.candidate_lists(q, pairs), f"{out}/candidate_pairs", tables.CANDIDATE_COLUMNS)
    tables.write_tsv(pairs.selectExpr("s1_id AS source1_entity_id", "candidate_id AS candidate_entity_id", "source_dataset", "provenance_rules"), f"{out}/candidate_provenance", ["source1_entity_id", "candidate_entity_id", "source_dataset", "provenance_rules"])
    return validate.validate_file(spark, f"{out}/candidate_pairs", q.select(F.col("s1_id").alias("entity_id")), "candidate_entity_ids", known=t)
