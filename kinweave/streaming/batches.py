"""Queries that arrive in files, answered batch by batch.

A checkpoint says which files are done, and each batch overwrites the folder of its own number, so a
run that was broken off goes on where it stopped and writes nothing twice.  Metrics come from what was
written, not from counters kept along the way.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BlockingConfig
from ..operators.retrieve import scored_candidates
from ..operators.stored import shared_folder, written


def fingerprint(mode: str, inputs: dict[str, str], cfg: BlockingConfig) -> str:
    """Names a run: other inputs or parameters make another name, and so another folder.  ``inputs`` says what they hold (``state_of``)."""
    return hashlib.sha256(json.dumps([mode, inputs, {k: str(v) for k, v in cfg.__dict__.items()}], sort_keys=True).encode()).hexdigest()[:16]


def state_of(spark: SparkSession, path: str) -> str:
    """The files of a path with their sizes and times, as text: it changes if an input does."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files, found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return "\n".join(sorted(found))


def hash_of(ids: DataFrame | None) -> str:
    """A sum over the hashes of the column entity_id, and how many there are; "" for no frame."""
    if ids is None:
        return ""
    return str(tuple(ids.agg(F.count("entity_id"), F.sum(F.xxhash64("entity_id").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("entity_id"))).first()))


def answer_stream(stream: DataFrame, targets: DataFrame, cfg: BlockingConfig, folder: str):
    """Start answering a stream of queries (s1_id and the normalised columns) into ``folder``/candidates; ends when nothing new is there."""

    def batch(rows: DataFrame, number: int) -> None:
        got = scored_candidates(rows.dropDuplicates(["s1_id"]), targets, cfg)
        got.write.mode("overwrite").parquet(f"{folder}/candidates/batch_id={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


def candidates_of_stream(spark: SparkSession, queries: DataFrame, targets: DataFrame, cfg: BlockingConfig, folder: str | None = None, files: int = 3) -> DataFrame:
    """Write ``queries`` as files, answer them as a stream, and read what was written."""
    folder = folder or shared_folder(spark, "stream")
    targets = written(targets, "targets")
    columns = ["s1_id", "business_name_norm", "business_address_norm", "country_norm"]
    queries.select(*columns).repartition(files, "s1_id").write.mode("overwrite").parquet(f"{folder}/queries")
    stream = spark.readStream.schema(queries.select(*columns).schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/queries")
    answer_stream(stream, targets, cfg, folder).awaitTermination()
    return spark.read.parquet(f"{folder}/candidates").select("s1_id", "candidate_id", "source_dataset", "rule_name", F.col("score"))
