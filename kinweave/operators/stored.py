"""Tables that a later step reads more than once, written to a folder that driver and executors share."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI under ``spark.checkpoint.dir``, which driver and executors all see.

    Where the setting is absent (single-machine tests) a temporary folder stands in for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _OWN.setdefault("base", "file://" + tempfile.mkdtemp(prefix="kinweave-"))
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + base if base.startswith("/") else base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    It cuts the lineage: a lost executor costs a re-read of files, not a re-run of the plan.  The
    folder's URI is in the frame's ``kinweave_folder`` attribute, for ``forget``.
    """
    spark = df.sparkSession
    to = shared_folder(spark, name)
    df.write.parquet(to)
    out = spark.read.schema(df.schema).parquet(to)
    out.kinweave_folder = to
    return out


def forget(df: DataFrame) -> None:
    """Delete what ``written`` wrote; only for tables that no later plan reads."""
    to = getattr(df, "kinweave_folder", None)
    if to:
        jvm, spark = df.sparkSession._jvm, df.sparkSession
        path = jvm.org.apache.hadoop.fs.Path(to)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def forget_own() -> None:
    """Delete the stand-in for ``spark.checkpoint.dir``."""
    if base := _OWN.pop("base", None):
        shutil.rmtree(urlparse(base).path, ignore_errors=True)
