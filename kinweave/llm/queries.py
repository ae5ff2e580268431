"""The queries of this subpackage and, where SQL can express one, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html, lines, mixing, neardup, packing, quality, secrets, topk, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """Where the tokenizer of the packing query is; the operator takes it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.copies(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    folder, tops = warc.archive(pages)
    got = warc.read_records(warc.look_up(pages, tops, folder), folder, with_payload=False)
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    got = toxicity.toxicity(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return got.select("doc_id", held_out.alias("held_out"), "toxicity.score", "toxicity.predicted")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = secrets.secrets(_table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("spans", lambda x: x["kind"].isin(*secrets.BASE))
    kinds = F.transform("spans", lambda x: x["kind"])
    number = [(F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in secrets.BASE]
    live = F.size(F.filter("spans", lambda x: x["live"])).cast("long").alias("n_live")
    return got.select("doc_id", *number, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), live)


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = html.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), "text")
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components(_table(spark, sf_dir, "documents"))


def op9_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality.quality(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    counts = [f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ratio")]
    return q.select("doc_id", *counts)


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_mix_to_weights, op2_warc_index, op3_exact_topk, op4_toxicity, op5_secrets, op6_fuzzy_lines, op7_main_text,
        op8_simhash_ball, op9_quality_ratio, op10_best_fit, pipeline,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """Exact search as SQL.  The other queries are held against plain versions in tests/llm."""
    return {
        "op3_exact_topk": """
            WITH v AS (
              SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
              FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            ), s AS (
              SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                     CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
            ), r AS (
              SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
            )
            SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    }
