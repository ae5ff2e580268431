"""The stages of the corpus pipeline on the smallest tables."""

import os
import sys

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def test_stages(spark):
    import corpus_pipeline
    from test_llm import plain_first

    from kinweave.llm import quality
    from kinweave.llm.shared import written

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    after = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), name)
        after[name] = docs
        if name != "packing":
            assert docs.columns == before.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = quality.quality(after["documents"], labels).where("quality.kept").select("doc_id")
    assert {r[0] for r in kept.collect()} == {r[0] for r in after["quality"].select("doc_id").collect()}
    assert after["line_dedup"].where(F.length("text") != F.col("n_chars")).count() == 0
    groups = plain_first([(r["doc_id"], r["text"]) for r in after["line_dedup"].select("doc_id", "text").collect()])
    assert sorted(r["doc_id"] for r in after["near_dedup"].select("doc_id").collect()) == sorted(min(d for d, _ in g) for g in groups)
    mixed = after["mixing"].groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert mixed <= 3
    assert after["packing"].where("piece = 0").count() == after["mixing"].count()


def test_run_on_odd_rows(spark, tmp_path):
    """Null, empty, repeated and very long texts, null ids, unlike texts under one id, and an extra column with a name that stages use."""
    import corpus_pipeline
    from test_llm import plain_first, plain_lines, text_of

    good = [(i, text_of(60 + i, 300 + i), "en", "ab"[i % 2], 1) for i in range(30)]
    odd = [(100, None, "en", "a", 0), (101, "", None, None, 0), (None, text_of(70, 1), "en", "a", 1), (None, text_of(70, 2), "en", "b", 1), (5, text_of(80, 3), "en", None, 1), (102, text_of(9000, 4), "en", "a", 1)]
    odd += [good[3], good[3], (103, good[4][1], "en", "a", 1), (104, good[5][1] + "\n" + text_of(40, 9), "en", "b", 1)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, 1) for r in good + odd], columns + ", n_removed int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path), f"{tmp_path}/run").collect()
    after = {name: [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/run/{name}").collect()] for name, _ in corpus_pipeline.STAGES[:-1]}
    assert {d for d, _ in after["quality"]} == {r[0] for r in good + odd} - {100, 101}
    rows = sorted(set(after["quality"]), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    numbered = {i: r for i, r in enumerate(rows)}
    gone = plain_lines([(i, t) for i, (_, t) in numbered.items()])
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, (_, t) in numbered.items()}
    assert set(after["line_dedup"]) == {(numbered[i][0], t) for i, t in want.items() if t}
    assert len(after["near_dedup"]) == len(plain_first(sorted(set(after["line_dedup"]), key=repr))) and set(after["near_dedup"]) <= set(after["line_dedup"])
    assert set(after["mixing"]) <= set(after["near_dedup"]) and max(after["mixing"].count(r) for r in after["mixing"]) <= 3
    assert sum(r["piece"] == 0 for r in packed) == len(after["mixing"]) and max(r["offset"] + r["length"] for r in packed) <= 4096
    assert [c for c, _ in docs.dtypes] == spark.read.parquet(f"{tmp_path}/run/mixing").columns
    assert len(corpus_pipeline.run(spark, str(tmp_path)).collect()) == len(packed)
