"""The pipeline's stages, one by one and together."""

import corpus_pipeline as pipeline
from firnline.llm import decontaminate, lines, quality, queries
from firnline.session import stage

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("hits", quality.F.lit("x"))
    seen = {}
    for name, function in pipeline.STAGES:
        seen[name] = (docs, out := stage(function(spark, docs, FOLDER), name))
        docs = out
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality_filter", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"]
    for name in names[:-1]:
        given, out = seen[name]
        assert out.columns == given.columns and 0 < out.count() <= given.count()
    given, out = seen["quality_filter"]
    scores = {r.doc_id: r.predicted for r in queries.op9_quality(spark, FOLDER).collect()}
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in given.collect() if scores[r.doc_id]}
    given, out = seen["line_dedup"]
    want = {r.doc_id: r.text for r in lines.without_boilerplate(given).collect()}
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {d: (t, len(t)) for d, t in want.items()}
    given, out = seen["near_dedup"]
    assert {r.text for r in given.collect()} >= {r.text for r in out.collect()}
    assert len({r.text for r in out.collect()}) == out.count()
    given, out = seen["decontamination"]
    clean = decontaminate.with_hits(given, spark.read.parquet(f"{FOLDER}/benchmark.parquet"), column="found")
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in clean.filter("found.n_hit = 0").collect()}
    given, out = seen["best_fit_packing"]
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in given.collect()}
    assert out.count() == pipeline.run(spark, FOLDER).count()


def test_stages_on_odd_rows(spark, odd, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    for name, function in pipeline.STAGES:
        assert function(spark, odd.limit(0), str(tmp_path)).count() == 0, name
        function(spark, odd, str(tmp_path)).collect()
