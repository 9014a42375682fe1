"""Stages of the corpus pipeline on a small table."""

import corpus_pipeline

BASE = " ".join(f"w{i}" for i in range(60))
ROWS = [(1, BASE), (2, BASE), (3, "other words entirely"), (3, "other words entirely"), (None, BASE), (None, BASE), (None, None), (None, None)]


def _docs(spark):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in ROWS],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def test_quality_without_labels_keeps_all(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.quality(spark, _docs(spark), str(tmp_path))
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == sorted((d or 0, t or "") for d, t in ROWS)


def test_near_duplicates_keep_rows_without_an_id(spark, tmp_path):
    got = corpus_pipeline.near_duplicates(spark, _docs(spark), str(tmp_path))
    want = [ROWS[0], ROWS[2], *ROWS[4:]]
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == sorted((d or 0, t or "") for d, t in want)
