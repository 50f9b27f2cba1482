import corpus_pipeline as p
from helixframe.llm import decontaminate, exact_dedup, jaccard, quality
from pyspark.sql import functions as F


def test_stages_work_on_what_the_one_before_kept(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in p.STAGES[:-1]:
        after = p.saved(stage(spark, docs, sf), "stage")
        assert after.columns == columns, name
        assert 0 < after.count() <= docs.count()
        assert after.join(docs, columns, "left_anti").count() == 0
        docs = after
    # what a stage decides has taken effect
    assert exact_dedup.mark_copies(docs).where("not kept").count() == 0
    near = jaccard.near_duplicates(docs)
    assert near.where(F.col("component_id") != F.col("doc_id")).count() == 0
    assert decontaminate.find_leaks(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
    packed = p.pack(spark, docs, sf)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_run_and_clashing_columns(spark, sf, edge_docs, no_docs):
    assert p.run(spark, sf).count() > 0
    for name, stage in p.STAGES[:-1]:
        assert stage(spark, edge_docs, sf).columns == edge_docs.columns, name
        assert stage(spark, no_docs, sf).count() == 0, name
    assert p.pack(spark, no_docs, sf).count() == 0
    assert quality.TERMS and p.ORACLE_SQL is None
