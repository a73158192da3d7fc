import corpus_pipeline as P
from hestia.llm import simhash


def test_stages_on_odd_rows(spark, odd, empty, sf):
    for docs in (odd, empty):
        for name, stage in P.STAGES:
            out = stage(spark, docs, sf)
            left = out.count()
            assert left <= docs.count()
            if name != "tokens":
                assert out.columns == docs.columns
    assert {r.doc_id for r in P.identify_language(spark, odd, sf).collect()} >= {1, 2, 6, 9}


def test_run(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = P.run(spark, sf).cache()
    assert 0.6 * docs.count() < out.count() < docs.count() and set(docs.columns) < set(out.columns)
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    groups = {}
    for r in simhash.near_duplicates(out).collect():
        groups.setdefault(r.component_id, []).append(r.doc_id)
    assert all(len(g) == 1 for g in groups.values()) and len(kept) == out.count()
    assert out.where("n_tokens != size(ids)").count() == 0
