"""The pipeline's stages follow each other and keep the columns of documents."""

import corpus_pipeline
from livemart.llm import decontaminate, ngram_jaccard_join, toxicity


def test_stages_on_small_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "decontaminate", "domain_mixing", "shard_shuffle"]
    ids = {r.doc_id for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.score(docs, toxicity.fit(docs, labels)).where("toxic").collect()}
    now = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        now = stage(spark, now, folder)
        assert now.columns == docs.columns and now.schema.simpleString() == docs.schema.simpleString()
        left = {r.doc_id for r in now.collect()}
        assert left <= ids
        if k == 0:
            assert left == ids - toxic
        if k == 1:
            assert ngram_jaccard_join.ngram_jaccard_join(now).where("n_links > 0 or n_copies > 1").count() == 0
        if k == 2:
            assert decontaminate.leaks(now, bench).count() == 0
        ids = left
    last = corpus_pipeline.run(spark, folder)
    sizes = [r["count"] for r in last.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and {r.doc_id for r in last.collect()} <= {r.doc_id for r in docs.collect()}
