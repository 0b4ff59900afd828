"""The pipeline's stages, one after another, against brute force on the smallest tables."""

import corpus_pipeline as pipe
from pyspark.sql import functions as F

from tests.llm.test_operators import brute_classes
from treelab.llm import decontamination, mixing, tokens
from treelab.llm.shared import settle, staged, table


def test_stages(spark, data):
    docs = table(spark, data, "documents")
    seen = {}
    for name, stage in pipe.STAGES:
        before, docs = docs, settle(stage(spark, docs, data), "stage")
        seen[name] = (before, docs)
        if name != "token_shards":
            assert docs.columns == before.columns
    before, after = seen["toxicity"]
    labels = table(spark, data, "labels")
    assert before.join(labels, "doc_id").where("toxic = 0").join(after, "doc_id", "left_anti").count() <= 2
    assert after.join(labels, "doc_id").where("toxic = 1").count() < labels.where("toxic = 1").count()
    before, after = seen["near_dedup"]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    groups = brute_classes(rows)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(rows[g[0]][0] for g in groups)
    before, after = seen["decontamination"]
    items = [" ".join(r["text"].split()) for r in table(spark, data, "benchmark").collect()]
    leaked = {r["doc_id"] for r in before.collect() if any(x in " ".join(r["text"].split()) for x in items)}
    held = {r["doc_id"] for r in decontamination.matches(before, table(spark, data, "benchmark")).collect()}
    assert leaked <= held and {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - held
    before, after = seen["mixing"]
    chosen = dict(mixing.select(before, **pipe.MIXTURE).select("doc_id", "copies").collect())
    assert dict(after.groupBy("doc_id").count().collect()) == chosen
    before, after = seen["token_shards"]
    assert after.count() == before.count() and after.where("n_tokens < 1").count() == 0
    whole = pipe.run(spark, data)
    assert sorted(whole.drop("shard").collect()) == sorted(after.drop("shard").collect())
    assert whole.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] == whole.agg(F.sum("n_tokens")).first()[0]


def test_stages_release_what_is_not_read(spark, data):
    import glob
    import os

    from treelab.functions.storage import shared_dir

    tables = lambda name: set(glob.glob(os.path.join(shared_dir(spark).replace("file:", ""), f"{name}-*")))
    before = tables("made")
    first = staged(lambda spark, docs, sf_dir: settle(docs, "made"))
    other = staged(lambda spark, docs, sf_dir: docs)
    docs = table(spark, data, "documents")
    passed = first(spark, docs, data)
    made = tables("made") - before
    assert len(made) == 1
    kept = other(spark, passed.where("doc_id >= 0"), data)
    assert tables("made") - before == made and kept.count() == docs.where("doc_id >= 0").count()
    other(spark, docs, data)
    assert tables("made") == before


def test_empty_documents(spark, data):
    docs = table(spark, data, "documents").limit(0)
    for _, stage in pipe.STAGES:
        docs = stage(spark, docs, data)
    assert docs.count() == 0 and tokens is not None
