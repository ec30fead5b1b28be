"""The pipeline's stages against plain versions of their decisions."""

import hashlib

from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import rule_quality

import test_decontaminate
import test_secret_scan
import test_simhash


def test_stages_take_effect_and_keep_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("component_id", F.lit("own")).withColumn("found", F.lit(1))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "secrets", "mix"]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, before, folder))
        was, now = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}
        assert len(now) == after.count()
        if name != "mix":
            assert after.columns == docs.columns and set(now) <= set(was)
        if name == "quality":
            model = rule_quality.fit(before, labels)
            good = {r.doc_id for r in rule_quality.score(before, model).filter("__score >= 0.3").select("doc_id").collect()}
            assert set(now) == good and all(now[d] == was[d] for d in now)
        elif name == "near_duplicates":
            groups = test_simhash.brute([(d, r.text) for d, r in was.items()])
            assert set(now) == {g[2] for g in groups} and all(now[d] == was[d] for d in now)
        elif name == "decontamination":
            assert set(now) == set(was)
            hit = {r[0]: r[2] for r in test_decontaminate.brute([(d, r.text) for d, r in was.items()], items)}
            for d in now:
                assert (now[d] == was[d]) == (hit[d] == 0)
                assert len(test_decontaminate.words(now[d].text)) <= len(test_decontaminate.words(was[d].text)) - hit[d] + 0 or hit[d] == 0
        elif name == "secrets":
            assert set(now) == set(was)
            for d in now:
                spans = test_secret_scan.brute(was[d].text)
                assert (now[d] == was[d]) == (not spans)
                assert not test_secret_scan.brute(now[d].text)
        else:
            assert set(now) == set(was)
            assert abs(sum(r.taken for r in now.values()) - 1.5 * sum(r.size for r in now.values())) <= 20
        before = after
    run = corpus_pipeline.run(spark, folder)
    digest = lambda rows: hashlib.sha256(str(sorted(map(str, rows))).encode()).hexdigest()
    assert digest(run.collect()) == digest(before.collect())
