"""Quality rules: compiled scores against rules applied one by one, held-out accuracy, and odd inputs."""

import math
import zlib

from pyspark.sql import functions as F

from tidewatch.llm.rule_quality import RuleModel, accepted, fit, held_out, paths, score, statistics


def labelled(spark, folder):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    return docs, labels


def test_scores_are_the_rules_and_held_out_documents_are_told_apart(spark):
    docs, labels = labelled(spark, "/root/testdata/sf0.01")
    model = fit(docs, labels)
    assert model.rules
    stats = statistics(F.col("text"))
    rows = score(docs, model).withColumns({f"s_{n}": c for n, c in stats.items()}).join(labels.select("doc_id", "quality"), "doc_id", "left").collect()
    right = wrong = 0
    for r in rows:
        value = {n: r[f"s_{n}"] for n in stats}
        margin = model.intercept + sum(w for rule, w in model.rules if rule.holds(value))
        assert math.isclose(r["__score"], 1 / (1 + math.exp(-margin)), rel_tol=1e-9)
        if r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
            if (r["__score"] >= 0.3) == bool(r.quality):
                right += 1
            else:
                wrong += 1
    assert right / (right + wrong) >= 0.95


def test_labels_of_held_out_rows_do_not_matter(spark, folder):
    docs, labels = labelled(spark, folder)
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert fit(docs, labels) == fit(docs, flipped)


def test_odd_inputs(spark, folder):
    docs, labels = labelled(spark, folder)
    model = fit(docs, labels)
    odd = spark.createDataFrame(
        [(1, None, 5.0), (None, "", 5.0), (3, " \n ", None), (4, "word " * 300000, 1.0), (4, "a b c", 1.0), (4, "a b c", 1.0), (5, "é", 1.0)],
        "doc_id long, text string, symbols double",
    )
    out = score(odd, model).collect()
    assert len(out) == 7 and all(0 <= r["__score"] <= 1 for r in out)
    assert out[0]["__score"] == out[1]["__score"]
    assert score(odd.limit(0), model).count() == 0
    none = labels.limit(0)
    assert fit(docs, none) == RuleModel(0.0)
    assert accepted(docs, none).count() == docs.count()
    good = fit(docs, labels.withColumn("quality", F.lit(1)).union(labels.limit(1).select(F.lit(None), F.lit(None), F.lit(None))))
    assert not good.rules and good.intercept > 0


def test_paths_of_a_printed_tree():
    text = "m\n  Tree 0 (weight 1.0):\n    If (feature 0 <= 0.5)\n     If (feature 1 <= 2.0)\n      Predict: 0.0\n     Else (feature 1 > 2.0)\n      Predict: 1.0\n    Else (feature 0 > 0.5)\n     Predict: 1.0\n"  # noqa: E501
    found = {(r.above, r.below) for r in paths(text, ["a", "b"])}
    assert found == {((), (("a", 0.5),)), ((), (("a", 0.5), ("b", 2.0))), ((("b", 2.0),), (("a", 0.5),)), ((("a", 0.5),), ())}
