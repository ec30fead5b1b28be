"""Toxicity: the kernel against its definition, held-out accuracy, altered insults, and odd inputs."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import toxicity
from tidewatch.llm.string_kernel import kernel, raw_kernel, self_kernel
from tidewatch.llm.toxicity import Model, fit, held_out, score


def by_definition(s, t, length, decay):
    total = 0.0
    for a in itertools.combinations(range(len(s)), length):
        for b in itertools.combinations(range(len(t)), length):
            if [s[i] for i in a] == [t[i] for i in b]:
                total += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


@pytest.mark.parametrize("length", [2, 3])
def test_kernel_as_defined(length):
    left, right = ["idiot", "idxiot", "ab", "", "aaaa", "éäéä", "toidi"], ["idiot", "aaa", "éäö", "diet"]
    expected = [[by_definition(s, t, length, 0.7) for t in right] for s in left]
    assert np.allclose(raw_kernel(left, right, length, 0.7), expected, rtol=1e-4, atol=1e-6)
    assert np.allclose(self_kernel(left, length, 0.7), [by_definition(s, s, length, 0.7) for s in left], rtol=1e-4, atol=1e-6)


def test_normalised_kernel_favours_altered_words():
    value = kernel(["idiot", "idioot", "idxiot", "thing", "it"], ["idiot"])[:, 0]
    assert value[0] == pytest.approx(1, abs=1e-4) and value[1] > value[3] and value[2] > 10 * value[3] and value[4] == 0


def test_words():
    assert toxicity.words_of("You i d i o t, (i.d.i.o.t) x y lo-ser!") == ["You", "idiot", "idiot", "loser"]
    assert [sorted(p) for p in toxicity.pieces_of("Abc def. Ghi\njkl? " + "word " * 40)] == [["abc", "def"], ["ghi"], ["jkl"], ["word"], ["word"], ["word"]]
    assert toxicity.pieces_of(None) == [] and toxicity.parts_of("x" * 60)[0] == "x" * 24


@pytest.fixture(scope="module")
def trained(spark):
    """Clean prose of the test tables; every third document has one of a few insults put in."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("toxic = 0").select("doc_id"), "doc_id"
    )
    insults = F.array(*map(F.lit, ["moron", "stinkard", "blockhead", "numbskull"]))
    word = F.element_at(insults, (F.col("doc_id") % 4 + 1).cast("int"))
    toxic = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    docs = docs.select("doc_id", F.when(toxic, F.concat(word, F.lit(" "), "text")).otherwise(F.col("text")).alias("text"), toxic.cast("int").alias("toxic"))
    docs = docs.checkpoint() if spark.sparkContext.getCheckpointDir() else docs
    return docs, fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))


def test_held_out_documents_and_altered_insults(spark, trained):
    docs, model = trained
    rows = [r for r in score(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(rows) > 50 and sum((r["__score"] >= 0.7) == bool(r.toxic) for r in rows) / len(rows) >= 0.95
    texts = ["a stinkkard here", "you numbxskull.", "block-head and so on", "what an m o r o n he is", "The thing with the rest."]
    out = score(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    got = [r["__score"] for r in out]
    assert min(got[:4]) >= 0.5 and max(got[2:4]) >= 0.7 and got[4] < 0.1, got


def test_labels_of_held_out_rows_do_not_matter(spark, trained):
    docs, model = trained
    labels = docs.select("doc_id", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"))
    assert fit(docs, labels).landmarks == model.landmarks


def test_odd_inputs(spark, trained):
    docs, model = trained
    rows = [(1, None, "x"), (None, "", None), (3, " \n ", None), (4, "word " * 300000, "y"), (5, "q" * 100000, "z"), (5, "moron", "z"), (5, "moron", "z")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = score(odd, model).collect()
    assert len(out) == 7 and all(0 <= r["__score"] <= 1 for r in out)
    assert out[0]["__score"] == out[1]["__score"] == out[2]["__score"] < 0.7 <= out[5]["__score"] == out[6]["__score"]
    assert score(odd.limit(0), model).count() == 0
    none = docs.select("doc_id", "toxic").limit(0)
    assert fit(docs, none) == Model((), (), 0.0, 0.0, 0.0)
    clean = fit(docs, docs.select("doc_id", F.lit(0).alias("toxic")))
    assert score(odd, clean).filter("__score >= 0.1").count() == 0
