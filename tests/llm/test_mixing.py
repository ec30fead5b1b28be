"""Mixing: targets by water filling, exact totals, limits, permutations and the texts themselves."""

import re

import pytest
from pyspark.sql import functions as F

from tidewatch.llm.mixing import mix, mixed_texts, permuted, words_taken

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected_targets(sizes):
    """sizes: source -> words."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    left, full, total = set(names), set(), 1.5 * sum(sizes.values())
    while left:
        level = (total - sum(2 * sizes[n] for n in full)) / sum(weight[n] for n in left)
        above = {n for n in left if weight[n] * level > 2 * sizes[n]}
        if not above:
            return {n: 2.0 * sizes[n] if n in full else weight[n] * level for n in names}
        left, full = left - above, full | above
    return {n: 2.0 * sizes[n] for n in names}


def check(docs, **options):
    frame = docs.select("doc_id", "source", "text").toPandas().astype(object)
    frame = frame.where(frame.notna(), None)
    frame["words"] = [len(WORD.findall(t or "")) for t in frame["text"]]
    sizes = {}
    for s, w in zip(frame["source"], frame["words"]):
        sizes[s] = sizes.get(s, 0) + w
    goal = expected_targets(sizes)
    out = words_taken(docs, **options).collect()
    assert len(out) == len(frame)
    assert sorted((str(r.doc_id), r.size) for r in out) == sorted((str(d), w) for d, w in zip(frame["doc_id"], frame["words"]))
    assert all(0 <= r.taken <= 2 * r.size for r in out)
    by_id = dict(zip(frame["doc_id"], frame["source"]))
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        name = by_id[r.doc_id]
        assert r.source_size == sizes[name] and r.target == pytest.approx(goal[name])
        taken[name] += r.taken
    for name in sizes:
        assert abs(taken[name] - goal[name]) <= 1, name
    return out


def test_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first = check(docs)
    assert sorted(first) == sorted(words_taken(docs.repartition(5)).collect())


EDGE = [
    (1, "z", "one two three"), (2, "z", None), (3, None, "a b c d\x0be"), (4, "é", "w " * 5000), (5, "a", ""), (6, "b", "x y z " * 30),
    (7, None, "solo"), (8, "b", "p " * 64), (8, "b", "p " * 64), (9, "", "empty name here"),
]


@pytest.mark.parametrize("block", [1, 7, 64, 100000])
def test_edge_cases(spark, block):
    docs = spark.createDataFrame(EDGE, "doc_id long, source string, text string").withColumn("target", F.lit("x")).withColumn("size", F.lit(1))
    check(docs, block_words=block, shard_slots=5)


def test_empty_table_and_no_words(spark):
    assert words_taken(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0
    rows = words_taken(spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id long, source string, text string")).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_permutation_hits_every_index_once(spark):
    for size in (1, 2, 5, 64, 1000):
        p = spark.range(size).select(permuted(F.col("id"), F.lit(size), 24, F.lit(3), F.lit("s")).alias("p")).collect()
        assert sorted(r.p for r in p) == list(range(size))


def test_shards_have_equal_slots_and_texts_are_the_words(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    m = mix(docs, block_words=50, shard_slots=20)
    per_shard = [r["count"] for r in m.slots.groupBy("shard").count().orderBy("shard").collect()]
    assert set(per_shard[:-1]) == {20} and 0 < per_shard[-1] <= 20
    texts = mixed_texts(docs, block_words=50, shard_slots=20).collect()
    assert len(texts) == sum(per_shard)
    words = {r.doc_id: WORD.findall(r.text or "") for r in docs.select("doc_id", "text").collect()}
    taken = {r.doc_id: r.taken for r in words_taken(docs, block_words=50, shard_slots=20).collect()}
    assert sum(len(r.text.split(" ")) for r in texts) == sum(taken.values())
    known = {d: set(w) for d, w in words.items()}
    for r in texts:
        assert set(r.text.split(" ")) <= set().union(*(known[d] for d in r.doc_ids))


def test_texts_of_null_and_repeated_ids(spark):
    """Two passes over one source: every word stands in the mix twice, in its block, whatever the ids are."""
    rows = [(None, "a", "n1 n2 n3 n4"), (None, "a", "m1 m2"), (5, "a", "r1 r2 r3"), (5, "a", "r1 r2 r3"), (5, "a", "s1 s2 s3 s4 s5"), (6, "a", "t1 " * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    every = sorted(WORD.findall(" ".join(r[2] for r in rows)) * 2)
    texts = mixed_texts(docs, share=2.0, block_words=7, shard_slots=4).collect()
    assert sorted(w for r in texts for w in r.text.split(" ")) == every
    assert all(len(r.text.split(" ")) <= 7 for r in texts)
    half = words_taken(docs, share=1.5, block_words=7, shard_slots=4).collect()
    assert sum(r.taken for r in half) == round(0.75 * len(every))


def test_query_counts_the_written_mix(spark, folder, monkeypatch):
    from tidewatch.llm import mixing

    kept = []
    monkeypatch.setattr(mixing, "stored", lambda df, *more, write=mixing.stored: kept.append(write(df, *more)) or kept[-1])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    taken = words_taken(docs).agg(F.sum("taken")).first()[0]
    written = [df for df in kept if {"shard", "k", "text"} <= set(df.columns)]
    assert len(written) == 1 and sum(len(r.text.split(" ")) for r in written[0].collect()) == taken
