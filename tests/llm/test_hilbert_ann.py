"""Nearest neighbours against brute force."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm.hilbert_ann import hilbert_keys, nearest


def brute(rows, queries, count):
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    out = {}
    for q in queries:
        scores = vectors @ vectors[list(ids).index(q)]
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-round(scores[i], 9), ids[i]))[:count]
        out[q] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def result(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def share(got, expected):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in e}) for q, e in expected.items())
    return hits / sum(map(len, expected.values()))


def test_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    expected = brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    got = result(nearest(table, is_query=F.col("id") % 20 == 0, block_rows=64))
    assert set(got) == set(expected) and share(got, expected) >= 0.9
    by_id = dict(rows)
    for q, found in got.items():
        assert len(found) == 20 and all(abs(s - np.dot(np.float64(by_id[q]), np.float64(by_id[i]))) < 1e-12 for i, s in found)


@pytest.mark.parametrize("scale", [False, True])
def test_clusters_with_narrow_windows(spark, scale):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(150, 24))
    vectors = np.repeat(middles, 20, 0) + 0.05 * rng.normal(size=(3000, 24))
    if scale:
        vectors *= rng.uniform(0.5, 2, (3000, 1))
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors.astype(np.float32))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = result(nearest(table, is_query=F.col("id") % 20 == 0, count=10, block_rows=256, query_rows=40))
    assert share(got, brute(rows, range(0, 3000, 20), 10)) >= 0.9


def test_copies_ties_and_vectors_without_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(0, 60)] + [(100 + i, [0.5, float(i), 1.0]) for i in range(10)] + [(120, [-0.0, 2.0, 0.0])]
    bad = [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 0.0]), (260, [nan, 1.0, 1.0]), (280, [inf, 0.0, 0.0]), (300, []), (320, [1.0, 2.0]), (None, [9.0, 9.0, 9.0])]
    schema = "vec_id long, embedding array<double>"
    table = spark.createDataFrame(rows + bad + rows[:3], schema).withColumn("rank", F.lit("x")).withColumn("score", F.lit("y"))
    got = result(nearest(table, is_query=F.col("id") % 20 == 0, count=5))
    assert got == brute(rows, [0, 20, 40, 100, 120], 5)
    assert nearest(table.limit(0)).count() == 0
    few = spark.createDataFrame(rows[:1] + rows[60:62], schema)
    assert {q: len(f) for q, f in result(nearest(few, count=5)).items()} == {0: 2, 100: 2, 101: 2}
    assert nearest(spark.createDataFrame(rows[:1], schema)).count() == 0


def test_hilbert_curve_visits_neighbouring_cells():
    for n, bits in ((2, 3), (3, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        keys = hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
