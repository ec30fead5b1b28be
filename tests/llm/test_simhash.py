"""SimHash groups against all pairs and plain union-find."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.components import connected
from tidewatch.llm.simhash import group_prints, keep_one, near_duplicates


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, bits):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits and find(i) != find(j):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    group = roots(prints, 2)
    out = []
    for (doc, _), p, g in zip(rows, prints, group):
        ids = [d for (d, _), h in zip(rows, group) if h == g and d is not None]
        out.append((doc, f"{p:016x}", min(ids, default=None)))
    return sorted(out, key=str)


EDGE = [
    (900001, None), (900002, ""), (900003, " \n\t"), (900004, "One"), (900005, "one"), (900006, "a\x0bb\x0cc d e"),
    (None, "one"), (None, "only here and nowhere else"), (900007, "word " * 70000), (900005, "one"),
]


def test_groups_as_brute_force_on_documents_and_edge_cases(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame(EDGE, "doc_id long, text string")
    rows = [tuple(r) for r in docs.union(extra).collect()]
    mixed = docs.union(extra).withColumn("component_id", F.lit("x")).withColumn("fingerprint", F.lit(1))
    assert sorted((tuple(r) for r in near_duplicates(mixed).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("small", [0, 1000])
@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_near_fingerprints_in_small_and_crowded_buckets(spark, bits, small, monkeypatch):
    from tidewatch.llm import simhash

    rng = random.Random(bits)
    values = set()
    for _ in range(40):
        value = rng.getrandbits(64)
        for _ in range(8):
            values.add(value)
            for _ in range(rng.randint(0, 3)):
                value ^= 1 << rng.randrange(64)
    values = sorted(values)
    plain = simhash.link_edges
    monkeypatch.setattr(simhash, "link_edges", lambda p, b: plain(p, b, small))
    signed = [(v - 2**64 if v >= 2**63 else v, n) for n, v in enumerate(values)]
    frame = spark.createDataFrame(signed, "__print long, id long")
    got = {r["print"] % 2**64: r["first_id"] for r in group_prints(frame, "id", bits).collect()}
    group = roots(values, bits)
    first = {}
    for n, g in enumerate(group):
        first.setdefault(g, n)
    assert [got[v] for v in values] == [first[g] for g in group]


def test_keeps_one_of_each_group(spark):
    rows = [(3, "a b c d", "x"), (1, "a b c d", "y"), (1, "a b c d", "y"), (None, "q r s t", "n"), (None, None, None), (7, "other words here now", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted({rows[1], rows[3], rows[4], rows[5]}, key=str)


def test_components_of_a_long_path_and_of_a_hub(spark):
    path = [(i, i + 1) for i in range(40)]
    hub = [(100, 100 + i) for i in range(1, 200)]
    got = dict(connected(spark.createDataFrame(path + hub, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(200)}}
    empty = spark.createDataFrame([], T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
    assert connected(empty).count() == 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).count() == 0 and keep_one(docs).count() == 0
