"""Suffix dedup against a dictionary of all windows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import suffix_dedup
from tidewatch.llm.deep_shallow import BlindTrie, sort_suffixes
from tidewatch.llm.suffix_dedup import remove_repeats


def brute(rows, length=50):
    far = 2**63 - 1
    raw = [((far if d is None else d), (t or "").encode()) for d, t in rows]
    least = {}
    for d, b in raw:
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            least[w] = min(least.get(w, far), d)
    out = []
    for (d, _), (key, b) in zip(rows, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if least[b[i : i + length]] < key:
                gone[i : i + length] = b"\1" * length
        spans, i = [], 0
        while i < len(gone):
            j = i
            while j < len(gone) and gone[j]:
                j += 1
            if j > i:
                spans.append((i, j))
            i = max(j, i + 1)
        out.append((d, len(b), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def result(frame):
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) for r in frame.collect()), key=str)


def made_up(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(["the ", "and ", "é", "ti", "on ", "wh", "\n", "ouré", "x"]) for _ in range(n))
    base = [text(rng.randint(0, 120)) for _ in range(30)]
    rows = [(i, b) for i, b in enumerate(base)]
    for i in range(30, 90):
        a, b = rng.choice(base), rng.choice(base)
        cut = rng.randint(0, len(a))
        kind = rng.randrange(4)
        if kind == 0:
            new = a
        elif kind == 1:
            new = a[:cut] + text(3) + a[cut:]
        elif kind == 2:
            new = a[:cut] + b[len(b) // 2 :] + a[cut:]
        else:
            new = (a[:60] + "|") * rng.randint(1, 5)
        rows.append((i, new))
    rng.shuffle(rows)
    return rows


EDGE = [
    (None, "q" * 120), (None, "q" * 120), (500, "q" * 49), (501, "q" * 50), (502, "q" * 51), (503, None), (504, ""), (505, "q" * 51 + "é" * 200),
    (506, "é" * 26), (507, "abc" * 40), (507, "abc" * 40), (507, "cab" * 40), (-3, "abc" * 16 + "ab"), (508, "long words here " * 40000),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_as_brute_force(spark, seed, monkeypatch):
    rows = made_up(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("removed", F.lit("x"))
    assert result(remove_repeats(docs.repartition(3), bucket_bytes=700, slice_bytes=900)) == brute(rows)
    assert result(remove_repeats(docs, length=20)) == brute(rows, 20)


def test_edge_cases(spark):
    rows = EDGE + made_up(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(remove_repeats(docs, bucket_bytes=100000)) == brute(rows)
    assert remove_repeats(docs.limit(0)).count() == 0


def test_units_cut_anywhere_give_the_same(spark, monkeypatch):
    rows = made_up(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    task = suffix_dedup._deal(3, 50)
    batch = docs.selectExpr("doc_id id", "0L tie", "text").toArrow().to_batches()[0]

    def spans():
        blobs = {}
        for b in task([batch]):
            for r in b.to_pylist():
                blobs.setdefault(r["bucket"], []).append((r["kind"], r["blob"]))
        return [x.tolist() for x in suffix_dedup.merge_spans(*(np.concatenate(c) for c in zip(*(suffix_dedup.settle(v, 50) for v in blobs.values()))))]

    whole = spans()
    monkeypatch.setattr(suffix_dedup, "UNIT_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "_STEP", 777)
    assert spans() == whole


def test_sorts_suffixes():
    rng = np.random.default_rng(1)
    data = np.concatenate([rng.integers(97, 99, 4000).astype(np.uint8), np.zeros(60, np.uint8)])
    data[1000:1400] = data[2000:2400]
    data[3000:3200] = 97
    starts = np.arange(4000)
    order, opens = sort_suffixes(data, starts, 50)
    keys = [data[s : s + 50].tobytes() for s in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == starts.tolist()
    assert opens.tolist() == [i == 0 or keys[i] != keys[i - 1] for i in range(len(keys))]


def test_blind_trie():
    rng = random.Random(2)
    strings = [bytes(rng.choice(b"ab") for _ in range(6)) for _ in range(200)]
    trie = BlindTrie()
    for n, s in enumerate(strings):
        trie.insert(s, n)
    leaves = list(trie.leaves())
    assert [strings[m[0]] for m in leaves] == sorted(set(strings))
    assert all(strings[i] == strings[m[0]] for m in leaves for i in m) and sum(map(len, leaves)) == 200


RUNS = [
    (1, "-" * 3000 + "x"), (2, "q " * 900), (3, "y" + "-" * 500 + "z" + "q " * 200), (4, "-" * 49 + "u" + "-" * 70), (5, "abc" * 300 + "-" * 60),
    (6, "".join(f"{n % 7:>17}" for n in range(120))), (7, "".join(f"{n % 5:>17}" for n in range(90))), (None, " " * 400), (7, "-" * 120),
]


def test_runs_leave_a_unit_as_ranges():
    """One byte or two over and over: not a record for every place."""
    texts = ["-" * 1_000_000, "q " * 400_000]
    names = ["id", "tie", "text"]
    batch = suffix_dedup.pa.RecordBatch.from_arrays([suffix_dedup.pa.array(c) for c in ([1, 2], [0, 0], texts)], names)
    rows = sum(
        int(np.frombuffer(suffix_dedup.zstandard.decompress(r["blob"]), np.int64, 1)[0]) for b in suffix_dedup._deal(3, 50)([batch]) for r in b.to_pylist()
    )
    assert rows < 100


@pytest.mark.parametrize("hot_rows", [1, 20])
def test_hot_anchors_as_brute_force(spark, hot_rows):
    rows = RUNS + made_up(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keyed = docs.selectExpr("coalesce(doc_id, 9223372036854775807L) id", "0L tie", "text").fillna("")
    assert len(suffix_dedup.hot_anchors(keyed, 10**6, 50, hot_rows)) > 0
    assert result(remove_repeats(docs, hot_rows=hot_rows, bucket_bytes=2000, slice_bytes=3000)) == brute(rows)


def test_no_bucket_holds_a_hot_anchor():
    """Padded figures: one anchor for almost every place, all different."""
    rng = random.Random(6)
    word = lambda c: np.frombuffer(c.encode() * 8, "<u8")
    pad = min("-_=.*# ~+", key=lambda c: int(suffix_dedup._hash(word(c), word(c))[0]))
    text = "".join(f"{rng.randrange(10**6):{pad}>45}" for _ in range(4000))
    batch = suffix_dedup.pa.RecordBatch.from_arrays([suffix_dedup.pa.array(c) for c in ([1], [0], [text])], ["id", "tie", "text"])
    counts = [r for b in suffix_dedup._count_anchors(1, 50)([batch]) for r in b.to_pylist()]
    hot = np.array([r["anchor"] for r in counts if r["rows"] > 5000], np.int64).view(np.uint64)

    def largest(*hot):
        sizes = {}
        for b in suffix_dedup._deal(40, 50, *hot)([batch]):
            for r in b.to_pylist():
                sizes[r["bucket"]] = sizes.get(r["bucket"], 0) + int(np.frombuffer(suffix_dedup.zstandard.decompress(r["blob"]), np.int64, 1)[0])
        return max(sizes.values(), default=0)

    assert len(hot) and largest() > 5000 and largest(hot) < 5000
