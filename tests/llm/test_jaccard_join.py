"""The Jaccard join against all pairs of sets."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import jaccard_join
from tidewatch.llm.jaccard_join import Block, Shingler, _stars, divide_skip, join
from tidewatch.llm.queries import op12_jaccard_join


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    having = {}
    for i, s in enumerate(sets):
        for x in s:
            having.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in having[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n) and find(i) != find(j):
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def result(frame):
    return sorted((tuple(r) for r in join(frame).collect()), key=str)


def near_copies(seed, texts, copies, alike):
    """Texts with chains and groups of copies that differ in single words, some around the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(texts):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        if rng.random() < alike:
            words += passage
        for _ in range(rng.randint(1, copies)):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], ["new", rng.choice(vocabulary)], [rng.choice(vocabulary)]])
                words = words or ["x"]
    rng.shuffle(rows)
    return rows


EDGE = [
    (9001, None), (9002, ""), (9003, " \n\t"), (9004, "One two"), (9005, "one TWO"), (9005, "one TWO"), (9006, "a\x0bb\x0cc d"), (9007, "a b c D"),
    (None, "one two"), (None, "only here and nowhere else at all"), (9008, "word " * 50000), (9009, "word word word word"), (9010, "É b c d"), (9011, "é b c d"),
    (9012, "A " + "Long" * 40 + " word here"), (9013, "a " + "lonG" * 40 + " word here"), (9014, "a " + "long" * 39 + " word here"),
]


@pytest.mark.parametrize("block", [40, 3000, 1 << 19])
def test_as_all_pairs_in_one_block_and_many(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(jaccard_join, "COMMON_LEVEL", 2)
    rows = near_copies(block, 60, 8, 0.5) + EDGE
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, set_id string, size int").repartition(5)
    assert result(frame) == plain(rows)


def test_query_on_the_whole_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op12_jaccard_join(spark, folder).collect()), key=str)
    assert got == plain(rows)
    assert any(d != c for d, _, c in got)


def test_divide_skip_counts_lists():
    rng = random.Random(3)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.randint(1, 25))) for _ in range(rng.randint(1, 12))]
        for need in range(1, len(lists) + 1):
            counts = {i: sum(i in x for x in lists) for i in range(40)}
            want = {(i, n) for i, n in counts.items() if n >= need}
            assert set(divide_skip([np.array(x) for x in lists], need)) == want


def test_near_misses_are_given_up_before_they_are_checked(monkeypatch):
    """Sets that share more than the least overlap of a set with any other, but too little for sets of their size."""
    rng = random.Random(5)
    base = rng.sample(range(1 << 40), 140)
    sets = [np.array(sorted([*rng.sample(base, 130), *rng.sample(range(1 << 41, 1 << 42), 10)]), np.uint64) for _ in range(300)]
    sets += [np.append(s[:-1], np.uint64(1 << 43)) for s in sets[:20]]
    named = []

    def recorded(*args, search=jaccard_join.divide_skip):
        found = list(search(*args))
        named.extend(found)
        return found

    monkeypatch.setattr(jaccard_join, "divide_skip", recorded)
    block = Block(list(range(320)), sets)
    linked = {(max(p), min(p)) for p in block.links()}
    assert {p for p in linked if p[0] >= 300} >= {(300 + i, i) for i in range(20)}
    assert all(100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b])) for a, b in linked)
    assert len(named) <= 320


def test_divide_skip_keeps_to_the_need_of_each_id():
    rng = random.Random(4)
    for _ in range(200):
        lists = [np.array(sorted(rng.sample(range(60), rng.randint(1, 50)))) for _ in range(rng.randint(1, 30))]
        least = np.array([rng.randint(0, 31) for _ in range(60)])
        for need in range(1, len(lists) + 1):
            counts = {i: sum(i in x for x in lists) for i in range(60)}
            assert set(divide_skip(lists, need, least)) == {(i, n) for i, n in counts.items() if n >= max(need, least[i])}


def test_pairs_become_stars():
    assert sorted(_stars([(5, 4), (3, 4), (9, 8), (3, 1), (7, 8), (8, 9)])) == [(3, 1), (4, 1), (5, 1), (8, 7), (9, 7)]
    assert _stars([]) == []


def test_blocks_connect_as_all_links():
    rows = near_copies(9, 25, 9, 0.8)
    rows = [r for r in rows if shingles(r[1])]
    members, visitors = rows[: len(rows) // 2], rows[len(rows) // 2 :]
    coded = dict(zip([d for d, _ in rows], Shingler().sets(pa.array([t for _, t in rows]))))
    block = Block([d for d, _ in members], [coded[d] for d, _ in members])
    pairs = list(block.links())
    for d, _ in visitors:
        pairs += block.visit(d, coded[d])
    sets = {d: shingles(t) for d, t in rows}

    def links(a, b):
        return 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])

    assert all(links(a, b) for a, b in pairs)
    inside = {d for d, _ in members}
    every = [(a, b) for a in sets for b in inside if a != b and links(a, b)]

    def components(edges):
        root = {d: d for d in sets}
        for _ in sets:
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert components(pairs) == components(every)


def test_empty_table(spark):
    assert join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
