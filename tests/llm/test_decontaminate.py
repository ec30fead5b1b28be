"""Benchmark decontamination against a plain search of every window."""

import hashlib
import re

from tidewatch.llm import decontaminate as module
from tidewatch.llm.decontaminate import decontaminate, decontaminated
from tidewatch.llm.fm_index import FmIndex

import numpy as np
import pyarrow as pa

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = []
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        windows += [(str(item), tuple(w[i : i + n])) for i in range(len(w) - n + 1 if w else 0)]
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found.add(item)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return sorted(out, key=str)


ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"),
    (2, "short item"), (3, None), (4, "... !!"), (10, "a a a a a a a a a a a"), (11, "one two three four five six seven eight nine ten"),
    (12, "Éa öß"), (13, "x"),
]
DOCS = [
    (1, "zero ONE two, three four five six seven eight nine ten eleven twelve thirteen one two"),
    (2, "short. item short item item"), (3, None), (4, ""), (5, "a " * 40), (6, "Éa öß éa öß"), (7, "nothing at all"),
    (7, "nothing at all"), (None, "x y x"), (8, "ten eleven one two three four five six seven eight nine ten " * 300),
    (9, "one two three four five six seven eight nine"), (10, "short"), (11, "item"),
]


def result(frame):
    picked = frame.select("doc_id", "__n_words", "__n_hit", "__n_items", "__items_sha256").collect()
    return sorted((tuple(r) for r in picked), key=str)


def test_windows_as_brute_force_in_one_block_and_in_many(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert result(decontaminate(docs, items)) == brute(DOCS, ITEMS)
    assert result(decontaminate(docs, items, block_bytes=120)) == brute(DOCS, ITEMS)


def test_removal_keeps_rows_columns_and_the_rest_of_the_text(spark):
    docs = spark.createDataFrame(
        [(1, "keep Short  ITEM, é x?", 20, "a", 1), (2, None, None, "b", 2), (3, "clean", 99, None, 3)],
        "doc_id long, text string, n_chars long, items string, item_id int",
    )
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = {r.doc_id: r for r in decontaminated(docs, items).collect()}
    assert out[1].text == "keep , é ?" and out[1].n_chars == 10 and out[1].items == "a"
    assert out[2].text is None and out[2].n_chars is None
    assert out[3].text == "clean" and out[3].n_chars == 99
    assert decontaminated(docs, items).columns == docs.columns


def test_a_task_holds_one_worker_and_one_bounded_shard(spark, monkeypatch):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = decontaminate(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    shards, search = [], module.search_shard
    monkeypatch.setattr(module, "search_shard", lambda offsets, data, phrases: shards.append(len(data)) or search(offsets, data, phrases))
    shared = type("Shared", (), {"value": module.Phrases(ITEMS, 10)})
    texts = ["filler " * 20_000 + DOCS[0][1]] * 30
    run = module._searched_and_merged(module._search(shared, "text", False), "text")
    out = pa.Table.from_batches(run([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]))
    assert out.num_rows == 30 and set(out["__n_hit"].to_pylist()) == {12} and sum(shards) == sum(map(len, texts)) and max(shards) <= 1 << 20


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0
    full = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert result(decontaminate(full, items)) == brute(DOCS, [])


def test_index_counts_every_occurrence():
    rng = np.random.default_rng(5)
    text = rng.integers(0, 4, 3000)
    text[-1] = 0
    index = FmIndex(text, 4)
    rows = rng.integers(1, 4, (30, 3))
    which, place = index.hits(rows)
    expected = {(p, i) for p in range(30) for i in range(len(text) - 2) if (text[i : i + 3] == rows[p]).all()}
    assert set(zip(which.tolist(), place.tolist())) == expected and len(which) == len(expected)
