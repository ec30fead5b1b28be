"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidewatch.llm import spelling
from tidewatch.llm.queries import op11_spelling, worn_words
from tidewatch.llm.spelling import near_words, variants


def worn(doc, text):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{doc}:{run}".encode())
        yield run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def neighbours(words):
    """All pairs, met by what is left after deleting one letter."""
    left = {}
    for w in words:
        for part in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            left.setdefault(part, set()).add(w)
    near = {w: set() for w in words}
    for group in left.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    return near


def plain(tokens):
    n = {w: k for w, k in Counter(tokens).items() if len(w) >= 5 and k >= 3}
    near = neighbours(list(n))
    form = {}
    for w in n:
        best = min(near[w], key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return out


@pytest.mark.parametrize("tile", [2, 5, 256])
def test_near_words_as_all_pairs_in_whole_and_split_keys(spark, monkeypatch, tile):
    rng = random.Random(tile)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(400)}
    words |= {"x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1500, "😀bcde", "😀bcd", "y😀bcde"}
    words |= {chr(0x4E00 + i) + "same" for i in range(30)}
    n = {w: rng.randint(1, 5) for w in words}
    monkeypatch.setattr(spelling, "TILE_WORDS", tile)
    got = {r.word: (r.near, r.best, r.other) for r in near_words(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    first = {w: min(o, key=lambda b: (-n[b], b)) for w, o in neighbours(list(words)).items() if o}
    want = {w: (len(o), n[first[w]], first[w]) for w, o in neighbours(list(words)).items() if o}
    assert got == want


def test_forms_and_roots_as_all_pairs(spark):
    counts = {"house": 40, "hous": 9, "houses": 19, "housse": 8, "hose": 90, "mouse": 20, "houßes": 3, "hoouse": 2, "aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24}
    tokens = [w for w, k in counts.items() for _ in range(k)] + [None, None, None]
    frame = spark.createDataFrame([(t, "x") for t in tokens], "word string, form string").repartition(3)
    got = {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in variants(frame).collect()}
    assert got == plain([t for t in tokens if t])
    assert ("aaaaa", 3, 1, "aaaaaa", 6, "aaaaaaaa") in got
    assert variants(frame.limit(0)).count() == 0


def test_words_of_texts(spark):
    rows = [(1, "Élan naïve×÷x don't ÀÉ-É 12ab"), (2, None), (3, ""), (3, "one"), (None, "one two"), (4, " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)))]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")
    assert Counter(r.word for r in worn_words(frame).collect()) == Counter(w for d, t in rows for w in worn("" if d is None else d, t))


def test_query_on_the_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = op11_spelling(spark, folder).collect()
    got = {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(rows) == len(got) and got == plain([w for d, t in docs for w in worn(d, t)])
    assert any(r[3] for r in got)
