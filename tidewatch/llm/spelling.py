"""Spelling variants: words one edit apart, compared in dense tiles of padded code points.

Two words are one insert, delete or replacement apart exactly if their common prefix and common suffix together reach the longer
length less one. With M the longer length and a the common prefix, a < M, the words agree before a and in the last M - 1 - a
places. So for any window [low, high) that holds a, they share the first ``low`` and the last ``M - high`` code points. Words meet
by that key, first with two windows for each M; a key of more than ``TILE_WORDS`` words is split by halving its window until it is small
or one place wide, where only the alphabet bounds it. A pair belongs to one window only, as the exact a decides. Inside a key, words
are rows of matrices padded to M, and blocks of rows are compared with blocks of rows column by column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

LEAST_CHARS, LEAST_COUNT, RATIO = 5, 3, 2
# Words of a block, and compared pairs that a task holds at a time.
TILE_WORDS, TILE_PAIRS = 256, 1 << 21


def _windows(words: DataFrame, bounds: list[tuple[Column, Column]]) -> DataFrame:
    """One row per word and window: (key, size, low, high, word, n)."""
    made = words.withColumn("w", F.explode(F.array(*(F.struct(a.cast("int").alias("low"), b.cast("int").alias("high")) for a, b in bounds))))
    made = made.select("word", "n", "size", "w.low", "w.high")
    shared = [F.substr("word", F.lit(1), F.col("low")), F.right("word", F.col("size") - F.col("high"))]
    return made.select(F.xxhash64("size", "low", "high", *shared).alias("key"), "size", "low", "high", "word", "n")


def _padded(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points with padding behind, with padding before, and lengths."""
    sizes = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    at = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = np.repeat(np.arange(len(words)), sizes)
    behind, before = np.zeros((len(words), width), np.uint32), np.zeros((len(words), width), np.uint32)
    behind[row, at] = points
    before[row, at + np.repeat(width - sizes, sizes)] = points
    return behind, before, sizes


def _common(a: np.ndarray, b: np.ndarray, columns: Iterator[int]) -> np.ndarray:
    """How many leading ``columns`` each row of a block (groups, rows, width) shares with each row of the other."""
    alive = np.ones((a.shape[0], a.shape[1], b.shape[1]), bool)
    total = np.zeros(alive.shape, np.int32)
    for c in columns:
        alive &= a[:, :, None, c] == b[:, None, :, c]
        if not alive.any():
            break
        total += alive
    return total


def _tile(a: tuple, b: tuple, width: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which rows of blocks ``a`` are one edit from which rows of blocks ``b``; both are (behind, before, sizes, used) by group."""
    prefix = _common(a[0], b[0], range(width))
    suffix = _common(a[1], b[1], range(width - 1, -1, -1))
    near = (prefix + suffix >= width - 1) & (prefix >= low[:, None, None]) & (prefix < high[:, None, None])
    near &= np.maximum(a[2][:, :, None], b[2][:, None, :]) == width
    return near & a[3][:, :, None] & b[3][:, None, :]


def _compare(groups: list[dict]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, largest n, smallest word of that n) for groups of one width, block pair by block pair."""
    width = groups[0]["size"]
    longest = max(len(g["words"]) for g in groups)
    block = min(TILE_WORDS, longest)
    blocks = -(-longest // block)
    rows, shape = block * blocks, (len(groups), block * blocks)
    behind, before = np.zeros((*shape, width), np.uint32), np.zeros((*shape, width), np.uint32)
    sizes, used, counts = np.zeros(shape, np.int64), np.zeros(shape, bool), np.zeros(shape, np.int64)
    for g, group in enumerate(groups):
        k = len(group["words"])
        behind[g, :k], before[g, :k], sizes[g, :k] = _padded(group["words"], width)
        used[g, :k], counts[g, :k] = True, group["n"]
    low, high = (np.array([g[k] for g in groups]) for k in ("low", "high"))

    def part(i: int) -> tuple:
        at = slice(i * block, (i + 1) * block)
        return behind[:, at], before[:, at], sizes[:, at], used[:, at]

    total, best, where = np.zeros(shape, np.int64), np.full(shape, -1), np.zeros(shape, np.int64)

    def note(i: int, j: int, near: np.ndarray):
        """Words are sorted and later blocks come later, so the first largest count is that of the smallest word."""
        at, offset = slice(i * block, (i + 1) * block), j * block
        seen = np.where(near, counts[:, None, offset : offset + block], -1)
        first = seen.argmax(axis=2)
        top = np.take_along_axis(seen, first[..., None], 2)[..., 0]
        total[:, at] += near.sum(axis=2)
        better = (top > best[:, at]) | ((top == best[:, at]) & (first + offset < where[:, at]))
        where[:, at] = np.where(better, first + offset, where[:, at])
        best[:, at] = np.maximum(best[:, at], top)

    for i in range(blocks):
        for j in range(i, blocks):
            near = _tile(part(i), part(j), width, low, high)
            if i == j:
                near &= ~np.eye(block, dtype=bool)
            note(i, j, near)
            if i != j:
                note(j, i, near.transpose(0, 2, 1))
    for g, r in zip(*np.nonzero(total)):
        words = groups[g]["words"]
        yield words[r], int(total[g, r]), int(best[g, r]), words[where[g, r]]


_FOUND = "word string, near long, best long, other string"


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of words in rows sorted by key and word."""
    held: dict[tuple[int, int], list[dict]] = {}
    pairs: dict[tuple[int, int], int] = {}
    group: dict = {"key": None, "words": []}

    def flush(kind):
        del pairs[kind]
        found = list(zip(*_compare(held.pop(kind))))
        if found:
            types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types)], ["word", "near", "best", "other"])

    def close():
        if len(group["words"]) < 2:
            return
        padded = 1 << (len(group["words"]) - 1).bit_length()
        kind = (group["size"], padded)
        held.setdefault(kind, []).append(dict(group))
        pairs[kind] = pairs.get(kind, 0) + min(padded, TILE_WORDS) ** 2 + padded * group["size"]
        if pairs[kind] >= TILE_PAIRS:
            yield from flush(kind)

    for batch in batches:
        for row in batch.to_pylist():
            kind = (row["key"], row["size"], row["low"], row["high"])
            if kind != group["key"]:
                yield from close()
                group = {"key": kind, "size": row["size"], "low": row["low"], "high": row["high"], "words": [], "n": []}
            group["words"].append(row["word"])
            group["n"].append(row["n"])
    yield from close()
    for kind in list(held):
        yield from flush(kind)


def near_words(words: DataFrame, tile_words: int | None = None) -> DataFrame:
    """(word, near, best, other) for words (word, n; distinct) with some word one edit away: how many, and the one of largest n.

    Ties go to the smallest word in code-point order. Each round of splitting is written, so that nothing is done again.
    """
    limit = tile_words or TILE_WORDS
    sized = words.select("word", "n", F.char_length("word").alias("size"))
    # A word may be the longer of a pair or shorter by one.
    sized = sized.select("word", "n", F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("size"))
    half = F.floor(F.col("size") / 2)
    cells = _windows(sized, [(F.lit(0), half), (half, F.col("size"))])
    tiles = None
    while True:
        cells = stored(cells)
        members = cells.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        met = cells.join(members, "key")
        crowded = (F.col("members") > limit) & (F.col("high") - F.col("low") > 1)
        few = met.filter(~crowded).drop("members")
        tiles = few if tiles is None else tiles.union(few)
        split = stored(met.filter(crowded).select("word", "n", "size", "low", "high"))
        if split.isEmpty():
            break
        middle = F.floor((F.col("low") + F.col("high")) / 2)
        cells = _windows(split.withColumnsRenamed({"low": "from", "high": "to"}).withColumn("middle", F.floor((F.col("from") + F.col("to")) / 2)), [
            (F.col("from"), F.col("middle")), (F.col("middle"), F.col("to")),
        ])
    found = tiles.repartition("key").sortWithinPartitions("key", "size", "low", "high", "word").mapInArrow(_tiles, _FOUND)
    least = F.min(F.struct((-F.col("best")).alias("less"), F.col("other").alias("other")))
    merged = found.groupBy("word").agg(F.sum("near").alias("near"), least.alias("first"))
    return merged.select("word", "near", (-F.col("first.less")).alias("best"), F.col("first.other").alias("other"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): every word's pointer is doubled until all point at words without a form."""
    pointers = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        following = pointers.select(F.col("word").alias("at"), F.col("root").alias("further"))
        joined = stored(pointers.join(following, F.col("root") == F.col("at"), "left").select("word", "root", "further"))
        pointers = joined.select("word", F.coalesce("further", "root").alias("root"))
        if joined.filter("further is not null").isEmpty():
            return pointers


def variants(tokens: DataFrame, word: str = "word", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every distinct token of enough code points that occurs often enough.

    ``tokens`` holds one row per occurrence; null tokens are left out. A word's form is its near word of largest n if that is at
    least twice the word's n. Counts at least double along forms, so the pointers end after few rounds. An empty table gives an
    empty one. Only the named column is read.
    """
    named = tokens.select(F.col(word).alias("word")).filter(F.char_length("word") >= least_chars)
    counted = stored(named.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count))
    near = counted.join(near_words(counted), "word", "left")
    risen = F.col("best") >= RATIO * F.col("n")
    near = stored(near.select(
        "word", "n", F.coalesce("near", F.lit(0)).cast("bigint").alias("n_near"), F.when(risen, F.col("other")).alias("form"), F.when(risen, F.col("best")).alias("form_n")
    ))
    last = roots(near.filter("form is not null").select("word", "form"))
    joined = near.join(last, "word", "left")
    return joined.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
