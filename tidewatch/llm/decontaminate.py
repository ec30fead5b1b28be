"""Benchmark decontamination by an FM-index per shard of training text.

A shard is a run of whole documents inside a task. Its words become symbols of the benchmark's vocabulary, runs
of such words are indexed, and all benchmark windows are searched backwards through wavelet-tree ranks. Hits
are located by sampled suffixes, checked word by word, and merged to removal spans. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import chunks, utf8
from tidewatch.llm.fm_index import FmIndex

WINDOW = 10
# Most bytes of benchmark text that are broadcast at once; a larger benchmark is searched in blocks.
BLOCK_BYTES = 32 * 1024 * 1024
# Bytes of text of a shard; the arrays of its words and index take some 40 times as much of a worker.
SHARD_BYTES = 1024 * 1024
# Odd multiplier of the rolling word hash (a fixed value; any odd one does).
MULTIPLIER = 0x9E3779B97F4A7C15

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LOWERED = np.frombuffer(_LOWER, np.uint8)
_IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in _LOWER])

_SPANS = "array<struct<word:bigint,length:bigint,start:bigint,end:bigint,items:array<string>>>"


def item_words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().translate(_LOWER))


def word_hash(word: bytes) -> int:
    value = 0
    for byte in reversed(word):
        value = (value * MULTIPLIER + byte + 1) % 2**64
    return value


class Phrases:
    """The distinct windows of a block of benchmark items, as symbols of their vocabulary."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.ids: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in item_words(text)]
            length = min(window, len(words))
            for at in range(len(words) - length + 1 if words else 0):
                windows.setdefault(tuple(words[at : at + length]), set()).add(str(item))
        self.words = [b"", *self.ids]
        self.groups = []
        for length in sorted({len(w) for w in windows}):
            rows = [w for w in windows if len(w) == length]
            self.groups.append((length, np.array(rows, np.int64).reshape(len(rows), length), [sorted(windows[w]) for w in rows]))
        self.shortest = min((g[0] for g in self.groups), default=0)
        hashes = np.array([word_hash(w) for w in self.words[1:]], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.codes = hashes[order], order + 1
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        likely = np.flatnonzero(self.seen[(hashes >> np.uint64(44)).astype(np.int64)])
        if len(likely):
            at = np.minimum(np.searchsorted(self.hashes, hashes[likely]), len(self.hashes) - 1)
            out[likely] = np.where(self.hashes[at] == hashes[likely], self.codes[at], 0)
        return out


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", MULTIPLIER), ("down", pow(MULTIPLIER, -1, 2**64))):
            factors = np.full(n, base, np.uint64)
            factors[:1] = 1
            _POWERS[name] = np.cumprod(factors)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def find_words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word, and none across two texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = _IS_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = offsets[:-1][offsets[:-1] < len(data)]
    first[bounds] = inside[bounds]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWERED[data].astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    return starts, stops, (total[stops] - total[starts]) * down[starts]


def search_shard(offsets: np.ndarray, data: np.ndarray, phrases: Phrases):
    """Per document of the shard: number of words and the hits (word, length, start byte, end byte, items)."""
    starts, stops, hashes = find_words(offsets, data)
    first_word = np.searchsorted(starts, offsets)
    n_words = np.diff(first_word)
    hits: list[list[tuple]] = [[] for _ in n_words]
    if not phrases.groups or not len(starts):
        return n_words, hits
    symbols = phrases.symbols(hashes)
    new_text = np.zeros(len(starts), bool)
    new_text[first_word[:-1][n_words > 0]] = True
    known = symbols > 0
    begins = known & (new_text | ~np.concatenate([[False], known[:-1]]))
    run = np.cumsum(begins)
    sizes = np.bincount(run[known], minlength=int(run[-1]) + 1)
    keep = np.flatnonzero(known & (sizes[run] >= phrases.shortest))
    if not len(keep):
        return n_words, hits
    opens = np.concatenate([[True], run[keep][1:] != run[keep][:-1]])
    place = np.arange(len(keep)) + np.cumsum(opens) - 1
    sequence = np.zeros(int(place[-1]) + 2, np.int64)
    origin = np.zeros(len(sequence), np.int64)
    sequence[place], origin[place] = symbols[keep], keep
    index = FmIndex(sequence, len(phrases.words))
    low = data.tobytes().translate(_LOWER)
    for length, rows, items in phrases.groups:
        which, found = index.hits(rows)
        words = origin[found]
        texts = np.searchsorted(first_word, words, "right") - 1
        for p, w, doc in zip(which.tolist(), words.tolist(), texts.tolist()):
            if all(low[starts[w + j] : stops[w + j]] == phrases.words[rows[p, j]] for j in range(length)):
                base = int(offsets[doc])
                hits[doc].append((w - int(first_word[doc]), length, int(starts[w]) - base, int(stops[w + length - 1]) - base, items[p]))
    return n_words, hits


_HIT_TYPE = pa.list_(
    pa.struct([("word", pa.int64()), ("length", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("items", pa.list_(pa.string()))])
)


def _search(phrases, text: str, earlier: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = phrases.value
        for batch in batches:
            for part in chunks(batch, text, SHARD_BYTES):
                offsets, data = utf8(part.column(part.schema.get_field_index(text)))
                n_words, hits = search_shard(offsets, data, block)
                columns, names = list(part.columns), list(part.schema.names)
                if earlier:
                    before = columns.pop().to_pylist()
                    hits = [[tuple(h.values()) for h in old] + new for old, new in zip(before, hits)]
                    columns.pop()
                    names = names[:-2]
                listed = pa.array([[dict(zip(("word", "length", "start", "end", "items"), h)) for h in doc] for doc in hits], _HIT_TYPE)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n_words, pa.int64()), listed], [*names, "__n_words", "__hits"])

    return run


def item_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def _merge(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            out = {"n_hit": [], "n_items": [], "items_sha256": [], "removed": [], "clean": []}
            for at, hits in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                items = sorted({i for h in hits for i in h["items"]})
                merged: list[list[int]] = []
                for h in sorted(hits, key=lambda h: h["word"]):
                    end = h["word"] + h["length"]
                    if merged and h["word"] <= merged[-1][1]:
                        if end > merged[-1][1]:
                            merged[-1][1], merged[-1][3] = end, h["end"]
                    else:
                        merged.append([h["word"], end, h["start"], h["end"]])
                out["n_hit"].append(sum(m[1] - m[0] for m in merged))
                out["n_items"].append(len(items))
                out["items_sha256"].append(item_digest(items))
                out["removed"].append([{"start": m[2], "end": m[3]} for m in merged])
                if merged:
                    raw, parts, last = texts[at].as_py().encode(), [], 0
                    for m in merged:
                        parts.append(raw[last : m[2]])
                        last = m[3]
                    out["clean"].append(b"".join([*parts, raw[last:]]).decode())
                else:
                    out["clean"].append(texts[at].as_py())
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string())
            arrays = [pa.array(v, kind) for v, kind in zip(out.values(), kinds)]
            kept = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], [*batch.schema.names[:-1], *(f"__{k}" for k in out)])

    return run


def _searched_and_merged(search, text: str):
    merge = _merge(text)
    return lambda batches: merge(search(batches))


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size, one block at a time on the driver."""
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = -(-total // block_bytes) if total else 0
    part = F.pmod(F.xxhash64("item", "text"), F.lit(max(count, 1)))
    for n in range(count):
        yield [tuple(r) for r in rows.filter(part == n).distinct().collect()]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All rows and columns of ``docs`` plus what benchmark windows were found in the text.

    Adds ``__n_words``, ``__n_hit``, ``__n_items``, ``__items_sha256``, ``__removed`` (merged byte spans of hit
    words) and ``__clean`` (the text without them). A null text has no words and stays null; a benchmark item that
    is null or has no word has no window; equal items count once per id. Repeated documents are judged one by one.
    An empty benchmark leaves every text as it is. Other columns are carried along, whatever their names, unless
    they start with two underscores.
    """
    context = docs.sparkSession.sparkContext
    added = T.StructType.fromDDL(f"__n_words bigint, __hits {_SPANS}").fields
    more = T.StructType.fromDDL(
        "__n_hit bigint, __n_items bigint, __items_sha256 string, __removed array<struct<start:bigint,end:bigint>>, __clean string"
    )
    merged = T.StructType([*docs.schema.fields, added[0], *more.fields])
    found, search = docs, None
    for block in _blocks(benchmark, item, item_text, block_bytes):
        if search is not None:
            found = found.mapInArrow(search, T.StructType([*docs.schema.fields, *added]))
        search = _search(context.broadcast(Phrases(block, window)), text, search is not None)
    search = search or _search(context.broadcast(Phrases([], window)), text, False)
    # The last search and the merge share a worker: two in a row would hold twice the memory for each task.
    return found.mapInArrow(_searched_and_merged(search, text), merged)


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents with benchmark passages cut out and ``n_chars``, if there, counted anew; no row is dropped."""
    changed = F.size("__removed") > 0
    out = decontaminate(docs, benchmark).withColumn("text", F.col("__clean"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
