"""Exact Jaccard join of word shingles by T-occurrence search (DivideSkip) in index blocks.

Texts become sets of 64-bit shingle hashes. Equal sets are one class and meet by digest alone. For the rest, every set is sorted
by a global order of shingles: by hash, but shingles of many texts last, as told by a table of fixed size over all texts. A set
needs at least T = ceil(0.85 * size) common shingles with a partner, so two linked sets share one of their first size - T + 1. Sets that
share none of these with any other are done. The others are laid out by the first they share, which brings likely partners together,
and cut into blocks of bounded size; a block is an inverted index over whole sets, and a set visits its own block and each other one that
holds a set, smaller and not too small, with which it shares such a shingle.

In a block the set's inverted lists are divided: the shortest ones, all but T - 1, are merged and name the ids that can be partners at
all. These are looked up in the long lists, by binary search or, while they are many, by counting whole lists; an id is skipped as soon as
the lists left cannot bring it to the overlap that sets of these two sizes need. The count is the exact overlap. Only links between
sets that are not yet connected within the block matter, so ids of the set's own component are skipped first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.running import running_totals
from tidewatch.llm.common import chunks, stored, utf8
from tidewatch.llm.components import connected
from tidewatch.session import sized

SHINGLE_WORDS, PERCENT, SEED = 4, 85, 42
# Shingles of an index block; counted shingles that one task sorts; entries of the table of common shingles.
BLOCK_SHINGLES, COUNT_SHINGLES, CELL_BITS = 1 << 19, 1 << 21, 24
# Texts from which on a shingle may count as common, as a power of two.
COMMON_LEVEL = 1
# Shingles that a task holds before it hands them on.
HELD = 1 << 20
# A set counts as so many shingles at least, which bounds the sets of a block.
LEAST_WEIGHT = 64
# Long lists that are searched between two cuts of the ids left; entries of a list that are counted in the time of one binary search.
LIST_RUN, PROBE_COST = 8, 16
# Bytes of text whose words are hashed together.
TEXT_BYTES = 1 << 19
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Shingler:
    """Hashes words of many texts at once: differences of running sums of coded bytes times powers of a number, modulo 2 ** 64.

    Long words, for which such sums would be weak, are hashed one by one.
    """

    LONG = 48

    def __init__(self):
        codes = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        upper = np.arange(65, 91)
        codes[upper] = codes[upper + 32]
        self.codes = codes
        self.blank = np.zeros(256, bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True
        self.base = 0xD1342543DE82EF95 | 3
        self.powers = _powers(self.base, 1 << 16)
        self.inverse = _powers(pow(self.base, -1, 2**64), 1 << 16)

    def _grow(self, size: int) -> None:
        if size >= len(self.powers):
            self.powers = _powers(self.base, size)
            self.inverse = _powers(pow(self.base, -1, 2**64), size)

    def sets(self, texts: pa.Array) -> list[np.ndarray]:
        """The distinct shingles of each text, as sorted hashes; a text of fewer words has all of them as its one shingle."""
        offsets, data = utf8(texts)
        count = len(offsets) - 1
        # A blank in front and one behind every text keep words apart.
        place = np.arange(len(data)) + np.repeat(np.arange(1, count + 1), np.diff(offsets))
        spaced = np.full(len(data) + count + 1, 32, np.uint8)
        spaced[place] = data
        self._grow(len(spaced))
        inside = ~self.blank[spaced]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(spaced) + 1, np.uint64)
        np.cumsum(self.codes[spaced] * self.powers[: len(spaced)], dtype=np.uint64, out=sums[1:])
        words = _mixed((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        for i in np.flatnonzero(ends - starts > self.LONG):
            words[i] = xxhash.xxh64_intdigest(spaced[starts[i] : ends[i]].tobytes().translate(_LOWER), SEED)
        bounds = np.searchsorted(starts, offsets + np.arange(count + 1))
        total = np.full(max(len(words) - SHINGLE_WORDS + 1, 0), SHINGLE_WORDS, np.uint64)
        for i in range(SHINGLE_WORDS):
            total = total + words[i : i + len(total)] * _ODD[i]
        total = _mixed(total)
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= SHINGLE_WORDS:
                found = np.sort(total[a : b - SHINGLE_WORDS + 1])
                new = np.concatenate([[True], found[1:] != found[:-1]])
                out.append(found if new.all() else found[new])
            elif b > a:
                out.append(_mixed(np.array([b - a], np.uint64) + np.sum(words[a:b] * _ODD[: b - a], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def least_overlap(size: int) -> int:
    """The smallest overlap with any set that a set of this size can be linked at."""
    return -(-PERCENT * size // 100)


def _digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _count_shingles(text: str, bits: int):
    """Per gathered run of texts: shingles of the lower half of the hash space with their counts, in packets by leading bits."""

    def packets(found: list[np.ndarray]) -> pa.RecordBatch:
        shingles, counts = np.unique(np.concatenate(found), return_counts=True)
        packet = (shingles >> np.uint64(63 - bits)).astype(np.int64)
        edges = np.flatnonzero(np.diff(packet, prepend=-1))
        low = ((shingles << np.uint64(1 + bits)) >> np.uint64(32)).astype(np.uint32)
        parts = list(zip(edges, [*edges[1:], len(packet)]))
        arrays = [
            pa.array(packet[edges], pa.int64()), pa.array([low[a:b].tobytes() for a, b in parts], pa.binary()),
            pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in parts], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["packet", "shingles", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, size = Shingler(), [], 0
        for part in (p for batch in batches for p in chunks(batch, text, TEXT_BYTES)):
            for found in shingler.sets(part.column(part.schema.get_field_index(text))):
                found = found[: np.searchsorted(found, np.uint64(1 << 63))]
                if len(found):
                    held.append(found)
                    size += len(found)
                if size >= HELD:
                    yield packets(held)
                    held, size = [], 0
        if held:
            yield packets(held)

    return run


def _common(bits: int):
    """(level, n, cells) of a packet's shingles that at least 2 ** COMMON_LEVEL texts have."""

    def run(table: pa.Table) -> pa.Table:
        packet = table["packet"][0].as_py()
        shingles = np.concatenate([np.frombuffer(b, np.uint32) for b in table["shingles"].to_pylist()])
        counts = np.concatenate([np.frombuffer(b, np.uint32) for b in table["counts"].to_pylist()])
        order = np.argsort(shingles, kind="stable")
        shingles, counts = shingles[order], counts[order].astype(np.int64)
        edges = np.flatnonzero(np.diff(shingles.astype(np.int64), prepend=-1))
        texts = np.add.reduceat(counts, edges)
        level = np.floor(np.log2(texts)).astype(int)
        # The cell of a shingle is given by its leading bits: the first is 0, then the packet's, then those kept.
        cells = ((packet << (CELL_BITS - bits)) | (shingles[edges].astype(np.int64) >> (32 - CELL_BITS + bits))).astype(np.uint32)
        out = [(k, int((level == k).sum()), cells[level == k].tobytes()) for k in np.unique(level) if k >= COMMON_LEVEL]
        kinds = [pa.int32(), pa.int64(), pa.binary()]
        return pa.table({n: pa.array([row[i] for row in out], kinds[i]) for i, n in enumerate(("level", "n", "cells"))})

    return run


def common_levels(docs: DataFrame, text: str = "text") -> np.ndarray:
    """A table of ``2 ** CELL_BITS`` bytes: about how many texts have a shingle whose hash falls there, as a power of two.

    Counts cover the lower half of all hashes in all texts. Only the most common shingles, as many as half its cells, are
    entered, so its size and what the driver gets are bounded; any table gives a valid order.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = min(max(int(size // (12 * COUNT_SHINGLES)).bit_length(), 0), CELL_BITS)
    counted = docs.select(text).mapInArrow(_count_shingles(text, bits), "packet long, shingles binary, counts binary")
    found = stored(counted.groupBy("packet").applyInArrow(_common(bits), "level int, n long, cells binary"))
    levels, room, least = found.groupBy("level").agg(F.sum("n").alias("n")).orderBy(F.desc("level")).collect(), (1 << CELL_BITS) // 2, 99
    for row in levels:
        if row.n > room:
            break
        room, least = room - row.n, row.level
    table = np.zeros(1 << CELL_BITS, np.uint8)
    for row in found.filter(F.col("level") >= least).select("level", "cells").orderBy("level").collect():
        table[np.frombuffer(row.cells, np.uint32)] = row.level
    return table


def _first_shingles(text: str, doc_id: str, levels):
    """(doc_id, size, set_id, first): the shingles of the global order of which linked sets share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, table = Shingler(), levels.value
        for batch in (p for whole in batches for p in chunks(whole, text, TEXT_BYTES)):
            sizes, ids, firsts = [], [], []
            for found in shingler.sets(batch.column(batch.schema.get_field_index(text))):
                sizes.append(len(found))
                ids.append(_digest(found))
                rank = np.where(found < np.uint64(1 << 63), table[(found >> np.uint64(63 - CELL_BITS)).astype(np.int64) & ((1 << CELL_BITS) - 1)], 0)
                firsts.append(found[np.argsort(rank, kind="stable")][: len(found) - least_overlap(len(found)) + 1].tobytes() if len(found) else b"")
            kept = batch.column(batch.schema.get_field_index(doc_id))
            yield pa.RecordBatch.from_arrays([kept, pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(firsts, pa.binary())], ["doc_id", "size", "set_id", "first"])

    return run


_POSTING = "shingle long, number long, size int, place int"


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            lists = [np.frombuffer(b, np.int64) for b in part.column(2).to_pylist()]
            counts = [len(x) for x in lists]
            numbers, sizes = (np.repeat(part.column(i).to_numpy(zero_copy_only=False), counts) for i in (0, 1))
            places = np.concatenate([np.arange(n) for n in counts])
            arrays = [pa.array(np.concatenate(lists)), pa.array(numbers), pa.array(sizes.astype(np.int32)), pa.array(places.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["shingle", "number", "size", "place"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings, sorted by shingle and size, that some partner may meet: ``as_smaller`` or ``as_larger`` of a pair.

    The smaller set of a linked pair of sizes x <= y has the first common shingle among its first x - ceil(2 * 85 * x / 185) + 1.
    A row's nearest possible partners are the last such posting before it and the row after it. One row is held back.
    """
    held, last = None, (None, 0)
    names = ["shingle", "number", "size", "as_smaller", "as_larger"]

    def judge(rows: pa.RecordBatch, whole: bool):
        nonlocal last
        shingles, sizes, places = (rows.column(i).to_numpy().astype(np.int64) for i in (0, 2, 3))
        early = places <= sizes + -2 * PERCENT * sizes // (100 + PERCENT)
        n = len(shingles)
        before = np.concatenate([[-1], np.maximum.accumulate(np.where(early, np.arange(n), -1))[:-1]])
        smaller = np.where(before >= 0, sizes[before], last[1])
        same = np.where(before >= 0, shingles[before] == shingles, np.array([last[0] == s for s in shingles.tolist()]) if (before < 0).any() else False)
        larger = same & (100 * smaller >= PERCENT * sizes)
        follows = np.concatenate([shingles[1:] == shingles[:-1], [False]])
        following = np.concatenate([sizes[1:], [0]])
        less = early & follows & (100 * sizes >= PERCENT * following)
        decided = n if whole else n - 1
        keep = pa.array((larger | less)[:decided])
        if decided:
            at = int(np.where(early[:decided], np.arange(decided), -1).max())
            if at >= 0:
                last = (int(shingles[at]), int(sizes[at]))
        columns = [rows.column(0), rows.column(1), rows.column(2), pa.array(less), pa.array(larger)]
        return pa.RecordBatch.from_arrays([c.slice(0, decided).filter(keep) for c in columns], names)

    for batch in batches:
        if batch.num_rows:
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            yield judge(rows, whole=False)
            held = rows.slice(rows.num_rows - 1)
    if held is not None:
        yield judge(held, whole=True)


class Block:
    """An inverted index over sets, sorted by size, and the components found among them and their visitors."""

    def __init__(self, numbers: list[int], sets: list[np.ndarray], components: list[int] | None = None):
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), numbers[i]))
        self.numbers, self.sets = [numbers[i] for i in order], [sets[i] for i in order]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        shingles = np.concatenate(self.sets)
        ids = np.repeat(np.arange(len(order)), self.sizes)
        by = np.lexsort((ids, shingles))
        shingles, self.ids = shingles[by], ids[by]
        starts = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
        self.shingles = shingles[starts]
        # List and id as one sorted number, so that all lists are cut to a range of ids at once.
        self.keys = np.repeat(np.arange(len(starts)), np.diff([*starts, len(shingles)])) * len(order) + self.ids
        # The smallest id of each component; a visitor may belong to one as well.
        self.roots, self.known = np.arange(len(order)), {}
        for n, i in enumerate(order if components is not None else ()):
            self.roots[n] = self.known.setdefault(components[i], n)

    def _merge(self, a: int, b: int) -> None:
        low, high = sorted((self.roots[a], self.roots[b]))
        self.roots[self.roots == high] = low

    def partners(self, found: np.ndarray, upto: int, own: int | None = None) -> Iterator[int]:
        """Ids below ``upto`` linked to a set, at least one for each component that has any; ``own`` is a member of its component."""
        size = len(found)
        low = int(np.searchsorted(self.sizes, least_overlap(size)))
        high = min(upto, int(np.searchsorted(self.sizes, 100 * size // PERCENT, "right")))
        if low >= high or not len(self.shingles):
            return
        least = np.zeros(high, np.int64)
        least[low:] = -(-PERCENT * (size + self.sizes[low:high]) // (100 + PERCENT))
        need = int(least[low])
        at = np.minimum(np.searchsorted(self.shingles, found), len(self.shingles) - 1)
        lists = at[self.shingles[at] == found]
        if len(lists) < need:
            return
        starts = np.searchsorted(self.keys, lists * len(self.sizes) + low)
        ends = np.searchsorted(self.keys, lists * len(self.sizes) + high)
        lists = sorted((self.ids[a:b] for a, b in zip(starts.tolist(), ends.tolist()) if a < b), key=len)
        if len(lists) < need:
            return
        linked: set[int] = set() if own is None else {int(self.roots[own])}
        # The shortest lists name likely partners; once one is linked, its whole component is left out.
        for number in {int(x[end]) for x in lists[:3] for end in (0, -1)}:
            if int(self.roots[number]) not in linked and self._linked(size, number, _overlap(found, self.sets[number])):
                linked.add(int(self.roots[number]))
                yield number
        for root in linked:
            least[self.roots[:high] == root] = size + 1
        for number, _ in divide_skip(lists, need, least):
            if int(self.roots[number]) not in linked:
                linked.add(int(self.roots[number]))
                yield number

    def _linked(self, size: int, number: int, overlap: int) -> bool:
        return 100 * overlap >= PERCENT * (size + int(self.sizes[number]) - overlap)

    def links(self) -> Iterator[tuple[int, int]]:
        """Pairs of numbers that connect linked members."""
        for i, found in enumerate(self.sets):
            for j in self.partners(found, i, own=i):
                yield self.numbers[i], self.numbers[j]
                self._merge(i, j)

    def visit(self, number: int, found: np.ndarray, component: int | None = None) -> Iterator[tuple[int, int]]:
        """Pairs that connect a visitor to other components than its own; they are one with it from then on."""
        own = self.known.get(component)
        for j in self.partners(found, len(self.sets), own):
            yield number, self.numbers[j]
            if own is None:
                own = j
                if component is not None:
                    self.known[component] = j
            else:
                self._merge(own, j)


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """The number of common elements of two sorted sets."""
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def divide_skip(lists: list[np.ndarray], need: int, least: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """(id, number of lists) for ids on at least ``need`` of the sorted lists, and on ``least[id]`` where that is more.

    An id that is on none of the shortest lists, all but ``need - 1``, is skipped. The others are looked up in the long lists, by
    binary search or, while they are many, by counting whole lists, and are given up as soon as the lists left cannot make up the rest.
    """
    lists = sorted(lists, key=len)
    left = need - 1
    counts = np.bincount(np.concatenate(lists[: len(lists) - left]))
    ids = np.flatnonzero(counts)
    counts = counts[ids]
    wanted = np.full(len(ids), need) if least is None else np.maximum(least[ids], need)
    while True:
        alive = counts + left >= wanted
        if not alive.all():
            ids, counts, wanted = ids[alive], counts[alive], wanted[alive]
        if not left or not len(ids):
            break
        run = lists[len(lists) - left : len(lists) - left + LIST_RUN]
        if len(ids) * PROBE_COST * len(run) < sum(map(len, run)):
            for probed in run:
                counts = counts + (probed[np.minimum(np.searchsorted(probed, ids), len(probed) - 1)] == ids)
        else:
            counts = counts + np.bincount(np.concatenate(run), minlength=ids[-1] + 1)[ids]
        left -= len(run)
    yield from zip(ids.tolist(), counts.tolist())


def _stars(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Pairs that connect the same numbers, each with the smallest of its component."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    return [(x, top(x)) for x in list(root) if top(x) != x]


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links found in rows sorted by block, share and kind, as a star for each component: a block's members come before its visitors.

    Members that are alone in their components so far are searched among themselves as well.
    """
    key, members, block = None, {}, None
    pairs: list[tuple[int, int]] = []
    out: list[tuple[int, int]] = []

    def rows():
        done = pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], ["a", "b"])
        out.clear()
        return done

    def close_members():
        nonlocal block
        if members and block is None:
            numbers = list(members)
            alone = all(root == n for n, (root, _) in members.items())
            block = Block(numbers, [members[n][1] for n in numbers], [members[n][0] for n in numbers])
            if key[1] == 0 and alone:
                pairs.extend(block.links())

    def close_block():
        close_members()
        out.extend(_stars(pairs))
        pairs.clear()

    for batch in batches:
        for row in batch.to_pylist():
            if (row["block"], row["share"]) != key:
                close_block()
                key, members, block = (row["block"], row["share"]), {}, None
            found = np.frombuffer(row["shingles"], np.uint64)
            if row["visitor"]:
                close_members()
                if block is not None:
                    pairs.extend(block.visit(row["number"], found, row["root"]))
            else:
                members[row["number"]] = (row["root"], found)
        if out:
            yield rows()
    close_block()
    if out:
        yield rows()


def _whole_sets(text: str, doc_id: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for part in (p for batch in batches for p in chunks(batch, text, TEXT_BYTES)):
            found = shingler.sets(part.column(part.schema.get_field_index(text)))
            kept = part.column(part.schema.get_field_index(doc_id))
            arrays = [kept, pa.array([_digest(f) for f in found], pa.binary()), pa.array([f.tobytes() for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "set_id", "shingles"])

    return run


def _band(size: Column) -> Column:
    """Sizes of linked sets are in the same band or in neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(100.001 / PERCENT))).cast("int")


def _search(docs: DataFrame, sets: DataFrame, visits: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Links (a, b) found by rows (number, size, block, visitor, root) of sets that make up a block's index or visit it."""
    # Visitors of a much visited block are shared out; each share gets the block's members.
    weight = F.sum(F.when(F.col("visitor"), F.greatest("size", F.lit(LEAST_WEIGHT))).otherwise(0))
    shares = visits.groupBy("block").agg((F.floor(weight / (8 * BLOCK_SHINGLES)) + 1).alias("shares"))
    all_shares = F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)
    one = F.array(F.pmod(F.xxhash64("number"), F.col("shares")))
    dealt = visits.join(shares, "block").withColumn("share", F.explode(F.when(F.col("visitor"), one).otherwise(all_shares)))
    named = sets.select("number", F.col("set_id").alias("wanted_id"), F.col("doc_id").alias("of"))
    wanted = stored(dealt.join(named, "number").select("number", "wanted_id", "of", "block", "share", "visitor", "root"))
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("set_id", T.BinaryType()), T.StructField("shingles", T.BinaryType())])
    # Copies of a set have its id as well; only the document that stands for it goes on.
    whole = docs.select(doc_id, text).mapInArrow(_whole_sets(text, doc_id), schema)
    met = whole.join(sized(wanted), (F.col("set_id") == F.col("wanted_id")) & F.col("doc_id").eqNullSafe(F.col("of")))
    placed = met.select("block", "share", "visitor", "number", "root", "shingles").repartition("block", "share")
    return stored(placed.sortWithinPartitions("block", "share", "visitor", "number").mapInArrow(_searched, "a long, b long"))


def join_sets(docs: DataFrame, sets: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Edges (a, b) between ``number``s that connect the distinct sets (number, set_id, doc_id, size, first) as all links would.

    First every block is searched by its own sets and by the first of the next block, which connects most groups, wherever they lie.
    Then a set visits other blocks, but only for partners of other components than its own, and only these are indexed.
    """
    postings = sets.select("number", "size", "first").mapInArrow(_postings, _POSTING)
    postings = postings.repartition("shingle").sortWithinPartitions("shingle", "size", "number")
    met = stored(postings.mapInArrow(_met, "shingle long, number long, size int, as_smaller boolean, as_larger boolean"))
    # A set's home is the shingle that most others share with it.
    common = met.groupBy("shingle").agg(F.count(F.lit(1)).alias("others"))
    homes = met.join(common, "shingle").groupBy("number").agg(F.max(F.struct("others", "shingle")).alias("home"), F.min("size").cast("bigint").alias("size"))
    homes = homes.select("number", "size", F.greatest("size", F.lit(LEAST_WEIGHT)).alias("weight"), F.col("home.shingle").alias("home"))
    homes = running_totals(homes, ["home", "size", "number"], {"before": "weight"})
    homes = stored(homes.select("number", "size", F.floor(F.col("before") / BLOCK_SHINGLES).alias("block"), (F.col("before") % BLOCK_SHINGLES).alias("depth")))
    early = homes.filter((F.col("block") > 0) & (F.col("depth") < BLOCK_SHINGLES // 16))
    own = homes.select("number", "size", "block", F.lit(False).alias("visitor"), F.col("number").alias("root"))
    first = own.union(early.select("number", "size", F.col("block") - 1, F.lit(True), "number"))
    inside = _search(docs, sets, first, doc_id, text)
    stars = connected(inside).toDF("a", "b")
    linked = stars.toDF("number", "linked")
    homes = homes.join(linked, "number", "left").select("number", "block", F.coalesce("linked", "number").alias("root"))

    at = stored(met.join(homes, "number").withColumn("band", _band(F.col("size"))))
    held = at.filter("as_smaller").groupBy("shingle", "block", "band").agg(
        F.min("size").alias("least"), F.max("size").alias("most"), F.min("root").alias("first_root"), F.max("root").alias("last_root")
    )
    held = held.select("shingle", F.col("block").alias("other"), "least", "most", "first_root", "last_root", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    fits = (F.col("other") != F.col("block")) & (F.col("least") <= F.col("size")) & (100 * F.col("most") >= PERCENT * F.col("size"))
    foreign = (F.col("first_root") != F.col("root")) | (F.col("last_root") != F.col("root"))
    visits = at.filter("as_larger").join(held, ["shingle", "band"]).filter(fits & foreign)
    visits = stored(visits.select("shingle", "number", "size", "root", "other").distinct())
    asked = visits.select("shingle", F.col("other").alias("block")).distinct()
    members = at.filter("as_smaller").join(asked, ["shingle", "block"], "left_semi").select("number", "size", "block", F.lit(False).alias("visitor"), "root")
    second = members.distinct().union(visits.select("number", "size", "other", F.lit(True), "root").distinct())
    return stars.union(_search(docs, sets, stored(second), doc_id, text))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``, the smallest id reachable by links, its own included.

    Null and empty texts and texts without words have no shingles and are linked with nothing; their component is their own id. Rows
    with a null id belong to components too, and a component of null ids only has a null ``component_id``. Repeated rows come out
    repeated. An empty table gives an empty one. Only the two named columns are read. Sets are told apart by 128 bits and shingles by 64.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    levels = spark.sparkContext.broadcast(common_levels(named))
    kind = T.StructType([named.schema["doc_id"], T.StructField("size", T.LongType()), T.StructField("set_id", T.BinaryType()), T.StructField("first", T.BinaryType())])
    rows = stored(named.mapInArrow(_first_shingles("text", "doc_id", levels), kind))
    filled = rows.filter("size > 0")
    sets = filled.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.min("size").alias("size"), F.max("first").alias("first"))
    sets = stored(sets.withColumn("number", F.monotonically_increasing_id()))
    found = connected(join_sets(named, sets, "doc_id", "text")).toDF("number", "linked")
    classes = sets.select("set_id", "doc_id", "number").join(found, "number", "left").select("set_id", "doc_id", F.coalesce("linked", "number").alias("root"))
    classes = stored(classes)
    least = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    placed = classes.join(least, "root").select("set_id", "component_id")
    out = rows.select("doc_id", "size", "set_id").join(placed, "set_id", "left")
    own = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("size").alias("n_shingles"), own.alias("component_id"))
