"""SimHash near-duplicates, with candidates filtered by chains of segments around a ring.

Texts become 64-bit fingerprints inside tasks; from there on all is DataFrame work on distinct fingerprints.
With at most t differing bits and m = t + 2 segments, two segments agree at least, so fingerprints meet in
buckets keyed by two segments. A pair of a bucket survives only if some chain of consecutive segments keeps its
summed differences within l * t / m for each length l; then the full distance is counted. Buckets with more than
``small_bucket`` fingerprints are linked through shared centres (a fingerprint with one bit changed) instead
of pairs, which finds the same links in linear work.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import stored
from tidewatch.llm.components import connected
from tidewatch.session import sized

SHINGLE_WORDS, MAX_BITS, SEED = 3, 2, 42
SMALL_BUCKET = 32
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PIECE = 1 << 16


def shingle_hashes(text: str, words: int) -> list[int]:
    found = text.encode().translate(_LOWER).split()
    if not found:
        return []
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return [digest(b" ".join(found), SEED)]
    return [digest(b" ".join(s), SEED) for s in zip(*(found[i:] for i in range(words)))]


def _count(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per run of hashes (starting at ``bounds``), how often each of the 64 bits is set."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, bounds, axis=0, dtype=np.int64)


def fingerprint_all(texts: list[str | None], words: int) -> np.ndarray:
    counts = np.zeros((len(texts), 64), np.int64)
    sizes = np.zeros(len(texts), np.int64)
    pending: list[np.ndarray] = []
    rows: list[int] = []
    held = 0

    def flush():
        if rows:
            bounds = np.cumsum([0, *(len(p) for p in pending)])[:-1]
            np.add.at(counts, rows, _count(np.concatenate(pending), bounds))
            pending.clear()
            rows.clear()

    for row, text in enumerate(texts):
        if not text:
            continue
        hashes = np.array(shingle_hashes(text, words), np.uint64)
        sizes[row] = len(hashes)
        for at in range(0, len(hashes), _PIECE):
            pending.append(hashes[at : at + _PIECE])
            rows.append(row)
            held += len(pending[-1])
            if held >= _PIECE:
                flush()
                held = 0
    flush()
    packed = np.packbits(counts * 2 > sizes[:, None], axis=1, bitorder="little")
    return packed.reshape(-1).view(np.int64)


def _add_fingerprints(text: str, keep: list[str], words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                prints = fingerprint_all(part.column(part.schema.get_field_index(text)).to_pylist(), words)
                kept = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(prints, pa.int64())], [*keep, "__print"])

    return run


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """Columns ``keep`` of every row plus ``__print``, the fingerprint as a signed long (zero without words)."""
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("__print", T.LongType())])
    needed = docs.select(*dict.fromkeys([*keep, text]))
    return needed.mapInArrow(_add_fingerprints(text, keep, words), schema)


def _segments(count: int) -> list[int]:
    """Bit masks of ``count`` consecutive segments of a long, as signed values."""
    edges = [round(64 * i / count) for i in range(count + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [m - 2**64 if m >= 2**63 else m for m in masks]


def ring_passes(left: Column, right: Column, max_bits: int) -> Column:
    """Whether some chain of consecutive segments stays within its proportional budget at every length."""
    masks = _segments(max_bits + 2)
    m = len(masks)
    off = [F.bit_count(left.bitwiseXOR(right).bitwiseAND(F.lit(k))) for k in masks]
    chains = []
    for start in range(m):
        sums = [reduce(lambda a, b: a + b, [off[(start + i) % m] for i in range(length)]) for length in range(1, m + 1)]
        chains.append(reduce(lambda a, b: a & b, [s <= (n * max_bits) // m for n, s in enumerate(sums, 1)]))
    return reduce(lambda a, b: a | b, chains)


def _centres(prints: Column, max_bits: int) -> Column:
    """Values of which two fingerprints share one if, and only if, at most ``max_bits`` bits differ."""
    bits = [1 << b if b < 63 else -(2**63) for b in range(64)]
    if max_bits == 2:
        values = [prints, *(prints.bitwiseXOR(F.lit(b)) for b in bits)]
        return F.array(*(F.struct(F.lit(-1).alias("bit"), v.alias("value")) for v in values))
    return F.array(*(F.struct(F.lit(n).alias("bit"), prints.bitwiseAND(F.lit(~b)).alias("value")) for n, b in enumerate(bits)))


def link_edges(prints: DataFrame, max_bits: int = MAX_BITS, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints of column ``print`` as all links would."""
    if max_bits not in (0, 1, 2):
        raise ValueError("max_bits is 0, 1 or 2")
    if max_bits == 0:
        return prints.select(F.col("print").alias("a"), F.col("print").alias("b")).limit(0)
    masks = _segments(max_bits + 2)
    keys = [
        F.struct(F.lit(n).alias("pair"), F.col("print").bitwiseAND(F.lit(masks[i] | masks[j])).alias("bits"))
        for n, (i, j) in enumerate(combinations(range(len(masks)), 2))
    ]
    keyed = prints.select("print", F.inline(F.array(*keys)))
    sizes = keyed.groupBy("pair", "bits").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    crowded = stored(keyed.join(sizes, ["pair", "bits"]))
    few = crowded.filter(F.col("size") <= small_bucket)
    a, b = few.select("pair", "bits", F.col("print").alias("a")), few.select("pair", "bits", F.col("print").alias("b"))
    one, other = F.col("a"), F.col("b")
    close = (one < other) & ring_passes(one, other, max_bits) & (F.bit_count(one.bitwiseXOR(other)) <= max_bits)
    pairs = a.join(b, (a.pair == b.pair) & (a.bits == b.bits) & close).select("a", "b")
    many = crowded.filter(F.col("size") > small_bucket).select("print").distinct()
    spread = many.select("print", F.inline(_centres(F.col("print"), max_bits)))
    least = spread.groupBy("bit", "value").agg(F.min("print").alias("b"), F.max("print").alias("most")).filter("b < most")
    stars = spread.join(least, ["bit", "value"]).filter("print <> b").select(F.col("print").alias("a"), "b")
    return pairs.union(stars).distinct()


def group_prints(prints: DataFrame, doc_id: str, max_bits: int = MAX_BITS) -> DataFrame:
    """(print, root, first_id) for every distinct fingerprint: its component and the smallest id of that."""
    classes = stored(prints.groupBy(F.col("__print").alias("print")).agg(F.min(doc_id).alias("first_id")))
    roots = connected(link_edges(classes.select("print"), max_bits)).toDF("print", "linked")
    members = classes.join(roots, "print", "left").select("print", F.coalesce("linked", "print").alias("root"), "first_id")
    firsts = members.groupBy("root").agg(F.min("first_id").alias("first_id"))
    return members.drop("first_id").join(firsts, "root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (hex) and ``component_id``, the smallest id it is linked to.

    Null and empty texts and texts without words have fingerprint zero and are linked like any other. Rows
    with a null id belong to components too; a component of null ids only has a null ``component_id``. Repeated rows
    come out repeated. Only the two named columns are read, so further columns can have any name.
    """
    prints = stored(fingerprints(docs, [doc_id], text, words))
    groups = group_prints(prints, doc_id, max_bits).select(F.col("print").alias("__print"), F.col("first_id").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("__print"), 16, "0"))
    return prints.join(groups, "__print", "left").select(doc_id, hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` of which one document of each component stays: that with the smallest id.

    Repeated rows of that document count as one. If all ids of a component are null, a row with the smallest
    fingerprint stays. Rows are chosen by number, so texts are written once and shuffled only if the chosen numbers are too many to broadcast.
    """
    written = stored(fingerprints(docs, docs.columns, text, words).withColumn("__row", F.monotonically_increasing_id()), "zstd")
    named = written.select(F.col(doc_id).alias("id"), "__print", F.col("__row").alias("row"))
    groups = group_prints(named, "id", max_bits).select(F.col("print").alias("__print"), "root")
    best = F.struct(F.col("id").isNull().alias("absent"), "id", "__print", "row")
    kept = stored(named.join(groups, "__print").groupBy("root").agg(F.min(best).alias("best")).select(F.col("best.row").alias("__row")))
    return written.join(sized(kept), "__row", "left_semi").select(*docs.columns)
