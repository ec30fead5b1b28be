"""Mixing sources to target weights with packed blocks and pseudorandom slots.

The words of each source are laid end to end and cut into blocks of a fixed length. The mix is a row of slots, dealt
to output shards; every shard draws how many of its slots each source gets (a multinomial draw over the targets),
and the surplus of sources drawn too often is handed to those drawn too seldom, so totals come out exact. The n-th
slot of a source takes a block through a pseudorandom permutation of the source's block numbers, one permutation
for each pass over the source. Texts are cut at the bounds of chunks of neighbouring blocks, travel once, compressed by chunk, and meet the
chunk's slots. Documents are told apart by a row number that is written with their text, so ids may be null or repeated. All draws are
hashes of a seed, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.running import running_totals
from tidewatch.llm.common import chunks, stored
from tidewatch.session import attach, sized

# The weights of sources in code-point order, repeated; the mix's share of all words; the most passes over a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
BLOCK_WORDS, SHARD_SLOTS, ROUNDS = 64, 256, 24
# Slots that a task numbers and permutes; words of a chunk, which holds one block at least.
TASK_SLOTS, CHUNK_WORDS = 200_000, 4096
WORD = r"[^\x20\x09-\x0D]+"


@dataclass
class Mixture:
    """``rows``: documents with size; ``sources``: targets; ``slots``: the mix by block; ``texts``: (row, doc_id, skey, low, text), words by place."""

    rows: DataFrame
    sources: DataFrame
    slots: DataFrame
    texts: DataFrame
    block_words: int


def _long(value: Column) -> Column:
    return value.cast("bigint")


def count_words(text: Column) -> Column:
    return _long(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)))


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Add ``weight`` and ``target`` to (skey, size): shares by weight, none above ``most`` times its size.

    Each round is one aggregate over the sources: those above their limit stop there and the rest share what is left.
    """
    ranked = running_totals(sources.withColumn("one", F.lit(1)), ["skey"], {"rank": "one"}).drop("one")
    order = F.array(*map(F.lit, weights))
    ranked = stored(ranked.withColumn("weight", F.get(order, (F.col("rank") % len(weights)).cast("int"))).drop("rank"))
    total = ranked.agg(F.sum("size")).first()[0] or 0
    level, above = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > F.col("size") * most
        r = ranked.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, F.col("size") * most)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if r[0] == above or not r[2]:
            break
        above, level = r[0], (total * share - (r[1] or 0)) / r[2]
    return ranked.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), (F.col("size") * most).cast("double")))


def _within(values: DataFrame, value: str, ranges: DataFrame, low: str, high: str, span: int, count: int) -> DataFrame:
    """Join every value with the one range [low, high) that holds it, by way of equal bins of [0, span)."""
    width = max(1, span // (4096 + 4 * count))
    binned = ranges.filter(F.col(high) > F.col(low)).withColumn(
        "bin", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor((F.col(high) - 1) / width)))
    )
    joined = values.withColumn("bin", F.floor(F.col(value) / width)).join(sized(binned, 8192 + 6 * count), "bin")
    return joined.filter((F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))).drop("bin")


def permuted(index: Column, size: Column, rounds: int, *key: Column | int) -> Column:
    """A pseudorandom permutation of 0 .. size - 1, chosen by ``key``: in each round an index and its mirror swap or stay."""

    def step(x: Column, n: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(n, F.lit("k"), *key), size) - x, size)
        swap = F.pmod(F.xxhash64(n, F.lit("b"), F.greatest(x, mirror), *key), F.lit(2)) == 1
        return F.when(swap, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, step)


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE, most: int = MOST, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 7,
) -> Mixture:
    """Plan the mix of all documents. Null text has no words; null is a source of its own, after all others.

    Sources without words have target 0. Repeated rows are packed one after the other like other documents. An
    empty table gives empty results. Only the three named columns are read.
    """
    spark, long_block = docs.sparkSession, F.lit(block_words)
    skey = F.coalesce(F.concat(F.lit("a"), F.col(source)), F.lit("b"))
    picked = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), skey.alias("skey"), count_words(F.col(text)).alias("size"),
        F.xxhash64(text).alias("tie"), F.col(text).alias("text"),
    )
    written = stored(picked.withColumn("row", F.monotonically_increasing_id()), "zstd")
    rows = written.drop("text")
    totals = rows.groupBy("skey", "source").agg(F.sum("size").alias("size"))
    sources = targets(totals, weights, share, most)
    # Slots of a source: whole passes, then so many blocks of the next; the last slot is cut to meet the target.
    blocks = F.ceil(F.col("size") / block_words)
    words = F.least(_long(F.floor(F.col("target") + 0.5)), F.col("size") * most)
    passes = F.when(F.col("size") > 0, F.floor(words / F.col("size"))).otherwise(F.lit(0).cast("bigint"))
    sources = sources.withColumns({"blocks": blocks, "words": words, "passes": passes})
    sources = sources.withColumns({
        "short": F.col("size") - (F.col("blocks") - 1) * block_words,
        "rest": F.col("words") - F.col("passes") * F.col("size"),
        "place": F.when(F.col("blocks") > 0, F.pmod(F.xxhash64(F.lit(seed), "skey"), F.col("blocks"))).otherwise(F.lit(0).cast("bigint")),
    })
    before = F.col("rest") <= F.col("place") * long_block
    extra = F.when(before, F.ceil(F.col("rest") / block_words)).otherwise(
        1 + F.ceil(F.greatest(F.col("rest") - F.col("short"), F.lit(0)) / block_words)
    )
    done = F.when(before, (F.col("extra") - 1) * long_block).otherwise(
        F.when(F.col("extra") - 1 == F.col("place"), F.col("place") * long_block).otherwise((F.col("extra") - 2) * long_block + F.col("short"))
    )
    sources = sources.withColumn("extra", F.when(F.col("rest") > 0, extra).otherwise(F.lit(0).cast("bigint")))
    sources = sources.withColumn("cut", F.when(F.col("rest") > 0, F.col("rest") - done))
    sources = sources.withColumn("quota", F.col("passes") * F.col("blocks") + F.col("extra"))
    sources = running_totals(sources, ["skey"], {"low": "quota"}).withColumn("high", F.col("low") + F.col("quota"))
    sources = stored(sources)
    count, total = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("quota"), F.lit(0))).first()

    # Each shard's slots fall on the sources' shares of all slots.
    slots = spark.range(total).select(F.col("id").alias("slot"), F.floor(F.col("id") / shard_slots).alias("shard"))
    slots = slots.withColumn("fall", F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "slot"), F.lit(max(total, 1))))
    drawn = _within(slots, "fall", sources.select("skey", "low", "high"), "low", "high", total, count)
    counts = drawn.groupBy("shard", "skey").agg(F.count(F.lit(1)).alias("drawn"))
    counts = running_totals(counts, ["shard"], {"first": "drawn"}, by=["skey"])
    spread = counts.repartition(int(total // TASK_SLOTS) + 1, "shard")
    numbered = spread.select("shard", "skey", F.explode(F.sequence("first", F.col("first") + F.col("drawn") - 1)).alias("k"))

    # Surplus slots fill the deficits, in order.
    got = counts.groupBy("skey").agg(F.sum("drawn").alias("got"))
    balance = sources.join(got, "skey", "left").select("skey", "quota", F.coalesce("got", F.lit(0)).alias("got"))
    balance = balance.withColumns({"over": F.greatest(F.col("got") - F.col("quota"), F.lit(0)), "under": F.greatest(F.col("quota") - F.col("got"), F.lit(0))})
    balance = running_totals(balance, ["skey"], {"over_low": "over", "under_low": "under"})
    balance = stored(balance.withColumn("under_high", F.col("under_low") + F.col("under")))
    surplus = balance.agg(F.coalesce(F.sum("over"), F.lit(0))).first()[0]
    judged = attach(numbered, balance.select("skey", "quota", "over_low"), ["skey"], count)
    kept = judged.filter(F.col("k") < F.col("quota")).select("shard", "skey", "k")
    moved = judged.filter(F.col("k") >= F.col("quota")).select("shard", (F.col("over_low") + F.col("k") - F.col("quota")).alias("g"))
    moved = _within(moved, "g", balance.select("skey", "got", "under_low", "under_high"), "under_low", "under_high", surplus, count)
    dealt = kept.union(moved.select("shard", "skey", F.col("got") + F.col("g") - F.col("under_low")))

    # The k-th slot of a source takes the block that the permutation of its pass gives.
    dealt = attach(dealt, sources.select("skey", "blocks", "place", "cut", "quota"), ["skey"], count)
    turn, step = F.floor(F.col("k") / F.col("blocks")), F.col("k") % F.col("blocks")
    whole = permuted(F.col("step") - F.when(F.col("step") > F.col("place"), 1).otherwise(0), F.greatest(F.col("blocks") - 1, F.lit(1)), ROUNDS, F.lit(seed), F.col("skey"), F.col("turn"))
    dealt = dealt.withColumns({"turn": turn, "step": step})
    dealt = dealt.withColumn("block", F.when(F.col("step") == F.col("place"), F.col("blocks") - 1).otherwise(whole))
    dealt = dealt.withColumn("take", F.when(F.col("k") == F.col("quota") - 1, F.col("cut")))
    slots = stored(dealt.select("shard", "skey", "k", "block", F.coalesce("take", long_block).alias("take")))

    # Only short rows are sorted to place the documents in their sources; a text is then given its place.
    packed = running_totals(rows.filter("size > 0"), ["doc_id", "tie", "row"], {"low": "size"}, by=["skey"])
    places = sized(stored(packed.select("row", "low")))
    texts = written.filter("size > 0").select("row", "doc_id", "skey", "text").join(places, "row")
    return Mixture(rows, sources, slots, texts.select("row", "doc_id", "skey", "low", "text"), block_words)


def _cut(span: int):
    """Per run of documents: their words by source and chunk, compressed. A word holds no blank, so blanks and line ends can part them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for part in (p for batch in batches for p in chunks(batch, "text")):
            found: dict[tuple[str, int], tuple[list, ...]] = {}
            ids = part.column(1)
            for n, row in enumerate(part.select(["row", "skey", "low", "text"]).to_pylist()):
                words, low = row["text"].encode().split(), row["low"]
                for chunk in range(low // span, (low + len(words) - 1) // span + 1):
                    begin = max(low, chunk * span)
                    held = words[begin - low : (chunk + 1) * span - low]
                    for value, into in zip((begin - chunk * span, row["row"], n, b" ".join(held)), found.setdefault((row["skey"], chunk), ([], [], [], []))):
                        into.append(value)
            columns = [
                pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int64()),
                pa.array([f[0] for f in found.values()], pa.list_(pa.int32())), pa.array([f[1] for f in found.values()], pa.list_(pa.int64())),
                _lists([ids.take(pa.array(f[2], pa.int64())) for f in found.values()], ids.type),
                pa.array([packer.compress(b"\n".join(f[3])) for f in found.values()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["skey", "chunk", "begins", "rows", "doc_ids", "words"])

    return run


def _lists(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    flat = pa.concat_arrays(parts) if parts else pa.array([], kind)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)), flat)


def _fill(block_words: int, per_chunk: int):
    """Texts of slots, from records sorted by source and chunk: a chunk's words come before its slots."""
    names = ["shard", "skey", "k", "doc_ids", "rows", "counts", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        key, pieces = None, []
        for batch in batches:
            kind = batch.schema.field("doc_ids").type.value_type
            out: list[tuple] = []
            for record in batch.to_pylist():
                if (record["skey"], record["chunk"]) != key:
                    key, pieces = (record["skey"], record["chunk"]), []
                if record["words"] is not None:
                    texts = unpacker.decompress(record["words"]).decode().split("\n")
                    pieces += [(b, r, d, t.split(" ")) for b, r, d, t in zip(record["begins"], record["rows"], record["doc_ids"], texts)]
                    pieces.sort(key=lambda p: p[0])
                    continue
                low = record["block"] % per_chunk * block_words
                high = low + min(record["take"], block_words)
                parts = [(p[1], p[2], p[3][max(low - p[0], 0) : high - p[0]]) for p in pieces if p[0] < high and p[0] + len(p[3]) > low]
                text = " ".join(" ".join(w) for _, _, w in parts)
                out.append((record["shard"], record["skey"], record["k"], [p[1] for p in parts], [p[0] for p in parts], [len(p[2]) for p in parts], text))
            if out:
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.list_(kind), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return run


def _filled(m: Mixture) -> DataFrame:
    """``shard, skey, k, doc_ids, rows, counts, text``: every slot with its words, and the documents and numbers of words they are from."""
    per_chunk = max(1, CHUNK_WORDS // m.block_words)
    longs, chunk = T.ArrayType(T.LongType()), T.StructField("chunk", T.LongType())
    ids = T.ArrayType(m.texts.schema["doc_id"].dataType)
    skey = T.StructField("skey", T.StringType())
    cut = T.StructType([
        skey, chunk, T.StructField("begins", T.ArrayType(T.IntegerType())), T.StructField("rows", longs), T.StructField("doc_ids", ids), T.StructField("words", T.BinaryType()),
    ])
    runs = m.texts.mapInArrow(_cut(per_chunk * m.block_words), cut)
    slots = m.slots.select("shard", "skey", "k", "block", "take", F.floor(F.col("block") / per_chunk).alias("chunk"))
    records = runs.unionByName(slots, allowMissingColumns=True)
    sorted_ = records.repartition("skey", "chunk").sortWithinPartitions("skey", "chunk", F.col("words").isNull())
    filled = T.StructType([
        T.StructField("shard", T.LongType()), skey, T.StructField("k", T.LongType()), T.StructField("doc_ids", ids), T.StructField("rows", longs),
        T.StructField("counts", longs), T.StructField("text", T.StringType()),
    ])
    return sorted_.mapInArrow(_fill(m.block_words, per_chunk), filled)


def _texts() -> list[Column | str]:
    return ["shard", F.when(F.col("skey") != "b", F.substring("skey", 2, 2**31 - 1)).alias("source"), "k", "doc_ids", "text"]


def words_taken(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` (words of it in the mix, repeats counted).

    The mix is written, and its words are counted.
    """
    m = mix(docs, doc_id, text, source, **options)
    written = stored(_filled(m).select(*_texts(), F.arrays_zip(F.col("rows").alias("row"), F.col("counts").alias("words")).alias("parts")), "zstd")
    taken = written.select(F.inline("parts")).groupBy("row").agg(F.sum("words").alias("taken"))
    rows = m.rows.join(taken, "row", "left")
    count = m.sources.count()
    rows = attach(rows, m.sources.select("skey", F.col("size").alias("source_size"), "target"), ["skey"], count)
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mixed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: ``shard, source, k, doc_ids, text``, one row per slot with its block's words joined by spaces.

    ``doc_ids`` has one entry, null for a null id, for each row whose words stand in the slot.
    """
    return _filled(mix(docs, doc_id, text, source, **options)).select(*_texts())
