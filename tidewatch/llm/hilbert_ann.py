"""Nearest neighbours by shifted Hilbert curves.

Vectors are projected several times to a few dimensions, shifted and keyed along a Hilbert curve. Every curve's keys are
range-partitioned, sorted and numbered by Spark. A query's neighbours are sought among the vectors within a window of
places around its own place on each curve; windows of all curves are merged and ranked by the exact measure.
The window is not guessed: for a bounded sample of queries the true neighbours are found by brute force, and the window is as
wide as it takes to hold the wanted share of them on some curve.

Largest inner product is turned into least distance by one more dimension that brings all vectors to the same length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.running import running_totals
from tidewatch.llm.common import stored
from tidewatch.session import attach

NEAREST, RECALL = 20, 0.95
CURVES, DIMENSIONS, BITS = 8, 8, 7
BLOCK_ROWS, QUERY_ROWS = 4096, 4096
# Rows that fit the projections' scale, and queries that fit the window. Both are collected.
FIT_ROWS, FIT_QUERIES = 4096, 96


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of cell numbers, which have ``bits`` bits."""
    x = [c.astype(np.uint64) for c in cells.T]
    n, one = len(x), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        low = np.uint64((1 << level) - 1)
        for i in range(n):
            set_ = (x[i] >> np.uint64(level)) & one == one
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0]) ^ swap
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(cells), np.uint64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> np.uint64(level)) & one == one, np.uint64((1 << level) - 1), np.uint64(0))
    key = np.zeros(len(cells), np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | (((x[i] ^ turn) >> np.uint64(level)) & one)
    return key.astype(np.int64)


class Curves:
    """Projections, shifts and scales of all curves, fitted to a sample."""

    def __init__(self, sample: np.ndarray, longest: float, curves: int, dimensions: int, bits: int, seed: int):
        self.longest, self.bits = longest, bits
        rng = np.random.default_rng(seed)
        width = sample.shape[1] + 1
        kept = min(dimensions, width)
        self.axes = [np.linalg.qr(rng.normal(size=(width, kept)))[0] for _ in range(curves)]
        lifted = self.lift(sample)
        self.middle = lifted.mean(axis=0)
        self.scale = [np.maximum(((lifted - self.middle) @ a).std(axis=0), 1e-12) for a in self.axes]
        self.shift = [rng.uniform(-1, 1, kept) for _ in range(curves)]

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0)
        return np.hstack([vectors, np.sqrt(rest)[:, None]])

    def as_query(self, vectors: np.ndarray) -> np.ndarray:
        norms = np.sqrt((vectors**2).sum(axis=1))[:, None]
        return np.hstack([vectors / norms * self.longest, np.zeros((len(vectors), 1))])

    def keys(self, lifted: np.ndarray) -> Iterator[np.ndarray]:
        for axes, scale, shift in zip(self.axes, self.scale, self.shift):
            at = ((lifted - self.middle) @ axes) / scale + shift
            cells = np.clip((at + 4) / 8 * (1 << self.bits), 0, (1 << self.bits) - 1).astype(np.int64)
            yield hilbert_keys(cells, self.bits)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _place(curves):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = curves.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, reps = _matrix(batch.column(1)), batch.column(0)
            asked = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for query, rows in ((0, np.ones(len(asked), bool)), (1, asked)):
                lifted = (c.as_query if query else c.lift)(vectors[rows])
                ids = reps.filter(pa.array(rows))
                for n, keys in enumerate(c.keys(lifted)):
                    size = len(keys)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(size, n), pa.int32()), pa.array(keys), ids, pa.array(np.full(size, query), pa.int32()), pa.array(np.full(size, 1 - query), pa.int64())],
                        ["curve", "key", "rep", "query", "one"],
                    )

    return run


def top(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Columns of the ``count`` best scores of each row, ties to smaller ids; columns of -inf may be among them."""
    count = min(count, scores.shape[1])
    edge = -np.partition(-scores, count - 1, axis=1)[:, count - 1 : count]
    out = np.empty((len(scores), count), np.int64)
    for row, (line, least) in enumerate(zip(scores, edge[:, 0])):
        close = np.flatnonzero(line >= least)
        out[row] = close[np.lexsort((ids[close], -line[close]))[:count]]
    return out


def exact(queries: np.ndarray, vectors: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Inner products of each query with its chosen vectors, alike wherever they are computed."""
    return np.stack([np.einsum("ij,ij->i", np.repeat(queries[i : i + 1], chosen.shape[1], 0), vectors[c]) for i, c in enumerate(chosen)])


def _brute(queries, count: int):
    """The best vectors of each batch for the sample's queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q = queries.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1))
            scores = q @ vectors.T
            scores[q_ids[:, None] == ids[None, :]] = -np.inf
            best = top(scores, ids, count)
            rows = np.repeat(np.arange(len(q)), best.shape[1])
            picked = scores[rows, best.ravel()]
            use = np.isfinite(picked)
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[rows][use]), pa.array(ids[best.ravel()][use]), pa.array(picked[use])], ["asked", "rep", "score"])

    return run


def _search(window: int, count: int):
    """The best vectors of a block for each query whose window reaches into it."""
    kinds = pa.schema([("asked", pa.int64()), ("reps", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        is_query = table["query"].to_numpy().astype(bool)
        rank, reps = table["rank"].to_numpy(), table["rep"].to_numpy()
        vectors = _matrix(table["vec"].combine_chunks() if table.num_rows else table["vec"])
        own_rank, own_ids, own = rank[~is_query], reps[~is_query], vectors[~is_query]
        asked, at, q = reps[is_query], rank[is_query], vectors[is_query]
        out = ([], [], [])
        for low in range(0, len(q), 256) if len(own) else ():
            part = slice(low, low + 256)
            scores = q[part] @ own.T
            scores[np.abs(at[part][:, None] - own_rank[None, :]) > window] = -np.inf
            scores[asked[part][:, None] == own_ids[None, :]] = -np.inf
            best = top(scores, own_ids, count)
            value = np.where(np.isfinite(np.take_along_axis(scores, best, 1)), exact(q[part], own, best), -np.inf)
            for a, b, v in zip(asked[part].tolist(), best, value):
                use = np.isfinite(v)
                out[0].append(a)
                out[1].append(own_ids[b[use]].tolist())
                out[2].append(v[use].tolist())
        return pa.table([pa.array(c, f.type) for c, f in zip(out, kinds)], schema=kinds)

    return run


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", is_query: Column | None = None, count: int = NEAREST, recall: float = RECALL,
    curves: int = CURVES, dimensions: int = DIMENSIONS, bits: int = BITS, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, seed: int = 3,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its ``count`` nearest others found, by largest inner product.

    ``is_query`` is a condition on ``id``. Null, zero and non-finite vectors, null ids and vectors whose length is not
    the commonest take no part. Of rows with the same id the least vector counts. Equal vectors are one point
    of the search and share its neighbours; only their ``count + 1`` smallest ids can ever be results. Ids are integers.
    An empty table has no results. Only the two named columns are read.
    """
    spark = rows.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    picked = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("vec")).filter(F.col("id").isNotNull() & usable(F.col("vec")))
    usual = picked.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if usual is None:
        return spark.createDataFrame([], schema)
    picked = stored(picked.filter(F.size("vec") == usual["size"]).groupBy("id").agg(F.min("vec").alias("vec")))
    asking = (F.lit(True) if is_query is None else is_query).cast("int")

    # Equal vectors make a class, named by its smallest id.
    by_class = Window.partitionBy("vec").orderBy("id")
    members = picked.withColumn("n", F.row_number().over(by_class)).filter(F.col("n") <= count + 1)
    classes = members.groupBy("vec").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"))
    asked = picked.groupBy("vec").agg(F.max(asking).alias("asked"))
    classes = stored(classes.join(asked, "vec"))
    reps = classes.select("vec", "rep")
    queries = stored(picked.filter(asking == 1).join(reps, "vec").select(F.col("id").alias("query_id"), "rep"))

    # Curves, and each point's place on them.
    longest = classes.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))).first()[0] ** 0.5
    fit = classes.orderBy(F.xxhash64("rep"), "rep").limit(FIT_ROWS).select("vec").collect()
    shape = spark.sparkContext.broadcast(Curves(np.array([r.vec for r in fit], np.float64), longest, curves, dimensions, bits, seed))
    keyed = classes.select("rep", "vec", "asked").mapInArrow(_place(shape), "curve int, key bigint, rep bigint, query int, one bigint")
    placed = running_totals(keyed, ["key", "rep", "query"], {"rank": "one"}, by=["curve"])
    placed = stored(placed.select("curve", "rep", "query", "rank"))

    # The window that holds enough true neighbours of sampled queries.
    sample = classes.filter("asked = 1").orderBy(F.xxhash64("rep"), "rep").limit(FIT_QUERIES).select("rep", "vec").collect()
    if not sample:
        return spark.createDataFrame([], schema)
    points = spark.sparkContext.broadcast((np.array([r.rep for r in sample]), np.array([r.vec for r in sample], np.float64)))
    true = classes.select("rep", "vec").mapInArrow(_brute(points, count), "asked bigint, rep bigint, score double")
    by_query = Window.partitionBy("asked").orderBy(F.desc("score"), "rep")
    true = true.withColumn("n", F.row_number().over(by_query)).filter(F.col("n") <= count).select("asked", "rep")
    mine = placed.filter("query = 1").select("curve", F.col("rep").alias("asked"), F.col("rank").alias("at"))
    gaps = true.join(placed.filter("query = 0"), "rep").join(mine, ["curve", "asked"])
    needed = gaps.groupBy("asked", "rep").agg(F.min(F.abs(F.col("at") - F.col("rank"))).alias("gap")).select("gap").collect()
    width = int(np.quantile([r.gap for r in needed], recall, method="higher")) + 1 if needed else 1

    # Windows reach into blocks of places; queries of a crowded block are dealt to copies of it.
    blocks = F.when(F.col("query") == 1, F.sequence(F.greatest(F.floor((F.col("rank") - width) / block_rows), F.lit(0)), F.floor((F.col("rank") + width) / block_rows)))
    spread = placed.withColumn("block", F.explode(F.coalesce(blocks, F.array(F.floor(F.col("rank") / block_rows)))))
    crowds = spread.groupBy("curve", "block").agg(F.ceil(F.sum("query") / query_rows).alias("parts")).filter("parts > 0")
    spread = attach(spread, crowds, ["curve", "block"]).filter("parts > 0")
    part = F.when(F.col("query") == 1, F.array(F.pmod(F.xxhash64("rep"), "parts"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    spread = spread.withColumn("part", F.explode(part))
    full = spread.join(classes.select("rep", "vec"), "rep").select("curve", "block", "part", "rep", "query", "rank", "vec")
    found = full.groupBy("curve", "block", "part").applyInArrow(_search(width, count), "asked bigint, reps array<bigint>, scores array<double>")

    # Merge curves, expand classes, rank.
    pairs = found.select("asked", F.inline(F.arrays_zip(F.col("reps").alias("rep"), F.col("scores").alias("score"))))
    merged = pairs.groupBy("asked", "rep").agg(F.max("score").alias("score"))
    best = merged.withColumn("n", F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), "rep"))).filter(F.col("n") <= count)
    ids = classes.select("rep", "ids")
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    own = classes.filter("asked = 1 and size(ids) > 1").select(F.col("rep").alias("asked"), "rep", square.alias("score"))
    listed = best.select("asked", "rep", "score").union(own).join(ids, "rep").select("asked", "score", F.explode("ids").alias("vec_id"))
    ranked = queries.join(listed, queries.rep == listed.asked).filter("query_id <> vec_id")
    by_row = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return ranked.withColumn("rank", F.row_number().over(by_row)).filter(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")
