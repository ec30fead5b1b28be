"""Removal of byte strings that documents with smaller ids have too, by distributed deep-shallow suffix sorting.

Equal strings of ``length`` bytes must meet in one task without sending every suffix. Each such window of a text is
dealt by its anchor: the K bytes in it whose hash is least. Runs of neighbouring windows with one anchor
travel together as one record of at most ``2 * length`` bytes, packed and compressed by target bucket. A record that
occurs in several documents of a unit leaves it once, and places of it in one document that lie within a window of each
other, as in a run of blanks, leave it as one range. In a bucket, equal records settle most repeats at once; where
an anchor has different records, their windows are suffix-sorted (deep_shallow) and equal neighbours found. Anchors with
more records than a bucket should hold are found in a sample first; their windows are not dealt by anchor but
compared with the least id of the same window, an aggregate combined before its shuffle. The sample decides on cost only, not
on results. Removed spans return to the documents in packed slices. Buckets and slices grow in number with the input, not in size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import chunks, stored, utf8
from tidewatch.llm.deep_shallow import sort_suffixes
from tidewatch.session import attach

LENGTH = 50
ANCHOR = 12
# Bytes of text per packing unit, bucket and slice.
UNIT_BYTES, BUCKET_BYTES, SLICE_BYTES = 4 << 20, 6 << 20, 6 << 20
_STEP = 1 << 20
# Records of one anchor above which it is hot; bytes of a sampled piece, one in so many pieces, and input that is counted whole.
HOT_ROWS = 200_000
PIECE_BYTES, PIECE_EVERY, WHOLE_BYTES = 128 << 10, 16, 32 << 20
_NONE = np.zeros(0, np.uint64)
_LAST_ID = 2**63 - 1
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9))


def _hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    h = first * _MIX[0] + second * _MIX[1]
    h ^= h >> np.uint64(29)
    h *= _MIX[2]
    h ^= h >> np.uint64(32)
    return h


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of ``data`` on."""
    return np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h * _MIX[1]) >> np.uint64(31)) % np.uint64(buckets)


def anchored_runs(data: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of valid windows with the same anchor: first window, number of windows, anchor's place in it, anchor's hash."""
    places = length - ANCHOR + 1
    windows = len(valid)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = _words(padded)
    grams = windows + places - 1
    h = _hash(words[:grams], words[ANCHOR - 8 : ANCHOR - 8 + grams])
    low = np.uint64((1 << 24) - 1)
    least, span = (h & ~low) | np.arange(grams, dtype=np.uint64), 1
    while span * 2 <= places:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < places:
        least = np.minimum(least[: len(least) - (places - span)], least[places - span :])
    anchor = (least & low).astype(np.int64)
    other = anchor[1:] != anchor[:-1]
    first, last = valid.copy(), valid.copy()
    first[1:] &= other | ~valid[:-1]
    last[:-1] &= other | ~valid[1:]
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    return begin, end - begin + 1, anchor[begin] - begin, h[anchor[begin]]


def record_width(length: int) -> int:
    return -(-(2 * length - ANCHOR + 2) // 8) * 8


def build_records(data: np.ndarray, begin: np.ndarray, windows: np.ndarray, offset: np.ndarray, length: int) -> np.ndarray:
    """One row per run: its bytes, zeros, number of windows, anchor's place."""
    width = record_width(length)
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    records = np.lib.stride_tricks.sliding_window_view(padded, width)[begin]
    records[np.arange(width)[None, :] >= (windows + length - 1)[:, None]] = 0
    records[:, -2], records[:, -1] = windows, offset
    return records


def record_hash(records: np.ndarray) -> np.ndarray:
    words = records.view("<u8")
    factors = np.cumprod(np.full(words.shape[1], _MIX[0])) | np.uint64(1)
    h = (words * factors).sum(axis=1, dtype=np.uint64)
    return _hash(h, words[:, -1] + words[:, 0])


def classes(records: np.ndarray, ids: np.ndarray, *lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by ``lead``, record and id, and where in it a new record begins; rows are compared byte by byte."""
    h = record_hash(records)
    order = np.lexsort((ids, h, *lead))
    words = records.view("<u8")[order]
    opens = np.ones(len(order), bool)
    opens[1:] = (words[1:] != words[:-1]).any(axis=1)
    return order, opens


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal rank side by side, which compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _unplanes(raw: memoryview, kind: type, count: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, count * size).reshape(size, count).T).reshape(-1).view(kind)


def pack(arrays: list[np.ndarray], tail: bytes = b"", level: int = 1) -> bytes:
    return zstandard.compress(np.int64(len(arrays[0])).tobytes() + b"".join(map(_planes, arrays)) + tail, level)


def unpack(blob: bytes, kinds: list[type]) -> tuple[list[np.ndarray], memoryview]:
    raw = memoryview(zstandard.decompress(blob))
    count, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in kinds:
        out.append(_unplanes(raw[at:], kind, count))
        at += count * np.dtype(kind).itemsize
    return out, raw[at:]


_SPAN = [np.int64, np.int64, np.int64, np.int64]


def merge_spans(ids, ties, begin, end) -> list[np.ndarray]:
    """Sorted spans per document, with overlapping and touching ones joined."""
    if not len(ids):
        return [np.zeros(0, np.int64) for _ in range(4)]
    order = np.lexsort((begin, ties, ids))
    ids, ties, begin, end = ids[order], ties[order], begin[order], end[order]
    doc = np.ones(len(ids), bool)
    doc[1:] = (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])
    number = np.cumsum(doc) - 1
    base = number * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + base)
    opens = doc.copy()
    opens[1:] |= (begin + base)[1:] > reach[:-1]
    heads = np.flatnonzero(opens)
    lasts = np.concatenate([heads[1:], [len(ids)]]) - 1
    return [ids[heads], ties[heads], begin[heads], reach[lasts] - base[lasts]]


def ranges(records: np.ndarray, own: np.ndarray, doc: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row and reach of every range of places of one record in one document, and whether a smaller id has the record.

    Places at most ``length`` apart make a range: the spans that they give touch, whichever windows of the record are removed.
    Rows are in order of place.
    """
    order, opens = classes(records, own)
    leader = np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))
    repeat = own[order] > own[order[leader]]
    starts = np.ones(len(order), bool)
    starts[1:] = opens[1:] | (doc[order][1:] != doc[order][:-1]) | (np.diff(at[order]) > length)
    heads = np.flatnonzero(starts)
    lasts = np.concatenate([heads[1:], [len(order)]]) - 1
    first, reach, repeat = order[heads], at[order[lasts]] - at[order[heads]], repeat[heads]
    by = np.argsort(first)
    return first[by], reach[by], repeat[by]


def pack_unit(data, runs, doc_of, offsets, ids, ties, buckets: int, length: int) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, kind, blob): records for their buckets (kind 0), and spans that the unit itself settles (kind 1)."""
    begin, windows, place, h = runs
    doc = doc_of(begin)
    own, at = ids[doc], begin - offsets[doc]
    records = build_records(data, begin, windows, place, length)
    first, reach, repeat = ranges(records, own, doc, at, length)
    if repeat.any():
        rows = first[repeat]
        spans = merge_spans(own[rows], ties[doc[rows]], at[rows], at[rows] + reach[repeat] + windows[rows] + length - 1)
        yield int(h[0] % np.uint64(buckets)), 1, pack(spans)
    first, reach = first[~repeat], reach[~repeat]
    bucket = _bucket(h[first], buckets).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    first, reach, bucket = first[by], reach[by], bucket[by]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(first) else []
    for a, b in zip(cuts, [*cuts[1:], len(first)]):
        rows = first[a:b]
        body = records[rows]
        used = np.arange(body.shape[1])[None, :] < (windows[rows] + length - 1)[:, None]
        columns = [
            windows[rows].astype(np.uint8), place[rows].astype(np.uint8), np.diff(own[rows], prepend=np.int64(0)), ties[doc[rows]],
            at[rows].astype(np.uint32), reach[a:b].astype(np.uint32),
        ]
        yield int(bucket[a]), 0, pack(columns, body[used].tobytes(), 4)


def _texts(batches: Iterator[pa.RecordBatch], length: int):
    """Offsets, bytes, ids and ties of runs of rows, and which bytes start a window."""
    for batch in batches:
        for part in chunks(batch, "text", UNIT_BYTES):
            offsets, data = utf8(part.column(part.schema.get_field_index("text")))
            ids = part.column(part.schema.get_field_index("id")).to_numpy(zero_copy_only=False)
            ties = part.column(part.schema.get_field_index("tie")).to_numpy(zero_copy_only=False)
            valid = np.zeros(len(data) + 1, np.int8)
            long_ = np.diff(offsets) >= length
            np.add.at(valid, offsets[:-1][long_], 1)
            np.add.at(valid, offsets[1:][long_] - length + 1, -1)
            valid = np.cumsum(valid, dtype=np.int8)[:-1] > 0
            yield offsets, data, ids, ties, valid


def _runs(data: np.ndarray, valid: np.ndarray, low: int, high: int, length: int) -> list[np.ndarray]:
    """The anchored runs of windows that start in [low, high)."""
    begin, *rest = anchored_runs(data[low : high + length - 1], valid[low:high], length)
    return [begin + low, *rest]


def _deal(buckets: int, length: int, hot: np.ndarray = _NONE):
    schema = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for offsets, data, ids, ties, valid in _texts(batches, length):
            for unit in range(0, len(data), UNIT_BYTES):
                found = []
                for low in range(unit, min(unit + UNIT_BYTES, len(data) - length + 1), _STEP):
                    one = _runs(data, valid, low, min(low + _STEP, unit + UNIT_BYTES, len(data) - length + 1), length)
                    found.append([c[~np.isin(one[3], hot)] for c in one] if len(hot) else one)
                runs = [np.concatenate(x) for x in zip(*found)]
                if not runs or not len(runs[0]):
                    continue
                rows = list(pack_unit(data, runs, lambda p: np.searchsorted(offsets, p, "right") - 1, offsets, ids, ties, buckets, length))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _count_anchors(every: int, length: int):
    """(anchor, rows): the records that sampled pieces of text would send by anchor, rare anchors in a random sample with weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for offsets, data, ids, _, valid in _texts(batches, length):
            rng = np.random.default_rng([len(data), int(ids[0]) & _LAST_ID])
            for low in range(0, len(data) - length + 1, PIECE_BYTES):
                if rng.integers(every):
                    continue
                begin, windows, place, h = _runs(data, valid, low, min(low + PIECE_BYTES, len(data) - length + 1), length)
                if not len(begin):
                    continue
                doc = np.searchsorted(offsets, begin, "right") - 1
                first, _, repeat = ranges(build_records(data, begin, windows, place, length), ids[doc], doc, begin, length)
                anchor, rows = np.unique(h[first[~repeat]], return_counts=True)
                seen = rng.random(len(rows)) * 16 < rows
                weights = np.maximum(rows[seen], 16) * every
                yield pa.RecordBatch.from_arrays([pa.array(anchor[seen].view(np.int64)), pa.array(weights.astype(np.int64))], ["anchor", "rows"])

    return run


def _hot_windows(hot: np.ndarray, length: int):
    """(window, id, tie, begin, last): ranges of places of the windows with hot anchors; no window if a smaller id here has it too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for offsets, data, ids, ties, valid in _texts(batches, length):
            for low in range(0, len(data) - length + 1, _STEP):
                begin, windows, _, h = _runs(data, valid, low, min(low + _STEP, len(data) - length + 1), length)
                begin, windows = (c[np.isin(h, hot)] for c in (begin, windows))
                if not len(begin):
                    continue
                start = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows - begin, windows)
                doc = np.searchsorted(offsets, start, "right") - 1
                own, at = ids[doc], start - offsets[doc]
                one = np.ones(len(start), np.int64)
                first, reach, repeat = ranges(build_records(data, start, one, 0 * one, length), own, doc, at, length)
                window = [None if r else data[s : s + length].tobytes() for s, r in zip(start[first].tolist(), repeat.tolist())]
                columns = [window, own[first], ties[doc[first]], at[first], at[first] + reach]
                kinds = [pa.binary(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["window", "id", "tie", "begin", "last"])

    return run


def _pack_spans(slices: int, length: int):
    """(slice, blob): the spans of a run of ranges, by target slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties, begin, last = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            yield _sliced(merge_spans(ids, ties, begin, last + length), slices)

    return run


def settle(blobs: list[tuple[int, bytes]], length: int) -> list[np.ndarray]:
    """The spans (id, tie, begin, end) that the records and spans of one bucket give."""
    width = record_width(length)
    done, parts, bodies = [], [], []
    for kind, blob in blobs:
        if kind == 1:
            done.append(unpack(blob, _SPAN)[0])
            continue
        columns, body = unpack(blob, [np.uint8, np.uint8, np.int64, np.int64, np.uint32, np.uint32])
        columns[2], columns[4], columns[5] = np.cumsum(columns[2]), columns[4].astype(np.int64), columns[5].astype(np.int64)
        parts.append(columns)
        used = np.arange(width)[None, :] < (columns[0].astype(np.int64) + length - 1)[:, None]
        records = np.zeros((len(columns[0]), width), np.uint8)
        records[used] = np.frombuffer(body, np.uint8)
        records[:, -2], records[:, -1] = columns[0], columns[1]
        bodies.append(records)
    if parts:
        windows, place, ids, ties, begin, reach = (np.concatenate(c) for c in zip(*parts))
        records = np.concatenate(bodies)
        del bodies, parts
        words = _words(records.reshape(-1))
        at = np.arange(len(records)) * width + place
        h = _hash(words[at], words[at + ANCHOR - 8])
        # Anchors of a single document share nothing.
        order = np.argsort(h, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
        mixed = np.minimum.reduceat(ids[order], heads) < np.maximum.reduceat(ids[order], heads)
        rows = order[np.repeat(mixed, np.diff([*heads, len(order)]))]
        if len(rows):
            windows, ids, ties, begin, records, h = windows[rows].astype(np.int64), ids[rows], ties[rows], begin[rows], records[rows], h[rows]
            reach = reach[rows]
            order, opens = classes(records, ids, h)
            number = np.cumsum(opens) - 1
            first = order[opens]
            least = ids[first]
            later = ids[order] > least[number]
            whole = order[later]
            done.append([ids[whole], ties[whole], begin[whole], begin[whole] + reach[whole] + windows[whole] + length - 1])
            done.append(_settle_mixed(order[~later], number[~later], first, least, windows, ids, ties, begin, reach, records, h, length))
    return merge_spans(*(np.concatenate(c) for c in zip(*done))) if done else merge_spans([], [], [], [])


def _settle_mixed(rows, number, first, least, windows, ids, ties, begin, reach, records, h, length):
    """Spans in the documents that own a record, from other records with the same anchor."""
    own = h[first]
    again = np.zeros(len(first), bool)
    again[1:] = own[1:] == own[:-1]
    again[:-1] |= own[:-1] == own[1:]
    several = np.flatnonzero(again)
    if not len(several):
        return [np.zeros(0, np.int64) for _ in range(4)]
    width = records.shape[1]
    data = np.concatenate([records[first[several]].reshape(-1), np.zeros(length + 8, np.uint8)])
    count = windows[first[several]]
    record = np.repeat(np.arange(len(several)), count)
    shift = np.arange(len(record)) - np.repeat(np.cumsum(count) - count, count)
    order, opens = sort_suffixes(data, record * width + shift, length)
    heads = np.flatnonzero(opens)
    owner = least[several][record[order]]
    best = np.minimum.reduceat(owner, heads)
    taken = owner > np.repeat(best, np.diff([*heads, len(order)]))
    hit, shift = several[record[order[taken]]], shift[order[taken]]
    # Every place of the owning document where the record stands.
    low, high = np.searchsorted(number, hit, "left"), np.searchsorted(number, hit, "right")
    times = high - low
    which = rows[np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)]
    start = begin[which] + np.repeat(shift, times)
    return [ids[which], ties[which], start, start + reach[which] + length]


def _slice(ids: np.ndarray, ties: np.ndarray, slices: int) -> np.ndarray:
    return (ids % slices + ties % slices) % slices


def _sliced(spans: list[np.ndarray], slices: int) -> pa.RecordBatch:
    """(slice, blob): spans by target slice."""
    to = _slice(spans[0], spans[1], slices)
    order = np.argsort(to, kind="stable")
    spans, to = [s[order] for s in spans], to[order]
    cuts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else []
    blobs = [(int(to[a]), pack([s[a:b] for s in spans])) for a, b in zip(cuts, [*cuts[1:], len(to)])]
    return pa.RecordBatch.from_arrays([pa.array([b[0] for b in blobs], pa.int64()), pa.array([b[1] for b in blobs], pa.binary())], ["slice", "blob"])


def _bucket_task(slices: int, length: int):
    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(table["kind"].to_pylist(), table["blob"].to_pylist()))
        return pa.Table.from_batches([_sliced(settle(rows, length), slices)])

    return run


def _pack_texts(slices: int):
    """(slice, blob): the documents of a run of rows, compressed by target slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, ties, times = (part.column(part.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("id", "tie", "times"))
                offsets, data = utf8(part.column(part.schema.get_field_index("text")))
                to = _slice(ids, ties, slices)
                order = np.argsort(to, kind="stable")
                heads = np.flatnonzero(np.concatenate([[True], to[order][1:] != to[order][:-1]])) if len(order) else []
                blobs = []
                for a, b in zip(heads, [*heads[1:], len(order)]):
                    rows = order[a:b]
                    texts = b"".join(data[offsets[i] : offsets[i + 1]].tobytes() for i in rows)
                    blobs.append(pack([ids[rows], ties[rows], times[rows], np.diff(offsets)[rows]], texts, 3))
                names = ["slice", "blob"]
                yield pa.RecordBatch.from_arrays([pa.array(to[order][heads] if blobs else [], pa.int64()), pa.array(blobs, pa.binary())], names)

    return run


_CUT = pa.schema([
    ("id", pa.int64()), ("times", pa.int64()), ("n_bytes", pa.int64()),
    ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()),
])


def _cut(docs: pa.Table, blobs: pa.Table) -> pa.Table:
    spans = [unpack(b, _SPAN)[0] for b in blobs["blob"].to_pylist()]
    ids, ties, begin, end = merge_spans(*(np.concatenate(c) for c in zip(*spans))) if spans else merge_spans([], [], [], [])
    by_doc: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i, t, a, b in zip(ids.tolist(), ties.tolist(), begin.tolist(), end.tolist()):
        by_doc.setdefault((i, t), []).append((a, b))
    rows = []
    for blob in docs["blob"].to_pylist():
        columns, texts = unpack(blob, _SPAN)
        at = 0
        for i, t, times, size in zip(*(c.tolist() for c in columns)):
            raw, last, parts, cuts = texts[at : at + size], 0, [], by_doc.get((i, t), [])
            at += size
            for a, b in cuts:
                parts.append(raw[last:a])
                last = b
            rows.append((i, times, size, [{"start": a, "end": b} for a, b in cuts], b"".join([*parts, raw[last:]])))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_CUT), _CUT)], schema=_CUT)


def hot_anchors(rows: DataFrame, total: int, length: int, hot_rows: int) -> np.ndarray:
    """Hashes of the anchors with more than ``hot_rows`` records, estimated; at most so many as records over ``hot_rows``."""
    if total <= hot_rows:
        return _NONE
    every = PIECE_EVERY if total > WHOLE_BYTES else 1
    counts = rows.select("id", "tie", "text").mapInArrow(_count_anchors(every, length), "anchor bigint, rows bigint")
    hot = counts.groupBy("anchor").agg(F.sum("rows").alias("rows")).filter(F.col("rows") > hot_rows).select("anchor").collect()
    return np.sort(np.array([r[0] for r in hot], np.int64).view(np.uint64))


def _hot_spans(rows: DataFrame, hot: np.ndarray, slices: int, length: int) -> DataFrame:
    """The spans that windows with hot anchors give."""
    found = stored(rows.select("id", "tie", "text").mapInArrow(_hot_windows(hot, length), "window binary, id bigint, tie bigint, begin bigint, last bigint"))
    least = found.filter("window is not null").groupBy("window").agg(F.min("id").alias("least"))
    later = attach(found, least, ["window"]).filter("window is null or id > least")
    return later.select("id", "tie", "begin", "last").mapInArrow(_pack_spans(slices, length), "slice bigint, blob binary")


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES, slice_bytes: int = SLICE_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, removed`` (maximal byte spans) and ``kept`` (the other bytes).

    A byte goes if a string of ``length`` bytes over it also starts in a document with a smaller id. Null text is empty.
    Rows with a null id stand after all others and take nothing from each other; rows with the same id
    take nothing from each other either, and equal rows come out as often as they came in. Ids are integers.
    ``length`` is 20 to 120. Only the two named columns are read.
    """
    if not 20 <= length <= 120:
        raise ValueError("length is 20 to 120")
    rows = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if rows.groupBy("id").count().filter("count > 1").limit(1).count():
        rows = rows.groupBy("id", "text").agg(F.count(F.lit(1)).alias("times")).withColumn("tie", F.xxhash64("text"))
    else:
        rows = rows.withColumns({"times": F.lit(1).cast("bigint"), "tie": F.lit(0).cast("bigint")})
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets, slices = int(total // bucket_bytes) + 1, 2 * int(total // slice_bytes // 2) + 1
    hot = hot_anchors(rows, total, length, hot_rows)
    dealt = rows.select("id", "tie", "text").mapInArrow(_deal(buckets, length, hot), "bucket bigint, kind int, blob binary")
    spans = dealt.groupBy("bucket").applyInArrow(_bucket_task(slices, length), "slice bigint, blob binary")
    if len(hot):
        spans = spans.unionByName(_hot_spans(rows, hot, slices, length))
    texts = rows.select("id", "tie", "times", "text").mapInArrow(_pack_texts(slices), "slice bigint, blob binary")
    cut = (
        texts.groupBy("slice").cogroup(spans.groupBy("slice"))
        .applyInArrow(_cut, "id bigint, times bigint, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary")
    )
    cut = cut.withColumn("id", F.when(F.col("id") != _LAST_ID, F.col("id")))
    return cut.withColumn("times", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int")))).select(F.col("id").alias("doc_id"), "n_bytes", "removed", "kept")
