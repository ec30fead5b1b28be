"""Repair of damaged conversations by the cheapest edits, ties settled by prefix-doubled ranks.

Rows are laid out by conversation and turn in range partitions, so a conversation of any length is spread, and cut into
slices of bounded length. Inside a slice a cost DP runs backwards over (row, state) nodes of the turn-order machine, once for
each state that the slice may end in. Arcs that keep to the cheapest cost are the optimal arcs; nodes are ranked by the first
letter of their least audit, then by 2, 4, 8 ... letters from the ranks of a node and of the node its pointer reaches, and the
pointers are doubled with them. The least path of a start node is read off through the doubled pointers. Slices are then chained:
a slice is a 4 x 4 table of costs and ranks, so the choice of states at the cuts reads one short row per slice.

Inserts before a row belong to that row's slice. All paths of a slice therefore use up the same rows and end with a letter that uses up
the last one, so none is a prefix of another, and ranks inside a slice decide before those of later slices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

# Rows of a slice, and rows that are gathered before slices are solved together.
SLICE_ROWS, GATHER_ROWS = 4096, 16384
BLANKS = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
# States: nothing yet, after system, after user, after assistant. Role codes: other, system, user, assistant.
START, TOLD, ASKED, ANSWERED = range(4)
_NEXT = np.array([ASKED, ASKED, ANSWERED, ASKED])
_KEEP = np.array([[-1, TOLD, ASKED, -1], [-1, -1, ASKED, -1], [-1, -1, -1, ANSWERED], [-1, -1, ASKED, -1]])
_ROLE = {ASKED: "user", ANSWERED: "assistant"}
_CODE = {"s": 1, "u": 2, "a": 3}
_FAR = 1 << 50
# Cost and audit from each state to an accepting one behind the last row; the audits' order.
END_COST, END_AUDIT, END_RANK = [0, 2 * INSERT, INSERT, 0], ["", "II", "I", ""], [0, 2, 1, 0]
_LEGAL = {"su", "ua", "au"}


def slice_paths(codes: np.ndarray, gone: np.ndarray, cut: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Costs (slices, 4, 4) from entry to exit state, ranks of the least audits in order, and those audits.

    ``codes`` are role codes of rows, ``gone`` rows that must be deleted, ``cut`` truncated ones; slices are [start, end) and not empty.
    """
    rows, sizes = len(codes), ends - starts
    cost = np.full((rows, 4, 4), _FAR)
    letter = np.zeros(rows * 16 + 5, np.int64)
    pointer = np.arange(rows * 16 + 5)
    good, dead = rows * 16, rows * 16 + 4
    target = np.arange(4)
    for back in range(1, int(sizes.max()) + 1):
        open_ = sizes >= back
        row = ends[open_] - back
        last = back == 1
        after = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, _FAR), (len(row), 4, 4)) if last else cost[row + 1]

        def reach(state):
            """Node ids that lie behind the row, by entry state."""
            if last:
                return np.broadcast_to(np.where(state[..., None] == target, good + target, dead), (len(row), 4, 4))
            return ((row[:, None] + 1) * 4 + state)[..., None] * 4 + target

        extra = np.where(cut[row], TRUNCATED, 0)[:, None, None] + np.where(gone[row], _FAR, 0)[:, None, None]
        kept = _KEEP[:, codes[row]].T
        same, turned = np.broadcast_to(np.arange(4), (len(row), 4)), np.broadcast_to(_NEXT, (len(row), 4))
        drop = DELETE + after
        keep = np.where((kept >= 0)[..., None], extra + np.take_along_axis(after, np.maximum(kept, 0)[..., None], 1), _FAR)
        role = REROLE + extra + after[:, _NEXT]
        used = np.minimum(np.minimum(drop, keep), role)
        best = used.copy()
        best[:, ASKED] = np.minimum(used[:, ASKED], INSERT + used[:, ANSWERED])
        best[:, ANSWERED] = np.minimum(used[:, ANSWERED], INSERT + used[:, ASKED])
        for state in (START, TOLD):
            best[:, state] = np.minimum(used[:, state], INSERT + best[:, ASKED])
        cost[row] = np.minimum(best, _FAR)
        # Optimal arcs. A letter leaves a node once at most, so the least letter's arc is where the least audit goes on.
        here = (row[:, None] * 4 + np.arange(4))[..., None] * 4 + target
        into = (row[:, None] * 4 + _NEXT)[..., None] * 4 + target
        node, found = np.full(here.shape, dead), np.full(here.shape, ord("Z"))
        for name, way, to in (
            ("R", role, reach(turned)), ("K", keep, reach(np.maximum(kept, 0))), ("I", INSERT + best[:, _NEXT], into), ("D", drop, reach(same)),
        ):
            optimal = (way == best) & (best < _FAR)
            node, found = np.where(optimal, to, node), np.where(optimal, ord(name), found)
        pointer[here], letter[here] = node, found
    letter[dead] = ord("Z")
    heads = ((starts[:, None] * 4 + np.arange(4))[..., None] * 4 + target).reshape(-1)
    path, rank = heads[:, None], letter
    while True:
        path = np.concatenate([path, pointer[path]], axis=1)
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)[1]
        if (pointer[heads] >= good).all():
            break
        pointer = pointer[pointer]
    letters = letter[path].astype(np.uint8)
    letters[path >= good] = 0
    audits = [bytes(line).rstrip(b"\0").decode() for line in letters]
    return cost[starts], rank[heads].reshape(-1, 4, 4), audits


def _by_length(codes, gone, cut, starts, ends):
    """``slice_paths`` of slices of similar length together."""
    size = np.ceil(np.log2(np.maximum(ends - starts, 1))).astype(int)
    costs, ranks = np.zeros((len(starts), 4, 4), np.int64), np.zeros((len(starts), 4, 4), np.int64)
    audits: list[list[str]] = [[] for _ in starts]
    for s in np.unique(size):
        of = np.flatnonzero(size == s)
        lengths = ends[of] - starts[of]
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        take = np.repeat(starts[of] - bounds[:-1], lengths) + np.arange(bounds[-1])
        c, r, a = slice_paths(codes[take], gone[take], cut[take], bounds[:-1], bounds[1:])
        costs[of], ranks[of] = c, r
        for n, i in enumerate(of):
            audits[i] = a[16 * n : 16 * n + 16]
    return costs, ranks, audits


def _summary_schema(conversation: str, turn: str) -> str:
    return (
        f"conv {conversation}, part int, seq long, costs array<long>, ranks array<long>, audits array<string>, first string, last string, "
        f"illegal long, blank long, duplicate long, truncated long, low {turn}, high {turn}, turns long, head {turn}, tail {turn}"
    )


def _summarise(rows: pa.Table, starts: list[int], ends: list[int], part: int, seq: int) -> pa.RecordBatch | dict:
    initials = rows["initial"].to_pylist()
    turns = rows["turn"].to_pylist()
    fault = np.array(rows["fault"].to_pylist())
    codes = np.array([_CODE.get(i, 0) for i in initials])
    first, last = np.array(starts), np.array(ends)
    costs, ranks, audits = _by_length(codes, (fault == "b") | (fault == "d"), fault == "t", first, last)
    out: dict[str, list] = {k: [] for k in (
        "conv", "part", "seq", "costs", "ranks", "audits", "first", "last", "illegal", "blank", "duplicate", "truncated", "low", "high", "turns", "head", "tail",
    )}
    convs = rows["conv"].to_pylist()
    for n, (a, b) in enumerate(zip(starts, ends)):
        known = [t for t in turns[a:b] if t is not None]
        faults = fault[a:b].tolist()
        row = (
            convs[a], part, seq + n, costs[n].reshape(-1).tolist(), ranks[n].reshape(-1).tolist(), audits[n], initials[a], initials[b - 1],
            sum(x + y not in _LEGAL for x, y in zip(initials[a : b - 1], initials[a + 1 : b])),
            faults.count("b"), faults.count("d"), faults.count("t"), min(known, default=None), max(known, default=None), len(set(known)), turns[a], turns[b - 1],
        )
        for k, v in zip(out, row):
            out[k].append(v)
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut sorted rows into slices of one conversation each; equal neighbours after the first are duplicates."""
    part, seq, held, before = TaskContext.get().partitionId(), 0, None, None

    def solve(rows: pa.Table, whole: bool):
        nonlocal seq
        convs = rows["conv"].to_pylist()
        edges = [0, *(i for i in range(1, len(convs)) if convs[i] != convs[i - 1]), len(convs)]
        pieces = [(a, min(a + SLICE_ROWS, end)) for at, end in zip(edges, edges[1:]) for a in range(at, end, SLICE_ROWS)]
        # The last piece may go on in the next batch.
        if not whole and pieces and pieces[-1][1] - pieces[-1][0] < SLICE_ROWS:
            rest = rows.slice(pieces.pop()[0])
        else:
            rest = rows.slice(len(convs))
        if not pieces:
            return None, rest
        out = _summarise(rows, [a for a, _ in pieces], [b for _, b in pieces], part, seq)
        seq += len(pieces)
        types = {
            "conv": rows.schema.field("conv").type, **{k: rows.schema.field("turn").type for k in ("low", "high", "head", "tail")}, "part": pa.int32(),
            "costs": pa.list_(pa.int64()), "ranks": pa.list_(pa.int64()), "audits": pa.list_(pa.string()), "first": pa.string(), "last": pa.string(),
        }
        return pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.int64())) for k, v in out.items()], list(out)), rest

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in ("conv", "turn", "id"))))
        fault = batch.column(batch.schema.get_field_index("fault")).to_pylist()
        for n, key in enumerate(keys):
            if key == before and fault[n] != "b":
                fault[n] = "d"
            before = key
        rows = pa.table({k: batch.column(batch.schema.get_field_index(k)) for k in ("conv", "turn", "initial")} | {"fault": pa.array(fault, pa.string())})
        held = rows if held is None else pa.concat_tables([held, rows])
        if held.num_rows >= GATHER_ROWS:
            out, held = solve(held.combine_chunks(), whole=False)
            if out is not None:
                yield out
    if held is not None and held.num_rows:
        yield solve(held.combine_chunks(), whole=True)[0]


def _chain(slices: list[dict]) -> tuple:
    """Report of one conversation from its slices in order."""
    cost, rank, choice = list(END_COST), list(END_RANK), []
    for s in reversed(slices):
        picked, found = [], []
        for state in range(4):
            ways = [(s["costs"][4 * state + t] + cost[t], s["ranks"][4 * state + t], rank[t], t) for t in range(4)]
            found.append(min(ways))
            picked.append(found[-1][3])
        order = {key: n for n, key in enumerate(sorted({w[1:3] for w in found}))}
        cost, rank = [w[0] for w in found], [order[w[1:3]] for w in found]
        choice.append(picked)
    state, audit = START, []
    for s, picked in zip(slices, reversed(choice)):
        audit.append(s["audits"][4 * state + picked[state]])
        state = picked[state]
    audit.append(END_AUDIT[state])
    meets = list(zip(slices, slices[1:]))
    illegal = sum(s["illegal"] for s in slices) + sum(a["last"] + b["first"] not in _LEGAL for a, b in meets)
    turns = sum(s["turns"] for s in slices) - sum(a["tail"] is not None and a["tail"] == b["head"] for a, b in meets)
    lows, highs = [s["low"] for s in slices if s["low"] is not None], [s["high"] for s in slices if s["high"] is not None]
    gaps = max(highs) - min(lows) + 1 - turns if lows else 0
    return (gaps, *(sum(s[k] for s in slices) for k in ("blank", "duplicate", "truncated")), illegal, cost[START], "".join(audit))


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run: list[dict] = []
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if run and run[0]["conv"] != row["conv"]:
                done.append((run[0]["conv"], *_chain(run)))
                run = []
            run.append(row)
        kind = batch.schema.field("conv").type
        if done:
            yield _reports(done, kind)
    if run:
        yield _reports([(run[0]["conv"], *_chain(run))], kind)


def _reports(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:-1]), pa.array(columns[-1], pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["conv", *_REPORT, "audit"])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows from sorted records: a conversation's audit, then its rows."""
    conv, audit, at, state, place = None, "", 0, START, 0
    out: list[tuple] = []

    def inserts():
        nonlocal at, state, place
        while at < len(audit) and audit[at] == "I":
            state = int(_NEXT[state])
            out.append((conv, place, _ROLE[state], ""))
            at, place = at + 1, place + 1

    for batch in batches:
        kind = batch.schema.field("conv").type
        for row in batch.to_pylist():
            if row["audit"] is not None:
                inserts()
                conv, audit, at, state, place = row["conv"], row["audit"], 0, START, 0
                continue
            inserts()
            letter, at = audit[at], at + 1
            if letter == "D":
                continue
            if letter == "R":
                state = int(_NEXT[state])
                role = _ROLE[state]
            else:
                role = row["role"]
                state = int(_KEEP[state, _CODE[role[0]]])
            out.append((conv, place, role, row["text"]))
            place += 1
        if out:
            yield _turns(out, kind)
            out = []
    inserts()
    if out:
        yield _turns(out, kind)


def _turns(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(columns[0], kind), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["conv", "place", "role", "text"])


@dataclass
class Repaired:
    """``report``: one row per conversation (conv, gaps, blank, duplicate, truncated, illegal, cost, audit); ``turns``: its repaired rows."""

    report: DataFrame
    turns: DataFrame


def _ordered(turn: Column) -> list[Column]:
    return [turn.isNotNull(), turn]


def repair(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """Report and repair every conversation; turn numbers are integers.

    Rows are taken by turn, null turns first; rows of one turn by the SHA-256 of role and text. Null roles and texts are empty;
    rows with a null conversation form one. A row's first fault counts: blank, duplicate (role and text seen earlier, repeated rows
    too), truncated. ``turns`` holds (conv, place, role, text), each conversation in order within one partition, so that it can be
    hashed in one pass; a conversation whose rows are all deleted has none. Texts are shuffled once. An empty table gives empty
    results. Only the four named columns are read, whatever others there are.
    """
    said = F.coalesce(F.col(text), F.lit(""))
    named = turns.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), said.alias("text"))
    named = named.withColumn("id", F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    ending = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(ending == "", "b").when(~F.right(ending, F.lit(1)).isin(".", "!", "?"), "t").otherwise("")
    narrow = stored(named.select("conv", "turn", "id", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")))
    # Duplicates at a later turn; those at the same turn are neighbours once sorted.
    position = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = narrow.filter("fault <> 'b'").groupBy("conv", "id").agg(F.min(position).alias("least"), F.max(position).alias("most"))
    firsts = firsts.filter("least <> most").select(F.col("conv").alias("c"), F.col("id").alias("i"), "least")
    joined = narrow.join(firsts, narrow["conv"].eqNullSafe(firsts["c"]) & (narrow["id"] == firsts["i"]), "left")
    later = (F.col("fault") != "b") & F.col("least").isNotNull() & (position > F.col("least"))
    judged = joined.select("conv", "turn", "id", "initial", F.when(later, "d").otherwise(F.col("fault")).alias("fault"))
    order = ["conv", *_ordered(F.col("turn")), "id"]
    kinds = [named.schema[c].dataType.simpleString() for c in ("conv", "turn")]
    sliced = judged.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_slices, _summary_schema(*kinds))
    chained = sliced.repartition("conv").sortWithinPartitions("conv", "part", "seq")
    longs = ", ".join(f"{c} long" for c in _REPORT)
    report = stored(chained.mapInArrow(_chained, f"conv {kinds[0]}, {longs}, audit string"))
    audits = report.select("conv", "audit", F.lit(None).cast(kinds[1]).alias("turn"), F.lit(None).cast("binary").alias("id"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    rows = named.select("conv", F.lit(None).cast("string").alias("audit"), "turn", "id", "role", "text")
    merged = audits.union(rows).repartition("conv").sortWithinPartitions("conv", F.col("audit").isNull(), *_ordered(F.col("turn")), "id")
    repaired = merged.select("conv", "audit", "role", "text").mapInArrow(_apply, f"conv {kinds[0]}, place long, role string, text string")
    return Repaired(report, repaired)


def digests(turns: DataFrame) -> DataFrame:
    """(conv, digest): SHA-256 of each conversation's ``role:text`` lines, in one pass over ``Repaired.turns`` as it comes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, hashed = None, None
        for batch in batches:
            done = []
            kind = batch.schema.field("conv").type
            for row in batch.to_pylist():
                if row["place"] == 0:
                    if hashed is not None:
                        done.append((conv, hashed.hexdigest()))
                    conv, hashed = row["conv"], hashlib.sha256()
                else:
                    hashed.update(b"\n")
                hashed.update(f"{row['role']}:{row['text']}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kind), pa.array([h for _, h in done])], ["conv", "digest"])
        if hashed is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([hashed.hexdigest()])], ["conv", "digest"])

    return turns.mapInArrow(run, f"conv {turns.schema['conv'].dataType.simpleString()}, digest string")
