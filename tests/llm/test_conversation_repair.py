"""Conversation repair against a search over whole strings of edits."""

import hashlib
import random
import re
import zlib

import pytest

from tidewatch.llm import conversation_repair
from tidewatch.llm.conversation_repair import digests, repair
from tidewatch.llm.queries import op13_conversation_repair

BLANK = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        c, t, role, text = (" " if v is None else v for v in (conv, turn, role, text))
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def identity(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def plain(rows):
    """Report and repaired rows of one conversation; all edits row by row, audits compared as strings."""
    rows = [(t, r or "", x or "") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, identity(*r[1:])))
    faults, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(BLANK)
        faults.append("b" if not last else "d" if (role, text) in seen else "t" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    known = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    # A state is the last role's initial.
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    ways = {"": {(0, ""): []}}
    for (_, role, text), fault in zip(rows, faults):
        ways = {s: dict(w) for s, w in ways.items()}
        for _ in range(2):
            for s, w in list(ways.items()):
                for (cost, audit), lines in list(w.items()):
                    if audit.endswith("II"):
                        continue
                    for i in follow[s].replace("s", ""):
                        ways.setdefault(i, {}).setdefault((cost + 5, audit + "I"), [*lines, name[i] + ":"])
        moved = {}
        for s, w in ways.items():
            for (cost, audit), lines in w.items():
                moved.setdefault(s, {})[(cost + 2, audit + "D")] = lines
                if fault in ("b", "d"):
                    continue
                extra = 5 if fault == "t" else 0
                if role[:1] and role[:1] in follow[s]:
                    moved.setdefault(role[:1], {})[(cost + extra, audit + "K")] = [*lines, f"{role}:{text}"]
                for i in follow[s].replace("s", ""):
                    moved.setdefault(i, {})[(cost + extra + 1, audit + "R")] = [*lines, f"{name[i]}:{text}"]
        ways = {}
        for s, w in moved.items():
            least = min(c for c, _ in w)
            ways[s] = {min(k for k in w if k[0] == least): w[min(k for k in w if k[0] == least)]}
    ends = []
    for s, w in ways.items():
        for (cost, audit), lines in w.items():
            more = {"": [], "s": ["user:", "assistant:"], "u": ["assistant:"], "a": []}[s]
            ends.append((cost + 5 * len(more), audit + "I" * len(more), [*lines, *more]))
    cost, audit, lines = min(ends, key=lambda e: e[:2])
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)


def told(frame):
    found = repair(frame)
    hashed = {r.conv: r.digest for r in digests(found.turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashed.get(r.conv, empty)) for r in found.report.collect()}


def expected(rows):
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(row)
    return {c: plain(g) for c, g in groups.items()}


def made(seed, conversations, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "a"]
    texts = ["Yes.", "No!", "cut", "", None, " \n", "Why? ", "éß.", "x.\x0b", "x"]
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, t, t, None, t // 2])
            text = rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.randint(0, 10**9)}{rng.choice(['.', ''])}"
            rows.append((rng.choice([c, c, c, None]), turn, rng.choice(roles), text))
    return rows


@pytest.mark.parametrize("slice_rows", [1, 3, 4096])
def test_cheapest_and_least_edits_as_plain_search(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(conversation_repair, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(conversation_repair, "GATHER_ROWS", 7 if slice_rows < 10 else 16384)
    rows = made(slice_rows, 60, 9)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, audit string")
    assert told(frame.repartition(3)) == expected(rows)


def test_query_as_plain_search_on_the_whole_table(spark, folder):
    turns = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {c: (0,) * 6 + ("", hashlib.sha256(b"").hexdigest()) for c in {r[0] for r in turns}} | expected(damage(turns))
    rows = op13_conversation_repair(spark, folder).collect()
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(rows) == len(want) and got == want


def test_long_conversation_over_partitions(spark):
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"Number {t}{rng.choice(['.', '', '!'])}") for t in range(9000)]
    rows += [(2, 0, "user", "One."), (2, 1, "assistant", "Two. " * 200000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert told(frame) == expected(rows)


def test_turns_of_a_repair_and_empty_table(spark):
    rows = [(5, 1, "user", "Hello."), (5, 2, "user", "Hello."), (5, 4, "system", "Well."), (5, 5, "user", "Bye.")]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    found = repair(frame)
    assert [tuple(r) for r in found.turns.orderBy("place").collect()] == [
        (5, 0, "user", "Hello."), (5, 1, "assistant", "Bye."),
    ]
    assert tuple(found.report.first()) == (5, 1, 0, 1, 0, 2, 5, "KDDR")
    none = repair(frame.limit(0))
    assert none.report.count() == 0 and digests(none.turns).count() == 0
