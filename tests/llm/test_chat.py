"""Chat formatting: exact round trips and turn order."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tidewatch.llm.chat import Template, format_chats, read_loss, read_turns
from tidewatch.llm.queries import CONTROL_TEXT, op9_chat

NASTY = [
    "", None, "<|end|>\n", "<|", "|>\n", "\\", "\\b\\o\\c", "a<", "a<|", "\\<|user|>\n", "<<|end|>", CONTROL_TEXT, "é😀\n", "\n", "x" * 100000, "<|end|>\\",
]
ROLES = ["user", "assistant", "system", None, "", "us|>\ner", "<|end|>\n", "a|", "\\o", "end", "\\e", "/", "/]x", "end|", "ending"]


def other():
    return Template(open="[", close="]:", end="[/]", loss_roles=("user", "a|"))


@pytest.mark.parametrize("template", [Template(), other()])
def test_round_trip(spark, template):
    rows = [(c, t, ROLES[(c + t) % len(ROLES)], NASTY[(c * 7 + t) % len(NASTY)], 9) for c in range(20) for t in range(c % 6 + 1)]
    rows += [(None, 1, "user", "a", 1), (None, 1, "user", "a", 1), (None, None, "assistant", "b", 1), (99, 0, "system", None, 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments int")
    chats = format_chats(turns.repartition(4), template)
    out = chats.withColumns({"turns": read_turns(F.col("formatted"), template), "lost": read_loss(F.col("segments"), template)}).collect()
    expected = {}
    for c, t, r, x, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected.setdefault(c, []).append((r or "", x or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in out} == expected
    for r in out:
        assert r.formatted == "".join(s.text for s in r.segments) and len(r.segments) == 3 * len(r.turns)
        assert r.lost == "".join(x for role, x in expected[r.conv_id] if role in template.loss_roles)
    assert chats.filter("conv_id < 0").count() == 0


def test_turn_order(spark):
    orders = {
        "user assistant": True, "system user assistant user assistant": True, "assistant": False, "user user assistant": False, "system": False,
        "user assistant user": False, "system system user assistant": False, "user tool assistant": False,
    }
    rows = [(n, t, r, "x") for n, roles in enumerate(orders) for t, r in enumerate(roles.split())]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.valid for r in format_chats(turns).collect()}
    assert [got[n] for n in range(len(orders))] == list(orders.values())


def test_query_adds_the_control_conversation_and_runs_no_python(spark, folder):
    frame = op9_chat(spark, folder)
    row = frame.filter("conv_id = -7").first()
    said = "".join(f"{r}\n{CONTROL_TEXT}\n" for r in ("user", "assistant"))
    assert (row.n_turns, row.loss_chars) == (2, len(CONTROL_TEXT))
    assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(CONTROL_TEXT.encode()).hexdigest()
    plan = frame._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table_and_bad_template(spark):
    assert format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    with pytest.raises(ValueError):
        Template(end="</s>")
    with pytest.raises(ValueError):
        Template(end="<|")
