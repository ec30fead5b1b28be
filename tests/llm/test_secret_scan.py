"""Secret scans against Python's regular expressions, and the ledger's bookkeeping."""

import re
import time
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from tidewatch.llm import secret_scan
from tidewatch.llm.secret_scan import RULES, find_secrets, redacted, scan_versions

HEX = "0123456789abcdef" * 2
TEXTS = [
    None, "", "no secrets", f"é😀 x {HEX} y {HEX}f", "AKIA" + "A1" * 6, "AKIA" + "A" * 11, "AKIAAKIA" + "B" * 12,
    "password = 'abcdefgh'", "SECRET: token: abcdefgh1", "api_key=short apikey=\"longenough1\"", "ſecret=abcdefgh12", f"token={HEX}",
    "-----BEGIN RSA PRIVATE KEY-----\nxx", "ghp_" + "a" * 36 + " gho_" + "b" * 35, "pass word token : \"x=y/z+1.2_3-4\" " * 3000,
    "a" * 200000, ("Passwd:" + "q" * 9 + "\n") * 40, f"{HEX}{HEX}",
]


def brute(text, rules=RULES):
    spans = []
    for place, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m.group(rule.group)) >= rule.least:
                spans.append((m.start(), place, rule.kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(spans)]


def ledger_at(tmp_path):
    return f"file://{tmp_path}/{uuid.uuid4().hex}"


def test_spans_as_brute_force_with_copies_and_nulls(spark, tmp_path):
    rows = [(n, t, "x") for n, t in enumerate(TEXTS * 2)] + [(None, TEXTS[3], None), (0, None, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string")
    got = find_secrets(docs, ledger_at(tmp_path))
    assert got.columns == ["doc_id", "text", "found", "__found"]
    out = got.collect()
    assert len(out) == len(rows)
    for r in out:
        assert [tuple(s) for s in r["__found"]] == brute(r["text"]), r["text"][:60]


def test_only_unseen_blobs_and_rules_are_scanned(spark, tmp_path, monkeypatch):
    ledger = ledger_at(tmp_path)
    first = spark.createDataFrame([("a", 1, TEXTS[3]), ("b", 1, TEXTS[3]), ("a", 2, TEXTS[7])], "path string, version int, text string")
    scan_versions(first, ledger, RULES[:2])
    read = lambda: spark.read.schema(secret_scan.LEDGER).parquet(ledger)
    assert read().count() == 4
    second = first.union(spark.createDataFrame([("c", 1, TEXTS[4])], first.schema))
    scan_versions(second, ledger, RULES[:2])
    assert read().count() == 6
    scan_versions(second, ledger, RULES[:2])
    assert read().count() == 6
    found = scan_versions(second, ledger, RULES[:3])
    assert read().count() == 9 and read().distinct().count() == 9
    assert found.count() == 3
    changed = (replace(RULES[0], version=2), *RULES[1:3])
    scan_versions(second, ledger, changed)
    assert read().count() == 12
    texts = {bytes.fromhex(__import__("hashlib").sha256(t.encode()).hexdigest()): t for t in (TEXTS[3], TEXTS[4], TEXTS[7])}
    for r in scan_versions(second, ledger, RULES[:3]).collect():
        assert [tuple(s) for s in r["found"]] == brute(texts[bytes(r["blob"])], RULES[:3])


def test_redaction(spark, tmp_path):
    docs = spark.createDataFrame([(1, f"é {HEX} é token={HEX}!", 5), (2, None, None), (3, "clean", 9)], "doc_id long, text string, n_chars int")
    out = {r.doc_id: r for r in redacted(docs, ledger_at(tmp_path)).collect()}
    assert out[1].text == "é [secret] é [secret]!" and out[1].n_chars == len(out[1].text)
    assert out[2].text is None and out[2].n_chars is None and out[3].text == "clean" and out[3].n_chars == 9


def test_cost_grows_with_findings_not_their_square(spark, tmp_path):
    """A text of 100,000 digests would take minutes if each finding copied the ones before it."""
    digests = [f"{n:032x}" for n in range(100_000)]
    text = "é\n".join(digests)
    docs = spark.createDataFrame([(1, text), (2, "a short one")], "doc_id long, text string")
    start = time.monotonic()
    found = find_secrets(docs, ledger_at(tmp_path)).filter("doc_id = 1").first()["__found"]
    assert [tuple(s) for s in found] == [("hex", 34 * n, 34 * n + 32) for n in range(len(digests))]
    out = {r.doc_id: r.text for r in redacted(docs, ledger_at(tmp_path)).collect()}
    assert out[1] == "é\n".join(["[secret]"] * len(digests)) and out[2] == "a short one"
    assert time.monotonic() - start < 60


def test_redaction_as_brute_force(spark, tmp_path):
    rows = [(n, t) for n, t in enumerate(TEXTS)] + [(99, ("é" * 4095 + HEX) * 3 + "x" * 5000 + "token=" + HEX + "/abc" + "😀" * 9000)]
    out = {r.doc_id: r.text for r in redacted(spark.createDataFrame(rows, "doc_id long, text string"), ledger_at(tmp_path)).collect()}
    for n, text in rows:
        at, expected = 0, ""
        for _, start, end in brute(text):
            expected += "" if start < at else text[at:start] + "[secret]"
            at = max(at, end)
        assert out[n] == (None if text is None else expected + text[at:]), n


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert find_secrets(docs, ledger_at(tmp_path)).count() == 0


def test_native_plan(spark, tmp_path):
    docs = spark.createDataFrame([(1, TEXTS[3])], "doc_id long, text string")
    plan = find_secrets(docs, ledger_at(tmp_path)).select(F.size("__found"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
