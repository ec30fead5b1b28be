"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content. The ledger, a Parquet folder on shared
storage, holds the findings of each (blob, rule version) pair ever scanned, also when there are none. A scan takes the
blobs and rules that the ledger does not have yet, scans each blob once however many paths hold it, appends,
and joins the findings back to all paths. Blobs are de-duplicated map-side before they are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FINDINGS = "array<struct<kind:string,start:bigint,end:bigint>>"
PIECES = "array<struct<gap:bigint,size:bigint,judged:bigint>>"
# Characters of the blocks that a text is cut into before it is redacted.
BLOCK = 4096
LEDGER = f"blob binary, rule string, found {FINDINGS}"


@dataclass(frozen=True)
class Rule:
    """A pattern whose ``group`` must have ``least`` characters or the match is dropped.

    ``hint`` is found in every text that has a kept match. ``version`` names the rule's present wording;
    changing it makes every blob unseen for that rule alone.
    """

    kind: str
    pattern: str
    group: int
    least: int
    hint: str | None = None
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key")))
# The three base kinds, in the order that spans at one place are listed, and two more kinds.
BASE = (
    Rule("assign", rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, hint=r"AKIA[A-Z0-9]{12}"),
    Rule("hex", r"[0-9a-f]+", 0, 32, hint=r"[0-9a-f]{32}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    Rule("bearer", r"(gh[pousr]_)([A-Za-z0-9]+)", 2, 36),
)
RULES = BASE + MORE


def pieces(text: Column, rule: Rule) -> Column:
    """The text as an array of (gap, size, judged): characters before a match, of the match, and of its judged group.

    What lies between matches comes from splitting, what matches from extracting. The last piece is the rest after all matches
    and has null sizes; a text without a kept match may have no pieces.
    """
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda s: F.char_length(s).cast("bigint"))
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = whole if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    sizes = F.arrays_zip(
        gaps.alias("gap"), F.transform(whole, lambda s: F.char_length(s).cast("bigint")).alias("size"),
        F.transform(judged, lambda s: F.char_length(s).cast("bigint")).alias("judged"),
    )
    return F.when(text.rlike(rule.hint or rule.pattern), sizes).otherwise(F.array().cast(PIECES))


def scanned(unseen: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows for the rules that each blob of ``unseen (blob, content, todo)`` still needs, also for no finding.

    Places are running sums over a text's pieces, one row a piece, so a text's cost is in proportion to its findings. ``unseen`` is
    partitioned by blob already, which the windows and the collecting go on using: texts and pieces are not shuffled again.
    """
    parts = [
        F.when(F.array_contains("todo", r.name), F.struct(F.lit(r.name).alias("rule"), pieces(F.col("content"), r).alias("pieces"))) for r in rules
    ]
    rows = unseen.select("blob", F.inline(F.array_compact(F.array(*parts))))
    rows = rows.select("blob", "rule", F.posexplode_outer("pieces").alias("n", "piece")).select("blob", "rule", "n", "piece.*")
    end = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(Window.partitionBy("blob", "rule").orderBy("n"))
    rows = rows.withColumn("end", end)
    kind = F.element_at(F.create_map(*(F.lit(x) for r in rules for x in (r.name, r.kind))), F.col("rule"))
    least = F.element_at(F.create_map(*(F.lit(x) for r in rules for x in (r.name, r.least))), F.col("rule"))
    span = F.struct(kind.alias("kind"), (F.col("end") - F.col("size")).alias("start"), F.col("end").alias("end"))
    kept = F.collect_list(F.when(F.col("judged") >= least, span))
    return rows.groupBy("blob", "rule").agg(kept.cast(FINDINGS).alias("found"))


def read_ledger(spark: SparkSession, folder: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(LEDGER).parquet(folder)


def scan_versions(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Append to ``ledger`` what it lacks for the texts of ``versions`` and return its blobs and findings.

    ``versions`` has one row per stored version of a path, present and past. Null text is the empty blob. The
    result has one row per blob of the ledger: ``blob`` and ``found``, sorted by start, then by order of the rules,
    for the given rules only. A retried run scans what the failed one did not finish writing.
    """
    spark = versions.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    blobs = versions.select(F.unhex(F.sha2(content, 256)).alias("blob"), content.alias("content"))
    known = read_ledger(spark, ledger)
    if known is None:
        unseen = blobs.dropDuplicates(["blob"]).withColumn("todo", F.array(*(F.lit(r.name) for r in rules)))
    else:
        seen = known.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = F.array_except(F.array(*(F.lit(r.name) for r in rules)), F.coalesce("seen", F.array().cast("array<string>")))
        unseen = blobs.dropDuplicates(["blob"]).join(seen, "blob", "left").withColumn("todo", todo).filter(F.size("todo") > 0)
    scanned(unseen, rules).write.mode("append").parquet(ledger)
    order = F.create_map(*(x for n, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(n))))
    ranked = F.transform("found", lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("place"), s["kind"].alias("kind"), s["end"].alias("end")))
    gathered = spark.read.schema(LEDGER).parquet(ledger).filter(F.col("rule").isin([r.name for r in rules]))
    merged = gathered.groupBy("blob", "rule").agg(F.first("found").alias("found")).groupBy("blob").agg(F.flatten(F.collect_list(ranked)).alias("found"))
    plain = F.transform(F.array_sort("found"), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return merged.select("blob", plain.alias("found"))


def _with_blobs(docs: DataFrame, blobs: DataFrame, text: str) -> DataFrame:
    """``docs`` left-joined by the address of its text with ``blobs``, whose address is ``__blob``."""
    address = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    return docs.withColumn("__blob", address).join(blobs, "__blob", "left")


def find_secrets(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``__found``, the findings of the row's text.

    Repeated rows and copies all get the findings of their blob; an empty table gives an empty result. Columns that begin with two
    underscores are the operator's own: ``docs`` must not have ``__blob`` or ``__found``.
    """
    found = scan_versions(docs, ledger, rules, text).withColumnsRenamed({"blob": "__blob", "found": "__found"}).filter(F.size("__found") > 0)
    joined = _with_blobs(docs, found, text)
    return joined.withColumn("__found", F.coalesce("__found", F.array().cast(FINDINGS))).select(*docs.columns, "__found")


def joined_spans(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def clear_runs(blobs: DataFrame) -> DataFrame:
    """``__blob``, ``__clear`` and ``__rest`` of the blobs with findings: what stays of a text, as places between marks.

    ``__clear`` holds (from, to) before each mark, ``__rest`` is the place after the last. A span that begins before the furthest
    end so far belongs to the mark before it.
    """
    spans = blobs.select(F.col("blob").alias("__blob"), F.posexplode("found").alias("n", "span")).select("__blob", "n", "span.start", "span.end")
    before = Window.partitionBy("__blob").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("from", F.coalesce(F.max("end").over(before), F.lit(0).cast("bigint")))
    run = F.when(F.col("start") >= F.col("from"), F.struct("from", F.col("start").alias("to")))
    return spans.groupBy("__blob").agg(F.sort_array(F.collect_list(run)).alias("__clear"), F.max("end").alias("__rest"))


def redacted(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """The documents with every found span replaced by ``mark`` and ``n_chars``, if there, counted anew.

    Overlapping spans are replaced together. No row is dropped and a null text stays null. Texts are cut into blocks once, so that
    a place in a long text is found without walking there from its start. Columns named ``__blob``, ``__clear``, ``__rest`` or
    ``__blocks`` clash.
    """
    hit = F.col("__rest").isNotNull() & F.col("text").isNotNull()
    found = _with_blobs(docs, clear_runs(scan_versions(docs, ledger, rules)), "text")
    found = found.withColumn("__blocks", F.when(hit, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))

    def between(start: Column, end: Column) -> Column:
        first = F.floor(start / BLOCK).cast("int")
        blocks = F.slice("__blocks", first + 1, F.floor(end / BLOCK).cast("int") - first + 1)
        return F.substr(F.array_join(blocks, ""), (start - first * BLOCK + 1).cast("int"), (end - start).cast("int"))

    pieces = F.transform("__clear", lambda s: between(s["from"], s["to"]))
    first = F.floor(F.col("__rest") / BLOCK).cast("int")
    tail = F.array_join(F.slice("__blocks", first + 1, F.size("__blocks") + 1), "")
    rest = F.substr(tail, (F.col("__rest") - first * BLOCK + 1).cast("int"))
    clean = found.withColumn("text", F.when(hit, F.array_join(F.concat(pieces, F.array(rest)), mark)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(hit, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)
