"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.decontaminate import decontaminate

    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate(docs, read_table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"), F.col("__n_items").alias("n_items"),
        F.col("__items_sha256").alias("items_sha256"), (F.col("__n_hit") > 0).alias("contaminated"),
    )


ORACLE["op1_decontaminate"] = r"""
with d as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (
    select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as phrase
    from (select item_id, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from b where len(w) > 0)),
dw as (
    select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as phrase
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from bw) where len(w) >= n)),
hits as (select doc_id, item_id, i, dw.n from dw join bw using (n, phrase)),
covered as (select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(i, i + n)) as word from hits) group by doc_id),
found as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join found using (doc_id)
"""


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.simhash import near_duplicates

    return near_duplicates(read_table(spark, folder, "documents"))


@query
def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.secret_scan import BASE, find_secrets, joined_spans
    from tidewatch.session import scratch_folder

    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    kinds = [r.kind for r in BASE]
    found = find_secrets(docs, scratch_folder(spark))

    def of(*names: str):
        return F.filter("__found", lambda s: s["kind"].isin(*names))

    base = joined_spans(of(*kinds))
    counts = [F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), joined_spans(F.col("__found")).alias("spans"))


def _secrets_sql() -> str:
    from tidewatch.llm.secret_scan import RULES

    parts = []
    for n, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(
            f"""select doc_id, {n} as place, '{r.kind}' as kind, length(whole) as size, length(judged) >= {r.least} as kept,
                       gaps + coalesce(before, 0) as start from (
                select doc_id, whole, judged, sum(length(gap)) over (partition by doc_id order by i) as gaps,
                       sum(length(whole)) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding) as before
                from (select doc_id, generate_subscripts(w, 1) as i, unnest(w) as whole, unnest(j) as judged, unnest(g[:len(w)]) as gap from (
                    select doc_id, regexp_extract_all(t, '{pattern}', 0) as w, regexp_extract_all(t, '{pattern}', {r.group}) as j,
                           string_split_regex(t, '{pattern}') as g from d)))"""
        )
    return f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
m as ({' union all '.join(parts)}),
s as (select doc_id, place, kind, start, kind || ':' || cast(start as bigint) || ':' || cast(start + size as bigint) as span from m where kept),
g as (
    select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
           string_agg(span, ',' order by start, place) filter (place < 3) as base, string_agg(span, ',' order by start, place) as spans
    from s group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join g using (doc_id)
"""


ORACLE["op4_secrets"] = _secrets_sql()


@query
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.mixing import words_taken

    return words_taken(read_table(spark, folder, "documents"))


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.rule_quality import THRESHOLD, fit, held_out, score

    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, read_table(spark, folder, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.suffix_dedup import remove_repeats

    found = remove_repeats(read_table(spark, folder, "documents"))
    lost = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", lost.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


# A conversation whose texts hold what looks like control strings.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


@query
def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.chat import format_chats, read_loss, read_turns

    turns = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    chats = format_chats(turns.unionByName(extra))
    read = chats.select("conv_id", "valid", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("segments")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"), "valid",
    )


ORACLE["op9_chat"] = r"""
with t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
    select *, length(replace(replace(replace(role, '\', '\b'), '<|', '\o'), '|>' || chr(10), '\c'))
              + length(replace(replace(replace(text, '\', '\b'), '<|', '\o'), '|>' || chr(10), '\c'))
              + case when role = 'end' then 15 else 13 end as chars,
           lag(role) over (partition by conv_id order by turn nulls first, role, text) as before,
           lead(role) over (partition by conv_id order by turn nulls first, role, text) as after,
           row_number() over (partition by conv_id order by turn nulls first, role, text) as n from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       cast(length(coalesce(string_agg(text, '') filter (role = 'assistant'), '')) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(chars) as bigint) as formatted_chars,
       bool_and(case when n = 1 then role in ('system', 'user') when role = 'user' then before in ('system', 'assistant')
                     when role = 'assistant' then before = 'user' else false end
                and (after is not null or role = 'assistant')) as valid
from e group by conv_id
"""


@query
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.warc import read_records, write_archives
    from tidewatch.session import scratch_folder

    index = write_archives(read_table(spark, folder, "pages"), scratch_folder(spark))
    return read_records(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op5_warc"] = """
with p as (select page_id, coalesce(html, '') as html from pages),
f as (select page_id, html, sha1(html) as h, min(page_id) over (partition by html) as first from p)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           cast((cast('0x' || substr(h, cast(i // 8 * 10 + 1 as bigint), 10) as bigint) >> cast(35 - 5 * (i % 8) as bigint)) & 31 as bigint) + 1, 1)), '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to
from f
"""


@query
def op6_hilbert_ann(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.hilbert_ann import nearest

    return nearest(read_table(spark, folder, "embeddings"), is_query=F.col("id") % 20 == 0)


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.toxicity import THRESHOLD, fit, held_out, score

    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, read_table(spark, folder, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with rows dropped, emptied, cut, repeated and given to the user by a checksum of conversation and turn."""
    space = F.lit(" ")
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(named) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.filter("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies)).drop("col")


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.conversation_repair import digests, repair

    turns = read_table(spark, folder, "conversations")
    found = repair(damaged(turns))
    hashed = digests(found.turns).select(F.col("conv").alias("hashed"), "digest")
    told = found.report.join(hashed, F.col("conv").eqNullSafe(F.col("hashed")), "left")
    told = turns.select("conv_id").distinct().join(told, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return told.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", empty).alias("repaired_sha256"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def worn_words(docs: DataFrame) -> DataFrame:
    """Runs of letters of all texts in lower case, some of them with a letter missing by a checksum of document and run."""
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(r"[a-zÀ-ÿ]+"), F.lit(0))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    rows = docs.select(named.alias("named"), F.explode(runs).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("named", "run")))
    place = (F.col("h") % F.char_length("run")).cast("int")
    worn = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    return rows.select(F.when(F.col("h") % 97 == 0, worn).otherwise(F.col("run")).alias("word"))


@query
def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.spelling import variants

    return variants(worn_words(read_table(spark, folder, "documents")))


@query
def op12_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.jaccard_join import join

    return join(read_table(spark, folder, "documents"))
