"""Queries over batching, profiles, typing, quality and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import coerce
from tidewatch.operators import clean, profile, quality
from tidewatch.queries import sql
from tidewatch.queries.registry import query, r6, rounded
from tidewatch.roles import Cleaning, Roles
from tidewatch.sources import batching, files
from tidewatch.sources.tables import BATCH_ROWS, FIXTURE, events, policies, table

CATEGORIES = ("insr_type", "usage", "make", "prod_year", "sex")
METRICS = list(sql.METRICS)


def _two_sources(spark: SparkSession, folder: str) -> DataFrame:
    parts = []
    for name, key in (("events", "event_id"), ("orders", "o_orderkey")):
        placed = batching.with_file_position(table(spark, folder, name).select(F.col(key).alias("key")))
        parts.append(batching.index_rows(placed.withColumn("source", F.lit(name))))
    return batching.cut_batches(parts[0].unionByName(parts[1]), BATCH_ROWS, ["events", "orders"])


TWO_SOURCES = """u AS (SELECT 'events' AS source, 1 AS pos, event_id AS key, event_id AS idx FROM events UNION ALL SELECT 'orders', 2, o_orderkey, o_orderkey FROM orders),
t AS (SELECT source, pos, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS total_batches FROM u GROUP BY 1, 2),
o AS (SELECT *, CAST(coalesce(sum(total_batches) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM t)"""


@query(
    "batch_slices",
    f"""WITH {TWO_SOURCES} SELECT source, before + idx // 1000 + 1 AS batch_num, idx // 1000 + 1 AS batch_index, total_batches,
    min(idx) AS start_row, max(idx) + 1 AS end_row FROM u JOIN o USING (source) GROUP BY 1, 2, 3, 4""",
)
def batch_slices(spark: SparkSession, folder: str) -> DataFrame:
    return batching.batch_info(_two_sources(spark, folder), BATCH_ROWS, ["events", "orders"])


@query("batch_rows", f"WITH {TWO_SOURCES} SELECT source, key, before + idx // 1000 + 1 AS batch_num, idx AS row_index FROM u JOIN o USING (source)")
def batch_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _two_sources(spark, folder).select("source", "key", "batch_num", "row_index")


@query(
    "row_index",
    """SELECT o_orderkey, o_orderstatus AS source, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) - 1 AS row_index
    FROM orders""",
)
def row_index(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderstatus").alias("source"))
    return batching.index_by_order(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "source", "row_index")


@query("storage_volume")
def storage_volume(spark: SparkSession, folder: str) -> DataFrame:
    return files.storage_volume(spark, folder, "*.parquet")


EVENT_ROLES = Roles(batch="batch_num")


@query(
    "batch_profile",
    f"""WITH {sql.POLICIES} SELECT batch_num, count(*) AS total_rows, 13 AS columns_count,
    round(1 - ({sql.NULL_CELLS})::DOUBLE / (count(*) * 13), 6) AS data_quality FROM policies GROUP BY 1""",
)
def batch_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.batch_profile(policies(spark, folder), FIXTURE), "data_quality")


def _profile_sql() -> str:
    parts = []
    for i, c in enumerate(sql.COLUMNS):
        number = c in sql.NUMBERS
        stats = ", ".join(f"CAST({f}({c}) AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)" for f in ("min", "max", "avg"))
        kind = "numeric" if number else "categorical"
        parts.append(
            f"SELECT batch_num, {i} AS ordinal, '{c}' AS column_name, '{kind}' AS data_type, count(*) - count({c}) AS null_count, "
            f"count(DISTINCT {c}) AS unique_count, {stats} FROM policies GROUP BY batch_num"
        )
    union = " UNION ALL ".join(parts)
    return f"prof(batch_num, ordinal, column_name, data_type, null_count, unique_count, min_value, max_value, mean_value) AS ({union})"


@query(
    "column_profile",
    f"""WITH {sql.POLICIES}, {_profile_sql()} SELECT batch_num, ordinal, column_name, data_type, null_count, unique_count, min_value, max_value,
    round(mean_value, 6) AS mean_value FROM prof""",
)
def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_profile(policies(spark, folder), FIXTURE).withColumn("mean_value", F.round("mean_value", 6))


@query(
    "column_profile_events",
    """WITH e AS (SELECT *, event_id // 1000 + 1 AS batch_num FROM events) SELECT batch_num, 'value' AS column_name, count(DISTINCT value) AS unique_count,
    min(value) AS min_value, max(value) AS max_value FROM e GROUP BY 1 UNION ALL SELECT batch_num, 'event_type', count(DISTINCT event_type), NULL, NULL
    FROM e GROUP BY 1 UNION ALL SELECT batch_num, 'user_id', count(DISTINCT user_id), min(user_id)::DOUBLE, max(user_id)::DOUBLE FROM e GROUP BY 1""",
)
def column_profile_events(spark: SparkSession, folder: str) -> DataFrame:
    rows = events(spark, folder).select("batch_num", "value", "event_type", "user_id")
    return profile.column_profile(rows, EVENT_ROLES).select("batch_num", "column_name", "unique_count", "min_value", "max_value")


@query("column_profile_approximate")
def column_profile_approximate(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_profile(policies(spark, folder), FIXTURE, approximate=True)


@query(
    "top_missing",
    f"""WITH {sql.POLICIES}, {_profile_sql()} SELECT batch_num, column_name, null_count, rank FROM (SELECT batch_num, column_name, null_count,
    CAST(row_number() OVER (PARTITION BY batch_num ORDER BY null_count DESC, ordinal) AS INTEGER) AS rank FROM prof) WHERE rank <= 5""",
)
def top_missing(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.column_profile(policies(spark, folder), FIXTURE)
    return profile.top_missing(found, FIXTURE).select("batch_num", "column_name", "null_count", "rank")


@query(
    "typed_dates",
    """SELECT o_orderkey AS object_id, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate END AS insr_begin FROM orders""",
)
def typed_dates(spark: SparkSession, folder: str) -> DataFrame:
    day = F.upper(F.date_format("o_orderdate", "dd-MMM-yy"))
    text = F.when(F.col("o_orderkey") % 97 == 0, F.concat(F.lit("31-FOO-"), day)).otherwise(F.concat(F.lit(" "), day))
    raw = table(spark, folder, "orders").select(F.col("o_orderkey").alias("object_id"), text.alias(" insr_begin "))
    return coerce.coerce(raw, dates=["insr_begin"]).withColumn("insr_begin", F.col("insr_begin").cast("timestamp_ntz"))


@query(
    "typed_numbers",
    """SELECT o_orderkey AS object_id, CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR o_orderkey % 83 = 0 THEN NULL ELSE o_totalprice END AS premium
    FROM orders""",
)
def typed_numbers(spark: SparkSession, folder: str) -> DataFrame:
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    text = (
        F.when(key % 97 == 0, F.concat(price, F.lit("d"))).when(key % 89 == 0, "NaN").when(key % 83 == 0, "")
        .otherwise(F.concat(F.lit(" "), price, F.lit(" ")))
    )
    raw = table(spark, folder, "orders").select(key.alias("object_id"), text.alias("premium"))
    return coerce.coerce(raw, numbers=["premium"])


@query(
    "day_difference",
    """SELECT event_id, CAST(floor(epoch_us(ts - TIMESTAMP '2024-01-02 12:00:00') / 86400000000.0) AS BIGINT) AS days FROM
    (SELECT event_id, ts FROM events)""",
)
def day_difference(spark: SparkSession, folder: str) -> DataFrame:
    noon = F.lit("2024-01-02 12:00:00").cast("timestamp")
    return table(spark, folder, "events").select("event_id", coerce.day_difference(noon, F.col("ts")).alias("days"))


@query(
    "item_lists",
    """SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_brand || ' , ' || p_type || ',,', ','), lambda x: trim(x)),
    lambda x: x <> ''), '|') AS items FROM part""",
)
def item_lists(spark: SparkSession, folder: str) -> DataFrame:
    text = F.concat("p_brand", F.lit(" , "), "p_type", F.lit(",,"))
    return table(spark, folder, "part").select("p_partkey", F.array_join(coerce.split_items(text), "|").alias("items"))


def _rounded_metrics(prefix: str = "") -> str:
    return ", ".join(f"round({m}, 6) AS {prefix}{m}" for m in sql.METRICS)


@query("dq_metrics", f"WITH {sql.POLICIES}, m AS ({sql.metrics('policies')}) SELECT batch_num, n_rows, n_cols, {_rounded_metrics()} FROM m")
def dq_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.dq_metrics(policies(spark, folder), FIXTURE)
    return found.select("batch_num", "n_rows", "n_cols", *[r6(m) for m in METRICS])


@query(
    "dq_flags",
    f"""WITH {sql.POLICIES}, m AS ({sql.metrics("policies")}) SELECT batch_num, {", ".join(f"{c} AS {n}" for n, c in sql.FLAGS.items())},
    {" OR ".join(sql.FLAGS.values())} AS any_issue FROM m""",
)
def dq_flags(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_flags(quality.dq_metrics(policies(spark, folder), FIXTURE)).select("batch_num", *quality.FLAGS)


@query(
    "invalid_breakdown",
    f"WITH {sql.POLICIES} "
    + " UNION ALL ".join(f"SELECT batch_num, '{n}' AS \"check\", round({sql.share(c)}, 6) AS ratio FROM policies GROUP BY 1" for n, c in sql.CHECKS.items()),
)
def invalid_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.invalid_breakdown(quality.dq_metrics(policies(spark, folder), FIXTURE), FIXTURE), "ratio")


@query(
    "missing_per_column",
    f"WITH {sql.POLICIES} "
    + " UNION ALL ".join(
        f"SELECT batch_num, '{c}' AS column_name, round({sql.share(c + ' IS NULL')}, 6) AS ratio FROM policies GROUP BY 1" for c in sql.COLUMNS
    ),
)
def missing_per_column(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.missing_breakdown(quality.dq_metrics(policies(spark, folder), FIXTURE), FIXTURE), "ratio")


@query(
    "duplicates",
    f"""WITH {sql.POLICIES} SELECT batch_num, sum(n)::BIGINT AS n_rows, count(*) AS n_distinct, round((sum(n) - count(*))::DOUBLE / sum(n), 6) AS duplicate_ratio
    FROM (SELECT batch_num, {", ".join(CATEGORIES)}, count(*) AS n FROM policies GROUP BY ALL) GROUP BY 1""",
)
def duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.duplicates(policies(spark, folder).select("batch_num", *CATEGORIES), FIXTURE), "duplicate_ratio")


DQ_SQL = f"""WITH {sql.POLICIES}, {sql.CLEANED}, b AS ({sql.metrics("policies")}), a AS ({sql.metrics("cleaned")})
    SELECT b.batch_num, b.n_rows AS before_n_rows, a.n_rows AS after_n_rows, {", ".join(f"round(b.{m}, 6) AS before_{m}" for m in sql.METRICS)},
    {", ".join(f"round(a.{m}, 6) AS after_{m}" for m in sql.METRICS)},
    {" OR ".join("b." + c for c in sql.FLAGS.values())} AS before_any_issue, {" OR ".join("a." + c for c in sql.FLAGS.values())} AS after_any_issue
    FROM b JOIN a USING (batch_num)"""


def dq_columns(report: DataFrame) -> DataFrame:
    return report.select(
        "batch_num",
        *[F.col(f"{w}.n_rows").alias(f"{w}_n_rows") for w in ("before", "after")],
        *[r6(F.col(f"{w}.{m}"), f"{w}_{m}") for w in ("before", "after") for m in METRICS],
        *[F.col(f"flags_{w}.any_issue").alias(f"{w}_any_issue") for w in ("before", "after")],
    )


@query("dq_before_after", DQ_SQL)
def dq_before_after(spark: SparkSession, folder: str) -> DataFrame:
    return dq_columns(quality.dq_report(policies(spark, folder), FIXTURE))


ALL = "batch_num, " + ", ".join(sql.COLUMNS)


@query("clean_rows", f"WITH {sql.POLICIES}, {sql.KEPT} SELECT {ALL} FROM (SELECT * REPLACE (prod_year::DOUBLE AS prod_year) FROM blanked)")
def clean_rows(spark: SparkSession, folder: str) -> DataFrame:
    kept = clean.blank_values(clean.drop_rows(policies(spark, folder), FIXTURE), FIXTURE)
    return kept.withColumn("prod_year", F.col("prod_year").cast("double"))


@query("clean_impute", f"WITH {sql.POLICIES}, {sql.CLEANED} SELECT {ALL} FROM (SELECT * REPLACE (round(premium, 6) AS premium) FROM cleaned)")
def clean_impute(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clean.clean(policies(spark, folder), FIXTURE), "premium")


@query(
    "clean_impute_mean",
    f"""WITH {sql.POLICIES}, {sql.KEPT} SELECT object_id, batch_num, round(coalesce(premium, avg(premium) OVER (PARTITION BY batch_num)), 6) AS premium,
    round(coalesce(prod_year::DOUBLE, avg(prod_year) OVER (PARTITION BY batch_num)), 6) AS prod_year FROM blanked""",
)
def clean_impute_mean(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = clean.clean(policies(spark, folder), FIXTURE, Cleaning(impute_numeric="mean"))
    return cleaned.select("object_id", "batch_num", F.round("premium", 6).alias("premium"), F.round("prod_year", 6).alias("prod_year"))
