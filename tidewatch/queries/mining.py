"""Queries over association rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import rules
from tidewatch.operators.clean import clean
from tidewatch.plans import jobs
from tidewatch.queries import sql
from tidewatch.queries.registry import query, r6
from tidewatch.roles import Limits, Mining
from tidewatch.session import materialize, stored
from tidewatch.sources.tables import FIXTURE, stored_policies

REFERENCE_BATCHES = 3
RULE = "round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift, antecedents_str, consequents_str"


def _baskets(spark: SparkSession, folder: str, **options) -> DataFrame:
    return rules.baskets(stored_policies(spark, folder, packed=True), FIXTURE, Mining(**options))


def _rule_columns(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*more, r6("support"), r6("confidence"), r6("lift"), "antecedents_str", "consequents_str")


@query("top_values", f"WITH {sql.POLICIES}, {sql.mining('policies')} SELECT batch_num, col AS \"column\", v AS value, n, CAST(rank AS INTEGER) AS rank FROM tops")
def top_values(spark: SparkSession, folder: str) -> DataFrame:
    return rules.top_values(stored_policies(spark, folder), FIXTURE, 5)


@query(
    "items",
    f"""WITH {sql.POLICIES}, {sql.mining("policies")} SELECT b.batch_num, b.object_id, coalesce(string_agg(t.item, ', ' ORDER BY t.item), '') AS items
    FROM base b LEFT JOIN all_items t ON t.batch_num = b.batch_num AND t.object_id = b.object_id GROUP BY 1, 2""",
)
def items(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.transactions(stored_policies(spark, folder), FIXTURE)
    return found.select("batch_num", "object_id", F.array_join("items", ", ").alias("items"))


@query(
    "item_counts",
    f"""WITH {sql.POLICIES}, {sql.mining("policies")} SELECT batch_num, n_rows, item, n FROM
    (SELECT batch_num, item, count(*) AS n FROM tx GROUP BY 1, 2) JOIN sizes USING (batch_num)""",
)
def item_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rules.item_counts(_baskets(spark, folder), FIXTURE)


def _sets_sql(size: int | None) -> str:
    only = f"WHERE len(itemset) = {size}" if size else ""
    return f"""WITH {sql.POLICIES}, {sql.mining("policies")}, {sql.itemsets(0.03)}
    SELECT batch_num, array_to_string(itemset, ', ') AS itemset, n, round(n::DOUBLE / n_rows, 6) AS support FROM sets {only}"""


def _sets(spark: SparkSession, folder: str) -> DataFrame:
    return rules.itemsets(_baskets(spark, folder), FIXTURE, 0.03)


def _set_columns(df: DataFrame) -> DataFrame:
    return df.select("batch_num", F.array_join("itemset", ", ").alias("itemset"), "n", r6(F.col("n") / F.col("n_rows"), "support"))


@query("itemsets", _sets_sql(None))
def itemsets(spark: SparkSession, folder: str) -> DataFrame:
    return _set_columns(_sets(spark, folder))


@query(
    "itemsets_2",
    f"""WITH {sql.POLICIES}, {sql.mining("policies")} SELECT a.batch_num, a.item || ', ' || b.item AS itemset, count(*) AS n,
    round(count(*)::DOUBLE / any_value(n_rows), 6) AS support FROM tx a JOIN tx b ON a.batch_num = b.batch_num AND a.object_id = b.object_id AND a.item < b.item
    JOIN sizes s ON s.batch_num = a.batch_num GROUP BY 1, 2 HAVING count(*)::DOUBLE / any_value(n_rows) >= 0.03""",
)
def itemsets_2(spark: SparkSession, folder: str) -> DataFrame:
    return _set_columns(_sets(spark, folder).where(F.size("itemset") == 2))


@query(
    "itemsets_grown_3",
    f"""WITH {sql.POLICIES}, {sql.mining("policies")} SELECT a.batch_num, a.item || ', ' || b.item || ', ' || c.item AS itemset, count(*) AS n,
    round(count(*)::DOUBLE / any_value(n_rows), 6) AS support FROM tx a JOIN tx b ON a.batch_num = b.batch_num AND a.object_id = b.object_id AND a.item < b.item
    JOIN tx c ON c.batch_num = b.batch_num AND c.object_id = b.object_id AND b.item < c.item
    JOIN sizes s ON s.batch_num = a.batch_num GROUP BY 1, 2 HAVING count(*)::DOUBLE / any_value(n_rows) >= 0.03""",
)
def itemsets_grown_3(spark: SparkSession, folder: str) -> DataFrame:
    grown = rules.itemsets(_baskets(spark, folder), FIXTURE, 0.03)
    return _set_columns(grown.where(F.size("itemset") == 3))


@query("rules_all", f"WITH {sql.POLICIES}, {sql.mining('policies')}, {sql.itemsets(0.03)}, {sql.coded_rules(0.4, 1.05)} SELECT batch_num, {RULE} FROM found")
def rules_all(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.rules(stored(_sets(spark, folder)), FIXTURE, 0.4, 1.05)
    return _rule_columns(found, "batch_num")


@query("rules_top", f"WITH {sql.POLICIES}, {sql.mining('policies')}, {sql.itemsets(0.03)}, {sql.rules(0.4, 1.05)}, {sql.top()} SELECT batch_num, {RULE} FROM best")
def rules_top(spark: SparkSession, folder: str) -> DataFrame:
    return _rule_columns(rules.mine(stored_policies(spark, folder, packed=True), FIXTURE), "batch_num")


# Tight first thresholds, so that relaxing them is exercised.
TIGHT = Mining(min_support=0.2, min_confidence=0.6, min_lift=1.2)
GRID = [(TIGHT.min_support, TIGHT.min_confidence, TIGHT.min_lift)] + [
    (s, c, lift) for s in (0.2, 0.03, 0.02, 0.01) for c in (0.6, 0.4, 0.3, 0.2) for lift in (1.2, 1.05, 1.0)
]
GRID_VALUES = ", ".join(f"({i}, {s}::DOUBLE, {c}::DOUBLE, {lift}::DOUBLE)" for i, (s, c, lift) in enumerate(GRID))


def _relaxed_sql(early: str) -> str:
    return f"""WITH {sql.POLICIES}, {sql.CLEANED}, early AS (SELECT * FROM cleaned WHERE {early}),
    {sql.mining("early", by_batch=False)}, {sql.itemsets(0.01)}, {sql.rules(0.2, 1.0)},
    grid(i, min_support, min_confidence, min_lift) AS (VALUES {GRID_VALUES}),
    chosen AS (SELECT * FROM grid g WHERE (SELECT count(*) FROM found f WHERE f.support >= g.min_support AND f.confidence >= g.min_confidence
      AND f.lift >= g.min_lift) >= 5 OR i = {len(GRID) - 1} ORDER BY i LIMIT 1)
    SELECT {RULE}, min_support, min_confidence, min_lift FROM (SELECT f.*, g.* FROM found f JOIN chosen g ON f.support >= g.min_support
      AND f.confidence >= g.min_confidence AND f.lift >= g.min_lift)
    ORDER BY lift DESC, confidence DESC, support DESC, antecedents_str, consequents_str LIMIT 5"""


def _relaxed_columns(found: DataFrame) -> DataFrame:
    return found.select(r6("support"), r6("confidence"), r6("lift"), "antecedents_str", "consequents_str", "min_support", "min_confidence", "min_lift")


@query("rules_relaxed", _relaxed_sql(f"batch_num <= {REFERENCE_BATCHES}"))
def rules_relaxed(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = clean(stored_policies(spark, folder), FIXTURE).where(F.col("batch_num") <= REFERENCE_BATCHES).drop("batch_num")
    return _relaxed_columns(rules.mine_relaxed(cleaned, FIXTURE, TIGHT))


@query(
    "reference_rules",
    _relaxed_sql(f"batch_num IN (SELECT batch_num FROM (SELECT DISTINCT batch_num FROM policies WHERE batch_num % 3 = 2) ORDER BY 1 LIMIT {REFERENCE_BATCHES})"),
)
def reference_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Reference rules of the first batches where batch numbers have gaps."""
    some = stored_policies(spark, folder).where("batch_num % 3 = 2")
    return _relaxed_columns(jobs.build_reference_rules(some, FIXTURE, REFERENCE_BATCHES, Limits(mining=TIGHT)))


def _reference_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules of the first batch, pinned."""
    first = stored_policies(spark, folder).where("batch_num = 1").drop("batch_num")
    return materialize(rules.mine(first, FIXTURE))


def _checked(spark: SparkSession, folder: str) -> DataFrame:
    return rules.recheck(_baskets(spark, folder), _reference_rules(spark, folder), FIXTURE)


CHECKED = f"""{sql.POLICIES}, first AS (SELECT * FROM policies WHERE batch_num = 1), {sql.mining("policies")}, {sql.itemsets(0.03)}, {sql.rules(0.4, 1.05)}, {sql.top()},
ref AS (SELECT support, confidence, lift, ante, cons, antecedents_str, consequents_str FROM best WHERE batch_num = 1),
lists2 AS (SELECT b.batch_num, b.object_id, coalesce(list(t.item) FILTER (t.item IS NOT NULL), []) AS items FROM base b
  LEFT JOIN tx t ON t.batch_num = b.batch_num AND t.object_id = b.object_id GROUP BY 1, 2),
hits AS (SELECT l.batch_num, r.*, list_has_all(l.items, r.ante) AS has_left, list_has_all(l.items, r.cons) AS has_right FROM lists2 l, ref r),
sums AS (SELECT batch_num, antecedents_str, consequents_str, any_value(support) AS support_ref, any_value(confidence) AS confidence_ref, count(*) AS n_rows,
  count(CASE WHEN has_left THEN 1 END) AS antecedent_count, count(CASE WHEN has_left AND has_right THEN 1 END) AS both_count FROM hits GROUP BY 1, 2, 3),
measured AS (SELECT *, both_count::DOUBLE / n_rows AS support_new, coalesce(both_count::DOUBLE / nullif(antecedent_count, 0), 0) AS confidence_new,
  antecedent_count < 30 AS low_sample FROM sums),
checked AS (SELECT *, NOT low_sample AND confidence_new < confidence_ref * 0.7 AS flag_conf_drop, NOT low_sample AND support_new < support_ref * 0.5 AS flag_support_drop,
  NOT low_sample AND confidence_new < 0.3 AS flag_conf_abs FROM measured)"""


@query(
    "rules_recheck",
    f"""WITH {CHECKED} SELECT batch_num, antecedents_str, consequents_str, round(support_ref, 6) AS support_ref, round(confidence_ref, 6) AS confidence_ref,
    round(support_new, 6) AS support_new, round(confidence_new, 6) AS confidence_new, antecedent_count, both_count, low_sample, flag_conf_drop,
    flag_support_drop, flag_conf_abs FROM checked""",
)
def rules_recheck(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder).select(
        "batch_num",
        F.array_join("antecedents", ", ").alias("antecedents_str"),
        F.array_join("consequents", ", ").alias("consequents_str"),
        *[r6(c) for c in ("support_ref", "confidence_ref", "support_new", "confidence_new")],
        "antecedent_count", "both_count", "low_sample", "flag_conf_drop", "flag_support_drop", "flag_conf_abs",
    )


@query(
    "rules_consistency",
    f"""WITH {CHECKED} SELECT batch_num, any_value(n_rows) AS n_rows, count(*) AS n_rules_checked, bool_or(flag_conf_drop OR flag_support_drop OR flag_conf_abs) AS any_issue
    FROM checked GROUP BY 1""",
)
def rules_consistency(spark: SparkSession, folder: str) -> DataFrame:
    return rules.consistency(_checked(spark, folder), FIXTURE)
