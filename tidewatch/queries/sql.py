"""SQL fragments shared by the twins: the policy view and what is derived from it."""

POLICIES = """policies AS (
  SELECT o.o_orderkey AS object_id, o.o_orderkey // 1000 + 1 AS batch_num, o.o_orderdate AS insr_begin, l.insr_end,
         o.o_orderpriority AS insr_type, o.o_orderstatus AS usage, c.c_mktsegment AS make, CAST(c.c_nationkey % 4 AS INTEGER) AS sex,
         l.insured_value, c.c_acctbal AS premium, l.seats_num, l.carrying_capacity, CAST(year(o.o_orderdate) AS INTEGER) AS prod_year,
         l.claim_paid
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS insr_end, max(l_extendedprice) AS insured_value, max(l_quantity) AS seats_num,
                    nullif(min(l_tax), 0.0) AS carrying_capacity,
                    max(CASE WHEN l_returnflag = 'R' AND l_discount > 0.08 THEN l_extendedprice ELSE 0.0 END) AS claim_paid
             FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey)"""

COLUMNS = (
    "object_id", "insr_begin", "insr_end", "insr_type", "usage", "make", "sex", "insured_value", "premium", "seats_num",
    "carrying_capacity", "prod_year", "claim_paid",
)
NUMBERS = ("object_id", "sex", "insured_value", "premium", "seats_num", "carrying_capacity", "prod_year", "claim_paid")
MONITORED = ("claim_paid", "insured_value", "premium", "prod_year", "seats_num", "sex")
CATEGORICAL = ("insr_type", "usage", "make")
KEPT = """dedup AS (SELECT DISTINCT * FROM policies),
kept AS (SELECT * FROM dedup WHERE NOT coalesce(insr_begin > insr_end, false) AND insr_begin IS NOT NULL),
blanked AS (SELECT object_id, batch_num, insr_begin, insr_end, insr_type, usage, make, sex,
  coalesce(CASE WHEN insured_value >= 0 THEN insured_value END, 0.0) AS insured_value,
  CASE WHEN premium >= 0 THEN premium END AS premium,
  coalesce(CASE WHEN seats_num BETWEEN 1 AND 40 THEN seats_num END, 0.0) AS seats_num,
  coalesce(carrying_capacity, 0.0) AS carrying_capacity,
  CASE WHEN prod_year BETWEEN 1996 AND 2000 THEN prod_year END AS prod_year,
  coalesce(CASE WHEN claim_paid >= 0 THEN claim_paid END, 0.0) AS claim_paid FROM kept)"""
CLEANED = f"""{KEPT},
fills AS (SELECT batch_num, median(premium) AS fill_premium, median(prod_year) AS fill_year FROM blanked GROUP BY 1),
cleaned AS (SELECT b.object_id, b.batch_num, b.insr_begin, b.insr_end, coalesce(b.insr_type, 'Unknown') AS insr_type,
  coalesce(b.usage, 'Unknown') AS usage, coalesce(b.make, 'Unknown') AS make, b.sex, b.insured_value,
  coalesce(b.premium, f.fill_premium) AS premium, b.seats_num, b.carrying_capacity,
  coalesce(CAST(b.prod_year AS DOUBLE), f.fill_year) AS prod_year, b.claim_paid
  FROM blanked b JOIN fills f USING (batch_num))"""

CHECKS = {
    "sex_unknown": "sex NOT IN (0, 1, 2)",
    "insr_type_unknown": "insr_type NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')",
    "prod_year_out_of_range": "prod_year NOT BETWEEN 1996 AND 2000",
    "seats_out_of_range": "seats_num NOT BETWEEN 1 AND 40",
    "insured_value_negative": "insured_value < 0",
    "premium_negative": "premium < 0",
    "claim_paid_negative": "claim_paid < 0",
}


def share(condition: str) -> str:
    return f"(count(CASE WHEN {condition} THEN 1 END)::DOUBLE / count(*))"


def metrics(source: str) -> str:
    """Quality metrics of every batch of a relation with the policy columns."""
    nulls = " + ".join(f"count(CASE WHEN {c} IS NULL THEN 1 END)" for c in COLUMNS)
    checks = ", ".join(share(c) for c in CHECKS.values())
    return f"""SELECT m.batch_num, n_rows, {len(COLUMNS)} AS n_cols, missing_total_ratio,
      (n_rows - n_distinct)::DOUBLE / n_rows AS duplicate_ratio, bad_time_ratio, bad_date_ratio, invalid_ratio
    FROM (SELECT batch_num, count(*) AS n_rows, ({nulls})::DOUBLE / (count(*) * {len(COLUMNS)}) AS missing_total_ratio,
            {share("insr_begin IS NULL")} AS bad_time_ratio,
            greatest({share("insr_begin > insr_end")}, {share("insr_begin IS NULL")}, {share("insr_end IS NULL")}) AS bad_date_ratio,
            greatest({checks}) AS invalid_ratio FROM {source} GROUP BY batch_num) m
    JOIN (SELECT batch_num, count(*) AS n_distinct FROM (SELECT DISTINCT * FROM {source}) GROUP BY batch_num) d ON m.batch_num = d.batch_num"""


METRICS = ("missing_total_ratio", "duplicate_ratio", "bad_time_ratio", "bad_date_ratio", "invalid_ratio")
FLAGS = {
    "too_many_missing": "missing_total_ratio > 0.30",
    "too_many_duplicates": "duplicate_ratio > 0.05",
    "too_many_bad_dates": "bad_date_ratio > 0.01",
    "too_many_invalid": "invalid_ratio > 0.03",
}


def cells(source: str, columns: tuple[str, ...], extra: str = "", cast: str = "DOUBLE") -> str:
    """One row per batch, row and column."""
    return " UNION ALL ".join(f"SELECT batch_num{extra}, '{c}' AS col, CAST({c} AS {cast}) AS v FROM {source}" for c in columns)


def mining(source: str, by_batch: bool = True, constant: bool = True) -> str:
    """CTEs from rows to ``tx`` (batch, row, item) and ``sizes``; without ``by_batch`` all rows are batch 0."""
    rows = f"base AS (SELECT * FROM {source})" if by_batch else f"base AS (SELECT * REPLACE (0 AS batch_num) FROM {source})"
    hot = " UNION ALL ".join(f"SELECT batch_num, object_id, '{c}' AS col, CAST({c} AS VARCHAR) AS v FROM base" for c in ("insr_type", "usage", "make", "sex"))
    drop = "WHERE (batch_num, item) NOT IN (SELECT (batch_num, item) FROM counted JOIN sizes USING (batch_num) WHERE n = n_rows)" if constant else ""
    return f"""{rows},
sizes AS (SELECT batch_num, count(*) AS n_rows FROM base GROUP BY 1),
quarts AS (SELECT batch_num, quantile_cont(premium, 0.75) AS pq, quantile_cont(insured_value, 0.75) AS iq FROM base GROUP BY 1),
hot AS ({hot}),
tops AS (SELECT batch_num, col, v, n, rank FROM (SELECT batch_num, col, v, count(*) AS n,
  row_number() OVER (PARTITION BY batch_num, col ORDER BY count(*) DESC, v) AS rank FROM hot WHERE v IS NOT NULL GROUP BY 1, 2, 3) WHERE rank <= 5),
all_items AS (
  SELECT batch_num, object_id, 'premium_gt_0' AS item FROM base WHERE premium > 0
  UNION ALL SELECT batch_num, object_id, 'seats_ge_5' FROM base WHERE seats_num >= 5
  UNION ALL SELECT batch_num, object_id, 'duration_ge_365' FROM base WHERE date_diff('day', insr_begin, insr_end) >= 365
  UNION ALL SELECT batch_num, object_id, 'premium_high' FROM base JOIN quarts USING (batch_num) WHERE premium >= pq
  UNION ALL SELECT batch_num, object_id, 'insured_value_high' FROM base JOIN quarts USING (batch_num) WHERE insured_value >= iq
  UNION ALL SELECT h.batch_num, h.object_id, h.col || '=' || h.v FROM hot h JOIN tops t ON h.batch_num = t.batch_num AND h.col = t.col AND h.v = t.v),
counted AS (SELECT batch_num, item, count(*) AS n FROM all_items GROUP BY 1, 2),
tx AS (SELECT * FROM all_items {drop})"""


def itemsets(min_support: float) -> str:
    """CTE ``sets`` (batch, itemset list, n, n_rows) from ``tx``: every subset of every row's frequent items."""
    return f"""frequent AS (SELECT batch_num, item FROM (SELECT batch_num, item, count(*) AS n FROM tx GROUP BY 1, 2) JOIN sizes USING (batch_num)
  WHERE n::DOUBLE / n_rows >= {min_support}),
lists AS (SELECT batch_num, items, count(*) AS n FROM (SELECT batch_num, object_id, list(item ORDER BY item) AS items FROM tx
  SEMI JOIN frequent USING (batch_num, item) GROUP BY 1, 2) GROUP BY 1, 2),
masks AS (SELECT batch_num, items, n, unnest(range(1, CAST(pow(2, len(items)) AS BIGINT))) AS mask FROM lists),
sets AS (SELECT batch_num, itemset, CAST(sum(n) AS BIGINT) AS n, any_value(n_rows) AS n_rows FROM (
  SELECT batch_num, n, list_filter(items, lambda x, i: (mask // CAST(pow(2, i - 1) AS BIGINT)) % 2 = 1) AS itemset FROM masks) JOIN sizes USING (batch_num)
  GROUP BY 1, 2 HAVING sum(n)::DOUBLE / any_value(n_rows) >= {min_support})"""


def rules(min_confidence: float, min_lift: float) -> str:
    """CTE ``found`` from ``sets``: all splits that pass both limits."""
    return f"""parts AS (SELECT *, unnest(range(1, CAST(pow(2, len(itemset)) AS BIGINT) - 1)) AS mask FROM sets WHERE len(itemset) > 1),
split AS (SELECT batch_num, n, n_rows, list_filter(itemset, lambda x, i: (mask // CAST(pow(2, i - 1) AS BIGINT)) % 2 = 1) AS ante,
  list_filter(itemset, lambda x, i: (mask // CAST(pow(2, i - 1) AS BIGINT)) % 2 = 0) AS cons FROM parts),
found AS (SELECT * FROM (SELECT s.batch_num, s.n::DOUBLE / s.n_rows AS support, s.n::DOUBLE / a.n AS confidence,
    (s.n::DOUBLE / a.n) / (c.n::DOUBLE / s.n_rows) AS lift, array_to_string(s.ante, ', ') AS antecedents_str,
    array_to_string(s.cons, ', ') AS consequents_str, s.ante, s.cons
  FROM split s JOIN sets a ON s.batch_num = a.batch_num AND s.ante = a.itemset JOIN sets c ON s.batch_num = c.batch_num AND s.cons = c.itemset)
  WHERE confidence >= {min_confidence} AND lift >= {min_lift})"""


def coded_rules(min_confidence: float, min_lift: float) -> str:
    """CTE ``found`` from ``sets`` and ``frequent``: the same splits, with itemsets as bit masks so that all of them are joined by integers."""
    return f"""bits AS (SELECT batch_num, item, CAST(1 AS BIGINT) << CAST(row_number() OVER (PARTITION BY batch_num ORDER BY item) - 1 AS INT) AS bit FROM frequent),
coded AS (SELECT batch_num, n, n_rows, itemset, list(bit ORDER BY item) AS bits, CAST(sum(bit) AS BIGINT) AS code
  FROM (SELECT batch_num, n, n_rows, itemset, unnest(itemset) AS item FROM sets) JOIN bits USING (batch_num, item) GROUP BY 1, 2, 3, 4),
split AS (SELECT batch_num, n, n_rows, code,
    CAST(list_sum(list_transform(bits, lambda b, i: CASE WHEN (mask >> (i - 1)) & 1 = 1 THEN b ELSE 0 END)) AS BIGINT) AS ante
  FROM (SELECT *, unnest(range(1, (CAST(1 AS BIGINT) << len(itemset)) - 1)) AS mask FROM coded WHERE len(itemset) > 1)),
found AS (SELECT s.batch_num, s.n::DOUBLE / s.n_rows AS support, s.n::DOUBLE / a.n AS confidence, (s.n::DOUBLE / a.n) / (c.n::DOUBLE / s.n_rows) AS lift,
    array_to_string(a.itemset, ', ') AS antecedents_str, array_to_string(c.itemset, ', ') AS consequents_str
  FROM split s JOIN coded a ON s.batch_num = a.batch_num AND s.ante = a.code JOIN coded c ON s.batch_num = c.batch_num AND s.code - s.ante = c.code
  WHERE s.n::DOUBLE / a.n >= {min_confidence} AND (s.n::DOUBLE / a.n) / (c.n::DOUBLE / s.n_rows) >= {min_lift})"""


def top(k: int = 5) -> str:
    """CTE ``best``: the first k of ``found`` per batch."""
    return f"""best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_num ORDER BY lift DESC, confidence DESC, support DESC,
  antecedents_str, consequents_str) AS r FROM found) WHERE r <= {k})"""


QUARTILES = f"""long AS ({cells("policies", NUMBERS)}),
quart AS (SELECT batch_num, col, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM long WHERE v IS NOT NULL GROUP BY 1, 2)"""
SHIFT = f"""{QUARTILES},
shift0 AS (SELECT n.batch_num, n.col, n.q1, n.q3, r.q1 AS q1_ref, r.q3 AS q3_ref,
  1 - least(1.0, abs((n.q1 - r.q1) / (r.q3 - r.q1 + 1e-8)) + abs((n.q3 - r.q3) / (r.q3 - r.q1 + 1e-8))) AS similarity
  FROM quart n JOIN quart r ON r.batch_num = 1 AND r.col = n.col WHERE n.col IN {MONITORED}),
shift AS (SELECT *, similarity < 0.8 AS drifted, 1 - similarity AS score,
  CASE WHEN q1_ref <> 0 THEN (q1 - q1_ref) / q1_ref * 100 ELSE 0.0 END AS q1_change_percent,
  CASE WHEN q3_ref <> 0 THEN (q3 - q3_ref) / q3_ref * 100 ELSE 0.0 END AS q3_change_percent FROM shift0)"""


def shares(columns: tuple[str, ...], name: str = "shares") -> str:
    return f"""{name} AS (SELECT batch_num, col, v, n, sum(n) OVER (PARTITION BY batch_num, col) AS total, n::DOUBLE / sum(n) OVER (PARTITION BY batch_num, col) AS share
  FROM (SELECT batch_num, col, v, count(*) AS n FROM ({cells("policies", columns, cast="VARCHAR")}) WHERE v IS NOT NULL GROUP BY 1, 2, 3))"""


CHI = f"""{shares(CATEGORICAL)},
pairs AS (SELECT coalesce(n.batch_num, b.batch_num) AS batch_num, coalesce(n.col, b.col) AS col, coalesce(n.share, 0.0) AS o, coalesce(b.share, 0.0) AS e, n.total
  FROM (SELECT k.batch_num, r.col, r.v, r.share FROM (SELECT DISTINCT batch_num FROM policies) k, shares r WHERE r.batch_num = 1) b
  FULL JOIN shares n ON n.batch_num = b.batch_num AND n.col = b.col AND n.v = b.v),
chi AS (SELECT batch_num, col, CASE WHEN min(e) = 0 THEN NULL ELSE sum((o - e) * (o - e) / nullif(e, 0)) END AS statistic,
  count(*) - 1 AS df, min(e) = 0 AS unseen, max(total) AS total FROM pairs GROUP BY 1, 2)"""


def tail(x: str) -> str:
    """Chi-square tail for an even number of degrees of freedom (as all fixture columns have)."""
    return f"exp(-({x}) / 2) * list_sum(list_transform(range(0, df // 2), lambda k: pow(({x}) / 2, k) / gamma(k + 1)))"


CHI_P = f"CASE WHEN unseen THEN 0.0 ELSE {tail('statistic')} END"
TARGET = f"""{shares(("claim_paid",), "claims")},
tpairs AS (SELECT coalesce(n.batch_num, b.batch_num) AS batch_num, coalesce(n.share, 0.001) AS o, coalesce(b.share, 0.001) AS e
  FROM (SELECT k.batch_num, r.v, r.share FROM (SELECT DISTINCT batch_num FROM policies) k, claims r WHERE r.batch_num = 1) b
  FULL JOIN claims n ON n.batch_num = b.batch_num AND n.v = b.v),
target AS (SELECT batch_num, sum(abs(o - e)) AS distribution_change FROM tpairs GROUP BY 1)"""
NULL_CELLS = " + ".join(f"count(CASE WHEN {c} IS NULL THEN 1 END)" for c in COLUMNS)
QUALITY = f"""outliers AS (SELECT l.batch_num, count(CASE WHEN v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
  FROM long l JOIN quart q ON l.batch_num = q.batch_num AND l.col = q.col GROUP BY 1),
missing AS (SELECT batch_num, count(*) AS n_rows, ({NULL_CELLS})::DOUBLE / (count(*) * {len(COLUMNS)}) AS missing_ratio FROM policies GROUP BY 1),
quality AS (SELECT m.batch_num, m.n_rows, m.missing_ratio, o.outliers, abs(m.missing_ratio - rm.missing_ratio) AS missing_value_drift,
  abs(o.outliers - ro.outliers)::DOUBLE / greatest(ro.outliers, 1) AS outlier_drift
  FROM missing m JOIN outliers o ON o.batch_num = m.batch_num JOIN missing rm ON rm.batch_num = 1 JOIN outliers ro ON ro.batch_num = 1)"""
VERDICT = f"""{POLICIES}, {SHIFT}, {CHI}, {TARGET}, {QUALITY},
tests AS (SELECT batch_num, col, score, drifted AS counts, drifted FROM shift
  UNION ALL SELECT batch_num, col, 1 - {CHI_P}, true, {CHI_P} < 0.01 FROM chi),
features AS (SELECT batch_num, coalesce(avg(CASE WHEN counts THEN score END), 0.0) AS confidence, count(CASE WHEN drifted THEN 1 END) AS n_affected,
  coalesce(string_agg(CASE WHEN drifted THEN col END, ',' ORDER BY col), '') AS affected FROM tests GROUP BY 1),
verdict AS (SELECT f.batch_num, q.n_rows, n_affected > 0 OR distribution_change > 0.1 AS drift_detected,
  CASE WHEN distribution_change > 0.1 THEN 'concept' WHEN n_affected > 0 THEN 'covariate' END AS drift_type,
  CASE WHEN n_affected > 0 THEN confidence ELSE 0.0 END AS confidence, affected, n_affected,
  CASE WHEN distribution_change > 0.1 THEN least(distribution_change, 1.0) END AS concept_shift_confidence,
  missing_value_drift > 0.05 OR outlier_drift > 0.5 AS quality_issues, missing_value_drift, outlier_drift
  FROM features f JOIN target t ON t.batch_num = f.batch_num JOIN quality q ON q.batch_num = f.batch_num)"""

# A deterministic score and label per row stand in for classifiers.
SCORED = """scored AS (SELECT object_id, batch_num, CASE WHEN claim_paid > 0 THEN 1 ELSE 0 END AS label, model_name, score,
    CASE WHEN score >= 0.6 THEN 1.0 ELSE 0.0 END AS prediction FROM (
  SELECT *, 'DecisionTree' AS model_name, coalesce(seats_num, 0.0) / 50 AS score FROM policies
  UNION ALL SELECT *, 'NeuralNetwork', greatest(premium, 0.0) / 10000 FROM policies
  UNION ALL SELECT *, 'RandomForest', coalesce(insured_value, 0.0) / 100000 FROM policies))"""


def auc(by: str) -> str:
    """AUC by average ranks per group."""
    return f"""SELECT {by}, CASE WHEN p * (n - p) > 0 THEN (ranks - p * (p + 1) / 2.0) / (p::DOUBLE * (n - p)) ELSE 0.5 END AS roc_auc FROM (
  SELECT {by}, sum(CASE WHEN label = 1 THEN r + (t - 1) / 2.0 ELSE 0 END) AS ranks, CAST(sum(label) AS BIGINT) AS p, count(*) AS n FROM (
    SELECT {by}, label, rank() OVER (PARTITION BY {by} ORDER BY score) AS r, count(*) OVER (PARTITION BY {by}, score) AS t FROM scored) GROUP BY {by})"""


CONFUSION = """count(CASE WHEN label = 0 AND prediction = 0 THEN 1 END) AS tn, count(CASE WHEN label = 0 AND prediction = 1 THEN 1 END) AS fp,
  count(CASE WHEN label = 1 AND prediction = 0 THEN 1 END) AS fn, count(CASE WHEN label = 1 AND prediction = 1 THEN 1 END) AS tp"""


def binary(by: str) -> str:
    return f"""SELECT {by}, tn + fp + fn + tp AS n, (tn + tp)::DOUBLE / (tn + fp + fn + tp) AS accuracy,
  coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS "precision", coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM (SELECT {by}, {CONFUSION} FROM scored GROUP BY {by})"""


HISTORY = f"""{POLICIES}, {SCORED},
history AS (SELECT b.model_name, b.batch_num AS ts, b.batch_num AS version, round(b.accuracy, 6) AS accuracy, round(b.f1, 6) AS f1,
  CASE WHEN b.batch_num % 5 <> 0 THEN round(a.roc_auc, 6) END AS roc_auc, round(t.inference_time, 6) AS inference_time
  FROM ({binary("model_name, batch_num")}) b JOIN ({auc("model_name, batch_num")}) a USING (model_name, batch_num)
  JOIN (SELECT batch_num, max(insured_value) / 100000 AS inference_time FROM policies GROUP BY 1) t USING (batch_num))"""
