"""Quality classifier as a sparse rule ensemble.

Statistics of whole texts are column expressions. A random forest over a bounded sample of labelled rows gives tree
paths, each a rule that joins its splits by AND; a lasso logistic regression weighs the rules and drops most; the
rest become one column expression. Scoring is a single pass without Python, joins or shuffles.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

# Most labelled rows that a model is fitted on; the sample is drawn by a hash of the id.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5
TREES, DEPTH, LASSO = 40, 3, 0.0005

# Character classes whose share of all characters is a statistic.
CLASSES = {
    "symbols": r"[#$%&*+<=>@\\^_`~{}\[\]/]", "bars": r"[|]", "upper": r"\p{Lu}", "digits": r"[0-9]", "marks": r"[!?]", "stops": r"[.,;:]",
    "lines": r"\n",
}


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text, all 0 for null and for texts without words."""
    t = F.coalesce(text, F.lit(""))
    chars = F.char_length(t)
    words = F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+"))
    distinct = F.size(F.array_distinct(F.split(F.btrim(t, F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")))
    rows = F.filter(F.split(t, r"\n"), lambda w: w != "")

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))

    out = {name: share(F.regexp_count(t, F.lit(pattern)), chars) for name, pattern in CLASSES.items()}
    out["word_length"] = share(chars, words)
    out["variety"] = F.when(words > 0, F.log1p(distinct.cast("double")) / F.log1p(words.cast("double"))).otherwise(F.lit(0.0))
    out["repeats"] = share(F.regexp_count(t, F.lit(r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]++(?=\1(?![^\x20\x09-\x0D]))")), words)
    out["distinct_lines"] = share(F.size(F.array_distinct(rows)), F.size(rows))
    out["line_length"] = share(chars, F.size(rows))
    return out


@dataclass(frozen=True)
class Rule:
    """Bounds per statistic: all of ``above[s] < s <= below[s]`` hold."""

    above: tuple[tuple[str, float], ...]
    below: tuple[tuple[str, float], ...]

    def column(self, value: dict[str, Column]) -> Column:
        parts = [value[s] > F.lit(x) for s, x in self.above] + [value[s] <= F.lit(x) for s, x in self.below]
        return reduce(lambda a, b: a & b, parts)

    def holds(self, row: dict[str, float]) -> bool:
        return all(row[s] > x for s, x in self.above) and all(row[s] <= x for s, x in self.below)


@dataclass
class RuleModel:
    """Score = sigmoid(intercept + weights of the rules that hold)."""

    intercept: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self, value: dict[str, Column]) -> Column:
        margin = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            margin = margin + F.when(rule.column(value), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def paths(description: str, names: list[str]) -> set[Rule]:
    """The rules of a printed tree or forest: one per branch, from the root down to it."""
    found: set[Rule] = set()
    stack: list[tuple[int, str, str, float]] = []
    line_of = re.compile(r"^(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")
    for line in description.splitlines():
        m = line_of.match(line)
        if not m:
            if line.lstrip().startswith("Tree"):
                stack = []
            continue
        depth = len(m[1])
        stack = [s for s in stack if s[0] < depth] + [(depth, names[int(m[2])], m[3], float(m[4]))]
        above: dict[str, float] = {}
        below: dict[str, float] = {}
        for _, name, side, value in stack:
            if side == ">":
                above[name] = max(value, above.get(name, -math.inf))
            else:
                below[name] = min(value, below.get(name, math.inf))
        found.add(Rule(tuple(sorted(above.items())), tuple(sorted(below.items()))))
    return found


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Whether a row's label must not be learned from; a null id is not held out, and has no label either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def sample_labels(labels: DataFrame, doc_id: str, label: str, most: int, out: Column) -> DataFrame:
    """(id, label) of about ``most`` labelled rows that are not held out; all of them if there are fewer."""
    usable = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("double").alias("label"))
    usable = usable.filter(F.col("label").isin(0.0, 1.0) & F.col("id").isNotNull() & ~out)
    rows = usable.count()
    scale = 1 << 30
    return usable.filter(F.pmod(F.xxhash64("id"), F.lit(scale)) < scale * min(1.0, most / max(rows, 1)))


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", train_rows: int = TRAIN_ROWS,
    folds: int = FOLDS, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = 11,
) -> RuleModel:
    """Learn rules from labelled texts. Without labels the score is 0.5, with one class it is that class's share.

    The labels used are at most about ``train_rows``, which bounds the broadcast of their ids.
    """
    picked = sample_labels(labels, doc_id, label, train_rows, held_out(F.col("id"), folds))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    stats = statistics(F.col("text"))
    names = list(stats)
    rows = stored(texts.join(F.broadcast(picked), "id").select("label", *(stats[n].alias(n) for n in names)))
    count, positive = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not count:
        return RuleModel(0.0)
    share = (positive + 0.5) / (count + 1)
    start = RuleModel(math.log(share / (1 - share)))
    if positive in (0, count):
        return start
    vectors = rows.select("label", array_to_vector(F.array(*names)).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, subsamplingRate=0.7, featureSubsetStrategy="0.5", seed=seed).fit(vectors)
    rules = sorted(paths(forest.toDebugString, names), key=repr)
    if not rules:
        return start
    value = {n: F.col(n) for n in names}
    facts = rows.select("label", array_to_vector(F.array(*(r.column(value).cast("double") for r in rules))).alias("features"))
    weighed = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=200).fit(stored(facts))
    weights = [(r, float(w)) for r, w in zip(rules, weighed.coefficients) if abs(w) > 1e-9]
    return RuleModel(float(weighed.intercept), weights)


def score(docs: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """All rows and columns plus ``__score``; empty and null texts are scored as texts without words."""
    stats = {f"__{n}": c for n, c in statistics(F.col(text)).items()}
    named = docs.withColumns(stats)
    return named.withColumn("__score", model.score({n[2:]: F.col(n) for n in stats})).select(*docs.columns, "__score")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, unchanged.

    The score is written with the rows before they are filtered: a filter on it would be pushed below the projection and
    make every statistic again for every rule.
    """
    return stored(score(docs, fit(docs, labels)), "zstd").filter(F.col("__score") >= threshold).select(*docs.columns)
