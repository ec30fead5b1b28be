"""Training, tuning, updating and explaining Spark ML classifiers."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import evaluate as ev
from tidewatch.operators.features import DURATION, LABEL, add_class_weights, add_label, medians, modes, scaling, stratified_folds
from tidewatch.operators.forests import Ensemble
from tidewatch.operators.text_codes import TextCodes
from tidewatch.roles import Roles

SEED = 42
TREE, FOREST, NETWORK = "DecisionTree", "RandomForest", "NeuralNetwork"
MODEL_NAMES = (TREE, FOREST, NETWORK)

# The parameter grids tried by default. A least split size has no counterpart in Spark.
GRIDS = {
    TREE: {"maxDepth": [10, 15], "minInstancesPerNode": [2, 4]},
    FOREST: {"numTrees": [100, 200], "maxDepth": [10], "minInstancesPerNode": [2, 4]},
    NETWORK: {"hidden": [[100], [100, 50]]},
}


def feature_names(roles: Roles, columns: Sequence[str]) -> list[str]:
    numbers = [c for c in (*roles.zero_features, *roles.median_features) if c in columns]
    categories = [c for c in roles.categorical_features if c in columns]
    return numbers + [f"{c}_encoded" for c in categories] + [DURATION]


def _name(column: str) -> str:
    return f"`{column}`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _label_sql(df: DataFrame, column: str) -> str:
    """SQL twin of ``as_label`` for a persisted stage."""
    if df.schema[column].dataType.typeName() in ("double", "float"):
        c = _name(column)
        return f"if({c} = floor({c}), cast(cast({c} as bigint) as string), cast({c} as string))"
    return f"cast({_name(column)} as string)"


def fit_features(df: DataFrame, roles: Roles) -> PipelineModel:
    """A fitted, persistable pipeline from raw typed columns to a scaled ``features`` vector.

    Medians, modes and scaling are exact aggregates of the training table, stored as constants; the codes of texts are
    a table of the saved pipeline. Rows are not shuffled to score while the codes are small. The target is not needed.
    """
    numbers = [c for c in roles.median_features if c in df.columns]
    zeros = [c for c in roles.zero_features if c in df.columns]
    categories = [c for c in roles.categorical_features if c in df.columns]
    middles, common = medians(df, numbers), modes(df, categories)
    filled = [f"coalesce(cast({_name(c)} as double), 0.0D) AS `_num_{c}`" for c in zeros]
    filled += [f"coalesce(cast({_name(c)} as double), cast({middles[c] or 0.0!r} as double)) AS `_num_{c}`" for c in numbers]
    filled += [f"coalesce({_label_sql(df, c)}, {_text(common[c])}) AS `_cat_{c}`" for c in categories]
    days = "floor((unix_micros(cast({e} as timestamp)) - unix_micros(cast({b} as timestamp))) / 86400000000)"
    filled.append(f"cast(coalesce({days.format(b=_name(roles.begin), e=_name(roles.end))}, 1) as double) AS `_num_{DURATION}`")
    impute = SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")

    indexed = [f"_idx_{c}" for c in categories]
    encode = TextCodes(inputCols=[f"_cat_{c}" for c in categories], outputCols=indexed)
    first = Pipeline(stages=[impute, encode]).fit(df)
    raw = [f"_num_{c}" for c in zeros + numbers] + indexed + [f"_num_{DURATION}"]
    stats = {row["column"]: row for row in scaling(first.transform(df), raw).collect()}
    scaled = []
    for i, c in enumerate(raw):
        mean, std = stats[c]["mean"] or 0.0, stats[c]["std"] or 0.0
        value = f"({_name(c)} - cast({mean!r} as double)) / cast({std!r} as double)" if std else "0.0D"
        scaled.append(f"{value} AS `_f_{i}`")
    scale = SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")
    assemble = VectorAssembler(inputCols=[f"_f_{i}" for i in range(len(raw))], outputCol="features")
    helpers = raw + [f"_cat_{c}" for c in categories] + [f"_f_{i}" for i in range(len(raw))]
    drop = SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(_name(c) for c in helpers)}) FROM __THIS__")
    return PipelineModel([*first.stages, scale, assemble, drop])


def labelled(df: DataFrame, roles: Roles, features: PipelineModel) -> DataFrame:
    """Feature vector, 0/1 label and balancing weight."""
    ready = features.transform(add_label(df, roles))
    return add_class_weights(ready, LABEL).withColumn("label", F.col(LABEL).cast("double"))


def estimator(name: str, n_features: int, weighted: bool = True, **params):
    """An unfitted classifier by name. ``hidden`` lists the hidden layer sizes of the network."""
    common = {"labelCol": "label", "featuresCol": "features"}
    if name == NETWORK:
        hidden = list(params.pop("hidden", [100]))
        options = {"maxIter": 100, "seed": SEED, "solver": "l-bfgs"} | params
        return MultilayerPerceptronClassifier(layers=[n_features, *hidden, 2], **common, **options)
    if weighted:
        common["weightCol"] = "weight"
    if name == TREE:
        return DecisionTreeClassifier(impurity="gini", seed=SEED, **common, **({"maxDepth": 10} | params))
    if name == FOREST:
        return RandomForestClassifier(seed=SEED, **common, **({"maxDepth": 10, "numTrees": 100} | params))
    raise ValueError(f"unknown classifier {name}")


@dataclass
class Trained:
    name: str
    model: object
    params: dict = field(default_factory=dict)
    cv_score: float | None = None


def train(ready: DataFrame, name: str, grid: dict | None = None, key: str | None = None, folds: int = 3, parallelism: int = 4) -> Trained:
    """Fit one classifier; with a grid, pick its parameters by cross-validated ROC-AUC and refit."""
    n_features = len(ready.select("features").first()[0])
    if not grid:
        return Trained(name, estimator(name, n_features).fit(ready))
    base = estimator(name, n_features)
    builder = ParamGridBuilder()
    for param, values in grid.items():
        if param == "hidden":
            builder.addGrid(base.layers, [[n_features, *hidden, 2] for hidden in values])
        else:
            builder.addGrid(getattr(base, param), values)
    maps = builder.build()
    folded = stratified_folds(ready, key, "label", folds) if key else ready
    validator = CrossValidator(
        estimator=base,
        estimatorParamMaps=maps,
        evaluator=BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction"),
        numFolds=folds,
        seed=SEED,
        parallelism=parallelism,
        **({"foldCol": "fold"} if key else {}),
    )
    fitted = validator.fit(folded)
    best = max(range(len(maps)), key=lambda i: (fitted.avgMetrics[i], -i))
    return Trained(name, fitted.bestModel, {p.name: v for p, v in maps[best].items()}, fitted.avgMetrics[best])


def score(df: DataFrame, model) -> DataFrame:
    """Add ``prediction`` and ``score``, the probability of class 1. ``df`` has ``features``."""
    scored = model.transform(df)
    return scored.withColumn("score", vector_to_array("probability")[1]).drop("rawPrediction", "probability")


def update(trained: Trained, fresh: DataFrame) -> Trained:
    """Continue training on new rows, keeping the classifier's type.

    A network starts from its weights; a forest gains the trees of a new forest and keeps the newest ``MAX_TREES``; a tree is
    refitted on the rows it is given (callers pass a window of batches). Stored parameters are kept.
    """
    n_features = len(fresh.select("features").first()[0])
    params = dict(trained.params)
    if trained.name == NETWORK:
        layers = params.pop("layers", None) or trained.model.getLayers()
        hidden = list(layers)[1:-1]
        base = estimator(NETWORK, n_features, hidden=hidden).setInitialWeights(trained.model.weights)
        return Trained(NETWORK, base.fit(fresh), trained.params)
    grown = estimator(trained.name, n_features, **params).fit(fresh)
    if trained.name == FOREST:
        members = trained.model.members if isinstance(trained.model, Ensemble) else [trained.model]
        return Trained(FOREST, Ensemble([*members, grown]), trained.params)
    return Trained(trained.name, grown, trained.params)


def metrics_of(model, ready: DataFrame) -> dict[str, float]:
    row = ev.evaluate(score(ready, model), "label", "prediction", "score").first()
    return {m: row[m] for m in ("accuracy", "precision", "recall", "f1", "roc_auc")}


def importances(model, names: Sequence[str], spark, k: int = 10) -> DataFrame:
    """The ``k`` most important features of a tree model; one row per feature."""
    rows = [(n, float(model.featureImportances[i]), i) for i, n in enumerate(names)]
    table = spark.createDataFrame(rows, "feature string, importance double, ordinal int")
    return table.orderBy(F.desc("importance"), "ordinal").limit(k).drop("ordinal")


def shapley(df: DataFrame, model, names: Sequence[str], key: str, permutations: int = 16, baseline: Sequence[float] | None = None) -> DataFrame:
    """Sampled-permutation Shapley values of class 1: ``key, feature, shapley``.

    Every row walks through a few random feature orders, switching one feature at a time from the
    baseline (0, the mean of scaled features) to its own value. Callers choose the rows to explain.
    """
    width = len(names)
    rng = random.Random(SEED)
    orders = [rng.sample(range(width), width) for _ in range(permutations)]
    base = [float(v) for v in (baseline or [0.0] * width)]
    # A set of switched features is scored once a row, and counts for every order that passes it: for the feature before it, against the one after it.
    passed: dict[frozenset, list[int]] = {}
    for order in orders:
        for step in range(width + 1):
            weights = passed.setdefault(frozenset(order[:step]), [0] * width)
            if step:
                weights[order[step - 1]] += 1
            if step < width:
                weights[order[step]] -= 1
    steps = [
        F.struct(F.array(*[F.lit(i in on) for i in range(width)]).alias("on"), F.array(*[F.lit(float(w)) for w in weights]).alias("weights"))
        for on, weights in passed.items()
    ]
    walked = df.select(key, vector_to_array("features").alias("_x"), F.explode(F.array(*steps)).alias("_step"))
    mixed = F.array(*[F.when(F.col("_step.on")[i], F.get("_x", F.lit(i))).otherwise(F.lit(v)) for i, v in enumerate(base)])
    scored = score(walked.select(key, "_step.weights", array_to_vector(mixed).alias("features")), model)
    # Rows of one key walk one path after another, so each adds to a mean over all of them.
    copies = F.count(F.lit(1)) / len(steps)
    sums = scored.groupBy(key).agg(
        copies.alias("_copies"), *[F.sum(F.col("weights")[i] * F.col("score")).alias(f"_gain_{i}") for i in range(width)]
    )
    gains = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"_gain_{i}").alias("gain")) for i, n in enumerate(names)])
    return sums.select(key, "_copies", F.inline(gains)).select(key, "feature", (F.col("gain") / (permutations * F.col("_copies") ** 2)).alias("shapley"))


def best_of(results: Sequence[tuple[Trained, dict[str, float]]]) -> tuple[Trained, dict[str, float]]:
    """Highest test ROC-AUC; the first wins ties."""
    return max(results, key=lambda item: item[1]["roc_auc"])
