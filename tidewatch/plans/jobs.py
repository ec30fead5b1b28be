"""User-level jobs: collect, analyse, train and follow, update, score, summarise."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import drift, models, profile, quality, rules
from tidewatch.operators.clean import clean
from tidewatch.operators.evaluate import batch_performance
from tidewatch.operators.features import LABEL, add_label, stratified_split
from tidewatch.operators.registry import Registry
from tidewatch.plans import report
from tidewatch.roles import Limits, Roles
from tidewatch.session import materialize, sized, stored
from tidewatch.sources import commits, sinks
from tidewatch.sources.files import path_exists, read_csv, read_sources, typed_policies


@dataclass(frozen=True)
class Store:
    """Where a deployment keeps its tables, all under one shared root."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name in ("raw", "profiles", "analyzed", "dq", "consistency", "drift", "rules", "reference", "performance", "scored", "registry", "runs", "landed", "ledger"):
            return f"{self.root.rstrip('/')}/{name}"
        raise AttributeError(name)


def collect(spark: SparkSession, sources: Sequence[str], store: Store, roles: Roles, batch_rows: int = 5000) -> DataFrame:
    """Cut the sources into batches, store them raw, and profile every column of every new batch.

    The batch counter goes on from the batches stored before, which stay as they are.
    """
    rows = read_sources(spark, sources, batch_rows)
    if path_exists(spark, store.raw):
        before = spark.read.parquet(store.raw).agg(F.max("batch_num")).first()[0] or 0
        rows = rows.withColumn("batch_num", F.col("batch_num") + F.lit(before).cast("bigint"))
    rows = materialize(rows)
    sinks.write_batches(rows.drop("row_index", "batch_index"), store.raw)
    typed = typed_policies(rows.drop("source", "row_index", "batch_index"))
    table = profile.column_profile(typed, roles)
    table.write.mode("append").parquet(store.profiles)
    return profile.batch_profile(typed, roles)


@dataclass
class Analysis:
    dq: DataFrame
    checked: DataFrame
    consistency: DataFrame
    drift: DataFrame
    rules: DataFrame
    cleaned: DataFrame


def analyze(df: DataFrame, roles: Roles, reference: DataFrame, reference_rules: DataFrame, limits: Limits = Limits()) -> Analysis:
    """Quality before and after, rule check, drift and fresh rules of every batch in ``df``.

    ``reference`` holds the rows of the pinned reference batch; its batch number may be in ``df``.
    """
    cleaned, dq = quality.clean_with_report(df, roles, limits.quality, limits.cleaning)
    cleaned = stored(cleaned)
    found = rules.baskets(df, roles, limits.mining)
    checked = rules.recheck(found, reference_rules, roles, limits.rules)
    pinned = drift.first_batch(reference, roles)
    others = df.where(F.col(roles.batch) != pinned)
    reports = drift.detect(others.unionByName(reference.select(*df.columns)), roles, pinned, limits.drift)
    mined = rules.rules(
        stored(rules.itemsets(rules.baskets(cleaned, roles, limits.mining), roles, limits.mining.min_support)),
        roles,
        limits.mining.min_confidence,
        limits.mining.min_lift,
    )
    return Analysis(
        dq=dq,
        checked=checked,
        consistency=rules.consistency(checked, roles),
        drift=reports,
        rules=rules.top_rules(mined, roles, limits.mining.top_k_rules),
        cleaned=cleaned,
    )


def pin_reference(df: DataFrame, store: Store, roles: Roles) -> DataFrame:
    """The reference batch's rows: those stored first, for ever."""
    spark = df.sparkSession
    if not path_exists(spark, f"{store.reference}/_SUCCESS"):
        first = drift.first_batch(df, roles)
        df.where(F.col(roles.batch) == first).write.mode("ignore").parquet(store.reference)
    return spark.read.schema(df.schema).parquet(store.reference)


def repin_reference(df: DataFrame, store: Store, roles: Roles, limits: Limits = Limits()) -> None:
    """Replace the pinned rows and rules by those of ``df``, all rows of the reference batch, when more of it has come."""
    df.write.mode("overwrite").parquet(store.reference)
    mined = rules.mine(df.drop(roles.batch), roles, limits.mining)
    mined.select("support", "confidence", "lift", "antecedents_str", "consequents_str").coalesce(1).write.mode("overwrite").parquet(f"{store.rules}/reference")


def run_analysis(df: DataFrame, store: Store, roles: Roles, limits: Limits = Limits()) -> None:
    """Analyse the batches of ``df`` and write every report under the store. Safe to repeat.

    All tables of the run are committed together under ``store.runs`` (see ``read_reports``); the plain folders by batch are a copy that
    is brought up to date afterwards.
    """
    spark = df.sparkSession
    reference = pin_reference(df, store, roles)
    pinned = sinks.pin_rules(
        spark, f"{store.rules}/reference", lambda: rules.mine(reference.drop(roles.batch), roles, limits.mining)
    )
    result = analyze(df, roles, reference, pinned, limits)
    present = materialize(df.select(roles.batch).distinct())
    tables = {
        "dq": result.dq,
        "consistency": result.consistency,
        "drift": result.drift.join(present, roles.by, "left_semi"),
        "rules": result.rules,
        "analyzed": result.cleaned,
    }
    tables = {name: table if name == "analyzed" else materialize(table) for name, table in tables.items()}
    commits.write_run(tables, present, store.runs, roles.by)
    publish(tables, store, roles)


def read_reports(spark: SparkSession, store: Store, name: str, roles: Roles) -> DataFrame | None:
    """``dq``, ``consistency``, ``drift``, ``rules`` or ``analyzed`` as of the last committed run of every batch; None before the first."""
    return commits.read_committed(spark, store.runs, name, roles.batch)


def publish(tables: dict[str, DataFrame], store: Store, roles: Roles) -> None:
    """Copies of a run's tables in plain folders by batch, for readers that know nothing of runs."""
    sinks.write_reports(tables["dq"], store.dq, roles)
    sinks.write_reports(tables["consistency"], store.consistency, roles)
    sinks.write_reports(tables["drift"], store.drift, roles)
    sinks.write_reports(tables["rules"], f"{store.rules}/batches", roles)
    sinks.write_analyzed(tables["analyzed"], store.analyzed, roles)


def build_reference_rules(df: DataFrame, roles: Roles, n_batches: int = 1, limits: Limits = Limits()) -> DataFrame:
    """Reference rules from the first batches that there are, cleaned batch by batch, thresholds relaxed if need be."""
    first = materialize(df.select(roles.batch).where(F.col(roles.batch).isNotNull()).distinct().orderBy(roles.batch).limit(n_batches))
    chosen = clean(df.join(sized(first), roles.batch, "left_semi").select(*df.columns), roles, limits.cleaning)
    return rules.mine_relaxed(chosen.drop(roles.batch), roles, limits.mining)


def train_models(
    df: DataFrame, roles: Roles, registry: Registry, names: Sequence[str] = models.MODEL_NAMES, grids: dict | None = None, batch_id: int | None = None
) -> list[tuple[models.Trained, dict[str, float], int]]:
    """Fit, tune and evaluate the classifiers on a stratified split; register all, promote the best.

    ``batch_id`` names the run: the same one again registers nothing new.
    """
    run = None if batch_id is None else f"train {batch_id}"
    split = materialize(stratified_split(add_label(df, roles), roles.identifier, LABEL))
    features = models.fit_features(split.where("not is_test"), roles)
    ready = materialize(models.labelled(split.where("not is_test"), roles, features))
    held_out = materialize(models.labelled(split.where("is_test"), roles, features))
    results = []
    for name in names:
        trained = models.train(ready, name, (models.GRIDS if grids is None else grids).get(name), roles.identifier)
        metrics = models.metrics_of(trained.model, held_out)
        results.append((trained, metrics, registry.register(features, trained, metrics, batch_id, run_id=run)))
    best = max(results, key=lambda r: r[1]["roc_auc"])
    registry.promote(best[0].name, best[2], best[1], after=batch_id)
    return results


def score_batches(df: DataFrame, roles: Roles, registry: Registry, version: dict | None = None) -> DataFrame:
    """Add ``prediction`` and ``score`` by the champion, or by the given version. The target is not needed."""
    held = version or registry.champion()
    if held is None:
        raise LookupError("no champion registered")
    features, trained, _ = registry.load(**held)
    return models.score(features.transform(df), trained.model).drop("features")


def reigning(df: DataFrame, roles: Roles, registry: Registry) -> DataFrame:
    """Batch number, ``model_name`` and ``version`` of the champion that reigned when the batch came: an as-of join of batches to reigns."""
    batches = df.select(roles.batch).where(F.col(roles.batch).isNotNull()).distinct()
    b, after, until = F.col(roles.batch), F.col("after"), F.col("until")
    within = (after.isNull() | (b > after)) & (until.isNull() | (b <= until))
    return batches.join(F.broadcast(registry.reigns()), within).select(roles.batch, "model_name", "version")  # one row per promotion


def follow(df: DataFrame, roles: Roles, registry: Registry, store: Store) -> DataFrame:
    """Score every batch with the champion that reigned when it came; accuracy, weighted F1 and time per batch, appended to the history.

    All batches of one champion are scored by one distributed job, so the number of jobs follows the promotions, not the batches. A batch's
    ``inference_time`` is its share, by rows, of the job's time.
    """
    if registry.champion() is None:
        raise LookupError("no champion registered")
    placed = materialize(reigning(df, roles, registry))
    rows = None
    for held in placed.select("model_name", "version").distinct().orderBy("model_name", "version").collect():
        own = placed.where((F.col("model_name") == held["model_name"]) & (F.col("version") == held["version"])).select(roles.batch)
        started = time.time()
        scored = score_batches(df.join(sized(own), roles.batch, "left_semi").select(*df.columns), roles, registry, held.asDict())
        scored = materialize(add_label(scored, roles).select(*roles.by, LABEL, "prediction"))
        seconds = time.time() - started
        share = F.col("n") / F.lit(float(max(scored.count(), 1)))
        part = batch_performance(scored, roles.by, LABEL, "prediction").select(
            *roles.by, "accuracy", "f1", (F.lit(seconds) * share).alias("inference_time"), F.current_timestamp().alias("ts")
        )
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        return df.sparkSession.createDataFrame([], sinks.PERFORMANCE_SCHEMA)
    rows = materialize(rows)
    sinks.append_performance(rows, store.performance, roles)
    return rows


def batch_numbers(df: DataFrame, roles: Roles) -> list[int]:
    """The batch numbers present, ascending. Jobs that go batch by batch hold one number per batch."""
    return [r[0] for r in df.select(roles.batch).distinct().orderBy(roles.batch).collect() if r[0] is not None]


def update_model(df: DataFrame, roles: Roles, registry: Registry, model_name: str | None = None, batch_id: int | None = None) -> dict:
    """Continue training the latest version of a model on new batches and register the child version.

    Part of the new rows is held out, so before and after are compared on rows not trained on. ``batch_id`` names
    the run: the same one again registers nothing new.
    """
    run = None if batch_id is None else f"update {batch_id}"
    if model_name is None:
        best = registry.best("roc_auc")
        if best is None:
            raise LookupError("no model is registered")
        model_name = best["model_name"]
    done = registry.find(model_name, run, True)
    if done is not None:
        after = dict(done["metrics"])
        return {"model_name": model_name, "version": done["version"], "before": {}, "after": after, "promoted": registry.promote(model_name, done["version"], after, after=batch_id)}
    parent = registry.latest(model_name)
    if parent is None:
        raise LookupError(f"{model_name} is not registered")
    features, trained, _ = registry.load(model_name, parent["version"])
    split = materialize(stratified_split(add_label(df, roles), roles.identifier, LABEL))
    fresh = materialize(models.labelled(split.where("not is_test"), roles, features))
    held_out = materialize(models.labelled(split.where("is_test"), roles, features))
    before = models.metrics_of(trained.model, held_out)
    grown = models.update(trained, fresh)
    after = models.metrics_of(grown.model, held_out)
    version = registry.register(features, grown, after, batch_id, True, parent["version"], run)
    return {"model_name": model_name, "version": version, "before": before, "after": after, "promoted": registry.promote(model_name, version, after, after=batch_id)}


def run_pipeline(
    df: DataFrame,
    roles: Roles,
    store: Store,
    initial: int = 3,
    update_every: int = 5,
    max_batches: int | None = None,
    names: Sequence[str] = models.MODEL_NAMES,
    grids: dict | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """Train on the first batches, update the champion every few batches, and score every later batch with the champion of its time.

    Updates follow one another, as each starts from the last; all scoring comes after them, see ``follow``. Batches are counted as they come, so their numbers may have gaps. All are used unless the caller sets
    ``max_batches``.
    """
    registry = Registry(df.sparkSession, store.registry)
    numbers = batch_numbers(df, roles)[:max_batches]
    batch = F.col(roles.batch)
    used = df.where((batch >= numbers[0]) & (batch <= numbers[-1]))
    run_analysis(used, store, roles, limits)
    train_models(used.where(batch <= numbers[:initial][-1]), roles, registry, names, grids, batch_id=numbers[:initial][-1])
    for at in range(initial, len(numbers), update_every):
        part = numbers[at : at + update_every]
        if len(part) == update_every:
            window = used.where((batch >= part[0]) & (batch <= part[-1]))
            update_model(window, roles, registry, registry.champion()["model_name"], batch_id=part[-1])
    if len(numbers) > initial:
        follow(used.where(batch > numbers[initial - 1]), roles, registry, store)
    return df.sparkSession.read.schema(sinks.PERFORMANCE_SCHEMA).parquet(store.performance)


def run_update(df: DataFrame, roles: Roles, store: Store, model_name: str = models.FOREST, max_batches: int | None = None, limits: Limits = Limits()) -> dict:
    """Quality analysis and one model update on the new batches, or the first ``max_batches`` of them."""
    numbers = batch_numbers(df, roles)[:max_batches]
    used = df.where(F.col(roles.batch) <= numbers[-1])
    run_analysis(used, store, roles, limits)
    return update_model(used, roles, Registry(df.sparkSession, store.registry), model_name, batch_id=numbers[-1])


def run_inference(spark: SparkSession, path: str, output: str, roles: Roles, store: Store) -> DataFrame:
    """Score one CSV file with the champion and write it back with ``predict``."""
    typed = typed_policies(read_csv(spark, path))
    scored = score_batches(typed, roles, Registry(spark, store.registry))
    sinks.write_scored(scored, output)
    return scored


def run_summary(spark: SparkSession, store: Store, roles: Roles) -> DataFrame:
    """The full report as one JSON row, from whatever history exists."""
    registry = Registry(spark, store.registry)
    versions = registry.versions().select(
        "model_name", "version", "ts", F.col("metrics")["accuracy"].alias("accuracy"), F.col("metrics")["f1"].alias("f1"), "params", "metrics"
    )
    sections = {"model_metrics": report.model_metrics(versions), "model_selection_history": report.selection_history(versions)}
    held = registry.champion()
    if held:
        reigning = (F.col("model_name") == held["model_name"]) & (F.col("version") == held["version"])
        sections["best_model"] = versions.where(reigning).select("model_name", "version", "metrics")
        sections["hyperparameters"] = versions.where(reigning).select("model_name", "params")
    if path_exists(spark, store.dq) and path_exists(spark, store.consistency):
        newest = [sinks.read_newest(spark, path, roles, 1) for path in (store.dq, store.consistency)]
        sections["data_quality"] = report.latest_quality(*newest, roles)
    if path_exists(spark, store.performance):
        sections["performance"] = report.performance(spark.read.parquet(store.performance), roles)
    if path_exists(spark, store.drift):
        reports = sinks.read_newest(spark, store.drift, roles, schema=DRIFT_SCHEMA)
        sections["drift"] = report.drift_overview(reports, roles)
    return report.full_report(**sections)


DRIFT_SCHEMA = """batch_num long, n_rows long, drift_detected boolean, drift_type string, confidence double,
affected_features array<struct<feature string, drift_type string, confidence double, test string,
q1_change_percent double, q3_change_percent double, statistic double, p_value double>>,
concept_shift_confidence double, target_distribution_change double, quality_issues boolean,
missing_value_drift double, outlier_drift double, anomalies array<struct<type string, severity double>>"""
