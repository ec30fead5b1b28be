"""Model versions on shared storage: a fitted pipeline per version and one metadata row each."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.operators.forests import Ensemble
from tidewatch.operators.models import Trained

SCHEMA = """version int, batch_id long, ts timestamp, path string, metrics map<string,double>, params map<string,string>,
is_incremental boolean, parent_version int, members array<string>, run_id string, model_name string"""

CHAMPION_SCHEMA = "model_name string, version int, selected_at string, after long"


class Registry:
    """Append-only: every registration is a new version in a new folder, and its row is written last.

    A registration that names a ``run_id`` already known for the model and kind is a retry and adds nothing.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> DataFrame:
        """All versions, one row each."""
        path = f"{self.root}/versions"
        if not _exists(self.spark, path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).json(path).drop("v")

    def find(self, model_name: str, run_id: str | None, is_incremental: bool):
        """The version that a run registered, or None."""
        if run_id is None:
            return None
        same = (F.col("model_name") == model_name) & (F.col("run_id") == run_id) & (F.col("is_incremental") == is_incremental)
        return self.versions().where(same).orderBy("version").first()

    def register(
        self,
        features: PipelineModel,
        trained: Trained,
        metrics: dict[str, float],
        batch_id: int | None = None,
        is_incremental: bool = False,
        parent_version: int | None = None,
        run_id: str | None = None,
    ) -> int:
        """Save features and classifier together; returns the version number.

        A child that only adds members to its parent saves the new ones and points to the parent's.
        """
        same = self.find(trained.name, run_id, is_incremental)
        if same is not None:
            return same["version"]
        mine = F.col("model_name") == trained.name
        version = (self.versions().where(mine).agg(F.max("version")).first()[0] or 0) + 1
        path = f"{self.root}/models/{trained.name}/v{version}-{uuid.uuid4().hex[:12]}"
        members = trained.model.members if isinstance(trained.model, Ensemble) else [trained.model]
        held = []
        if parent_version is not None and len(members) > 1:
            parent = self.versions().where(mine & (F.col("version") == parent_version)).first()
            held = list(parent["members"])[: len(members) - 1] if parent is not None else []
        for i, member in enumerate(members[len(held) :], len(held)):
            if isinstance(member, str):  # saved before, with an earlier version
                held.append(member)
                continue
            stages = [*features.stages, member] if i == 0 else [member]
            PipelineModel(stages).save(f"{path}/part{i}")
            held.append(f"{path}/part{i}")
        params = {k: json.dumps(v) for k, v in trained.params.items()}
        record = (
            version, batch_id, datetime.now(timezone.utc), path, {k: float(v) for k, v in metrics.items() if v is not None},
            params, is_incremental, parent_version, held, run_id,
        )
        schema = SCHEMA.rsplit(",", 1)[0]
        table = self.spark.createDataFrame([record], schema)
        table.coalesce(1).write.mode("errorifexists").json(f"{self.root}/versions/model_name={trained.name}/v={version}")
        return version

    def load(self, model_name: str, version: int) -> tuple[PipelineModel, Trained, dict[str, float]]:
        """Feature pipeline, classifier and metrics of one version. Members of a grown forest are read together when it scores."""
        row = self.versions().where((F.col("model_name") == model_name) & (F.col("version") == version)).first()
        if row is None:
            raise KeyError(f"{model_name} v{version} is not registered")
        first = PipelineModel.load(row["members"][0])
        model = Ensemble(list(row["members"])) if len(row["members"]) > 1 else first.stages[-1]
        params = {k: json.loads(v) for k, v in (row["params"] or {}).items()}
        return PipelineModel(first.stages[:-1]), Trained(model_name, model, params), dict(row["metrics"])

    def best(self, metric: str = "roc_auc", model_name: str | None = None):
        """Name and version with the highest metric; missing counts as lowest, the first wins ties."""
        rows = self.versions() if model_name is None else self.versions().where(F.col("model_name") == model_name)
        value = F.coalesce(F.col("metrics")[metric], F.lit(float("-inf")))
        order = F.struct((-value).alias("v"), F.col("ts"), F.col("version"))
        return rows.agg(F.min_by(F.struct("model_name", "version"), order).alias("r")).first()["r"]

    def latest(self, model_name: str):
        rows = self.versions().where(F.col("model_name") == model_name)
        return rows.agg(F.max_by(F.struct("model_name", "version"), "version").alias("r")).first()["r"]

    def reigns(self) -> DataFrame:
        """Every promotion: ``model_name, version, after, until``; the version reigned over the batches ``after < b <= until``.

        The first reign also covers all batches before it, the last all later ones (null bounds). Of promotions after the same batch the
        last one counts; the others have empty intervals.
        """
        path = f"{self.root}/champion"
        if not _exists(self.spark, path):
            return self.spark.createDataFrame([], CHAMPION_SCHEMA).selectExpr("model_name", "version", "after", "after AS until")
        rows = self.spark.read.schema(CHAMPION_SCHEMA).json(path)
        rows = rows.withColumn("_after", F.coalesce("after", F.lit(-(2**63)).cast("bigint")))
        order = Window.orderBy("_after", "selected_at", "version")  # one row per promotion
        placed = rows.withColumn("until", F.lead("_after").over(order)).withColumn("_least", F.min("_after").over(Window.partitionBy()))
        after = F.when(F.col("_after") > F.col("_least"), F.col("_after"))
        return placed.where("until is null or _after < until").select("model_name", "version", after.alias("after"), "until")

    def champion(self) -> dict | None:
        """The reigning version, as last promoted."""
        path = f"{self.root}/champion"
        if not _exists(self.spark, path):
            return None
        row = self.spark.read.schema(CHAMPION_SCHEMA).json(path).orderBy(F.desc("selected_at"), F.desc("version")).first()
        return None if row is None else {"model_name": row["model_name"], "version": row["version"]}

    def promote(self, model_name: str, version: int, metrics: dict[str, float], improvement: float = 0.01, after: int | None = None) -> bool:
        """Make a version champion if there is none or its F1 beats the reigning one by enough.

        ``after`` is the last batch it has learned from; it reigns over the batches that follow.
        """
        reigning = self.champion()
        if reigning is not None:
            row = self.versions().where((F.col("model_name") == reigning["model_name"]) & (F.col("version") == reigning["version"])).first()
            held = dict(row["metrics"]) if row is not None else {}
            if not ("f1" in metrics and "f1" in held and metrics["f1"] > held["f1"] + improvement):
                return False
        record = [(model_name, version, datetime.now(timezone.utc).isoformat(), after)]
        table = self.spark.createDataFrame(record, CHAMPION_SCHEMA)
        table.coalesce(1).write.mode("append").json(f"{self.root}/champion")
        return True


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
