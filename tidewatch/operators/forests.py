"""One random forest out of many: the node tables of saved forests are put together and loaded as a single model."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import scratch_folder

# Ageing: a forest that grows by updates keeps its newest trees, at most this many.
MAX_TREES = 1000
STAGE = "stages/*_RandomForestClassifi*"


def _plain(path: str) -> str:
    """A path without scheme and escapes, as Hadoop and Spark write them differently."""
    return unquote(urlparse(path).path).rstrip("/")


def _described(spark: SparkSession, folders: list[str]) -> list[tuple[str, dict]]:
    """Stage folder, as the scan names it, and saved description of the forest in each pipeline folder; one row a forest."""
    lines = spark.read.text([f"{folder}/{STAGE}/metadata" for folder in folders])
    found = {}
    for row in lines.select(F.col("_metadata.file_path").alias("path"), "value").where("value <> ''").collect():
        stage = row["path"].rsplit("/metadata/", 1)[0]
        found[_plain(stage.rsplit("/stages/", 1)[0])] = (stage, json.loads(row["value"]))
    absent = [folder for folder in folders if _plain(folder) not in found]
    if absent:
        raise FileNotFoundError(f"no saved forest in {absent[0]}")
    return [found[_plain(folder)] for folder in folders]


def _renumbered(spark: SparkSession, folders: list[str], table: str, tree: str, places: DataFrame) -> DataFrame:
    """The trees of all forests in one table, numbered one after another; trees that are too old are left out."""
    rows = spark.read.parquet(*[f"{folder}/{STAGE}/{table}" for folder in folders])
    stage = F.substring_index(F.col("_metadata.file_path"), f"/{table}/", 1)
    columns = rows.columns
    placed = rows.withColumn("_stage", stage).join(F.broadcast(places), "_stage").where(F.col(tree) >= F.col("_first"))
    return placed.withColumn(tree, (F.col(tree) - F.col("_first") + F.col("_shift")).cast("int")).select(*columns)


def merge_forests(spark: SparkSession, folders: list[str], target: str, max_trees: int = MAX_TREES) -> RandomForestClassificationModel:
    """The forests saved in the pipeline folders, oldest first, as one model, which is also saved at ``target``.

    Every tree votes with one weight, so the score is the mean of the forests' scores by their number of trees. Of more than
    ``max_trees`` trees the newest stay. All tables are read in one scan, however many folders there are. A folder counts once; forests
    over another number of features or classes are refused.
    """
    folders = list(dict.fromkeys(folders))[-max_trees:]
    forests = _described(spark, folders)
    shapes = {(d["numFeatures"], d["numClasses"]) for _, d in forests}
    if len(shapes) > 1:
        raise ValueError(f"forests of different shapes cannot be one: {sorted(shapes)}")
    room, places = max_trees, []
    for stage, described in reversed(forests):
        kept = min(room, described["numTrees"])
        room -= kept
        places.append((stage, described["numTrees"] - kept, room))
    total = max_trees - room
    kept = [(stage, first, at - room) for stage, first, at in places]
    table = spark.createDataFrame(kept, "_stage string, _first int, _shift int")  # one row per forest, at most max_trees
    _renumbered(spark, folders, "data", "treeID", table).write.parquet(f"{target}/data")
    _renumbered(spark, folders, "treesMetadata", "_1", table).write.parquet(f"{target}/treesMetadata")
    described = forests[-1][1]
    described = described | {"numTrees": total, "paramMap": described["paramMap"] | {"numTrees": total}}
    spark.createDataFrame([(json.dumps(described),)], "value string").coalesce(1).write.text(f"{target}/metadata")
    return RandomForestClassificationModel.load(target)


@dataclass
class Ensemble:
    """A forest that grew by updates. Members are fitted forests or the folders of saved ones, oldest first.

    It scores as one model: one pass and a plan of constant size, whatever the number of members.
    """

    members: list
    max_trees: int = MAX_TREES
    _merged: RandomForestClassificationModel | None = field(default=None, repr=False, compare=False)

    def model(self) -> RandomForestClassificationModel:
        if self._merged is None:
            spark = SparkSession.active()
            root, folders = scratch_folder(spark), []
            for i, member in enumerate(self.members):
                folders.append(member if isinstance(member, str) else f"{root}/part{i}")
                if not isinstance(member, str):
                    PipelineModel([member]).save(folders[-1])
            self._merged = merge_forests(spark, folders, f"{root}/merged", self.max_trees)
        return self._merged

    @property
    def getNumTrees(self) -> int:
        return self.model().getNumTrees

    @property
    def featureImportances(self):
        return self.model().featureImportances

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model().transform(df)
