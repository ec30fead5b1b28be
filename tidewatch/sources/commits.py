"""Several report tables that change together: a run's tables become visible by one commit, or not at all.

A run writes each table under ``<root>/<table>/run=<n>`` and then one line of ``<root>/committed/run=<n>``, the
batches that the run covers. Readers take, for every batch, the newest committed run that covers it, from all tables alike. A run that
stopped before its commit is never read, and the next run writes over what it left. One writer at a time works on a root.

The batch number is a column of the files, so a run over many batches has few files. Runs that were written in folders by batch
are read as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import materialize, sized
from tidewatch.sources.files import path_exists


def committed_runs(spark: SparkSession, root: str) -> DataFrame:
    """(run, batch_num) of every committed run."""
    if not path_exists(spark, f"{root}/committed/run=*/_SUCCESS"):
        return spark.createDataFrame([], "run long, batch_num long")
    return spark.read.schema("batch_num long, run long").parquet(f"{root}/committed").select("run", "batch_num")


def next_run(spark: SparkSession, root: str) -> int:
    return (committed_runs(spark, root).agg(F.max("run")).first()[0] or 0) + 1


def write_run(tables: dict[str, DataFrame], batches: DataFrame, root: str, by: list[str]) -> int:
    """Write all ``tables``, whose key is ``by``, as a new run over ``batches`` (one column, the batch number) and commit it."""
    spark = batches.sparkSession
    run = next_run(spark, root)
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{root}/{name}/run={run}")
    batches.toDF("batch_num").select(F.col("batch_num").cast("bigint")).coalesce(1).write.mode("overwrite").parquet(f"{root}/committed/run={run}")
    return run


def read_committed(spark: SparkSession, root: str, name: str, batch: str = "batch_num") -> DataFrame | None:
    """The rows of a table that count now; None before the first commit. Only folders of committed runs are read."""
    newest = materialize(committed_runs(spark, root).groupBy("batch_num").agg(F.max("run").alias("run")))
    runs = [r[0] for r in newest.select("run").distinct().orderBy("run").collect()]
    # A run by folders may have no rows for a table, and then no schema either.
    folders = {r: path_exists(spark, f"{root}/{name}/run={r}/{batch}=*") for r in runs}
    plain = [r for r in runs if not folders[r] and path_exists(spark, f"{root}/{name}/run={r}/*.parquet")]
    found = None
    for group in ([r for r in runs if folders[r]], plain):
        if group:
            paths = [f"{root}/{name}/run={r}" for r in group]
            part = spark.read.option("basePath", f"{root}/{name}").option("mergeSchema", True).parquet(*paths)
            part = part.withColumns({batch: F.col(batch).cast("bigint"), "run": F.col("run").cast("bigint")})
            found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    if found is None:
        return None
    return found.join(sized(newest.withColumnRenamed("batch_num", batch)), [batch, "run"], "left_semi").drop("run")
