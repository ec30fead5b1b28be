"""The given tables, and the policy-shaped view that stands in for the policy files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.roles import Allowed, Flag, Range, Roles
from tidewatch.session import materialize, stored

BATCH_ROWS = 1000

# Roles of the ``policies`` view.
FIXTURE = Roles(
    begin="insr_begin",
    end="insr_end",
    time="insr_begin",
    allowed=(Allowed("sex", (0, 1, 2)), Allowed("insr_type", ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"))),
    ranges=(Range("prod_year", 1996, 2000), Range("seats_num", 1, 40, "seats_out_of_range")),
    non_negative=("insured_value", "premium", "claim_paid"),
    zero_default=("claim_paid", "insured_value", "carrying_capacity", "seats_num"),
    flags=(Flag("premium_gt_0", "premium", above=0), Flag("seats_ge_5", "seats_num", at_least=5)),
    high=(("premium_high", "premium"), ("insured_value_high", "insured_value")),
    one_hot=("insr_type", "usage", "make", "sex"),
    target="claim_paid",
    monitored_numeric=("claim_paid", "insured_value", "premium", "prod_year", "seats_num", "sex"),
    monitored_categorical=("insr_type", "usage", "make"),
    identifier="object_id",
    median_features=("premium", "prod_year", "seats_num", "carrying_capacity"),
    zero_features=("insured_value",),
    categorical_features=("sex", "insr_type", "make", "usage"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def policies(spark: SparkSession, folder: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """One policy-shaped row per order; ``o_orderkey`` is dense, so it gives the batch number."""
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.max("l_shipdate").alias("insr_end"),
            F.max("l_extendedprice").alias("insured_value"),
            F.max("l_quantity").alias("seats_num"),
            F.nullif(F.min("l_tax"), F.lit(0.0)).alias("carrying_capacity"),
            F.max(
                F.when((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.08), F.col("l_extendedprice")).otherwise(0.0)
            ).alias("claim_paid"),
        )
    )
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .select(
            F.col("o_orderkey").alias("object_id"),
            F.expr(f"o_orderkey div {batch_rows} + 1").alias("batch_num"),
            F.col("o_orderdate").alias("insr_begin"),
            "insr_end",
            F.col("o_orderpriority").alias("insr_type"),
            F.col("o_orderstatus").alias("usage"),
            F.col("c_mktsegment").alias("make"),
            (F.col("c_nationkey") % 4).alias("sex"),
            "insured_value",
            F.col("c_acctbal").alias("premium"),
            "seats_num",
            "carrying_capacity",
            F.year("o_orderdate").alias("prod_year"),
            "claim_paid",
        )
    )


def stored_policies(spark: SparkSession, folder: str, batch_rows: int = BATCH_ROWS, packed: bool = False) -> DataFrame:
    """The same rows written once, for operators that read their input several times: the view is a
    join and an aggregate, which would otherwise be repeated for every pass. ``packed`` rows take a fifth of the disk."""
    return (stored if packed else materialize)(policies(spark, folder, batch_rows))


def events(spark: SparkSession, folder: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """The event table with a batch number from its dense key."""
    return table(spark, folder, "events").withColumn("batch_num", F.expr(f"event_id div {batch_rows} + 1"))
