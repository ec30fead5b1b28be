"""Costs that must not grow with the sets times their splits, or with the passes over small groups."""

from pyspark.sql import functions as F

from tidewatch.functions import order_stats
from tidewatch.operators import rules
from tidewatch.roles import Roles
from tidewatch.sources.tables import FIXTURE


def test_sets_of_a_batch_are_split_in_its_task(spark, policies, monkeypatch):
    sets = rules.itemsets(rules.baskets(policies, FIXTURE), FIXTURE, 0.03).localCheckpoint()
    plain = lambda found: sorted(tuple(r) for r in found.select("batch_num", "support", "confidence", "lift", "antecedents_str", "consequents_str").collect())
    levels = plain(rules.rules(sets, FIXTURE, 0.4, 1.05, in_task=0))
    sizes = sets.groupBy("batch_num").agg(F.sum(F.expr("pow(2, size(itemset))")).alias("n")).agg(F.min("n"), F.max("n")).first()
    assert sizes[0] < sizes[1] and plain(rules.rules(sets, FIXTURE, 0.4, 1.05, in_task=int(sizes[0]))) == levels
    monkeypatch.setattr(rules, "_split", None)
    assert plain(rules.rules(sets, FIXTURE, 0.4, 1.05)) == levels and len(levels) > 1000
    assert rules.rules(sets.limit(0), FIXTURE, 0.4, 1.05).isEmpty()


def test_sets_over_more_items_than_bits(spark):
    baskets = [(1, [f"i{k:03}", f"i{k + 1:03}", f"i{(k * 7) % 100:03}"], 1 + k % 3, 200) for k in range(99)]
    found = spark.createDataFrame([(b, sorted(set(i)), n, r) for b, i, n, r in baskets], "batch_num long, items array<string>, n long, n_rows long")
    sets = rules.itemsets(found, FIXTURE, 0.005).localCheckpoint()
    plain = lambda found: sorted(tuple(r) for r in found.collect())
    assert sets.select(F.explode("itemset")).distinct().count() == 100
    got = plain(rules.rules(sets, FIXTURE, 0.3, 1.0))
    assert got == plain(rules.rules(sets, FIXTURE, 0.3, 1.0, in_task=0)) and len(got) > 300
    whole = rules.rules(sets.drop("batch_num"), Roles(), 0.3, 1.0)
    assert plain(whole) == sorted(r[1:] for r in got)


def test_small_groups_are_sorted_in_one_pass(spark, monkeypatch):
    value = F.when(F.col("id") % 9 == 0, F.lit(None)).when(F.col("id") % 31 == 0, F.lit(float("nan"))).otherwise(F.sin("id") * F.exp(F.col("id") % 40 - 20))
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, 0).when(F.col("id") < 2950, F.col("id") % 30).alias("g"), value.alias("v"), (F.col("id") % 5).cast("int").alias("w"), F.lit(None).cast("double").alias("none"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    plain = lambda found: sorted(((r["g"], r["column"], tuple(r["q"])) for r in found.collect()), key=str)
    columns = ["v", "w", "none"]
    slow = plain(order_stats.quantiles(rows, ["g"], columns, probs, in_task=0))
    assert plain(order_stats.quantiles(rows, ["g"], columns, probs, in_task=100)) == slow and len(slow) > 50
    known = rows.where("g is not null")
    slow = [r for r in slow if r[0] is not None]
    monkeypatch.setattr(order_stats, "_located", None)
    assert plain(order_stats.quantiles(known, ["g"], columns, probs)) == slow
    assert order_stats.quantiles(known.limit(0), ["g"], columns, probs).isEmpty()
    assert len(order_stats.quantiles(known, [], columns, probs).collect()) == 2
