import random
from itertools import combinations

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from tidewatch.operators import rules
from tidewatch.roles import Flag, Mining, Roles
from tidewatch.sources.tables import FIXTURE


@pytest.fixture(scope="module")
def found(policies):
    return rules.baskets(policies, FIXTURE)


def brute_force(baskets, n_rows, support):
    counts = {}
    for items, n in baskets:
        for size in range(1, len(items) + 1):
            for chosen in combinations(sorted(items), size):
                counts[chosen] = counts.get(chosen, 0) + n
    return {k: n for k, n in counts.items() if n / n_rows >= support}


def test_itemsets_match_brute_force(found):
    got = rules.itemsets(found, FIXTURE, 0.05).where("batch_num = 2").collect()
    local = [(r["items"], r["n"]) for r in found.where("batch_num = 2").collect()]
    assert {tuple(r["itemset"]): r["n"] for r in got} == brute_force(local, 250, 0.05)


def test_itemsets_match_spark_mining(found):
    one = found.where("batch_num = 1").selectExpr("explode(sequence(1, int(n))) as copy", "items").drop("copy")
    mined = FPGrowth(itemsCol="items", minSupport=0.1).fit(one).freqItemsets.collect()
    got = rules.itemsets(found.where("batch_num = 1"), FIXTURE, 0.1).collect()
    assert {tuple(r["itemset"]): r["n"] for r in got} == {tuple(sorted(r["items"])): r["freq"] for r in mined}


def test_support_falls_with_length(found):
    sets = {(r["batch_num"], tuple(r["itemset"])): r["n"] for r in rules.itemsets(found, FIXTURE, 0.05).collect()}
    for (batch, items), n in sets.items():
        for shorter in combinations(items, len(items) - 1):
            assert not shorter or sets[(batch, shorter)] >= n


ROLES = Roles(flags=(Flag("rich", "v", above=10), Flag("old", "w", at_least=5)), one_hot=("k",))


def small(spark):
    rows = [(1, 20.0, 9.0, 1.0), (1, 20.0, 9.0, 1.0), (1, 20.0, 1.0, 2.0), (1, None, 7.0, None), (2, 20.0, 9.0, 1.0), (2, 30.0, 9.0, 1.0)]
    return spark.createDataFrame(rows, "batch_num long, v double, w double, k double")


def test_items_labels_and_missing(spark):
    rows = rules.transactions(small(spark), ROLES).collect()
    assert sorted(r["items"] for r in rows if r["batch_num"] == 1) == [["k=1", "old", "rich"], ["k=1", "old", "rich"], ["k=2", "rich"], ["old"]]


def test_constant_items_are_removed(spark):
    found = rules.baskets(small(spark), ROLES)
    assert [r["items"] for r in found.where("batch_num = 2").collect()] == [[]]
    kept = rules.baskets(small(spark), ROLES, Mining(drop_constant=False))
    assert [r["items"] for r in kept.where("batch_num = 2").collect()] == [["k=1", "old", "rich"]]


def test_recheck_counts_and_flags(spark):
    reference = spark.createDataFrame([(0.9, 0.9, 1.2, "rich", "k=1"), (0.1, 0.5, 1.0, "", "old")], "support double, confidence double, lift double, antecedents_str string, consequents_str string")
    from tidewatch.roles import RuleLimits

    checked = rules.recheck(rules.baskets(small(spark), ROLES), reference, ROLES, RuleLimits(min_antecedent_count=1))
    rows = {r["batch_num"]: r for r in checked.collect()}
    assert len(rows) == 2
    assert (rows[1]["antecedent_count"], rows[1]["both_count"], rows[1]["support_new"]) == (3, 2, 0.5)
    assert not rows[1]["flag_support_drop"] and not rows[1]["flag_conf_abs"]
    assert rows[2]["antecedent_count"] == 0 and rows[2]["low_sample"] and not rows[2]["flag_conf_drop"]
    issues = {r["batch_num"]: r["any_issue"] for r in rules.consistency(checked, ROLES).collect()}
    assert issues == {1: False, 2: False}
    default = rules.recheck(rules.baskets(small(spark), ROLES), reference, ROLES)
    assert default.where("low_sample").count() == 2


def test_relaxing_finds_enough_rules(policies):
    strict = Mining(min_support=0.9, min_confidence=0.99, min_lift=3.0)
    got = rules.mine_relaxed(policies.drop("batch_num"), FIXTURE, strict)
    assert got.count() == 5 and got.first()["min_support"] < 0.9


def test_rules_by_growing_consequents_as_all_splits(spark):
    rng = random.Random(5)
    items = "abcdefg"
    rows = [sorted(rng.sample(items, rng.randint(1, 6))) for _ in range(120)]
    found = spark.createDataFrame([(r, 1, 120) for r in rows], "items array<string>, n long, n_rows long").groupBy("items", "n_rows").agg(F.sum("n").alias("n"))
    sets = rules.itemsets(found, Roles(), 0.05)
    got = {(r.antecedents_str, r.consequents_str): (round(r.confidence, 9), round(r.lift, 9)) for r in rules.rules(sets, Roles(), 0.3, 0.9).collect()}
    n = {c: sum(set(c) <= set(r) for r in rows) for k in range(1, 8) for c in combinations(items, k)}
    want = {}
    for whole in (c for c in n if len(c) > 1 and n[c] / 120 >= 0.05):
        for k in range(1, len(whole)):
            for left in combinations(whole, k):
                right = tuple(i for i in whole if i not in left)
                confidence = n[whole] / n[left]
                lift = confidence / (n[right] / 120)
                if confidence >= 0.3 and lift >= 0.9:
                    want[", ".join(left), ", ".join(right)] = (round(confidence, 9), round(lift, 9))
    assert got == want and max(len(right.split(", ")) for _, right in want) > 1


def test_thousands_of_pinned_rules_meet_baskets_by_items(spark):
    rng = random.Random(6)
    items = [f"i{k}" for k in range(60)]
    baskets = list({tuple(sorted(rng.sample(items, rng.randint(1, 12)))): rng.randint(1, 9) for _ in range(80)}.items())
    pinned = []
    for _ in range(10_000):
        picked = rng.sample(items, rng.randint(2, 4))
        cut = rng.randint(1, len(picked) - 1)
        pinned.append((0.1, 0.2, 1.1, ", ".join(picked[:cut]), ", ".join(picked[cut:])))
    found = spark.createDataFrame([(list(b), n, 400) for b, n in baskets], "items array<string>, n long, n_rows long")
    reference = spark.createDataFrame(pinned, "support double, confidence double, lift double, antecedents_str string, consequents_str string")
    checked = rules.recheck(found, reference, Roles()).collect()
    assert len(checked) == len(pinned) and {r.n_rows for r in checked} == {sum(n for _, n in baskets)}
    held = [(set(b), n) for b, n in baskets]
    for r in checked[::50]:
        left, both = set(r.antecedents), {*r.antecedents, *r.consequents}
        assert (r.antecedent_count, r.both_count) == (sum(n for b, n in held if left <= b), sum(n for b, n in held if both <= b))
