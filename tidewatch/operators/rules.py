"""Association rules per batch: items, frequent itemsets, rules, and re-checking of pinned rules.

Rows are first collapsed to distinct baskets with a count. A basket holds at most one item per flag
and per one-hot column, so the collapsed table stays small however many rows a batch has, and all
mining runs on it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.coerce import as_label, day_difference, split_items
from tidewatch.functions.order_stats import group_sizes, wide_quantiles
from tidewatch.roles import Mining, Roles, RuleLimits
from tidewatch.session import attach, materialize, materialize_counted, ratio, sized, stored


def top_values(df: DataFrame, roles: Roles, k: int) -> DataFrame:
    """The ``k`` most frequent values of every one-hot column per batch, ties by value."""
    by = [c for c in roles.by if c in df.columns]
    present = [c for c in roles.one_hot if c in df.columns]
    labels = [F.struct(F.lit(c).alias("column"), as_label(df, c).alias("value")) for c in present]
    cells = df.select(*by, F.inline(F.array(*labels))).where("value is not null")
    counted = cells.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = Window.partitionBy(*by, "column").orderBy(F.desc("n"), "value")
    return counted.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def transactions(df: DataFrame, roles: Roles, mining: Mining = Mining()) -> DataFrame:
    """Add ``items``, the sorted item names of each row. A missing value gives no item."""
    by = [c for c in roles.by if c in df.columns]
    columns = df.columns
    high = [(name, c) for name, c in roles.high if c in columns]
    hot = [c for c in roles.one_hot if c in columns]
    items: list[Column] = []
    for flag in roles.flags:
        if flag.column in columns:
            value = F.col(flag.column)
            items.append(F.when(value > flag.above if flag.at_least is None else value >= flag.at_least, F.lit(flag.name)))
    if roles.begin in columns and roles.end in columns:
        days = day_difference(F.col(roles.begin), F.col(roles.end))
        items.append(F.when(days >= roles.long_days, F.lit(roles.long_item)))
    if mining.include_target and roles.target in columns:
        items.append(F.when(F.col(roles.target) > 0, F.lit(roles.target_item)))
    groups = group_sizes(df, by)[1] if high or hot else 0
    if high:
        stats = wide_quantiles(df, by, sorted({c for _, c in high}), [0.75])
        stats = stats.select(*by, *[F.col(c)[0].alias(f"_q_{c}") for c in sorted({c for _, c in high})])
        df = attach(df, stats, by, groups)
        items += [F.when(F.col(c) >= F.col(f"_q_{c}"), F.lit(name)) for name, c in high]
    if hot:
        kept = top_values(df, roles, mining.top_k_values)
        label = F.concat("column", F.lit("="), "value")
        kept = kept.groupBy(*by).agg(F.collect_list(label).alias("_hot"))
        df = attach(df, kept, by, groups)
        for c in hot:
            named = F.concat(F.lit(f"{c}="), as_label(df, c))
            items.append(F.when(F.array_contains("_hot", named), named))
    listed = F.array_sort(F.array_compact(F.array(*items))) if items else F.array().cast("array<string>")
    return df.select(*columns, listed.alias("items"))


def baskets(df: DataFrame, roles: Roles, mining: Mining = Mining()) -> DataFrame:
    """Distinct item lists with their row count ``n`` and the batch size ``n_rows``, written once.

    An item that every row of a batch has says nothing; it is removed unless ``drop_constant`` is off.
    """
    by = [c for c in roles.by if c in df.columns]
    counted = transactions(df, roles, mining).groupBy(*by, "items").agg(F.count(F.lit(1)).alias("n"))
    found = stored(counted.withColumn("n_rows", F.sum("n").over(Window.partitionBy(*by))))
    if not mining.drop_constant:
        return found
    constant = item_counts(found, roles).where("n = n_rows").groupBy(*by).agg(F.collect_list("item").alias("_constant"))
    constant = materialize(constant)
    if constant.isEmpty():
        return found
    trimmed = attach(found, constant, by)
    items = F.when(F.col("_constant").isNull(), F.col("items")).otherwise(F.array_except("items", "_constant"))
    return stored(trimmed.select(*by, items.alias("items"), "n", "n_rows"))


def item_counts(found: DataFrame, roles: Roles) -> DataFrame:
    """Rows per batch and item."""
    by = [c for c in roles.by if c in found.columns]
    return found.select(*by, "n_rows", "n", F.explode("items").alias("item")).groupBy(*by, "n_rows", "item").agg(F.sum("n").alias("n"))


# Distinct baskets of a batch that one task mines at most; larger batches are grown level by level over all tasks.
BASKETS_IN_TASK = 16_384
# Sets that a task extends at a time.
BLOCK = 256


def itemsets(found: DataFrame, roles: Roles, min_support: float, in_task: int = BASKETS_IN_TASK) -> DataFrame:
    """All itemsets of any length with support of at least ``min_support``: ``batch, itemset, n, n_rows``.

    Infrequent items are removed from the baskets first; sets are then grown one item at a time from the
    frequent ones, so no basket's subsets are ever listed at once. Batches of at most ``in_task`` distinct baskets meet in
    one task each; those of larger ones stay where they are and are grown by one shuffle per level.
    """
    by = [c for c in roles.by if c in found.columns]
    frequent = item_counts(found, roles).where(_enough(min_support))
    listed = materialize(frequent.groupBy(*by).agg(F.array_sort(F.collect_list("item")).alias("_frequent")))
    kept = attach(found, listed, by).withColumn("items", F.array_intersect("items", "_frequent")).where(F.size("items") > 0)
    positions = F.transform("items", lambda item: F.array_position("_frequent", item).cast("int"))
    kept = stored(kept.groupBy(*by, "n_rows", F.array_sort(positions).alias("rest")).agg(F.sum("n").alias("n")))
    sizes, groups = materialize_counted(kept.groupBy(*by).agg(F.count(F.lit(1)).alias("_baskets")))
    kept = attach(kept, sizes, by, groups)
    small = kept.where(F.col("_baskets") <= in_task).drop("_baskets")
    fields = {f.name: f.dataType.simpleString() for f in small.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in [*by, "n_rows"]) + ", set array<int>, n long"
    grown = small.groupBy(*by, "n_rows").applyInArrow(_grow_batch([*by, "n_rows"], min_support), schema)
    if not sizes.where(F.col("_baskets") > in_task).isEmpty():
        grown = grown.unionByName(_grown(kept.where(F.col("_baskets") > in_task).drop("_baskets"), by, min_support))
    named = F.transform("set", lambda at: F.element_at("_frequent", at))
    return attach(grown, listed, by).select(*by, "n_rows", named.alias("itemset"), "n")


def _grow_batch(keys: list[str], min_support: float) -> Callable[[pa.Table], pa.Table]:
    """Grows the sets of one batch from its distinct baskets: a block of sets meets all later items by one matrix product."""

    def grow(table: pa.Table) -> pa.Table:
        rest, n = table["rest"].combine_chunks(), table["n"].to_numpy().astype("float64")
        at, n_rows = rest.flatten().to_numpy() - 1, table["n_rows"][0].as_py()
        held = np.zeros((at.max() + 1, len(n)), dtype=bool)
        held[at, np.repeat(np.arange(len(n)), rest.value_lengths().to_numpy())] = True
        weighted = (held * n).T
        waiting, sets, lengths, counts = [np.zeros((1, 0), dtype="int32")], [], [], []
        while waiting:
            block = waiting.pop()
            inside = np.ones((len(block), len(n)), dtype=bool)
            for column in block.T:
                inside &= held[column]
            found = inside @ weighted
            last = block[:, -1:] if block.shape[1] else np.full((len(block), 1), -1)
            of, item = np.nonzero((np.arange(len(held)) > last) & (found / n_rows >= min_support))
            longer = np.column_stack([block[of], item.astype("int32")])
            waiting += [longer[i : i + BLOCK] for i in range(0, len(longer), BLOCK)]
            sets.append(longer.ravel() + 1)
            lengths.append(np.full(len(longer), longer.shape[1]))
            counts.append(found[of, item])
        ends = np.cumsum(np.concatenate([[0], *lengths])).astype("int32")
        grown = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).astype("int32")))
        batch = table.select(keys).take(np.zeros(len(grown), dtype="int64"))
        return batch.append_column("set", grown).append_column("n", pa.array(np.concatenate(counts).astype("int64")))

    return grow


def _enough(min_support: float) -> Column:
    return F.col("n") / F.col("n_rows") >= F.lit(min_support)


def _grown(kept: DataFrame, by: list[str], min_support: float) -> DataFrame:
    """Level-wise growth: ``set`` and ``rest`` are positions among the batch's frequent items, and a set
    is extended by every later position its basket has. Only baskets of frequent sets go on."""
    open_sets = kept.select(*by, "n_rows", "n", F.array().cast("array<int>").alias("set"), "rest")
    levels = []
    while True:
        exploded = open_sets.select(*by, "n_rows", "n", "set", "rest", F.posexplode("rest").alias("at", "next"))
        longer = exploded.select(
            *by,
            "n_rows",
            "n",
            F.array_append("set", F.col("next")).alias("set"),
            F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"),
        )
        level, count = materialize_counted(longer.groupBy(*by, "n_rows", "set").agg(F.sum("n").alias("n")).where(_enough(min_support)))
        levels.append(level)
        if count == 0:
            break
        going_on = longer.where(F.size("rest") > 0)
        open_sets = materialize(going_on.join(sized(level.select(*by, "set"), count), by + ["set"], "left_semi"))
    result = levels[0]
    for level in levels[1:]:
        result = result.unionByName(level)
    return result


# Splits of all sets of a batch that one task tries at most; the sets of larger batches are split level by level over all tasks.
SPLITS_IN_TASK = 4_000_000


def rules(sets: DataFrame, roles: Roles, min_confidence: float, min_lift: float, in_task: int = SPLITS_IN_TASK) -> DataFrame:
    """Every split of every itemset into antecedent and consequent that passes both limits. ``sets`` are read more than once.

    Consequents are grown one item at a time. Moving an item from the antecedent to the consequent can only lower the
    confidence, so a consequent is grown only if it is confident itself, and only by later items that are confident alone.
    Batches whose sets have at most ``in_task`` splits meet in one task each; those of larger ones are joined by one shuffle per level.
    """
    by = [c for c in roles.by if c in sets.columns]
    for c in by:
        sets = sets.where(F.col(c).isNotNull())
    splits = F.sum(F.pow(F.lit(2.0), F.size("itemset")))
    large = materialize(sets.groupBy(*by).agg(splits.alias("_splits")).where(F.col("_splits") > in_task).select(*by, F.lit(True).alias("_large")))
    fields = {f.name: f.dataType.simpleString() for f in sets.schema.fields}
    schema = ", ".join([f"`{c}` {fields[c]}" for c in by] + ["support double, confidence double, lift double, antecedents_str string, consequents_str string"])
    split = _split_batch(by, min_confidence, min_lift)
    if large.isEmpty():
        return sets.groupBy(*by).applyInArrow(split, schema)
    if not by:
        return _split(sets, by, min_confidence, min_lift)
    small = sets.join(sized(large.select(*by)), by, "left_anti")
    rest = sets.join(sized(large.select(*by)), by, "left_semi")
    return small.groupBy(*by).applyInArrow(split, schema).unionByName(_split(rest, by, min_confidence, min_lift))


def _split_batch(by: list[str], min_confidence: float, min_lift: float) -> Callable[[pa.Table], pa.Table]:
    """Splits the sets of one batch. A set is a bit mask of its items (a long Python number if there are more items than bits), found by its rank."""

    def split(table: pa.Table) -> pa.Table:
        itemset = table["itemset"].combine_chunks().cast(pa.list_(pa.string()))
        n, n_rows = (table[c].to_numpy().astype("float64") for c in ("n", "n_rows"))
        lengths = itemset.value_lengths().to_numpy()
        item = itemset.flatten().dictionary_encode()
        kind = "int64" if len(item.dictionary) < 62 else object
        bits = np.array([1 << i for i in range(len(item.dictionary))], dtype=kind)
        row, bit = np.repeat(np.arange(len(lengths)), lengths), bits[item.indices.to_numpy()]
        code = np.zeros(len(lengths), dtype=kind)
        np.bitwise_or.at(code, row, bit)
        order = np.argsort(code, kind="stable")
        ranked = code[order]

        def found(wanted: np.ndarray) -> np.ndarray:
            """The rows of the wanted sets, -1 for those that there are not."""
            at = np.minimum(np.searchsorted(ranked, wanted), len(ranked) - 1)
            return np.where(ranked[at] == wanted, order[at], -1)

        def confident(of: np.ndarray, right: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
            left = found(code[of] ^ right)
            kept = (left >= 0) & (n[of] / n[left] >= min_confidence)
            return of[kept], right[kept], last[kept], left[kept]

        several = lengths[row] > 1
        level = confident(row[several], bit[several], bit[several])
        alone = np.zeros(len(lengths), dtype=kind)
        np.bitwise_or.at(alone, level[0], level[1])
        levels, size = [level], 1
        while len(level[0]):
            of, right, last, _ = (part[lengths[level[0]] - size > 1] for part in level)
            later = alone[of] & ~((last << 1) - 1)
            longer = [np.flatnonzero((later & b) != 0) for b in bits]
            of, right = (np.concatenate([part[at] for at in longer]) for part in (of, right))
            last = np.repeat(bits, [len(at) for at in longer])
            level = confident(of, right | last, last)
            levels.append(level)
            size += 1
        of, right, _, left = (np.concatenate(parts) for parts in zip(*levels))
        right = found(right)
        confidence = n[of] / n[left]
        lift = confidence / (n[right] / n_rows[of])
        kept = (right >= 0) & (lift >= min_lift)
        names = pc.binary_join(itemset, ", ")
        first = np.zeros(int(kept.sum()), dtype="int64")
        columns = {"support": n[of] / n_rows[of], "confidence": confidence, "lift": lift}
        columns = {c: pa.array(v[kept]) for c, v in columns.items()}
        columns |= {c: names.take(pa.array(v[kept])) for c, v in (("antecedents_str", left), ("consequents_str", right))}
        return pa.table({c: table[c].take(first) for c in by} | columns)

    return split


def _split(sets: DataFrame, by: list[str], min_confidence: float, min_lift: float) -> DataFrame:
    """Level-wise splits: a join per level finds the antecedents."""
    support = sets.select(*by, F.col("itemset").alias("antecedent"), F.col("n").alias("n_antecedent"))
    kept = [*by, "n_rows", "n", "itemset", "antecedent", "consequent"]
    confident = F.col("n") / F.col("n_antecedent") >= F.lit(min_confidence)
    single = sets.where(F.size("itemset") > 1).select(*by, "n_rows", "n", "itemset", F.explode("itemset").alias("item"))
    single = single.withColumns({"consequent": F.array("item"), "antecedent": F.array_except("itemset", F.array("item"))})
    level, count = materialize_counted(single.join(support, by + ["antecedent"]).where(confident).select(*kept, "n_antecedent"))
    alone = level.groupBy(*by, "itemset").agg(F.array_sort(F.flatten(F.collect_list("consequent"))).alias("alone"))
    growing = level.where(F.size("antecedent") > 1)
    levels = [level]
    if count:
        growing = growing.join(alone, by + ["itemset"])
    while count:
        later = F.filter("alone", lambda item: item > F.element_at("consequent", -1))
        longer = growing.select(*kept, "alone", F.explode(later).alias("item"))
        longer = longer.withColumns(
            {"consequent": F.array_append("consequent", F.col("item")), "antecedent": F.array_except("antecedent", F.array("item"))}
        )
        joined = longer.join(support, by + ["antecedent"]).where(confident)
        level, count = materialize_counted(joined.select(*kept, "n_antecedent", "alone"))
        levels.append(level.drop("alone"))
        growing = level.where(F.size("antecedent") > 1)
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    right = support.withColumnsRenamed({"antecedent": "consequent", "n_antecedent": "n_consequent"})
    joined = found.join(right, by + ["consequent"])
    n, n_rows = F.col("n").cast("double"), F.col("n_rows").cast("double")
    confidence = n / F.col("n_antecedent")
    return joined.select(
        *by,
        (n / n_rows).alias("support"),
        confidence.alias("confidence"),
        (confidence / (F.col("n_consequent") / n_rows)).alias("lift"),
        F.array_join("antecedent", ", ").alias("antecedents_str"),
        F.array_join("consequent", ", ").alias("consequents_str"),
    ).where(F.col("lift") >= min_lift)


ORDER = (F.desc, "lift"), (F.desc, "confidence"), (F.desc, "support"), (F.asc, "antecedents_str"), (F.asc, "consequents_str")


def top_rules(found: DataFrame, roles: Roles, k: int) -> DataFrame:
    """The ``k`` best rules of each batch by lift, confidence, support; ties by text."""
    order = [direction(c) for direction, c in ORDER]
    by = [c for c in roles.by if c in found.columns]
    if not by:
        return found.orderBy(*order).limit(k)
    ranked = Window.partitionBy(*by).orderBy(*order)
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).drop("rank")


def mine(df: DataFrame, roles: Roles, mining: Mining = Mining()) -> DataFrame:
    """Items, itemsets, rules and top-k in one go."""
    sets = stored(itemsets(baskets(df, roles, mining), roles, mining.min_support))
    return top_rules(rules(sets, roles, mining.min_confidence, mining.min_lift), roles, mining.top_k_rules)


# The thresholds tried, in this nesting, when the first ones give too few rules.
RELAXED_SUPPORTS = (0.03, 0.02, 0.01)
RELAXED_CONFIDENCES = (0.4, 0.3, 0.2)
RELAXED_LIFTS = (1.05, 1.0)


def mine_relaxed(
    df: DataFrame,
    roles: Roles,
    mining: Mining = Mining(),
    supports: Sequence[float] = RELAXED_SUPPORTS,
    confidences: Sequence[float] = RELAXED_CONFIDENCES,
    lifts: Sequence[float] = RELAXED_LIFTS,
) -> DataFrame:
    """Top rules of the whole table under the first thresholds that give ``top_k_rules`` of them.

    Mining runs once at the loosest thresholds; every combination is then one conditional count in
    the same aggregate. If no combination suffices the last one is used.
    """
    grid = [(mining.min_support, mining.min_confidence, mining.min_lift)]
    for s in (mining.min_support, *supports):
        for c in (mining.min_confidence, *confidences):
            for lift in (mining.min_lift, *lifts):
                if (s, c, lift) not in grid or (s, c, lift) == (supports[-1], confidences[-1], lifts[-1]):
                    grid.append((s, c, lift))
    loosest = [min(cell[i] for cell in grid) for i in range(3)]
    sets = stored(itemsets(baskets(df, roles, mining), roles, loosest[0]))
    found = materialize(rules(sets, roles, loosest[1], loosest[2]))

    def passes(cell: tuple[float, float, float]) -> Column:
        return (F.col("support") >= cell[0]) & (F.col("confidence") >= cell[1]) & (F.col("lift") >= cell[2])

    counts = found.agg(*[F.count(F.when(passes(cell), 1)).alias(f"c{i}") for i, cell in enumerate(grid)]).first()
    chosen = next((cell for cell, n in zip(grid, counts) if n >= mining.top_k_rules), grid[-1])
    picked = top_rules(found.where(passes(chosen)), roles, mining.top_k_rules)
    return picked.withColumns({n: F.lit(v) for n, v in zip(("min_support", "min_confidence", "min_lift"), chosen)})


def recheck(found: DataFrame, reference: DataFrame, roles: Roles, limits: RuleLimits = RuleLimits()) -> DataFrame:
    """Support and confidence of the reference rules in each batch's baskets, with drop flags.

    An inverted index from items to rules meets the items of the distinct baskets; a basket holds a rule's side if as many of
    the side's items met it as the side has. So baskets meet only rules that they share an item with, however many rules are pinned.
    """
    by = [c for c in roles.by if c in found.columns]
    parsed = reference.select(
        F.array_distinct(split_items(F.col("antecedents_str"))).alias("antecedents"),
        F.array_distinct(split_items(F.col("consequents_str"))).alias("consequents"),
        F.col("support").alias("support_ref"),
        F.col("confidence").alias("confidence_ref"),
        F.col("lift").alias("lift_ref"),
    ).where((F.size("antecedents") > 0) & (F.size("consequents") > 0))
    pinned = materialize(parsed.withColumn("_rule", F.monotonically_increasing_id()))
    sides = F.array_union("antecedents", "consequents")
    index = pinned.select(
        "_rule", F.size("antecedents").alias("_left"), F.size(sides).alias("_both"), "antecedents", F.explode(sides).alias("item")
    ).withColumn("_in_left", F.array_contains("antecedents", F.col("item")).cast("int")).drop("antecedents")
    held = stored(found.withColumn("_basket", F.monotonically_increasing_id()))
    met = held.select(*by, "n", "_basket", F.explode("items").alias("item")).join(sized(index), "item")
    shared = met.groupBy(*by, "_basket", "_rule", "n", "_left", "_both").agg(F.sum("_in_left").alias("_met_left"), F.count(F.lit(1)).alias("_met_both"))
    has_left, has_both = F.col("_met_left") == F.col("_left"), F.col("_met_both") == F.col("_both")
    counted = shared.groupBy(*by, "_rule").agg(
        F.sum(F.when(has_left, F.col("n")).otherwise(0)).alias("antecedent_count"), F.sum(F.when(has_both, F.col("n")).otherwise(0)).alias("both_count")
    )
    # One row per batch and rule, also where no basket met the rule.
    totals = held.groupBy(*by).agg(F.sum("n").alias("n_rows")).where("n_rows is not null")
    every = totals.join(sized(pinned), F.lit(True))
    counted = every.join(counted, by + ["_rule"], "left").fillna(0, ["antecedent_count", "both_count"])
    measured = counted.select(
        *by,
        *[c for c in pinned.columns if c != "_rule"],
        "n_rows",
        ratio(F.col("both_count"), F.col("n_rows")).alias("support_new"),
        ratio(F.col("both_count"), F.col("antecedent_count")).alias("confidence_new"),
        "antecedent_count",
        "both_count",
        (F.col("antecedent_count") < limits.min_antecedent_count).alias("low_sample"),
    )

    def flag(condition: Column) -> Column:
        return ~F.col("low_sample") & F.coalesce(condition, F.lit(False))

    return measured.withColumns(
        {
            "flag_conf_drop": flag(F.col("confidence_new") < F.col("confidence_ref") * limits.confidence_drop_ratio),
            "flag_support_drop": flag(F.col("support_new") < F.col("support_ref") * limits.support_drop_ratio),
            "flag_conf_abs": flag(F.col("confidence_new") < limits.min_confidence_abs),
        }
    )


def consistency(checked: DataFrame, roles: Roles) -> DataFrame:
    """One row per batch: rules checked and whether any of them raised a flag."""
    by = [c for c in roles.by if c in checked.columns]
    any_flag = F.col("flag_conf_drop") | F.col("flag_support_drop") | F.col("flag_conf_abs")
    return checked.groupBy(*by).agg(
        F.first("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_rules_checked"), F.bool_or(any_flag).alias("any_issue")
    )
