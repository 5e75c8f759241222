"""Allocation: water-filling, rounding and token budgets.

The pure functions work on cell tables that a driver holds (a row per pool, language and task); the DataFrame
forms do the same with windows where a closed form exists.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def waterfill(total: float, weights: Mapping[str, float], caps: Mapping[str, float], tolerance: float = 1e-9) -> dict[str, float]:
    """Shares in proportion to weight, none above its cap; what capped ones leave goes to the others."""
    out = dict.fromkeys(weights, 0.0)
    open_ = {k for k, w in weights.items() if w > 0 and caps[k] > 0}
    left = float(total)
    while open_ and left > tolerance:
        scale = left / sum(weights[k] for k in open_)
        full = {k for k in open_ if out[k] + scale * weights[k] >= caps[k] - tolerance}
        if not full:
            for k in open_:
                out[k] += scale * weights[k]
            break
        for k in full:
            left -= caps[k] - out[k]
            out[k] = float(caps[k])
        open_ -= full
    return out


def largest_remainder(parts: Mapping[str, float], total: int | None = None, reverse_ties: bool = False) -> dict[str, int]:
    """Whole numbers that sum to total: floors, then one more for the largest fractions (ties by key)."""
    total = round(sum(parts.values())) if total is None else total
    out = {k: math.floor(v + 1e-9) for k, v in parts.items()}
    order = sorted(parts, reverse=reverse_ties)
    order.sort(key=lambda k: -(parts[k] - out[k]))
    for k in order[: max(0, total - sum(out.values()))]:
        out[k] += 1
    return out


def waterfill_frame(cells: DataFrame, group: Sequence[str], key: str, weight: str, cap: str, total: Column) -> DataFrame:
    """Closed form by windows: cells in order of cap / weight; the capped ones are a prefix.  Adds ``share``."""
    g = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    before = g.orderBy(F.col(cap) / F.col(weight), key).rowsBetween(Window.unboundedPreceding, -1)
    level = (total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (F.sum(weight).over(g) - F.coalesce(F.sum(weight).over(before), F.lit(0.0)))
    rows = cells.withColumn("_level", level)
    free = F.when(F.col("_level") * F.col(weight) <= F.col(cap), F.struct(F.col(cap) / F.col(weight), F.col(key), F.col("_level").alias("level")))
    rows = rows.withColumn("_free", F.min(free).over(g))
    return rows.withColumn("share", F.least(F.col(cap).cast("double"), F.coalesce(F.col("_free.level"), F.lit(float("inf"))) * F.col(weight))).drop("_level", "_free")


def largest_remainder_frame(cells: DataFrame, group: Sequence[str], key: str, part: str) -> DataFrame:
    """Adds ``rounded``: floors plus one for the largest fractions, so each group keeps its rounded total."""
    g = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    floor = F.floor(F.col(part) + 1e-9)
    rows = cells.withColumns({"_f": floor, "_left": F.round(F.sum(part).over(g)) - F.sum(floor).over(g)})
    rank = F.row_number().over(g.orderBy(F.desc(F.round(F.col(part) - F.col("_f"), 9)), key))
    return rows.withColumn("rounded", (F.col("_f") + F.when(rank <= F.col("_left"), 1).otherwise(0)).cast("long")).drop("_f", "_left")


def equal_token_plan(cells: DataFrame, budget: int, max_epochs: float, tasks: Sequence[str], languages: Sequence[str]) -> DataFrame:
    """budget / (tasks * languages) tokens for each cell of both lists, capped by its tokens * epochs.

    cells: lang, task, records, text_tokens -> lang, task, target_tokens, planned_tokens, target_records, shortfall.
    """
    spark = cells.sparkSession
    each = budget / (len(tasks) * len(languages))
    every = spark.createDataFrame([(x, t) for x in languages for t in tasks], "lang string, task string")
    rows = every.join(cells, ["lang", "task"], "left").fillna({"records": 0, "text_tokens": 0})
    planned = F.least(F.lit(each), F.col("text_tokens") * F.lit(float(max_epochs)))
    average = F.try_divide(F.col("text_tokens").cast("double"), F.col("records"))
    return rows.select(
        "lang",
        "task",
        F.round(F.lit(each), 6).alias("target_tokens"),
        F.round(planned, 6).alias("planned_tokens"),
        F.coalesce(F.floor(F.try_divide(planned, average) + 1e-9), F.lit(0)).cast("long").alias("target_records"),
        F.round(F.lit(each) - planned, 6).alias("shortfall"),
    )


def capped_example_plan(cells: Sequence[Mapping], budget: int, temperature: float, caps: Mapping[str, int], max_epochs: float) -> dict[tuple[str, str], float]:
    """Records of each (task, lang) cell: task probabilities from capped counts to the power 1 / temperature, languages by
    water-filling inside a task, and the total found by bisection so that the tokens meet the budget.

    cells: mappings with task, lang, records, text_tokens.
    """
    tasks: dict[str, list[Mapping]] = {}
    for c in cells:
        tasks.setdefault(c["task"], []).append(c)
    weight = {t: min(sum(c["records"] for c in own), caps.get(t, math.inf)) ** (1 / temperature) for t, own in tasks.items()}
    scale = sum(weight.values()) or 1.0

    def plan(total: float) -> dict[tuple[str, str], float]:
        out = {}
        for t, own in tasks.items():
            shares = waterfill(total * weight[t] / scale, {c["lang"]: 1.0 for c in own}, {c["lang"]: c["records"] * max_epochs for c in own})
            out.update({(t, lang): n for lang, n in shares.items()})
        return out

    average = {(c["task"], c["lang"]): c["text_tokens"] / c["records"] if c["records"] else 0.0 for c in cells}
    tokens = lambda p: sum(n * average[k] for k, n in p.items())
    low, high = 0.0, sum(c["records"] for c in cells) * max_epochs * max(1, len(tasks))
    if tokens(plan(high)) <= budget:
        return plan(high)
    for _ in range(64):
        mid = (low + high) / 2
        low, high = (mid, high) if tokens(plan(mid)) < budget else (low, mid)
    return plan(low)


def pool_allocation(target: float, primary: Mapping[str, float], fallback: Mapping[str, float], quality: Mapping[str, float], family: Mapping[str, str], family_cap: float, fallback_share: float) -> dict[str, float]:
    """Records from each pool: primary pools by quality, then fallback pools up to their share; no family above family_cap * target;
    what is missing then is filled from whatever capacity is left."""
    capacity = {**primary, **fallback}
    out = dict.fromkeys(capacity, 0.0)
    room = {f: family_cap * target for f in set(family.values())}

    def fill(pools: Sequence[str], amount: float, capped: bool) -> None:
        want = waterfill(amount, {p: quality[p] for p in pools}, {p: capacity[p] - out[p] for p in pools})
        for p in pools:
            n = min(want[p], room[family[p]]) if capped else want[p]
            out[p] += n
            room[family[p]] -= n

    fill(sorted(primary), target * (1 - fallback_share) if fallback else target, True)
    if fallback:
        fill(sorted(fallback), min(target * fallback_share, target - sum(out.values())), True)
    fill(sorted(primary), target - sum(out.values()), True)
    fill(sorted(capacity), max(0.0, target - sum(out.values())), False)
    return out


def balanced_targets(total: int, capacity: Mapping[str, int]) -> dict[str, int]:
    """Equal whole shares below each capacity; extras in key order."""
    out = dict.fromkeys(capacity, 0)
    left = min(total, sum(capacity.values()))
    while left > 0:
        open_ = [k for k in sorted(capacity) if out[k] < capacity[k]]
        each, extra = divmod(left, len(open_))
        for i, k in enumerate(open_):
            n = min(capacity[k] - out[k], each + (1 if i < extra else 0))
            out[k] += n
            left -= n
    return out


def blend_sizes(total: int, weights: Sequence[float], surplus: float = 0.005) -> list[int]:
    """Samples to make of each dataset so that a weighted draw of ``total`` never runs dry."""
    whole = sum(weights)
    return [math.ceil(math.ceil(total * w / whole) * (1 + surplus)) for w in weights]


def epochs_needed(tokens_per_epoch: int, wanted: int) -> int:
    return math.ceil(wanted / tokens_per_epoch) if tokens_per_epoch else 0


def allocate_counts_frame(cells: DataFrame, group: Sequence[str], key: str, weight: str, total: Column) -> DataFrame:
    """Adds ``records``: a whole share of the group's total by weight; what floors leave goes to the largest fractions, of equal
    ones to the last key.  Groups are cells of one parent, a row each."""
    whole = Window.partitionBy(*group)
    exact = cells.withColumns({"_total": total.cast("long"), "_exact": total * F.col(weight) / F.sum(weight).over(whole)})
    exact = exact.withColumns({"_floor": F.floor("_exact"), "_part": F.round(F.col("_exact") - F.floor("_exact"), 9)})
    left = F.col("_total") - F.sum("_floor").over(whole)
    rank = F.row_number().over(whole.orderBy(F.desc("_part"), F.desc(key)))
    return exact.withColumn("records", F.col("_floor") + F.when(rank <= left, 1).otherwise(0)).drop("_total", "_exact", "_floor", "_part")


def normalised(weight: Column | str, *by: str) -> Column:
    """The weight's share of the sum, over all rows or within groups."""
    w = F.col(weight) if isinstance(weight, str) else weight
    return w / F.sum(w).over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1)))  # a row per source
