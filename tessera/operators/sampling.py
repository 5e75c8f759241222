"""Deterministic sampling, splits, budgets, repeats and shards.

Every choice comes from a hash or an explicit order, so results don't depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import hash_fraction


def hash_sample(df: DataFrame, fraction: float, seed: str, *keys: str) -> DataFrame:
    return df if fraction >= 1 else df.where(hash_fraction(seed, *keys) < fraction)


def hash_split(df: DataFrame, validation: float, seed: str, *keys: str) -> DataFrame:
    """Adds ``split``: validation where the hash is below the fraction, else train."""
    return df.withColumn("split", F.when(hash_fraction(seed, *keys) < validation, "validation").otherwise("train"))


def token_budget_prefix(df: DataFrame, cell: Sequence[str], order: Sequence[Column | str], tokens: str, budget: int) -> DataFrame:
    """Rows of each cell in order until the running total is nearest to the budget.

    The row that crosses the budget goes if leaving it out is strictly nearer.
    """
    w = Window.partitionBy(*cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(tokens).over(w), F.lit(0))
    left = F.lit(budget) - F.col("_before")
    out = df.withColumn("_before", before)
    return out.where((left > 0) & ((F.col(tokens) <= left) | (left >= F.abs(left - F.col(tokens))))).drop("_before")


def quota_scan(df: DataFrame, cell: Sequence[str], order: Sequence[Column | str], tokens: str, target: Column) -> DataFrame:
    """Rows of each cell in order as long as the total before them is below the target."""
    w = Window.partitionBy(*cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_before", F.coalesce(F.sum(tokens).over(w), F.lit(0))).where(F.col("_before") < target).drop("_before")


def stratified_repeat(df: DataFrame, cell: Sequence[str], stratum: str, order: Sequence[Column | str], target: int, max_epochs: float) -> DataFrame:
    """``target`` rows of each (cell, stratum), cycling through its rows at most max_epochs times; adds ``epoch`` from 1.

    Row r of n comes ceil((target - r + 1) / n) times, bounded by floor(n * max_epochs + 1e-9) rows in all.
    """
    group = Window.partitionBy(*cell, stratum)
    rows = df.withColumn("_r", F.row_number().over(group.orderBy(*order))).withColumn("_n", F.count("*").over(group))
    total = F.least(F.lit(target), F.floor(F.col("_n") * F.lit(float(max_epochs)) + F.lit(1e-9)))
    times = F.ceil((total - F.col("_r") + 1) / F.col("_n")).cast("int")
    rows = rows.withColumn("_times", times).where("_times >= 1")
    return rows.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times").cast("long")))).drop("_r", "_n", "_times")


def validation_pick(df: DataFrame, selected: DataFrame, key: str, pool: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """n rows of each pool that were not selected."""
    rest = df.join(selected.select(key).distinct(), key, "left_anti")
    return rest.withColumn("_r", F.row_number().over(Window.partitionBy(*pool).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def positions(df: DataFrame, order: str) -> DataFrame:
    """Adds ``position`` from 0 in the order of a column, without gathering rows: ranges are counted, then numbered inside.

    The order column should be unique.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = ", ".join(str((k + 1) / parts) for k in range(max(1, parts - 1)))
    bounds = sorted(set(df.agg(F.expr(f"percentile_approx({order}, array({cuts}), 10000)").alias("q")).first()["q"] or []))
    where = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>"), lambda b: b < F.col(order)))
    rows = df.withColumn("_range", where)
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_size"))
    offset = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_range", "_offset")  # a row per range
    numbered = rows.withColumn("_r", F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1).join(F.broadcast(offset), "_range")
    return numbered.withColumn("position", (F.col("_offset") + F.col("_r")).cast("long")).drop("_range", "_r", "_offset")


def modulo_shard(positioned: DataFrame, world: int, rank: int | None = None) -> DataFrame:
    out = positioned.withColumn("shard", F.pmod("position", F.lit(world)).cast("long"))
    return out if rank is None else out.where(F.col("shard") == rank)


def contiguous_shard(positioned: DataFrame, world: int) -> DataFrame:
    """Contiguous blocks; the first (n mod world) blocks hold one row more."""
    n = positioned.count()
    base, extra = divmod(n, world)
    p = F.col("position")
    block = F.when(p < extra * (base + 1), F.floor(p / (base + 1))).otherwise(extra + F.floor((p - extra * (base + 1)) / max(base, 1)))
    return positioned.withColumn("shard", block.cast("long"))


def repeat_ratio(positioned: DataFrame, ratio: float, seed: str, key: str) -> DataFrame:
    """floor(ratio) whole copies and, of the rest, the rows whose hash is below the fraction; adds ``copy`` from 1."""
    whole, part = int(ratio), ratio - int(ratio)
    times = F.lit(whole) + F.when(hash_fraction(seed, key) < part, 1).otherwise(0)
    rows = positioned.withColumn("_times", times).where("_times > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times").cast("long")))).drop("_times")


def split_ranges(positioned: DataFrame, split: str) -> DataFrame:
    """"99,1,0" -> contiguous train, validation and test ranges with half-even rounded borders; adds ``split``."""
    weights = [float(x) for x in split.split(",")]
    weights = [w / sum(weights) for w in weights] + [0.0] * (3 - len(weights))
    n = positioned.count()
    borders = [0]
    for w in weights:
        borders.append(borders[-1] + round(w * n))
    borders[-1] = n
    p = F.col("position")
    return positioned.withColumn("split", F.when(p < borders[1], "train").when(p < borders[2], "validation").otherwise("test"))


def depth_decay(df: DataFrame, key: str, valid: str, ratio: float, floor: float, depth: int) -> Column:
    """How many positions depth d keeps: int(valid * max(ratio ** d, floor))."""
    return F.floor((F.col(valid) - depth) * F.lit(max(ratio**depth, floor))).cast("long")


def shuffled(df: DataFrame, seed: str, *keys: str) -> DataFrame:
    """A seeded order as a sort; every row once."""
    return df.orderBy(F.md5(F.concat_ws("\x1f", F.lit(seed), *[F.col(k).cast("string") for k in keys])), *keys)
