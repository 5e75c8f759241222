"""Batches of a training run by arithmetic on dense positions, and seeded orders without a window over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import hash_fraction


def hash_order(df: DataFrame, by: Sequence[str], u: str, ties: Sequence[str], bins: int = 1024) -> DataFrame:
    """Adds ``place``: 0, 1, ... in the order of the fraction ``u`` (then ``ties``) within ``by``.

    Rows are counted by bin of u first and numbered inside a bin, so no window holds more than a bin.
    """
    rows = df.withColumn("_bin", F.floor(F.col(u) * bins))
    sizes = rows.groupBy(*by, "_bin").agg(F.count("*").alias("_c"))
    before = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # a row per bin
    offset = sizes.select(*by, "_bin", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_bin").orderBy(u, *ties)) - 1).join(offset, [*by, "_bin"])
    return rows.withColumn("place", (F.col("_o") + F.col("_r")).cast("long")).drop("_bin", "_o", "_r")


def sequential_batches(positioned: DataFrame, micro: int, world: int, drop_last: bool = True, pad_to: int | None = None) -> DataFrame:
    """(position, total) -> step, rank and the row's place in its micro-batch.

    micro * world positions in order make a step, micro of them go to each rank.  drop_last: an incomplete last step goes;
    else it stays as it is or, with ``pad_to`` (a global batch size), positions -1, -2, ... fill it up.
    """
    every = micro * world
    rows = positioned.withColumn("_at", F.col("position"))
    if drop_last:
        rows = rows.where(F.floor(F.col("_at") / every) < F.floor(F.col("total") / every))
    elif pad_to:
        total = positioned.agg(F.max("total").alias("total")).where("total > 0")  # one row
        pads = total.select("total", F.explode(F.sequence(F.lit(1), F.lit(pad_to))).alias("_k")).where(F.col("_k") <= F.pmod(-F.col("total"), F.lit(pad_to)))
        pads = pads.select((-F.col("_k")).cast("long").alias("position"), "total", (F.col("total") + F.col("_k") - 1).alias("_at"))
        rows = rows.unionByName(pads, allowMissingColumns=True)
    inside = F.pmod("_at", F.lit(every))
    out = rows.withColumns({"step": F.floor(F.col("_at") / every), "rank": F.floor(inside / micro), "place": F.pmod(inside, F.lit(micro)).cast("long")})
    return out.drop("_at")


def random_batches(positioned: DataFrame, micro: int, world: int, seed: str, consumed: int = 0) -> DataFrame:
    """(position, total) -> step and rank of what is left of the epoch after ``consumed`` samples.

    Each rank owns a run of positions and takes it in an order of hashes of seed, epoch and position; positions that
    fill no whole step take no part.
    """
    every = micro * world
    steps = F.floor(F.col("total") / every)
    active = steps * every
    rows = positioned.where(steps > 0).withColumns({"epoch": F.floor(F.lit(consumed) / active), "_skip": F.floor(F.pmod(F.lit(consumed), active) / world)})
    rows = rows.withColumn("rank", F.floor(F.col("position") / (steps * micro))).where(F.col("rank") < world)
    rows = hash_order(rows.withColumn("_u", hash_fraction(seed, "epoch", "position")), ["rank"], "_u", ["position"])
    left = F.col("place") - F.col("_skip")
    return rows.where(left >= 0).withColumn("step", F.floor(left / micro)).drop("_u", "_skip", "place")


def document_index(docs: DataFrame, key: str, epochs: int, seed: str, separate_final: bool) -> DataFrame:
    """Each document once an epoch, in hashed order over all epochs -> key, epoch, position.

    separate_final: the last epoch comes after all others, in an order of its own.
    """
    rows = docs.select(key).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    last = F.lit(separate_final and epochs > 1) & (F.col("epoch") == epochs - 1)
    rows = rows.withColumns({"_last": last, "_u": hash_fraction(seed, "epoch", key)})
    before = docs.count() * (epochs - 1)
    out = hash_order(rows, ["_last"], "_u", ["epoch", key])
    return out.select(key, F.col("epoch").cast("long").alias("epoch"), (F.col("place") + F.when(F.col("_last"), F.lit(before)).otherwise(F.lit(0))).alias("position"))


def throughput(tokens: Column | str, seconds: Column | str) -> Column:
    """Tokens a second; null where nothing was timed or made."""
    n, s = (F.col(c) if isinstance(c, str) else c for c in (tokens, seconds))
    return F.when((n > 0) & (s > 0), n / s)
