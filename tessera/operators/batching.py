"""Batches: length groups, buckets, padding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import hash_fraction


def length_groups(ranked: DataFrame, world: int, batch: int, seed: str, epoch: int = 0) -> DataFrame:
    """rows with ``position`` (0 from the longest) -> rank, chunk and the order of the chunk in this epoch.

    Neighbours in length go to different ranks; a rank's rows are cut into chunks of ``batch``, and chunks are
    shuffled by a hash of seed and epoch.
    """
    p = F.col("position")
    rank, place = F.pmod(p, F.lit(world)), F.floor(p / world)
    chunk = F.floor(place / batch)
    return ranked.withColumns({"rank": rank.cast("long"), "chunk": chunk.cast("long"), "chunk_key": F.md5(F.concat_ws("\x1f", F.lit(seed), F.lit(str(epoch)), chunk.cast("string")))})


def length_order(df: DataFrame, length: str, key: str, block: int = 256) -> DataFrame:
    """Adds ``position`` by length descending, then key: counted by length range first, numbered inside it."""
    rows = df.withColumn("_range", F.floor(F.col(length) / block))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_c"))
    offset = sizes.select("_range", F.coalesce(F.sum("_c").over(Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))  # a row per range of lengths
    inside = Window.partitionBy("_range").orderBy(F.desc(length), key)
    out = rows.withColumn("_r", F.row_number().over(inside) - 1).join(offset, "_range")
    return out.withColumn("position", (F.col("_o") + F.col("_r")).cast("long")).drop("_range", "_r", "_o")


def dense_positions(df: DataFrame, key: str, block: int = 1 << 16) -> DataFrame:
    """(key, position, total): each distinct whole-number key that is not null and its place in order from 0.

    Keys are counted by range of ``block`` values first and numbered inside it, so no window holds more than a range.
    """
    rows = df.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_range", F.floor(F.col(key) / block))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_c"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range of keys
    offset = sizes.select("_range", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"), F.sum("_c").over(Window.partitionBy(F.lit(1))).alias("total"))
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1).join(offset, "_range")
    return rows.select(key, (F.col("_o") + F.col("_r")).cast("long").alias("position"), F.col("total").cast("long").alias("total"))


def named_split(position: Column | str, total: Column | str, splits: Mapping[str, tuple[float, float]]) -> Column:
    """Name of the split whose share of the positions, with bounds rounded half to even, holds this one; else null."""
    p, n = (F.col(c) if isinstance(c, str) else c for c in (position, total))
    bound = lambda share: F.bround(F.lit(float(share)) * n).cast("long")
    return F.coalesce(*[F.when((p >= bound(lo)) & (p < bound(hi)), F.lit(name)) for name, (lo, hi) in splits.items()])


def bucket_batches(df: DataFrame, bucket: str, key: str, batch: int, seed: str, drop_last: bool = True) -> DataFrame:
    """Hash order inside each bucket, cut into batches of ``batch``; adds ``batch_no``."""
    order = Window.partitionBy(bucket).orderBy(hash_fraction(seed, key), key)
    rows = df.withColumns({"_r": F.row_number().over(order) - 1, "_n": F.count("*").over(Window.partitionBy(bucket))})
    rows = rows.withColumn("batch_no", F.floor(F.col("_r") / batch).cast("long"))
    if drop_last:
        rows = rows.where(F.col("batch_no") < F.floor(F.col("_n") / batch))
    return rows.drop("_r", "_n")


def padded_cost(df: DataFrame, by: Sequence[str], length: str) -> DataFrame:
    """Per batch: rows, tokens, longest, and padding."""
    out = df.groupBy(*by).agg(F.count("*").alias("records"), F.sum(length).cast("long").alias("tokens"), F.max(length).cast("long").alias("longest"))
    return out.withColumn("padding", F.col("records") * F.col("longest") - F.col("tokens"))


def draft_segments(position: Column | str, n_segments: int, length: Column | str) -> Column:
    """(position * S) // L inside 0 .. S - 1."""
    p, n = (F.col(c) if isinstance(c, str) else c for c in (position, length))
    return F.least(F.greatest(F.floor(p * n_segments / n), F.lit(0)), F.lit(n_segments - 1)).cast("long")
