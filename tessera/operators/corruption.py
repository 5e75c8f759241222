"""Seeded masking of token rows; every choice is a hash of (seed, row, place)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import hash_fraction


def uniform_mask(tokens: DataFrame, key: str, place: str, token: str, mask_id: Column, seed: str, eps: float = 1e-3) -> DataFrame:
    """(key, place, token) rows: a rate per key, p = (1 - eps) * t + eps with t from a hash, and each token masked where its hash is below p.

    Adds p (rounded to 6), masked and noisy.
    """
    t = hash_fraction(f"{seed}:t", key)
    rows = tokens.withColumn("p", F.round((1 - eps) * t + eps, 6))
    rows = rows.withColumn("masked", hash_fraction(seed, key, place) < F.col("p"))
    return rows.withColumn("noisy", F.when(F.col("masked"), mask_id).otherwise(F.col(token)))


def gumbel_top_k(tokens: DataFrame, key: str, place: str, weight: Column, k: Column, seed: str) -> DataFrame:
    """Exactly k places of each key: the greatest log-weight plus Gumbel noise; adds ``picked``."""
    u = hash_fraction(seed, key, place)
    noise = -F.log(-F.log(u + 1e-9) + 1e-9)
    rows = tokens.withColumn("_g", F.round(weight + noise, 9))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_g"), place))
    return rows.withColumn("picked", rank <= k).drop("_g")


def random_tokens(tokens: DataFrame, key: str, place: str, vocabulary: int, seed: str) -> Column:
    """A hashed vocabulary id for each place."""
    return F.floor(hash_fraction(seed, key, place) * vocabulary).cast("long")
