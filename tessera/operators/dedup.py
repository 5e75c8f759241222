"""Exact de-duplication: the first of equal keys in an explicit order stays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import digest


def keep_first(df: DataFrame, key: Column | str, order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the least in ``order`` (which should be total).

    An aggregate, not a window: equal keys combine before the shuffle, so a key that holds a
    third of all rows costs a row per task.  Nulls are a key.  Column names stay; ``order`` columns may be any
    orderable expressions.
    """
    key = F.col(key) if isinstance(key, str) else key
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(key.alias("_key")).agg(F.min_by(row, F.struct(*order)).alias("_row")).select("_row.*")


def mark_duplicates(df: DataFrame, key: Column, order_id: str) -> DataFrame:
    """Adds first_id (least order_id with that key) and is_duplicate; rows without a key are no duplicates."""
    keyed = df.withColumn("_key", key)
    first = keyed.where("_key is not null").groupBy("_key").agg(F.min(order_id).alias("first_id"))
    out = keyed.join(first, "_key", "left")
    return out.withColumn("is_duplicate", F.coalesce(F.col(order_id) > F.col("first_id"), F.lit(False))).drop("_key")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keep-first by canonical text: anti join of later copies, so texts are not shuffled by digest and back."""
    return mark_duplicates(docs, digest(text_col), id_col).where("not is_duplicate").drop("is_duplicate", "first_id")
