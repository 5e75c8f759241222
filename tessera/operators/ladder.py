"""Ordered rejection reasons: the first rule that holds names the reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ladder(rules: Sequence[tuple[str, Column]]) -> Column:
    """CASE over (reason, predicate) in order; a null predicate doesn't hold; null if none does."""
    out = F.lit(None).cast("string")
    for reason, holds in reversed(list(rules)):
        out = F.when(F.coalesce(holds, F.lit(False)), F.lit(reason)).otherwise(out)
    return out


def reason_ladder(df: DataFrame, early: Sequence[tuple[str, Column]], key: Column, order_id: str, late: Sequence[tuple[str, Column]], duplicates_last: bool = False) -> DataFrame:
    """Adds ``reason``.

    Duplicates are tested among the rows that the rules before them let pass: after ``early``, or, if
    duplicates_last, after ``late`` too.
    """
    before = ladder([*early, *late]) if duplicates_last else ladder(early)
    rows = df.withColumn("_before", before).withColumn("_key", F.when(F.col("_before").isNull(), key))
    rows = rows.withColumn("_spread", F.when(F.col("_key").isNull(), F.xxhash64(order_id)).otherwise(0))  # rows without a key go to all tasks
    first = rows.where("_key is not null").groupBy("_key", "_spread").agg(F.min(order_id).alias("_first"))
    rows = rows.join(first, ["_key", "_spread"], "left")
    duplicate = F.when(F.col(order_id) > F.col("_first"), F.lit("duplicate"))
    after = F.lit(None).cast("string") if duplicates_last else ladder(late)
    return rows.withColumn("reason", F.coalesce("_before", duplicate, after)).drop("_before", "_key", "_spread", "_first")


def reason_counts(df: DataFrame) -> DataFrame:
    """Rows by reason; accepted ones as ``accepted``."""
    return df.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("records"))


def ladder_counts(df: DataFrame, early: Sequence[tuple[str, Column]], key: Column, order_id: str, late: Sequence[tuple[str, Column]], duplicates_last: bool = False) -> DataFrame:
    """(reason, records) of ``reason_ladder`` without its join: rows of a key combine before the shuffle, so no key is hot.

    All rows of a key but one are duplicates, also of rows with equal ids; null ids come last.
    """
    names = [] if duplicates_last else [reason for reason, _ in late]
    before = ladder([*early, *late]) if duplicates_last else ladder(early)
    code = F.coalesce(F.array_position(F.array(*map(F.lit, names)), ladder(late)), F.lit(0)).cast("int") if names else F.lit(0)
    name = lambda c: F.element_at(F.array(*map(F.lit, ["accepted", *names])), c + 1)
    rows = df.select(before.alias("before"), key.alias("key"), code.alias("code"), F.col(order_id).alias("id"))
    rows = rows.select(F.when(F.col("before").isNull(), F.col("key")).alias("key"), F.coalesce("before", F.when(F.col("key").isNull(), name(F.col("code")))).alias("settled"), "code", "id")
    first = F.coalesce(F.min_by("code", "id"), F.min("code"))
    groups = rows.groupBy("settled", "key").agg(F.count("*").alias("n"), first.alias("first"))
    pair = lambda reason, n: F.struct(reason.alias("reason"), n.cast("long").alias("records"))
    parts = F.when(F.col("settled").isNotNull(), F.array(pair(F.col("settled"), F.col("n")))).otherwise(
        F.array(pair(name(F.col("first")), F.lit(1)), pair(F.lit("duplicate"), F.col("n") - 1))
    )
    return groups.select(F.inline(parts)).where("records > 0").groupBy("reason").agg(F.sum("records").alias("records"))
