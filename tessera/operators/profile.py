"""Profiles of cells (source, language, task ...)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import length_bucket


def cell_stats(df: DataFrame, cell: Sequence[str], length: str) -> DataFrame:
    return df.groupBy(*cell).agg(
        F.count("*").alias("records"),
        F.sum(length).cast("long").alias("text_tokens"),
        F.max(length).cast("long").alias("max_text_tokens"),
        F.round(F.avg(length), 6).alias("average_text_tokens"),
    )


def length_histogram(df: DataFrame, cell: Sequence[str], length: str) -> DataFrame:
    return df.groupBy(*cell, length_bucket(length).alias("bucket")).agg(F.count("*").alias("records"))


def rollups(df: DataFrame, levels: Sequence[Sequence[str]], length: str) -> DataFrame:
    """All levels in one pass (grouping sets); columns outside a level are null."""
    columns = list(dict.fromkeys(c for level in levels for c in level))
    sets = ", ".join(f"({', '.join(level)})" for level in levels)
    df.createOrReplaceTempView("_rollup_input")
    return df.sparkSession.sql(
        f"SELECT {', '.join(columns)}, grouping_id() AS _gid, count(*) AS records, cast(sum({length}) AS bigint) AS text_tokens FROM _rollup_input GROUP BY GROUPING SETS ({sets})"
    ).drop("_gid")


def missing_cells(df: DataFrame, left: str, left_values: Sequence[str], right: str, right_values: Sequence[str]) -> DataFrame:
    """All pairs of the two value lists that don't occur."""
    spark = df.sparkSession
    every = spark.createDataFrame([(a, b) for a in left_values for b in right_values], f"{left} string, {right} string")
    return every.exceptAll(df.select(left, right).distinct())


def review_sample(df: DataFrame, cell: Sequence[str], key: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n rows with the least key of each cell (a top-k report); rank starts at 1."""
    order = Window.partitionBy(*cell).orderBy(key, *ties)
    return df.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n)


def vocabulary(tokens: DataFrame, token: str, specials: Sequence[str] = (), size: int | None = None) -> DataFrame:
    """(token, records, token_id): specials first, then by count descending and token."""
    counts = tokens.groupBy(F.col(token).alias("token")).agg(F.count("*").alias("records"))
    rank = F.row_number().over(Window.orderBy(~F.col("token").isin(list(specials)) if specials else F.lit(True), F.desc("records"), "token")) - 1
    if size is not None:
        counts = counts.orderBy(F.desc("records"), "token").limit(size)  # the window below sees the bound only
    return counts.withColumn("token_id", rank.cast("long"))
