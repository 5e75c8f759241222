"""Quality checks of texts and token rows, and reports on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.tokens import IGNORE

#: Characters that may end an answer.
TERMINAL = (".", "!", "?", '"', "'", ")", "]", "}", ">", "*", "`", ":", ";")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentences(text: Column | str, least_words: int = 5) -> Column:
    """Trimmed sentences (cut after . ! ? or a newline) of at least so many words."""
    parts = F.transform(F.split(_col(text), r"(?<=[.!?])\s+|\n+"), lambda s: F.trim(s))
    return F.filter(parts, lambda s: (s != "") & (F.size(F.split(s, r"\s+")) >= least_words))


def death_loop(df: DataFrame, key: str, text: str, ratio: float = 0.3, repeats: int = 5, block: int = 4) -> DataFrame:
    """(key, n_sentences, duplicate_ratio, max_repeat, max_run, looping) of each row, the array kept in its row.

    looping: the duplicate ratio is above ``ratio``, or one sentence comes ``repeats`` times, or ``block`` equal ones follow each other.
    """
    s = F.col("_s")
    sorted_s = F.array_sort(s)

    def longest(a: Column) -> Column:
        start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

        def step(acc: Column, x: Column) -> Column:
            run = F.when(acc["last"] == x, acc["run"] + 1).otherwise(1)
            return F.struct(x.alias("last"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

        return F.aggregate(a, start, step, lambda acc: acc["best"])

    n = F.size(s)
    rows = df.select(F.col(key), sentences(F.coalesce(F.col(text), F.lit(""))).alias("_s"))
    duplicate = F.round(F.when(n > 0, (n - F.size(F.array_distinct(s))) / n).otherwise(0.0), 4)
    rows = rows.select(key, n.cast("long").alias("n_sentences"), duplicate.alias("duplicate_ratio"), longest(sorted_s).cast("long").alias("max_repeat"), longest(s).cast("long").alias("max_run"))
    return rows.withColumn("looping", (F.col("duplicate_ratio") > ratio) | (F.col("max_repeat") >= repeats) | (F.col("max_run") >= block))


def abrupt_ending(text: Column | str, terminal: Sequence[str] = TERMINAL) -> Column:
    """Whether the last character is none of the terminal ones; false for empty texts."""
    t = F.rtrim(F.regexp_replace(_col(text), r"\s+$", ""))
    return F.when(F.coalesce(t, F.lit("")) == "", False).otherwise(~F.right(t, F.lit(1)).isin(list(terminal)))


def missing_end(text: Column | str, limit_tokens: int, eos: str) -> Column:
    """Near the limit (nine tenths at four characters a token) without the end token."""
    return (F.length(_col(text)) >= 0.9 * 4 * limit_tokens) & ~_col(text).endswith(eos)


def index_values(df: DataFrame, value: str, places: Mapping[str, float], by: Sequence[str] = (), last: bool = False) -> DataFrame:
    """Values at sorted positions int(n * p) of each group (capped at n - 1): counts by value, then running counts.

    Only the distinct values of a group are ordered.
    """
    by = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    upto = F.sum("_c").over(group.orderBy("_v"))
    rows = counts.withColumns({"_upto": upto, "_n": F.sum("_c").over(group)})
    out = [F.min(F.when(F.col("_upto") > F.least(F.floor(F.col("_n") * F.lit(float(p)) + 1e-9), F.col("_n") - 1), F.col("_v"))).alias(name) for name, p in places.items()]
    return rows.groupBy(*by).agg(*out, F.min("_v").alias("min"), F.max("_v").alias("max"), F.sum("_c").alias("n"), (F.sum(F.col("_v") * F.col("_c")) / F.sum("_c")).alias("mean"))


def truncation_report(df: DataFrame, length: str, limits: Sequence[int]) -> DataFrame:
    """(limit_tokens, over, share) of each limit: one aggregate, no join with the limits."""
    sums = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(length) > x).alias(f"over_{x}") for x in limits])
    rows = F.array(*[F.struct(F.lit(int(x)).cast("long").alias("limit_tokens"), F.col(f"over_{x}").alias("over"), F.round(F.col(f"over_{x}") / F.col("n"), 6).alias("share")) for x in limits])
    return sums.select(F.inline(rows))


def chunk_ema(positioned: DataFrame, value: str, size: int = 100, alpha: float = 0.1) -> DataFrame:
    """Average, least and greatest value of each chunk of positions, and the moving average over chunks.

    EMA_k = alpha * avg_k + (1 - alpha) * EMA_(k-1), EMA_0 = avg_0, folded over the chunk averages in order (a row a chunk).
    """
    chunks = positioned.groupBy(F.floor(F.col("position") / size).alias("chunk")).agg(F.round(F.avg(value), 6).alias("average"), F.min(value).alias("least"), F.max(value).alias("greatest"))
    whole = Window.partitionBy(F.lit(1)).orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    series = F.collect_list("average").over(whole)
    ema = F.aggregate(F.slice(F.col("_series"), 2, F.size("_series")), F.element_at("_series", 1), lambda acc, x: F.lit(alpha) * x + F.lit(1 - alpha) * acc)
    return chunks.withColumn("_series", series).withColumn("ema", F.round(ema, 6)).drop("_series")


def validation_battery(rows: DataFrame, ids: str, labels: str, mask: str, eos: int) -> DataFrame:
    """Five checks of packed rows as boolean columns (true: passes)."""
    m, x, y = F.col(mask), F.col(ids), F.col(labels)
    pairs = F.arrays_zip(m.alias("m"), x.alias("x"), y.alias("y"))
    falls = F.forall(F.transform(m, lambda v, i: (i == 0) | ~((v == 1) & (F.get(m, i - 1) == 0))), lambda ok: ok)
    return rows.withColumns(
        {
            "mask_monotone": falls,
            "padding_unlabelled": F.forall(pairs, lambda p: (p["m"] == 1) | (p["y"] == IGNORE)),
            "has_supervised": F.exists(y, lambda v: v != IGNORE),
            "no_eos_in_padding": F.forall(pairs, lambda p: (p["m"] == 1) | (p["x"] != eos)),
            "eos_in_content": F.exists(pairs, lambda p: (p["m"] == 1) & (p["x"] == eos)),
        }
    )


def violations(rates: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """(metric, rate, threshold) of the metrics above their threshold; rates: metric, rate."""
    limits = rates.sparkSession.createDataFrame([(k, float(v)) for k, v in thresholds.items()], "metric string, threshold double")
    return rates.join(F.broadcast(limits), "metric").where("rate > threshold")


def counter_deltas(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Adds ``delta``: increase since the row before, not below 0; 0 for the first."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("delta", F.coalesce(F.greatest(F.col(value) - before, F.lit(0.0)), F.lit(0.0)))


def prometheus_counters(lines: DataFrame) -> DataFrame:
    """(name, total) of exposition lines, label sets summed; comment lines go."""
    pattern = r"^([A-Za-z_:][A-Za-z0-9_:]*)(?:\{[^}]*\})?\s+([-+0-9.eE]+)"
    rows = lines.where(~F.col("value").startswith("#")).select(F.regexp_extract("value", pattern, 1).alias("name"), F.try_to_number(F.regexp_extract("value", pattern, 2), F.lit("9999999999999999.999999")).cast("double").alias("v"))
    return rows.where("name <> ''").groupBy("name").agg(F.sum("v").alias("total"))
