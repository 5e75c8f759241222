"""Mixing sources to target weights by Pareto order sampling.

A source with target T over S words is to be taken f = T / S times (at most ``max_copies``).
Document i expects e_i = f copies (or a share in proportion to ``weight_col``, inside a source, clipped
at ``max_copies``).  floor(e_i) whole copies are certain; the rest is its inclusion probability
p_i, and Pareto order sampling ranks documents by

    q_i = [u_i / (1 - u_i)] / [p_i / (1 - p_i)],   u_i uniform from the md5 of doc_id and seed

and takes the smallest ranks until the words still missing are met as nearly as possible, so the
sample has a fixed size in words.  Only DataFrame functions are used, and nothing is sorted
whole: ranks are first counted in BINS bins of a source, then only the one bin in which the
target falls is ordered.

Null texts have size 0 and are taken 0 times.  A null source is a source of its own, after all
others.  Repeated rows are rows of their own; ties in rank are broken by doc_id and size, and rows that agree
in both can stand for each other.  With no documents, or sizes that are all 0, the result has no taken words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import common

BINS = 65536
SHARES = (5.0, 2.0, 1.0)


def source_targets(sizes: DataFrame, shares: Sequence[float] = SHARES, share_of_all: float = 1.0, max_copies: float = 3.0) -> DataFrame:
    """(source, source_size) -> (source, source_size, share, target).

    Sources by code point, null last, weigh ``shares`` in turn.  Targets are proportional to
    weight, stop at max_copies * source_size, and the excess goes to the others by weight until
    none is above: with sources ordered by cap / weight, the capped ones are a prefix.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(1))
    t = sizes.withColumn("n", F.row_number().over(everything) - 1)
    t = t.withColumn("share", F.element_at(F.array(*[F.lit(float(x)) for x in shares]), (F.col("n") % len(shares) + 1).cast("int")))
    t = t.withColumn("cap", F.col("source_size") * F.lit(float(max_copies))).withColumn("total", F.sum("source_size").over(all_rows) * F.lit(float(share_of_all)))
    before = Window.orderBy(F.col("cap") / F.col("share"), "n").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("share_left", F.sum("share").over(all_rows) - F.coalesce(F.sum("share").over(before), F.lit(0.0)))
    t = t.withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("share_left"))
    # the first source, in order of cap / weight, whose cap is above its part of the rest; it and all after it share the rest
    free = F.col("level") * F.col("share") <= F.col("cap")
    t = t.withColumn("rest_level", F.min(F.when(free, F.struct(F.col("cap") / F.col("share"), F.col("n"), F.col("level")))).over(all_rows))
    share = F.coalesce(F.col("rest_level.level"), F.lit(float("inf"))) * F.col("share")
    return t.select("source", "source_size", "share", F.least("cap", share).alias("target"))


def pareto_mix(docs: DataFrame, shares: Sequence[float] = SHARES, share_of_all: float = 1.0, max_copies: float = 3.0, seed: str = "mix", weight_col: str | None = None) -> DataFrame:
    """docs: doc_id, size, source and any others -> the same rows plus source_size, target, copies (long).

    Columns of these three names are replaced; all others may have any names.  The rows given in must be cheap to make
    again (or cut): they are read three times.
    """
    docs = docs.drop("source_size", "target", "copies")
    src, sure, p, q, bin_, edge_, missing, share, mean = common.free([*docs.columns, "source_size", "target", "copies"], "src", "sure", "p", "q", "bin", "edge", "missing", "share", "mean")
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, shares, share_of_all, max_copies).withColumnsRenamed({"source": src, "share": share})
    factor = F.lit(1.0)
    if weight_col:
        means = docs.groupBy("source").agg((F.sum(F.col(weight_col) * F.col("size")) / F.sum("size")).alias(mean))
        targets = targets.join(means, targets[src].eqNullSafe(means["source"])).select(targets["*"], mean)
        factor = F.col(weight_col) / F.col(mean)
    targets = common.cut(targets)
    rows = docs.join(targets, docs["source"].eqNullSafe(F.col(src)), "left").drop(src)
    f = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    e = F.least(F.lit(float(max_copies)), f * factor)
    u = common.uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), seed)
    rows = rows.withColumns({sure: F.when(F.col("size") > 0, F.floor(e)).otherwise(0).cast("long"), p: F.when(F.col("size") > 0, e - F.floor(e)).otherwise(0.0)})
    rows = rows.withColumn(q, F.when(F.col(p) > 0, (u / (1 - u)) / (F.col(p) / (1 - F.col(p)))))
    # q / (1 + q) is inside (0, 1) and rises with q
    rows = rows.withColumn(bin_, F.when(F.col(q).isNotNull(), F.floor(F.col(q) / (1 + F.col(q)) * BINS)).cast("int"))
    per_bin = rows.groupBy("source", bin_).agg(F.sum("size").alias("words"), F.sum(F.col("size") * F.col(sure)).alias("sure"), F.max("target").alias("target"))
    up_to = Window.partitionBy("source").orderBy(F.col(bin_).asc_nulls_first())  # BINS + 1 rows a source at most
    whole = Window.partitionBy("source")
    marks = (
        per_bin.withColumn("want", F.col("target") - F.sum("sure").over(whole))
        .where(F.col(bin_).isNotNull())
        .withColumn("upto", F.sum("words").over(up_to))
        .where("upto >= want")
        .groupBy("source")
        .agg(F.min_by(F.struct(F.col(bin_).alias("bin"), (F.col("want") - F.col("upto") + F.col("words")).alias("missing")), bin_).alias("edge"))
        .select(F.col("source").alias(src), F.col("edge.bin").alias(edge_), F.col("edge.missing").alias(missing))
    )
    marks = common.cut(marks)
    rows = rows.join(marks, rows["source"].eqNullSafe(F.col(src)), "left").drop(src)
    at_edge = F.coalesce(F.col(bin_) == F.col(edge_), F.lit(False))
    below = F.col(q).isNotNull() & (F.col(edge_).isNull() | (F.col(bin_) < F.col(edge_)))
    clear = rows.where(~at_edge).withColumn("copies", F.col(sure) + below.cast("int"))
    order = Window.partitionBy("source").orderBy(q, "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    gone = F.coalesce(F.sum("size").over(order), F.lit(0))
    # taken while that brings the words nearer to the target
    edge = rows.where(at_edge).withColumn("copies", F.col(sure) + F.when(F.col(missing) - gone >= F.col("size") / 2, 1).otherwise(0))
    return clear.unionByName(edge).withColumn("copies", F.col("copies").cast("long")).drop(sure, p, q, bin_, edge_, missing, share, mean)


def _sized(docs: DataFrame) -> DataFrame:
    return common.cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), common.n_words("text").alias("size")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _sized(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return pareto_mix(docs).select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), F.col("target").cast("double").alias("target"), (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs (with doc_id, text, source), each as often as the mix takes it; same columns, of any names.

    Rows that agree in doc_id, source and text are one unit of their joint size: each of them comes as often as the others.
    """
    source, text = F.col("source").cast("string"), F.xxhash64(F.col("text").cast("string"))
    units = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), text.alias("text")).agg(F.sum(common.n_words(F.col("text"))).alias("size"))
    taken = pareto_mix(common.cut(units), **options).where("copies > 0")
    key_id, key_source, key_text, copies, copy = common.free(docs.columns, "key_id", "key_source", "key_text", "copies", "copy")
    taken = taken.select(F.col("doc_id").alias(key_id), F.col("source").alias(key_source), F.col("text").alias(key_text), F.col("copies").alias(copies))
    same = F.col(key_id).eqNullSafe(docs["doc_id"].cast("long")) & F.col(key_source).eqNullSafe(docs["source"].cast("string")) & F.col(key_text).eqNullSafe(F.xxhash64(docs["text"].cast("string")))
    joined = docs.join(taken, same)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*[joined[f"`{c}`"] for c in docs.columns])


OP10_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|mix'), 1, 8))::BIGINT + 0.5) / 4294967296.0 AS u
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS n FROM sized GROUP BY source
), weighted AS (
  SELECT *, [5.0, 2.0, 1.0][(n % 3 + 1)::INT]::DOUBLE AS share, source_size * 3.0::DOUBLE AS cap, sum(source_size) OVER ()::DOUBLE AS total FROM per_source
), levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER w, 0.0)) / (sum(share) OVER () - coalesce(sum(share) OVER w, 0.0)) AS level FROM weighted
  WINDOW w AS (ORDER BY cap / share, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(cap, share * coalesce((SELECT min(level) FROM levels WHERE level * share <= cap AND cap / share = (SELECT min(cap / share) FROM levels WHERE level * share <= cap)), 1e300)) AS target FROM levels
), asked AS (
  SELECT d.doc_id, d.size, d.u, d.source, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS f
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), drawn AS (
  SELECT *, CASE WHEN size > 0 THEN floor(f)::BIGINT ELSE 0 END AS sure, size > 0 AND f > floor(f) AS open,
         (sum(CASE WHEN size > 0 THEN floor(f)::BIGINT * size ELSE 0 END) OVER (PARTITION BY source))::DOUBLE AS certain,
         coalesce(sum(size) FILTER (WHERE size > 0 AND f > floor(f)) OVER (PARTITION BY source ORDER BY u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone
  FROM asked
)
SELECT doc_id, size, source_size, target, ((sure + CASE WHEN open AND target - certain - gone >= size / 2.0 THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM drawn
"""
