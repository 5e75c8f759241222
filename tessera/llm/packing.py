"""Packing by optimal length buckets.

The lengths of all documents are aggregated into one histogram; a dynamic program over it
chooses the ``buckets`` boundaries that minimise total padding (every document is padded to its
bucket's boundary).  Inside a bucket, documents form batches whose padded size stays within
``token_budget``: a batch holds floor(token_budget / boundary) documents, one at least, so a document
longer than the budget is a batch by itself, whole.

Batches form inside shards of a bucket (documents dealt by a hash of doc_id, so many that a shard holds
about ``shard_rows``), never over a whole bucket in one task; each shard ends in at most one
batch that is not full.  Only the histogram reaches the driver: one row per distinct length,
so it is bounded by the longest text and not by the number of documents.

Null texts have length 0 and are packed too (boundary 0 needs no padding; a batch of such holds
``token_budget`` documents).  Repeated rows are packed each; rows without doc_id count in n_docs, tokens and padded and are
left out of doc_ids.  Equal lengths are ordered by doc_id.  An empty table gives no batches.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import common, token_counts

BUCKETS = 16
TOKEN_BUDGET = 16384
SHARD_ROWS = 50_000


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Boundaries that minimise sum(count * (boundary - length)), by dynamic programming.

    The cost obeys the quadrangle inequality, so the best cut of a prefix moves right with the
    prefix and each layer is solved by divide and conquer in O(n log n).
    """
    order = np.argsort(lengths)
    x, c = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    n = len(x)
    if n == 0:
        return []
    buckets = min(buckets, n)
    docs = np.concatenate([[0], np.cumsum(c)]).astype(np.float64)
    # padded tokens are to be least: the unpadded total is constant
    best = docs[1:] * x  # one bucket
    cuts = np.zeros((buckets, n), np.int64)
    for layer in range(1, buckets):
        now = np.empty(n)
        spans = [(0, n - 1, 0, n - 1)]
        while spans:
            lo, hi, a, b = spans.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            first, last = a, min(b, mid)  # the last bucket covers lengths first..mid
            starts = np.arange(first, last + 1)
            before = np.where(starts > 0, best[starts - 1], 0.0)
            cost = before + (docs[mid + 1] - docs[starts]) * x[mid]
            k = int(np.argmin(cost))
            now[mid], cuts[layer, mid] = cost[k], starts[k]
            spans += [(lo, mid - 1, a, int(starts[k])), (mid + 1, hi, int(starts[k]), b)]
        best = now
    out, end = [], n - 1
    for layer in range(buckets - 1, -1, -1):
        out.append(int(x[end]))
        if layer == 0:
            break
        end = int(cuts[layer, end]) - 1
        if end < 0:
            break
    return sorted(set(out))


def pack(docs: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """docs: doc_id, length (cheap to make again, or cut) -> one row per batch.

    boundary, shard, batch (number inside the shard), doc_ids (ascending), n_docs, tokens, padded.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("length"), F.lit(0)).cast("long").alias("length"))
    histogram = docs.groupBy("length").agg(F.count("*").alias("n")).toPandas()
    bounds = optimal_boundaries(histogram["length"].to_numpy(), histogram["n"].to_numpy(), buckets)
    held = np.add.reduceat(histogram.sort_values("length")["n"].to_numpy(), np.concatenate([[0], np.searchsorted(np.sort(histogram["length"].to_numpy()), bounds[:-1], side="right")])) if bounds else []
    boundary, shards = F.lit(None).cast("long"), F.lit(1)
    for b, n in reversed(list(zip(bounds, held, strict=True))):
        boundary = F.when(F.col("length") <= b, F.lit(int(b)).cast("long")).otherwise(boundary)
        shards = F.when(F.col("length") <= b, F.lit(int(n) // shard_rows + 1)).otherwise(shards)
    # rows without doc_id are dealt by their place: they share no shard
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(F.monotonically_increasing_id())).otherwise(F.xxhash64("doc_id"))
    rows = docs.withColumns({"boundary": boundary, "shard": F.pmod(key, shards).cast("int")})
    order = Window.partitionBy("boundary", "shard").orderBy("doc_id", "length")
    capacity = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest(F.col("boundary"), F.lit(1)))).cast("long")
    rows = rows.withColumn("batch", F.floor((F.row_number().over(order) - 1) / capacity).cast("long"))
    out = rows.groupBy("boundary", "shard", "batch").agg(F.array_sort(F.collect_list("doc_id")).alias("doc_ids"), F.count("*").alias("n_docs"), F.sum("length").alias("tokens"))
    return out.withColumn("padded", F.col("n_docs") * F.col("boundary"))


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Packs documents by their number of tokens."""
    return pack(common.cut(token_counts.with_token_count(docs, count_col="length", id_col="doc_id")), **options)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.job(spark)
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
