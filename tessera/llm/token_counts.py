"""Token counts: an exact histogram of encoded lengths with suffix sums.

Every whole text is encoded with a public byte-level BPE vocabulary (its folder is a
parameter) and documents are aggregated by encoded length, so what moves is one row per
length and task.  Suffix sums over the histogram give, for every context limit L:

    docs_within / docs_over     documents of at most / more than L tokens
    tokens_truncated            total tokens when every document is cut at L
    tokens_lost                 what the cut drops

and cumulative counts give every quantile.  The sums are made in two levels (blocks of lengths,
then inside a block), so no window holds all lengths.

Null texts count as empty (0 tokens).  Special-token strings are ordinary text.  Repeated rows count each.  An
empty table has an empty histogram.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import common

TOKENIZER_DIR = "/opt/tokenizers"
RANKS_FILE = "byte_bpe_50k.tiktoken"
#: Lengths in a block of the two-level sums.
BLOCK_LENGTHS = 1024


@functools.lru_cache(maxsize=4)
def encoder(folder: str, ranks_file: str, pattern: str | None):
    """The tokenizer of a vocabulary file, once a worker."""
    import public_tokenizers
    import tiktoken

    with open(f"{folder}/{ranks_file}", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(ranks_file, pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_count(docs: DataFrame, text_col: str = "text", count_col: str = "n_tokens", folder: str = TOKENIZER_DIR, ranks_file: str = RANKS_FILE, pattern: str | None = None, id_col: str | None = None) -> DataFrame:
    """The number of tokens of each text, as the only column or, with id_col, after the ids (longs)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(folder, ranks_file, pattern).encode_ordinary
        for batch in batches:
            # one text at a time: a batch holds 64 MB of them at most, and never all of them as Python strings
            lengths = [0 if t is None else len(encode(t)) for t in map(pa.StringScalar.as_py, batch.column(0))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(lengths, pa.int64())], names=[*batch.schema.names[1:], count_col])

    if id_col is None:
        return docs.select(F.col(text_col).cast("string")).mapInArrow(count, f"{count_col} long")
    return docs.select(F.col(text_col).cast("string"), F.col(id_col).cast("long")).mapInArrow(count, f"{id_col} long, {count_col} long")


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """A row per distinct length: n_docs, tokens and, from suffix and prefix sums, the answers for the limit L = length."""
    # cut: texts are encoded once, though the histogram is read twice below
    h = common.cut(lengths.groupBy(F.col(length_col).alias("length")).agg(F.count("*").alias("n_docs")).withColumn("tokens", F.col("length") * F.col("n_docs")))
    h = h.withColumn("_block", F.floor(F.col("length") / BLOCK_LENGTHS))
    blocks = h.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum("tokens").alias("_t"))
    after = Window.partitionBy(F.lit(1)).orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_d_after"),
        F.sum("_d").over(everything).alias("total_docs"),
        F.sum("_t").over(everything).alias("total_tokens"),
        F.coalesce(F.sum("_t").over(after), F.lit(0)).alias("_t_after"),
    )
    inside = Window.partitionBy("_block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    h = h.join(blocks, "_block")
    h = h.withColumns(
        {
            "docs_over": F.coalesce(F.sum("n_docs").over(inside), F.lit(0)) + F.col("_d_after"),
            "_tokens_over": F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("_t_after"),
        }
    )
    h = h.withColumns(
        {
            "docs_within": F.col("total_docs") - F.col("docs_over"),
            "tokens_lost": F.col("_tokens_over") - F.col("docs_over") * F.col("length"),
            "tokens_truncated": F.col("total_tokens") - F.col("_tokens_over") + F.col("docs_over") * F.col("length"),
        }
    )
    h = h.withColumn("quantile", F.col("docs_within") / F.col("total_docs"))
    return h.select("length", "n_docs", "tokens", "docs_within", "docs_over", "tokens_truncated", "tokens_lost", "quantile", "total_docs", "total_tokens")


def quantiles(histogram: DataFrame, at=(0.5, 0.9, 0.99)) -> DataFrame:
    """The smallest length within which at least that share of documents lies: (q, length)."""
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in at]))
    return histogram.select("length", "quantile", wanted.alias("q")).where("quantile >= q").groupBy("q").agg(F.min("length").alias("length"))


def truncated_totals(histogram: DataFrame, limits) -> DataFrame:
    """(context limit, total tokens if every document is cut there), for any limits."""
    wanted = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits]))
    return histogram.select(wanted.alias("context"), "length", "n_docs").groupBy("context").agg(F.sum(F.least("length", "context") * F.col("n_docs")).alias("tokens_truncated"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.job(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    return length_histogram(with_token_count(docs))
