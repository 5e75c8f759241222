"""Shared pieces: checkpoints, word kernels over Arrow buffers, hashing."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes handled at once by the kernels; longer texts are cut at white space.
BLOCK = 1 << 20

#: Bytes of an Arrow batch of texts in our own jobs.
BATCH_BYTES = 8 << 20


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors, from the session; only in local mode one of our own where it is unset."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if found:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(found)
        return found
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(f"{tempfile.gettempdir()}/checkpoints/{uuid.uuid4().hex}")
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint: it survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_stored: list[tuple[SparkSession, str]] = []


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of the shared store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    _stored.append((spark, folder))


@atexit.register
def _remove_stored() -> None:
    for spark, folder in _stored:
        try:
            remove_folder(spark, folder)
        except Exception:  # noqa: BLE001 - the session has ended already
            return


def store(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it again: like ``cut``, but columnar and compressed.

    The folder goes when the driver ends.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    remove_at_exit(spark, folder)
    return spark.read.schema(df.schema).parquet(folder)


def job(spark: SparkSession) -> None:
    """Settings of a job that owns its session (registered queries and pipeline stages call this; operators never do): texts reach
    Python in Arrow batches of BATCH_BYTES."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def free(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from ``columns`` (compared without case)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def pieces(batch: pa.RecordBatch, column: int = 0, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts hold about ``limit`` bytes at most; a longer text comes alone."""
    _, offsets = text_buffer(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, min(end, n) - at)
        at = end


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: Column | str) -> Column:
    """Number of words (JVM side); null counts as 0."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """Uniform value inside (0, 1) from the md5 of key and seed; the same in any SQL engine."""
    head = F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}"))), 1, 8)
    return (F.conv(head, 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)


# ---------------------------------------------------------------- numpy kernels

_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(1, 2**64, 256, dtype=np.uint64)
_BYTE_FOLDED = _BYTE.copy()
_BYTE_FOLDED[65:91] = _BYTE[97:123]
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 2**64))
_ROLL = _SEED.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, BLOCK) + 1
        for key, base in (("p", _P), ("q", _P_INV)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[key] = np.multiply.accumulate(out)
    return _powers["p"], _powers["q"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the start of each text (nulls are empty)."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def _pieces(data: np.ndarray, offsets: np.ndarray):
    """Cuts the texts at white space into pieces of about BLOCK bytes: (text, from, to)."""
    for i in range(len(offsets) - 1):
        a, end = int(offsets[i]), int(offsets[i + 1])
        while end - a > BLOCK:
            b = a + BLOCK
            while b < end:
                stop = np.flatnonzero(~_IS_WORD[data[b : b + BLOCK]])
                if len(stop):
                    b += int(stop[0])
                    break
                b += BLOCK
            b = min(b, end)
            yield i, a, b
            a = b
        if end > a:
            yield i, a, end


def word_spans(data: np.ndarray, offsets: np.ndarray, fold: bool):
    """Yields (text index, start byte, end byte, 64-bit hash) of the words, block by block.

    Texts come whole and in order; a text longer than BLOCK goes over several blocks.
    fold: A-Z count as a-z.
    """
    table = _BYTE_FOLDED if fold else _BYTE
    held: list[tuple[int, int, int]] = []
    size = 0

    def block():
        lo = held[0][1]
        hi = held[-1][2]
        raw = data[lo:hi]
        inside = _IS_WORD[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[[x[1] - lo for x in held]] = True
        edge[len(raw)] = True
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        p, q = powers(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(table[raw] * p[: len(raw)], out=sums[1:])
        h = mix((sums[ends] - sums[starts]) * q[starts] + (ends - starts).astype(np.uint64))
        texts = np.array([x[0] for x in held])
        at = np.searchsorted(np.array([x[1] - lo for x in held]), starts, side="right") - 1
        return texts[at], starts + lo, ends + lo, h

    for piece in _pieces(data, offsets):
        if held and (size + piece[2] - piece[1] > BLOCK or piece[1] != held[-1][2]):
            yield block()
            held, size = [], 0
        held.append(piece)
        size += piece[2] - piece[1]
    if held:
        yield block()


def words_by_text(column: pa.Array, fold: bool):
    """Yields (first text, word hashes, word count of each text) over runs of whole texts."""
    data, offsets = text_buffer(column)
    n = len(offsets) - 1
    parts: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    first = 0
    for owner, _, _, h in word_spans(data, offsets, fold):
        parts.append(h)
        owners.append(owner)
        last = int(owner[-1]) if len(owner) else first
        if sum(map(len, parts)) >= 1 << 17 and last > first:
            own, all_h = np.concatenate(owners), np.concatenate(parts)
            whole = int(np.searchsorted(own, last))  # the last text may go on in the next block
            yield first, all_h[:whole], np.bincount(own[:whole] - first, minlength=last - first)
            parts, owners, first = [all_h[whole:]], [own[whole:]], last
    own = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    all_h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if n > first:
        yield first, all_h, np.bincount(own - first, minlength=n - first)


def shingles(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k-word shingle hashes with repeats, and how many of them each text has.

    A text with fewer than k words, but one at least, has its whole sequence as one shingle.
    """
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(counts)])
    total = np.zeros(len(h), np.uint64)
    for j in range(k):
        total[: len(h) - j] += h[j:] * _ROLL[j % 64] if j < len(h) else 0
    out_starts = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(out_starts[-1], np.uint64)
    where = np.repeat(starts[:-1] - out_starts[:-1], n) + np.arange(out_starts[-1])
    if len(out):
        out[:] = mix(total[where])
    for i in np.flatnonzero((counts < k) & (counts > 0)):
        own = h[starts[i] : starts[i + 1]]
        with np.errstate(over="ignore"):
            out[out_starts[i]] = mix(np.array([(own * _ROLL[: len(own)]).sum() ^ np.uint64(0xA5A5 + len(own))], np.uint64))[0]
    return out, n


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of each node of an undirected edge table (a, b longs) -> (id, label).

    Alternating large-star and small-star contraction: each round joins edges with the least
    neighbour of each node, so no neighbour list is ever gathered; the edge table is cut from
    its lineage every round.  Isolated nodes don't appear.  Nulls are ignored.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u is not null and v is not null and u <> v").distinct())
    seen = None
    for _ in range(max_rounds):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))).where("u <> v")
        now = cut(small.distinct())
        state = now.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) % 1000000007 as decimal(38, 0)))")).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("id"), F.col("v").alias("label")).union(now.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
