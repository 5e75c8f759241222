"""Binary token files as a Python data source, and writers of them.

Two formats: an index file (lengths, byte pointers and document ends of a .bin file of tokens) and
shards with a header of 1 KiB (magic, version, count, bytes a token).  Files are found and read by Spark
(``binaryFile``), so any store works, and a file is one input split.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_MAGIC = b"MMIDIDX\x00\x00"
#: Codes of token types in an index (fixed values of the format).
DTYPES = {1: np.uint8, 2: np.int8, 3: np.int16, 4: np.int32, 5: np.int64, 6: np.float64, 7: np.float32, 8: np.uint16}
#: Header of a token shard (fixed values of the format): 256 int32 values, of which these come first.
SHARD_MAGICS = (20240520, 278895051)
SHARD_VERSION = 1
HEADER = 1024


def token_dtype(vocabulary: int) -> type:
    return np.uint16 if vocabulary < 65500 else np.int32


def encode_index(lengths: list[int], document_ends: list[int], dtype: type) -> bytes:
    """Index bytes: sequence lengths, byte pointers and document borders."""
    size = np.dtype(dtype).itemsize
    code = next(k for k, v in DTYPES.items() if v is dtype)
    n = np.asarray(lengths, np.int32)
    pointers = np.concatenate([[0], np.cumsum(n[:-1], dtype=np.int64) * size]).astype(np.int64) if len(n) else np.zeros(0, np.int64)
    return INDEX_MAGIC + struct.pack("<QBQQ", 1, code, len(n), len(document_ends)) + n.tobytes() + pointers.tobytes() + np.asarray(document_ends, np.int64).tobytes()


def decode_index(data: bytes) -> tuple[type, np.ndarray, np.ndarray, np.ndarray]:
    """(token type, lengths, byte pointers, document ends)."""
    if data[:9] != INDEX_MAGIC:
        raise ValueError("not an index file")
    version, code, n, docs = struct.unpack_from("<QBQQ", data, 9)
    if version != 1 or code not in DTYPES:
        raise ValueError(f"index version {version}, token type {code}")
    at = 9 + struct.calcsize("<QBQQ")
    lengths = np.frombuffer(data, np.int32, n, at)
    pointers = np.frombuffer(data, np.int64, n, at + 4 * n)
    return DTYPES[code], lengths, pointers, np.frombuffer(data, np.int64, docs, at + 12 * n)


def read_indexed(spark: SparkSession, prefix: str) -> DataFrame:
    """All files ``prefix``*.idx with their .bin -> (file, seq_id, tokens array<long>)."""
    files = spark.read.format("binaryFile").load([f"{prefix}*.idx", f"{prefix}*.bin"]).select(F.regexp_replace("path", r"\.(idx|bin)$", "").alias("file"), F.col("path").endswith(".idx").alias("is_index"), "content")
    pairs = files.groupBy("file").agg(F.first(F.when(F.col("is_index"), F.col("content")), ignorenulls=True).alias("idx"), F.first(F.when(~F.col("is_index"), F.col("content")), ignorenulls=True).alias("bin"))

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, idx, data in zip(frame["file"], frame["idx"], frame["bin"], strict=True):
                dtype, lengths, pointers, _ = decode_index(idx)
                for at in range(0, len(lengths), 1000):
                    own = range(at, min(at + 1000, len(lengths)))
                    yield pd.DataFrame({"file": file, "seq_id": list(own), "tokens": [np.frombuffer(data, dtype, int(lengths[i]), int(pointers[i])).astype(np.int64) for i in own]})

    return pairs.mapInPandas(decode, "file string, seq_id long, tokens array<long>")


def encode_shard(tokens: np.ndarray, vocabulary: int) -> bytes:
    dtype = np.uint16 if vocabulary < 2**16 else np.uint32
    header = np.zeros(256, np.int32)
    header[:4] = SHARD_MAGICS[1], SHARD_VERSION, len(tokens), np.dtype(dtype).itemsize
    return header.tobytes() + np.asarray(tokens).astype(dtype).tobytes()


def decode_shard(data: bytes) -> np.ndarray:
    header = np.frombuffer(data, np.int32, 256)
    if header[0] not in SHARD_MAGICS or header[1] != SHARD_VERSION:
        raise ValueError("not a token shard")
    size = int(header[3]) or 2
    dtype = {2: np.uint16, 4: np.uint32}[size if header[0] == SHARD_MAGICS[1] else 2]
    out = np.frombuffer(data, dtype, int(header[2]), HEADER)
    if len(data) != HEADER + len(out) * out.itemsize:
        raise ValueError("shard length and header differ")
    return out.astype(np.int64)


def read_shards(spark: SparkSession, pattern: str, seq_length: int, bos: int | None = None) -> DataFrame:
    """Contiguous slices of seq_length + 1 tokens of each shard -> (file, sample, input_ids, labels).

    bos: slices begin at a beginning-of-sequence token.  What is left at the end of a shard goes.
    """
    files = spark.read.format("binaryFile").load(pattern).select("path", "content")

    def slices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                tokens = decode_shard(content)
                begins = np.flatnonzero(tokens == bos) if bos is not None else None
                rows, at = [], 0
                while True:
                    if begins is not None:
                        k = np.searchsorted(begins, at)
                        if k == len(begins):
                            break
                        at = int(begins[k])
                    if at + seq_length + 1 > len(tokens):
                        break
                    rows.append(tokens[at : at + seq_length + 1])
                    at += seq_length + (1 if begins is not None else 0)
                yield pd.DataFrame({"file": path, "sample": range(len(rows)), "input_ids": [r[:-1] for r in rows], "labels": [r[1:] for r in rows]})

    return files.mapInPandas(slices, "file string, sample long, input_ids array<long>, labels array<long>")


def write_shards(rows: DataFrame, tokens: str, shard: str, vocabulary: int) -> DataFrame:
    """One shard's bytes per value of ``shard`` (bounded by the caller): (shard, content), to be saved by a sink."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        flat = np.concatenate([np.asarray(t, np.int64) for t in frame.sort_values("_order")[tokens]]) if len(frame) else np.zeros(0)
        return pd.DataFrame({"shard": [int(frame[shard].iloc[0])], "content": [encode_shard(flat, vocabulary)]})

    return rows.groupBy(shard).applyInPandas(pack, "shard long, content binary")


from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition  # noqa: E402


class TokenShardSource(DataSource):
    """``spark.read.format("token_shards")``: local or mounted shards given as ``path`` (a glob); a shard a partition."""

    @classmethod
    def name(cls) -> str:
        return "token_shards"

    def schema(self) -> str:
        return "file string, tokens array<long>"

    def reader(self, schema) -> DataSourceReader:
        return _ShardReader(self.options)


class _ShardReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]

    def partitions(self):
        import glob

        return [InputPartition(p) for p in sorted(glob.glob(self.path))]

    def read(self, partition):
        with open(partition.value, "rb") as f:
            tokens = decode_shard(f.read())
        yield pa.RecordBatch.from_arrays([pa.array([partition.value]), pa.array([tokens.tolist()], pa.list_(pa.int64()))], names=["file", "tokens"])
