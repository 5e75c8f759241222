"""Streams over growing folders: de-duplication, running counts, bounded shuffles, budget cut-offs.

Event times are cast to TIMESTAMP (watermarks need it).  Queries here run with ``availableNow``: they read what
is there, checkpoint, and go on from there next time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def dedup_stream(df: DataFrame, keys: list[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key inside the watermark."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.dropDuplicatesWithinWatermark(keys)


def windowed_counts(df: DataFrame, ts: str, window: str, by: list[str], value: str, delay: str = "10 minutes") -> DataFrame:
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.groupBy(F.window(ts, window), *by).agg(F.count("*").alias("records"), F.sum(value).alias("total"))


class ReservoirShuffle(StatefulProcessor):
    """A bounded shuffle per key: a buffer of ``size`` rows; each new row pushes out one picked by a seeded hash.

    At the end of input (a timer) the buffer is flushed, so every row leaves once.  Rows are (key, item, payload).
    """

    def __init__(self, size: int, seed: int):
        self.size, self.seed = size, seed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", "item long, payload string")
        self.drawn = handle.getValueState("drawn", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        import hashlib

        held = [tuple(x) for x in self.buffer.get()] if self.buffer.exists() else []
        n = self.drawn.get()[0] if self.drawn.exists() else 0
        out = []
        for frame in rows:
            for item, payload in frame[["item", "payload"]].itertuples(index=False):
                if len(held) < self.size:
                    held.append((int(item), payload))
                else:
                    at = int.from_bytes(hashlib.blake2b(f"{self.seed}:{key}:{n}".encode(), digest_size=8).digest(), "big") % self.size
                    out.append(held[at])
                    held[at] = (int(item), payload)
                n += 1
        self.buffer.put(held)
        self.drawn.update((n,))
        self.handle.registerTimer(timer_values.getCurrentProcessingTimeInMs() + 1)
        if out:
            yield pd.DataFrame({"key": key[0], "item": [o[0] for o in out], "payload": [o[1] for o in out]})

    def handleExpiredTimer(self, key, timer_values, expired) -> Iterator[pd.DataFrame]:  # noqa: N802
        held = [tuple(x) for x in self.buffer.get()] if self.buffer.exists() else []
        self.buffer.clear()
        if held:
            yield pd.DataFrame({"key": key[0], "item": [o[0] for o in held], "payload": [o[1] for o in held]})

    def close(self) -> None:
        pass


def shuffle_stream(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """df: key, item (long), payload (string).  Needs the RocksDB state store."""
    return df.groupBy(key).transformWithStateInPandas(statefulProcessor=ReservoirShuffle(size, seed), outputStructType="key string, item long, payload string", outputMode="append", timeMode="processingTime")


def reservoir_order(items: list, size: int, seed: int) -> list:
    """The same bounded shuffle on a list: each item once, reproducible."""
    import hashlib

    held, out = [], []
    for n, item in enumerate(items):
        if len(held) < size:
            held.append(item)
        else:
            at = int.from_bytes(hashlib.blake2b(f"{seed}:{n}".encode(), digest_size=8).digest(), "big") % size
            out.append(held[at])
            held[at] = item
    return out + held


def run_available(df: DataFrame, folder: str, checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over what is there into Parquet files, exactly once with the same checkpoint."""
    df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", folder).trigger(availableNow=True).start().awaitTermination()


def newest_ready(cycles: DataFrame) -> DataFrame:
    """Of the cycles that are ready and not consumed, the newest; older ready ones are superseded: (cycle, action)."""
    ready = cycles.where("ready and not consumed")
    top = ready.agg(F.max("cycle").alias("top"))
    return ready.join(F.broadcast(top)).select("cycle", F.when(F.col("cycle") == F.col("top"), "take").otherwise("drop").alias("action"))
