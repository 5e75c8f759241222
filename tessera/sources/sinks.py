"""Writers: shards with a manifest, guards against overwriting, metric logs."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import hash_fraction, partition_name


def hadoop_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file written whole and then renamed into place."""
    jvm = spark._jvm
    target, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"could not write {path}")


def guard_output(spark: SparkSession, folder: str, manifest: Mapping | None = None, resume: bool = False) -> None:
    """Refuses a folder that exists, unless resuming with an equal manifest; names the fields that differ."""
    if not hadoop_exists(spark, folder):
        return
    path = f"{folder}/_manifest.json"
    if not resume or not hadoop_exists(spark, path):
        raise FileExistsError(folder)
    from tessera.sources.readers import read_text

    old = json.loads(read_text(spark, path))
    differ = sorted(k for k in {*old, *(manifest or {})} if old.get(k) != (manifest or {}).get(k))
    if differ:
        raise ValueError(f"{folder} was made with other values of {', '.join(differ)}")


def write_mixture(df: DataFrame, folder: str, by: Sequence[str] = ("lang", "task"), rows_per_file: int = 50_000, manifest: Mapping | None = None) -> DataFrame:
    """JSON shards under partition=slug folders, at most rows_per_file each, and a manifest; returns the counts written.

    Rows are dealt by partition and a hash, so a large cell goes to many tasks.
    """
    spark = df.sparkSession
    guard_output(spark, folder)
    named = df.withColumn("partition", partition_name(*by))
    counts = named.groupBy("partition").agg(F.count("*").alias("records"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = named.repartition(parts, "partition", F.floor(hash_fraction("shard", *[c for c in df.columns if c in by or c.endswith("id")]) * parts))
    dealt.write.option("maxRecordsPerFile", rows_per_file).partitionBy("partition").mode("errorifexists").json(folder)
    written = counts.orderBy("partition")
    rows = {r["partition"]: {"file_name": f"partition={r['partition']}/*.json", "records": r["records"]} for r in written.collect()}  # a row per cell
    write_text(spark, f"{folder}/manifest.json", json.dumps(rows, indent=2, sort_keys=True))
    write_text(spark, f"{folder}/_manifest.json", json.dumps(dict(manifest or {}), indent=2, sort_keys=True))
    return written


def resume_shards(planned: DataFrame, done: DataFrame, shard: str = "shard") -> DataFrame:
    """Rows of the shards that aren't written yet; the written ones must be a prefix 0 .. n - 1."""
    state = done.agg(F.countDistinct(shard).alias("n"), F.max(shard).alias("top")).first()
    if state["n"] and state["top"] + 1 != state["n"]:
        raise ValueError("written shards are not contiguous")
    return planned.join(done.select(shard).distinct(), shard, "left_anti")


def write_metrics(df: DataFrame, path: str) -> None:
    """(step, epoch, ts, metrics map) as JSON lines with a UTC time of milliseconds."""
    from tessera.functions.text import utc_millis

    df.select("step", "epoch", utc_millis("ts").alias("timestamp"), "metrics").write.mode("append").json(path)
