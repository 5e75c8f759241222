"""Readers of JSON, chat, retrieval and Delta tables; small metadata is read through Hadoop paths, so any store works."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHAT_SCHEMA = "messages array<struct<role:string,content:string>>, lang string, task string, source string"
DELTA_PATH = re.compile(r"^(delta://|dbfs:/|abfss?://|s3a?://|gs://)")


def read_text(spark: SparkSession, path: str) -> str:
    """One whole (small) text file from any file system Spark knows."""
    rows = spark.read.option("wholetext", True).text(path).collect()
    return "".join(r["value"] for r in rows)


def read_manifest(spark: SparkSession, path: str) -> dict[str, dict]:
    """name -> {file_name, columns ...}; file names become absolute."""
    found = json.loads(read_text(spark, path))
    if not isinstance(found, dict):
        raise ValueError(f"{path}: a manifest is a mapping")
    folder = path.rsplit("/", 1)[0]
    return {k: v | {"file_name": v["file_name"] if re.match(r"^([a-z0-9]+:/|/)", v["file_name"]) else f"{folder}/{v['file_name']}"} for k, v in found.items()}


def manifest_records(spark: SparkSession, path: str, schema: str = CHAT_SCHEMA, corrupt: bool = False) -> DataFrame:
    """All JSON lines of a manifest's shards with ``dataset`` (the entry) ; blank lines don't count.

    corrupt: malformed lines stay, in ``_corrupt_record``; else they raise.
    """
    parts = []
    for name, entry in read_manifest(spark, path).items():
        reader = spark.read.schema(f"{schema}, _corrupt_record string" if corrupt else schema).option("mode", "PERMISSIVE" if corrupt else "FAILFAST")
        parts.append(reader.json(entry["file_name"]).withColumn("dataset", F.lit(name)))
    if not parts:
        return spark.createDataFrame([], f"{schema}, dataset string")
    return reduce(DataFrame.unionByName, parts)


def parse_split(split: str | None) -> tuple[str | None, slice]:
    """ "train[1024:]" -> ("train", slice(1024, None))."""
    if split is None:
        return None, slice(None)
    m = re.fullmatch(r"([^\[\]]+)(?:\[(\d*):(\d*)\])?", split.strip())
    if not m:
        raise ValueError(f"not a split: {split}")
    start, stop = (int(x) if x else None for x in (m[2], m[3]))
    return m[1], slice(start, stop)


def read_messages(spark: SparkSession, paths: str | Sequence[str], skip_invalid: bool = False, schema: str = CHAT_SCHEMA) -> DataFrame:
    """Chat rows from parquet or JSON lines; malformed lines raise, or go with skip_invalid."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if all(p.rstrip("/").endswith(".parquet") for p in paths):
        return spark.read.parquet(*paths)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED" if skip_invalid else "FAILFAST").json(paths)


def read_json_or_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A JSON array or object in one file, or JSON lines: told apart by the first line."""
    first = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
    line = first[0]["value"].strip() if first else ""
    try:
        multi = not isinstance(json.loads(line), dict)
    except ValueError:
        multi = True
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("multiLine", multi).json(path)


def map_columns(df: DataFrame, roles: Mapping[str, str]) -> DataFrame:
    """Renames columns to logical roles; roles: role -> column.  ``answer`` is needed; rows with a blank answer go."""
    unknown = set(roles) - {"context", "question", "answer"}
    if unknown or "answer" not in roles:
        raise ValueError(f"roles are context, question and answer (needed), not {sorted(roles)}")
    return df.select(*[F.col(c).cast("string").alias(r) for r, c in roles.items()]).where(F.trim(F.coalesce("answer", F.lit(""))) != "")


def read_retrieval(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """{corpus, data} JSON -> queries (question_id, question, corpus_id, pos_doc and neg_doc as id arrays) and corpus paths."""
    raw = json.loads(read_text(spark, path))
    if not isinstance(raw, dict) or not {"corpus", "data"} <= set(raw):
        raise ValueError(f"{path}: corpus and data are needed")
    folder = path.rsplit("/", 1)[0]
    corpora = raw["corpus"] if isinstance(raw["corpus"], list) else [raw["corpus"]]
    paths = [c["path"] if re.match(r"^([a-z0-9]+:/|/)", c["path"]) else f"{folder}/{c['path']}" for c in corpora]
    item = "array<struct<id:string>>"
    df = spark.read.option("multiLine", True).schema(f"data array<struct<question_id:string,question:string,corpus_id:string,pos_doc:{item},neg_doc:{item}>>").json(path).select(F.inline("data"))
    needed = F.col("question").isNotNull() & F.col("corpus_id").isNotNull() & (F.size(F.coalesce("pos_doc", F.array().cast(item))) > 0)
    checked = F.when(needed, F.col("question")).otherwise(F.raise_error(F.lit("question, corpus_id and a positive are needed")).cast("string"))
    ids = lambda c: F.transform(F.coalesce(c, F.array().cast(item)), lambda d: d["id"])
    return df.select("question_id", checked.alias("question"), "corpus_id", ids(F.col("pos_doc")).alias("pos_doc"), ids(F.col("neg_doc")).alias("neg_doc")), paths


def read_inline_retrieval(df: DataFrame, name: str) -> DataFrame:
    """Rows with query|question, pos_doc, neg_doc as strings or arrays -> question, pos_doc, neg_doc arrays of texts, question_id ``name:n``."""
    if "corpus_id" in df.columns:
        raise ValueError("rows that name a corpus are read with read_retrieval")
    question = F.coalesce(*[F.col(c) for c in ("question", "query") if c in df.columns])
    kinds = dict(df.dtypes)
    many = lambda c: F.col(c) if kinds[c].startswith("array") else F.array_compact(F.array(F.col(c).cast("string")))
    key = F.monotonically_increasing_id() if "question_id" not in df.columns else F.lit(None)
    ident = F.col("question_id").cast("string") if "question_id" in df.columns else F.concat(F.lit(f"{name}:"), key.cast("string"))
    return df.select(ident.alias("question_id"), question.alias("question"), many("pos_doc").alias("pos_doc"), many("neg_doc").alias("neg_doc"))


def is_delta(path: str, listing: Sequence[str] = ()) -> bool:
    """A Delta address, or a folder (its listing given) with a transaction log."""
    return bool(DELTA_PATH.match(path)) or "_delta_log" in listing


def quote_name(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def read_delta(spark: SparkSession, path: str | None = None, columns: Sequence[str] = (), version: int | None = None, sql_query: str | None = None) -> DataFrame:
    """A Delta table by path or name, or a query; columns wrap the query.  Needs the Delta package on the class path."""
    if sql_query:
        cols = ", ".join(f"`{c}`" for c in columns) or "*"
        return spark.sql(f"SELECT {cols} FROM ({sql_query.rstrip().rstrip(';')}) AS _q")
    if DELTA_PATH.match(path or "") or "/" in (path or ""):
        reader = spark.read.format("delta")
        df = (reader.option("versionAsOf", version) if version is not None else reader).load(re.sub(r"^delta://", "", path))
    else:
        name = quote_name(*path.split("."))
        df = spark.sql(f"SELECT * FROM {name}" + (f" VERSION AS OF {int(version)}" if version is not None else ""))
    return df.select(*columns) if columns else df


def conll_sentences(lines: DataFrame, n_columns: int = 2) -> DataFrame:
    """CoNLL files (one whole file a row: path, value) -> (path, sentence, tokens, tags); blank lines part sentences, short lines go."""
    blocks = F.posexplode(F.split("value", r"\n[ \t]*\n"))
    rows = lines.select("path", blocks.alias("sentence", "block"))
    parts = F.filter(F.transform(F.split("block", "\n"), lambda x: F.split(F.trim(x), r"\s+")), lambda p: F.size(p) >= n_columns)
    out = rows.withColumn("_p", parts).where(F.size("_p") > 0)
    return out.select("path", F.col("sentence").cast("long").alias("sentence"), F.transform("_p", lambda p: p[0]).alias("tokens"), F.transform("_p", lambda p: F.element_at(p, -1)).alias("tags"))


def bio_spans(tokens: str, tags: str):
    """array<struct<type, text>> of BIO-tagged entities: B or a change of type opens, anything without a dash closes; PERS is PER."""
    pairs = F.arrays_zip(F.col(tokens).alias("t"), F.col(tags).alias("g"))
    span = "struct<type:string,text:string>"
    start = F.struct(F.lit("").alias("open"), F.array().cast(f"array<{span}>").alias("out"))

    def step(acc, x):
        kind = F.replace(F.regexp_extract(x["g"], r"^[BI]-(.+)$", 1), F.lit("PERS"), F.lit("PER"))
        goes_on = (kind != "") & (kind == acc["open"]) & ~F.startswith(x["g"], F.lit("B-"))
        last = F.try_element_at(acc["out"], F.lit(-1))
        grown = F.concat(F.slice(acc["out"], 1, F.greatest(F.size(acc["out"]) - 1, F.lit(0))), F.array(F.struct(last["type"].alias("type"), F.concat(last["text"], F.lit(" "), x["t"]).alias("text"))))
        opened = F.concat(acc["out"], F.array(F.struct(kind.alias("type"), x["t"].alias("text"))))
        return F.struct(kind.alias("open"), F.when(goes_on, grown).when(kind != "", opened).otherwise(acc["out"]).alias("out"))

    return F.aggregate(pairs, start, step, lambda acc: acc["out"])
