"""Benchmark decontamination: digests of whole texts and of 12-token fragments."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import FRAGMENT_TOKENS, canonical, digest, fragments, token_count

#: Blocklists of at most so many rows are broadcast; larger ones go through a shuffle join.
BROADCAST_ROWS = 500_000
#: Hashes of fragments (8 bytes each) that are broadcast at most.
EDGE_ROWS = 4_000_000


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks df for broadcast if it is counted to be small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def benchmark_fields(df: DataFrame, fields: Sequence[tuple[str, Column]], benchmark: Column | str) -> DataFrame:
    """Unpivots derived fields of a benchmark to (benchmark, field, text); blank texts go."""
    name = F.lit(benchmark) if isinstance(benchmark, str) else benchmark
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), c.alias("text")) for n, c in fields])
    return df.select(name.alias("benchmark"), F.inline(pairs)).where(F.trim("text") != "")


def blocklist(fields: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(benchmark, field, text) -> (digest, benchmark, field) and (fragment, benchmark, field), the least origin of each."""
    rows = fields.select("benchmark", "field", digest("text").alias("digest"), fragments("text").alias("fragments"))
    origin = F.min(F.struct("benchmark", "field")).alias("o")
    whole = rows.groupBy("digest").agg(origin).select("digest", "o.benchmark", "o.field")
    parts = rows.select(F.explode("fragments").alias("fragment"), "benchmark", "field").groupBy("fragment").agg(origin).select("fragment", "o.benchmark", "o.field")
    return whole, parts


def edges(fields: DataFrame) -> DataFrame:
    """(benchmark, field, text) -> (edge): the distinct hashes of fragments that ``suspects`` looks for."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, h in window_hashes(*_bytes(batch.column(0))):
                yield pa.RecordBatch.from_pydict({"edge": h.view(np.int64)})

    return fields.select(canonical("text").alias("c")).mapInArrow(hashes, "edge long").distinct()


def spread(df: DataFrame) -> DataFrame:
    """df in as many partitions as there are cores, if fewer hold rows: a file is split by bytes, but its rows are read by row group.

    Partitions that hold rows are counted without reading a column; tables of many files stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores and df.select(F.spark_partition_id().alias("p")).distinct().count() >= cores:
        return df
    return df.repartition(cores)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the start of each text (nulls are empty)."""
    texts = texts.cast(pa.large_string())
    texts = texts.fill_null("") if texts.null_count else texts
    _, offsets, data = texts.buffers()
    return np.frombuffer(data or b"", np.uint8), np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)


#: For bytes of UTF-8: ASCII white space (as ``str.split`` has it) to spaces, and the same with small letters.
_SPACES = bytes(32 if i < 128 and chr(i).isspace() else i for i in range(256))
_SMALL = _SPACES.lower()
#: White space beyond ASCII that compatibility forms leave as it is.
_RARE = ("\x85", "\u1680", "\u2028", "\u2029")


def _folded(text: str) -> bytes:
    """Canonical form of a text, but for spaces inside that are not collapsed yet."""
    if text.isascii():
        return text.encode().translate(_SMALL).strip(b" ")
    text = unicodedata.normalize("NFKC", text).casefold()
    if any(c in text for c in _RARE):
        text = " ".join(text.split())
    return text.encode().translate(_SPACES).strip(b" ")


def canonical_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the canonical forms of a string array and the start of each (nulls are empty)."""
    parts = [b"" if x is None else _folded(x) for x in texts.to_pylist()]
    data, offsets = np.frombuffer(b"".join(parts), np.uint8), np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    space = data == 32
    again = np.flatnonzero(space[1:] & space[:-1]) + 1
    return (np.delete(data, again), offsets - np.searchsorted(again, offsets)) if len(again) else (data, offsets)


def token_counts(texts: pa.Array) -> np.ndarray:
    """``text.token_count`` of a string array."""
    data, offsets = _bytes(texts)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]  # of a slice the buffer holds all
    first, end = offsets[:-1], offsets[1:]
    ink = (data != 32) & ((data < 9) | (data > 13))
    starts = ink.copy()
    starts[1:] &= ~ink[:-1]
    heads = first[end > first]
    starts[heads] = ink[heads]
    return np.diff(np.searchsorted(np.flatnonzero(starts), offsets))


_BYTE = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _power(n: int) -> list[np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 2**20), base, np.uint64)])) for base in (_BASE, pow(_BASE, -1, 2**64))]
    return _powers


def among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which hashes are in known, which is sorted: by bisection, as ``np.isin`` would sort known again for each block."""
    at = np.searchsorted(known, hashes)
    out = at < len(known)
    out[out] = known[at[out]] == hashes[out]
    return out


#: Windows that are hashed at a time: their sums and powers stay in a core's own cache.
WINDOWS = 2**14


def window_hashes(data: np.ndarray, offsets: np.ndarray, n: int = FRAGMENT_TOKENS, block: int = WINDOWS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, first byte, end byte, hash) of all n-token windows of canonical texts, ``block`` windows at a time.

    Tokens of a canonical text are one space apart, so a window is a run of bytes and its hash a difference of prefix sums.
    """
    first, end = offsets[:-1], offsets[1:]
    some = end > first
    space = np.flatnonzero(data[offsets[0] : offsets[-1]] == 32) + offsets[0]
    starts, ends = np.sort(np.concatenate([first[some], space + 1]), kind="stable"), np.sort(np.concatenate([space, end[some]]), kind="stable")
    owner = np.repeat(np.flatnonzero(some), np.diff(np.searchsorted(space, offsets))[some] + 1)
    whole = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :]) if len(owner) >= n else np.zeros(0, np.int64)
    for at in range(0, len(whole), block):
        i = whole[at : at + block]
        lo, hi = starts[i[0]], ends[i[-1] + n - 1]
        p, q = _power(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[data[lo:hi]] * p[: hi - lo], out=sums[1:])
        s, e = starts[i], ends[i + n - 1]
        h = (sums[e - lo] - sums[s - lo]) * q[s - lo]
        yield owner[i], s, e, (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def suspects(docs: DataFrame, edge_table: DataFrame, text_col: str = "text", tokens: str | None = None) -> DataFrame:
    """Texts -> the ``digest`` of their canonical form and ``fragments``, the digests of those of its windows whose hash is in
    edge_table, in the text's stead; other columns stay.  With tokens, a column of that name has the text's token_count.  One pass;
    the hashes are broadcast if they are counted to be few, else all windows are suspect."""
    docs = spread(docs).select(*[c for c in docs.columns if c != text_col], text_col)
    if edge_table.limit(EDGE_ROWS + 1).count() > EDGE_ROWS:
        counted = {tokens: token_count(text_col)} if tokens else {}
        return docs.withColumns({"digest": digest(text_col), "fragments": fragments(text_col)} | counted).drop(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(np.sort(edge_table.toPandas()["edge"].to_numpy(np.int64).view(np.uint64)))
    new = [T.StructField("digest", T.StringType()), T.StructField("fragments", T.ArrayType(T.StringType()))]
    new += [T.StructField(tokens, T.LongType())] if tokens else []

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        shift = np.uint64(64 - min(26, max(16, len(known).bit_length() + 6)))
        maybe = np.zeros(1 << int(np.uint64(64) - shift), bool)
        maybe[(known >> shift).astype(np.int64)] = True
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            texts = batch.column(batch.num_columns - 1)
            data, offsets = canonical_bytes(texts)
            found: dict[int, dict[str, None]] = {}
            for owner, s, e, h in window_hashes(data, offsets):
                near = np.flatnonzero(maybe[(h >> shift).astype(np.int64)])
                for i in near[among(h[near], known)]:
                    found.setdefault(int(owner[i]), {})[hashlib.md5(data[s[i] : e[i]]).hexdigest()] = None
            ends = offsets.tolist()
            digests = [hashlib.md5(data[ends[i] : ends[i + 1]]).hexdigest() if ok else None for i, ok in enumerate(texts.is_valid().to_pylist())]
            lists = pa.array([list(found.get(i, ())) for i in range(batch.num_rows)], pa.list_(pa.string()))
            made = [pa.array(digests, pa.string()), lists, *([pa.array(token_counts(texts), pa.int64())] if tokens else [])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], *[f.name for f in new]])

    return docs.mapInArrow(look, T.StructType([*docs.drop(text_col).schema.fields, *new]))


def hits(marked: DataFrame, whole: DataFrame, parts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, benchmark, field, kind) of rows with ``digest`` and ``fragments`` that are in the blocklist."""
    known = whole.select(F.lit(0).alias("rank"), "digest", "benchmark", "field").union(parts.select(F.lit(1), "fragment", "benchmark", F.concat("field", F.lit(":fragment"))))
    keys = F.concat(F.array(F.struct(F.lit(0).alias("rank"), F.col("digest"))), F.transform("fragments", lambda f: F.struct(F.lit(1).alias("rank"), f.alias("digest"))))
    found = marked.select(id_col, F.inline(keys)).join(sized(known), ["rank", "digest"])
    best = found.groupBy(id_col).agg(F.min(F.struct("rank", "benchmark", "field")).alias("hit"))
    return best.select(id_col, "hit.benchmark", "hit.field", F.when(F.col("hit.rank") == 0, "exact").otherwise("fragment").alias("kind"))


def match(docs: DataFrame, whole: DataFrame, parts: DataFrame, id_col: str = "doc_id", text_col: str = "text", edge_table: DataFrame | None = None) -> DataFrame:
    """(id, benchmark, field, kind) of each contaminated document: an exact match before a fragment match, then the least origin.

    With ``edge_table`` (see ``edges``) documents are searched in one pass for the hash of a fragment, and digests are made only
    of windows that have one.  Either way the hits are those of full digests.
    """
    if edge_table is None:
        marked = docs.select(id_col, digest(text_col).alias("digest"), fragments(text_col).alias("fragments"))
    else:
        marked = suspects(docs.select(id_col, text_col), edge_table, text_col)
    return hits(marked, whole, parts, id_col)


def decontaminate(docs: DataFrame, whole: DataFrame, parts: DataFrame, id_col: str = "doc_id", text_col: str = "text", edge_table: DataFrame | None = None) -> DataFrame:
    """Documents without a match."""
    return docs.join(match(docs, whole, parts, id_col, text_col, edge_table).select(id_col), id_col, "left_anti")
