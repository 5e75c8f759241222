"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

A text is cut into sections (runs of blank lines part them), a section into paragraphs (lines) and a
paragraph into leaves (sentences; a leaf never passes LEAF characters: longer ones are cut
where a rolling hash of the last SPAN characters says so, so an edit moves only the cuts near it).
Separators belong to the piece before them, so the leaves put together are the text.  A leaf's digest
covers its characters, a node's digest its children's digests in order, and the root the sections' digests:
equal roots mean equal texts.  Two trees are compared from the root down: what has the same digest in both is
common as a whole, and only the children of what is left are looked at, which locates edits.

The fingerprint is a string: root (32 hex digits), a colon, and the tree in preorder as base64 of ten bytes a
node: digest (8), level (2 section, 1 paragraph, 0 leaf) and a leaf's length.  The likeness of two fingerprints
is 1 for equal roots, else twice the characters in common nodes (as multisets) over the characters of both.

Cuts and digests are made by numpy over the code points of many texts at once, in time linear in
their length.  Null texts count as empty.  Two empty texts are equal (likeness 1).  Repeated rows get the same
fingerprint each.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

#: Characters of a leaf, at most (a byte holds its length).
LEAF = 240
#: Characters that decide where a long leaf is cut.
SPAN = 8
#: Characters handled at once.
RUN = 1 << 20
SECTION, PARAGRAPH, LEAF_NODE = 2, 1, 0
NODE = np.dtype([("digest", "<u8"), ("level", "u1"), ("size", "u1")])
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _digest_runs(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A digest of each run of digests, their order included; runs begin at ``starts``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(values)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(values)]])))
    mixed = common.mix(values + (place.astype(np.uint64) + np.uint64(1)) * _STEP)
    return common.mix(np.add.reduceat(mixed, starts) ^ np.diff(np.concatenate([starts, [len(values)]])).astype(np.uint64))


def _long_cuts(start: int, end: int, places: np.ndarray) -> list[int]:
    """Cuts of a piece longer than LEAF: the first hashed place past a quarter of a leaf, else a whole leaf."""
    out = []
    i = int(np.searchsorted(places, start))
    while end - start > LEAF:
        while i < len(places) and places[i] < start + LEAF // 4:
            i += 1
        start = int(places[i]) if i < len(places) and places[i] <= start + LEAF else start + LEAF
        out.append(start)
    return out


def _trees(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the trees of all texts, one after the other in preorder, and where each text's nodes begin."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.concatenate([[0], np.cumsum(sizes)])
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(c)
    if not n:
        return np.zeros(0, NODE), np.zeros(len(texts) + 1, np.int64)
    line = c == 10
    end = (c == 46) | (c == 33) | (c == 63)  # . ! ?
    space = line | (c == 32) | ((c >= 9) & (c <= 13)) | (c == 0xA0) | (c == 0x85) | (c == 0x2028) | (c == 0x2029) | ((c >= 0x2000) & (c <= 0x200A)) | (c == 0x3000)
    start_of = np.repeat(first[:-1], sizes)  # of the text that a place is in
    begins = np.arange(n) == start_of
    paragraph, section = begins.copy(), begins.copy()
    after = ~line[1:] & line[:-1]
    paragraph[1:] |= after
    section[2:] |= after[1:] & line[:-2] & (np.arange(n - 2) >= start_of[2:])
    # a sentence begins after a run of . ! ? and the white space behind it
    solid = np.maximum.accumulate(np.where(space, -1, np.arange(n)))
    before = np.concatenate([[-1], solid[:-1]])
    begins |= paragraph | (~space & ~end & (before >= start_of) & end[np.maximum(before, 0)])
    starts = np.flatnonzero(begins)
    sums = np.zeros(n + 1, np.uint64)
    powers, inverse = common.powers(n + 1)
    np.cumsum((c.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    ends = np.concatenate([starts[1:], [n]])
    long = np.flatnonzero(ends - starts > LEAF)
    if len(long):
        near = common.mix((sums[SPAN:] - sums[:-SPAN]) * inverse[: n - SPAN + 1])  # of the SPAN characters before a place
        places = np.flatnonzero(near % np.uint64(64) == 0) + SPAN
        more = [x for i in long for x in _long_cuts(int(starts[i]), int(ends[i]), places)]
        starts = np.sort(np.concatenate([starts, np.array(more, np.int64)]))
        ends = np.concatenate([starts[1:], [n]])
    leaf = common.mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    p_at = np.flatnonzero(paragraph[starts])  # leaf that begins each paragraph
    s_at = np.flatnonzero(section[starts][p_at])  # paragraph that begins each section
    p_digest = _digest_runs(leaf, p_at)
    s_digest = _digest_runs(p_digest, s_at)
    p_before, s_before = np.cumsum(paragraph[starts]), np.cumsum(section[starts])
    nodes = np.zeros(len(leaf) + len(p_at) + len(s_at), NODE)
    at = np.arange(len(leaf)) + p_before + s_before
    nodes["digest"][at], nodes["size"][at] = leaf, ends - starts
    nodes["digest"][at[p_at] - 1], nodes["level"][at[p_at] - 1] = p_digest, PARAGRAPH
    s_place = at[p_at[s_at]] - 2
    nodes["digest"][s_place], nodes["level"][s_place] = s_digest, SECTION
    # a text's first leaf has its paragraph and section before it
    leaf_of = np.searchsorted(starts, first[:-1])
    offsets = np.where(leaf_of < len(at), at[np.minimum(leaf_of, len(at) - 1)] - 2, len(nodes))
    return nodes, np.concatenate([offsets, [len(nodes)]])


def _runs_of(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about RUN characters."""
    at = chars = 0
    for i, t in enumerate(texts):
        chars += len(t)
        if chars >= RUN or i == len(texts) - 1:
            yield at, i + 1
            at, chars = i + 1, 0


def fingerprint_many(texts: list[str]) -> list[str]:
    out = []
    for lo, hi in _runs_of(texts):
        nodes, offsets = _trees(texts[lo:hi])
        for i in range(hi - lo):
            own = nodes[offsets[i] : offsets[i + 1]]
            root = hashlib.blake2b(own["digest"][own["level"] == SECTION].tobytes(), digest_size=16).hexdigest()
            out.append(f"{root}:{base64.b64encode(own.tobytes()).decode()}")
    return out


def fingerprint(text: str | None) -> str:
    return fingerprint_many([text or ""])[0]


def _nodes(prints: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of all fingerprints and the number of the fingerprint that each belongs to."""
    raw = [base64.b64decode(p[33:]) for p in prints]
    return np.frombuffer(b"".join(raw), NODE), np.repeat(np.arange(len(raw)), [len(r) // NODE.itemsize for r in raw])


def _in_both(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys of a and of b are in both, as multisets."""

    def ranked(v: np.ndarray) -> np.ndarray:
        order = np.argsort(v, kind="stable")
        s = v[order]
        first = np.maximum.accumulate(np.where(np.concatenate([[True], s[1:] != s[:-1]]), np.arange(len(s)), 0))
        out = np.empty(len(v), np.uint64)
        out[order] = common.mix(s + (np.arange(len(s)) - first).astype(np.uint64) * _STEP)
        return out

    if not len(a) or not len(b):
        return np.zeros(len(a), bool), np.zeros(len(b), bool)
    x, y = ranked(a), ranked(b)
    return np.isin(x, y), np.isin(y, x)


def _common_characters(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], pairs: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Characters that the trees of each pair share, and which nodes of a and b lie in shared ones: level by level from the top."""
    shared = [np.zeros(len(a[0]), bool), np.zeros(len(b[0]), bool)]
    for level in (SECTION, PARAGRAPH, LEAF_NODE):
        open_ = [np.flatnonzero((nodes["level"] == level) & ~s) for (nodes, _), s in zip((a, b), shared, strict=True)]
        keys = [common.mix(nodes["digest"][i] + owner[i].astype(np.uint64) * np.uint64(0xA3B195354A39B70D) + np.uint64(level)) for (nodes, owner), i in zip((a, b), open_, strict=True)]
        for (nodes, _), s, i, hit in zip((a, b), shared, open_, _in_both(*keys), strict=True):
            hit = i[hit]
            s[hit] = True
            if level != LEAF_NODE and len(hit):  # all below a shared node is shared
                top = np.flatnonzero(nodes["level"] >= level)
                until = np.concatenate([top[1:], [len(nodes)]])[np.searchsorted(top, hit)]
                edge = np.zeros(len(nodes) + 1, np.int32)
                np.add.at(edge, hit, 1)
                np.add.at(edge, until, -1)
                s |= np.cumsum(edge[:-1]) > 0
    nodes, owner = a
    return np.bincount(owner[shared[0]], nodes["size"][shared[0]], pairs), shared


def likeness_many(left: list[str], right: list[str]) -> np.ndarray:
    """Likeness of each pair of fingerprints: 0 to 1; 1 only for equal roots."""
    a, b = _nodes(left), _nodes(right)
    both, _ = _common_characters(a, b, len(left))
    total = np.bincount(a[1], a[0]["size"], len(left)) + np.bincount(b[1], b[0]["size"], len(left))
    same = np.fromiter((x[:32] == y[:32] for x, y in zip(left, right, strict=True)), bool, len(left))
    return np.where(same, 1.0, np.minimum(2 * both / np.maximum(total, 1), 0.999999))


def likeness(a: str, b: str) -> float:
    return float(likeness_many([a], [b])[0])


def differing_paragraphs(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of fingerprint a whose subtree fingerprint b doesn't have; equal branches are passed over."""
    if a[:32] == b[:32]:
        return []
    left, right = _nodes([a]), _nodes([b])
    _, (shared, _) = _common_characters(left, right, 1)
    level = left[0]["level"]
    section = np.cumsum(level == SECTION) - 1
    paragraph = np.cumsum(level == PARAGRAPH)
    before = np.concatenate([[0], paragraph])[np.flatnonzero(level == SECTION)]  # paragraphs before each section
    return [(int(section[i]), int(paragraph[i] - 1 - before[section[i]])) for i in np.flatnonzero((level == PARAGRAPH) & ~shared)]


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text -> doc_id, n_chars, fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in common.pieces(batch, 1):
                texts = [t or "" for t in own.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(fingerprint_many(texts), pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def _dealt(docs: DataFrame, parts: int) -> DataFrame:
    """docs: doc_id, text -> (slice, doc_id, text, tail), ordered inside slices of the key range.

    The key range is cut at quantiles into four slices a part; every slice also gets a copy of the first row of the
    slice after it (tail = 1), so no task needs more than its slice and no window spans the table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slices = 4 * parts
    cuts = ", ".join(str((k + 1) / slices) for k in range(slices - 1))
    bounds = sorted(set(docs.agg(F.expr(f"percentile_approx(doc_id, array({cuts}), 10000)").alias("q")).first()["q"] or []))
    below = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    rows = docs.withColumn("slice", F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(below, lambda b: b < F.col("doc_id")))))
    # the first key of each slice is wanted by the slice before it, the first slice's by the last
    firsts = rows.groupBy("slice").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("real"), "doc_id")).alias("key")).orderBy("slice").collect()  # ``slices`` rows at most
    heads = docs.sparkSession.createDataFrame([(r["slice"], r["key"]["doc_id"], firsts[k - 1]["slice"]) for k, r in enumerate(firsts)], "slice int, first_id long, to int")
    copies = rows.join(F.broadcast(heads), "slice").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    extra = copies.select("doc_id", "text", F.col("to").alias("slice"), F.lit(1).alias("tail"))
    both = rows.withColumn("tail", F.lit(0)).unionByName(extra)
    return both.repartition(parts, "slice").sortWithinPartitions("slice", "tail", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()).select("slice", "doc_id", "text", "tail")


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Ordered rows of slices -> lists of (doc_id, text, next text) of a few MB."""
    before = None  # (slice, doc_id, text, tail)
    out: list[tuple] = []
    size = 0
    for batch in batches:
        for own in common.pieces(batch, 2):
            for row in zip(*(own.column(c).to_pylist() for c in ("slice", "doc_id", "text", "tail")), strict=True):
                if before is not None and not before[3] and before[0] == row[0]:
                    out.append((before[1], before[2], row[2]))
                    size += len(before[2] or "")
                    if size > RUN:
                        yield out
                        out, size = [], 0
                before = row
    if out:
        yield out


def in_order(docs: DataFrame, parts: int) -> DataFrame:
    """docs: doc_id, text -> (doc_id, text, next_text): each row with the next row's text, ascending doc_id; after the last the first.

    Equal doc_ids follow each other by text; null doc_ids come first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _followed(batches):
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], names=["doc_id", "text", "next_text"])

    return _dealt(docs, parts).mapInArrow(run, "doc_id long, text string, next_text string")


def edit(text: str, following: str) -> str:
    """text with its last floor(n / 2) characters replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.job(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _followed(batches):
            texts, following = [r[1] or "" for r in rows], [r[2] or "" for r in rows]
            edited = [edit(t, f) for t, f in zip(texts, following, strict=True)]
            # the next row is this row's next text, but at the end of a slice
            own = fingerprint_many([*texts, following[-1]])
            after = own[1:]
            other = [i for i in range(len(rows) - 1) if following[i] != texts[i + 1]]
            for i, fp in zip(other, fingerprint_many([following[i] for i in other]), strict=True):
                after[i] = fp
            own = own[:-1]
            changed = fingerprint_many(edited)
            sha = [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]
            columns = [[r[0] for r in rows], [len(t) for t in texts], sha, own, changed, likeness_many(own, changed), likeness_many(own, after)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split(" ")[0] for f in schema.split(", ")])

    return _dealt(docs, common.shuffle_partitions(spark)).mapInArrow(run, schema)
