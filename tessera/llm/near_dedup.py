"""MinHash near-dedup: a chosen-path similarity join over word-shingle sets.

1. Every text becomes the set of its distinct k-word shingles (64-bit hashes), a digest of
   that set and a MinHash vector.  Texts with equal sets collapse to their smallest id, so a
   group of copies of any size is one row from here on.
2. Chosen paths: each of ``trees`` trees sends a set to the child named by one MinHash
   coordinate and its value.  The number of sets in each node is counted; nodes of more than
   ``leaf`` sets branch on, every set into ``branch`` children picked by the path, until all
   are small, branching would hardly lessen the pairs or ``depth`` is reached (what is left
   then is compared in all pairs of blocks).  A pair at similarity s shares a child with probability 1 - (1 - s) ** branch.
3. Small nodes are compared exhaustively on the MinHash vectors; of the pairs whose estimate
   lies above the threshold less five standard errors, a spanning forest is enough, as only
   connectivity counts.  Its components are candidate clusters.
4. Exact check on the full sets: all members of a cluster meet once (in pairs of blocks if the
   cluster is large) and every pair with intersection * 100 >= percent * union is a link.

Null, empty and wordless texts have an empty set, link with nothing and stay.  Repeated rows
are copies of each other; rows with one doc_id and different texts are sets of their own that bear one id.  Extra columns are ignored by ``near_duplicates`` and kept by
``drop_near_duplicates``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

COORDS = 64
#: Shingles that the members of a block hold together, about: long texts make smaller blocks.
BLOCK_SHINGLES = 4_000_000
_ODD = np.random.default_rng(7).integers(1, 2**63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = np.random.default_rng(8).integers(1, 2**63, COORDS, dtype=np.uint64)


def _unique_sets(h: np.ndarray, counts: np.ndarray, k: int) -> list[np.ndarray]:
    s, n = common.shingles(h, counts, k)
    return [np.unique(x) for x in np.split(s, np.cumsum(n)[:-1])]


def _describe(k: int):
    """Per text: set size, digest of the set, MinHash vector (uint32 x COORDS)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, h, counts in common.words_by_text(batch.column(1), fold=True):
                sets = _unique_sets(h, counts, k)
                sizes = np.array([len(x) for x in sets], np.int64)
                some = np.flatnonzero(sizes)
                digest: list[bytes | None] = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
                vectors = np.zeros((len(sets), COORDS), np.uint32)
                if len(some):
                    flat = np.concatenate([sets[i] for i in some])
                    at = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
                    for c in range(COORDS):
                        vectors[some, c] = np.minimum.reduceat((flat ^ _XOR[c]) * _ODD[c], at) >> np.uint64(32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(sets)), pa.array(sizes), pa.array(digest, pa.binary()), pa.array([v.tobytes() if n else None for v, n in zip(vectors, sizes, strict=True)], pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "sig"],
                )

    return run


def _vectors(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint32).reshape(-1, COORDS)


def _agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many coordinates the rows agree."""
    words = (x == y).view(np.uint64).sum(axis=1)  # eight coordinates a byte each
    return ((words * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int64)


def _branch(trees: int, branch: int, first: bool):
    """(node, id, sig) -> a row (parent, node, id) for each child the set goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id")
            sig = _vectors(batch.column("sig"))
            rows = np.arange(len(sig))
            for j in range(trees if first else branch):
                node = np.full(len(sig), j + 1, np.uint64) if first else batch.column("node").to_numpy().view(np.uint64)
                pick = common.mix(node * np.uint64(0x9E3779B97F4A7C15) + np.uint64(13)) + np.uint64(29 * j)  # an odd step: no coordinate twice
                coord = np.full(len(sig), j * COORDS // trees) if first else (pick % np.uint64(COORDS)).astype(np.int64)
                child = common.mix(node * np.uint64(0xD6E8FEB86659FD93) + coord.astype(np.uint64) * np.uint64(0xA3B195354A39B70D) + sig[rows, coord].astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(child.view(np.int64)), ids], names=["parent", "node", "id"])

    return run


def _spanning(m: int, linked) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest over 0..m-1; linked(i, others) -> mask of the others linked with i.

    Breadth first: a member found leaves the rest, so a dense group takes little more than one
    pass while every unlinked pair is still looked at.
    """
    left, right = [], []
    rest = np.arange(m)
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            ok = linked(i, rest)
            found = rest[ok]
            if len(found):
                left.append(np.full(len(found), i))
                right.append(found)
                queue += found.tolist()
                rest = rest[~ok]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _runs(batches: Iterator[pa.RecordBatch], key: int = 1) -> Iterator[pa.Table]:
    """Splits sorted rows into runs of equal values of the first ``key`` columns."""
    held: list[pa.RecordBatch] = []
    names: list[str] = []

    def flush():
        return pa.Table.from_batches(held)

    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names[:key]
        new = np.zeros(batch.num_rows, bool)
        for c in names:
            v = batch.column(c).to_numpy(zero_copy_only=False)
            new[1:] |= v[1:] != v[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for x, y in zip(starts[:-1], starts[1:], strict=True):
            if held and any(held[-1].column(c)[0] != batch.column(c)[x] for c in names):
                yield flush()
                held = []
            held.append(batch.slice(x, y - x))
    if held:
        yield flush()


def _leaf_edges(low: float, ratio: float):
    """(node, id, n, sig) sorted by node -> candidate edges (a, b): a spanning forest a node."""
    least = low * COORDS

    def compare(ids: np.ndarray, n: np.ndarray, sig: np.ndarray):
        sig = np.ascontiguousarray(sig)

        def linked(i: int, rest: np.ndarray) -> np.ndarray:
            return (_agree(sig[rest], sig[i]) >= least) & (np.minimum(n[rest], n[i]) >= ratio * np.maximum(n[rest], n[i]))

        a, b = _spanning(len(ids), linked)
        return ids[a], ids[b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray]] = []
        pair: list[pa.Table] = []

        def pack():
            a, b = (np.concatenate([x[i] for x in out]) for i in (0, 1))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        def two():
            t = pa.concat_tables(pair)
            pair.clear()
            ids, n = t["id"].to_numpy(), t["n"].to_numpy()
            sig = _vectors(t["sig"].combine_chunks())
            same = _agree(sig[::2], sig[1::2])
            lo, hi = np.minimum(n[::2], n[1::2]), np.maximum(n[::2], n[1::2])
            ok = (same >= least) & (lo >= ratio * hi)
            out.append((ids[::2][ok], ids[1::2][ok]))

        for node in _runs(batches):
            if node.num_rows == 2:
                pair.append(node)
                if len(pair) >= 2000:
                    two()
            elif node.num_rows > 2:
                ids, n = node["id"].to_numpy(), node["n"].to_numpy()
                sig = _vectors(node["sig"].combine_chunks())
                out.append(compare(ids, n, sig))
            if len(out) >= 5000:
                yield pack()
        if pair:
            two()
        if out:
            yield pack()

    return run


def _block_pairs(big: DataFrame, leaf: int) -> DataFrame:
    """(node, id, size) of nodes of more than ``leaf`` sets -> (node, id): a node for each pair of blocks of about leaf / 2 sets, so that all pairs meet."""
    half = max(1, leaf // 2)
    dealt = big.withColumn("blocks", F.ceil(F.col("size") / F.lit(half)).cast("int")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pairs = dealt.select("node", "id", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).where("other <> block")
    return pairs.select(F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other")).alias("node"), "id")


def candidate_clusters(sets: DataFrame, threshold: float, trees: int, branch: int, leaf: int, depth: int) -> DataFrame:
    """Chosen-path trees over (id, n, sig) -> (id, label) of the candidate clusters."""
    spark = sets.sparkSession
    rows = sets.select("id", "sig").mapInArrow(_branch(trees, branch, True), "parent long, node long, id long").select("node", "id")
    small: list[DataFrame] = []
    for level in range(1, depth + 1):
        # sizes are counted before the shuffle; the join can be split where a node is hot
        size = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        near = common.cut(rows.join(size, "node").select("node", "id", "size"))
        big = near.where(F.col("size") > leaf)
        small.append(near.where(F.col("size") <= leaf).select("node", "id"))
        if big.isEmpty():
            break
        if level == depth:
            small.append(_block_pairs(big, leaf))
            break
        below = big.select("node", "id").join(sets.select("id", "sig"), "id").select("node", "id", "sig")
        below = common.cut(below.mapInArrow(_branch(trees, branch, False), "parent long, node long, id long").distinct())
        # a node whose children have nearly as many pairs as itself gains nothing by branching and is compared whole
        share = below.groupBy("parent", "node").agg(F.count("*").cast("double").alias("n")).groupBy("parent").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
        whole = share.join(big.groupBy("node").agg(F.first("size").alias("size")), F.col("parent") == F.col("node")).where(F.col("pairs") > 0.75 * F.col("size") * F.col("size")).select("parent")
        whole = common.cut(whole)
        small.append(_block_pairs(big.join(F.broadcast(whole), F.col("parent") == F.col("node"), "left_semi"), leaf))
        rows = below.join(F.broadcast(whole), "parent", "left_anti").select("node", "id")
    small_all = small[0]
    for more in small[1:]:
        small_all = small_all.union(more)
    error = (threshold * (1 - threshold) / COORDS) ** 0.5
    edges = (
        small_all.join(sets, "id")
        .select("node", "id", "n", "sig")
        .repartition(common.shuffle_partitions(spark), "node")
        .sortWithinPartitions("node", "id")
        .mapInArrow(_leaf_edges(threshold - 5 * error, threshold), "a long, b long")
    )
    return common.connected_components(edges)


def _labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and the least node of the component of each."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    x, y = where[: len(a)], where[len(a) :]
    while True:
        before = label.copy()
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
        if (before == label).all():
            return nodes, nodes[label]


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Exact intersection sizes of all pairs of sets, as products of 0/1 matrices (float32 is exact below 2**24)."""
    m = len(sets)
    values, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rename = np.full(len(values), -1)
    shared = count > 1
    rename[shared] = np.arange(shared.sum())
    column = rename[inverse]
    row = np.repeat(np.arange(m), [len(x) for x in sets])
    row, column = row[column >= 0], column[column >= 0]
    by = np.argsort(column, kind="stable")
    row, column = row[by], column[by]
    total = np.zeros((m, m), np.float32)
    step = 2048
    for at in range(0, int(shared.sum()), step):
        lo, hi = np.searchsorted(column, [at, at + step])
        dense = np.zeros((m, step), np.float32)
        dense[row[lo:hi], column[lo:hi] - at] = 1
        total += dense @ dense.T
    return total


def _exact_links(k: int, percent: int):
    """(cluster, blocks, i, j, block, id, text) sorted by cluster, i, j -> links (a, b) as a spanning forest.

    i = j: all pairs of a block; i < j: pairs between two blocks of a large cluster.  With one block the
    components are known at once: b is then the least id linked with a, and ``final`` is true.
    """

    def links(ids: np.ndarray, block: np.ndarray, sets: list[np.ndarray], across: bool):
        m = len(sets)
        n = np.array([len(x) for x in sets])
        total = None if m <= 16 else _intersections(sets)

        def linked(i: int, rest: np.ndarray) -> np.ndarray:
            inter = np.array([len(np.intersect1d(sets[i], sets[r], assume_unique=True)) for r in rest]) if total is None else total[i, rest].astype(np.int64)
            ok = 100 * inter >= percent * (n[i] + n[rest] - inter)
            return ok & (block[rest] != block[i]) if across else ok

        a, b = _spanning(m, linked)
        return ids[a], ids[b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, 3):
            if group.num_rows < 2:
                continue
            sets: list[np.ndarray] = []
            for chunk in group["text"].chunks:
                for _, h, counts in common.words_by_text(chunk, fold=True):
                    sets += _unique_sets(h, counts, k)
            ids = group["id"].to_numpy()
            a, b = links(ids, group["block"].to_numpy(), sets, group["i"][0] != group["j"][0])
            final = group["blocks"][0].as_py() == 1
            if final:
                a, b = _labels(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b)), pa.array(np.full(len(a), final))], names=["a", "b", "final"])

    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, trees: int = 8, branch: int = 2, leaf: int = 4096, depth: int = 8, block: int = 2560) -> DataFrame:
    """Classes of near-duplicate documents.

    docs: doc_id, text.  Returns one row per input row: doc_id, n_shingles, component_id (the
    smallest doc_id reachable over links) and kept (doc_id = component_id).  A null doc_id takes
    no part: its component_id is null and kept is true.

    trees, branch, leaf, depth: see the module; the defaults find a pair at exactly the
    threshold with a probability above 0.9999 at every depth (README has the figures).  block: members that meet in one exact check.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = common.cut(base.mapInArrow(_describe(k), "doc_id long, n_shingles long, digest binary, sig binary"))
    real = described.where("n_shingles > 0 and doc_id is not null")
    sets = common.cut(real.groupBy("digest").agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("n"), F.first("sig").alias("sig")))
    members = sets.select("id", "n", "sig")
    clusters = common.cut(candidate_clusters(members, percent / 100, trees, branch, leaf, depth))

    # members of a cluster are dealt into blocks; a cluster of b blocks meets in b * (b + 1) / 2 groups
    size = clusters.join(members.select("id", "n"), "id").groupBy("label").agg(F.ceil(F.greatest(F.count("*") / F.lit(block), F.sum("n") / F.lit(BLOCK_SHINGLES))).cast("int").alias("blocks"))
    dealt = clusters.join(size, "label").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.select("label", "id", "blocks", "block", other.alias("o")).select("label", "id", "blocks", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    texts = base.where("doc_id is not null").join(dealt.select("id").distinct(), F.col("doc_id") == F.col("id"), "left_semi")
    links = common.cut(
        dealt.join(texts.withColumnRenamed("doc_id", "id"), "id")
        .select("label", "i", "j", "blocks", "block", "id", "text")
        .repartition(common.shuffle_partitions(spark), "label", "i", "j")
        .sortWithinPartitions("label", "i", "j", "id")
        .mapInArrow(_exact_links(k, percent), "a long, b long, final boolean")
    )
    found = links.where("final").select(F.col("a").alias("id"), F.col("b").alias("label"))
    open_ = links.where("not final").select("a", "b")
    if not open_.isEmpty():
        found = found.union(common.connected_components(open_))
    labelled = sets.select("digest", "id").join(found, "id", "left").select("digest", F.coalesce("label", "id").alias("label"))
    out = described.join(labelled, "digest", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Keeps one document of each class, the one with the smallest doc_id; all columns stay.

    Rows with the same doc_id count as one document and stay or go together.
    """
    (name,) = common.free(docs.columns, "gone")
    gone = near_duplicates(docs, **options).where("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone[name], "left_anti")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.job(spark)
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), k=4)
