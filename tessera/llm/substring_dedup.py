"""Substring dedup: collinear chaining of shared k-mer seeds.

1. Seeds: of every window of WINDOW consecutive word k-mers the one with the least hash is a seed, so
   two texts that share WINDOW + K - 1 words in a row share a seed.
2. Join: a seed that occurs more than once is matched to its first occurrence (least doc_id, then
   place), never to all others, so a passage in n documents makes n - 1 matches.  Seeds are dealt
   and sorted once; those that a sample of the documents shows to be frequent are dealt by document too.
3. Chains: the matches between a document and an anchor document become maximal diagonal runs;
   runs are chained in the order of both texts with a gap cost.  The best predecessor comes from Fenwick
   trees over cells of MAX_GAP words in both texts, so it is always a near one.
4. Alignment: the words around each chain (min_words and a window on either side) are cut out of both
   texts and matched: runs along the diagonal, gaps and ends by a longest common subsequence.  The
   maximal-scoring stretches of the alignment that have at least ``min_words`` words, enough of
   them equal, are repeats.
5. The rest: seeds of one passage may have their first occurrences in different documents, none of
   which holds the passage.  Of stretches that are seeded all over, the runs of ``min_words`` words that lie in no
   one repeat go through 2 to 4 again as keys.  So a passage of ``min_words``
   words that an earlier text has word for word is always found, but for less than a window of words at its ends
   if another repeat holds the rest.

The anchor keeps its passage; rows name the later copy.  Passages of one document may overlap if they
have different sources.  Repeats inside one document count too.  Nulls and texts under
identity * min_words words have no passages; rows without doc_id are ignored.  Rows with one doc_id and
different texts are texts of their own, told apart by ``part`` (a hash of the text); rows repeated
whole count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

K = 6
WINDOW = 6
MIN_WORDS = 50
MAX_GAP = 40
#: Share of a gap's words (in both texts) that a chain's score loses.
GAP_COST = 0.25
#: An unequal word of an alignment costs so many equal ones.
PENALTY = 3
#: Chains of one pair of documents closer than so many words are aligned together.
NEAR = 64
#: One in so many documents is looked at to find frequent seeds; frequent: so often in the sample; at most so many.
HOT_SAMPLE, HOT_COUNT, HOT_SEEDS = 64, 24, 2_000
#: Runs of words asked for, up to this many, are broadcast to the texts that may hold them (8 bytes each).
BROADCAST_GRAMS = 2_000_000

PLACE = "doc_id long, part int, pos int"
MATCH = "doc_id long, part int, anchor long, anchor_part int, pos int, anchor_pos int"
CHAIN = "doc_id long, part int, anchor long, anchor_part int, x0 int, x1 int, y0 int, y1 int, chains array<int>"
SLICE = "doc_id long, part int, anchor long, anchor_part int, x0 int, y0 int, side int, begin int, words binary, chains array<int>"
PASSAGE = "doc_id long, part int, start_word int, n_words int, source_id long, source_part int, source_start_word int, source_n_words int, equal_words int, identity double, exact int"
PAIR = ["doc_id", "part", "anchor", "anchor_part"]


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def minimisers(s: np.ndarray, n: np.ndarray, window: int) -> np.ndarray:
    """Places of the least of every ``window`` consecutive hashes; n: how many hashes each text has (its windows stay inside)."""
    if not len(s):
        return np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    owner = np.repeat(np.arange(len(n)), n)
    size = np.minimum(window, n)
    best, at, reach = s.copy(), np.arange(len(s)), 1
    while reach < window:  # sliding minimum by doubling; the last of equals wins
        step = min(reach, window - reach)
        other = np.minimum(np.arange(len(s)) + step, len(s) - 1)
        take = (np.arange(len(s)) + step < len(s)) & (owner[other] == owner) & (best[other] <= best)
        best = np.where(take, best[other], best)
        at = np.where(take, at[other], at)
        reach += step
    valid = np.arange(len(s)) - starts[owner] + size[owner] <= n[owner]
    return np.unique(at[valid])


def _seeds(k: int, window: int, least: int):
    """(doc_id, part, text) -> (seed, doc_id, part, pos) of texts of at least ``least`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = _columns(batch, ["doc_id", "part"])
            for first, h, counts in common.words_by_text(batch.column("text"), fold=True):
                s, n = common.shingles(h, counts, k)
                picked = minimisers(s, n, window)
                owner = np.repeat(np.arange(len(n)), n)[picked]
                enough = counts[owner] >= max(k, least)
                picked, owner = picked[enough], owner[enough]
                pos = picked - np.concatenate([[0], np.cumsum(n)])[owner]
                yield pa.RecordBatch.from_arrays([pa.array(s[picked].view(np.int64)), pa.array(ids[first + owner]), pa.array(parts[first + owner]), pa.array(pos.astype(np.int32))], names=["seed", "doc_id", "part", "pos"])

    return run


def _first_places(hot: list[tuple[int, int, int, int]]):
    """(seed, salt, doc_id, part, pos), sorted -> MATCH.

    The first place of a seed in a document meets the seed's first place of all, a later one the place before it in the
    document (a text that repeats itself so has one diagonal, not one for each repeat).  The first place of all
    of a seed with such later ones is matched with itself, which marks it as shared.  hot: first places of the
    frequent seeds (seed, doc_id, part, pos), whose rows lie in several groups.
    """
    hot_seed, *hot_place = (np.array(v, t) for v, t in zip(zip(*sorted(hot), strict=True) if hot else [[]] * 4, (np.int64, np.int64, np.int32, np.int32), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # seed and salt, the first place and the last one
        for batch in batches:
            if not batch.num_rows:
                continue
            seed, salt, *place = _columns(batch, ["seed", "salt", "doc_id", "part", "pos"])
            new = np.concatenate([[held is None or held[0] != (seed[0], salt[0])], (seed[1:] != seed[:-1]) | (salt[1:] != salt[:-1])])
            first = np.maximum.accumulate(np.where(new, np.arange(len(seed)), -1))
            anchor = [np.where(first >= 0, p[first], p.dtype.type(0 if held is None else held[1][i])) for i, p in enumerate(place)]
            salted = np.flatnonzero(salt)
            if len(salted):
                at = np.searchsorted(hot_seed, seed[salted])
                for own, given in zip(anchor, hot_place, strict=True):
                    own[salted] = given[at]
            before = [np.concatenate([[p.dtype.type(0 if held is None else held[2][i])], p[:-1]]) for i, p in enumerate(place)]
            held = ((seed[-1], salt[-1]), [a[-1] for a in anchor], [p[-1] for p in place])
            again = ~new & (place[0] == before[0]) & (place[1] == before[1])
            meets = [np.where(again, b, a) for a, b in zip(anchor, before, strict=True)]
            later = np.flatnonzero((place[0] != meets[0]) | (place[1] != meets[1]) | (place[2] != meets[2]))
            marked = np.flatnonzero(again)
            if len(marked):
                marked = marked[np.concatenate([[True], seed[marked][1:] != seed[marked][:-1]])]
            if len(later):
                d, p, x, a, q, y = (np.concatenate([v[later], a[marked]]) for v, a in zip((*place, *meets), (*anchor, *anchor), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (d, p, a, q, x, y)], names=[*PAIR, "pos", "anchor_pos"])

    return run


def first_matches(seeds: DataFrame) -> DataFrame:
    """(seed, doc_id, part, pos), stored -> MATCH, as ``_first_places`` has it.

    Seeds are dealt and sorted by seed once.  Those that a sample shows to be frequent (HOT_SEEDS at most) are dealt by
    document too; their first places are found by an aggregation before.  Which seeds these are never changes what comes out.
    """
    spark = seeds.sparkSession
    parts = common.shuffle_partitions(spark)
    sample = seeds.where(F.pmod(F.xxhash64("doc_id"), F.lit(HOT_SAMPLE)) == 0)
    names = [r["seed"] for r in sample.groupBy("seed").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_COUNT).orderBy(F.desc("n"), "seed").limit(HOT_SEEDS).collect()]
    salt, hot = F.lit(0), []
    if names:
        frequent = F.col("seed").isin(names)
        first = seeds.groupBy(F.when(frequent, F.col("seed")).alias("seed")).agg(F.min(F.struct("doc_id", "part", "pos")).alias("at")).collect()  # HOT_SEEDS + 1 rows at most
        hot = [(r["seed"], *r["at"]) for r in first if r["seed"] is not None]
        salt = F.when(frequent, F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int") + 1).otherwise(0)
    rows = seeds.select("seed", salt.alias("salt"), "doc_id", "part", "pos")
    dealt = rows.repartition(parts, "seed", "salt").sortWithinPartitions("seed", "salt", "doc_id", "part", "pos")
    return dealt.mapInArrow(_first_places(hot), MATCH)


class _Fenwick:
    """Greatest (value, index) over prefixes of MAX_GAP slots."""

    __slots__ = ("best",)

    def __init__(self, size: int):
        self.best: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)

    def add(self, slot: int, value: tuple[float, int]) -> None:
        slot += 1
        while slot < len(self.best):
            if self.best[slot] < value:
                self.best[slot] = value
            slot += slot & -slot

    def upto(self, slot: int) -> tuple[float, int]:
        """Best of slots 0..slot."""
        slot += 1
        out = (-1e18, -1)
        while slot > 0:
            out = max(out, self.best[slot])
            slot -= slot & -slot
        return out


def chain(x: np.ndarray, y: np.ndarray, k: int, window: int = WINDOW, max_gap: int = MAX_GAP) -> list[tuple[int, int, int, int, list[tuple[int, int, int]]]]:
    """Chains of matches (x[i], y[i]) of k words: (x from, x to, y from, y to, runs (x, y, words)).

    Score of a chain: its words less GAP_COST for each word between two runs (in both texts).  A run may follow
    one that ends before it in both texts, in the same cell of max_gap words or the one before: a predecessor
    max_gap words away is always considered, one 2 * max_gap away never.
    """
    if len(x) == 1:
        a, b = int(x[0]), int(y[0])
        return [(a, a + k, b, b + k, [(a, b, k)])]
    order = np.lexsort((x, x - y))
    x, y = x[order].astype(np.int64), y[order].astype(np.int64)
    # maximal runs on a diagonal: the next match starts before the run's end plus a window
    new = np.concatenate([[True], (np.diff(x - y) != 0) | (np.diff(x) > k + window)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(x) - 1]])
    rx, ry, rl = x[first], y[first], x[last] - x[first] + k
    by = np.lexsort((ry, rx))
    rx, ry, rl = rx[by].tolist(), ry[by].tolist(), rl[by].tolist()
    n = len(rx)
    score, prev = [float(v) for v in rl], [-1] * n
    if n > 1:
        cells: dict[tuple[int, int], _Fenwick] = {}
        waiting = sorted(range(n), key=lambda i: (rx[i] + rl[i], i))
        w = 0
        for i in range(n):  # by start in x
            while w < n and rx[waiting[w]] + rl[waiting[w]] <= rx[i]:
                j = waiting[w]
                ex, ey = rx[j] + rl[j], ry[j] + rl[j]
                cell = cells.setdefault((ex // max_gap, ey // max_gap), _Fenwick(max_gap))
                cell.add(ey % max_gap, (score[j] + GAP_COST * (ex + ey), j))
                w += 1
            cx, cy = rx[i] // max_gap, ry[i] // max_gap
            best = (-1e18, -1)
            for ox in (cx, cx - 1):
                if (ox, cy) in cells:
                    best = max(best, cells[ox, cy].upto(ry[i] % max_gap))
                if (ox, cy - 1) in cells:
                    best = max(best, cells[ox, cy - 1].upto(max_gap - 1))
            joined = best[0] - GAP_COST * (rx[i] + ry[i])
            if best[1] >= 0 and joined > 0:
                score[i], prev[i] = rl[i] + joined, best[1]
    out, used = [], [False] * n
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append((rx[i], ry[i], rl[i]))
            i = prev[i]
        if path:
            path.reverse()
            out.append((path[0][0], path[-1][0] + path[-1][2], path[0][1], path[-1][1] + path[-1][2], path))
    return out


def _groups(batches: Iterator[pa.RecordBatch], key: list[str], rest: list[str]):
    """Sorted rows -> (key, arrays of the other columns) of each run of equal keys."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = _columns(batch, [*key, *rest])
        if held is not None:
            own = [np.concatenate(v) for v in zip(held, own, strict=True)]
        new = np.zeros(len(own[0]), bool)
        for c in own[: len(key)]:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield tuple(c[a] for c in own[: len(key)]), [c[a:b] for c in own[len(key) :]]
        held = [c[cuts[-1] :] for c in own]
    if held is not None:
        yield tuple(c[0] for c in held[: len(key)]), held[len(key) :]


def _record(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as an Arrow batch of a schema like ``a long, b int, c binary, d array<int>``."""
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[t]) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def _chains(k: int, window: int):
    """MATCH, sorted -> CHAIN: neighbouring chains of a pair in one row, each as (number of runs, then x, y, words of each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for key, (x, y) in _groups(batches, PAIR, ["pos", "anchor_pos"]):
            if key[:2] == key[2:]:  # places matched with themselves are marks, not repeats
                marks, x, y = x[x == y], x[x != y], y[x != y]
                for a in np.unique(marks).tolist():
                    out.append((*key, a, a + k, a, a + k, [1, a, a, k]))
                if not len(x):
                    continue
            near: list = []
            for c in [*sorted(chain(x, y, k, window)), None]:
                if near and (c is None or c[0] > near[1] + NEAR or c[2] > near[3] + NEAR or c[3] < near[2] - NEAR):
                    out.append((*key, *near))
                    near = []
                if c is not None:
                    flat = [len(c[4]), *(w for r in c[4] for w in r)]
                    near = [min(near[0], c[0]), max(near[1], c[1]), min(near[2], c[2]), max(near[3], c[3]), near[4] + flat] if near else [*c[:4], flat]
            if len(out) >= 5000:
                yield _record(out, CHAIN)
                out = []
        if out:
            yield _record(out, CHAIN)

    return run


def _read_chains(flat) -> list[list[tuple[int, int, int]]]:
    out, i = [], 0
    while i < len(flat):
        out.append([(flat[j], flat[j + 1], flat[j + 2]) for j in range(i + 1, i + 1 + 3 * flat[i], 3)])
        i += 1 + 3 * flat[i]
    return out


def _cut_words(margin: int):
    """(text, spans) -> SLICE: the hashes of the words of each span and ``margin`` words around it, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: list[np.ndarray] = []
            for _, h, counts in common.words_by_text(batch.column("text"), fold=True):
                words += np.split((h >> np.uint64(32)).astype(np.uint32), np.cumsum(counts)[:-1])
            spans = batch.column("spans")
            out, size = [], 0
            for own, s in zip(words, spans, strict=True):
                for v in s.as_py():
                    lo = max(0, v["lo"] - margin)
                    cut = own[lo : v["hi"] + margin].tobytes()
                    out.append((v["doc_id"], v["part"], v["anchor"], v["anchor_part"], v["x0"], v["y0"], v["side"], lo, cut, v["chains"]))
                    size += len(cut) + 100
                    if size > 4 << 20:
                        yield _record(out, SLICE)
                        out, size = [], 0
            if out:
                yield _record(out, SLICE)

    return run


def common_words(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Matched places of a longest common subsequence, by bit-parallel rows."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(np.argmin(same))
    out = [(i, i) for i in range(head)]
    a, b = a[head:].tolist(), b[head:].tolist()
    if not a or not b:
        return out
    where: dict[int, int] = {}
    for j, w in enumerate(b):
        where[w] = where.get(w, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v, rows = full, []
    for w in a:
        u = v & where.get(w, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    tail = []
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                tail.append((head + i, head + j))
    return out + tail[::-1]


def aligned(a: np.ndarray, b: np.ndarray, runs: list[tuple[int, int, int]], margin: int) -> list[tuple[int, int]]:
    """Matched places of two word slices along a chain, with what ``margin`` words before and after it have in common."""
    x, y, _ = runs[0]
    na, nb = min(x, margin), min(y, margin)
    back = common_words(a[x - na : x][::-1], b[y - nb : y][::-1])
    out = [(x - 1 - i, y - 1 - j) for i, j in reversed(back)]
    px, py = x, y
    for x, y, m in runs:
        if x > px and y > py:
            out += [(px + i, py + j) for i, j in common_words(a[px:x], b[py:y])]
        out += [(x + i, y + i) for i in np.flatnonzero(a[x : x + m] == b[y : y + m]).tolist()]
        px, py = x + m, y + m
    return out + [(px + i, py + j) for i, j in common_words(a[px : px + margin], b[py : py + margin])]


def stretches(pairs: list[tuple[int, int]], penalty: int) -> list[tuple[int, int]]:
    """All maximal-scoring stretches (first, last) of an alignment's matched places: 1 a match, -penalty an unmatched word."""
    stack: list[tuple[int, int, int, int]] = []  # first, last, score before, score after
    total = 0
    at = 0
    n = len(pairs)
    while at < n:
        end = at
        while end + 1 < n and pairs[end + 1][0] - pairs[end][0] == 1 and pairs[end + 1][1] - pairs[end][1] == 1:
            end += 1
        if at:
            total -= penalty * max(pairs[at][0] - pairs[at - 1][0] - 1, pairs[at][1] - pairs[at - 1][1] - 1)
        first, before = at, total
        total += end - at + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j -= 1
            if j >= 0 and stack[j][3] < total:
                first, before = stack[j][0], stack[j][2]
                del stack[j:]
                continue
            stack.append((first, end, before, total))
            break
        at = end + 1
    return [(s[0], s[1]) for s in stack]


def passages_of(a: np.ndarray, b: np.ndarray, runs: list[tuple[int, int, int]], min_words: int, identity: float, margin: int) -> list[tuple]:
    """(x from, x to, y from, y to, equal words, [(x, words) of its stretches of min_words equal words]) of the repeats along a
    chain inside two word slices."""
    pairs = aligned(a, b, runs, margin)
    for penalty in (PENALTY, PENALTY + 1):  # where the first takes in too much, the second parts it
        out = []
        for s, e in stretches(pairs, penalty):
            x0, x1, y0, y1 = pairs[s][0], pairs[e][0] + 1, pairs[s][1], pairs[e][1] + 1
            if x1 - x0 >= min_words and e - s + 1 >= identity * max(x1 - x0, y1 - y0):
                own = np.array(pairs[s : e + 1])
                cuts = np.flatnonzero((np.diff(own, axis=0) != 1).any(axis=1)) + 1
                whole = [(int(own[i, 0]), int(j - i)) for i, j in zip([0, *cuts], [*cuts, len(own)], strict=True) if j - i >= min_words]
                out.append((x0, x1, y0, y1, e - s + 1, whole))
        if out:
            return out
    return []


def _align(min_words: int, identity: float, margin: int):
    """SLICE, sorted by pair, x0, y0, side -> PASSAGE; a chain inside a stretch found already is part of it."""

    def one(doc, part, anchor, anchor_part, a_at, a, chains, b_at, b) -> Iterator[tuple]:
        a, b = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
        found: list[tuple[int, int, int, int]] = []
        every = _read_chains(chains)
        for runs in sorted(every, key=lambda r: -sum(m for _, _, m in r)):
            runs = [(x - a_at, y - b_at, m) for x, y, m in runs]
            x, y, m = runs[0]
            if any(x0 <= x and runs[-1][0] + runs[-1][2] <= x1 and abs((x - x0) - (y - y0)) <= max(0, (x1 - x0) - (y1 - y0), (y1 - y0) - (x1 - x0)) for x0, x1, y0, y1 in found):
                continue
            # a repeat needs identity * min_words equal words; no alignment has more than words that both sides hold
            lo, hi = max(0, x - margin), runs[-1][0] + runs[-1][2] + margin
            if hi - lo < 400:
                other = set(b[max(0, y - margin) : runs[-1][1] + runs[-1][2] + margin].tolist())
                if sum(map(other.__contains__, a[lo:hi].tolist())) < identity * min_words:
                    continue
            for x0, x1, y0, y1, equal, whole in passages_of(a, b, runs, min_words, identity, margin):
                if (x0, x1, y0, y1) in found:
                    continue
                found.append((x0, x1, y0, y1))
                if doc != anchor or part != anchor_part or y0 + b_at < x0 + a_at:
                    yield doc, part, x0 + a_at, x1 - x0, anchor, anchor_part, y0 + b_at, y1 - y0, equal, equal / max(x1 - x0, y1 - y0), 0
                    for x, m in whole:
                        yield doc, part, x + a_at, m, anchor, anchor_part, y0 + b_at, m, m, 1.0, 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[6] == 0:
                    held = row
                elif held is not None and held[:6] == row[:6]:
                    out += one(*row[:4], held[7], held[8], held[9], row[7], row[8])
                    held = None
            if out:
                yield _record(out, PASSAGE)

    return run


def _chained(matches: DataFrame, k: int, window: int) -> DataFrame:
    dealt = matches.repartition(common.shuffle_partitions(matches.sparkSession), *PAIR).sortWithinPartitions(*PAIR, "pos", "anchor_pos")
    return common.store(dealt.mapInArrow(_chains(k, window), CHAIN), "chains")


def _passages(chains: DataFrame, texts: DataFrame, min_words: int, identity: float, margin: int) -> DataFrame:
    """Aligns stored chains but marks.  A text comes once with all spans wanted of it; those of a much-copied text are
    dealt over as many rows as there are shuffle partitions, by the document that asks."""
    parts = common.shuffle_partitions(texts.sparkSession)
    chains = chains.where("doc_id <> anchor or part <> anchor_part or x0 <> y0")
    key = [F.col(c) for c in (*PAIR, "x0", "y0")]
    span = lambda side, lo, hi, runs: F.struct(*key, F.lit(side).alias("side"), F.col(lo).alias("lo"), F.col(hi).alias("hi"), runs.alias("chains"))
    wanted = chains.select(F.col("doc_id").alias("want"), F.col("part").alias("want_part"), F.lit(0).alias("salt"), span(0, "x0", "x1", F.col("chains")).alias("span")).unionByName(
        chains.select(F.col("anchor").alias("want"), F.col("anchor_part").alias("want_part"), F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("salt"), span(1, "y0", "y1", F.lit(None).cast("array<int>")).alias("span"))
    )
    spans = wanted.groupBy("want", "want_part", "salt").agg(F.collect_list("span").alias("spans"))
    spans = spans.hint("merge")  # one plan at every size
    asked = texts.join(spans, (texts["doc_id"] == spans["want"]) & (texts["part"] == spans["want_part"])).select("text", "spans")
    slices = asked.mapInArrow(_cut_words(margin), SLICE)
    order = [*PAIR, "x0", "y0"]
    dealt = slices.repartition(parts, *order).sortWithinPartitions(*order, "side")
    return dealt.mapInArrow(_align(min_words, identity, margin), PASSAGE)


#: What a span is: part of a chain, a mark, a passage found, a stretch of one that is equal word for word.
RUN, MARK, PASSED, EXACT = 0, 1, 2, 3


def _open_regions(min_words: int, window: int):
    """(doc_id, part, x0, x1, kind) sorted -> (doc_id, part, lo, hi, ask): words lo..hi whose runs of min_words words are open.

    Open are runs inside a stretch that is seeded all over, a window wider at both ends (a run of min_words words has its first
    seed among its first ``window`` words, its last seed ends among its last ones, and two seeds in a row start at most
    ``window`` words apart): with ask = 1 those of later places that no passage holds but for a window at its ends,
    with ask = 0 those (of marked first places too) that no stretch equal to an earlier place holds.
    """
    schema = "doc_id long, part int, lo int, hi int, ask int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for key, (x0, x1, kind) in _groups(batches, ["doc_id", "part"], ["x0", "x1", "kind"]):
            for ask, seeded, closing, slack in ((1, kind == RUN, kind == PASSED, window), (0, kind <= MARK, kind == EXACT, 0)):
                a, b = x0[seeded], x1[seeded]
                if not len(a):
                    continue
                reach = np.maximum.accumulate(b)
                first = np.flatnonzero(np.concatenate([[True], a[1:] > reach[:-1] + window]))
                for lo, hi in zip(first, [*first[1:], len(a)], strict=True):
                    start, end = max(0, int(a[lo]) - window), int(reach[hi - 1]) + window
                    if end - start < min_words:
                        continue
                    # first words of the runs in it, without those that a closing span holds
                    open_ = np.ones(end - start - min_words + 1, bool)
                    for x, y in zip(x0[closing].tolist(), x1[closing].tolist(), strict=True):
                        open_[max(0, x - slack - start) : max(0, y + slack - min_words + 1 - start)] = False
                    edge = np.diff(np.concatenate([[0], open_.astype(np.int8), [0]]))
                    out += [(*key, start + i, start + j - 1 + min_words, ask) for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]
            if len(out) >= 5000:
                yield _record(out, schema)
                out = []
        if out:
            yield _record(out, schema)

    return run


def _region_grams(size: int, wanted=None):
    """(doc_id, part, text, regions) -> (seed, doc_id, part, pos) for each run of ``size`` words inside a region; wanted:
    a broadcast sorted array, only of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if wanted is None else wanted.value
        for batch in batches:
            ids, parts = _columns(batch, ["doc_id", "part"])
            regions = batch.column("regions").to_pylist()
            for first, h, counts in common.words_by_text(batch.column("text"), fold=True):
                for i, words in enumerate(np.split(h, np.cumsum(counts)[:-1]), first):
                    for r in regions[i]:
                        own = words[r["lo"] : r["hi"]]
                        if len(own) < size:
                            continue
                        grams = common.shingles(own, np.array([len(own)]), size)[0].view(np.int64)
                        at = np.arange(len(grams))
                        if known is not None:
                            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams)
                        n = len(at)
                        if n:
                            yield pa.RecordBatch.from_arrays([pa.array(grams[at]), pa.array(np.full(n, ids[i])), pa.array(np.full(n, parts[i])), pa.array((at + r["lo"]).astype(np.int32))], names=["seed", "doc_id", "part", "pos"])

    return run


def _split_over_sources(chains: DataFrame, found: DataFrame, texts: DataFrame, min_words: int, window: int) -> DataFrame | None:
    """The grams that step 5 matches, stored: those of all open regions, or, if they are few, the ones that a region without
    a passage asks for; None without any such region."""
    spark = texts.sparkSession
    kind = F.when(F.col("exact") == 1, EXACT).otherwise(PASSED).alias("kind")
    spans = chains.mapInArrow(_run_spans, "doc_id long, part int, x0 int, x1 int, kind int").unionByName(found.select("doc_id", "part", F.col("start_word").alias("x0"), (F.col("start_word") + F.col("n_words")).alias("x1"), kind))
    regions = spans.repartition(common.shuffle_partitions(spark), "doc_id", "part").sortWithinPartitions("doc_id", "part", "x0", "x1")
    regions = common.store(regions.mapInArrow(_open_regions(min_words, window), "doc_id long, part int, lo int, hi int, ask int"), "regions")
    asks = regions.where("ask = 1")
    words = asks.agg(F.sum(F.col("hi") - F.col("lo") - min_words + 1)).first()[0]
    if words is None:
        return None

    def grams(regions: DataFrame, wanted=None) -> DataFrame:
        by_text = regions.groupBy("doc_id", "part").agg(F.collect_list(F.struct("lo", "hi")).alias("regions"))
        held = texts.join(by_text.hint("merge"), ["doc_id", "part"]).select("doc_id", "part", "text", "regions")
        return held.mapInArrow(_region_grams(min_words, wanted), f"seed long, {PLACE}")

    regions = regions.where("ask = 0")
    if words > BROADCAST_GRAMS:
        return common.store(grams(regions), "grams")
    asked = grams(asks).select("seed").distinct().toPandas()["seed"].to_numpy()  # BROADCAST_GRAMS at most
    return common.store(grams(regions, spark.sparkContext.broadcast(np.sort(asked))), "grams") if len(asked) else None


def _run_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """CHAIN -> (doc_id, part, x0, x1, kind) of every run."""
    for batch in batches:
        rows = [(d, p, x, x + m, MARK if (d, p) == (a, q) and x == y else RUN) for d, p, a, q, flat in zip(*(batch.column(c).to_pylist() for c in (*PAIR, "chains")), strict=True) for runs in _read_chains(flat) for x, y, m in runs]
        yield _record(rows, "doc_id long, part int, x0 int, x1 int, kind int")


def _outermost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """PASSAGE, sorted by document, start and falling length -> without passages inside another one of their document."""
    names = [f.split(" ")[0] for f in PASSAGE.split(", ")]
    for key, columns in _groups(batches, names[:2], names[2:]):
        end = columns[0] + columns[1]
        before = np.concatenate([[-1], np.maximum.accumulate(end)[:-1]])
        keep = end > before
        n = int(keep.sum())
        ids = [np.full(n, key[0], np.int64), np.full(n, key[1], np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*ids, *(c[keep] for c in columns))], names=names)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash(text).alias("part"), text.alias("text")).where("doc_id is not null and text is not null")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, identity: float = 0.8, k: int = K, window: int = WINDOW) -> DataFrame:
    """docs: doc_id, text -> a row for each passage of a document that an earlier place has already.

    start_word and n_words count the words of the whole text from 0; source_* name the earlier place; part and
    source_part tell texts with one doc_id apart.
    """
    texts = _texts(docs)
    margin = min_words + k + window
    seeds = common.store(texts.mapInArrow(_seeds(k, window, int(identity * min_words)), f"seed long, {PLACE}"), "seeds")
    chains = _chained(first_matches(seeds), k, window)
    found = common.store(_passages(chains, texts, min_words, identity, margin), "passages")
    grams = _split_over_sources(chains, found, texts, min_words, window)
    if grams is not None:
        found = found.union(_passages(_chained(first_matches(grams), min_words, 0), texts, min_words, identity, margin))
    order = ["start_word", F.desc("n_words"), "source_id", "source_part", "source_start_word"]
    dealt = found.where("exact = 0").repartition(common.shuffle_partitions(docs.sparkSession), "doc_id", "part").sortWithinPartitions("doc_id", "part", *order)
    return dealt.mapInArrow(_outermost, PASSAGE).drop("exact")


def remove_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """docs (with text; n_chars is made anew if present) without the words of the passages; first occurrences stay.

    A text of which nothing is left but white space goes.  Texts without passages stay as they are, rows without
    doc_id or text too.  Columns may have any names.
    """
    own, part, spans_name, cut_name = common.free(docs.columns, "doc", "part", "spans", "cut")
    spans = passages.groupBy(F.col("doc_id").alias(own), F.col("part").alias(part)).agg(F.flatten(F.collect_list(F.array("start_word", "n_words"))).alias(spans_name))
    spans = spans.hint("merge")
    joined = docs.join(spans, (docs["doc_id"].cast("long") == spans[own]) & (F.hash(docs["text"].cast("string")) == spans[part]), "left").drop(own, part)

    @F.pandas_udf("string")
    def without(texts, spans):
        import pandas as pd

        out = []
        for text, own in zip(texts, spans, strict=True):
            if own is None or text is None or not len(own):
                out.append(text)
                continue
            raw = np.frombuffer(text.encode("utf-8"), np.uint8)
            found = [x[1:3] for x in common.word_spans(raw, np.array([0, len(raw)]), fold=True)]
            start, end = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
            gone = np.zeros(len(start) + 1, np.int32)
            for s, n in zip(own[::2], own[1::2], strict=True):
                gone[s] += 1
                gone[min(s + n, len(start))] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            keep = np.ones(len(raw), bool)
            edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
            for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
                keep[start[a] : (start[b] if b < len(start) else end[b - 1])] = False
            out.append(raw[keep].tobytes().decode("utf-8"))
        return pd.Series(out, dtype=object)

    changed = F.col(spans_name).isNotNull()
    edited = joined.withColumn(cut_name, without(F.when(changed, F.col("text").cast("string")), spans_name)).withColumn("text", F.when(changed, F.col(cut_name)).otherwise(F.col("text")))
    edited = edited.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        edited = edited.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return edited.select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.job(spark)
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
