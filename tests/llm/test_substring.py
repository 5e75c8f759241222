"""Substring dedup against brute force: chains, alignments, exact repeats, fuzzy recall, edge cases."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import common, substring_dedup

WORD = re.compile(common.WORD)
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EDGES = [None, "", "   \n", "one", "one two three", "same same same same same same same"]


def prose(rng, n, vocabulary=5000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def docs(spark, texts):
    return spark.createDataFrame([(i, t if t is None or isinstance(t, str) else " ".join(t), "en", "s", 0) for i, t in enumerate(texts)], DOCS)


def marked(rows, n):
    """Words of each document that some passage holds."""
    out = [set() for _ in range(n)]
    for r in rows:
        out[r["doc_id"]] |= set(range(r["start_word"], r["start_word"] + r["n_words"]))
    return out


def exact_repeats(texts, size=50):
    """Brute force: words of each document inside a run of ``size`` words that an earlier place has."""
    seen, out = set(), []
    for t in texts:
        words = t if isinstance(t, list) else WORD.findall((t or "").lower())
        own = set()
        for i in range(len(words) - size + 1):
            gram = tuple(words[i : i + size])
            if gram in seen:
                own |= set(range(i, i + size))
            seen.add(gram)
        out.append(own)
    return out


# ---------------------------------------------------------------- chains


def brute_chain(points, k, gap):
    """Best score over single runs by plain quadratic dynamic programming with the same rule of near cells."""
    runs = sorted((x, y, k) for x, y in points)
    score = []
    for x, y, m in runs:
        best = 0.0
        for (px, py, pm), s in zip(runs, score, strict=False):
            ex, ey = px + pm, py + pm
            if ex <= x and ey <= y and ex // gap >= x // gap - 1 and ey // gap >= y // gap - 1:
                best = max(best, s - substring_dedup.GAP_COST * (x - ex + y - ey))
        score.append(m + best)
    return max(score)


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=14, unique=True))
@settings(max_examples=200, deadline=None)
def test_fenwick_chains_score_as_the_quadratic_program(cells):
    points = [(29 * x + 7 * (y % 3), 31 * y + 5 * (x % 4)) for x, y in cells]  # no two on one diagonal close enough to be one run
    if len({x - y for x, y in points}) < len(points):
        return
    x, y = (np.array(v) for v in zip(*points, strict=True))
    got = substring_dedup.chain(x, y, 10)
    score = lambda path: sum(m for _, _, m in path) - substring_dedup.GAP_COST * sum(b[0] - a[0] - a[2] + b[1] - a[1] - a[2] for a, b in zip(path, path[1:], strict=False))
    assert max(score(c[4]) for c in got) == pytest.approx(brute_chain(points, 10, substring_dedup.MAX_GAP))
    assert sorted(r[:2] for c in got for r in c[4]) == sorted(points)


def test_a_distant_long_run_does_not_hide_a_near_one():
    first = np.arange(0, 400, 4)
    later = np.array([[490, 490], [502, 502], [515, 516], [527, 528], [540, 542]])  # an insertion after each
    x, y = np.concatenate([first, later[:, 0]]), np.concatenate([first, later[:, 1]])
    assert {c[:4] for c in substring_dedup.chain(x, y, 8)} == {(0, 404, 0, 404), (490, 548, 490, 550)}


# ---------------------------------------------------------------- alignment


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for w in a:
        before = row[:]
        for j, v in enumerate(b):
            row[j + 1] = before[j] + 1 if v == w else max(row[j], before[j + 1])
    return row[-1]


@given(st.lists(st.integers(0, 3), max_size=20), st.lists(st.integers(0, 3), max_size=20))
@settings(max_examples=200, deadline=None)
def test_common_words_are_a_longest_common_subsequence(a, b):
    pairs = substring_dedup.common_words(np.array(a, np.uint32), np.array(b, np.uint32))
    assert len(pairs) == brute_lcs(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))


def test_two_repeats_with_a_gap_between_are_two():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2**32, (2, 160), dtype=np.uint32)
    a[:60], a[100:] = b[:60], b[100:]
    got = substring_dedup.passages_of(a, b, [(0, 0, 60), (100, 100, 60)], 50, 0.8, 60)
    assert got == [(0, 60, 0, 60, 60, [(0, 60)]), (100, 160, 100, 160, 60, [(100, 60)])]


# ---------------------------------------------------------------- whole operator


def test_shared_passages_are_found_and_clean_texts_are_not(spark):
    rng = random.Random(5)
    passage = prose(rng, 70)
    fuzzy = passage[:20] + ["changed"] + passage[21:45] + ["in", "serted"] + passage[45:]
    texts = [prose(rng, 60) + p + prose(rng, 40) for p in (passage, passage, fuzzy)] + [prose(rng, 150) for _ in range(5)] + EDGES + [passage[:30]]
    table = docs(spark, texts)
    got = substring_dedup.repeated_passages(table).collect()
    assert {(r["doc_id"], r["source_id"]) for r in got} == {(1, 0), (2, 0)}
    for r in got:
        assert abs(r["start_word"] - 60) <= 2 and abs(r["n_words"] - 70) <= 4
        assert (r["identity"] == 1.0) == (r["doc_id"] == 1)
    cut = {r["doc_id"]: r for r in substring_dedup.remove_passages(table, substring_dedup.repeated_passages(table)).collect()}
    assert cut[0]["text"] == " ".join(texts[0]) and cut[3]["text"] == " ".join(texts[3])
    assert 95 <= len(WORD.findall(cut[1]["text"])) <= 103 and cut[1]["n_chars"] == len(cut[1]["text"])
    assert set(cut) == set(range(len(texts)))


@pytest.mark.parametrize("pieces", [[(0, 40), (20, 60), (40, 80)], [(0, 45), (35, 80)], [(0, 20), (20, 40), (40, 60), (60, 80)]])
def test_a_passage_whose_pieces_have_other_first_places_is_found_whole(spark, pieces):
    rng = random.Random(11)
    passage = prose(rng, 80)
    texts = [prose(rng, 60) + passage[a:b] + prose(rng, 60) for a, b in pieces]
    n = len(texts)
    texts += [prose(rng, 30) + passage + prose(rng, 30) for _ in range(3)]
    got = marked(substring_dedup.repeated_passages(docs(spark, texts)).collect(), len(texts))
    assert not any(got[: n + 1])  # no earlier document has the passage
    for own in got[n + 1 :]:
        assert set(range(30, 110)) <= own and len(own) <= 84


def test_every_exact_repeat_is_found(spark):
    rng = random.Random(23)
    pool = [prose(rng, rng.randrange(12, 70)) for _ in range(12)]
    texts = []
    for _ in range(60):  # documents are put together from shared pieces, so first places are scattered
        t = prose(rng, rng.randrange(0, 25))
        for _ in range(rng.randrange(1, 6)):
            t = t + rng.choice(pool) + prose(rng, rng.choice([0, 0, 0, 15]))
        texts.append(t)
    got = marked(substring_dedup.repeated_passages(docs(spark, texts)).collect(), len(texts))
    asked = exact_repeats(texts)
    missed = sum(len(a - g) for a, g in zip(asked, got, strict=True))
    assert sum(map(len, asked)) > 2000
    assert missed <= 0.01 * sum(map(len, asked))  # words at the ends of a stretch that another repeat holds


@pytest.mark.parametrize(("identity", "least"), [(0.9, 0.98), (0.85, 0.95), (0.82, 0.9)])
def test_fuzzy_recall(spark, identity, least):
    rng = random.Random(31)
    texts, n = [], 60
    sources = [prose(rng, 80) for _ in range(n)]
    for s in sources:
        texts.append(prose(rng, 30) + s + prose(rng, 30))
    for s in sources:
        copy = list(s)
        for _ in range(round((1 - identity) * len(s))):  # substitutions, insertions and deletions
            i = rng.randrange(len(copy))
            kind = rng.randrange(3)
            copy[i : i + (kind != 1)] = [f"new{rng.randrange(999)}"] if kind < 2 else []
        texts.append(prose(rng, 30) + copy + prose(rng, 30))
    got = substring_dedup.repeated_passages(docs(spark, texts)).collect()
    assert all(r["doc_id"] - r["source_id"] == n for r in got)
    assert len({r["doc_id"] for r in got}) >= least * n


def test_repeats_inside_a_document_and_hot_passages(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_SAMPLE", 1)
    rng = random.Random(2)
    line = prose(rng, 17)
    passage = prose(rng, 60)
    texts = [line * 20, prose(rng, 30) + line * 20] + [prose(rng, 20) + passage + prose(rng, 20) for _ in range(60)] + [prose(rng, 10) + passage + prose(rng, 5) + passage]
    table = docs(spark, texts)
    got = marked(substring_dedup.repeated_passages(table).collect(), len(texts))
    assert got[0] == set(range(17, 340)) and set(range(30, 370)) <= got[1]
    assert not got[2] and all(set(range(20, 80)) <= g and len(g) < 66 for g in got[3:62])
    assert set(range(10, 70)) | set(range(75, 135)) <= got[62]
    monkeypatch.setattr(substring_dedup, "HOT_COUNT", 10**9)  # no seed is frequent: the same rows
    assert marked(substring_dedup.repeated_passages(table).collect(), len(texts)) == got


def test_edges(spark):
    rng = random.Random(8)
    a, b = " ".join(prose(rng, 90)), " ".join(prose(rng, 90))
    long = " ".join(prose(rng, 60_000, 10**6))
    rows = [(1, a, "x"), (1, a, "x"), (1, b, "y"), (2, b, "z"), (None, a, "n"), (3, None, "n"), (4, "", "n"), (5, long, "l"), (6, " ".join(long.split()[:15000]), "l")]
    table = spark.createDataFrame([(i, t, v, v, v, v) for i, t, v in rows], "doc_id long, text string, doc string, part string, spans string, cut string")
    passages = substring_dedup.repeated_passages(table)
    got = passages.collect()
    assert {(r["doc_id"], r["source_id"]) for r in got} == {(2, 1), (6, 5)}  # a row repeated whole is one text, another text of its id is another
    left = substring_dedup.remove_passages(table, passages)
    assert left.columns == table.columns
    kept = sorted((r["doc_id"] or 0, r["doc"], len(r["text"] or "")) for r in left.collect())
    assert kept == sorted([(1, "x", len(a)), (1, "x", len(a)), (1, "y", len(b)), (0, "n", len(a)), (3, "n", 0), (4, "n", 0), (5, "l", len(long))])
    assert substring_dedup.repeated_passages(table.limit(0)).count() == 0
    assert substring_dedup.remove_passages(table, passages.limit(0)).count() == len(rows)
