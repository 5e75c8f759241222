"""Batches, packs, masks and reports against plain loops, with nulls, empties and ties."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import tokens
from tessera.operators import batching, evaluation, packing, retrieval, samplers
from tessera.plans import allocation


def positioned(spark, n):
    rows = spark.createDataFrame([(i * 3,) for i in range(n)], "doc_id long")
    return batching.dense_positions(rows, "doc_id")


@pytest.mark.parametrize("n", [0, 5, 12, 29])
@pytest.mark.parametrize("pad_to", [None, 24])
def test_sequential_batches(spark, n, pad_to):
    got = samplers.sequential_batches(positioned(spark, n), 2, 3, drop_last=False, pad_to=pad_to).select("step", "rank", "position").collect()
    order = list(range(n)) + [-k - 1 for k in range(-n % 24 if pad_to else 0)]
    want = [(i // 6, i % 6 // 2, p) for i, p in enumerate(order)]
    assert sorted(map(tuple, got)) == sorted(want)
    kept = samplers.sequential_batches(positioned(spark, n), 2, 3).count()
    assert kept == n // 6 * 6


def test_random_batches_resume(spark):
    whole = samplers.random_batches(positioned(spark, 53), 2, 3, "s").select("rank", "step", "position").collect()
    assert len({r["position"] for r in whole}) == len(whole) == 48
    assert all(r["position"] // 16 == r["rank"] for r in whole)
    later = samplers.random_batches(positioned(spark, 53), 2, 3, "s", consumed=12).select("rank", "step", "position").collect()
    assert sorted(map(tuple, later)) == sorted((r["rank"], r["step"] - 2, r["position"]) for r in whole if r["step"] >= 2)
    assert samplers.random_batches(positioned(spark, 4), 2, 3, "s").count() == 0


def test_document_index_keeps_the_last_epoch_apart(spark):
    docs = spark.createDataFrame([(i,) for i in range(40)], "doc_id long")
    rows = samplers.document_index(docs, "doc_id", 3, "s", True).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(120))
    assert {r["epoch"] for r in rows[80:]} == {2} and {r["doc_id"] for r in rows[80:]} == set(range(40))
    assert {r["epoch"] for r in samplers.document_index(docs, "doc_id", 3, "s", False).where("position >= 80").collect()} == {0, 1, 2}


def test_hash_order_numbers_ties(spark):
    rows = spark.createDataFrame([("a", 0.5, i) for i in range(5)] + [("b", 0.9, 1), ("b", 0.1, 2)], "g string, u double, k int")
    got = {(r["g"], r["k"]): r["place"] for r in samplers.hash_order(rows, ["g"], "u", ["k"], bins=4).collect()}
    assert got == {("a", 0): 0, ("a", 1): 1, ("a", 2): 2, ("a", 3): 3, ("a", 4): 4, ("b", 2): 0, ("b", 1): 1}


def test_split_packs(spark):
    lens = [5, 0, 17, 1, 8, 30]
    rows = spark.createDataFrame([("g", i, n) for i, n in enumerate(lens)] + [("h", 0, None)], "g string, i int, n long")
    got = sorted((r["i"], r["pack"], r["piece_from"], r["piece_len"]) for r in packing.split_packs(rows, ["g"], ["i"], "n", 8).collect())
    tokens_ = [(i, j) for i, n in enumerate(lens) for j in range(n)]
    want = {}
    for at, (i, j) in enumerate(tokens_):
        first, n = want.get((i, at // 8), (j, 0))
        want[i, at // 8] = (first, n + 1)
    assert got == sorted((*k, *v) for k, v in want.items())


def test_masks(spark):
    lens = [3, 0, 2, 4]
    row = spark.createDataFrame([(lens, [1, 1, 1, 2, 2, 3, 3, 3, 3, 0]), ([], [])], "lens array<int>, ids array<int>")
    row = row.select(tokens.causal_starts("lens").alias("starts"), tokens.block_causal_mask("ids").alias("mask"), tokens.additive_mask(tokens.block_causal_mask("ids")).alias("add"), tokens.lengths_fill("lens", 9).alias("fill"))
    got, empty = row.collect()
    ids = [1, 1, 1, 2, 2, 3, 3, 3, 3, 0]
    want = [[j <= i and ids[i] == ids[j] != 0 for j in range(10)] for i in range(10)]
    assert got["mask"] == want and got["starts"] == [r.index(True) for r in want[:9]]
    assert got["add"] == [[0.0 if x else float("-inf") for x in r] for r in want]
    assert got["fill"] and not empty["fill"] and empty["mask"] == [] and empty["starts"] == []


def test_spans_and_prefixes(spark):
    rnd = random.Random(3)
    pairs = [([rnd.randint(1, 2) for _ in range(rnd.randint(0, 6))], [rnd.randint(1, 2) for _ in range(rnd.randint(0, 6))]) for _ in range(200)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, f array<int>, m array<int>")
    got = rows.select("i", tokens.reasoning_span("f", "m").alias("s"), tokens.consistent_prefix("m", "f", 2).alias("p"), tokens.equal_lengths("f", "m").alias("e")).collect()
    for r in got:
        f, m = pairs[r["i"]]
        most = min(len(f), len(m))
        head = next((k for k in range(most) if f[k] != m[k]), most)
        tail = next((k for k in range(most - head) if f[-1 - k] != m[-1 - k]), most - head)
        assert (r["s"] and tuple(r["s"])) == ((head, len(f) - tail) if len(f) - tail > head else None)
        close = len(m) > 1 and m[-1] == 2 and f[: len(m) - 1] == m[:-1]
        assert r["p"] == (len(m) <= len(f) and (f[: len(m)] == m or close))
        assert r["e"] == (len(f) == len(m))


def test_reports(spark):
    rows = spark.createDataFrame([(1, {"9": 1.0, "exact_match": 0.0}), (2, {"x": 1.0, "4096": 1.0}), (3, {}), (4, {"prompt_level_strict_acc": 1.0, "exact_match": 0.0})], "i int, s map<string,double>")
    assert [r[0] for r in rows.orderBy("i").select(evaluation.pass_flag("s")).collect()] == [False, True, False, True]
    flags = rows.orderBy("i").select(evaluation.failure_modes({"a": F.col("i") > 1, "b": F.col("i") > 3})).collect()
    assert [r[0] for r in flags] == [[], ["a"], ["a"], ["a", "b"]]
    out = evaluation.strategy_comparison(rows, {"x": F.col("i") > 2, "y": F.col("i") < 3}).collect()
    assert [tuple(r) for r in out] == [("x", 2, 2, True), ("y", 2, 2, True)]
    sweep = evaluation.sweep_report(rows.withColumn("g", F.lit("g")).withColumn("v", F.col("i") * 1.0), ["g"], F.col("i") == 4, "i", ["v"]).first()
    assert (sweep["runs"], sweep["runs_ok"], sweep["completed"]) == (4, 3, 6) and abs(sweep["v"] - 14 / 6) < 1e-9


def test_pairs_and_same_documents(spark):
    rows = spark.createDataFrame([(7, ["p", "n"]), (8, [])], "q int, docs array<string>")
    got = retrieval.cross_encoder_rows(rows, "q", "docs").orderBy("place").collect()
    assert [(r["q"], r["place"], r["n_passages"], r["text"]) for r in got] == [(7, 0, 2, "question:7 \n \n passage:p"), (7, 1, 2, "question:7 \n \n passage:n")]
    passages = [(0, 0, "a"), (0, 1, "b"), (0, 2, "a"), (0, 3, None), (0, 4, None), (1, 0, "a")]
    p = spark.createDataFrame(passages, "batch int, column int, doc string")
    own = spark.createDataFrame([(0, 10, 0), (0, 11, 2), (0, 12, 3), (1, 13, 0)], "batch int, query int, column int")
    assert sorted(map(tuple, retrieval.same_document_negatives(own, p).collect())) == [(0, 10, 2), (0, 11, 0)]


def test_counts_go_to_the_largest_fraction_then_the_last_key(spark):
    cells = spark.createDataFrame([("g", k, 1.0) for k in "abc"] + [("h", "a", 0.5)], "g string, k string, w double")
    got = {(r["g"], r["k"]): r["records"] for r in allocation.allocate_counts_frame(cells, ["g"], "k", "w", F.lit(11)).collect()}
    assert got == {("g", "a"): 3, ("g", "b"): 4, ("g", "c"): 4, ("h", "a"): 11}
    shares = [r[0] for r in cells.select(allocation.normalised("w", "g")).collect()]
    assert abs(sum(shares) - 2) < 1e-9
