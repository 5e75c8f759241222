"""Operators, plans, sources and streams on small rows."""

import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import dedup, evaluation, packing
from tessera.plans import allocation
from tessera.sources import readers, sinks, token_files
from tessera.streaming import streams


def test_keep_first(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 4), (None, 5)], "k string, i long")
    assert sorted(r["i"] for r in dedup.keep_first(df, "k", ["i"]).collect()) == [1, 3, 4]


@pytest.mark.parametrize(("lengths", "size", "packs"), [([7, 6, 2, 5, 3], 12, 2), ([8, 8, 4, 4, 9, 3], 12, 3), ([11, 11], 12, 2), ([], 12, 0)])
def test_knapsack(lengths, size, packs):
    out = packing.knapsack_packs(lengths, size)
    assert len({p for p in out if p is not None}) == packs
    for p in set(out) - {None}:
        assert sum(n for n, q in zip(lengths, out, strict=True) if q == p) <= size


def test_knapsack_skips_oversized():
    assert packing.knapsack_packs([6, 4, 31], 12)[2] is None


@given(st.lists(st.integers(1, 50), max_size=60))
@settings(max_examples=50, deadline=None)
def test_packs_hold(lengths):
    for method in (packing.greedy_packs, packing.knapsack_packs):
        out = method(lengths, 40)
        assert [p is None for p in out] == [n > 40 for n in lengths]
        for p in set(out) - {None}:
            assert sum(n for n, q in zip(lengths, out, strict=True) if q == p) <= 40


def test_build_packs(spark):
    rows = spark.createDataFrame([("s", 1, [31, 32]), ("s", 2, [41, 42, 43, 44, 45]), ("s", 3, [51]), ("s", 4, list(range(60, 69)))], "shard string, id long, ids array<int>")
    packs = packing.pack_greedy(rows.withColumn("n", F.size("ids").cast("long")), "shard", ["id"], "n", 9)
    out = packing.build_packs(rows.join(packs.select("id", "pack"), "id"), "shard", "id", "ids", 9).orderBy("pack").collect()
    assert [r["seq_lens"] for r in out] == [[2, 5, 1], [9]]
    assert out[0]["seq_lens_padded"] == [2, 5, 2]
    assert out[0]["position_ids"] == [0, 1, 0, 1, 2, 3, 4, 0, 1]
    assert out[0]["labels"][-1] == -100


def test_blend_follows_weights():
    datasets, samples = packing.blend([0.5, 0.3, 0.2], 100)
    assert [datasets.count(d) for d in range(3)] == [50, 30, 20]
    assert samples[-1] == datasets[:-1].count(datasets[-1])
    assert sorted(packing.blend([0.5, 0.5], 10, [2, 3])[0]) == [0, 0, 1, 1, 1]


def test_waterfill_and_rounding():
    assert allocation.waterfill(10, {"a": 1, "b": 1}, {"a": 2, "b": 100}) == {"a": 2, "b": 8}
    assert allocation.waterfill(10, {"a": 1, "b": 1}, {"a": 2, "b": 3}) == {"a": 2, "b": 3}
    assert allocation.largest_remainder({"a": 1.5, "b": 1.5}) == {"a": 2, "b": 1}
    assert allocation.balanced_targets(10, {"a": 2, "b": 9, "c": 9}) == {"a": 2, "b": 4, "c": 4}
    assert allocation.blend_sizes(100, [1, 1], 0.1) == [55, 55] or allocation.blend_sizes(100, [1, 1], 0.1) == [56, 56]


@given(st.dictionaries(st.sampled_from("abcdef"), st.tuples(st.floats(0.1, 10), st.floats(0, 50)), min_size=1), st.floats(0, 100))
@settings(max_examples=100, deadline=None)
def test_waterfill_invariants(cells, total):
    got = allocation.waterfill(total, {k: w for k, (w, _) in cells.items()}, {k: c for k, (_, c) in cells.items()})
    assert all(got[k] <= cells[k][1] + 1e-6 for k in cells)
    assert sum(got.values()) == pytest.approx(min(total, sum(c for _, c in cells.values())), abs=1e-5)


def test_waterfill_frame_equals_the_loop(spark):
    caps, weights = {"a": 2.0, "b": 50.0, "c": 7.0}, {"a": 1.0, "b": 2.0, "c": 3.0}
    df = spark.createDataFrame([(k, weights[k], caps[k]) for k in caps], "k string, w double, c double")
    got = {r["k"]: r["share"] for r in allocation.waterfill_frame(df, [], "k", "w", "c", F.lit(30.0)).collect()}
    assert got == pytest.approx(allocation.waterfill(30, weights, caps))


def test_plans_meet_the_budget():
    cells = [{"task": t, "lang": lang, "records": 100, "text_tokens": 1000} for t in "xy" for lang in ("en", "fr")]
    plan = allocation.capped_example_plan(cells, 2000, 2, {"x": 50}, 4)
    assert sum(plan.values()) * 10 == pytest.approx(2000, rel=1e-6)
    assert plan["x", "en"] < plan["y", "en"]
    got = allocation.pool_allocation(100, {"p": 60, "q": 60}, {"z": 500}, {"p": 2, "q": 1, "z": 1}, {"p": "f", "q": "g", "z": "h"}, 0.5, 0.2)
    assert sum(got.values()) == pytest.approx(100) and got["z"] >= 20


def test_scores(spark):
    df = spark.createDataFrame([("The quick, quick fox", "quick fox"), ("", ""), ("a", "b c")], "p string, r string")
    assert [round(r["f"], 6) for r in df.select(evaluation.token_f1("p", "r").alias("f")).collect()] == [80.0, 100.0, 0.0]
    got = df.select(evaluation.best_f1("p", F.array(F.lit("fox"), F.lit("quick fox"))).alias("f"), evaluation.partial_ratio_udf("p", "r").alias("s")).first()
    assert got["f"] == 80.0 and got["s"] == 100.0
    assert evaluation.chrf([("abc def", "abc def")]) == pytest.approx(100)
    assert evaluation.chrf([("abc", "xyz")]) == 0


def test_index_files_round_trip(spark, tmp_path):
    rows = [np.arange(n) for n in (3, 0, 5)]
    (tmp_path / "x.bin").write_bytes(np.concatenate(rows).astype(np.uint16).tobytes())
    (tmp_path / "x.idx").write_bytes(token_files.encode_index([3, 0, 5], [0, 3], np.uint16))
    got = token_files.read_indexed(spark, f"{tmp_path}/x").orderBy("seq_id").collect()
    assert [r["tokens"] for r in got] == [x.tolist() for x in rows]
    with pytest.raises(ValueError, match="not an index"):
        token_files.decode_index(b"nonsense!!")


def test_shards_round_trip(spark, tmp_path):
    tokens = np.array([7, 1, 2, 3, 7, 4, 5, 6, 7, 8])
    (tmp_path / "a.bin").write_bytes(token_files.encode_shard(tokens, 100))
    assert token_files.decode_shard((tmp_path / "a.bin").read_bytes()).tolist() == tokens.tolist()
    got = token_files.read_shards(spark, f"{tmp_path}/*.bin", 3).orderBy("sample").collect()
    assert [r["input_ids"] for r in got] == [[7, 1, 2], [3, 7, 4], [5, 6, 7]]
    assert got[0]["labels"] == [1, 2, 3]
    aligned = token_files.read_shards(spark, f"{tmp_path}/*.bin", 3, bos=7).orderBy("sample").collect()
    assert [r["input_ids"] for r in aligned] == [[7, 1, 2], [7, 4, 5]]
    spark.dataSource.register(token_files.TokenShardSource)
    assert spark.read.format("token_shards").load(f"{tmp_path}/*.bin").first()["tokens"] == tokens.tolist()


def test_manifest_and_messages(spark, tmp_path):
    row = {"messages": [{"role": "user", "content": "hi"}], "lang": "en", "task": "t", "source": "s"}
    (tmp_path / "a.jsonl").write_text(json.dumps(row) + "\n\n" + json.dumps(row) + "\n")
    (tmp_path / "m.json").write_text(json.dumps({"pool": {"file_name": "a.jsonl"}}))
    got = readers.manifest_records(spark, f"{tmp_path}/m.json").collect()
    assert len(got) == 2 and got[0]["dataset"] == "pool" and got[0]["messages"][0]["content"] == "hi"
    (tmp_path / "bad.jsonl").write_text("{broken\n" + json.dumps(row) + "\n")
    assert readers.read_messages(spark, f"{tmp_path}/bad.jsonl", skip_invalid=True).count() == 1
    assert readers.parse_split("train[1024:]") == ("train", slice(1024, None))
    assert readers.is_delta("abfss://x") and not readers.is_delta("/x/y")


def test_retrieval_file(spark, tmp_path):
    (tmp_path / "q.json").write_text(json.dumps({"corpus": [{"path": "c"}], "data": [{"question_id": 1, "question": "q", "corpus_id": "c", "pos_doc": [{"id": 5}], "neg_doc": []}]}))
    df, paths = readers.read_retrieval(spark, f"{tmp_path}/q.json")
    assert df.first()["pos_doc"] == ["5"] and paths == [f"{tmp_path}/c"]


def test_bio(spark):
    lines = spark.createDataFrame([("f", "Ann B-PERS\nLee I-PERS\nwent O\nto O\nRome B-LOC\n\nx\n\nA B-ORG")], "path string, value string")
    got = readers.conll_sentences(lines).withColumn("spans", readers.bio_spans("tokens", "tags")).orderBy("sentence").collect()
    assert [(s["type"], s["text"]) for s in got[0]["spans"]] == [("PER", "Ann Lee"), ("LOC", "Rome")]
    assert len(got) == 2


def test_mixture_writer(spark, tmp_path):
    df = spark.createDataFrame([(i, "en" if i % 2 else "fr", "t") for i in range(20)], "doc_id long, lang string, task string")
    sinks.write_mixture(df, f"{tmp_path}/out", rows_per_file=4)
    manifest = json.loads((tmp_path / "out/manifest.json").read_text())
    assert sum(v["records"] for v in manifest.values()) == 20
    assert spark.read.json(f"{tmp_path}/out/partition=*").count() == 20
    with pytest.raises(FileExistsError):
        sinks.write_mixture(df, f"{tmp_path}/out")


def test_resume_shards(spark):
    planned = spark.range(5).withColumnRenamed("id", "shard")
    assert sinks.resume_shards(planned, spark.range(2).withColumnRenamed("id", "shard")).count() == 3
    with pytest.raises(ValueError, match="contiguous"):
        sinks.resume_shards(planned, spark.createDataFrame([(0,), (2,)], "shard long"))


@pytest.mark.parametrize("size", [1, 2, 3, 7, 20])
def test_reservoir(size):
    out = streams.reservoir_order(list(range(10)), size, 123)
    assert sorted(out) == list(range(10))
    assert out == streams.reservoir_order(list(range(10)), size, 123)


def test_stream_runs_to_its_end_and_goes_on(spark, tmp_path):
    schema = "key string, item long, payload string"
    spark.createDataFrame([("k", i, str(i)) for i in range(10)], schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = streams.read_stream(spark, f"{tmp_path}/in", schema)
    streams.run_available(stream.where("item < 8"), f"{tmp_path}/out", f"{tmp_path}/ck")
    streams.run_available(stream.where("item < 8"), f"{tmp_path}/out", f"{tmp_path}/ck")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 8


def test_newest_cycle_wins(spark):
    df = spark.createDataFrame([(1, True, True), (2, True, False), (3, True, False), (4, False, False)], "cycle long, ready boolean, consumed boolean")
    assert {(r["cycle"], r["action"]) for r in streams.newest_ready(df).collect()} == {(2, "drop"), (3, "take")}
