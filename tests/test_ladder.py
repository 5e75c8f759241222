"""Suspect windows against all windows, and texts that are read once."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import queries
from tessera.functions import text
from tessera.operators import decontam, ladder


def test_suspects_are_the_windows_of_the_blocklist(spark):
    rng = random.Random(3)
    words = ["Straße", "a", "b", "ﬁn", "中", "x" * 40, "É", "1"]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    bench = [make(n) for n in (11, 12, 13, 60, 200)]
    long = " \n ".join([make(80_000), bench[3].upper(), make(9), bench[1]])  # more windows than a block
    texts = [None, "", "  ", long, *bench, *[f"{make(rng.randint(0, 30))}\t{' '.join(bench[4].split()[:14])} {make(5)}" for _ in range(300)], *[make(40) for _ in range(300)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    fields = spark.createDataFrame([("b", "q", t) for t in bench], "benchmark string, field string, text string")
    whole, parts = decontam.blocklist(fields)
    known = {r["fragment"] for r in parts.collect()}
    got = {r["doc_id"]: r for r in decontam.suspects(docs, decontam.edges(fields)).collect()}
    want = docs.select("doc_id", text.digest("text").alias("digest"), text.fragments("text").alias("f")).collect()
    assert len(got) == len(texts) and sum(bool(r["fragments"]) for r in got.values()) > 100
    for r in want:
        assert got[r["doc_id"]]["digest"] == r["digest"]
        assert sorted(got[r["doc_id"]]["fragments"]) == sorted(set(r["f"] or ()) & known)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(decontam.match(docs, whole, parts, edge_table=decontam.edges(fields))) == rows(decontam.match(docs, whole, parts))


def test_equal_edges_alone_are_no_suspect(spark):
    inside = [str(i) for i in range(10)]
    fields = spark.createDataFrame([("b", "q", " ".join(["a", *inside, "z"]))], "benchmark string, field string, text string")
    docs = spark.createDataFrame([(1, " ".join(["a", *reversed(inside), "z"])), (2, " ".join(["o", "a", *inside, "z"]))], "doc_id long, text string")
    got = {r["doc_id"]: len(r["fragments"]) for r in decontam.suspects(docs, decontam.edges(fields)).collect()}
    assert got == {1: 0, 2: 1}


def test_many_hashes_go_the_plain_way(spark, monkeypatch):
    monkeypatch.setattr(decontam, "EDGE_ROWS", 1)
    passage = " ".join(map(str, range(20)))
    fields = spark.createDataFrame([("b", "q", passage)], "benchmark string, field string, text string")
    docs = spark.createDataFrame([(1, f"x {passage}"), (2, passage), (3, "x"), (4, None)], "doc_id long, text string")
    whole, parts = decontam.blocklist(fields)
    assert sorted((r["doc_id"], r["kind"]) for r in decontam.match(docs, whole, parts, edge_table=decontam.edges(fields)).collect()) == [(1, "fragment"), (2, "exact")]


def test_windows_of_sliced_arrays():
    import pyarrow as pa

    texts = pa.array(["q", None, " ".join("abcdefghijklm"), "", " ".join("abcdefghijkl")])
    for column in (texts, texts.slice(2), texts.cast(pa.large_string()).slice(1, 4)):
        found = [(column[int(o)].as_py()[:1], h) for owners, _, _, hs in decontam.window_hashes(*decontam._bytes(column)) for o, h in zip(owners, hs, strict=True)]
        assert len(found) == 3 and len(set(np.array([h for _, h in found]))) == 2
    assert not list(decontam.window_hashes(*decontam._bytes(pa.array([], pa.string()))))


def test_windows_come_in_small_blocks():
    """The same windows, in blocks whose sums fit a core's cache, and looked up without sorting the known hashes again."""
    rng = random.Random(7)
    texts = [" ".join(str(rng.randint(0, 999)) for _ in range(n)) for n in (40_000, 3, 12, 30_000, 11, 25)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    blocks, whole = list(decontam.window_hashes(data, offsets)), list(decontam.window_hashes(data, offsets, block=2**20))
    assert len(whole) == 1 and max(len(b[0]) for b in blocks) <= 2**14
    assert all((np.concatenate(parts) == all_).all() for parts, all_ in zip(zip(*blocks, strict=True), whole[0], strict=True))
    top = np.uint64(2**64 - 1)
    hashes = np.concatenate([whole[0][3], np.array([0, top], np.uint64)])
    for known in (hashes[::7], hashes[-1:], hashes[:-1], hashes[:0]):
        known = np.unique(known)
        assert (decontam.among(hashes, known) == np.isin(hashes, known)).all()


@pytest.mark.parametrize("last", [False, True])
def test_the_ladder_reads_texts_once(spark, last):
    plan = queries._laddered(spark, "/root/testdata/sf0.001", last).select("reason")._jdf.queryExecution().optimizedPlan().toString()
    documents = [line for line in plan.splitlines() if "parquet" in line and "text#" in line]
    assert not any("source#" in line or "n_chars#" in line for line in documents)


def test_canonical_bytes_and_token_counts_are_those_of_the_columns(spark):
    import sys

    import pyarrow as pa

    rng = random.Random(4)
    odd = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"{c} A{c}" for c in odd[i : i + 997]) for i in range(0, len(odd), 997)] + [None, "", " ", "\x85", " \u2028 a\u1680"]
    texts += [" ".join(f"a{c}b{c}" for c in odd if c.isspace()), *["".join(rng.choice(" \t\n\x0b\x1cAbß\xa0\u3000") for _ in range(rng.randint(0, 30))) for _ in range(2000)]]
    column = pa.array(texts, pa.string())
    for at in (0, 3):
        data, offsets = decontam.canonical_bytes(column.slice(at))
        assert [bytes(data[a:b]).decode() for a, b in zip(offsets, offsets[1:], strict=False)] == ["" if x is None else text.canonical_form(x) for x in texts[at:]]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select(text.token_count("t")).collect()
    assert decontam.token_counts(column).tolist() == [r[0] for r in rows]
    assert decontam.token_counts(column.slice(2)).tolist() == [r[0] for r in rows[2:]]


def test_one_row_group_is_spread(spark, tmp_path):
    """Splits by bytes of a file with one row group, all but one of them empty."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = random.Random(5)
    pq.write_table(pa.table({"doc_id": list(range(1200)), "text": [rng.randbytes(10_000).hex() for _ in range(1200)]}), str(tmp_path / "d.parquet"), compression="none")
    docs = spark.read.parquet(str(tmp_path / "d.parquet"))
    assert docs.rdd.getNumPartitions() >= 4
    assert decontam.spread(docs).select(F.spark_partition_id()).distinct().count() == 4


@pytest.mark.parametrize("last", [False, True])
def test_the_ladder_counts_without_a_join(spark, last):
    """Ids that repeat (with equal and other keys), null ids and null keys; as many duplicates as by row numbers."""
    rng = random.Random(6)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, "k1", "k2", *map(str, range(50))]), rng.random() < 0.2) for _ in range(400)]
    rows = [(i, k, bad, None if k is None else len(k) > 1) for i, k, bad in rows]
    df = spark.createDataFrame(rows, "id long, key string, bad boolean, long boolean").repartition(3)
    out = ladder.ladder_counts(df, [("bad", F.col("bad"))], F.col("key"), "id", [("long", F.col("long"))], last)
    want = dict.fromkeys(["bad", "long", "duplicate", "accepted"], 0)
    seen = set()
    for _, key, bad, long in rows:
        again = key in seen and key is not None
        reason = "bad" if bad else "long" if last and long else "duplicate" if again else "long" if long else "accepted"
        want[reason] += 1
        if not bad:
            seen.add(key)
    assert {r["reason"]: r["records"] for r in out.collect()} == {k: v for k, v in want.items() if v}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_rows_without_a_key_are_dealt_out(spark):
    df = spark.range(1000).withColumn("key", F.when(F.col("id") % 10 == 0, F.lit("k")))
    out = ladder.reason_ladder(df, [], F.col("key"), "id", [])
    assert {r["reason"]: r["count"] for r in out.groupBy("reason").count().collect()} == {None: 901, "duplicate": 99}
    assert "_spread" in out._jdf.queryExecution().optimizedPlan().toString() and "_spread" not in out.columns
