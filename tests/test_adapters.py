"""Adapters and collation on small rows."""

from pyspark.sql import functions as F

from tessera.functions import chat, collate
from tessera.sources import adapters


def turns(row):
    return [m["content"] for m in row["messages"]]


def test_instruction_rows(spark):
    df = spark.createDataFrame([("do", "nan", "done", "eng"), ("sum", "1 2", "3", "eng"), ("x", "", " ", "eng"), ("y", "", "z", "tlh")], "instruction string, input string, output string, l string")
    got = adapters.adapt(df, "chat", "src", ["instruction"], ["output"], lang="l", languages={"eng": "en"}, inputs="input").collect()
    assert [turns(r) for r in got] == [["do", "done"], ["sum\n\n1 2", "3"]]
    assert {r["lang"] for r in got} == {"en"}


def test_translation_rows(spark):
    df = spark.createDataFrame([("hello", "bonjour"), ("same", "Same"), ("", "x")], "en string, fr string")
    got = adapters.translations(df, "src", [("en", "en", "fr", "fr")]).collect()
    assert sorted(r["direction"] for r in got) == ["en-fr", "fr-en"] or sorted(r["direction"] for r in got) == ["en-fr", "fr-en", "fr-en"]
    assert sum(r["direction"] == "en-fr" for r in got) == 1


def test_spans_lines_and_columns(spark):
    df = spark.createDataFrame([("Ann in Rome", [(0, 3, "PER"), (7, 11, "LOC"), (5, 99, "BAD")])], "t string, s array<struct<start:int,end:int,label:string>>")
    row = adapters.char_spans(df, "t", "s", "src", "en").first()
    assert row["entity_types"] == ["LOC", "PER"] and '"text":"Rome"' in turns(row)[1]
    files = spark.createDataFrame([("good day\n1\nbad day\n0\n",)], "value string")
    assert [turns(r) for r in adapters.line_pairs(files, "s", "en", {"1": "positive", "0": "negative"}).collect()] == [["good day", "positive"], ["bad day", "negative"]]
    assert adapters.two_columns(spark.createDataFrame([("a\tb",), ("c",)], "value string"), "x", "y").collect() == [("a", "b")]
    wide = spark.createDataFrame([(1, "a", " ")], "id long, en string, fr string")
    assert adapters.unpivot_languages(wide, "id", {"en": "en", "fr": "fr"}).count() == 1


def test_prefix_tree(spark):
    df = spark.createDataFrame([([7, 8, 9], [[31, 32, 33, 34], [41]])], "p array<int>, c array<array<int>>")
    row = df.select(*[c.alias(k) for k, c in collate.prefix_tree("p", "c").items()]).first()
    assert row["input_ids"] == [7, 8, 9, 31, 32, 33, 34, 41]
    assert row["labels"] == [-100, -100, -100, 32, 33, 34, -100, -100]
    assert row["position_ids"] == [0, 1, 2, 3, 4, 5, 6, 3]
    assert row["node_lengths"] == [3, 4, 1] and row["paths"] == [[0, 1], [0, 2]]


def test_agent_turns_fold(spark):
    m = [("user", "q"), ("assistant", "let me see"), ("tool_call", "f"), ("tool_call", "g"), ("tool_response", "1"), ("tool_response", "2"), ("assistant", "done")]
    df = spark.createDataFrame([(7, m)], f"ex long, m {chat.MESSAGES}")
    got = df.select(collate.fold_agent_turns("m", "ex").alias("x")).first()["x"]
    assert [t["role"] for t in got] == ["user", "assistant", "tool", "tool", "assistant"]
    assert [c["id"] for c in got[1]["tool_calls"]] == ["call_7_0", "call_7_1"]
    assert [t["tool_call_id"] for t in got[2:4]] == ["call_7_0", "call_7_1"]


def test_pad_batches(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (1, [4]), (2, [5])], "b int, ids array<int>")
    got = collate.pad_batches(df, "b", {"ids": 0}, 2).orderBy("b", F.desc("ids")).collect()
    assert sorted(r["ids"] for r in got) == [[1, 2, 3, 0], [4, 0, 0, 0], [5, 0]]
