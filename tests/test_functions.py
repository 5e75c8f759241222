"""Functions on small hand-made rows."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tessera.functions import chat, media, text, tokens


def one(spark, expr, **values):
    return spark.createDataFrame([Row(**values)]).select(expr.alias("x")).first()["x"]


def test_canonical_forms_agree(spark):
    df = spark.createDataFrame([(" A  Straße\n b ",), ("ÉTÉ",), (None,), ("",)], "t string")
    got = df.select(text.canonical("t").alias("a"), text.canonical_udf("t").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)
    assert got[0]["a"] == "a strasse b"


def test_fragments_need_twelve_tokens(spark):
    words = " ".join("abcdefghijkl")
    assert len(one(spark, text.fragments("t"), t=words)) == 1
    assert one(spark, text.fragments("t"), t=words[:-2]) == []
    assert len(one(spark, text.fragments("t"), t=words + " m n")) == 3


def test_strings(spark):
    assert one(spark, text.slug("t"), t="  Hello, World! ") == "hello-world"
    assert one(spark, text.slug("t"), t="!!!") == "unknown"
    assert one(spark, text.length_bucket("n"), n=17) == "<=32"
    assert one(spark, text.length_bucket("n"), n=5000) == ">4096"
    assert one(spark, text.user_text("a", "b"), a="do", b=" x ") == "do\n\nx"
    assert one(spark, text.user_text("a", "b"), a="do", b=" ") == "do"
    assert one(spark, text.transcript_normal("t"), t="It’s <NOISE> a_test, ok.") == "IT'S A TEST OK"
    assert one(spark, text.strip_endpoint("t"), t="http://h/v1/") == "http://h"
    assert one(spark, text.topic_of("t", ["World News", "Sport"]), t="about worldnews") == "World News"
    assert text.parse_count("1.5M") == 1_500_000
    assert one(spark, text.alias("t", {"named entity": "ner"}), t="Named_Entity") == "ner"
    assert one(spark, text.latin_script("t"), t="привет мир как дела abc") is False


def test_masks(spark):
    labels = [-100, 5, -100, 7, 8, -100]
    assert one(spark, tokens.last_run_only("a"), a=labels) == [-100, -100, -100, 7, 8, -100]
    assert one(spark, tokens.attention_from_labels("a"), a=labels) == [1, 1, 1, 1, 1, 0]
    assert one(spark, tokens.padding_mask("a", 0), a=[3, 0, 4, 0, 0]) == [1, 1, 1, 0, 0]
    assert one(spark, tokens.padding_mask("a", 0, pad_is_eos=True), a=[3, 0, 4, 0, 0]) == [1, 1, 1, 1, 0]
    assert one(spark, tokens.marker_labels("a", 1, 2), a=[9, 1, 4, 5, 2, 6, 1, 7]) == [-100, -100, 4, 5, 2, -100, -100, 7]
    assert one(spark, tokens.expand_placeholder("a", 9, 3), a=[1, 9, 2]) == [1, 9, 9, 9, 2]
    best = one(spark, tokens.top_k_probabilities("p", 2), p=[0.2, 0.5, 0.3])
    assert [r["id"] for r in best] == [1, 2] and best[0]["p"] == pytest.approx(0.625)


def test_media(spark):
    h, w = media.smart_resize("h", "w")
    assert one(spark, F.array(h, w), h=100, w=200) == [112, 196]
    assert (512, 512) in [r[1:] for r in media.bucket_table(512 * 512)]
    assert all(w * h <= 512 * 512 for _, w, h in media.bucket_table(512 * 512))
    assert one(spark, media.even_frames("n", 4), n=10) == [0, 3, 6, 9]
    assert one(spark, media.middle_frames("n", 4), n=2) == [0, 1, 1, 1]
    assert one(spark, media.frames_4n1("n"), n=8) == 5
    assert one(spark, media.grid_tokens("g"), g=[[1, 4, 4], [1, 3, 3]]) == 6


def messages(*turns):
    return [Row(role=r, content=c) for r, c in turns]


def test_history_keeps_system_and_last_exchange(spark):
    m = messages(("system", "s"), ("user", "a b c"), ("assistant", "d"), ("user", "e"), ("assistant", "f"))
    df = spark.createDataFrame([(m,)], f"m {chat.MESSAGES}")
    cut = df.select(chat.truncate_history("m", 4).alias("x")).first()["x"]
    assert [r["content"] for r in cut] == ["s", "e", "f"]
    assert len(df.select(chat.truncate_history("m", 100).alias("x")).first()["x"]) == 5
    assert [r["content"] for r in df.select(chat.trim_tail("m").alias("x")).first()["x"]] == ["s", "a b c", "d", "e"]
    assert df.select(chat.normal_reason("m", F.lit("en"), F.lit(""), F.lit("s")).alias("x")).first()["x"] == "missing_provenance"


def test_tool_call_formats():
    call = '{"name": "f", "arguments": {"a": 1}}'
    assert chat.parse_tool_calls(f"x <tool_call>{call}</tool_call>") == [("f", '{"a": 1}', True)]
    assert chat.parse_tool_calls("<tool_call>{bad</tool_call>") == [(None, "{bad", False)]
    assert chat.parse_tool_calls('<|python_tag|>{"name": "f", "parameters": {}}') == [("f", "{}", True)]
    assert chat.parse_tool_calls(f"[TOOL_CALLS] [{call}, {call}]") == [("f", '{"a": 1}', True)] * 2
    assert chat.parse_tool_calls('text {"name": "g", "arguments": "{\\"b\\": 2}"} more') == [("g", '{"b": 2}', True)]
    assert chat.parse_tool_calls("no call") == []
    assert chat.json_to_tags({"a": [1, 2], "b": "x"}) == "<s_b>x</s_b><s_a>1<sep/>2</s_a>"


def test_canonical_form_is_exact(spark):
    import unicodedata

    texts = [None, "", " A  b\t\nC ", "STRASSE Straße", "ＦＵＬＬ　width", "ﬁne ligature", "no\u00a0break\u2003space", "ΟΔΟΣ σς", "İstanbul", "e\u0301tude É", "a\x1cb\x85c", "1/2 ½ …", "“quoted” – Œuvre"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").orderBy("i").select(text.canonical("t")).collect()]
    assert got == [None if t is None else " ".join(unicodedata.normalize("NFKC", t).casefold().split()) for t in texts]


def test_edges_never_hide_a_fragment(spark):
    from tessera.operators import decontam

    passage = " ".join(f"Wörd{i}" for i in range(14))
    docs = spark.createDataFrame([(1, f"x y {passage} z"), (2, passage.upper()), (3, " ".join(passage.split()[:11])), (4, None), (5, "")], "doc_id long, text string")
    fields = spark.createDataFrame([("b", "q", passage)], "benchmark string, field string, text string")
    whole, parts = decontam.blocklist(fields)
    found = {(r["doc_id"], r["kind"]) for r in decontam.match(docs, whole, parts, edge_table=decontam.edges(fields)).collect()}
    assert found == {(1, "fragment"), (2, "exact")} == {(r["doc_id"], r["kind"]) for r in decontam.match(docs, whole, parts).collect()}


def test_pack_counters_and_left_padding(spark):
    assert one(spark, tokens.remaining("n"), n=[3, 0, 2]) == [2, 1, 0, 1, 0]
    assert one(spark, tokens.folded_positions("n", 7), n=[3, 2]) == [0, 1, 2, 0, 1, 2, 3]
    assert one(spark, tokens.folded_positions("n", 4), n=[4]) == [0, 1, 2, 3]
    assert one(spark, tokens.shift_for_left_pad("m", "a"), m=[1, 0, 1, 0, 0], a=[0, 0, 1, 1, 1]) == [0, 0, 1, 0, 1]
    assert one(spark, tokens.shift_for_left_pad("m", "a"), m=[1, 0, 1], a=[1, 1, 1]) == [1, 0, 1]
