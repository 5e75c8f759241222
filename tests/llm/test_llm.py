"""Operators of the llm subpackage against brute force on small fixtures, and edge cases."""

import hashlib
import inspect
import random
import re
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import common, language_id, merkle, mixing, near_dedup, packing, quality, queries, substring_dedup, token_counts, toxicity, url_filter

SF = "/root/testdata/sf0.001"
WORD = re.compile(common.WORD)
has_tables = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)], DOCS)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


EDGES = [None, "", "   \n", "one", "one two three", "A b C d e f", "a B c D e f", "same same same same same same same", "é ü ß 漢字 ∑ 🙂 x y"]


# ---------------------------------------------------------------- kernels


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t漢", max_size=30)), max_size=8))
@settings(max_examples=80, deadline=None)
def test_words_are_cut_as_by_the_pattern(texts):
    seen = {}
    got = [[] for _ in texts]
    for first, h, counts in common.words_by_text(pa.array(texts, pa.string()), fold=True):
        for i, own in enumerate(np.split(h, np.cumsum(counts)[:-1])):
            got[first + i] += own.tolist()
    for text, hashes in zip(texts, got, strict=True):
        expected = words(text)
        assert len(hashes) == len(expected)
        for w, h in zip(expected, hashes, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_texts_go_over_several_blocks(monkeypatch):
    monkeypatch.setattr(common, "BLOCK", 16)
    text = " ".join(f"word{i}" for i in range(200)) + " " + "x" * 100
    parts = [h for _, h, _ in common.words_by_text(pa.array([text, "word3"]), fold=False)]
    h = np.concatenate(parts)
    assert len(h) == 202 and h[3] == h[-1]


# ---------------------------------------------------------------- 1 near-dedup


def brute_components(texts, k, percent):
    sets = [{tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if (w := words(t)) else set() for t in texts]
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(i):
                a, b = sets[i], sets[j]
                if a and b and 100 * len(a & b) >= percent * len(a | b) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return [(len(s), x) for s, x in zip(sets, label, strict=True)]


def near_texts(seed=1):
    rng = random.Random(seed)
    out = list(EDGES)
    for _ in range(12):
        base = prose(rng, rng.randrange(5, 120)).split()
        out.append(" ".join(base))
        for _ in range(rng.randrange(0, 5)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(99)}"
            out.append(" ".join(copy))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("options", [{}, {"leaf": 3, "depth": 4}, {"block": 2}])
def test_components_equal_brute_force(spark, options):
    texts = near_texts()
    got = near_dedup.near_duplicates(docs(spark, texts), k=4, **options).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == dict(enumerate(brute_components(texts, 4, 80)))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_one_document_of_each_group_stays(spark):
    texts = ["a b c d e f g"] * 4 + ["other words in this one here", None, ""]
    left = near_dedup.drop_near_duplicates(docs(spark, texts).withColumn("label", F.lit(1)))
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 4, 5, 6]
    assert left.columns[-1] == "label"


def test_near_dedup_edges(spark):
    rng = random.Random(12)
    a, b = prose(rng, 60), prose(rng, 60)
    long = prose(rng, 300_000, 10**6)
    rows = [(1, a), (1, b), (2, b), (None, a), (None, None), (3, long), (4, long + " end"), (5, a), (5, a)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, gone string, _gone string")
    got = near_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    label = {(r["doc_id"], r["n_shingles"] > 0): r["component_id"] for r in got}
    assert label == {(1, True): 1, (2, True): 1, (None, True): None, (None, False): None, (3, True): 3, (4, True): 3, (5, True): 1}
    left = near_dedup.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 0, 1, 1, 3]


def test_a_group_larger_than_a_block_is_one_component(spark):
    rng = random.Random(3)
    base = prose(rng, 80).split()
    texts = [" ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) for i in range(40)]
    got = near_dedup.near_duplicates(docs(spark, texts), k=4, block=8, leaf=8, depth=3).collect()
    assert {r["component_id"] for r in got} == {0}


def test_a_node_left_at_the_last_level_is_compared_whole(spark):
    rng = np.random.default_rng(4)
    sig = rng.integers(0, 2**32, (200, near_dedup.COORDS), dtype=np.uint32)
    sig[:, 0] = 7  # all share the one node of the only tree
    sig[150, 8:] = sig[20, 8:]  # one pair, unlike in coordinates 1..7
    sets = spark.createDataFrame([(i, 50, bytearray(v.tobytes())) for i, v in enumerate(sig)], "id long, n long, sig binary")
    got = near_dedup.candidate_clusters(sets, 0.8, trees=1, branch=2, leaf=8, depth=1).collect()
    assert {(r["id"], r["label"]) for r in got} == {(20, 20), (150, 20)}


def test_recall_at_the_threshold_does_not_fall_with_depth(spark):
    rng = np.random.default_rng(9)
    pairs = 1200
    left = rng.integers(0, 4, (pairs, near_dedup.COORDS), dtype=np.uint32)  # few values: many levels until nodes are small
    right = left.copy()
    for row in right:
        other = rng.choice(near_dedup.COORDS, 13, replace=False)
        row[other] = row[other] + 4 + rng.integers(0, 4, 13, dtype=np.uint32)
    rows = [(i, 50, bytearray(v.tobytes())) for i, v in enumerate(np.concatenate([left, right]))]
    sets = spark.createDataFrame(rows, "id long, n long, sig binary")
    default = {k: v.default for k, v in inspect.signature(near_dedup.near_duplicates).parameters.items()}
    got = near_dedup.candidate_clusters(sets, 0.78, default["trees"], default["branch"], leaf=2, depth=8)
    label = {r["id"]: r["label"] for r in got.collect()}
    missed = sum(i not in label or label.get(i) != label.get(i + pairs) for i in range(pairs))
    assert missed <= 1


def test_near_dedup_of_an_empty_table(spark):
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (5, 5), (None, 1)], "a long, b long")
    got = {r["id"]: r["label"] for r in common.connected_components(edges).collect()}
    assert got == dict.fromkeys(range(31), 0) | {100: 100, 101: 100}


# ---------------------------------------------------------------- 2 url filters


def brute_verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in url_filter.DEFAULT_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[3], max(fits)[4]
    spam = set(re.split("[.-]", host)) & set(url_filter.BLOCKED_HOST_WORDS)
    return host, path, None, "block" if spam else "allow"


URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.org/es/1", "http://a.example.org/en/17?x", "http://example.org/en/2", "http://notexample.org/es/1", "x://y.com/de/", "x://com/fr/#f", "http://b.com?/fr/", "http://casino-win.net/a", "http://org", "http://org/", "ftp://u.example.org/es", "http://a://b.com/fr/", "http://" + "s." * 300 + "com/de/1"]


def test_urls_equal_brute_force(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS + URLS[:5])], "page_id long, url string, verdict string")
    got = url_filter.judge_urls(df, url_filter.rules_table(spark)).collect()
    assert len(got) == len(URLS) + 5
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_verdict(r["url"])


def test_urls_without_rules(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert url_filter.judge_urls(df, url_filter.rules_table(spark, (), ())).first()["verdict"] == "allow"
    assert url_filter.judge_urls(df.limit(0), url_filter.rules_table(spark)).count() == 0


# ---------------------------------------------------------------- 4 token counts, 5 packing


@pytest.mark.skipif(not Path(token_counts.TOKENIZER_DIR).exists(), reason="needs the vocabulary files")
def test_token_histogram(spark):
    texts = [*EDGES, "hello world " * 500, "<|endoftext|> is text"]
    lengths = [r["n_tokens"] for r in token_counts.with_token_count(docs(spark, texts)).collect()]
    encode = token_counts.encoder(token_counts.TOKENIZER_DIR, token_counts.RANKS_FILE, None).encode_ordinary
    assert sorted(lengths) == sorted(len(encode(t or "")) for t in texts)
    assert lengths.count(0) == 2
    histogram = token_counts.length_histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens long"))
    for r in histogram.collect():
        limit = r["length"]
        assert r["n_docs"] == lengths.count(limit)
        assert r["docs_over"] == sum(n > limit for n in lengths)
        assert r["tokens_truncated"] == sum(min(n, limit) for n in lengths)
        assert r["tokens_lost"] == sum(max(n - limit, 0) for n in lengths)
    assert {r["context"]: r["tokens_truncated"] for r in token_counts.truncated_totals(histogram, [3, 100]).collect()} == {c: sum(min(n, c) for n in lengths) for c in (3, 100)}
    assert token_counts.quantiles(histogram, [0.5]).first()["length"] == sorted(lengths)[-(-len(lengths) // 2) - 1]


def brute_padding(lengths, counts, buckets):
    from itertools import combinations

    pairs = sorted(zip(lengths, counts, strict=True))
    top = pairs[-1][0]
    options = [x for x, _ in pairs[:-1]]
    best = None
    for n in range(min(buckets, len(pairs))):
        for c in combinations(options, n):
            bounds = [*c, top]
            best = min(filter(lambda v: v is not None, (best, sum(k * (next(b for b in bounds if b >= x) - x) for x, k in pairs))))
    return best


@given(st.dictionaries(st.integers(0, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 4))
@settings(max_examples=80, deadline=None)
def test_boundaries_are_optimal(histogram, buckets):
    lengths, counts = np.array(list(histogram)), np.array(list(histogram.values()))
    bounds = packing.optimal_boundaries(lengths, counts, buckets)
    assert len(bounds) <= buckets and bounds[-1] == lengths.max()
    cost = sum(n * (next(b for b in bounds if b >= x) - x) for x, n in histogram.items())
    assert cost == brute_padding(lengths, counts, buckets)


def test_every_document_is_packed_once(spark):
    rng = random.Random(2)
    sizes = [rng.randrange(0, 300) for _ in range(200)] + [5000]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)] + [(None, None)], "doc_id long, length long")
    got = packing.pack(df.where("doc_id is not null"), buckets=5, token_budget=1000, shard_rows=40).collect()
    assert sorted(i for r in got for i in r["doc_ids"]) == list(range(201))
    for r in got:
        own = [sizes[i] for i in r["doc_ids"]]
        assert max(own) <= r["boundary"] and r["tokens"] == sum(own)
        assert r["padded"] <= 1000 or r["n_docs"] == 1
    assert packing.pack(df.where("doc_id < 0")).count() == 0
    assert packing.pack(df).agg(F.sum("n_docs")).first()[0] == 202


def test_documents_are_packed_by_tokens(spark):
    texts = ["漢字" * 400, "x" * 3000, "plain words of prose here " * 100, None, ""]
    encode = token_counts.encoder(token_counts.TOKENIZER_DIR, token_counts.RANKS_FILE, None).encode_ordinary
    got = packing.pack_documents(docs(spark, texts), token_budget=600).collect()
    assert sorted(i for r in got for i in r["doc_ids"]) == list(range(5))
    for r in got:
        assert r["tokens"] == sum(len(encode(texts[i] or "")) for i in r["doc_ids"])


# ---------------------------------------------------------------- 6 quality rules


def brute_quality(text):
    text = text or ""
    w = WORD.findall(text)
    wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {p for i, x in enumerate(wins) if wins.count(x) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [*EDGES, "a\nb\na\n \na", "x y z x y z x", "#a $b <c>|%&*", " ".join(f"v{rng.randrange(6)}" for _ in range(300)), "a b c d e " * 15000]
    got = quality.judge(quality.measures(docs(spark, texts))).orderBy("doc_id").collect()
    for t, r in zip(texts[:-1], got, strict=False):
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute_quality(t)
    assert got[-1]["n_words"] == 75000 and got[-1]["n_repeat_words"] == 75000
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_rules_are_a_table(spark):
    got = quality.judge(quality.measures(docs(spark, [prose(random.Random(1), 80) + " the of and"])), [quality.Rule("long", "n_words / n_lines", None, 10)]).first()
    assert got["failed_rules"] == ["long"] and not got["kept"]


# ---------------------------------------------------------------- 7 language id


def brute_kneser_ney(text):
    """p(c, context) of a naive model of one language: dictionaries of strings."""
    order = language_id.ORDER
    c = "".join(chr(x) for x in language_id._stream([text])[0])
    grams = [c[i - order + 1 : i + 1] for i in language_id._stream([text])[1]]
    counts = {order: {}}
    for g in grams:
        counts[order][g] = counts[order].get(g, 0) + 1
    for n in range(order - 1, 0, -1):
        counts[n] = {}
        for g in counts[n + 1]:
            counts[n][g[1:]] = counts[n].get(g[1:], 0) + 1

    def p(letter, context):
        n = len(context) + 1
        lower = p(letter, context[1:]) if n > 1 else 1 / 0x11000
        once, twice = (sum(v == k for v in counts[n].values()) for k in (1, 2))
        d = min(max(once / (once + 2 * twice) if once + 2 * twice else 0.5, 0.1), 0.95)
        own = {g: v for g, v in counts[n].items() if g[:-1] == context}
        total = sum(own.values())
        if n > 1 and context not in counts[n - 1]:  # a context that was never predicted (a run of spaces) has no counts
            return lower
        return lower if not total else max(own.get(context + letter, 0) - d, 0) / total + d * len(own) / total * lower

    return p


def test_model_equals_naive_kneser_ney():
    text = "abcab abc ab ba cab bac"
    model, p = language_id.Model({"x": [text]}), brute_kneser_ney(text)
    for asked in ("abc ab", "cab", "zab qa", "b"):
        c, places, _ = language_id._stream([asked])
        c = "".join(map(chr, c))
        expected = -sum(np.log(p(c[i], c[i - language_id.ORDER + 1 : i])) for i in places)
        e, n = model.cross_entropy([asked])
        assert n[0] == len(places) and e[0, 0] * n[0] == pytest.approx(expected, rel=1e-4)


def test_naive_kneser_ney_sums_to_one():
    p = brute_kneser_ney("abcab abc ab ba cab bac")
    for context in ("", "a", "ab", "zz", "b c", " ab"):
        seen = sum(p(c, context) for c in "abc \n")
        assert seen + (0x11000 - 5) * p("z", context) == pytest.approx(1.0)


def test_languages_are_told_apart(spark):
    rng = random.Random(6)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(60))
    rows = [(i, make("abcdeaei") if i % 2 else make("öüßxyzöü"), "aa" if i % 2 else "bb") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df.where("doc_id < 60"), chars=5000)
    got = {r["doc_id"]: r for r in language_id.identify(df, model, reject=False).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (4, "漢字漢字" * 50)], "doc_id long, text string")
    assert [r["lang_pred"] for r in language_id.identify(odd, model).orderBy("doc_id").collect()] == ["und"] * 4
    assert language_id.identify(odd, model, reject=False).where("doc_id = 4").first()["lang_pred"] in ("aa", "bb")
    assert language_id.identify(odd, language_id.fit(df.limit(0))).where("lang_pred <> 'und'").count() == 0


def test_one_long_document_does_not_empty_the_sample(spark):
    rows = [(i, "short text " * 5, "aa") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    first = df.orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))).first()["doc_id"]
    df = df.withColumn("text", F.when(F.col("doc_id") == first, F.lit("long text " * 1000)).otherwise(F.col("text")))
    got = language_id.training_sample(df, chars=2000).collect()
    assert len(got) > 20 and sum(len(r["text"]) for r in got) <= 2000


def test_neighbours_in_a_batch_do_not_matter():
    model = language_id.Model({"x": ["hello there world"], "y": ["ola mundo bom"]})
    alone, _ = model.cross_entropy(["world"])
    beside, _ = model.cross_entropy(["ola", "world", "x" * 50])
    assert np.allclose(alone[0], beside[1])


def test_marks_long_and_repeated_texts_and_null_ids(spark):
    rows = [(i, "नमस्ते दुनिया " * 9 if i % 2 else "hello world again " * 9, "hi" if i % 2 else "en") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    asked = [(1, "नमस्ते"), (1, "नमस्ते"), (None, "hello"), (2, "\u0301\u0301"), (3, "hello world " * 400_000)]
    got = language_id.identify(spark.createDataFrame(asked, "doc_id long, text string"), model, reject=False).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in got) == [(0, "en"), (1, "hi"), (1, "hi"), (2, "und"), (3, "en")]


def test_every_language_is_learned(spark):
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)} " * 50, f"l{i:03d}") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.training_sample(df, total=120 * 20).collect()
    assert len({r["lang"] for r in got}) == 120 and sum(len(r["text"]) for r in got) <= 120 * 20


# ---------------------------------------------------------------- 8 toxicity


def naive_hits(text, entries, exceptions):
    """Weights of the entries that words of plain a-z text match, without those inside an exception."""
    spans = [m.span() for x in exceptions for m in re.finditer(rf"(?<![a-z]){x}(?![a-z])", text)]
    weights = []
    for m in re.finditer("[a-z]+", text):
        fits = [(len(e.rstrip("*")), w) for e, w in entries.items() if (m[0].startswith(e[:-1]) if e.endswith("*") else m[0] == e)]
        if fits and not any(a <= m.start() and m.start() + max(fits)[0] <= b for a, b in spans):
            weights.append(max(fits)[1])
    return sum(weights), len(weights)


@given(st.lists(st.lists(st.sampled_from(["trash", "can", "trashy", "scum", "scumbag", "bad", "badly", "x", "ban"]), max_size=12).map(" ".join), max_size=5))
@settings(max_examples=100, deadline=None)
def test_matches_equal_a_naive_matcher(texts):
    entries, exceptions = {"trash": 2.0, "scum*": 4.0, "bad*": 1.0, "badly": 3.0}, ["trash can", "bad x"]
    model = toxicity.Model(entries, exceptions)
    weight, hits, words = toxicity.lexicon_weights(texts, model.entries, model.exceptions)
    assert [(w, h) for w, h in zip(weight, hits, strict=True)] == [naive_hits(t, entries, exceptions) for t in texts]
    assert words.tolist() == [len(t.split()) for t in texts]


def test_odd_labels_are_ignored(spark):
    rows = [(i, "you blargh person" if i % 2 else "a kind person", v) for i, v in enumerate([0, 1] * 20 + [2, -1, None])]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert model.score(["you blargh"])[0][0] > model.score(["a kind"])[0][0]
    long = spark.createDataFrame([(1, "word " * 2_000_000), (None, None), (1, "")], "doc_id long, text string")
    assert toxicity.score_documents(long, model).count() == 3


def test_folding_and_exceptions():
    model = toxicity.Model({"idiot": 4.0, "scum": 4.0, "trash": 2.0, "bomen*": 3.0})
    texts = ["you IDIOT", "you 1d10t", "you ｉｄｉｏｔ", "you іdіоt", "idiotic scumbag", "in the trash can", "pure trash", "bomento x", "xbomento", "sc\u00famm", None, "", "12345"]
    _, hits = model.score(texts)
    assert hits.tolist() == [1, 1, 1, 1, 0, 0, 1, 1, 0, 0, 0, 0, 0]


def test_lexicon_is_learned(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        w = prose(rng, 60, 3000).split()
        if bad:
            for _ in range(3):
                w[rng.randrange(60)] = rng.choice(["blargh", "zorkish", "zorken"])
        rows.append((i, " ".join(w), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.where("doc_id < 300"))
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(df, model).collect()}
    assert sum(got[i] == t for i, _, t in rows if i >= 300) >= 97
    assert toxicity.drop_toxic(df, model).count() == sum(1 for v in got.values() if not v)
    assert toxicity.fit(df.limit(0)).score(["you idiot moron scum"])[0][0] >= 0.5


# ---------------------------------------------------------------- 9 fingerprints


def pieces(text):
    """Naive cut: sections -> paragraphs -> sentences (no text of these tests has a sentence that is too long)."""
    sections = re.findall(r"(?:[^\n]|\n(?!\n))*(?:\n{2,}|\Z)", text)
    return [[re.findall(r"(?:[^.!?]|(?<=^)[.!?])*?[^.!?]*[.!?]+\s*|[^.!?]+\Z", p) for p in re.findall(r"[^\n]*(?:\n+|\Z)", s) if p] for s in sections if s]


def brute_likeness(a, b):
    """Twice the characters in common nodes over all: sections first, then paragraphs of what is left, then sentences."""
    if a == b:
        return 1.0
    left, right = pieces(a), pieces(b)
    both = 0
    for down in (lambda nodes: [p for s in nodes for p in s], lambda nodes: [x for p in nodes for x in p], None):
        for node in list(left):
            if node in right:
                right.remove(node)
                left.remove(node)
                both += len(flat(node))
        if down:
            left, right = down(left), down(right)
    return min(2 * both / (len(a) + len(b)), 0.999999) if a or b else 1.0


def flat(node):
    return node if isinstance(node, str) else "".join(map(flat, node))


@given(st.lists(st.text(alphabet="ab. \n!é", max_size=120), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_leaves_cover_the_texts(texts):
    prints = merkle.fingerprint_many(texts)
    for text, fp in zip(texts, prints, strict=True):
        assert fp == merkle.fingerprint(text)
        nodes, _ = merkle._nodes([fp])
        assert nodes["size"].sum() == len(text)
        assert merkle.likeness(fp, fp) == 1.0
        assert merkle.fingerprint(text + "x") != fp


PARTS = ["One here. ", "Two! ", "Three.\n", "Four five.\n\n", "Six.", "Se ven? "]


@given(st.lists(st.sampled_from(PARTS), max_size=9), st.lists(st.sampled_from(PARTS), max_size=9))
@settings(max_examples=150, deadline=None)
def test_likeness_equals_brute_force(a, b):
    a, b = "".join(a), "".join(b)
    assert flat(pieces(a)) == a
    assert merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(b)) == pytest.approx(brute_likeness(a, b))


def test_edits_are_located():
    a = "One here. Two.\nThree.\n\nFour five.\nSix."
    b = a.replace("Four", "4")
    x, y = merkle.fingerprint(a), merkle.fingerprint(b)
    assert merkle.differing_paragraphs(x, y) == [(1, 0)] and merkle.differing_paragraphs(x, x) == []
    assert 0 < merkle.likeness(x, y) < 1
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint(None)) == 1.0
    long = "".join(f"w{i} " for i in range(200_000))  # one sentence: cut by content
    changed = long[:500_000] + "edit " + long[500_000:]
    nodes, _ = merkle._nodes([merkle.fingerprint(long)])
    assert nodes["size"].max() <= merkle.LEAF
    assert merkle.likeness(merkle.fingerprint(long), merkle.fingerprint(changed)) > 0.999


def test_neighbours_over_slices(spark):
    ids = [5, 1, 9, 3, None, 7, 3]
    df = spark.createDataFrame([(i, f"t{i}-{k}") for k, i in enumerate(ids)], "doc_id long, text string")
    order = sorted(((i is not None, i or 0, f"t{i}-{k}") for k, i in enumerate(ids)))
    got = {r["text"]: r["next_text"] for r in merkle.in_order(df, 3).collect()}
    assert got == {order[k][2]: order[(k + 1) % len(order)][2] for k in range(len(order))}
    one = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [tuple(r) for r in merkle.in_order(one, 3).collect()] == [(1, "a", "a")]
    assert merkle.in_order(one.limit(0), 3).count() == 0


@has_tables
def test_fingerprint_query(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(texts)
    got = {r["doc_id"]: r for r in merkle.op9_fingerprints(spark, SF).collect()}
    assert sorted(got) == ids
    for k, i in enumerate(ids):
        t, n = texts[i], texts[ids[(k + 1) % len(ids)]]
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == merkle.fingerprint(t) and r["edited_fingerprint"] == merkle.fingerprint(edited)
        assert r["near_edited"] == merkle.likeness(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == merkle.likeness(r["fingerprint"], merkle.fingerprint(n))


# ---------------------------------------------------------------- 10 mixing


def test_mix_meets_targets(spark):
    rng = random.Random(8)
    rows = [(i, rng.randrange(0, 40), None if i % 7 == 0 else f"s{i % 3}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, size long, source string")
    got = mixing.pareto_mix(df).collect()
    assert len(got) == 600
    by = {}
    for r in got:
        x = by.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        x[0] += r["copies"] * r["size"]
        x[1] += r["size"]
        assert 0 <= r["copies"] <= 3
    for taken, size, target, source_size in by.values():
        assert size == source_size and abs(taken - target) <= 20 and target <= 3 * size + 1e-6
    assert sum(v[2] for v in by.values()) == pytest.approx(sum(n for _, n, _ in rows))
    again = mixing.pareto_mix(df.repartition(7)).collect()
    assert {(r["doc_id"], r["copies"]) for r in again} == {(r["doc_id"], r["copies"]) for r in got}


def test_unequal_inclusion(spark):
    df = spark.createDataFrame([(i, 10, "s", 1.0 if i % 2 else 3.0) for i in range(2000)], "doc_id long, size long, source string, w double")
    got = mixing.pareto_mix(df, share_of_all=0.3, weight_col="w").collect()
    heavy, light = (sum(r["copies"] for r in got if r["doc_id"] % 2 == k) for k in (0, 1))
    assert heavy + light == pytest.approx(600, abs=1) and heavy / light == pytest.approx(3, rel=0.15)


def test_mixed_rows_repeat_whole(spark):
    df = docs(spark, [prose(random.Random(i), 10 + i) for i in range(30)] + [None, ""])
    out = mixing.mix_documents(df)
    assert out.columns == df.columns and out.where("text is null or text = ''").count() == 0
    assert out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    assert mixing.mix_documents(df.limit(0)).count() == 0


def test_mixing_of_repeated_rows_nulls_and_clashing_names(spark):
    rows = [(7, "one two three four", "a")] * 3 + [(7, "other text here", "a"), (None, "no id at all", "b"), (None, "no id at all", "b"), (8, None, "b"), (9, "x " * 50, None)]
    names = ["_p", "_q", "key_id", "copies", "target", "src"]
    df = spark.createDataFrame([(*r, *(f"{r[0]}" for _ in names)) for r in rows], "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    got = {(r["doc_id"], r["text"]): r["count"] for r in out.groupBy("doc_id", "text").count().collect()}
    assert got.get((7, "one two three four"), 0) in (0, 3, 6, 9) and got.get((None, "no id at all"), 0) in (0, 2, 4, 6)
    assert all(r[n] == f"{r['doc_id']}" for r in out.collect() for n in names)


def test_quality_keeps_columns_and_confirms_windows(spark):
    df = docs(spark, ["a b c d a b c", None, "", "w " * 300_000]).withColumns({"words": F.lit(1), "windows": F.lit(2), "_words": F.lit(3)})
    got = quality.measures(df).orderBy("doc_id").collect()
    assert [r["n_repeat_words"] for r in got] == [6, 0, 0, 300_000] and all((r["words"], r["windows"], r["_words"]) == (1, 2, 3) for r in got)
    assert quality.judge(quality.measures(df.limit(0))).count() == 0


def test_packing_of_rows_without_id_and_ties(spark):
    df = spark.createDataFrame([(None, 5)] * 50 + [(3, 5), (3, 5), (1, 5), (None, None)], "doc_id long, length long")
    got = packing.pack(df, shard_rows=10).collect()
    assert sum(r["n_docs"] for r in got) == 54 and sorted(i for r in got for i in r["doc_ids"]) == [1, 3, 3] and sum(r["tokens"] for r in got) == 265


# ---------------------------------------------------------------- queries and pipeline


@has_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, expected = queries.QUERIES[name](spark, SF).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    plain = lambda df: sorted(repr([None if v is None or v != v else v if isinstance(v, str) else round(float(v), 6) for v in r]) for r in df[columns].astype(object).itertuples(index=False))
    assert plain(got) == plain(expected)


def test_stages_handle_edges(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(44)
    passage = prose(rng, 70, 9000)
    rows = [(i, prose(rng, 40, 9000) + " " + passage + " " + prose(rng, 40, 9000), "en", f"s{i % 2}", 9) for i in range(6)]
    rows += [(6, rows[0][1], "en", "s0", 9), (7, rows[1][1], None, None, None), (8, None, "en", "s0", 0), (None, "no id", "en", "s1", 5), (None, None, None, None, None), (9, "", "en", "s1", 0), (9, "", "en", "s1", 0), (10, prose(rng, 250_000, 10**6), "en", "s1", 1)]
    extra = ["_gone", "_id", "_text", "_p", "copies", "spans", "key_id", "doc", "part"]
    df = spark.createDataFrame([(*r, *(["v"] * len(extra))) for r in rows], DOCS + "".join(f", {c} string" for c in extra))
    spark.createDataFrame([(0, 1, 0), (1, 0, None), (2, None, 5), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs_ in (df, df.limit(0)):
        now = docs_
        for name, stage in corpus_pipeline.STAGES:
            now = common.cut(stage(spark, now, str(tmp_path)))
            assert name == "packing" or now.columns == df.columns
        held = sorted({i for r in now.collect() for i in r["doc_ids"]})
        assert held == ([] if docs_ is not df else held) and set(held) <= set(range(11)) and 6 not in held and 7 not in held
        if docs_ is df:
            assert 0 in held and 10 in held


@has_tables
def test_pipeline(spark):
    import corpus_pipeline

    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "substring_dedup", "mixing", "packing"]
    packs = corpus_pipeline.run(spark, SF)
    source = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    seen = [i for r in packs.collect() for i in r["doc_ids"]]
    assert set(seen) <= source and len(seen) >= 100
    kept = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = kept.columns
        kept = common.cut(stage(spark, kept, SF))
        assert kept.columns == columns


def test_language_sample_is_the_same_beyond_the_broadcast_bound(spark, monkeypatch):
    from tessera.llm import language_id

    rows = spark.createDataFrame([(i, "word " * (i % 7 + 1), f"l{i % 3}" if i % 11 else None) for i in range(300)], "doc_id long, text string, lang string")
    sample = lambda: sorted(map(tuple, language_id.training_sample(rows, chars=400).collect()))
    joined = sample()
    monkeypatch.setattr(language_id, "BROADCAST_LANGUAGES", 0)
    assert joined and sample() == joined
