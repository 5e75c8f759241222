"""Quality rules: a threshold table compiled into Spark projections.

Measures of length, symbols, stop words, repeats and lines are Spark expressions over the text
alone (no user functions, no shuffle).  A rule is (name, measure expression, low, high); a document is
kept if it doesn't fail the base rules and every measure lies within its bounds.

Null and empty texts have no words; all counts are 0 and they fail.  Rows that repeat are
judged each.  Very long texts take memory in proportion to their length only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

#: Frequent function words of the four corpus languages; running text has some of them.
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "it", "for", "le", "la", "de", "et", "les", "des", "un", "une", "que", "der", "die", "das", "und", "den", "von", "zu", "mit", "el", "los", "las", "y", "en", "es", "por", "con", "para")


class Rule(NamedTuple):
    name: str
    measure: str
    low: float | None
    high: float | None


#: Ratios a document has to stay within.
RULES = (
    Rule("mean_word_chars", "word_chars / n_words", 1.5, 20.0),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.3),
    Rule("stop_word_share", "n_stop_words / n_words", 0.01, None),
    Rule("duplicate_line_share", "n_dup_lines / n_lines", None, 0.6),
    Rule("shout_share", "n_shouts / n_words", None, 0.5),
)

LINE_WITH_WORD = r"[^\x20\x09-\x0D]"


def _covered(windows: Column, words: Column) -> Column:
    """Words inside windows (of three) found twice or more; windows: 64-bit hashes by position.

    The upper half of a hash and the position are packed into one long, so that a primitive sort brings equal windows
    together.  It only chooses candidates: those go on to a sort by their words, and windows are equal if the words are.
    """
    low = (1 << 32) - 1
    rows = F.sort_array(F.transform(windows, lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))

    def bind(value: Column, use) -> Column:
        """use(value) with the value computed once."""
        return F.element_at(F.transform(F.array(value), use), 1)

    def total(places: Column) -> Column:
        start = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3).cast("long"), i - acc["last"])).alias("n"))
        return F.aggregate(F.array_sort(places), start, step, lambda acc: acc["n"])

    def twice(r: Column, equal) -> Column:
        """Items of a sorted array that are equal to the one before or after."""
        like = lambda x, j: F.coalesce(equal(x, F.get(r, j)), F.lit(False))
        return F.filter(r, lambda x, j: like(x, j + 1) | like(x, j - 1))

    def confirmed(candidates: Column) -> Column:
        word = lambda x, k: F.get(words, x.bitwiseAND(F.lit(low)).cast("int") + k)
        spelled = F.sort_array(F.transform(candidates, lambda x: F.struct(word(x, 0).alias("a"), word(x, 1).alias("b"), word(x, 2).alias("c"), x.bitwiseAND(F.lit(low)).alias("i"))))
        equal = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
        return bind(spelled, lambda r: total(F.transform(twice(r, equal), lambda x: x["i"])))

    candidates = bind(rows, lambda r: twice(r, lambda x, y: x.bitwiseXOR(y).between(0, low)))
    return bind(candidates, lambda c: F.when(F.size(c) > 0, confirmed(c)).otherwise(0))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the measures as further long columns (existing columns of those names are replaced; all others stay)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_shouts"]
    df = docs.drop(*[c for c in docs.columns if c in names and c != text_col])
    words, lines, hashes, stops, windows = common.free([*df.columns, *names], "words", "lines", "hashes", "stops", "windows")
    df = df.withColumns({words: F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""), lines: F.filter(F.split(text, "\n"), lambda x: x.rlike(LINE_WITH_WORD))})
    stop = [f(w) for w in STOP_WORDS for f in (str.lower, str.capitalize, str.upper)]
    df = df.withColumns({hashes: F.transform(words, lambda w: F.xxhash64(w)), stops: F.filter(words, lambda w: w.isin(stop))})
    tail = lambda k: F.slice(hashes, k + 1, F.size(hashes))
    triples = F.transform(F.slice(F.arrays_zip(F.col(hashes), tail(1), tail(2)), 1, F.greatest(F.size(hashes) - 2, F.lit(0))), lambda z: F.xxhash64(z))
    df = df.withColumns(
        {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_stop_words": F.size(stops),
            "n_shouts": ((F.length(text) - F.length(F.replace(text, F.lit("!!"), F.lit("")))) / 2).cast("long"),
            windows: triples,
        }
    )
    df = df.withColumn("n_repeat_words", F.when(F.size(windows) > 1, _covered(F.col(windows), F.col(words))).otherwise(0))
    return df.withColumns({n: F.col(n).cast("long") for n in names}).drop(words, lines, hashes, stops, windows)


def judge(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds base_failed, failed_rules (array of names) and kept."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    failed = []
    for rule in rules:
        value = F.expr(f"try_divide({rule.measure.replace(' / ', ', ')})")
        out = F.lit(False)
        if rule.low is not None:
            out = out | F.coalesce(value < rule.low, F.lit(True))
        if rule.high is not None:
            out = out | F.coalesce(value > rule.high, F.lit(False))
        failed.append(F.when(out, F.lit(rule.name)))
    df = measured.withColumns({"base_failed": base, "failed_rules": F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")})
    return df.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(measures(docs)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_STOP = ", ".join(f"'{f(w)}'" for w in STOP_WORDS for f in (str.lower, str.capitalize, str.upper))
OP6_SQL = rf"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), wins AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS c
  FROM (SELECT rid, i, words[i] || chr(1) || words[i + 1] || chr(1) || words[i + 2] AS w FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM base WHERE len(words) >= 3))
), repeats AS (
  SELECT rid, count(DISTINCT p)::BIGINT AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM wins WHERE c > 1) GROUP BY rid
), m AS (
  SELECT base.rid, doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
    len(list_filter(words, lambda w: list_contains([{_STOP}], w)))::BIGINT AS n_stop_words,
    ((length(text) - length(replace(text, '!!', ''))) // 2)::BIGINT AS n_shouts
  FROM base LEFT JOIN repeats ON base.rid = repeats.rid
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 1.5 AND 20.0 AND n_symbols / n_words <= 0.3 AND n_stop_words / n_words >= 0.01
    AND n_dup_lines / n_lines <= 0.6 AND n_shouts / n_words <= 0.5 AS kept
FROM judged
"""
