"""Adapters: raw rows of any source -> {messages, lang, task, source, ...}.

An adapter is data (which columns, which prompt, which maps), not code per source: ``adapt`` covers instruction, question,
label, title and translation rows; the others handle spans, alternating lines, two-column files and wide translations.
Rows whose turns are empty after trimming go.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.chat import two_turns
from tessera.functions.text import canonical, user_text


def _lookup(value: Column, table: Mapping[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), value) if table else value


def record(df: DataFrame, user: Column, assistant: Column, lang: Column, task: str, source: str, **extra: Column) -> DataFrame:
    """Two trimmed turns and provenance; rows with an empty turn or language go."""
    rows = df.select(F.trim(user).alias("_u"), F.trim(assistant).alias("_a"), lang.alias("lang"), F.lit(task).alias("task"), F.lit(source).alias("source"), *[c.alias(n) for n, c in extra.items()])
    rows = rows.where("_u <> '' and _a <> '' and lang is not null")
    return rows.select(two_turns("_u", "_a").alias("messages"), "lang", "task", "source", *extra)


def adapt(
    df: DataFrame, task: str, source: str, user: Sequence[str], assistant: Sequence[str], lang: str | None = None, languages: Mapping[str, str] | None = None, only: str | None = None,
    inputs: str | None = None, labels: Mapping[str, str] | None = None, template: str | None = None, extra: Sequence[str] = (), where: str | None = None,
) -> DataFrame:
    """One source of instruction-like rows.

    user, assistant: candidate columns, the first that is not null counts.  lang: a column mapped by ``languages`` (rows of
    other languages go), or ``only``: a fixed language.  inputs: a further column below the instruction
    (blank and literal "nan" don't count).  labels: answer values by name.  template: prompt with {user}.
    """
    df = df.where(where) if where else df
    first = lambda names: F.coalesce(*[F.col(c).cast("string") for c in names])
    ask = first(user)
    if inputs:
        ask = user_text(ask, F.when(F.lower(F.trim(F.col(inputs))) == "nan", None).otherwise(F.col(inputs)))
    if template:
        before, _, after = template.partition("{user}")
        ask = F.concat(F.lit(before), ask, F.lit(after))
    answer = first(assistant)
    answer = _lookup(answer, labels) if labels else answer
    language = F.lit(only) if only else _lookup(F.col(lang), languages or {})
    return record(df, ask, answer, language, task, source, **{c: F.col(c) for c in extra})


def translations(df: DataFrame, source: str, pairs: Sequence[tuple[str, str, str, str]], prompt: str = "Translate from {a} to {b}:\n{text}", both_ways: bool = True) -> DataFrame:
    """pairs: (language a, column a, language b, column b) -> forward rows and, with both_ways, reverse rows.

    A forward row whose sides are equal in canonical form is a copy and goes; the reverse row isn't checked.
    """
    sides = []
    for a, x, b, y in pairs:
        for k, (la, ca, lb, cb) in enumerate([(a, x, b, y), (b, y, a, x)][: 2 if both_ways else 1]):
            head, _, tail = prompt.replace("{a}", la).replace("{b}", lb).partition("{text}")
            copied = canonical(F.col(ca)) == canonical(F.col(cb)) if k == 0 else F.lit(False)
            sides.append(F.struct(F.concat(F.lit(head), F.trim(F.col(ca)), F.lit(tail)).alias("u"), F.trim(F.col(cb)).alias("a"), F.lit(lb).alias("lang"), F.lit(f"{la}-{lb}").alias("direction"), (F.coalesce(copied, F.lit(True)) | (F.trim(F.col(ca)) == "")).alias("skip")))
    rows = df.select(F.inline(F.array(*sides))).where("not skip")
    return record(rows, F.col("u"), F.col("a"), F.col("lang"), "translation", source, direction=F.col("direction"))


def unpivot_languages(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Wide rows (a column a language) -> (key, lang, text); blanks go."""
    cells = F.array(*[F.struct(F.lit(lang).alias("lang"), F.col(c).cast("string").alias("text")) for lang, c in columns.items()])
    return df.select(key, F.inline(cells)).where(F.trim("text") != "")


def char_spans(df: DataFrame, text: str, spans: str, source: str, lang: str, prompt: str = "List the named entities:\n") -> DataFrame:
    """Rows with spans as array<struct<start, end, label>> -> answer {"type": ..., "text": ...} JSON and sorted entity types.

    Spans outside 0 <= start < end <= length go.
    """
    ok = F.filter(F.col(spans), lambda s: (s["start"] >= 0) & (s["start"] < s["end"]) & (s["end"] <= F.length(F.col(text))))
    found = F.transform(ok, lambda s: F.struct(s["label"].alias("type"), F.substring(F.col(text), s["start"] + 1, s["end"] - s["start"]).alias("text")))
    rows = df.withColumns({"_answer": F.to_json(found), "_types": F.array_sort(F.array_distinct(F.transform(ok, lambda s: s["label"])))})
    return record(rows, F.concat(F.lit(prompt), F.col(text)), F.col("_answer"), F.lit(lang), "ner", source, entity_types=F.col("_types"))


def line_pairs(files: DataFrame, source: str, lang: str, labels: Mapping[str, str], task: str = "classification") -> DataFrame:
    """Whole files (value) of alternating text and label lines."""
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
    n = F.floor(F.size(lines) / 2).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.struct(F.get(lines, 2 * i).alias("u"), F.get(lines, 2 * i + 1).alias("a")))
    rows = files.where(n > 0).select(F.inline(pair))
    return record(rows, F.col("u"), _lookup(F.trim(F.col("a")), labels), F.lit(lang), task, source)


def two_columns(lines: DataFrame, a: str, b: str) -> DataFrame:
    """Tab-separated lines (value) with at least two cells -> columns a and b."""
    cells = F.split("value", "\t")
    return lines.where(F.size(cells) >= 2).select(cells[0].alias(a), cells[1].alias(b))


def markup_turns(df: DataFrame, text: str) -> DataFrame:
    """First user and model turn of chat-markup text as columns user and model."""
    return df.withColumns({"user": F.regexp_extract(text, r"(?s)<start_of_turn>user\n?(.*?)<end_of_turn>", 1), "model": F.regexp_extract(text, r"(?s)<start_of_turn>model\n?(.*?)<end_of_turn>", 1)})
