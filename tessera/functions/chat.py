"""Functions on conversations: array<struct<role: string, content: string>>."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructType

from tessera.functions.text import blank_to, canonical, token_count

MESSAGES = "array<struct<role:string,content:string>>"
SHAREGPT_ROLES = {"human": "user", "user": "user", "gpt": "assistant", "assistant": "assistant", "system": "system"}
CHATML_ROLES = SHAREGPT_ROLES | {"tool": "tool", "tool_call": "tool_call", "function_call": "tool_call", "tool_response": "tool", "observation": "tool"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def two_turns(user: Column | str, assistant: Column | str) -> Column:
    """A user turn and an assistant turn."""
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), _col(text).alias("content"))
    return F.array(turn("user", user), turn("assistant", assistant))


def contents(messages: Column | str) -> Column:
    return F.transform(_col(messages), lambda m: m["content"])


def assistant_text(messages: Column | str) -> Column:
    """Contents of the assistant's turns, a line each."""
    return F.array_join(F.transform(F.filter(_col(messages), lambda m: m["role"] == "assistant"), lambda m: m["content"]), "\n")


def message_digest(messages: Column | str) -> Column:
    """Identity of a conversation: roles and canonical contents."""
    return F.md5(F.array_join(F.transform(_col(messages), lambda m: F.concat(m["role"], F.lit("\x1f"), canonical(m["content"]))), "\x1e"))


def rename_roles(messages: Column | str, names: Mapping[str, str] = SHAREGPT_ROLES, strict: bool = True) -> Column:
    """from/value turns (fields ``from`` and ``value``) -> role/content; an unknown role raises, or its turn goes if not strict."""
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    known = F.filter(_col(messages), lambda m: F.array_contains(F.map_keys(table), m["from"]))
    turns = _col(messages) if strict else known

    def turn(m: Column) -> Column:
        role = F.try_element_at(table, m["from"])
        role = F.coalesce(role, F.raise_error(F.concat(F.lit("unsupported role: "), F.coalesce(m["from"], F.lit("null")))).cast("string")) if strict else role
        return F.struct(role.alias("role"), m["value"].alias("content"))

    return F.transform(turns, turn)


def normal_reason(messages: Column | str, lang: Column | str, task: Column | str, source: Column | str) -> Column:
    """Why a record is rejected (first reason that holds), or null."""
    m = _col(messages)
    empty = F.exists(m, lambda x: F.coalesce(F.trim(x["content"]), F.lit("")) == "")
    no_role = F.exists(m, lambda x: F.coalesce(F.trim(x["role"]), F.lit("")) == "")
    bad = m.isNull() | (F.size(m) == 0) | no_role
    provenance = F.greatest(*[blank_to(c, None).isNull() for c in (lang, task, source)])
    return (
        F.when(F.coalesce(bad, F.lit(True)), "malformed_messages")
        .when(empty, "empty_content")
        .when(~F.exists(m, lambda x: x["role"] == "assistant"), "missing_assistant")
        .when(provenance, "missing_provenance")
    )


def trimmed(messages: Column | str) -> Column:
    return F.transform(_col(messages), lambda m: F.struct(F.trim(m["role"]).alias("role"), F.trim(m["content"]).alias("content")))


def trim_tail(messages: Column | str) -> Column:
    """Without the assistant turns at the end; null if no user turn is left."""
    m = _col(messages)
    last = F.array_max(F.transform(m, lambda x, i: F.when(x["role"] != "assistant", i + 1).otherwise(0)))
    cut = F.slice(m, 1, F.greatest(F.coalesce(last, F.lit(0)), F.lit(0)))
    return F.when(F.exists(cut, lambda x: x["role"] == "user"), cut)


def last_assistant(messages: Column | str) -> Column:
    """Content of the last assistant turn, null if there is none."""
    return F.try_element_at(F.filter(_col(messages), lambda m: m["role"] == "assistant"), F.lit(-1))["content"]


def truncate_history(messages: Column | str, limit: int) -> Column:
    """Drops the oldest exchanges (each starts at a user turn) until the token count fits; leading system turns and the last exchange stay."""
    m = _col(messages)
    system = F.filter(m, lambda x, i: (x["role"] == "system") & (i == 0))
    rest = F.filter(m, lambda x, i: ~((x["role"] == "system") & (i == 0)))
    size = lambda turns: F.aggregate(turns, F.lit(0).cast("long"), lambda acc, x: acc + token_count(x["content"]))
    starts = F.filter(F.transform(rest, lambda x, i: F.when(x["role"] == "user", i + 1)), lambda i: i.isNotNull())
    fits = F.filter(starts, lambda s: size(system) + size(F.slice(rest, s, F.size(rest))) <= limit)
    start = F.coalesce(F.array_min(fits), F.array_max(starts), F.lit(1))
    whole = size(m) <= limit
    return F.when(whole | (F.size(rest) == 0), m).otherwise(F.concat(system, F.slice(rest, start, F.size(rest))))


def inserted_calls(messages: Column | str) -> Column:
    """Runs of equal roles: array<struct<role, turns, content>> with the contents of a run joined by newlines."""
    start = F.array().cast("array<struct<role:string,turns:int,content:string>>")

    def step(acc: Column, m: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.struct(m["role"].alias("role"), (last["turns"] + 1).alias("turns"), F.concat_ws("\n", last["content"], m["content"]).alias("content"))
        fresh = F.struct(m["role"].alias("role"), F.lit(1).alias("turns"), m["content"].alias("content"))
        same = (F.size(acc) > 0) & (last["role"] == m["role"])
        return F.when(same, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(fresh)))

    return F.aggregate(_col(messages), start, step)


def strip_thinking(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(text), r"(?s)<think>.*?</think>", ""))


def split_thinking(text: Column | str) -> tuple[Column, Column]:
    """(thinking, answer): what stands before and after the first </think>, tags removed."""
    parts = F.split(_col(text), "</think>", 2)
    has = F.size(parts) > 1
    clean = lambda x: F.trim(F.regexp_replace(x, "</?think>", ""))
    return F.when(has, clean(parts[0])).otherwise(F.lit("")), clean(F.when(has, F.get(parts, F.lit(1))).otherwise(parts[0]))


# ------------------------------------------------------------ tool calls (Python, on Arrow batches)


def balanced_objects(text: str) -> list[str]:
    """Top-level {...} and [...] spans, aware of strings."""
    out, depth, start, quoted, escaped = [], 0, 0, False, False
    for i, c in enumerate(text):
        if quoted:
            escaped, quoted = (not escaped and c == "\\"), not (c == '"' and not escaped)
        elif c == '"' and depth:
            quoted = True
        elif c in "{[":
            if not depth:
                start = i
            depth += 1
        elif c in "}]" and depth:
            depth -= 1
            if not depth:
                out.append(text[start : i + 1])
    return out


def _calls_of(value: object, raw: str) -> list[tuple[str | None, str, bool]]:
    if isinstance(value, list):
        return [c for v in value for c in _calls_of(v, raw)]
    if not isinstance(value, dict):
        return []
    if isinstance(value.get("function"), dict):
        value = value["function"]
    if not isinstance(value.get("name"), str):
        return []
    args = value.get("arguments", value.get("parameters", {}))
    if isinstance(args, str):
        try:
            args = json.loads(args)
        except ValueError:
            return [(value["name"], args, False)]
    return [(value["name"], json.dumps(args, ensure_ascii=False, sort_keys=True), isinstance(args, dict))]


def parse_tool_calls(text: str | None) -> list[tuple[str | None, str, bool]]:
    """(name, arguments as JSON, valid) of each call in generated text.

    Formats in turn, the first that finds any wins: channel headers, <tool_call> tags, the python tag, a
    bracketed list after a marker, then any balanced JSON with a name.  Broken JSON in a tag is kept as an invalid call.
    """
    import re

    text = text or ""
    found: list[tuple[str | None, str, bool]] = []
    for name, body in re.findall(r"to=functions\.([\w.-]+).*?<\|message\|>(.*?)(?:<\|call\|>|<\|end\|>|\Z)", text, re.S):
        try:
            found.append((name, json.dumps(json.loads(body), ensure_ascii=False, sort_keys=True), True))
        except ValueError:
            found.append((name, body.strip(), False))
    if found:
        return found
    for body in re.findall(r"<tool_call>(.*?)(?:</tool_call>|\Z)", text, re.S):
        try:
            found += _calls_of(json.loads(body), body)
        except ValueError:
            found.append((None, body.strip(), False))
    if found:
        return found
    for marker in ("<|python_tag|>", "[TOOL_CALLS]"):
        if marker in text:
            for span in balanced_objects(text.split(marker, 1)[1]):
                try:
                    found += _calls_of(json.loads(span), span)
                except ValueError:
                    found.append((None, span, False))
            if found:
                return found
    for span in balanced_objects(text):
        try:
            found += _calls_of(json.loads(span), span)
        except ValueError:
            continue
    return found


@F.pandas_udf(ArrayType(StructType().add("name", StringType()).add("arguments", StringType()).add("valid", BooleanType())))
def tool_calls_udf(text):
    import pandas as pd

    return pd.Series([[dict(zip(("name", "arguments", "valid"), c, strict=True)) for c in parse_tool_calls(t)] for t in text])


def json_to_tags(value: object) -> str:
    """Nested <s_key>..</s_key> text of a JSON value; keys in reverse order, lists joined by <sep/>."""
    if isinstance(value, dict):
        return "".join(f"<s_{k}>{json_to_tags(value[k])}</s_{k}>" for k in sorted(value, reverse=True))
    if isinstance(value, list):
        return "<sep/>".join(map(json_to_tags, value))
    return str(value)
