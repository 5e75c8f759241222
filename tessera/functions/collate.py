"""Batch collation as array functions: a batch is the rows of one batch id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import tokens as T


def round_up(n: Column, multiple: int) -> Column:
    return (F.ceil(n / multiple) * multiple).cast("int")


def pad_batches(rows: DataFrame, batch: str, pads: Mapping[str, int], multiple: int = 1) -> DataFrame:
    """Pads each column of ``pads`` to the longest row of its batch, rounded up; every row keeps its place."""
    longest = F.greatest(F.lit(0), *[F.max(F.size(c)).over(Window.partitionBy(batch)) for c in pads])
    rows = rows.withColumn("_n", round_up(longest, multiple))
    return rows.withColumns({c: T.pad_to(c, F.col("_n"), v) for c, v in pads.items()}).drop("_n")


def prefix_tree(prompt: Column | str, completions: Column | str) -> dict[str, Column]:
    """A prompt and its completions in one row: flat ids, labels shifted by one inside each node, positions that go on
    from the prompt in each completion, node lengths and the paths (prompt, completion) of each sample."""
    prompt, completions = (F.col(c) if isinstance(c, str) else c for c in (prompt, completions))
    n = F.size(prompt)
    spans = F.transform(completions, lambda c: F.when(F.size(c) > 0, F.sequence(n, n + F.size(c) - 1)).otherwise(F.array().cast("array<int>")))
    own_positions = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    ignore = F.array(F.lit(T.IGNORE))
    labels = F.transform(completions, lambda c: F.concat(T.shift_labels(c), ignore))
    return {
        "input_ids": F.concat(prompt, F.flatten(completions)),
        "labels": F.concat(F.array_repeat(F.lit(T.IGNORE), n), F.flatten(labels)),
        "position_ids": F.concat(own_positions, F.flatten(spans)),
        "node_lengths": F.concat(F.array(n), F.transform(completions, lambda c: F.size(c))),
        "paths": F.transform(completions, lambda c, i: F.array(F.lit(0), i + 1)),
    }


def fold_agent_turns(messages: Column | str, example: Column | str) -> Column:
    """Tool turns of a dialogue: consecutive tool_call turns become one assistant turn with numbered calls, and responses take their ids in order.

    messages: array<struct<role, content>> -> array<struct<role, content, tool_calls: array<struct<id, call>>, tool_call_id>>.
    """
    m = F.col(messages) if isinstance(messages, str) else messages
    ex = F.col(example).cast("string") if isinstance(example, str) else example.cast("string")
    call = "array<struct<id:string,call:string>>"
    turn = f"struct<role:string,content:string,tool_calls:{call},tool_call_id:string>"
    start = F.struct(F.array().cast(f"array<{turn}>").alias("out"), F.lit(0).alias("calls"), F.lit(0).alias("answered"))

    def make(role, content, calls, ident):
        return F.struct(role.alias("role"), content.alias("content"), calls.alias("tool_calls"), ident.alias("tool_call_id"))

    def step(acc: Column, x: Column) -> Column:
        out, n, a = acc["out"], acc["calls"], acc["answered"]
        last = F.try_element_at(out, F.lit(-1))
        none = F.lit(None).cast("string")
        new_call = F.array(F.struct(F.concat(F.lit("call_"), ex, F.lit("_"), n.cast("string")).alias("id"), x["content"].alias("call")))
        attach = (F.size(out) > 0) & (last["role"] == "assistant")
        grown = make(F.lit("assistant"), F.coalesce(last["content"], F.lit("")), F.concat(F.coalesce(last["tool_calls"], F.array().cast(call)), new_call), none)
        fresh = make(F.lit("assistant"), F.lit(""), new_call, none)
        called = F.struct(F.when(attach, F.concat(F.slice(out, 1, F.size(out) - 1), F.array(grown))).otherwise(F.concat(out, F.array(fresh))).alias("out"), (n + 1).alias("calls"), a.alias("answered"))
        ident = F.when(a < n, F.concat(F.lit("call_"), ex, F.lit("_"), a.cast("string"))).otherwise(F.concat(F.lit("response_"), ex, F.lit("_"), a.cast("string")))
        answer = F.struct(F.concat(out, F.array(make(F.lit("tool"), x["content"], F.array().cast(call), ident))).alias("out"), n.alias("calls"), (a + 1).alias("answered"))
        plain = F.struct(F.concat(out, F.array(make(x["role"], x["content"], F.array().cast(call), none))).alias("out"), n.alias("calls"), a.alias("answered"))
        return F.when(x["role"] == "tool_call", called).when(x["role"].isin("tool", "tool_response"), answer).otherwise(plain)

    return F.aggregate(m, start, step, lambda acc: acc["out"])
