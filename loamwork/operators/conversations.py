"""Conversations as text: one line or block per turn, in the order of the turn numbers, which may have gaps.

The lines are rows, so a conversation of any length is never gathered; sorted and joined they are its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def conversation_history(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, line): the role in capitals and the text; no shuffle."""
    return turns.select(conv, turn, F.concat(F.upper(role), F.lit(": "), text).alias("line"))


def _trim_breaks(c: Column, left: bool = True, right: bool = True) -> Column:
    out = F.regexp_replace(c, r"^\n+", "") if left else c
    return F.regexp_replace(out, r"\n+\z", "") if right else out


def tool_calls(df: DataFrame, calls: str, answer: Column) -> Column:
    """Text of the calls behind an answer; nothing without calls.

    ``calls`` is an array of (name, arguments); arguments are JSON text, or a map or struct that becomes JSON.
    """
    arguments = df.schema[calls].dataType.elementType["arguments"].dataType

    def call(c: Column, i: Column) -> Column:
        given = c["arguments"] if isinstance(arguments, StringType) else F.to_json(c["arguments"])
        gap = F.when((i > 0) | (answer != ""), "\n").otherwise("")
        return F.concat(gap, F.lit('<tool_call>\n{"name": "'), c["name"], F.lit('", "arguments": '), F.coalesce(given, F.lit("{}")), F.lit("}\n</tool_call>"))

    return F.coalesce(F.array_join(F.transform(F.col(calls), call), ""), F.lit(""))


def render_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str, calls: str | None = None) -> DataFrame:
    """(conv, turn, rendered): every turn between its role tags; an assistant's tool calls (see ``tool_calls``) follow its text.

    A reasoning block is kept only behind the last user question. Runs of tool turns share one
    user block. Neighbours and ends come from windows over one shuffle by conversation.
    """
    r, t, content = F.col(role), F.col(turn), F.col(text)
    question = (r == "user") & ~(content.startswith("<tool_response>") & content.endswith("</tool_response>"))
    whole, ordered = Window.partitionBy(conv), Window.partitionBy(conv).orderBy(turn)
    placed = turns.select(conv, turn, role, text, *([calls] if calls else [])).withColumns({
        "_before": F.lag(r).over(ordered), "_after": F.lead(r).over(ordered),
        "_last": F.max(turn).over(whole), "_query": F.max(F.when(question, t)).over(whole),
    })

    thinks = content.contains("</think>")
    told = _trim_breaks(F.substring_index(content, "</think>", 1), left=False)
    reasoning = F.when(thinks, _trim_breaks(F.substring_index(told, "<think>", -1), right=False)).otherwise("")
    answer = F.when(thinks, _trim_breaks(F.substring_index(content, "</think>", -1), right=False)).otherwise(content)
    called = tool_calls(turns, calls, answer) if calls else F.lit("")
    recent = t > F.coalesce("_query", "_last")
    # fixed values: tags of the chat format
    start, end = "<|im_start|>", "<|im_end|>\n"
    plain = F.concat(F.lit(start), r, F.lit("\n"), content, F.lit(end))
    thought = F.concat(
        F.lit(start + "assistant\n<think>\n"), _trim_breaks(reasoning), F.lit("\n</think>\n\n"), _trim_breaks(answer, right=False), called, F.lit(end)
    )
    spoken = F.concat(F.lit(start + "assistant\n"), answer, called, F.lit(end))
    assistant = F.when(recent & ((t == F.col("_last")) | (reasoning != "")), thought).otherwise(spoken)
    tool = F.concat(
        F.when(F.coalesce(F.col("_before") == "tool", F.lit(False)), "").otherwise(start + "user"),
        F.lit("\n<tool_response>\n"), content, F.lit("\n</tool_response>"),
        F.when(F.coalesce(F.col("_after") == "tool", F.lit(False)), "").otherwise(end),
    )
    rendered = F.when(r == "assistant", assistant).when(r == "tool", tool).otherwise(plain)
    return placed.select(conv, turn, rendered.alias("rendered"))
