"""Conversations as training texts, with the spans on which the loss counts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import column
from .templates import Template

#: Turns between control strings. A text's own control strings are escaped.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ANSWER]", "[ROLE]", "[TEXT]", "[/TEXT]")
TEMPLATE = """
{%- for message in messages -%}
  {%- if message.role == 'user' -%} <s>[INST]{{ ' ' ~ (message.text | escape) ~ ' ' }}[/INST]
  {%- elif message.role == 'assistant' -%} [ANSWER]{% generation %}{{ message.text | escape }}{% endgeneration %}</s>
  {%- elif message.role == 'system' -%} <<SYS>>{{ message.text | escape }}<</SYS>>
  {%- else -%} [ROLE]{{ message.role | escape }}[TEXT]{{ message.text | escape }}[/TEXT]
  {%- endif -%}
{%- endfor -%}
"""
#: How a turn of that template reads.
TURN = re.compile(
    r"<s>\[INST\] (?P<user>.*?) \[/INST\]|\[ANSWER\](?P<assistant>.*?)</s>|<<SYS>>(?P<system>.*?)<</SYS>>"
    r"|\[ROLE\](?P<role>.*?)\[TEXT\](?P<text>.*?)\[/TEXT\]",
    re.S,
)
FORMATTED = "n_turns long, formatted string, loss_spans array<struct<start: long, end: long>>"


def escaper(controls: tuple[str, ...]):
    """A filter that breaks every control string with a backslash and doubles backslashes."""
    found = re.compile("|".join(re.escape(c) for c in sorted(controls, key=len, reverse=True)) + r"|\\")

    def escape(value: object) -> str:
        return found.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], "" if value is None else str(value))

    return escape


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def format_conversations(
    turns: DataFrame,
    *,
    template: str = TEMPLATE,
    controls: tuple[str, ...] = CONTROLS,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns``, ``formatted`` and ``loss_spans``.

    ``template`` sees ``messages``, a list of mappings ``role`` and ``text``, and the
    filter ``escape`` for the control strings. ``loss_spans`` are the ``[start, end)``
    code points that its generations wrote, without empty ones. Other columns are not read.

    Empty table: empty. Null texts and roles: empty. Null conversation id: one conversation.
    Turns are ordered by turn (null first), role and text; repeated rows are turns of
    their own. A conversation becomes one text and so passes through one task.
    """
    given = F.struct(
        column(turn).alias("turn"), F.coalesce(column(role).cast("string"), F.lit("")).alias("role"), F.coalesce(column(text).cast("string"), F.lit("")).alias("text")
    )
    grouped = turns.select(column(conv_id).alias("conv_id"), given.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    grouped = grouped.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    Template(template, {"escape": escaper(controls)})  # a wrong template fails here

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template, {"escape": escaper(controls)})
        for batch in batches:
            made, spans, sizes = [], [], []
            for roles, texts in zip(batch.column("roles"), batch.column("texts"), strict=True):
                messages = [{"role": r, "text": t} for r, t in zip(roles.as_py(), texts.as_py(), strict=True)]
                formatted, marked = compiled.render(messages=messages)
                made.append(formatted)
                sizes.append(len(messages))
                spans.append([{"start": a, "end": b} for a, b in marked])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(sizes, pa.int64()), pa.array(made, pa.string()), pa.array(spans, kind)], names=["conv_id", "n_turns", "formatted", "loss_spans"]
            )

    kind = grouped.schema["conv_id"].dataType.simpleString()
    return grouped.mapInArrow(render, f"conv_id {kind}, {FORMATTED}")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a conversation in the default template."""
    found, at = [], 0
    while at < len(formatted):
        match = TURN.match(formatted, at)
        if match is None:
            raise ValueError(f"no turn at {at}: {formatted[at : at + 40]!r}")
        if match["role"] is not None:
            found.append((unescape(match["role"]), unescape(match["text"])))
        else:
            found.append((match.lastgroup, unescape(match[match.lastgroup])))
        at = match.end()
    return found


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``turns`` and ``loss_text`` of formatted conversations, from their texts and spans alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, losses = [], []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True):
                turns.append([{"role": r, "text": t} for r, t in read_turns(text)])
                losses.append("".join(unescape(text[s["start"] : s["end"]]) for s in spans))
            kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(turns, kind), pa.array(losses, pa.string()), batch.column("formatted")], names=["conv_id", "turns", "loss_text", "formatted"]
            )

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(
        read, f"conv_id {kind}, turns array<struct<role: string, text: string>>, loss_text string, formatted string"
    )
