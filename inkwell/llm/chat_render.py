"""Chat formatting: a template is a black box; its turns are located by rendering prefixes.

The renderer is called with the first one, two, ... turns. What a further turn adds at the end
is its span. When an earlier output is no prefix of the next, the template rewrites history.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.llm.common import batch_rows, to_batch

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# A character of Unicode's private use area stands for a text while its place is sought.
PROBE = "\ue000"
_SPECIAL = re.compile(r"[\\#<:\n]")
_TEXT_SPECIAL = re.compile(r"[\\#<]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(
    r"### ([^\\:\n#<]*(?:\\.[^\\:\n#<]*)*):\n([^\\#<]*(?:\\.[^\\#<]*)*)\n</turn>\n", re.DOTALL
)


def escape(text: str) -> str:
    """No control string is left: each of their first characters gets a backslash."""
    return _TEXT_SPECIAL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn_template(turns: list[Turn]) -> str:
    """The library's own template: ``### role:``, the escaped text, ``</turn>``."""
    return "".join(
        f"### {_SPECIAL.sub(r'\\\g<0>', role)}:\n{escape(text)}\n</turn>\n" for role, text in turns
    )


def parse(formatted: str) -> list[Turn]:
    """The turns of a string made by :func:`turn_template`."""
    turns, at = [], 0
    while at < len(formatted):
        match = _TURN.match(formatted, at)
        if match is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(match[1]), unescape(match[2])))
        at = match.end()
    return turns


@dataclass(frozen=True)
class Rendered:
    """A formatted conversation; per turn its span and its text's span, by code point.

    ``rewritten``: turns whose rendering changed what stood before. Their spans begin at the
    first character that differs. A text whose place the template hides has an empty span.
    """

    text: str
    spans: list[tuple[int, int]]
    text_spans: list[tuple[int, int]]
    rewritten: list[int]


def common_prefix(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def render_incrementally(turns: list[Turn], template: Template) -> Rendered:
    spans, text_spans, rewritten, before = [], [], [], ""
    for i in range(len(turns)):
        now = template(turns[: i + 1])
        start = len(before)
        if not now.startswith(before):
            rewritten.append(i)
            start = common_prefix(before, now)
        spans.append((start, len(now)))
        probe = template([*turns[:i], (turns[i][0], PROBE)])
        head = probe.rfind(PROBE)
        tail = len(probe) - head - 1
        found = head >= start and len(now) - tail >= head and now[:head] == probe[:head]
        text_spans.append((head, len(now) - tail) if found else (start, start))
        before = now
    return Rendered(before, spans, text_spans, rewritten)


RESULT = pa.schema(
    [
        ("n_turns", pa.int64()),
        ("formatted", pa.string()),
        ("turn_spans", pa.string()),
        ("loss_spans", pa.string()),
        ("rewritten_turns", pa.int64()),
    ]
)


def format_conversations(
    rows: DataFrame, template: Template = turn_template, trained_role: str = "assistant"
) -> DataFrame:
    """One row per conversation: formatted text, spans of the turns, spans under the loss mask.

    Spans are text like ``0:12,12:30``. Turns go by ``turn`` (nulls first), then role and text,
    so repeated and tied rows keep a fixed order. A null text or role is empty. Rows without a
    conv_id form one conversation. Other columns of ``rows`` do not matter. A template that
    rewrites history shows in ``rewritten_turns``; its loss spans count in the final text only
    when the later turns left them in place.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    grouped = grouped.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"]).alias("roles"),
        F.transform("turns", lambda t: t["text"]).alias("texts"),
    )

    def one(roles: list[str], texts: list[str]) -> tuple:
        turns = list(zip(roles, texts, strict=True))
        done = render_incrementally(turns, template)
        stable = min(
            (done.spans[i][0] for i in done.rewritten), default=len(done.text)
        )
        loss = [
            span
            for (role, _), span in zip(turns, done.text_spans, strict=True)
            if role == trained_role and (not done.rewritten or span[1] <= stable)
        ]
        show = lambda spans: ",".join(f"{a}:{b}" for a, b in spans)
        return len(turns), done.text, show(done.spans), show(loss), len(done.rewritten)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batch_rows(whole):
                made = [
                    one(r, t)
                    for r, t in zip(
                        batch.column("roles").to_pylist(), batch.column("texts").to_pylist(), strict=True
                    )
                ]
                out = to_batch(RESULT, zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv_id"), *out.columns], names=["conv_id", *RESULT.names]
                )

    schema = T.StructType([grouped.schema["conv_id"]])
    for field in RESULT:
        schema = schema.add(field.name, "string" if pa.types.is_string(field.type) else "long")
    return grouped.mapInArrow(run, schema)


DIGEST = pa.schema(
    [
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def digests(formatted: DataFrame) -> DataFrame:
    """Hashes of the turns and of the text under the loss mask, read back from the output."""

    def one(text: str, loss_spans: str) -> tuple:
        turns = "".join(f"{role}\n{said}\n" for role, said in parse(text))
        spans = [map(int, s.split(":")) for s in loss_spans.split(",") if s]
        loss = "".join(unescape(text[a:b]) for a, b in spans)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        return sha(turns), len(loss), sha(loss), len(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batch_rows(whole):
                made = [
                    one(t, s)
                    for t, s in zip(
                        batch.column("formatted").to_pylist(),
                        batch.column("loss_spans").to_pylist(),
                        strict=True,
                    )
                ]
                out = to_batch(DIGEST, zip(*made, strict=True))
                kept = ["conv_id", "n_turns", "rewritten_turns"]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in kept] + out.columns, names=kept + DIGEST.names
                )

    schema = T.StructType([formatted.schema[c] for c in ("conv_id", "n_turns", "rewritten_turns")])
    for field in DIGEST:
        schema = schema.add(field.name, "string" if pa.types.is_string(field.type) else "long")
    return formatted.select("conv_id", "n_turns", "rewritten_turns", "formatted", "loss_spans").mapInArrow(
        run, schema
    )
