"""Packing: token sequences of a fixed size, cut by order-preserving dynamic programming.

Documents follow each other as one stream of tokens per partition. A window may be cut at any
boundary: the end of a document (free), the end of a sentence (a small penalty) or, inside long
stretches without either, every so many tokens (a larger one). The best cost up to a boundary is

    best(j) = penalty(j) + min over i in [j - size, j) of best(i) + size - (j - i)

As padding is linear in i, the minimum is that of best(i) + i over a sliding window, kept by a
monotone queue. Windows whose length is a power of two need no padding.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.llm.common import batch_rows, text_or_empty


@dataclass(frozen=True)
class Packing:
    """size: tokens of a sequence; separator: the id after each document.

    Penalties are in tokens of padding: for a cut at a sentence end, for a cut elsewhere, and for
    each sequence (so that small ones are not preferred). grid: sentence ends closer than this to
    the one before are not tried. buffer: tokens planned at a time.
    """

    size: int = 1024
    separator: int = 0
    sentence_penalty: float = 1.0
    inner_penalty: float = 24.0
    sequence_penalty: float = 4.0
    grid: int = 16
    buffer: int = 1 << 20


def cuts(places: list[int], penalties: list[float], size: int, per_sequence: float) -> list[int]:
    """Indexes into ``places`` where windows end, with the least padding and penalties.

    ``places`` rise from the start of the stream (0, not itself a cut) to its end, with steps of at
    most ``size``.
    """
    powers = [1 << k for k in range(size.bit_length()) if 1 << k < size]
    at = {0: 0}
    best, back = [0.0], [0]
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # best(i) + i, place, index
    for j in range(1, len(places)):
        place = places[j]
        while queue[0][1] < place - size:
            queue.popleft()
        key, _, source = queue[0]
        cost = key + size - place
        for power in powers:
            i = at.get(place - power)
            if i is not None and best[i] < cost:
                cost, source = best[i], i
        cost += penalties[j] + per_sequence
        best.append(cost)
        back.append(source)
        at[place] = j
        key = cost + place
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, place, j))
    found, j = [], len(places) - 1
    while j:
        found.append(j)
        j = back[j]
    return found[::-1]


class Tokens:
    """Token ids of texts, by the tokenizer file.

    A byte-level vocabulary also comes as ranks for a second library, which gives the same ids
    several times faster; texts with a special token's string go by the file itself.
    """

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks and pattern:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")

    def sentence_ends(self) -> np.ndarray:
        """By id: whether the token ends in a full stop, another sentence mark or a line break."""
        size = self.full.get_vocab_size()
        ends = np.zeros(size + 1, bool)
        for i in range(size):
            shown = (self.full.id_to_token(i) or "").rstrip("Ġ")
            ends[i] = shown.endswith((".", "!", "?", "Ċ"))
        return ends


PIECES = pa.schema(
    [
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("padding", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


class _Stream:
    """The tokens of a partition that are not written yet, and the documents they come from."""

    def __init__(self, packing: Packing, ends: np.ndarray, first_sequence: int):
        self.packing, self.ends, self.sequence = packing, ends, first_sequence
        self.parts: list[tuple[int, np.ndarray, int, int]] = []  # row, tokens, their start, all
        self.held = 0

    def add(self, row: int, ids: np.ndarray) -> None:
        self.parts.append((row, ids, 0, len(ids)))
        self.held += len(ids)

    def _places(self, all_ids: np.ndarray, lengths: list[int]) -> tuple[list[int], list[float]]:
        p = self.packing
        document_ends = np.cumsum(lengths)
        sentence_ends = np.flatnonzero(self.ends[all_ids]) + 1
        # Of the sentence ends in a cell of the grid the last is tried.
        cell = sentence_ends // p.grid
        sentence_ends = sentence_ends[np.append(cell[1:] != cell[:-1], True)] if len(cell) else sentence_ends
        good = np.union1d(sentence_ends, document_ends)
        inner = []
        before = 0
        for i in np.flatnonzero(np.diff(np.append(0, good)) > p.size // 8):
            before = int(good[i - 1]) if i else 0
            inner.append(np.arange(before + p.grid, good[i], p.grid))
        every = np.union1d(good, np.concatenate(inner)) if inner else good
        cost = np.full(len(every), p.inner_penalty)
        cost[np.isin(every, sentence_ends)] = p.sentence_penalty
        cost[np.isin(every, document_ends)] = 0.0
        return [0, *every.tolist()], [0.0, *cost.tolist()]

    def flush(self, last: bool) -> list[tuple]:
        """Pieces (row, start, length, crc, all, sequence, offset, padding, ids) of the windows
        planned; unless it is the last call, the final window stays open."""
        if not self.held:
            return []
        p = self.packing
        all_ids = np.concatenate([part[1] for part in self.parts])
        places, penalties = self._places(all_ids, [len(part[1]) for part in self.parts])
        ends = [places[j] for j in cuts(places, penalties, p.size, p.sequence_penalty)]
        if not last:
            ends.pop()
        rows, begin, which, used = [], 0, 0, 0
        for end in ends:
            length = end - begin
            padding = 0 if length & (length - 1) == 0 else p.size - length
            offset = 0
            while offset < length:
                row, ids, start, total = self.parts[which]
                take = min(len(ids) - used, length - offset)
                piece = ids[used : used + take]
                crc = zlib.crc32(piece.tobytes())
                rows.append((row, start + used, take, crc, total, self.sequence, offset, padding, piece))
                offset += take
                used += take
                if used == len(ids):
                    which, used = which + 1, 0
            self.sequence += 1
            begin = end
        rest = self.parts[which:]
        if rest and used:
            row, ids, start, total = rest[0]
            rest[0] = (row, ids[used:], start + used, total)
        self.parts = rest
        self.held = sum(len(part[1]) for part in rest)
        return rows


def pack(
    documents: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    packing: Packing | None = None,
    with_ids: bool = True,
    text: str = "text",
) -> DataFrame:
    """One row per piece of a document: where it lies in its document and in its sequence.

    Documents keep their order inside each partition of the input, and sequences do not cross
    partitions, so the job needs no shuffle and a lost task is simply run again. The token ids of
    a piece are in ``ids`` unless ``with_ids`` is off. Other columns of ``documents`` are kept,
    save those with names of results. A null text counts as empty: its document is one
    separator. Repeated rows are packed each.
    """
    packing = packing or Packing()
    source = documents.drop(*PIECES.names).withColumn("_text", text_or_empty(text)).drop(text)
    out = pa.schema([f for f in PIECES if with_ids or f.name != "ids"])
    kinds = {"ids": T.ArrayType(T.IntegerType())}
    schema = source.drop("_text").schema
    for field in out:
        schema = schema.add(field.name, kinds.get(field.name, T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer, ranks, pattern)
        stream = _Stream(packing, tokens.sentence_ends(), TaskContext.get().partitionId() << 33)
        held: list[pa.RecordBatch] = []  # the other columns of documents that are still open
        first = 0  # number of the first row in held
        seen = 0

        def pieces(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, first
            rows = stream.flush(last)
            if not rows:
                return
            others = pa.Table.from_batches(held).combine_chunks()
            for begin in range(0, len(rows), 4096):
                part = rows[begin : begin + 4096]
                taken = others.take(pa.array([r[0] - first for r in part]))
                made = list(zip(*part, strict=True))[1:]
                columns = [pa.array(v, pa.int64()) for v in made[:-1]]
                if with_ids:
                    lengths = np.cumsum([0, *map(len, made[-1])], dtype=np.int32)
                    values = np.concatenate(made[-1]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(lengths, values))
                kept = [c.combine_chunks() for c in taken.columns]
                kept = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in kept]
                yield pa.RecordBatch.from_arrays(kept + columns, names=others.schema.names + out.names)
            if stream.parts:
                keep = stream.parts[0][0]
                held = others.slice(keep - first).combine_chunks().to_batches()
                first = keep
            else:
                held, first = [], seen

        separator = np.array([packing.separator], "<u4")
        for whole in batches:
            for batch in batch_rows(whole, 64):
                held.append(batch.drop_columns(["_text"]))
                for value in batch.column("_text").to_pylist():
                    stream.add(seen, np.concatenate([tokens.ids(value), separator]))
                    seen += 1
                if stream.held >= packing.buffer:
                    yield from pieces(last=False)
        yield from pieces(last=True)

    return source.mapInArrow(run, schema)
