"""Language-model scores: a hierarchical Pitman-Yor model over words, learned from a corpus.

There is a restaurant for each preceding word. Their tables are the customers of one shared
parent, whose base is uniform over the vocabulary and one unknown word. Seating is sampled by
Gibbs: all customers of a word leave a restaurant and are seated again one after another, given
the tables of all others. A customer alone in an entry (preceding word, word) has one table, so
only entries of two or more are seated. The tables and the parent's probabilities of several
seatings are averaged.

Texts are read once, in chunks of tokens. A chunk asks the blocks that own its words and its
pairs of words, which are dealt out by hashes, so that a frequent word's pairs meet in many tasks.
Words travel as hashes of 64 bits; the block that owns a word sees its text, and should two words
share a hash, all starts again with other hashes. In a pass the blocks of entries send the owners of their
words the tables per word and get back the totals; numbers travel as packed arrays, in an order that
both sides keep. At the end each chunk gets what belongs to its words and pairs and scores its texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.llm.common import batch_rows, crc_mod, removed, text_or_empty, written

# The end of a text; words are never empty.
END = b""

# Rows that the steps exchange. ``block`` is who gets a row, ``peer`` who sent it. The binary columns
# are packed arrays, the long ones numbers that the driver adds up.
ARRAYS = [
    "ids", "names", "ctx", "word", "n", "at", "tables", "kept", "served_once", "own_once", "served", "root", "own",
    "own_sum", "parent_sum",
]
SUMS = ["words", "tokens", "once", "twice", "seated", "clashes"]
PART = (
    "kind string, block long, peer long, "
    + ", ".join(f"{c} binary" for c in ARRAYS)
    + ", "
    + ", ".join(f"{c} long" for c in SUMS)
)
_PART = pa.schema(
    [("kind", pa.string()), ("block", pa.int64()), ("peer", pa.int64())]
    + [(c, pa.binary()) for c in ARRAYS]
    + [(c, pa.int64()) for c in SUMS]
)


@dataclass(frozen=True)
class Model:
    """passes times sweeps: seatings before the ``samples`` that are averaged. flush: tokens of a
    chunk; block: bytes of text for each of the blocks that words and pairs are dealt out to.
    contexts, head: without effect, all pairs are looked up alike.
    """

    contexts: int = 255
    head: int = 8192
    passes: int = 2
    sweeps: int = 2
    samples: int = 2
    strength: float = 1.0
    flush: int = 2_200_000
    block: int = 32_000_000


@dataclass(frozen=True)
class Totals:
    """Customers and tables per restaurant, tables and customers of the parent, and settings.

    Without ``root_customers`` the parent has a customer for each of ``tables``.
    """

    customers: np.ndarray
    tables: np.ndarray
    root_tables: float
    vocabulary: int
    discount: float
    root_discount: float
    strength: float
    root_customers: float | None = None


def _discount(once: int, twice: int) -> float:
    """From the numbers of counts one and two; kept away from the borders."""
    return min(0.95, max(0.05, once / (once + 2 * twice) if once + twice else 0.5))


def _seated(customers: np.ndarray, new: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating ``customers`` one after another; ``new``: weight of a new table.

    After the first eight, customers come in groups of an eighth of those already seated, each
    group with the chances of its first member.
    """
    tables = np.minimum(customers, 1)
    order = np.argsort(-customers, kind="stable")
    count, weight = customers[order], new[order]
    made = tables[order].astype(np.int64)
    i, active = 1, int(np.searchsorted(-count, -1, side="left"))
    while active:
        step = max(1, i // 8)
        chance = weight[:active] / (weight[:active] + np.maximum(i - discount * made[:active], 1e-12))
        group = np.minimum(step, count[:active] - i)
        made[:active] += rng.binomial(group, np.clip(chance, 0, 1))
        i += step
        active = int(np.searchsorted(-count, -i, side="left"))
    tables[order] = made
    return tables


def seat(
    word: np.ndarray, ctx: np.ndarray, count: np.ndarray, totals: Totals, sweeps: int, samples: int, seed: int,
    tables: np.ndarray | None = None, others: np.ndarray | None = None, root: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gibbs sweeps over entries (word number, context, count).

    ``tables``: per entry to start with; ``others``: tables of the words in entries elsewhere;
    ``root``: tables of the words in the parent, then held still. Returns the tables of the last
    sweep per entry and of the parent per word, and from the last ``samples`` sweeps the predictive
    probability per entry (averaged) and the parent's probability per word and sample.
    """
    rng = np.random.default_rng(seed)
    n_words = int(word[-1]) + 1 if len(word) else 0
    t = totals
    d1, d0 = t.discount, t.root_discount
    base = 1 / (t.vocabulary + 1)
    root_customers = float(t.tables.sum()) if t.root_customers is None else t.root_customers
    tables = np.ones(len(word), np.int64) if tables is None else tables
    others = np.zeros(n_words, np.int64) if others is None else others
    held, root = root is not None, np.ones(n_words, np.int64) if root is None else root
    mean = np.zeros(len(word))
    parents = np.zeros((n_words, samples))

    def parent(own: np.ndarray | int, by: np.ndarray | slice) -> np.ndarray:
        served = (np.bincount(word, tables, n_words) + others)[by] - own
        return _parent(served, np.minimum(root[by], np.maximum(served, 0)), t, root_customers)

    for sweep in range(sweeps + samples):
        new = (t.strength + d1 * np.maximum(t.tables[ctx] - tables, 0)) * parent(tables, word)
        tables = _seated(count, new, d1, rng)
        if not held:
            served = np.bincount(word, tables, n_words).astype(np.int64) + others
            root = _seated(served, np.full(n_words, (t.strength + d0 * t.root_tables) * base), d0, rng)
        if sweep >= sweeps:
            above = parent(0, slice(None))
            parents[:, sweep - sweeps] = above
            own = count - d1 * tables + (t.strength + d1 * t.tables[ctx]) * above[word]
            mean += own / (t.strength + t.customers[ctx]) / samples
    return tables, root, mean, parents


def _parent(served, root, t: Totals, root_customers: float):
    """The parent's probability of words with so many customers and tables there."""
    weight = np.maximum(served - t.root_discount * root, 0)
    above = (t.strength + t.root_discount * t.root_tables) / (t.vocabulary + 1)
    return (weight + above) / (t.strength + root_customers)


def _packed(values: np.ndarray) -> bytes:
    """An array of numbers, compressed by planes of bytes."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, kind: type) -> np.ndarray:
    size, width = int.from_bytes(packed[:8], "little"), np.dtype(kind).itemsize
    if not size:
        return np.zeros(0, kind)
    planes = pa.decompress(packed[8:], size * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, size).T).view(kind).reshape(size)


def _ascending(values: np.ndarray) -> bytes:
    """Packed steps between ascending numbers."""
    return _packed(np.diff(values, prepend=values.dtype.type(0)))


def _risen(packed: bytes, kind: type) -> np.ndarray:
    return np.cumsum(_unpacked(packed, kind), dtype=kind)


def _packed_words(words: pa.Array) -> bytes:
    return _packed(np.frombuffer(b" ".join(words.to_pylist()), np.uint8))


def _unpacked_words(packed: bytes, size: int) -> list[bytes]:
    return _unpacked(packed, np.uint8).tobytes().split(b" ") if size else []


def _small(values: np.ndarray) -> bytes:
    """Packed in 32 bits where all values fit; the first byte says so."""
    fits = not len(values) or (values.max() < 2**31 and values.min() >= -(2**31))
    return (b"\4" if fits else b"\10") + _packed(values.astype(np.int32 if fits else np.int64))


def _whole(packed: bytes) -> np.ndarray:
    return _unpacked(packed[1:], np.int32 if packed[0] == 4 else np.int64).astype(np.int64)


def _table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_PART)


def _ids(words: list[bytes], salt: int) -> np.ndarray:
    """Hashes of words."""
    return pd.util.hash_array(np.array([*words, END], object), hash_key=f"{salt:016d}", categorize=False)[:-1]


def _dealt(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """The blocks of hashes, ascending with the hash."""
    return (((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def _dealt_pairs(ctx: np.ndarray, word: np.ndarray, blocks: int) -> np.ndarray:
    mixed = (ctx * np.uint64(0x9E3779B97F4A7C15)) ^ word
    return _dealt(mixed * np.uint64(0xBF58476D1CE4E5B9), blocks)


def _bounds(block: np.ndarray, blocks: int) -> Iterator[tuple[int, slice]]:
    """The blocks that occur in an ascending array, with their places."""
    edges = np.searchsorted(block, np.arange(blocks + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        yield b, slice(int(edges[b]), int(edges[b + 1]))


def _pair_keys(tokens: np.ndarray, words: np.ndarray, salt: int) -> np.ndarray:
    """Each token with the one before it; both are places in ``words``."""
    before = np.empty(len(tokens), np.int64)
    before[:1] = np.searchsorted(words, _ids([END], salt))
    before[1:] = tokens[:-1]
    return before * len(words) + tokens


def _pairs(keys: np.ndarray, words: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Preceding word, word and block of ascending keys of pairs, and their order by block."""
    ctx, word = np.divmod(keys, len(words))
    block = _dealt_pairs(words[ctx], words[word], blocks)
    return ctx, word, block, np.argsort(block, kind="stable")


def _tokens(texts: pa.Array, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Hashes of the words of texts, in ASCII lower case and each text with its end; tokens per
    text; and hashes and words that occur."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = split.flatten().cast(pa.binary())
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))[filled]
    coded = flat.dictionary_encode()
    ids = _ids(coded.dictionary.to_pylist(), salt)
    stream = np.full(len(text) + len(texts), _ids([END], salt)[0], np.uint64)
    stream[np.arange(len(text)) + text] = ids[coded.indices.to_numpy(zero_copy_only=False)[filled]]
    return stream, np.bincount(text, minlength=len(texts)) + 1, ids, coded.dictionary


def _merged(ids: np.ndarray, words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, int]:
    """Distinct hashes, their words, the place of each hash, and how many words are not the hash's first."""
    distinct, first, place = np.unique(ids, return_index=True, return_inverse=True)
    named = words.take(pa.array(first))
    return distinct, named, place, pc.sum(pc.not_equal(named.take(pa.array(place)), words)).as_py() or 0


def _chunks(documents: DataFrame, plain: list[T.StructField], blocks: int, model: Model, salt: int) -> DataFrame:
    """Per text a row ``text`` and per chunk of tokens a row ``chunk``, with the chunk for a block; and
    rows ``words`` and ``pairs`` for the blocks that own them, n counting training texts only."""
    schema = T.StructType.fromDDL(PART).add("place", "long").add("n_tokens", "long")
    for f in plain:
        schema = schema.add(f.name, f.dataType)
    names = schema.names

    def asked(chunk: int, streams: list, helds: list, ids: list, named: list) -> Iterator[dict]:
        words, tokens = np.unique(np.concatenate(streams), return_inverse=True)
        held = np.concatenate(helds)
        every = np.concatenate([*ids, _ids([END], salt)])
        _, named, _, clashes = _merged(every, pa.concat_arrays([*named, pa.array([END], pa.binary())]))
        yield {"kind": "chunk", "block": chunk, "ids": _ascending(words), "word": _small(tokens), "clashes": clashes}
        n = np.bincount(tokens[~held], minlength=len(words))
        for b, own in _bounds(_dealt(words, blocks), blocks):
            yield {"kind": "words", "block": b, "peer": chunk, "ids": _ascending(words[own]),
                   "names": _packed_words(named[own]), "n": _small(n[own])}
        # Sorted with the lowest bit for texts held out, so that no places are needed.
        keys = _pair_keys(tokens, words, salt) * 2 + held
        keys.sort()
        first = np.flatnonzero(np.diff(keys >> 1, prepend=-1))
        n = np.add.reduceat(1 - (keys & 1), first)
        ctx, word, block, order = _pairs(keys[first] >> 1, words, blocks)
        ctx, word, n = ctx[order], word[order], n[order]
        for b, own in _bounds(block[order], blocks):
            used = np.unique(np.concatenate([ctx[own], word[own]]))
            yield {"kind": "pairs", "block": b, "peer": chunk, "ids": _ascending(words[used]),
                   "ctx": _ascending(np.searchsorted(used, ctx[own])), "word": _small(np.searchsorted(used, word[own])),
                   "n": _small(n[own])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, kinds = TaskContext.get().partitionId() << 33, []
        streams, helds, ids, named, size, place = [], [], [], [], 0, 0

        def closed() -> Iterator[pa.RecordBatch]:
            for row in asked(chunk, streams, helds, ids, named):
                part = pa.RecordBatch.from_pylist([row], schema=_PART)
                empty = [pa.nulls(1, k) for k in (pa.int64(), pa.int64(), *kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *empty], names=names)
            for found in (streams, helds, ids, named):
                found.clear()

        for whole in batches:
            for batch in batch_rows(whole, 512):
                if not batch.num_rows:
                    continue
                stream, n, own_ids, own_named = _tokens(batch.column("_text"), salt)
                held = ~batch.column("_train").to_numpy(zero_copy_only=False).astype(bool)
                streams.append(stream)
                helds.append(np.repeat(held, n))
                ids.append(own_ids)
                named.append(own_named)
                others = [batch.column(f.name) for f in plain]
                kinds = [c.type for c in others]
                part = {c: pa.nulls(batch.num_rows, _PART.field(c).type) for c in _PART.names}
                part |= {"kind": pa.array(["text"] * len(n)), "block": pa.array(np.full(len(n), chunk))}
                places = np.arange(place, place + len(n))
                yield pa.RecordBatch.from_arrays([*part.values(), pa.array(places), pa.array(n), *others], names=names)
                size, place = size + len(stream), place + len(n)
                if size >= model.flush:
                    yield from closed()
                    chunk, size, place = chunk + 1, 0, 0
        if size:
            yield from closed()

    return documents.mapInArrow(run, schema)


def _owned(asked: pa.Table) -> pa.Table:
    """The words of a block: those of training texts, and for each chunk the places of its words there."""
    rows = asked.to_pylist()
    ids = [_risen(r["ids"], np.uint64) for r in rows]
    named = [w for r, own in zip(rows, ids, strict=True) for w in _unpacked_words(r["names"], len(own))]
    distinct, words, place, clashes = _merged(np.concatenate(ids), pa.array(named, pa.binary()))
    n = np.zeros(len(distinct), np.int64)
    np.add.at(n, place, np.concatenate([_whole(r["n"]) for r in rows]))
    known = n > 0
    at = np.where(known, np.cumsum(known) - 1, -1)
    block, n = rows[0]["block"], n[known]
    out = [{"kind": "owned", "block": block, "ids": _ascending(distinct[known]), "n": _small(n),
            "names": _packed_words(words.filter(pa.array(known))), "words": len(n), "tokens": int(n.sum()),
            "once": int((n == 1).sum()), "twice": int((n == 2).sum()), "clashes": clashes}]
    ends = np.cumsum([len(i) for i in ids])
    for r, end, own in zip(rows, ends, ids, strict=True):
        out.append({"kind": "back", "block": block, "peer": r["peer"], "at": _small(at[place[end - len(own) : end]])})
    return _table(out)


def _entered(blocks: int, whole: bool):
    """The entries of a block of pairs. Those of two or more (``seats``) have words numbered among their
    own; for each chunk the places of its pairs: -1 without an entry, 0 for an entry of one, else one
    more than its seats. Owners of words learn who has entries of them (``first``)."""

    def run(asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        ids = [_risen(r["ids"], np.uint64) for r in rows]
        words = np.unique(np.concatenate(ids))
        keys = []
        for r, own in zip(rows, ids, strict=True):
            at = np.searchsorted(words, own)
            keys.append(at[_risen(r["ctx"], np.int64)] * len(words) + at[_whole(r["word"])])
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(place, np.concatenate([_whole(r["n"]) for r in rows]), len(distinct)).astype(np.int64)
        one, more = n == 1, n > 1
        at = np.where(more, np.cumsum(more), np.where(one, 0, -1))
        ctx, word = np.divmod(distinct, len(words))
        counts = [np.bincount(x[by], minlength=len(words)) for by in (one, more) for x in (word, ctx)]
        seats = counts[2] + counts[3] > 0
        number = np.cumsum(seats) - 1
        block = rows[0]["block"]
        out = [{"kind": "seats", "block": block, "ctx": _ascending(number[ctx[more]]), "word": _small(number[word[more]]),
                "n": _small(n[more]), "tables": _small(n[more] * 0 + 1), "kept": _small(n[more] * 0),
                "once": int(one.sum()), "twice": int((n == 2).sum())}]
        if whole:
            some = n > 0
            out.append({"kind": "entries", "block": block, "ids": _ascending(words), "ctx": _small(ctx[some]),
                        "word": _small(word[some]), "at": _small(at[some])})
        end = 0
        for r, own in zip(rows, keys, strict=True):
            end += len(own)
            back = at[place[end - len(own) : end]]
            out.append({"kind": "back", "block": block, "peer": r["peer"], "at": _small(back)})
        used = np.flatnonzero(np.sum(counts, axis=0))
        for b, own in _bounds(_dealt(words[used], blocks), blocks):
            once, own_once, tables, own_tables = (_small(c[used[own]]) for c in counts)
            out.append({"kind": "first", "block": b, "peer": block, "ids": _ascending(words[used[own]]),
                        "served_once": once, "own_once": own_once, "served": tables, "own": own_tables})
        return _table(out)

    return run


def _told(block: int, places: dict[int, np.ndarray], served: np.ndarray, root: np.ndarray, own: np.ndarray):
    """The totals of the words that blocks of entries seat."""
    for peer, at in places.items():
        yield {"kind": "told", "block": peer, "peer": block, "served": _small(served[at]),
               "root": _small(root[at]), "own": _small(own[at])}


def _opened(owned: pa.Table, first: pa.Table) -> pa.Table:
    """The totals of a block's words before the first pass: an entry has one table."""
    row = owned.to_pylist()[0]
    ids, block = _risen(row["ids"], np.uint64), row["block"]
    once, own_once, served, own = (np.zeros(len(ids), np.int64) for _ in range(4))
    places = {}
    for r in first.to_pylist():
        at = np.searchsorted(ids, _risen(r["ids"], np.uint64))
        tables, own_tables = _whole(r["served"]), _whole(r["own"])
        once[at] += _whole(r["served_once"])
        own_once[at] += _whole(r["own_once"])
        served[at] += tables
        own[at] += own_tables
        if (seats := tables + own_tables > 0).any():
            places[r["peer"]] = at[seats]
    served, own, root = served + once, own + own_once, np.ones(len(ids), np.int64)
    out = [{"kind": "state", "block": block, "served_once": _small(once), "own_once": _small(own_once),
            "served": _small(served), "root": _small(root), "own_sum": _small(own * 0),
            "parent_sum": _packed(np.zeros(len(ids))), "seated": int(served.sum())}]
    out += [{"kind": "place", "block": block, "peer": p, "at": _small(at)} for p, at in places.items()]
    return _table([*out, *_told(block, places, served, root, own)])


def _seated_entries(totals: Totals, turn: int, keep: bool):
    """The entries of a block seated once, given the totals of the last pass."""

    def run(seats: pa.Table, told: pa.Table) -> pa.Table:
        row = seats.to_pylist()[0]
        ctx = _risen(row["ctx"], np.int64)
        word, n, tables, kept = (_whole(row[c]) for c in ("word", "n", "tables", "kept"))
        # Owners have ranges of hashes and the words are numbered by hash.
        owners = sorted(told.to_pylist(), key=lambda r: r["peer"])
        none = [np.zeros(0, np.int64)]
        served, root, own = (np.concatenate(none + [_whole(r[c]) for r in owners]) for c in ("served", "root", "own"))
        each = np.arange(len(n))
        here = replace(totals, tables=own[ctx].astype(float), customers=np.zeros(len(n)))
        tables, *_ = seat(each, each, n, here, 1, 0, [row["block"], turn, 0], tables, served[word] - tables, root[word])
        out = [row | {"kind": "seats", "tables": _small(tables), "kept": _small(kept + tables if keep else kept)}]
        sums = [np.bincount(x, tables, len(own)).astype(np.int64) for x in (word, ctx)]
        end = 0
        for r in owners:
            start, end = end, end + int.from_bytes(r["own"][1:9], "little")
            out.append({"kind": "tables", "block": r["peer"], "peer": row["block"],
                        "served": _small(sums[0][start:end]), "own": _small(sums[1][start:end])})
        return _table(out)

    return run


def _parents(row: dict, due: Totals | None) -> np.ndarray:
    """The summed probabilities of the parent, with those of the last pass if they are due."""
    sums = _unpacked(row["parent_sum"], np.float64)
    if due is None:
        return sums
    return sums + _parent(_whole(row["served"]), _whole(row["root"]), due, due.root_customers)


def _seated_words(totals: Totals, due: Totals | None, turn: int, keep: bool):
    """The words of a block with the parent's tables seated again, given the tables that serve them."""

    def run(state: pa.Table, tables: pa.Table) -> pa.Table:
        rows = state.to_pylist()
        row = next(r for r in rows if r["kind"] == "state")
        places = {r["peer"]: _whole(r["at"]) for r in rows if r["kind"] == "place"}
        served, own = _whole(row["served_once"]), _whole(row["own_once"])
        for r in tables.to_pylist():
            served[places[r["peer"]]] += _whole(r["served"])
            own[places[r["peer"]]] += _whole(r["own"])
        t, block = totals, row["block"]
        new = (t.strength + t.root_discount * t.root_tables) / (t.vocabulary + 1)
        rng = np.random.default_rng([block, turn, 1])
        root = _seated(served, np.full(len(served), new), t.root_discount, rng).astype(np.int64)
        out = [row | {"served": _small(served), "root": _small(root), "parent_sum": _packed(_parents(row, due)),
                      "own_sum": _small(_whole(row["own_sum"]) + (own if keep else 0)),
                      "seated": int(served.sum()), "words": int(root.sum())}]
        out += [r for r in rows if r["kind"] == "place"]
        return _table([*out, *_told(block, places, served, root, own)])

    return run


def _valued(totals: Totals, due: Totals | None, samples: int, whole: bool):
    """The count, the parent's probability and the room of a block's words, for each chunk."""

    def run(state: pa.Table, back: pa.Table) -> pa.Table:
        rows = {r["kind"]: r for r in state.to_pylist()}
        owned, row = rows["owned"], rows["state"]
        n, parent = _whole(owned["n"]), _parents(row, due) / samples
        room = totals.strength + totals.discount * _whole(row["own_sum"]) / samples
        out = []
        if whole:
            out.append(owned | {"kind": "valued", "parent_sum": _packed(parent), "own_sum": _packed(room)})
        # A word without a count has the last place.
        n, parent, room = np.append(n, 0), np.append(parent, 1.0), np.append(room, 1.0)
        for r in back.to_pylist():
            at = _whole(r["at"])
            out.append({"kind": "values", "block": r["peer"], "peer": r["block"], "n": _small(n[at]),
                        "parent_sum": _packed(parent[at]), "own_sum": _packed(room[at])})
        return _table(out)

    return run


def _counted(samples: int):
    """The count and the tables, summed over the samples, of the pairs of each chunk."""

    def run(seats: pa.Table, back: pa.Table) -> pa.Table:
        row = seats.to_pylist()[0]
        n = np.concatenate([[1], _whole(row["n"]), [0]])
        kept = np.concatenate([[samples], _whole(row["kept"]), [0]])
        out = []
        for r in back.to_pylist():
            at = _whole(r["at"])
            out.append({"kind": "counts", "block": r["peer"], "peer": r["block"], "n": _small(n[at]),
                        "kept": _small(kept[at])})
        return _table(out)

    return run


@dataclass(frozen=True)
class _Fitted:
    """What is left after the passes: the chunks, the owned words and pairs with the chunks' places in
    them, the seats and the state of the words; and the driver's numbers."""

    chunks: DataFrame
    owned: DataFrame
    entered: DataFrame
    seats: DataFrame
    state: DataFrame
    totals: Totals
    due: Totals | None
    unknown: float
    tokens: int
    blocks: int
    salt: int


def _of(parts: DataFrame, *kinds: str) -> DataFrame:
    return parts.where(F.col("kind").isin(*kinds)).select("kind", "block", "peer", *ARRAYS)


def _met(left: DataFrame, right: DataFrame, step, schema: str | T.StructType = PART) -> DataFrame:
    """The rows of both sides that are for one block, through a step."""
    # With columns of their own, as both may come from one table.
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(step, schema)


def _sums(parts: DataFrame, *names: str):
    return parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()


def _fitted(documents: DataFrame, model: Model, whole: bool = False) -> _Fitted:
    """The model learned; ``documents`` has _text, _train and columns to be handed on."""
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = 1 + size // model.block
    plain = [f for f in documents.schema if f.name not in ("_text", "_train")]
    salt, clashes = -1, 1
    while clashes:
        salt += 1
        chunks, chunks_path = written(_chunks(documents, plain, blocks, model, salt), "hpy-chunks", "kind")
        owned, owned_path = written(_of(chunks, "words").groupBy("block").applyInArrow(_owned, PART), "hpy-words")
        facts = _sums(owned, "words", "tokens", "once", "twice", "clashes")
        clashes = facts.clashes + _sums(chunks, "clashes").clashes
        removed(spark, *((chunks_path, owned_path) if clashes else (f"{chunks_path}/kind=words",)))
    entered, entered_path = written(
        _of(chunks, "pairs").groupBy("block").applyInArrow(_entered(blocks, whole), PART), "hpy-pairs", "kind"
    )
    removed(spark, f"{chunks_path}/kind=pairs")
    now, path = written(_met(_of(owned, "owned"), _of(entered, "first"), _opened), "hpy-state", "kind")
    pairs = _sums(entered, "once", "twice")
    none = np.zeros(0)
    totals = Totals(
        none, none, float(facts.words), facts.words, _discount(pairs.once, pairs.twice),
        _discount(facts.once, facts.twice), model.strength, float(_sums(now, "seated").seated),
    )
    unknown, due, seats, seats_path = 0.0, None, entered, None
    removed(spark, f"{entered_path}/kind=first")
    burn = model.passes * model.sweeps
    for turn in range(burn + model.samples):
        keep = turn >= burn
        step = _met(_of(seats, "seats"), _of(now, "told"), _seated_entries(totals, turn, keep))
        seats, new_seats = written(step, "hpy-seats", "kind")
        step = _met(_of(now, "state", "place"), _of(seats, "tables"), _seated_words(totals, due, turn, keep))
        now, new_path = written(step, "hpy-state", "kind")
        sums = _sums(now, "seated", "words")
        totals = replace(totals, root_tables=float(sums.words), root_customers=float(sums.seated))
        due = totals if keep else None
        if keep:
            above = (totals.strength + totals.root_discount * totals.root_tables) / (totals.vocabulary + 1)
            unknown += above / (totals.strength + totals.root_customers) / model.samples
        removed(spark, path, *([seats_path] if seats_path else []))
        path, seats_path = new_path, new_seats
    return _Fitted(chunks, owned, entered, seats, now, totals, due, unknown, facts.tokens, blocks, salt)


def _values(f: _Fitted, model: Model, whole: bool = False) -> DataFrame:
    known = _of(f.owned, "owned").union(_of(f.state, "state"))
    return _met(known, _of(f.owned, "back"), _valued(f.totals, f.due, model.samples, whole))


@dataclass(frozen=True)
class Learned:
    """words: word, count, parent (its probability), backoff (the weight of the parent after it);
    gains: word, ctx, gain, where 10 ** gain is what multiplies backoff and parent; the parent's
    probability of an unknown word, distinct words and tokens.
    """

    words: DataFrame
    gains: DataFrame
    unknown: float
    vocabulary: int
    tokens: int


def learn(documents: DataFrame, model: Model) -> Learned:
    """The model of the texts of ``documents``."""
    rows = documents.select(text_or_empty().alias("_text"), F.lit(True).alias("_train"))
    f = _fitted(rows, model, whole=True)
    samples, strength, discount = model.samples, f.totals.strength, f.totals.discount

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, n = _risen(r["ids"], np.uint64), _whole(r["n"])
                found = [ids.view(np.int64), pa.array(_unpacked_words(r["names"], len(n)), pa.binary()), n]
                found += [_unpacked(r[c], np.float64) for c in ("parent_sum", "own_sum")]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["id", "word", "count", "parent", "room"])

    def entries(seats: pa.Table, every: pa.Table) -> pa.Table:
        row, r = seats.to_pylist()[0], every.to_pylist()[0]
        ids, at = _risen(r["ids"], np.uint64).view(np.int64), _whole(r["at"])
        n = np.concatenate([[1], _whole(row["n"])])[at]
        tables = np.concatenate([[samples], _whole(row["kept"])])[at] / samples
        found = [ids[_whole(r["ctx"])], ids[_whole(r["word"])], n - discount * tables]
        return pa.Table.from_arrays([pa.array(x) for x in found], ["c", "w", "above"])

    values = _values(f, model, whole=True).where("kind = 'valued'")
    valued = values.mapInArrow(words, "id long, word binary, count long, parent double, room double")
    valued, _ = written(valued, "hpy-model")
    pairs = _met(_of(f.seats, "seats"), _of(f.entered, "entries"), entries, "c long, w long, above double")
    gains = (
        pairs.join(valued.select(F.col("id").alias("w"), "word", "parent"), "w")
        .join(valued.select(F.col("id").alias("c"), F.col("word").alias("ctx"), "room"), "c")
        .select("word", "ctx", F.log10(1 + F.col("above") / (F.col("room") * F.col("parent"))).alias("gain"))
    )
    backoff = (F.col("room") / (strength + F.col("count"))).alias("backoff")
    return Learned(valued.select("word", "count", "parent", backoff), gains, f.unknown, f.totals.vocabulary, f.tokens)


def score(documents: DataFrame, training, model: Model | None = None, text: str = "text") -> DataFrame:
    """``documents`` without the text, with n_tokens, n_known, train_tokens, base_score, score and
    perplexity.

    ``training``: a condition for the documents the model learns from. A null text counts as
    empty: one token, the end. With no training documents every word is unknown and has
    probability 1 over the size of the vocabulary plus 1. Repeated rows are scored each; columns
    of ``documents`` with names of results are replaced.
    """
    model = model or Model()
    results = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    plain = [f for f in documents.drop(text, *results).schema]
    rows = documents.select(
        text_or_empty(text).alias("_text"),
        F.coalesce(F.expr(training) if isinstance(training, str) else training, F.lit(False)).alias("_train"),
        *[F.col(f"`{f.name}`").alias(f"_{i}") for i, f in enumerate(plain)],
    )
    own = [f"_{i}" for i in range(len(plain))]
    f = _fitted(rows, model)
    answers = _values(f, model).union(
        _met(_of(f.seats, "seats"), _of(f.entered, "back"), _counted(model.samples))
    )
    texts = f.chunks.where("kind = 'text'").select("block", "place", "n_tokens", *own)
    parts = _of(f.chunks, "chunk").union(_of(answers, "values", "counts"))
    schema = T.StructType([T.StructField(c, p.dataType) for c, p in zip(own, plain, strict=True)])
    for c in ("n_tokens", "n_known"):
        schema = schema.add(c, "long")
    for c in ("base_score", "score"):
        schema = schema.add(c, "double")
    return _met(texts, parts, _scored(f, model, own), schema).select(
        *[F.col(c).alias(p.name) for c, p in zip(own, plain, strict=True)],
        "n_tokens",
        "n_known",
        F.lit(int(f.tokens)).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def _scored(f: _Fitted, model: Model, own: list[str]):
    """The texts of a chunk: each token adds its parent's probability as a word, its backoff as the word
    before, and the gain of its pair."""
    blocks, salt, discount, strength = f.blocks, f.salt, f.totals.discount, f.totals.strength
    low, unknown, samples = f.tokens + f.totals.vocabulary + 1, math.log10(f.unknown), model.samples

    def run(texts: pa.Table, parts: pa.Table) -> pa.Table:
        texts = texts.sort_by("place")
        rows = sorted(parts.to_pylist(), key=lambda r: r["peer"] or 0)
        chunk = next(r for r in rows if r["kind"] == "chunk")
        values, counts = ([r for r in rows if r["kind"] == k] for k in ("values", "counts"))
        words, tokens = _risen(chunk["ids"], np.uint64), _whole(chunk["word"])
        count = np.concatenate([_whole(r["n"]) for r in values])
        parent, room = (
            np.concatenate([_unpacked(r[c], np.float64) for r in values]) for c in ("parent_sum", "own_sum")
        )
        value = np.where(count > 0, np.log10(parent) + np.log10(room / (strength + count)), unknown)
        keys, pair = np.unique(_pair_keys(tokens, words, salt), return_inverse=True)
        ctx, word, _, order = _pairs(keys, words, blocks)
        n, kept = (np.concatenate([_whole(r[c]) for r in counts]) for c in ("n", "kept"))
        gain = np.empty(len(keys))
        gain[order] = np.log10(1 + (n - discount * kept / samples) / (room[ctx[order]] * parent[word[order]]))
        start = np.cumsum(n_tokens := texts.column("n_tokens").to_numpy()) - n_tokens
        score = np.add.reduceat(value[tokens] + gain[pair], start)
        base = np.add.reduceat(np.log10((count + 1) / low)[tokens], start)
        known = np.add.reduceat((count > 0)[tokens].astype(np.int64), start)
        found = [texts.column("n_tokens"), pa.array(known), pa.array(base), pa.array(score)]
        names = [*own, "n_tokens", "n_known", "base_score", "score"]
        return pa.Table.from_arrays([*(texts.column(c) for c in own), *found], names)

    return run


def in_fold(column: str, folds: int, fold: int):
    """Whether crc32 of the id as text falls into a fold."""
    return crc_mod(column, folds) == fold


def perplexity(scores: list[float], tokens: list[int]) -> float:
    return math.pow(10.0, -sum(scores) / max(sum(tokens), 1))
