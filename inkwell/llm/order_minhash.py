"""Near-duplicates by Order MinHash, verified by banded alignment alone.

A text's k-mers are its windows of five words, each labelled with how often it occurred before.
A sketch entry takes, under one hash function, the two k-mers with the least hashes and
keeps them in text order, so it agrees for two texts when they share k-mers in the same order.
Bands of entries make buckets. In a bucket every text is aligned with the most central one, so
that groups of copies cost a linear number of alignments. Texts of a bucket that do not hang
together yet are then compared in blocks of bounded size, so that no link inside a bucket is lost.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.llm.common import batch_rows, checkpointed, removed, text_or_empty, written
from inkwell.operators.joins import heavy_keys, lookup


@dataclass(frozen=True)
class NearDuplicates:
    """k: words of a window; similarity: least edit similarity of the words; bands of rows sketch
    entries. An entry of two texts agrees about as often as the square of the share of windows that they
    have in common, so with 32 bands of 2 entries texts share a bucket with probability 0.9999 if this
    share is 0.7 (4 changes in 100 words spread evenly), 0.98 at 0.58, 0.87 at 0.5 (7 changes), and 0.23
    at 0.3. block: texts compared at a time; broadcast_rows: most keys that are sent to all executors.
    """

    k: int = 5
    similarity: float = 0.8
    bands: int = 32
    rows: int = 2
    block: int = 256
    broadcast_rows: int = 200_000
    seed: int = 11


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (a public finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words, remembered for the words of a batch."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > 500_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        return np.fromiter((known[w] for w in words), np.uint64, len(words))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of k words; a shorter text is one window, an empty one none."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(k, n)
    out = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        out = mixed(out * _MIX + hashes[i : n - size + 1 + i] + np.uint64(i + 1))
    return out


def labelled(grams: np.ndarray) -> np.ndarray:
    """Windows with their occurrence number, so that repeats differ."""
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    number = np.arange(len(grams)) - np.repeat(first, np.diff(np.append(first, len(grams))))
    out = grams.copy()
    out[order] = mixed(ranked + number.astype(np.uint64) * _MIX)
    return out


def sketch(grams: np.ndarray, functions: np.ndarray) -> np.ndarray:
    """One value per hash function: the two least labelled windows, in text order."""
    marked = labelled(grams)
    if len(marked) == 1:
        return mixed(marked ^ functions)
    first, second = np.empty_like(functions), np.empty_like(functions)
    hashed = np.empty_like(marked)
    for i, f in enumerate(functions):
        np.multiply(marked, f, out=hashed)
        a = int(hashed.argmin())
        least = hashed[a]
        hashed[a] = np.uint64(0xFFFFFFFFFFFFFFFF)
        b = int(hashed.argmin())
        first[i], second[i] = (least, hashed[b]) if a < b else (hashed[b], least)
    return mixed(first * np.uint64(3) + second)


def buckets(entries: np.ndarray, rows: int) -> np.ndarray:
    """One value per band."""
    out = np.zeros(len(entries) // rows, np.uint64)
    for i in range(rows):
        out = mixed(out * _MIX + entries[i::rows][: len(out)])
    return mixed(out + np.arange(len(out), dtype=np.uint64) * _MIX).view(np.int64)


def edit_distance(a: list, b: list, limit: int) -> int:
    """Levenshtein distance if at most ``limit``, else limit + 1.

    Works in a band of diagonals that widens by one with each edit: per diagonal the farthest
    place reached is kept, and equal stretches are skipped. This is quick for few edits; texts that need
    more than about the root of their length go on by columns.
    """
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return limit + 1

    def slide(i: int, j: int) -> int:
        while i + 32 <= n and j + 32 <= m and a[i : i + 32] == b[j : j + 32]:
            i, j = i + 32, j + 32
        while i < n and j < m and a[i] == b[j]:
            i, j = i + 1, j + 1
        return i

    reached = {0: slide(0, 0)}
    if n == m and reached[0] == n:
        return 0
    quick = math.isqrt(n + m)
    for d in range(1, limit + 1):
        if d > quick:
            return by_columns(a, b, limit)
        now = {}
        for diagonal in range(-d, d + 1):  # diagonal = place in b - place in a
            i = max(
                reached.get(diagonal, -2) + 1,
                reached.get(diagonal + 1, -2) + 1,
                reached.get(diagonal - 1, -1),
            )
            i = min(i, n, m - diagonal)
            if i < 0 or i + diagonal < 0:
                continue
            now[diagonal] = slide(i, i + diagonal)
            if diagonal == m - n and now[diagonal] == n:
                return d
        reached = now
    return limit + 1


def by_columns(a: list, b: list, limit: int) -> int:
    """Levenshtein distance if at most ``limit``, else limit + 1: a column of the alignment at a time.

    Neighbours in a column differ by one at most, so two sets of bits say where a column rises and
    falls, and a few operations on them give the next column. The last cell, less the columns to come,
    bounds the distance from below.
    """
    n, m = len(a), len(b)
    if not n:
        return min(m, limit + 1)
    places: dict = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    every = (1 << n) - 1
    last = 1 << n >> 1
    rises, falls, cell = every, 0, n
    for j, word in enumerate(b, 1):
        equal = places.get(word, 0)
        same = (((equal & rises) + rises ^ rises) | equal | falls) & every
        up = falls | (every & ~(same | rises))
        down = same & rises
        if up & last:
            cell += 1
        elif down & last:
            cell -= 1
        if cell - (m - j) > limit:
            return limit + 1
        up, down = (up << 1 | 1) & every, down << 1 & every
        rises = down | (every & ~(same | up))
        falls = up & same
    return cell if cell <= limit else limit + 1


def most_edits(a: int, b: int, least: float) -> int:
    """Edits that texts of so many words may differ in."""
    return int((1 - least) * max(a, b) + 1e-9)


def similar(a: list[bytes], b: list[bytes], ga: np.ndarray, gb: np.ndarray, least: float) -> bool:
    """Whether aligned words agree by ``least`` or more.

    ``ga`` and ``gb`` are the sorted words with their occurrence numbers. An edit takes away at most one
    word that both have, so texts that lack too many of them need no alignment.
    """
    limit = most_edits(len(a), len(b), least)
    if len(np.intersect1d(ga, gb, assume_unique=True)) < max(len(a), len(b), 1) - limit:
        return False
    return edit_distance(a, b, limit) <= limit


def word_bag(hashes: np.ndarray) -> np.ndarray:
    """Words labelled with their occurrence numbers, sorted."""
    return np.sort(labelled(hashes)) if len(hashes) else hashes


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def text_key():
    """What identifies a text: half its sha-256."""
    return F.unhex(F.substring(F.sha2(text_or_empty().cast("binary"), 256), 1, 32))


def key_of(text: str) -> bytes:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:16]


def hash_functions(settings: NearDuplicates) -> np.ndarray:
    """One odd factor per sketch entry."""
    return np.random.default_rng(settings.seed).integers(
        1 << 63, size=settings.bands * settings.rows, dtype=np.uint64
    ) * np.uint64(2) + np.uint64(1)


def sketched(documents: DataFrame, settings: NearDuplicates) -> DataFrame:
    """doc_id, key (of the text), number of words and bands of each row."""
    functions = hash_functions(settings)
    source = documents.select("doc_id", text_or_empty().alias("text"))
    schema = T.StructType([source.schema["doc_id"]]).add("key", "binary").add("words", "long")
    schema = schema.add("bands", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in batches:
            for batch in batch_rows(whole):
                keys, sizes, bands = [], [], []
                for text in batch.column("text").to_pylist():
                    keys.append(key_of(text))
                    words = hashes.of(words_of(text))
                    grams = windows(words, settings.k)
                    sizes.append(len(words))
                    bands.append(buckets(sketch(grams, functions), settings.rows) if len(grams) else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(keys, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "key", "words", "bands"],
                )

    return source.mapInArrow(run, schema)


def _sent(df: DataFrame, settings: NearDuplicates) -> DataFrame:
    """A table for the small side of a join: sent to all only when its measured size allows."""
    return F.broadcast(df) if df.count() <= settings.broadcast_rows else df


def texts_of(documents: DataFrame, keys: DataFrame, settings: NearDuplicates) -> DataFrame:
    """One row (key, text) for each of the keys. Tasks pass a text once, whatever its copies."""
    source = documents.select(text_or_empty().alias("text"))
    schema = T.StructType().add("key", "binary").add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for whole in batches:
            for batch in batch_rows(whole):
                keys, texts = [], []
                for text in batch.column("text").to_pylist():
                    key = key_of(text)
                    if key not in seen:
                        seen.add(key)
                        keys.append(key)
                        texts.append(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(texts, pa.string())], names=["key", "text"]
                )

    wanted = _sent(checkpointed(keys.select("key").distinct()), settings)
    return source.mapInArrow(run, schema).join(wanted, "key", "left_semi").dropDuplicates(["key"])


def verified(documents: DataFrame, pairs: DataFrame, settings: NearDuplicates) -> DataFrame:
    """The pairs (a, b) of keys whose texts are near-duplicates."""
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b"))
    texts = texts_of(documents, keys, settings)
    both = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        key, words, bag = None, [], np.array([], np.uint64)
        for whole in batches:
            for batch in batch_rows(whole):
                kept = []
                for i, b in enumerate(batch.column("b").to_pylist()):
                    if b != key:  # rows of one leader follow each other
                        key, words = b, words_of(batch.column("text_b")[i].as_py())
                        bag = word_bag(hashes.of(words))
                    own = words_of(batch.column("text_a")[i].as_py())
                    if similar(own, words, word_bag(hashes.of(own)), bag, settings.similarity):
                        kept.append(i)
                yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def shared_words(grams: list[np.ndarray]) -> np.ndarray:
    """How many words each two of the sets share: a product of matrices over those in several."""
    values, number, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    several = (count > 1)[number]
    row, column = row[several], (np.cumsum(count > 1) - 1)[number][several]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(grams), len(grams)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        part = np.zeros((len(grams), 4096), np.float32)
        part[row[a:b], column[a:b] - start] = 1
        shared += part @ part.T
    return shared


def block_links(table: pa.Table, settings: NearDuplicates) -> list[tuple[bytes, bytes]]:
    """Links between members of different components of a block, or of two blocks of a bucket.

    What a link joins is one component from then on, so its other pairs need no alignment.
    """
    keys, texts = table.column("key").to_pylist(), table.column("text").to_pylist()
    part, own = table.column("part").to_pylist(), table.column("component").to_pylist()
    two = len(set(part)) > 1
    hashes = WordHashes()
    words = [words_of(t) for t in texts]
    grams = [word_bag(hashes.of(w)) for w in words]
    size = np.array([len(w) for w in words])
    longer = np.maximum(size[:, None], size[None, :])
    near = shared_words(grams) >= longer - np.floor((1 - settings.similarity) * longer + 1e-9) - 1e-3
    top = {c: c for c in own}

    def root(c: bytes) -> bytes:
        while top[c] != c:
            top[c] = top[top[c]]
            c = top[c]
        return c

    links = []
    for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True):
        if two and part[i] == part[j]:
            continue
        a, b = root(own[i]), root(own[j])
        if a != b and similar(words[i], words[j], grams[i], grams[j], settings.similarity):
            top[max(a, b)] = min(a, b)
            links.append((keys[i], keys[j]))
    return links


def blocks(documents: DataFrame, members: DataFrame, settings: NearDuplicates) -> DataFrame:
    """Links (a, b) among the members (bucket, key, component) of buckets.

    A bucket is dealt into parts of about ``block`` texts; each part is compared with itself and
    with each other part, in a group of its own.
    """
    sizes = members.groupBy("bucket").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("parts"))
    texts = texts_of(documents, members, settings)
    dealt = members.join(sizes, "bucket").withColumn("part", F.pmod(F.hash("key"), F.col("parts")))
    groups = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "bucket", "key", "component", "part",
        F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
    )

    def compared(table: pa.Table) -> pa.Table:
        links = block_links(table, settings)
        return pa.table(
            {"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())}
        )

    return groups.join(texts, "key").groupBy("bucket", "low", "high").applyInArrow(compared, "a binary, b binary")


def star_round(edges: DataFrame) -> DataFrame:
    """Edges (a, b) after a large-star and a small-star step, which keep the components.

    The least neighbour comes from a window, so a step shuffles the edges once and joins nothing; what both
    steps give twice is dropped at the end.
    """

    def with_least(e: DataFrame) -> DataFrame:
        return e.withColumn("m", F.least("a", F.min("b").over(Window.partitionBy("a"))))

    both_ways = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = with_least(both_ways).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ends = F.explode(F.array("a", "b")).alias("a")
    return with_least(large).select(ends, F.col("m").alias("b")).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(key, component) for all ends of edges; the component is its least key.

    Rounds of :func:`star_round` until nothing changes. The edges are checkpointed in each round.
    """

    def state(e: DataFrame) -> tuple:
        row = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    edges = checkpointed(edges.where(F.col("a") != F.col("b")).distinct())
    before = state(edges)
    while before[0]:
        edges = checkpointed(star_round(edges))
        now = state(edges)
        if now == before:
            break
        before = now
    members = edges.select(F.col("a").alias("key"), F.col("b").alias("component"))
    return members.union(edges.select("b", "b").distinct())


def _with_component(df: DataFrame, of: DataFrame) -> DataFrame:
    return df.join(of, "key", "left").withColumn("component", F.coalesce("component", "key"))


def linked(documents: DataFrame, members: DataFrame, settings: NearDuplicates):
    """(key, component) of all texts with a near-duplicate; None if there are no links.

    First each member of a bucket meets the most central one. Buckets whose members are not in one
    component then are compared in blocks, without the leader, who has met them all.
    """
    links = found = None
    leaders = checkpointed(
        members.groupBy("bucket").agg(F.max(F.struct("central", "key", "words")).alias("leader"))
    )
    pairs = (
        members.join(leaders, "bucket")
        .where(F.col("key") != F.col("leader.key"))
        .where(
            F.least("words", "leader.words")
            >= settings.similarity * F.greatest("words", "leader.words") - 1e-6
        )
        .select(F.col("key").alias("a"), F.col("leader.key").alias("b"))
        .distinct()
    )
    pairs = checkpointed(pairs)
    if not pairs.isEmpty():
        links = checkpointed(verified(documents, pairs, settings))
        found = components(links)
    rest = members.select("bucket", "key")
    rest = rest.withColumn("component", F.col("key")) if found is None else _with_component(rest, found)
    led = leaders.select("bucket", F.col("leader.key").alias("leader"))
    rest = rest.join(led, "bucket").where(F.col("key") != F.col("leader"))
    open_ = rest.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rest = checkpointed(rest.join(open_.where("low != high").select("bucket"), "bucket").drop("leader"))
    if not rest.isEmpty():
        new = checkpointed(blocks(documents, rest, settings))
        links = new if links is None else links.union(new)
        found = components(links)
    return found


def classes(documents: DataFrame, settings: NearDuplicates | None = None) -> DataFrame:
    """One row per document: doc_id, key of its text, class_id, and the size of its class.

    Two texts that share a bucket are linked when their words have an edit similarity of 0.8 or more; a
    class is a connected group, with the least doc_id as its id. Equal texts are always in one class, so all null and empty texts
    are; texts of less than five words are one window. Rows without doc_id count as well; a class
    of such rows alone has a null id. Repeated rows come out repeatedly. An empty table has no
    classes. Other columns of ``documents`` do not matter.
    """
    settings = settings or NearDuplicates()
    rows, _ = written(sketched(documents, settings), "omh-sketches")
    flat = rows.select("key", "words", F.explode("bands").alias("bucket")).distinct()
    sizes = flat.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = checkpointed(flat.join(sizes, "bucket"))
    central = shared.groupBy("key").agg(F.sum("size").alias("central"))
    members, members_path = written(
        shared.join(central, "key").select("bucket", "key", "words", "central"), "omh-buckets"
    )
    found = linked(documents, members, settings)
    removed(documents.sparkSession, members_path)
    own = rows.select("doc_id", "key")
    # One row per text first: copies of a text, however many, are reduced before anything is joined.
    texts = own.groupBy("key").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"))
    texts = texts.withColumn("component", F.col("key")) if found is None else _with_component(texts, found)
    groups = texts.groupBy("component").agg(
        F.min("low").alias("class_id"), F.sum("copies").alias("class_size")
    )
    told = lookup(texts.select("key", "component"), groups, "component", ["key"], heavy_keys(texts, "component"))
    return lookup(own, told, "key", ["doc_id"], heavy_keys(own, "key")).select(
        "doc_id", "key", "component", "class_id", "class_size"
    )


def without_near_duplicates(documents: DataFrame, settings: NearDuplicates | None = None) -> DataFrame:
    """One document of each class stays: the one with the least doc_id (null last), then the least
    text key. Of repeated rows with this id and text one stays, by the order of the other columns.
    """
    found = checkpointed(classes(documents, settings))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("best")
    kept = found.groupBy("component").agg(best).select("best.doc_id", "best.key")
    repeated = (
        found.groupBy("doc_id", "key").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "key")
    )
    with_key = documents.withColumn("_key", text_key())

    def among(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        ids = ids.select(F.col("doc_id").alias("_id"), F.col("key").alias("_k"))
        return rows.join(ids, (F.col("_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_id")), how)

    stay = among(with_key, kept, "left_semi")
    if not repeated.isEmpty():
        others = [c for c in documents.columns if c not in ("doc_id", "text")]
        order = Window.partitionBy("doc_id", "_key").orderBy(*others or [F.lit(0)])
        stay = stay.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    return stay.drop("_key")
