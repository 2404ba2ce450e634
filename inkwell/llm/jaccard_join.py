"""Join of documents whose sets of word n-grams are alike, by combinations of prefix tokens.

The tokens of a set, its n-grams, are ordered from rare to frequent. Two sets that are alike differ in
few tokens, so they share one of the first few of each. Rare tokens are indexed singly. A frequent token
alone would bring together many sets that have nothing else in common, so tokens of a frequent class
are indexed as combinations of k within small sub-classes, and the prefix is extended until losing
every combination would take more differing tokens than two sets that are alike can have. Whatever meets
is verified on the exact sets.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.llm.common import batch_rows, checkpointed, removed, text_or_empty, written
from inkwell.llm.order_minhash import components, mixed, text_key
from inkwell.operators.joins import heavy_keys, lookup


@dataclass(frozen=True)
class JaccardJoin:
    """n: words of a token; percent: least Jaccard similarity; classes: the least document frequency of
    the tokens that are indexed as pairs, as triples and so on; table: tokens of the frequency table,
    the most frequent ones, which is sent to all tasks (12 bytes each) and bounds what is called
    frequent, never what is found; spread: tokens of a set in a sub-class, about; held: tokens that a
    task counts at a time; block: sets of a list that are compared with each other at a time;
    broadcast_rows: most keys sent to all tasks.
    """

    n: int = 3
    percent: int = 90
    classes: tuple[int, ...] = (32, 1024)
    table: int = 1 << 20
    spread: int = 3
    held: int = 2_000_000
    block: int = 256
    broadcast_rows: int = 100_000


def least_common(size: int, percent: int) -> int:
    """Tokens that a set of this size shares with any set it is linked with, at least."""
    return -(-size * percent // 100)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


class WordHashes(dict):
    """64-bit hashes of the words met so far, worked out on first sight."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


_PLACES = np.random.default_rng(5).integers(1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def token_set(text: bytes, hashes: WordHashes, n: int) -> np.ndarray:
    """Distinct tokens in the order of their hashes; ``text`` is UTF-8. A-Z are lower-cased.

    A text of fewer words is one token, an empty one none.
    """
    words = text.lower().split()
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(n, len(own))
    if not size:
        return own
    count = len(own) - size + 1
    out = np.full(count, size, np.uint64)
    for i in range(size):
        out += own[i : i + count] * _PLACES[i % 64]
    out = mixed(out)
    out.sort()
    return out[np.append(True, out[1:] != out[:-1])]


def set_key(tokens: np.ndarray) -> bytes:
    return hashlib.sha256(tokens.tobytes()).digest()[:16]


def size_band(size: int) -> int:
    return size.bit_length()


def _salt(band: int) -> np.uint64:
    return np.uint64(band * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


def _singles(tokens: np.ndarray, band: int) -> np.ndarray:
    return mixed(tokens ^ _salt(band)).view(np.int64)


def signatures(tokens: np.ndarray, k: np.ndarray, band: int, percent: int, spread: int) -> list[int]:
    """The signatures of a set among sets of a size band: hashes of combinations of its prefix.

    ``k`` is the class of each token: how many are combined. The order of tokens is by class, then by
    sub-class, then by hash; with the band it depends on the token alone. A sub-class of c tokens in
    the prefix loses all its combinations only if c - k + 1 of them differ; the prefix ends when these
    add up to more than the set may differ in.
    """
    size = len(tokens)
    need = size - least_common(size, percent) + 1
    parts = max(1, (1 << band) // (2 * spread))
    salt = _salt(band)
    rare = k == 1
    found = tokens[rare][:need]
    out = _singles(found, band).tolist()
    covered = len(found)
    if covered >= need:
        return out
    for c in np.unique(k[~rare]):
        own = tokens[k == c]
        part = (mixed(own ^ salt) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((own, part))
        own, part = own[order], part[order]
        heads = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(own))
        for a, b in itertools.pairwise(heads.tolist()):
            # Only as many of the sub-class as are still needed.
            last = min(b, a + int(c) - 1 + need - covered)
            if last - a < c:
                continue
            for combo in itertools.combinations(own[a:last].tolist(), int(c)):
                value = int(c) + band
                for t in combo:
                    value = (value * 0x9E3779B97F4A7C15 + t) & 0xFFFFFFFFFFFFFFFF
                    value ^= value >> 29
                out.append(value - (1 << 64) if value >> 63 else value)
            covered += last - a - int(c) + 1
            if covered >= need:
                return out
    # Not enough tokens for a cover by combinations: the frequent ones stand alone.
    return out + mixed(tokens[~rare] ^ ~salt).view(np.int64).tolist()


def frequent(documents: DataFrame, settings: JaccardJoin) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens (the leading 40 bits of their hashes, sorted) and their classes.

    All tokens of all documents are counted. Tasks add up what they hold before they hand it on, in
    buckets by hash whose number grows with the text, so that a bucket has a few million tokens.
    """
    source = documents.select(text_or_empty().alias("text"))
    size = source.agg(F.sum(F.octet_length("text").cast("decimal(38,0)"))).first()[0] or 0
    bits = min(32, max(8, (int(size) // 6 // (1 << 22)).bit_length()))
    rest = np.uint64(40 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, gathered = WordHashes(), 0, []

        def out() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(gathered) >> np.uint64(24), return_counts=True)
            low = (tokens & ((np.uint64(1) << rest) - np.uint64(1))).astype("<u4")
            once = counts == 1
            buckets, heads = np.unique(tokens >> rest, return_index=True)
            rows = [
                (low[a:b][once[a:b]].tobytes(), low[a:b][~once[a:b]].tobytes(), counts[a:b][~once[a:b]].astype("<u4").tobytes())
                for a, b in itertools.pairwise([*heads.tolist(), len(tokens)])
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(buckets.astype(np.int64)), *[pa.array([r[i] for r in rows], pa.binary()) for i in range(3)]],
                names=["bucket", "once", "more", "times"],
            )

        for whole in batches:
            for batch in batch_rows(whole):
                for text in batch.column("text"):
                    tokens = token_set(text.as_buffer().to_pybytes(), hashes, settings.n)
                    gathered.append(tokens)
                    held += len(tokens)
                if held >= settings.held:
                    yield out()
                    held, gathered = 0, []
        if gathered:
            yield out()

    def counted(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b, "<u4") for b in table.column("once").to_pylist()]
        counts = [np.ones(len(p), np.int64) for p in parts]
        parts += [np.frombuffer(b, "<u4") for b in table.column("more").to_pylist()]
        counts += [np.frombuffer(b, "<u4").astype(np.int64) for b in table.column("times").to_pylist()]
        tokens, number = np.unique(np.concatenate(parts), return_inverse=True)
        # Whole numbers below 2 ** 53, so the sums are exact.
        total = np.bincount(number, np.concatenate(counts), len(tokens)).astype(np.int64)
        kept = total >= settings.classes[0]
        high = np.uint64(table.column("bucket")[0].as_py()) << rest
        values = (tokens[kept].astype(np.uint64) | high).astype(np.int64)
        return pa.table({"token": values, "df": total[kept]})

    counts = source.mapInArrow(run, "bucket long, once binary, more binary, times binary")
    found = counts.groupBy("bucket").applyInArrow(counted, "token long, df long")
    top = found.orderBy(F.desc("df"), "token").limit(settings.table).toArrow()
    tokens, df = top.column("token").to_numpy(), top.column("df").to_numpy()
    order = np.argsort(tokens)
    k = 1 + np.searchsorted(np.array(settings.classes), df[order], side="right")
    return tokens[order].astype(np.uint64), k.astype(np.int8)


def class_of(tokens: np.ndarray, table: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """1 for tokens that are not in the table of frequent ones."""
    if not len(table):
        return np.ones(len(tokens), np.int8)
    high = tokens >> np.uint64(24)
    at = np.minimum(np.searchsorted(table, high), len(table) - 1)
    return np.where(table[at] == high, classes[at], np.int8(1))


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Parities of the tokens in classes by hash, a bit or more for each token, in 64-bit words.

    Each token that two sets differ in changes one bit, so sets whose bitmaps differ in more bits than
    sets that are alike can differ in tokens are not alike.
    """
    words = max(8, 1 << ((len(tokens) - 1) >> 6).bit_length())
    at = (tokens >> np.uint64(7)) & np.uint64(64 * words - 1)
    odd = np.bincount(at.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def narrowed(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap of the same set with fewer words, without signs, as bits are counted."""
    bits = bits.view(np.uint64)
    while len(bits) > words:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def may_be_alike(a_size, b_size, differing, percent: int):
    """Whether sizes and the differing bits of bitmaps leave room for a link; also for arrays."""
    return (100 + percent) * differing <= (100 - percent) * (a_size + b_size)


def own_lists(tokens: np.ndarray, table: np.ndarray, classes: np.ndarray, settings: JaccardJoin) -> list[int]:
    """The signatures of a set in its size band, and in the one below where sets of it may be alike."""
    bands = {size_band(len(tokens)), size_band(least_common(len(tokens), settings.percent))}
    need = len(tokens) - least_common(len(tokens), settings.percent) + 1
    # Rare tokens come first, so mostly a few of the least hashes are all that has to be looked up.
    first = tokens[: 2 * need + 8]
    k = class_of(first, table, classes)
    if np.count_nonzero(k == 1) < need:
        first, k = tokens, class_of(tokens, table, classes)
        return [x for b in bands for x in signatures(first, k, b, settings.percent, settings.spread)]
    rare = first[k == 1][:need]
    return [x for b in bands for x in _singles(rare, b).tolist()]


def sketched(documents: DataFrame, settings: JaccardJoin) -> DataFrame:
    """One row per document: doc_id, key (of its set), text_key, size, bits and signatures.

    The bitmap and the signatures come with the first copy of a set in a task only.
    """
    table, classes = frequent(documents, settings)
    shared = documents.sparkSession.sparkContext.broadcast((table, classes))
    source = documents.select("doc_id", text_or_empty().alias("text"))
    schema = T.StructType([source.schema["doc_id"]]).add("key", "binary").add("text_key", "binary")
    schema = schema.add("size", "long").add("bits", T.ArrayType(T.LongType())).add("lists", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (table, classes) = WordHashes(), shared.value
        known: set[bytes] = set()
        for whole in batches:
            for batch in batch_rows(whole):
                keys, texts, sizes, bits, lists = [], [], [], [], []
                for text in batch.column("text"):
                    raw = text.as_buffer().to_pybytes()
                    tokens = token_set(raw, hashes, settings.n)
                    keys.append(key := set_key(tokens))
                    texts.append(hashlib.sha256(raw).digest()[:16])
                    sizes.append(len(tokens))
                    if not len(tokens) or key in known:
                        bits.append(None)
                        lists.append(None)
                        continue
                    known.add(key)
                    bits.append(bitmap(tokens))
                    lists.append(own_lists(tokens, table, classes, settings))
                if len(known) > 1_000_000:
                    known.clear()
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(texts, pa.binary()),
                        pa.array(sizes, pa.int64()), pa.array(bits, kind), pa.array(lists, kind),
                    ],
                    names=["doc_id", "key", "text_key", "size", "bits", "lists"],
                )

    return source.mapInArrow(run, schema)


def allowed(pairs: DataFrame, nodes: DataFrame, settings: JaccardJoin) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps do not rule out. Both rules lose no link."""
    percent = settings.percent
    for column in ("size", "bits"):
        for side in "ab":
            own = nodes.select(F.col("node").alias(side), F.col(column).alias(f"{side}_{column}"))
            pairs = pairs.join(own, side)
        if column == "size":
            a, b = F.col("a_size"), F.col("b_size")
            pairs = pairs.where(percent * F.greatest(a, b) <= 100 * F.least(a, b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (_Lists(batch.column(f"{side}_bits")) for side in "ab")
            differing = np.zeros(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                x, y = a[i], b[i]
                words = min(len(x), len(y))
                differing[i] = np.bitwise_count(narrowed(x, words) ^ narrowed(y, words)).sum()
            sizes = (batch.column(f"{side}_size").to_numpy() for side in "ab")
            kept = np.flatnonzero(may_be_alike(*sizes, differing, percent))
            yield batch.select(["a", "b"]).take(pa.array(kept))

    return pairs.select("a", "b", "a_size", "b_size", "a_bits", "b_bits").mapInArrow(run, "a long, b long")


class _Lists:
    """The rows of an Arrow column of lists of numbers, without copies."""

    def __init__(self, column: pa.ListArray):
        self.ends, self.values = column.offsets.to_numpy(), column.values.to_numpy()

    def __getitem__(self, i: int) -> np.ndarray:
        return self.values[self.ends[i] : self.ends[i + 1]]


def verified(documents: DataFrame, pairs: DataFrame, nodes: DataFrame, settings: JaccardJoin) -> DataFrame:
    """The pairs (a, b) whose exact sets are alike, from the texts of one document each."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = checkpointed(ends.join(nodes, "node").select("node", F.col("text_key").alias("_key")))
    wanted = F.broadcast(wanted) if wanted.count() <= settings.broadcast_rows else wanted
    texts = documents.select(text_or_empty().alias("text")).withColumn("_key", text_key())
    texts = texts.join(wanted, "_key").dropDuplicates(["node"]).select("node", "text")
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, node, tokens = WordHashes(), None, None
        for whole in batches:
            for batch in batch_rows(whole):
                kept = []
                for i, b in enumerate(batch.column("b").to_pylist()):
                    if b != node:  # rows of one node follow each other
                        node = b
                        tokens = token_set(batch.column("text_b")[i].as_buffer().to_pybytes(), hashes, settings.n)
                    own = token_set(batch.column("text_a")[i].as_buffer().to_pybytes(), hashes, settings.n)
                    if alike(own, tokens, settings.percent):
                        kept.append(i)
                yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _labelled(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """``rows`` with the component of their node, which is the node itself where nothing is linked."""
    if found is None:
        return rows.withColumn("component", F.col("node"))
    joined = rows.join(found.withColumnRenamed("key", "node"), "node", "left")
    return joined.withColumn("component", F.coalesce("component", "node"))


def _open(rows: DataFrame) -> DataFrame:
    """The rows of lists whose members are not all in one component."""
    own = Window.partitionBy("list")
    spans = rows.withColumn("_low", F.min("component").over(own)).withColumn("_high", F.max("component").over(own))
    return spans.where("_low != _high").drop("_low", "_high")


def block_pairs(members: DataFrame, nodes: DataFrame, settings: JaccardJoin) -> DataFrame:
    """Pairs (a, b) of different components in the same list that sizes and bitmaps allow.

    A list is dealt into parts of about ``block`` members; a row holds two parts, and a task compares
    their bitmaps. What comes out are pairs that most likely are links, not the pairs of a list.
    """
    sizes = members.groupBy("list").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("parts"))
    dealt = members.join(sizes, "list").join(nodes.select("node", "size", "bits"), "node")
    dealt = dealt.withColumn("part", F.pmod(F.hash("node"), F.col("parts")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = dealt.groupBy("list", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")).agg(
        F.collect_list(F.struct("node", "component", "part", "size", "bits")).alias("members")
    )
    percent = settings.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_a, out_b = [], []
            lists = batch.column("members")
            flat, ends = lists.flatten(), lists.offsets.to_numpy()
            ends = ends - ends[0]
            node, component, part, size = (
                flat.field(c).to_numpy(zero_copy_only=False) for c in ("node", "component", "part", "size")
            )
            bits = _Lists(flat.field("bits"))
            for x, y in itertools.pairwise(ends.tolist()):
                i, j = np.triu_indices(y - x, 1)
                i, j = i + x, j + x
                open_ = component[i] != component[j]
                if part[x:y].min() != part[x:y].max():
                    open_ &= part[i] != part[j]
                open_ &= percent * np.maximum(size[i], size[j]) <= 100 * np.minimum(size[i], size[j])
                i, j = i[open_], j[open_]
                if not len(i):
                    continue
                words = min(len(bits[m]) for m in range(x, y))
                own = np.stack([narrowed(bits[m], words) for m in range(x, y)])
                differing = np.bitwise_count(own[i - x] ^ own[j - x]).sum(axis=1, dtype=np.int64)
                near = may_be_alike(size[i], size[j], differing, percent)
                out_a.append(np.maximum(node[i[near]], node[j[near]]))
                out_b.append(np.minimum(node[i[near]], node[j[near]]))
            if out_a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"]
                )

    return rows.select("members").mapInArrow(run, "a long, b long").distinct()


def linked(documents: DataFrame, members: DataFrame, nodes: DataFrame, settings: JaccardJoin):
    """(links, components) of the nodes in the lists (list, node, size of the list); None without links.

    First each member of a list meets the most central one, which shares most with the others of its
    lists, so that groups of sets that are alike cost a linear number of comparisons. Lists whose
    members are not all in one component then are compared in blocks, without the leader, who has met
    all the others.
    """
    ranked = members.join(members.groupBy("node").agg(F.sum("size").alias("central")), "node")
    leader = F.max(F.struct("central", "node")).over(Window.partitionBy("list"))
    led = checkpointed(ranked.select("list", "node", leader["node"].alias("leader")).where("node != leader"))

    def verify(pairs: DataFrame) -> DataFrame | None:
        pairs = checkpointed(pairs)
        return None if pairs.isEmpty() else checkpointed(verified(documents, pairs, nodes, settings))

    links = verify(allowed(led.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct(), nodes, settings))
    found = None if links is None else components(links)
    rest = checkpointed(_open(_labelled(led.select("list", "node"), found)))
    new = None if rest.isEmpty() else verify(block_pairs(rest, nodes, settings))
    if new is not None:
        links = new if links is None else links.union(new)
        found = components(links)
    return links, found


def classes(documents: DataFrame, settings: JaccardJoin | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles (size of its set) and component_id.

    Documents are linked when the Jaccard similarity of their sets of distinct n-grams of words is
    ``percent`` or more; the component of a document is the least doc_id that links lead to, its own
    included. A text with fewer words than n is one token; null, empty and blank texts are empty sets,
    which are linked with nothing. Rows are the documents: repeated rows come out repeatedly, rows
    that share a doc_id may be in different components, and components of rows without doc_id have a
    null id. Texts of any length count whole. An empty table gives no rows; other columns of
    ``documents`` do not matter. For the links themselves see :func:`linked`.
    """
    settings = settings or JaccardJoin()
    rows, _ = written(
        sketched(documents, settings).withColumn("row", F.monotonically_increasing_id()), "jaccard-rows"
    )
    # One row per set stands for all of its copies: the first that has its signatures.
    sets = rows.where(F.col("lists").isNotNull())
    first = F.row_number().over(Window.partitionBy("key").orderBy("row"))
    reps, reps_path = written(
        sets.withColumn("_n", first).where("_n = 1").select(F.col("row").alias("node"), "key", "text_key", "size", "bits", "lists"),
        "jaccard-sets",
    )
    flat = reps.select("node", F.explode(F.array_distinct("lists")).alias("list"))
    members, members_path = written(
        flat.withColumn("size", F.count("*").over(Window.partitionBy("list"))).where("size > 1"),
        "jaccard-lists",
    )
    nodes = reps.select("node", "text_key", "size", "bits")
    _, found = linked(documents, members, nodes, settings)
    spark = documents.sparkSession
    own = rows.where("size > 0").groupBy("key").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"))
    labelled = _labelled(reps.select("node", "key"), found).join(own, "key")
    least = labelled.groupBy("component").agg(F.min("low").alias("component_id"), F.sum("copies").alias("members"))
    least = least.where("members > 1")
    labelled = labelled.join(least.select("component"), "component", "left_semi")
    ids, _ = written(
        lookup(
            labelled, least.select("component", "component_id"), "component", ["node"], heavy_keys(labelled, "component")
        ).select("key", "component_id"),
        "jaccard-classes",
    )
    removed(spark, reps_path, members_path)
    told = lookup(rows.select("doc_id", "key", "size", "row"), ids.withColumn("_met", F.lit(True)), "key", ["row"],
                  heavy_keys(rows, "key"))
    alone = F.when(F.col("_met"), F.col("component_id")).otherwise(F.col("doc_id"))
    return told.select("doc_id", F.col("size").alias("n_shingles"), alone.alias("component_id"))
