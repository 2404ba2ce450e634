"""Merkle manifest of a dataset with octopus multiproofs.

Every row is a leaf; the leaves of a group (one language, say) form a tree in the order of their
keys, and the roots of all groups form a tree on top. Subtrees of a few thousand nodes are reduced in
one task each, so a tree of any size takes a handful of rounds. A proof is computed for a partition of
leaves at a time: the partition names the least union of nodes that it lacks, these are fetched once,
the interior nodes above its leaves are derived from both, and the proof of each leaf is read off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.llm.common import written

STEP = T.StructType().add("left", "string").add("right", "string")


@dataclass(frozen=True)
class Manifest:
    """levels: levels of a subtree that one task reduces; leaves: leaves of a proof partition;
    requests: partitions that ask for the same copy of a node."""

    levels: int = 12
    leaves: int = 10_000
    requests: int = 64


def encoded(values: Sequence[Column]) -> Column:
    """The values one after another, each as its count of UTF-8 bytes, a colon and itself, or ``-``."""
    texts = [v.cast("string") for v in values]
    return F.concat(
        *[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    )


def digest(values: Sequence[Column]) -> Column:
    return F.sha2(encoded(values).cast("binary"), 256)


def hashed(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(size: int) -> int:
    """Levels above the leaves of a tree."""
    return (size - 1).bit_length()


def missing(indices: Iterable[int], size: int) -> list[tuple[int, int]]:
    """The least set of (level, index) from which, with the given leaves, all nodes above them follow."""
    out, level, known = [], 0, sorted(set(indices))
    while size > 1:
        have = set(known)
        out += [(level, i ^ 1) for i in known if i ^ 1 < size and i ^ 1 not in have]
        known = sorted({i >> 1 for i in known})
        level, size = level + 1, (size + 1) >> 1
    return out


def numbered(rows: DataFrame, by: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with their ``index`` in the order of ``order`` within ``by``, the ``size`` of the group and
    the ``group`` number in the order of ``by`` (nulls first, then by UTF-8 bytes).

    Rows are sorted over all tasks by range; what meets in one task are counts per partition.
    """
    placed = rows.repartitionByRange(by, *order).sortWithinPartitions(by, *order)
    placed, _ = written(placed.withColumn("_at", F.monotonically_increasing_id()), "merkle-leaves")
    part = F.shiftright("_at", 33).alias("_part")
    parts = placed.groupBy(by, part).agg(F.min("_at").alias("_low"), F.count("*").alias("_n"))
    sizes = placed.groupBy(by).agg(F.count("*").alias("size"))
    # Groups per range partition, summed up over the partitions that come before.
    first = parts.groupBy(by).agg(F.min("_part").alias("_part"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    told = first.groupBy("_part").agg(F.count("*").alias("_groups")).withColumn(
        "_earlier", F.coalesce(F.sum("_groups").over(before), F.lit(0))
    )
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(by)) - 1
    groups = first.withColumn("_rank", rank).join(told, "_part").select(
        F.col(by).alias("_by"), (F.col("_rank") + F.col("_earlier")).cast("long").alias("group")
    )
    own = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_start", F.coalesce(F.sum("_n").over(own), F.lit(0)))
    starts = starts.join(groups, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
    starts = starts.join(
        sizes.select(F.col(by).alias("_by"), "size"), F.col(by).eqNullSafe(F.col("_by"))
    ).select(F.col("_by"), F.col("_part").alias("_p"), "_low", "_start", "group", "size")
    same = (F.shiftright("_at", 33) == F.col("_p")) & F.col(by).eqNullSafe(F.col("_by"))
    index = (F.col("_at") - F.col("_low") + F.col("_start")).alias("index")
    return placed.join(starts, same).select(*rows.columns, "group", index, "size")


def _reduction(base: int, levels: int):
    return lambda table: _reduced(table, base, levels)


def _reduced(table: pa.Table, base: int, levels: int) -> pa.Table:
    """All nodes of one subtree above the given nodes of level ``base``."""
    tree, size = table.column("tree")[0].as_py(), table.column("size")[0].as_py()
    rows = sorted(zip(table.column("index").to_pylist(), table.column("hash").to_pylist(), strict=True))
    at, hashes = rows[0][0], [h.hex() for _, h in rows]
    out_level, out_index, out_hash = [], [], []
    for level in range(base + 1, min(base + levels, height(size)) + 1):
        at >>= 1
        hashes = [hashed(*hashes[i : i + 2]) for i in range(0, len(hashes), 2)]
        out_level += [level] * len(hashes)
        out_index += range(at, at + len(hashes))
        out_hash += map(bytes.fromhex, hashes)
    n = len(out_level)
    return pa.table(
        {
            "tree": pa.array([tree] * n, pa.int64()),
            "size": pa.array([size] * n, pa.int64()),
            "level": pa.array(out_level, pa.int32()),
            "index": pa.array(out_index, pa.int64()),
            "hash": pa.array(out_hash, pa.binary()),
        }
    )


NODES = "tree long, size long, level int, index long, hash binary"


def forest(leaves: DataFrame, settings: Manifest) -> DataFrame:
    """All nodes (tree, size, level, index, hash) of the trees over the leaves (tree, size, index, hash).

    Each round reduces aligned runs of 2 ** ``levels`` nodes, one group each, and writes what it made;
    the next round starts from its top level. Only the greatest size is brought to the driver.
    """
    level = leaves.select("tree", "size", F.lit(0).alias("level"), "index", "hash")
    nodes, base = level, 0
    top = height(leaves.agg(F.max("size")).first()[0] or 1)
    while base < top:
        run = F.shiftright("index", settings.levels).alias("run")
        # A tree whose root is below has nothing to add.
        open_ = level.where(F.col("size") > F.lit(1 << base).cast("long"))
        made = open_.groupBy("tree", run).applyInArrow(_reduction(base, settings.levels), NODES)
        made, _ = written(made, "merkle-nodes")
        nodes = nodes.union(made)
        base += settings.levels
        level = made.where(F.col("level") == base)
    return nodes


def roots(nodes: DataFrame) -> DataFrame:
    """(tree, root) of each tree: the node at its height."""
    bits = F.length(F.bin(F.col("size") - 1))
    tall = F.when(F.col("size") == 1, F.lit(0)).otherwise(bits)
    return nodes.where(F.col("level") == tall).select("tree", F.col("hash").alias("root"))


def proofs(leaves: DataFrame, nodes: DataFrame, settings: Manifest) -> DataFrame:
    """The leaves (tree, size, index, hash, other columns) with ``steps`` up to the root of their tree, and
    with their proof partition, ``chunk``.

    A step has the sibling to the left or to the right, or neither where a node is alone. ``leaves`` may
    be any part of the leaves of the trees.
    """
    chunked = leaves.withColumn("chunk", F.floor(F.col("index") / settings.leaves))

    def wanted(table: pa.Table) -> pa.Table:
        tree, chunk = table.column("tree")[0].as_py(), table.column("chunk")[0].as_py()
        found = missing(table.column("index").to_pylist(), table.column("size")[0].as_py())
        n = len(found)
        return pa.table(
            {
                "tree": pa.array([tree] * n, pa.int64()),
                "chunk": pa.array([chunk] * n, pa.int64()),
                "level": pa.array([level for level, _ in found], pa.int32()),
                "index": pa.array([i for _, i in found], pa.int64()),
            }
        )

    asked = (
        chunked.select("tree", "size", "index", "chunk")
        .groupBy("tree", "chunk")
        .applyInArrow(wanted, "tree long, chunk long, level int, index long")
    )
    # A node stands for 2 ** level leaves, and only partitions of the subtree beside it ask for it, so its
    # level tells how many copies keep the requests of each copy few.
    per_copy = settings.leaves * settings.requests
    copies = F.greatest(F.lit(1).cast("long"), F.floor(F.pow(F.lit(2.0), "level") / per_copy).cast("long"))
    asked = asked.withColumn("copy", F.pmod("chunk", copies))
    stored = nodes.select("tree", "level", "index", "hash", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("copy"))
    fetched = asked.join(stored, ["tree", "level", "index", "copy"]).drop("copy")

    def expanded(own: pa.Table, more: pa.Table) -> pa.Table:
        size = own.column("size")[0].as_py()
        indices = own.column("index").to_pylist()
        known = {(0, i): h.hex() for i, h in zip(indices, own.column("hash").to_pylist(), strict=True)}
        for level, i, h in zip(
            more.column("level").to_pylist(), more.column("index").to_pylist(),
            more.column("hash").to_pylist(), strict=True,
        ):
            known[level, i] = h.hex()
        here, width = sorted(set(indices)), size
        widths = []
        while width > 1:
            level = len(widths)
            widths.append(width)
            for i in sorted({i >> 1 for i in here}):
                pair = [known[level, j] for j in (2 * i, 2 * i + 1) if j < width]
                known[level + 1, i] = hashed(*pair)
            here, width = sorted({i >> 1 for i in here}), (width + 1) >> 1
        steps = []
        for i in indices:
            path = []
            for level, width in enumerate(widths):
                j = i >> level
                if j & 1:
                    path.append({"left": known[level, j - 1], "right": None})
                else:
                    path.append({"left": None, "right": known[level, j + 1] if j + 1 < width else None})
            steps.append(path)
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        return own.append_column("steps", pa.array(steps, kind))

    schema = T.StructType([*chunked.schema.fields]).add("steps", T.ArrayType(STEP))
    return (
        chunked.groupBy("tree", "chunk")
        .cogroup(fetched.groupBy("tree", "chunk"))
        .applyInArrow(expanded, schema)
    )


def manifest(leaves: DataFrame, by: str, order: Sequence[str], settings: Manifest | None = None) -> DataFrame:
    """``leaves`` with the ``subroot`` of their group, the ``root`` of all, and ``steps``, their proof.

    ``leaves`` has a hex digest in ``leaf``; its other columns are handed through. Groups are the values
    of ``by`` (null is one, and the first); leaves stand in the order of ``order`` and then of their
    digests, so ties and repeated rows have a defined result: equal rows are leaves beside each other.
    An empty table has no leaves and no roots. Leaf texts of any length count, as only digests travel.
    """
    settings = settings or Manifest()
    kept = [F.col(c) for c in leaves.columns]
    own = F.struct(*kept).alias("row")
    flat = leaves.select(F.col(by).alias("_tree"), *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)],
                         F.unhex("leaf").alias("hash"), own)
    placed = numbered(flat, "_tree", [f"_order{i}" for i in range(len(order))] + ["hash"])
    placed = placed.select(F.col("group").alias("tree"), "size", "index", "hash", "row")
    nodes = forest(placed, settings)
    subroots, _ = written(roots(nodes), "merkle-subroots")
    groups = F.lit(subroots.count())
    top = subroots.select(
        F.lit(-1).cast("long").alias("tree"), groups.alias("size"), F.col("tree").alias("index"),
        F.col("root").alias("hash"),
    )
    top_nodes = forest(top, settings)
    root = roots(top_nodes).first()
    crown = proofs(top, top_nodes, settings).select(
        F.col("index").alias("tree"), F.col("steps").alias("top"), F.lower(F.hex("hash")).alias("subroot"),
        F.lit(root.root.hex() if root else None).alias("root"),
    )
    # One large tree has many partitions; its row is there once for each few of them.
    copies = F.greatest(
        F.lit(1).cast("long"), F.floor(F.col("size") / (settings.leaves * settings.requests))
    )
    sized = placed.where(F.col("index") == 0).select("tree", "size")
    crown = crown.join(sized, "tree").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    steps = proofs(placed, nodes, settings).withColumn("copy", F.pmod("chunk", copies))
    return steps.join(crown.drop("size"), ["tree", "copy"]).select(
        "row.*", "subroot", "root", F.concat("steps", "top").alias("steps")
    )


def folded(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and the steps of its proof."""

    def up(node: Column, step: Column) -> Column:
        both = F.concat(F.coalesce(step["left"], F.lit("")), node, F.coalesce(step["right"], F.lit("")))
        return F.sha2(both.cast("binary"), 256)

    return F.aggregate(steps, leaf, up)


def siblings(steps: Column) -> Column:
    """All digests of a proof, from the leaf upwards, as one text."""
    return F.array_join(F.transform(steps, lambda s: F.concat_ws("", s["left"], s["right"])), "")
