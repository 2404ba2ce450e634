"""Divergence audit, n-gram join and Merkle manifest against plain versions over small tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.llm import jaccard_join, merkle_manifest, source_divergence
from tests.llm.rows import SCHEMA, awkward, prose

AWKWARD = SCHEMA + ", leaf string, term string, list string, steps string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "x", "y", "z", "s") for r in rows], AWKWARD)


# Source divergence


def expected_audit(rows, least=3, top=200):
    terms = [
        (r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate(LOWER)))
        for r in rows
    ]
    out = collections.Counter()
    for lang in {t[0] for t in terms}:
        own = [t for t in terms if t[0] == lang]
        docs = collections.Counter(w for t in own for w in set(t[2]))
        kept = sorted(w for w, n in docs.items() if n >= least)
        sources = sorted({t[1] for t in own})
        counts = {s: collections.Counter(w for t in own if t[1] == s for w in t[2] if docs[w] >= least) for s in sources}
        whole = sum(counts.values(), collections.Counter())

        def share(c, w):
            return 1 + 1_000_000_000 * (c[w] + 1) // (sum(c.values()) + len(kept))

        for s in sources:
            pairs = [
                (o, sum((share(counts[s], w) - share(counts[o], w)) ** 2 // share(counts[o], w) for w in kept))
                for o in sources if o != s
            ]
            more = []
            for w in kept:
                p, q = share(counts[s], w), share(whole, w)
                if counts[s][w] and p > q:
                    more.append((w, (p - q) ** 2 // q))
            for part, items in (("pair", pairs), ("term", more)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(items, 1):
                    if part == "pair" or rank <= top:
                        out[lang, s, part, item, value, rank] += 1
    return out


LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def audited(df, **more):
    return collections.Counter(tuple(r) for r in source_divergence.audit(df, source_divergence.Audit(**more)).collect())


def test_divergence_against_brute_force(spark):
    rows = awkward()
    rows += [(100 + i, prose(i % 9, 40 + i), ("en", "de", None)[i % 3], f"s{i % 4}", 1) for i in range(40)]
    rows += [(200 + i, prose(50, 30), "en", "s1", 1) for i in range(25)]  # copies
    rows += [(300, "Über über ÜBER eins", "de", "s0", 1)] * 3 + [(301, "12 .. 34", "xx", "only", 1)]
    df = frame(spark, rows)
    assert audited(df) == expected_audit(rows)
    # Small holds: a task hands its counts on many times.
    assert audited(df, held=10, top=5) == expected_audit(rows, top=5)


def test_divergence_of_awkward_tables(spark):
    rows = awkward()
    assert audited(frame(spark, rows), least=1) == expected_audit(rows, least=1)
    assert not audited(frame(spark, rows).limit(0))


def test_each_text_is_there_once_with_its_copies(spark):
    rows = [(i, "same text", "en", f"s{i % 2}", 1) for i in range(9)] + [(9, "same text", "de", "s0", 1)]
    found = source_divergence.collapsed(frame(spark, rows).repartition(4)).collect()
    assert sorted((r.lang, r.text, sorted(map(tuple, r.copies))) for r in found) == [
        ("de", "same text", [("s0", 1)]), ("en", "same text", [("s0", 5), ("s1", 4)]),
    ]


def test_pair_slices_do_not_change_the_sums(spark, monkeypatch):
    rows = [(i, prose(i, 50), "en", f"s{i % 7}", 1) for i in range(30)]
    monkeypatch.setattr(source_divergence, "_PAIRS", 3)
    assert audited(frame(spark, rows)) == expected_audit(rows)


# N-gram Jaccard join


def shingles(text, n=3):
    words = (text or "").translate(LOWER).encode().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def expected_components(documents, percent=90):
    sets = [shingles(t) for _, t in documents]
    top = list(range(len(documents)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, j in itertools.combinations(range(len(documents)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            top[root(i)] = root(j)
    ids = collections.defaultdict(list)
    for i, (d, _) in enumerate(documents):
        ids[root(i)] += [] if d is None else [d]
    return collections.Counter(
        (d, len(sets[i]), min(ids[root(i)], default=None)) for i, (d, _) in enumerate(documents)
    )


def joined(spark, documents, **more):
    df = spark.createDataFrame(
        [(d, t, 1, "k") for d, t in documents], "doc_id long, text string, component_id long, key string"
    )
    found = jaccard_join.classes(df, jaccard_join.JaccardJoin(**more)).collect()
    return collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in found)


def changed(base, count, step):
    out = []
    for i in range(count):
        words = base.split()
        for at in range(i % 7, len(words), step):
            words[at] = f"w{i}x{at}"
        out.append(" ".join(words))
    return out


def test_join_against_brute_force(spark):
    base, passage = prose(1, 300), prose(2, 60)
    texts = [base, base.upper(), *changed(base, 14, 97), *changed(base, 6, 45), *changed(prose(3, 120), 9, 100)]
    texts += [f"{passage} {prose(20 + i, 8 + 4 * i)}" for i in range(14)]  # a passage that many share
    texts += [f"{passage} {passage} tail{i % 3}" for i in range(6)]
    texts += ["a b", "A b", "a", "a b c", "", None, " \n", "a b c d"] * 2
    documents = [(i * 3 % 101, t) for i, t in enumerate(texts)] + [(None, base), (None, "lonely words here now")]
    wanted = expected_components(documents)
    assert joined(spark, documents) == wanted
    # Tiny classes and blocks: combinations of two and three, leaders, and blocks of lists.
    assert joined(spark, documents, classes=(2, 4), block=3, held=50) == wanted
    assert joined(spark, documents, table=3, classes=(2, 3), block=4) == wanted


def test_join_of_awkward_tables(spark):
    documents = [r[:2] for r in awkward()]
    assert joined(spark, documents) == expected_components(documents)
    assert not joined(spark, documents[:0])


@settings(max_examples=150, deadline=None)
@given(
    st.sets(st.integers(0, 60), min_size=1, max_size=40),
    st.lists(st.integers(0, 60), max_size=5),
    st.sampled_from([(1,), (1, 2), (1, 2, 3), (2, 3), (3,)]),
    st.sampled_from([60, 80, 90]),
)
def test_sets_that_are_alike_share_a_signature(first, toggled, kinds, percent):
    def hashed(s):
        return np.sort(jaccard_join.mixed(np.array(sorted(s), np.uint64)))

    second = first.symmetric_difference(toggled)
    if not second:
        return
    a, b = hashed(first), hashed(second)
    if not jaccard_join.alike(a, b, percent):
        return
    universe = jaccard_join.mixed(np.arange(61, dtype=np.uint64))
    order = np.argsort(universe)
    kind = np.array([kinds[i % len(kinds)] for i in range(61)], np.int8)[order]

    def signed(tokens):
        k = kind[np.searchsorted(universe[order], tokens)]
        sizes = {len(tokens), jaccard_join.least_common(len(tokens), percent)}
        bands = {jaccard_join.size_band(s) for s in sizes}
        return {s for n in bands for s in jaccard_join.signatures(tokens, k, n, percent, 3)}

    assert signed(a) & signed(b)
    bits = [jaccard_join.bitmap(x) for x in (a, b)]
    words = min(map(len, bits))
    differing = int(np.bitwise_count(np.bitwise_xor(*[jaccard_join.narrowed(x, words) for x in bits])).sum())
    assert jaccard_join.may_be_alike(len(a), len(b), differing, percent)


def test_bitmaps_of_different_widths_compare():
    tokens = np.sort(jaccard_join.mixed(np.arange(1030, dtype=np.uint64)))
    wide, less = jaccard_join.bitmap(tokens), jaccard_join.bitmap(tokens[:1000])
    assert (len(wide), len(less)) == (32, 16)
    assert np.bitwise_count(jaccard_join.narrowed(wide, 16) ^ jaccard_join.narrowed(less, 16)).sum() <= 30


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.sampled_from([0.0, 0.3, 0.9]))
def test_lists_are_the_same_with_and_without_the_short_cut(size, seed, frequent):
    join = jaccard_join.JaccardJoin()
    chance = np.random.default_rng(seed)
    tokens = np.unique(chance.integers(1 << 63, size=size, dtype=np.uint64) * np.uint64(2))
    common = chance.random(len(tokens)) < frequent
    table = np.unique(tokens[common] >> np.uint64(24))
    classes = chance.integers(2, 4, size=len(table)).astype(np.int8)
    k = jaccard_join.class_of(tokens, table, classes)
    sizes = {len(tokens), jaccard_join.least_common(len(tokens), 90)}
    whole = [
        x for b in {jaccard_join.size_band(n) for n in sizes}
        for x in jaccard_join.signatures(tokens, k, b, join.percent, join.spread)
    ]
    assert sorted(whole) == sorted(jaccard_join.own_lists(tokens, table, classes, join))


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def expected_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def expected_proofs(leaves):
    """(id, leaf, subroot, root, siblings) of rows (lang, id, leaf)."""
    order = sorted(leaves, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2]))
    groups = [list(g) for _, g in itertools.groupby(order, key=lambda r: r[0])]
    trees = [expected_tree([r[2] for r in g]) for g in groups]
    top = expected_tree([t[-1][0] for t in trees]) if trees else []

    def path(levels, i):
        return [s for n, l in enumerate(levels[:-1]) for s in l[(i >> n) ^ 1 : ((i >> n) ^ 1) + 1]]

    return collections.Counter(
        (r[1], r[2], trees[g][-1][0], top[-1][0], "".join(path(trees[g], i) + path(top, g)))
        for g, rows in enumerate(groups) for i, r in enumerate(rows)
    )


def proven(spark, rows, **more):
    df = spark.createDataFrame(rows, "lang string, doc_id long, leaf string").withColumns(
        {name: F.lit("mine") for name in ("tree", "index", "size", "chunk", "hash", "steps_")}
    )
    out = merkle_manifest.manifest(df, "lang", ["doc_id"], merkle_manifest.Manifest(**more))
    out = out.withColumn("joined", merkle_manifest.siblings(F.col("steps"))).withColumn(
        "folded", merkle_manifest.folded(F.col("leaf"), F.col("steps"))
    )
    found = out.collect()
    assert all(r.folded == r.root and r.tree == r["index"] == "mine" for r in found)
    return collections.Counter((r.doc_id, r.leaf, r.subroot, r.root, r.joined) for r in found)


@pytest.mark.parametrize("more", [{}, {"levels": 2, "leaves": 5, "requests": 1}, {"levels": 1, "leaves": 3}])
def test_proofs_against_a_plain_tree(spark, more):
    leaves = [(("en", "de", None, "é", "z")[min(i % 9, 4)], i * 7 % 131, sha(str(i))) for i in range(130)]
    leaves += [("one", 1, sha("x")), ("two", None, sha("y")), ("two", None, sha("y")), ("two", 4, sha("b")), ("two", 4, sha("a"))]
    assert proven(spark, leaves, **more) == expected_proofs(leaves)


def test_a_single_leaf_and_none(spark):
    assert proven(spark, [("en", 1, sha("x"))]) == expected_proofs([("en", 1, sha("x"))])
    assert not proven(spark, [])


def test_a_changed_leaf_does_not_lead_to_the_root(spark):
    leaves = [("en", i, sha(str(i))) for i in range(11)]
    df = spark.createDataFrame(leaves, "lang string, doc_id long, leaf string")
    out = merkle_manifest.manifest(df, "lang", ["doc_id"])
    other = F.when(F.col("doc_id") % 3 == 0, F.sha2(F.lit(b"no"), 256)).otherwise(F.col("leaf"))
    good = {r.doc_id for r in out.where(merkle_manifest.folded(other, F.col("steps")) == F.col("root")).collect()}
    assert good == {i for i in range(11) if i % 3}


def test_encoding_tells_nulls_and_lengths_apart(spark):
    rows = spark.createDataFrame(awkward(), SCHEMA)
    names = ("doc_id", "source", "lang", "n_chars", "text")
    found = rows.select(*names, merkle_manifest.digest([F.col(n) for n in names]).alias("d")).collect()
    for r in found:
        values = ["-" if r[n] is None else f"{len(str(r[n]).encode())}:{r[n]}" for n in names]
        assert r.d == sha(*values)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 70), st.data())
def test_the_union_of_missing_nodes_is_least(size, data):
    indices = data.draw(st.sets(st.integers(0, size - 1), min_size=1))
    found = merkle_manifest.missing(indices, size)
    known, width, level = set(indices), size, 0
    while width > 1:
        here = {i for n, i in found if n == level}
        assert not here & known  # nothing that follows from what is there
        assert all(i ^ 1 in known for i in here)
        known |= here
        assert all(i ^ 1 in known or i ^ 1 >= width for i in known)
        known, width, level = {i >> 1 for i in known}, (width + 1) >> 1, level + 1
    assert len(found) == len(set(found))
