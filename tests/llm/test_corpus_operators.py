"""Operators that compare documents or learn from them, against brute force over small tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from inkwell.llm import order_minhash as omh
from inkwell.llm import pairwise_quality, pii_sanitise, pitman_yor
from inkwell.llm import template_decontamination as decontamination
from inkwell.llm.common import table
from tests.llm.rows import SCHEMA, awkward, prose

SMALL = "/root/testdata/sf0.001"


# Near-duplicates


def test_rounds_of_components_shuffle_three_times(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(n, n + 1) for n in range(400, 440)]
    top = {}

    def root(n):
        while top.setdefault(n, n) != n:
            n = top[n]
        return n

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            top[high] = low
    data = [(bytes([a >> 8, a & 255]), bytes([b >> 8, b & 255])) for a, b in edges]
    links = spark.createDataFrame(data, "a binary, b binary")
    found = {(bytes(k), bytes(c)) for k, c in omh.components(links).collect()}
    assert found == {(bytes([n >> 8, n & 255]), bytes([root(n) >> 8, root(n) & 255])) for n in top}
    plan = omh.star_round(links)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange ", plan)) == 3 and "Join" not in plan


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def expected_classes(documents):
    """Least id per connected group of texts, by the edit distance of all pairs."""
    texts = sorted({t or "" for _, t in documents})
    parent = {t: t for t in texts}

    def top(t):
        while parent[t] != t:
            t = parent[t]
        return t

    words = {t: t.encode().split() for t in texts}
    bags = {t: collections.Counter(w) for t, w in words.items()}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            # The words in common bound the distance from below.
            wa, wb, longer = words[a], words[b], max(len(words[a]), len(words[b]))
            if longer and (bags[a] & bags[b]).total() >= 0.8 * longer - 1e-9 and levenshtein(wa, wb) <= 0.2 * longer + 1e-9:
                parent[top(a)] = top(b)
    ids = collections.defaultdict(list)
    for d, t in documents:
        ids[top(t or "")] += [d] if d is not None else []
    return collections.Counter((d, min(ids[top(t or "")], default=None)) for d, t in documents)


def classes(spark, documents, extra=""):
    df = spark.createDataFrame([(d, t, 1) for d, t in documents], "doc_id long, text string, class_id long")
    return collections.Counter((r.doc_id, r.class_id) for r in omh.classes(df).collect())


def variants(base, count, step=40):
    """Copies with some words changed, each at other places."""
    words = base.split()
    out = []
    for n in range(count):
        own = words[:]
        for i in range(n % step, len(own), step + n):
            own[i] = f"w{n}"
        out.append(" ".join(own))
    return out


def test_near_duplicates_against_brute_force(spark):
    base = prose(1, 200)
    documents = [(i, t) for i, t in enumerate([base, *variants(base, 12, 60), *variants(prose(2, 90), 5, 30)])]
    documents += [(100 + i, prose(i + 10, 60)) for i in range(20)]
    documents += [(200, base), (201, base), (201, base), (None, base), (None, prose(70, 50)), (202, "one two")]
    documents += [(203, "one two"), (204, "one two three"), (205, None), (206, ""), (207, " ")]
    half = base.split()
    documents.append((208, " ".join(half[100:] + half[:100])))  # the same windows, another order
    assert classes(spark, documents) == expected_classes(documents)


def test_links_beyond_the_leaders_are_found(spark):
    """Chains of texts in one bucket whose ends are not similar."""
    words = prose(3, 300).split()
    chain = [(i, " ".join(words[i * 6 :] + [f"z{j}" for j in range(i * 6)])) for i in range(14)]
    assert classes(spark, chain) == expected_classes(chain)


def test_near_duplicates_on_awkward_rows(spark):
    rows = awkward()
    df = spark.createDataFrame([(*r, b"k") for r in rows], SCHEMA + ", key binary")
    found = collections.Counter((r.doc_id, r.class_id) for r in omh.classes(df).collect())
    wanted = collections.Counter(
        (d, c) for d, c in [(1, 1), (1, 1), (1, 1), (2, 2), (3, 2), (4, 4), (None, None), (None, 2)]
        + [(i, i) for i in (5, 6, 7, 8)]
    )
    assert found == wanted
    kept = omh.without_near_duplicates(df)
    assert kept.columns == df.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter([1, 1, 2, 4, None, 5, 6, 7, 8])
    assert omh.classes(df.limit(0)).count() == omh.without_near_duplicates(df.limit(0)).count() == 0


def test_real_documents_against_brute_force(spark):
    documents = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    rows = entry.queries()["op4_near_duplicates"](spark, SMALL).collect()
    assert collections.Counter((r.doc_id, r.class_id) for r in rows) == expected_classes(documents)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), max_size=30), st.integers(0, 12))
def test_edit_distance(a, b, limit):
    wanted = levenshtein(a, b)
    expected = wanted if wanted <= limit else limit + 1
    assert omh.edit_distance(a, b, limit) == expected
    if a and abs(len(a) - len(b)) <= limit:
        assert omh.by_columns(a, b, limit) == expected


def test_production_bands_meet_as_often_as_promised():
    """Texts with 4 % of their words changed all meet, and nine in ten of those with 7 %."""
    chosen = omh.NearDuplicates()
    functions = omh.hash_functions(chosen)
    assert len(functions) == chosen.bands * chosen.rows
    hashes, rng = omh.WordHashes(), np.random.default_rng(5)
    met = {25: [], 14: []}
    for i in range(100):
        for step, found in met.items():
            words = [b"%d" % x for x in rng.integers(1 << 40, size=300)]
            other = words[:]
            for j in range(step // 2, 300, step):
                other[j] = b"x%d" % i
            a, b = (omh.buckets(omh.sketch(omh.windows(hashes.of(w), chosen.k), functions), chosen.rows) for w in (words, other))
            found.append(bool(set(a.tolist()) & set(b.tolist())))
    assert np.mean(met[25]) >= 0.99 and np.mean(met[14]) >= 0.8


def test_scattered_changes_are_verified_by_alignment(spark):
    """Changes that leave few windows in common, up to a fifth of the words, decide by edit distance alone."""
    chance, documents = np.random.default_rng(4), []
    for i, share in enumerate([0.02, 0.03, 0.05, 0.05]):
        words = [f"{i}w{j}" for j in range(200)]
        other = words[:]
        for j in chance.choice(200, int(200 * share), replace=False):
            other[j] = f"{i}x{j}"
        documents += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    assert classes(spark, documents) == expected_classes(documents)
    a = [f"w{i}" for i in range(50)]
    pairs = [(a, a[:40] + ["x"] * 10, True), (a, a[:39] + ["x"] * 11, False), (a, a[25:] + a[:25], False)]
    hashes = omh.WordHashes()
    for x, y, alike in pairs:
        x, y = ([w.encode() for w in z] for z in (x, y))
        assert omh.similar(x, y, omh.word_bag(hashes.of(x)), omh.word_bag(hashes.of(y)), 0.8) is alike


def test_recall_against_all_pairs(spark):
    """Of the pairs of texts of the tables with an edit similarity of 0.8, nine in ten are in one class."""
    documents = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    words = {d: (t or "").encode().split() for d, t in documents}
    bags, pairs = {d: collections.Counter(w) for d, w in words.items()}, []
    for a, b in itertools.combinations(sorted(words, key=lambda d: len(words[d])), 2):
        longer = len(words[b])
        if len(words[a]) < 0.8 * longer or not longer or (bags[a] & bags[b]).total() < 0.8 * longer:
            continue
        limit = omh.most_edits(len(words[a]), longer, 0.8)
        if omh.edit_distance(words[a], words[b], limit) <= limit:
            pairs.append((a, b))
    found = dict(classes(spark, documents).keys())
    assert len(pairs) > 50
    assert np.mean([found[a] == found[b] for a, b in pairs]) >= 0.9


# Decontamination


def test_leaks_of_real_documents(spark):
    documents = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    items = {r.item_id: r.text for r in table(spark, SMALL, "benchmark").collect()}
    rows = entry.queries()["op2_decontamination"](spark, SMALL).collect()
    wanted = {(d, i) for d, t in documents.items() for i, b in items.items() if b in (t or "")}
    assert {(r.doc_id, r.item_id) for r in rows} == wanted


ITEM = (
    "A farmer named Tom has 12 sheep and buys 30 more sheep from Anna before the sun sets. "
    "How many sheep does the farmer named Tom have in the end if 12 of them run away?"
)


@pytest.mark.parametrize(
    ("text", "found", "verbatim"),
    [
        (ITEM, True, True),
        (ITEM.lower().replace("tom", "Tom").replace("anna", "Anna"), True, True),
        (ITEM.replace("12", "45").replace("30", "7").replace("Tom", "Lee"), True, False),
        # One number of the item becomes two: no question of this template.
        (ITEM.replace("12 sheep", "45 sheep").replace("Tom have", "Max have"), False, None),
        (ITEM.replace("\n", " ").replace(" ", "\n", 30), True, True),
        (prose(5, 300), False, None),
    ],
)
def test_templates(spark, text, found, verbatim):
    benchmark = spark.createDataFrame([(7, ITEM, "x")], "item_id long, text string, hash string")
    whole = prose(1, 2000) + " so " + text + "\n" + prose(2, 50)
    df = spark.createDataFrame([(1, whole, 3), (None, None, 3)], "doc_id long, text string, hash long")
    rows = decontamination.leaks(df, benchmark).collect()
    assert [(r.doc_id, r.item_id, r.verbatim) for r in rows] == ([(1, 7, verbatim)] if found else [])


def test_template_and_values_have_the_same_slots(spark):
    text = "We saw Anna Lee run 12.5 km and 3 miles for $40, then 7% more. Tom went. 5 kg\nof Rice."
    df = spark.createDataFrame([(text,)], "text string")
    row = df.select(decontamination.template(F.col("text")), decontamination.values(F.col("text"))).first()
    kinds = {decontamination.NUMBER: "n", decontamination.UNIT: "u", decontamination.NAME: "N"}
    slots = [kinds[w] for w in row[0] if w in kinds]
    assert slots == ["N", "N", "n", "u", "n", "u", "n", "n", "u", "n", "u", "N"]
    assert row[1] == ["anna", "lee", "12.5", "km", "3", "miles", "$40", "7", "%", "5", "kg", "rice"]


def test_verbatim_leaks_after_words_with_digits_and_bad_copies(spark):
    bad = ITEM.replace("12 sheep", "45 sheep").replace("Tom have", "Max have")
    # One value of the document for two of the item.
    merged = ITEM.replace("Anna", "Tom")
    before = prose(1, 60) + " He plays an MP3 on A4 for Tom today. "
    texts = [before + ITEM, bad + "\n" + prose(2, 30) + "\n" + ITEM, merged, bad, before + bad]
    benchmark = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = decontamination.leaks(df, benchmark).collect()
    assert sorted((r.doc_id, r.verbatim) for r in rows) == [(0, True), (1, True), (2, False)]
    one = df.limit(1).select(F.lit("He plays an MP3 for Tom today").alias("text"))
    row = one.select(decontamination.template(F.col("text")), decontamination.values(F.col("text"))).first()
    assert sum(w == decontamination.NAME for w in row[0]) == len(row[1]) == 2


NAMES = "In 1999 Tom sold 5 km of rope to Anna and in 2001 Lee paid 7 dollars to Max for 3 more of them again."
SHORT = "What is the capital of France?"


@pytest.mark.parametrize(
    ("item", "text", "verbatim"),
    [
        (NAMES, NAMES, True),
        (NAMES, NAMES.replace("Tom", "Joe").replace("Anna", "Eve").replace("1999", "1820").replace("Lee", "Kim"), False),
        (SHORT, SHORT, True),
        (SHORT, "Some asked: " + SHORT + " And so on.", True),
        (SHORT, "Some asked What is the capital of France? And so on.", True),
        (SHORT, "Some asked, what is the capital of Peru? And so on.", False),
        (SHORT, "Some asked, what is the capital of it? And so on.", None),
        ("Name the largest city of Spain now", "please Name the largest city of Peru now " + prose(9, 40), False),
    ],
)
def test_names_after_numbers_and_short_items(spark, item, text, verbatim):
    items = [(7, item), (8, "one two"), (9, ITEM)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = prose(1, 50) + " so\n" + text + "\n" + prose(2, 50)
    df = spark.createDataFrame([(1, whole), (2, prose(4, 300)), (3, "one"), (4, "we say one two three")], "doc_id long, text string")
    rows = decontamination.leaks(df, benchmark).collect()
    found = sorted((r.doc_id, r.item_id, r.verbatim) for r in rows)
    assert found == sorted(([(1, 7, verbatim)] if verbatim is not None else []) + [(4, 8, True)])


def test_leaks_on_awkward_rows(spark):
    benchmark = table(spark, SMALL, "benchmark")
    item = benchmark.where("item_id = 3").first().text
    rows = [*awkward(), (None, "say: " + item, None, None, None), (20, item, "en", "a", 1), (20, item, "en", "a", 1)]
    items = benchmark.union(spark.createDataFrame([(None, None), (90, ""), (91, "one two")], benchmark.schema))
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", item_id long")
    out = collections.Counter((r.doc_id, r.item_id) for r in decontamination.leaks(df, items).collect())
    assert out == {(None, 3): 1, (20, 3): 1, (7, 91): 1}
    clean = decontamination.without_leaks(df, items)
    assert clean.columns == df.columns and clean.count() == len(rows) - 4
    assert decontamination.leaks(df.limit(0), items).count() == 0
    assert decontamination.leaks(df, items.limit(0)).count() == 0
    tight = decontamination.Templates(broadcast_rows=0)
    assert collections.Counter((r.doc_id, r.item_id) for r in decontamination.leaks(df, items, tight).collect()) == out


# PII

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def is_personal(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "email":
        return True
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    twice = [int(c) * 2 for c in digits[-2::-2]]
    total = sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in twice)
    return 13 <= len(digits) <= 19 and total % 10 == 0


def base_spans(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if is_personal(kind, m.group())
    ]


def test_pii_of_real_documents(spark):
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    for r in entry.queries()["op3_pii"](spark, SMALL).collect():
        spans = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        counts = collections.Counter(s.split(":")[0] for s in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in PATTERNS)


TRICKY = [
    "a@b.c@d.e", "a@b.cd_x@d.e.f", "a@b..c", "x.y.@z-1.co.", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.255",
    "4111 1111 1111 1111 x 4111-1111-1111-1112", "4111111111111111 4111111111111111", "@b.c 41",
    "+1 (386) 555-3733. +49 30 1234567890", "1" * 30_000, "a" * 50_000 + "@x." + "b." * 5_000 + "c",
    "é\U0001f600 a@b.co \U0001f600 4111 1111 1111 1111", "a@b.c " * 3_000, "+1+2345678901 ((5))",
    "9 " * 20_000 + "- -9--9", "1.1.1.1.1 1..1.1.1.1.1",
]


def test_pii_on_awkward_rows(spark):
    rows = [*awkward(), *[(50 + i, t, None, None, None) for i, t in enumerate(TRICKY)]]
    df = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", n_email long")
    out = pii_sanitise.sanitise(df).collect()
    wanted = collections.Counter((r[0], r[1], ",".join(base_spans(r[1]))) for r in rows)
    assert collections.Counter((r.doc_id, r.text, r.base_spans) for r in out) == wanted
    done = {r.doc_id: r.sanitised for r in out}
    assert done[50 + 6] == "[CARD] x 4111-1111-1111-1112"
    assert done[50 + 9] == "[PHONE]. [PHONE]"
    assert pii_sanitise.sanitise(df.limit(0)).count() == 0


def test_disclosing_terms_against_brute_force(spark):
    rows = [(i, f"Call zorgblatt about {prose(i, 3)} a@b.co and common words here") for i in range(4)]
    rows += [(10 + i, f"The common words here call about {prose(i + 20, 12)} {prose(i, 3)}") for i in range(40)]
    rows += [(60, "A text with Zorgblatt alone, \U0001f600 zorgblatt."), (61, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii_sanitise.sanitise(df).collect()}
    # Over 45 distinct texts: PMI = ln(45 * 4 / (4 * 5)), IC = ln(45 / 4): 0.908 of it.
    total, both, value, term = 45, 4, 4, 5
    share = math.log(total * both / (value * term)) / math.log(total / value)
    assert 0.9 <= share < 0.98
    assert out[60].spans == "term:12:21,term:31:40" and out[60].n_term == 2
    assert out[60].sanitised == "A text with [TERM] alone, \U0001f600 [TERM]."
    assert out[0].spans.count("term:") == 1 and out[61].spans == out[0].spans
    assert all(out[10 + i].spans == "" for i in range(40))
    removing = pii_sanitise.Disclosure(remove=0.9, broadcast_rows=0)
    again = {r.doc_id: r for r in pii_sanitise.sanitise(df, removing).collect()}
    assert again[60].sanitised == "A text with  alone, \U0001f600 ." and again[60].spans == out[60].spans


def expected_terms(rows, least=3, generalise=0.9):
    """Shares of the terms of each text, by counting over all distinct texts."""
    texts = sorted({t or "" for _, t in rows})
    found = {t: {s.split(":")[0] + ":" + t[int(s.split(":")[1]) : int(s.split(":")[2])] for s in base_spans(t)} for t in texts}
    words = {t: set(re.findall(r"[^\W\d_]{4,}", t.lower())) for t in texts}
    n_value = collections.Counter(v for vs in found.values() for v in vs)
    n_term = collections.Counter(w for ws in words.values() for w in ws)
    both = collections.Counter((v, w) for t in texts for v in found[t] for w in words[t])
    shares = collections.defaultdict(float)
    for (v, w), n in both.items():
        if n >= least and n_value[v] < len(texts):
            share = math.log(len(texts) * n / (n_value[v] * n_term[w])) / math.log(len(texts) / n_value[v])
            shares[w] = max(shares[w], share)
    return {t: {w for w in words[t] if shares[w] >= generalise} for t in texts}


def test_terms_count_over_whole_texts(spark):
    """Terms behind other numbers, in other sentences, and far from the value."""
    rows = [(i, f"{prose(i, 2)} card 4111 1111 1111 1111 exp 12/26 holder Zorgblatt {prose(i + 9, 3)}") for i in range(6)]
    rows += [(10 + i, f"mail to a0@b.com. {prose(i, 90)}. The agent is Quuxman. {prose(i, 4)}") for i in range(6)]
    rows += [(30 + i, f"The card and agent of the holder, mail {prose(40 + i, 9)}") for i in range(90)]
    rows += [(200, "Quuxman and Zorgblatt"), (201, None), (202, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = expected_terms(rows)
    assert wanted[rows[0][1]] >= {"zorgblatt"} and wanted[rows[6][1]] >= {"quuxman"}
    for chosen in (pii_sanitise.Disclosure(), pii_sanitise.Disclosure(broadcast_rows=0, broadcast_terms=0)):
        for r in pii_sanitise.sanitise(df, chosen).collect():
            text = r.text or ""
            spans = [s.split(":") for s in r.spans.split(",") if s.startswith("term")]
            assert {text[int(a) : int(b)].lower() for _, a, b in spans} == wanted[text]


def test_no_pairs_of_text_and_candidate_term_are_kept(spark, monkeypatch):
    """Terms that meet a value in three texts and stand in many others: what is kept does not grow with those."""
    rows = [(i, f"mail a@b.co {prose(i, 2)} agent Quuxman") for i in range(6)]
    rows += [(10 + i, f"some agent and mail {prose(i + 20, 12)}") for i in range(200)] + [(300, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = []
    kept = pii_sanitise.checkpointed
    monkeypatch.setattr(pii_sanitise, "checkpointed", lambda d: (k := kept(d), sizes.append((d.columns, k.count())))[0])
    out = pii_sanitise.sanitise(df).collect()
    assert {w.split(":")[0] for r in out for w in r.spans.split(",")} == {"email", "term", ""}
    assert not any({"key", "term"} <= set(columns) for columns, _ in sizes)
    wanted = expected_terms(rows)
    for r in out:
        spans = [s.split(":") for s in r.spans.split(",") if s.startswith("term")]
        assert {r.text[int(a) : int(b)].lower() for _, a, b in spans} == wanted[r.text]


def test_running_sums(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        values = list(range(n))
        df = spark.createDataFrame([(values,)], "v array<int>")
        assert df.select(pii_sanitise.running_sums(F.col("v"))).first()[0] == np.cumsum(values).tolist()


# Quality classifier


def test_classifier_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    rows = entry.queries()["op9_quality_classifier"](spark, folder).collect()
    held_out = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    right = sum(r.predicted == labels[r.doc_id] for r in held_out)
    assert right >= 0.97 * len(held_out)


def test_pairs_are_ranked():
    rng = np.random.default_rng(0)
    size = len(pairwise_quality.FEATURES)
    x = rng.normal(size=(600, size))
    better = x[:, 0] - 2 * x[:, 3] + 0.2 * rng.normal(size=600) > 0
    model = pairwise_quality.fit(x, better)
    scores = model.scores(x)
    above = (scores[better][:, None] > scores[~better][None, :]).mean()
    assert above > 0.98
    assert abs((scores < model.threshold).mean() - (~better).mean()) < 0.01  # the quantile


def test_classifier_on_awkward_rows(spark):
    rows = awkward()
    df = spark.createDataFrame([(*r, 5.0) for r in rows], SCHEMA + ", score double")
    labels = spark.createDataFrame(
        [(1, 1, 0), (5, 1, 0), (5, 1, 1), (6, 0, 0), (7, 0, 0), (2, None, 0), (None, 0, 0)],
        "doc_id long, quality long, toxic long",
    )
    model = pairwise_quality.learn(df, labels)
    out = pairwise_quality.scored(df, model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert {r.predicted for r in pairwise_quality.scored(df, pairwise_quality.learn(df, none)).collect()} == {1}
    worse = pairwise_quality.learn(df, labels.where("quality = 0"))
    assert {r.predicted for r in pairwise_quality.scored(df, worse).collect()} == {0}
    assert pairwise_quality.scored(df.limit(0), model).count() == 0


# Language model


def tokens(text):
    return [*re.findall(b"[^\x20\x09-\x0d]+", (text or "").encode().lower()), b""]


def check_base(rows, documents, learned):
    counts = collections.Counter(t for _, text in learned for t in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    wanted = sorted(
        (repr(d), len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)),
         round(sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens(x)), 5))
        for d, x in documents
    )
    found = sorted((repr(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 5)) for r in rows)
    assert [f[:3] for f in found] == [w[:3] for w in wanted]
    assert np.allclose([f[3] for f in found], [w[3] for w in wanted], atol=2e-5)
    assert all(r.train_tokens == total for r in rows)


def test_language_model_on_real_documents(spark):
    documents = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    rows = entry.queries()["op10_language_model"](spark, SMALL).collect()
    fold = lambda d: zlib.crc32(str(d).encode()) % 7
    check_base(rows, documents, [x for x in documents if fold(x[0]) != 2])
    held_out = [r for r in rows if r.held_out]
    assert all(r.held_out == (fold(r.doc_id) == 2) for r in rows)
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_language_model_on_awkward_rows(spark):
    rows = awkward()
    df = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", n_tokens long")
    everything = pitman_yor.score(df, F.lit(True)).collect()
    check_base(everything, [(r[0], r[1]) for r in rows], [(r[0], r[1]) for r in rows])
    nothing = pitman_yor.score(df, F.lit(False)).collect()
    check_base(nothing, [(r[0], r[1]) for r in rows], [])
    assert all(r.score == 0 for r in nothing)
    assert pitman_yor.score(df.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("head", [1, 5, 8192])
def test_every_text_has_a_probability(spark, head):
    """Whatever the part of the words that is scored from the head's table."""
    texts = ["a b a c a b", "b a d a", "c c a b e f", "a b", "b b b g"]
    words = ["a", "b", "c", "d", "e", "f", "g", "unknown"]
    probes = [f"{before} {w}" for before in ("a", "d") for w in words] + ["a", "d"]
    df = spark.createDataFrame(
        [(i, t, True) for i, t in enumerate(texts)] + [(100 + i, t, False) for i, t in enumerate(probes)],
        "doc_id long, text string, train boolean",
    )
    model = pitman_yor.Model(contexts=min(3, head), head=head, samples=3)
    score = {r.doc_id: r.score for r in pitman_yor.score(df, F.col("train"), model).collect()}
    assert all(s < 0 for s in score.values())
    assert len(score) == len(texts) + len(probes)


def test_every_preceding_word_has_a_restaurant(spark):
    """400 words, each always before one of its own: more than the head's contexts."""
    size = 400
    texts = [f"before{i} after{i} end" for i in range(size) for _ in range(3)]
    probes = [f"before{i} after{j} end" for i in range(size) for j in (i, (i + 1) % size)]
    df = spark.createDataFrame(
        [(i, t, True) for i, t in enumerate(texts)] + [(10_000 + i, t, False) for i, t in enumerate(probes)],
        "doc_id long, text string, train boolean",
    )
    score = {r.doc_id: r.score for r in pitman_yor.score(df, F.col("train")).collect()}
    assert all(score[10_000 + 2 * i] > score[10_001 + 2 * i] + 1 for i in range(size))


def test_learned_probabilities_sum_to_one(spark):
    """After each word, over the vocabulary and the unknown word; the head does not matter."""
    texts = [prose(i % 7, 40) + " a b a c a b" for i in range(20)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = pitman_yor.learn(df, pitman_yor.Model())
    words = {bytes(r.word): r for r in model.words.collect()}
    gains = {(bytes(r.ctx), bytes(r.word)): 10**r.gain for r in model.gains.collect()}
    assert abs(sum(r.parent for r in words.values()) + model.unknown - 1) < 1e-9
    for u, r in words.items():
        total = sum(x.parent * r.backoff * gains.get((u, w), 1) for w, x in words.items())
        assert abs(total + model.unknown * r.backoff - 1) < 1e-9
    scores = [
        {r.doc_id: round(r.score, 3) for r in pitman_yor.score(df, F.lit(True), pitman_yor.Model(contexts=c, head=h)).collect()}
        for c, h in ((1, 1), (255, 8192))
    ]
    assert scores[0] == scores[1]


def test_language_model_in_many_chunks_and_blocks(spark):
    """Pairs travel packed, a row per chunk and block and not one per pair, with the same results."""
    texts = [prose(i % 7, 40) + " a b a c a b" for i in range(20)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    rows = df.select(F.col("text").alias("_text"), F.lit(True).alias("_train"))
    found = pitman_yor._chunks(rows, [], 2, pitman_yor.Model(), 0).where("kind <> 'text'").collect()
    assert len(found) <= 1 + 2 * 2
    model = pitman_yor.Model(flush=1, block=900)
    learned = pitman_yor.learn(df, model)
    words = {bytes(r.word): r for r in learned.words.collect()}
    gains = {(bytes(r.ctx), bytes(r.word)): 10**r.gain for r in learned.gains.collect()}
    pairs = {p for t in texts for p in itertools.pairwise([b"", *t.lower().encode().split(), b""])}
    assert set(gains) == pairs
    for u, r in words.items():
        total = sum(x.parent * r.backoff * gains.get((u, w), 1) for w, x in words.items())
        assert abs(total + learned.unknown * r.backoff - 1) < 1e-9


def test_words_that_share_a_hash_are_noticed():
    words = pa.array([b"a", b"b", b"a", b"c"])
    assert pitman_yor._merged(np.array([1, 2, 1, 3], np.uint64), words)[3] == 0
    assert pitman_yor._merged(np.array([1, 1, 1, 3], np.uint64), words)[3] == 1


def test_predictive_probabilities_sum_to_one():
    """Of every restaurant, over the vocabulary and the unknown word, whatever the seating."""
    rng = np.random.default_rng(2)
    words, size = 60, 4
    counts = rng.integers(0, 6, size=(words, size)) * (rng.random((words, size)) < 0.5)
    counts[:, 0] += counts.sum(axis=1) == 0
    word, ctx = np.nonzero(counts)
    count = counts[word, ctx]
    tables = np.bincount(ctx, minlength=size).astype(float)
    totals = pitman_yor.Totals(counts.sum(axis=0).astype(float), tables, float(words), words, 0.6, 0.4, 1.0)
    seats, root, _, _ = pitman_yor.seat(word, ctx, count, totals, 2, 0, 1)
    totals = pitman_yor.Totals(
        totals.customers, np.bincount(ctx, seats, size), float(root.sum()), words, 0.6, 0.4, 1.0
    )
    # With the tables held still, what the words leave over is exactly what an unknown word gets.
    served = np.bincount(word, seats, words)
    above = (served - 0.4 * root + (1.0 + 0.4 * root.sum()) / (words + 1)) / (1.0 + served.sum())
    unknown = (1.0 + 0.4 * root.sum()) / (words + 1) / (1.0 + served.sum())
    assert abs(above.sum() + unknown - 1) < 1e-9
    for u in range(size):
        own = np.zeros(words)
        at = ctx == u
        own[word[at]] = count[at] - 0.6 * seats[at]
        new = 1.0 + 0.6 * totals.tables[u]
        p = (own + new * above) / (1.0 + totals.customers[u])
        assert abs(p.sum() + new * unknown / (1.0 + totals.customers[u]) - 1) < 1e-9


def test_seating_by_brute_force():
    """Mean tables of one word against customers seated one by one."""
    rng = np.random.default_rng(3)
    count, weight, discount = 40, 1.7, 0.5
    sums = 0
    for _ in range(4000):
        made = 1
        for i in range(1, count):
            made += rng.random() < weight / (weight + i - discount * made)
        sums += made
    mean = pitman_yor._seated(np.full(4000, count), np.full(4000, weight), discount, rng).mean()
    assert abs(mean - sums / 4000) < 0.05 * mean


# The pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    columns = docs.columns
    seen = [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
        assert docs.columns == columns, name
        seen.append({r.doc_id: r.text for r in docs.collect()})
    _, good, unique, clean, private = seen
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    assert sum(labels.get(d) == 0 for d in good) <= 1
    classes = expected_classes(list(good.items()))
    assert set(unique) == {c for _, c in classes}
    items = [r.text for r in table(spark, folder, "benchmark").collect()]
    assert set(clean) == {d for d, t in unique.items() if not any(i in t for i in items)}
    assert set(private) == set(clean)
    assert not any(base_spans(t) for t in private.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {p.doc_id for p in packed} == set(private)
    rows = entry.queries()["pipeline"](spark, folder).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert {(r.doc_id, r.doc_tokens) for r in rows} == {(p.doc_id, p.doc_tokens) for p in packed}
    assert sum(r.length for r in rows) == sum(p.length for p in packed) and len(set(map(key, rows))) == len(rows)


def test_pipeline_stages_on_awkward_rows(spark):
    """Columns with names of results keep their values, and no case breaks a stage."""
    import corpus_pipeline

    folder, own = "/root/testdata/sf0.001", {"score": 7.0, "predicted": 9, "spans": "mine", "n_email": "x", "_hash2": True}
    rows = awkward()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(v) for n, v in own.items()})
    for stage in (corpus_pipeline.unique, corpus_pipeline.decontaminated, corpus_pipeline.sanitised):
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns
        kept = found.collect()
        assert all(r[n] == v for r in kept for n, v in own.items())
        assert stage(spark, docs.limit(0), folder).count() == 0
    assert [r.text for r in kept if r.doc_id == 8] == ["é \U0001f600 ñ [EMAIL] \U0001f600 [CARD]"]
    assert corpus_pipeline.good_quality(spark, docs.limit(0), folder).count() == 0
    good = corpus_pipeline.good_quality(spark, docs, folder).collect()
    assert all(r[n] == v for r in good for n, v in own.items())
    assert corpus_pipeline.packed(spark, docs.limit(0), folder).count() == 0
