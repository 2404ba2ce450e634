"""Operators that read a document at a time: quality rules, packing, chat, licenses, URLs."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import pytest

import __spark_entry__ as entry
from inkwell.llm import chat_render, dp_packing, filter_cascade, license_scan, line_quality, queries
from inkwell.llm.common import table
from inkwell.llm.filter_cascade import Rule
from tests.llm.rows import SCHEMA, awkward, prose

SMALL = "/root/testdata/sf0.001"


# Quality rules


def expected_numbers(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    filled = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {
        i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)
    }
    repeated = len(covered)
    failed = len(words) < 10 or 100 * repeated > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    duplicates = len(filled) - len(set(filled))
    return (len(words), sum(map(len, words)), symbols, duplicates, repeated, failed)


def numbers(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_quality_rules_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    rows = entry.queries()["op6_quality_rules"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert numbers(r) == expected_numbers(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_quality_rules_on_awkward_rows(spark):
    df = spark.createDataFrame([(*r, 9) for r in awkward()], SCHEMA + ", kept long")
    rows = line_quality.clean_lines(df).collect()
    assert len(rows) == len(awkward())
    key = lambda t: repr(t)
    assert sorted(map(numbers, rows), key=key) == sorted((expected_numbers(r[1]) for r in awkward()), key=key)
    assert line_quality.clean_lines(df.limit(0)).count() == 0


def test_many_distinct_words_count_exactly():
    words = [f"w{i}" for i in range(7000)] + [f"w{i}" for i in range(100, 110)]
    encoded = [w.encode() for w in words]
    assert line_quality.repeated_words(encoded) == expected_numbers(" ".join(words))[4] == 20


def test_lines_are_judged_first():
    rules = line_quality.LineRules()
    assert line_quality.line_fails("Home | About | Contact | Help", rules)
    assert line_quality.line_fails("BUY!! NOW!! CHEAP!!", rules)
    assert line_quality.line_fails("Please read our cookie policy.", rules)
    assert not line_quality.line_fails("A plain sentence about nothing, it ends here.", rules)
    good = prose(4, 60)
    row = line_quality.judged(good + "\nHome | About | Contact | Help", rules)
    assert row[-1] == good and row[6] == 1


# Packing


def packed_rows(df, **more):
    return dp_packing.pack(df, **queries.tokenizer_files(), **more).collect()


def check_packing(rows, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_files()["tokenizer"])
    wanted = collections.Counter(
        (i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])) for i, t in documents
    )
    by_sequence = collections.defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in r.ids))
        by_sequence[r.sequence_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= 1024
        assert pieces[0].padding == (0 if at & (at - 1) == 0 else 1024 - at)
    # Pieces of a document follow each other in the stream; repeated ids come one after another.
    ordered = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    made, open_ = collections.Counter(), {}
    for r in ordered:
        held = open_.setdefault(r.doc_id, [])
        assert r.start == len(held)
        held.extend(r.ids)
        if len(held) == r.doc_tokens:
            made[(r.doc_id, tuple(held))] += 1
            open_[r.doc_id] = []
    assert made == wanted and not any(open_.values())


def test_packing_of_all_documents(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    rows = packed_rows(docs)
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])
    tokens = sum(r.length for r in rows)
    padding = sum({r.sequence_id: r.padding for r in rows}.values())
    assert padding < 0.03 * tokens


def test_packing_of_awkward_rows(spark):
    texts = [*awkward(), (9, "a <|endoftext|> b", "en", "a", 1)]
    df = spark.createDataFrame([(*r, 5) for r in texts], SCHEMA + ", start long").repartition(1)
    small = dp_packing.Packing(buffer=3000)  # many refills of the stream
    check_packing(packed_rows(df, packing=small), [(r[0], r[1]) for r in texts])
    assert packed_rows(df.limit(0)) == []


def test_cuts_are_the_best():
    """Against all ways to cut a small stream."""
    places, penalties, size = [0, 3, 5, 6, 9, 12, 14], [0, 2.0, 0, 5.0, 0, 2.0, 0], 8
    best = {0: (0.0, [])}
    for j in range(1, len(places)):
        ways = []
        for i in range(j):
            length = places[j] - places[i]
            if length <= size and i in best:
                padding = 0 if length & (length - 1) == 0 else size - length
                ways.append((best[i][0] + padding + penalties[j] + 1.0, [*best[i][1], j]))
        best[j] = min(ways)
    found = dp_packing.cuts(places, penalties, size, 1.0)
    cost = 0.0
    for i, j in zip([0, *found], found, strict=False):
        length = places[j] - places[i]
        cost += (0 if length & (length - 1) == 0 else size - length) + penalties[j] + 1.0
    assert cost == best[len(places) - 1][0]


# Chat formatting


def test_texts_that_look_like_control_strings_come_back():
    turns = [("user", "\\### Assistant: </turn> ok"), ("a:b\n", "###\n</turn>\n### x:\n"), ("", "")]
    assert chat_render.parse(chat_render.turn_template(turns)) == turns


def test_spans_are_located():
    turns = [("user", "hi\n</turn>"), ("assistant", "\nyes"), ("assistant", "")]
    done = chat_render.render_incrementally(turns, chat_render.turn_template)
    assert done.rewritten == []
    assert [chat_render.unescape(done.text[a:b]) for a, b in done.text_spans] == [t for _, t in turns]
    assert "".join(done.text[a:b] for a, b in done.spans) == done.text


def test_rewriting_templates_are_detected():
    def last_marked(turns):
        return "".join(f"<{r}>{t}\n" for r, t in turns[:-1]) + f"<last {turns[-1][0]}>{turns[-1][1]}\n"

    done = chat_render.render_incrementally([("u", "a"), ("s", "b"), ("u", "c")], last_marked)
    assert done.rewritten == [1, 2]


def test_chat_on_awkward_rows(spark):
    rows = [
        (1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, None, None, "x"),
        (None, 0, "assistant", "n"), (2, 0, "assistant", "y" * 100_000), (3, 0, "user", ""),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n_turns long")
    out = {r.conv_id: r for r in chat_render.digests(chat_render.format_conversations(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert out[1].n_turns == 4 and out[1].turns_sha256 == sha("\nx\nuser\na\nassistant\n\nassistant\n\n")
    assert out[None].loss_sha256 == sha("n") and out[2].loss_chars == 100_000 and out[3].loss_chars == 0
    assert chat_render.format_conversations(df.limit(0)).count() == 0


# Licenses


def test_licenses_against_brute_force(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    rows = entry.queries()["op1_license_scan"](spark, SMALL).collect()
    found = {(r.doc_id, r.license) for r in rows}
    wanted = set()
    for d in docs:
        words = license_scan.words_of(d.text or "")
        for name, text in license_scan.TEMPLATES.items():
            own = license_scan.words_of(text)
            k = min(5, len(own))
            shingles = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)}
            grams = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
            reach = len(own)
            best = max(
                (len(shingles.intersection(grams[max(0, i - reach) : i + reach])) for i, g in enumerate(grams) if g in shingles),
                default=0,
            )
            if best >= 0.8 * len(shingles):
                wanted.add((d.doc_id, name))
    assert found == wanted and found


def test_licenses_inside_long_and_awkward_texts(spark):
    text = license_scan.TEMPLATES["MIT-text"]
    rows = [*awkward(), (10, prose(5, 3000) + " " + text.upper() + " " + prose(6, 300), "en", "a", 1)]
    changed = text.replace("including", "with").replace("merge", "mix")
    rows.append((11, changed + "\n" + text + "\n" + "All rights reserved.", "en", "a", 1))
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", license string")
    out = {(r.doc_id, r.license): r for r in license_scan.scan_licenses(df).collect()}
    assert set(out) == {(10, "MIT-text"), (11, "MIT-text"), (11, "all-rights-reserved")}
    assert out[10, "MIT-text"].first_word == 3000 and out[10, "MIT-text"].containment == 1.0
    assert license_scan.scan_licenses(df.limit(0)).count() == 0


# URLs


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_urls_and_cascade(spark, max_bytes):
    urls = [
        (1, "HTTP://A.Example.ORG/en/12?x", "a.example.org", "/en/12", "example.org/en/1", "block"),
        (2, "http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        (3, "http://x.com/de/1#t", "x.com", "/de/1", "com/de/", "block"),
        (4, "http://x.com/en/1", "x.com", "/en/1", None, "block"),
        (5, "http://notcom/de/", "notcom", "/de/", None, "allow"),
        (6, None, "", "", None, "allow"),
        (7, "no scheme/", "", "", None, "allow"),
        (8, "s://h://p/q", "h:", "//p/q", None, "allow"),
        (9, "https://org", "org", "", None, "allow"),
        (9, "https://org", "org", "", None, "allow"),
    ]
    df = spark.createDataFrame([(u[0], u[1], "clash") for u in urls], "page_id long, url string, host string")
    out = filter_cascade.filter_urls(df, queries.URL_RULES, max_bytes=max_bytes)
    found = sorted(tuple(r) for r in out.select("page_id", "url", "host", "path", "rule", "verdict").collect())
    assert found == sorted(urls)
    assert filter_cascade.filter_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).selectExpr("concat('host', id) AS key", "id % 7 = 0 AS listed")
    levels = filter_cascade.cascade(universe)
    assert len(levels) > 1 and sum(len(x.bits) for x in levels) < 20_000
    from pyspark.sql import functions as F

    wrong = universe.where(filter_cascade.member(F.col("key"), levels) != F.col("listed"))
    assert wrong.count() == 0


def test_longest_rule_wins_whatever_the_order(spark):
    from pyspark.sql import functions as F

    rules = [Rule("block", "a.b", "/x/"), Rule("allow", "b", "/")]
    df = spark.createDataFrame([("c.a.b", "/x/1"), ("b", "/x/1")], "host string, path string")
    for order in (rules, rules[::-1]):
        name, verdict = filter_cascade.longest_rule(F.col("host"), F.col("path"), order)
        assert [tuple(r) for r in df.select(name, verdict).collect()] == [("a.b/x/", "block"), ("b/", "allow")]


def test_short_documents_are_held_against_the_templates():
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.LicenseScan())
    cases = {
        "This work is licensed under the GNU General Public License, version": "GPL-3.0",
        " ".join(license_scan.TEMPLATES["BSD-text"].split()[:18]): "BSD-text",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by": "LGPL-text",
        license_scan.TEMPLATES["Unlicense"]: "Unlicense",
    }
    for text, name in cases.items():
        wanted = license_words(name)
        here = {tuple(w) for w in zip(*[license_scan.words_of(text)[i:] for i in range(5)], strict=False)}
        share = len(wanted & here) / len(wanted)
        assert share >= 0.8, name
        assert {n: c for n, c, _, _ in scanner.find(text)}.get(name) == share
    assert not scanner.find("This work is of the General public version")
    assert not scanner.find("one two")


def license_words(name):
    words = license_scan.words_of(license_scan.TEMPLATES[name])
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
