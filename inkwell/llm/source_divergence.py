"""Divergence of sources: how far the words of each source are from those of the others of its language.

Identical texts of a language are collapsed first: one row per text with the number of its copies in
each source. Each text is split into terms once, and counts and document frequencies are added with
these weights. The sums over all terms for a pair of sources come from the terms that both have, from
histograms of counts for the terms that one has, and from one value for those that none has.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import batch_rows, text_or_empty, written

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCALE = 1_000_000_000
_PAIRS = 2_000_000  # compared at a time in a task


@dataclass(frozen=True)
class Audit:
    """least: documents of a language that a kept term is in; top: terms reported per source;
    held: distinct (source, term) that a task gathers before it hands them on."""

    least: int = 3
    top: int = 200
    held: int = 400_000


def collapsed(documents: DataFrame) -> DataFrame:
    """(lang, text, copies): each text of a language once, with the (source, n) of its copies.

    Copies are counted by digest before the shuffle and a task passes on a text once, so that copies
    of one text in any number do not meet. Null text, lang and source count as empty.
    """
    rows = documents.select(
        text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"), text_or_empty().alias("text")
    ).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    copies = (
        rows.groupBy("lang", "digest", "source")
        .agg(F.count("*").alias("n"))
        .groupBy("lang", "digest")
        .agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    )
    texts = rows.select("lang", "digest", "text").where("text != ''").dropDuplicates(["lang", "digest"])
    return texts.join(copies, ["lang", "digest"]).select("lang", "text", "copies")


def term_counts(texts: DataFrame, settings: Audit) -> DataFrame:
    """(lang, term, source, n, docs): occurrences and documents, added up by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: defaultdict[tuple[str, str], Counter[bytes]] = defaultdict(Counter)
        docs: defaultdict[tuple[str, str], Counter[bytes]] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), own in counts.items():
                in_docs = docs[lang, source]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(own), pa.string()),
                        pa.array(list(own), pa.binary()).cast(pa.string()),
                        pa.array([source] * len(own), pa.string()),
                        pa.array(list(own.values()), pa.int64()),
                        pa.array([in_docs[w] for w in own], pa.int64()),
                    ],
                    names=["lang", "term", "source", "n", "docs"],
                )
            counts.clear()
            docs.clear()

        for whole in batches:
            for batch in batch_rows(whole):
                langs, copies = batch.column("lang").to_pylist(), batch.column("copies").to_pylist()
                for lang, text, sources in zip(langs, batch.column("text"), copies, strict=True):
                    words = TERM.findall(text.as_buffer().to_pybytes().lower())
                    if len(sources) == 1 and sources[0]["n"] == 1:
                        group = lang, sources[0]["source"]
                        counts[group].update(words)
                        docs[group].update(set(words))
                        continue
                    once = Counter(words)
                    for s in sources:
                        total, in_docs, n = counts[lang, s["source"]], docs[lang, s["source"]], s["n"]
                        for w, c in once.items():
                            total[w] += c * n
                            in_docs[w] += n
                if sum(map(len, counts.values())) > settings.held:
                    yield from out()
        yield from out()

    return texts.mapInArrow(run, "lang string, term string, source string, n long, docs long")


def kept_terms(counts: DataFrame, settings: Audit) -> DataFrame:
    """(lang, term, sources): the terms in ``least`` documents of a language, with (source, n) of each."""
    return (
        counts.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources"))
        .where(F.col("docs") >= settings.least)
        .select("lang", "term", "sources")
    )


def share(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a term in billionths, exact."""
    up = (n + F.lit(1)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    down = (total + terms).cast("decimal(20,0)")
    return F.lit(1).cast("long") + quotient(up, F.nullif(down, F.lit(0).cast("decimal(20,0)")))


def quotient(a: Column, b: Column) -> Column:
    """Whole quotient of numbers that are not negative."""
    return F.call_function("div", a, b)


def distance(p: Column, q: Column) -> Column:
    return quotient((p - q) * (p - q), q)


def _common(terms: DataFrame) -> DataFrame:
    """(lang, source, item, value): for each two sources, over the terms that both have, what the
    true distance adds to that of either alone. Terms come as (lang, entries of (source, p, none)),
    ``none`` being the share of a term that the source does not have.
    """

    def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for number, lang in enumerate(langs.dictionary.to_pylist()):
                rows = np.flatnonzero(langs.indices.to_numpy(zero_copy_only=False) == number)
                lists = batch.column("entries").take(pa.array(rows))
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten()
                names = flat.field("source").dictionary_encode()
                own = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                p = flat.field("p").to_numpy(zero_copy_only=False)
                none = flat.field("none").to_numpy(zero_copy_only=False)
                size = np.repeat(sizes, sizes)  # partners of each entry, itself included
                first = np.repeat(np.cumsum(sizes) - sizes, sizes)
                ends = np.cumsum(size)
                total = int(ends[-1]) if len(ends) else 0
                cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, total, _PAIRS)), len(ends)))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    left = np.repeat(np.arange(a, b), size[a:b])
                    start = np.repeat(np.cumsum(size[a:b]) - size[a:b], size[a:b])
                    right = np.arange(len(left)) - start + first[left]
                    left, right = left[left != right], right[left != right]
                    if not len(left):
                        continue
                    value = distances(p[left], p[right]) - distances(none[left], p[right])
                    value += distances(none[left], none[right]) - distances(p[left], none[right])
                    code = own[left] * len(names.dictionary) + own[right]
                    order = np.argsort(code, kind="stable")
                    code = code[order]
                    heads = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
                    sums = np.add.reduceat(value[order], heads)
                    one, other = np.divmod(code[heads], len(names.dictionary))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(heads), pa.string()),
                            names.dictionary.take(pa.array(one)),
                            names.dictionary.take(pa.array(other)),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["lang", "source", "item", "value"],
                    )

    return terms.mapInArrow(run, "lang string, source string, item string, value long")


def audit(documents: DataFrame, settings: Audit | None = None) -> DataFrame:
    """Divergence of every (lang, source) from the other sources of its language and from the language.

    Rows (lang, source, part, item, value, rank). Part ``pair`` has each other source of the language and
    the sum of the distances of all kept terms, part ``term`` the terms that the source has more often
    than its language. Ranks fall with the value; ties go by the item's UTF-8 bytes. Null text, lang and
    source count as empty; groups without terms have pairs as well, of value 0 in a language without kept
    terms. Repeated rows count repeatedly, texts of any length whole; an empty table gives no rows, and
    other columns of ``documents`` do not matter.
    """
    settings = settings or Audit()
    terms, _ = written(kept_terms(term_counts(collapsed(documents), settings), settings), "divergence-terms")
    entries = terms.select("lang", "term", F.inline("sources"))
    langs = entries.groupBy("lang").agg(F.sum("n").alias("lang_n")).join(
        terms.groupBy("lang").agg(F.count("*").alias("terms")), "lang"
    )
    found = documents.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct()
    groups, _ = written(
        found.join(entries.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "lang_n", "terms"])
        .withColumn("none", share(F.lit(0), F.col("total"), F.col("terms"))),
        "divergence-groups",
    )
    own_share = share(F.col("n"), F.col("total"), F.col("terms")).alias("p")
    shares = entries.join(groups, ["lang", "source"]).select(
        "lang", "term", "source", "n", own_share, "none", "lang_n", "terms"
    )

    # What a term adds that only one of the two has, by the counts that occur.
    counts = shares.groupBy("lang", "source", "n").agg(
        F.first("p").alias("p"), F.first("none").alias("none"), F.count("*").alias("times")
    )
    one = counts.withColumnRenamed("source", "one")
    other = groups.where("terms > 0").select("lang", F.col("source").alias("other"), F.col("none").alias("base"))
    alone = one.join(other, "lang").where("one != other")
    from_here = alone.select(
        "lang", F.col("one").alias("source"), F.col("other").alias("item"),
        (F.col("times") * (distance(F.col("p"), F.col("base")) - distance(F.col("none"), F.col("base")))).alias("value"),
    )
    from_there = alone.select(
        "lang", F.col("other").alias("source"), F.col("one").alias("item"),
        (F.col("times") * (distance(F.col("base"), F.col("p")) - distance(F.col("base"), F.col("none")))).alias("value"),
    )
    here = groups.select("lang", "source", F.col("none").alias("p"), "terms")
    neither = here.join(groups.select("lang", F.col("source").alias("item"), F.col("none").alias("q")), "lang").where(
        "source != item"
    )
    floor = F.coalesce(F.col("terms") * distance(F.col("p"), F.col("q")), F.lit(0).cast("long"))
    neither = neither.select("lang", "source", "item", floor.alias("value"))
    shared = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "none")).alias("entries"))
    both = _common(shared.where(F.size("entries") > 1).select("lang", "entries"))
    pairs = (
        neither.union(from_here).union(from_there).union(both)
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )

    whole = entries.groupBy("lang", "term").agg(F.sum("n").alias("lang_count"))
    more = shares.join(whole, ["lang", "term"]).withColumn(
        "q", share(F.col("lang_count"), F.col("lang_n"), F.col("terms"))
    )
    more = more.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value")
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    ranked_pairs = pairs.select("*", rank.alias("rank"), F.lit("pair").alias("part")).select(columns)
    ranked_terms = more.select("*", rank.alias("rank"), F.lit("term").alias("part")).where(
        F.col("rank") <= settings.top
    )
    return ranked_pairs.union(ranked_terms.select(columns))
