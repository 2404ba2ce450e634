"""Benchmark decontamination by templates: a question is found again with other numbers or names.

Texts are reduced to templates: lower-case words without punctuation, where numbers, units after
numbers and names inside sentences are typed placeholders. Windows of a benchmark item's template
are joined by hash with those of the documents. Where enough windows of an item meet, the values
in the placeholders are compared: each value of the item must stand for one value of the document,
as when a question is asked again with other parameters.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import checkpointed, text_or_empty

# Placeholders are single characters of Unicode's private use area.
NUMBER, UNIT, NAME = "\ue001", "\ue002", "\ue003"
MARKS = NUMBER + UNIT + NAME
UNITS = (
    "%", "percent", "km", "kilometers", "kilometres", "m", "meters", "metres", "cm", "mm", "miles",
    "feet", "inches", "kg", "kilograms", "g", "grams", "mg", "lb", "pounds", "tons", "l", "liters",
    "litres", "ml", "s", "seconds", "minutes", "hours", "days", "weeks", "months", "years", "km/h",
    "mph", "dollars", "euros", "cents", "degrees", "watts", "volts",
)
_NUMBER = r"(?<![\p{L}\p{N}])[$€£]?\d[\d.,]*(?<=\d)"
_UNIT = r"(?:" + "|".join(sorted((u for u in UNITS), key=len, reverse=True)) + r")(?![\p{L}\p{N}])"
_QUANTITY = f"(?i)({_NUMBER})(?:(\\s?)({_UNIT}))?"
# A capital inside a sentence: the word before ends in no sentence mark. Placeholders have spaces around
# them, so a name may follow several.
_NAME = r"(?=\p{Lu})(?<=[^.!?:\s]\s{1,4})\p{Lu}[\p{L}\p{M}'’-]*+"
_BETWEEN = rf"[^\p{{L}}\p{{M}}\p{{N}}{MARKS}]+"


@dataclass(frozen=True)
class Templates:
    """window: words of a window; coverage: least share of an item's windows that must meet, or
    run: windows that meet in one alignment; literals: least number of words in a window that are
    no placeholders; broadcast_rows: most rows of a table that is sent to all executors.
    """

    window: int = 8
    coverage: float = 0.5
    run: int = 6
    literals: int = 4
    broadcast_rows: int = 200_000


def template(text: Column) -> Column:
    """The words of a text's template, in order."""
    clean = F.translate(text, MARKS, " " * len(MARKS))
    numbers = F.regexp_replace(clean, _QUANTITY, f" {NUMBER}$2$3 ")
    # A unit is kept by the step above and becomes a placeholder only after a number's.
    units = F.regexp_replace(numbers, f"(?i)(?<={NUMBER})\\s?{_UNIT}", f" {UNIT} ")
    names = F.regexp_replace(units, _NAME, f" {NAME} ")
    words = F.regexp_replace(F.lower(names), _BETWEEN, " ")
    # The text stands here once: a condition on it would evaluate all of the above again.
    return F.filter(F.split(words, " "), lambda w: w != "")


def values(text: Column) -> Column:
    """What the placeholders of the template stand for, in order."""
    clean = F.translate(text, MARKS, " " * len(MARKS))
    quantities = F.regexp_replace(clean, _QUANTITY, f" {NUMBER}$1{NUMBER}$2$3 ")
    marked = F.regexp_replace(
        quantities, f"(?i)(?<=\\d{NUMBER}|[.,]{NUMBER})\\s?({_UNIT})", f" {UNIT}$1{UNIT} "
    )
    marked = F.regexp_replace(marked, f"({_NAME})", f"{NAME}$1{NAME}")
    found = F.regexp_extract_all(marked, F.lit(f"([{MARKS}])([^{MARKS}]*+)\\1"), 2)
    return F.transform(found, lambda v: F.lower(v))


def _windows(words: Column, size: int) -> Column:
    """Hashes of all windows of this many words; a shorter text has none."""
    starts = F.sequence(F.lit(0), F.size(words) - size)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, size)))
    return F.when(F.size(words) >= size, hashes).otherwise(F.array().cast("array<bigint>"))


def _is_mark(word: Column) -> Column:
    return F.length(word).eqNullSafe(1) & F.lit(MARKS).contains(word)


def _sent(df: DataFrame, settings: Templates) -> DataFrame:
    """A table for the small side of a join: sent to all only when its measured size allows."""
    return F.broadcast(df) if df.count() <= settings.broadcast_rows else df


def _slots(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, place of the word in the template, value: one row per placeholder of a text."""
    words = texts.select(*keys, F.col("words"), F.col("found"))
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: _is_mark(F.get("words", i)))
    both = words.where(F.size("words") > 0).select(*keys, F.arrays_zip(places.alias("at"), "found").alias("z"))
    return both.select(*keys, F.explode("z").alias("z")).select(
        *keys, F.col("z.at").alias("at"), F.col("z.found").alias("value")
    )


def leaks(
    documents: DataFrame, benchmark: DataFrame, settings: Templates | None = None
) -> DataFrame:
    """doc_id, text_hash, item_id, windows met, windows of the item, coverage, run, slots,
    verbatim, for each pair of a document and an item that it holds.

    An item is held when its windows meet as ``Templates`` says and its slots are consistent in one
    of the alignments that meet so, or in the longest.
    Windows with too few literal words are left out, unless an item has no others. Items shorter
    than a window match whole documents with the same template. Null texts count as empty and
    match nothing; an item without words matches nothing. Documents with the same id and text
    come out once; other columns do not matter.
    """
    s = settings or Templates()
    items = checkpointed(
        benchmark.select("item_id", text_or_empty().alias("text"))
        .distinct()
        .select(
            "item_id", template(F.col("text")).alias("words"), values(F.col("text")).alias("found"),
            F.rlike("text", F.lit(r"^[^\p{L}\p{N}]*\p{Lu}")).alias("capital"),
        )
    )
    lengths = items.select(F.size("words").alias("n")).where(F.col("n").between(1, s.window - 1)).distinct()
    short = sorted(r.n for r in lengths.collect())  # fewer than the words of a window
    length = F.least(F.size("words"), F.lit(s.window))
    named = F.concat(F.array(F.lit(NAME)), F.slice("words", 2, F.size("words")))
    by_length = [
        items.where(length == n).select(
            "item_id", "words", F.lit(n).alias("length"), _windows(F.col("words"), n).alias("hashes"),
            F.when(F.col("capital"), _windows(named, n)[0]).alias("other"),
        )
        for n in [*short, s.window]
    ]
    windows = reduce(DataFrame.union, by_length)
    each = windows.select("item_id", "words", "length", "other", F.posexplode("hashes").alias("item_at", "hash"))
    literal = F.size(F.filter(F.slice("words", F.col("item_at") + 1, F.col("length")), lambda w: ~_is_mark(w)))
    each = each.withColumn("good", literal >= F.least(F.lit(s.literals), F.size("words")))
    sizes = each.groupBy("item_id").agg(F.count_if("good").alias("good_ones"), F.count("*").alias("every"))
    each = (
        each.join(sizes, "item_id")
        .where(F.col("good") | (F.col("good_ones") == 0))
        .select(
            "item_id", "item_at", "length",
            F.explode(F.array_compact(F.array("hash", F.when(F.col("item_at") == 0, F.col("other"))))).alias("hash"),
            F.when(F.col("good_ones") > 0, F.col("good_ones")).otherwise(F.col("every")).alias("item_windows"),
        )
    )
    each = checkpointed(each)

    docs = documents.select("doc_id", text_or_empty().alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    key = ["doc_id", "text_hash", "item_id"]
    own = docs.select("doc_id", "text_hash", template(F.col("text")).alias("words"))
    if short:
        by_length = F.array(
            *[F.struct(F.lit(n).alias("length"), _windows(F.col("words"), n).alias("hashes")) for n in [*short, s.window]]
        )
        own = own.select("doc_id", "text_hash", F.explode(by_length).alias("of")).select(
            "doc_id", "text_hash", "of.length", F.posexplode("of.hashes").alias("at", "hash")
        )
    else:
        own = own.select(
            "doc_id", "text_hash", F.lit(s.window).alias("length"),
            F.posexplode(_windows(F.col("words"), s.window)).alias("at", "hash"),
        )
    met = (
        own.join(_sent(each, s), ["length", "hash"])
        # Of the places of a document where a window of the item stands, each alignment counts once.
        .groupBy(*key, "item_windows", "item_at", (F.col("at") - F.col("item_at")).alias("shift"))
        .agg(F.lit(1).alias("one"))
    )
    met = checkpointed(met.drop("one"))
    shifts = met.groupBy(*key, "item_windows", "shift").agg(F.count("*").alias("own_run"))
    enough = (F.col("own_run") >= s.run) | (F.col("own_run") / F.col("item_windows") >= s.coverage)
    runs = shifts.groupBy(*key).agg(
        F.max_by("shift", F.struct("own_run", -F.col("shift"))).alias("best"),
        F.max("own_run").alias("run"),
        F.collect_set(F.when(enough, F.col("shift"))).alias("others"),
    )
    found = (
        met.groupBy(*key, "item_windows")
        .agg(F.count_distinct("item_at").alias("windows"))
        .join(_null_safe(runs, key), _same(key))
        .drop(*[f"_{k}" for k in key])
        .withColumn("coverage", F.col("windows") / F.col("item_windows"))
        .where((F.col("coverage") >= s.coverage) | (F.col("run") >= s.run))
    )
    found = checkpointed(found)

    # Slots of the alignments of each pair.
    whole = docs.join(
        _sent(_null_safe(found.select("doc_id", "text_hash").distinct(), ["doc_id", "text_hash"]), s),
        _same(["doc_id", "text_hash"]), "left_semi",
    ).distinct()
    doc_slots = _slots(
        whole.select(
            "doc_id", "text_hash", template(F.col("text")).alias("words"), values(F.col("text")).alias("found")
        ),
        ["doc_id", "text_hash"],
    )
    tried = found.select(*key, F.explode(F.array_union(F.array("best"), "others")).alias("shift"))
    covered = tried.join(
        _null_safe(met.withColumn("met_shift", F.col("shift")).select(*key, "item_at", "met_shift"), key),
        _same(key) & (F.col("shift") == F.col("met_shift")),
    )
    covered = (
        covered.select(*key, "shift", F.explode(F.sequence("item_at", F.col("item_at") + s.window - 1)).alias("at"))
        .distinct()
        .join(_slots(items, ["item_id"]).withColumnRenamed("value", "item_value"), ["item_id", "at"])
        .withColumn("doc_at", F.col("at") + F.col("shift"))
    )
    slots = doc_slots.select(
        F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash"),
        F.col("at").alias("_at"), F.col("value").alias("doc_value"),
    )
    compared = covered.join(
        slots, _same(["doc_id", "text_hash"]) & (F.col("doc_at") == F.col("_at"))
    ).select(*key, "shift", "item_value", "doc_value")
    verdicts = (
        compared.groupBy(*key, "shift")
        .agg(
            F.count("*").alias("slots"),
            F.count_distinct("item_value").alias("item_values"),
            F.count_distinct("item_value", "doc_value").alias("pairs"),
            F.bool_and(F.col("item_value") == F.col("doc_value")).alias("equal"),
        )
    )
    consistent = F.col("pairs").isNull() | (F.col("pairs") == F.col("item_values"))
    verdict = F.struct(
        F.coalesce("equal", F.lit(True)).alias("verbatim"), F.coalesce("slots", F.lit(0)).alias("slots")
    )
    held = (
        tried.join(_null_safe(verdicts, [*key, "shift"]), _same([*key, "shift"]), "left")
        .where(consistent)
        .groupBy(*key)
        .agg(F.max(verdict).alias("verdict"))
    )
    return found.join(_null_safe(held, key), _same(key)).select(
        *key, "windows", "item_windows", "coverage", "run", "verdict.slots", "verdict.verbatim"
    )


def _null_safe(df: DataFrame, keys: list[str]) -> DataFrame:
    for k in keys:
        df = df.withColumnRenamed(k, f"_{k}")
    return df


def _same(keys: list[str]) -> Column:
    """Equality of keys with those renamed by :func:`_null_safe`, for null ids too."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return condition


def without_leaks(documents: DataFrame, benchmark: DataFrame, settings: Templates | None = None) -> DataFrame:
    """The documents that hold no item of the benchmark, with all their columns."""
    s = settings or Templates()
    keys = ["doc_id", "text_hash"]
    found = checkpointed(leaks(documents, benchmark, s).select(*keys).distinct())
    named = documents.withColumn("_hash", F.xxhash64(text_or_empty()))
    condition = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_hash") == F.col("_text_hash"))
    return named.join(_sent(_null_safe(found, keys), s), condition, "left_anti").drop("_hash")
