"""PII: patterns find personal data, and a corpus tells which other terms give it away.

Besides e-mail and IP addresses, card and phone numbers, a term can disclose a protected value
when it occurs with it and hardly anywhere else. Over distinct texts, the information that a term
t gives about a value e is PMI(e; t) = ln(N n(e,t) / (n(e) n(t))), at most IC(e) = ln(N / n(e)).
Terms that give most of IC(e) are generalised, those that give nearly all of it are removed.

All of it is column functions. Places come from the lengths of matches and of the gaps between
them, so that no text is walked per match.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import checkpointed, text_or_empty
from inkwell.operators.joins import heavy_keys, lookup

KINDS = ("email", "ip", "card", "phone")
# Characters of Unicode's private use area replace the marks that join two characters. Runs with
# joints are then plain character classes, which need no backtracking however long the text. The
# text's own characters of this kind count as U+FFFD.
DOT, SPACE, DASH = "\ue010", "\ue011", "\ue012"
JOINTS = DOT + SPACE + DASH
_LABEL = "[A-Za-z0-9-]"
_JOINED = {
    "email": [(rf"(?<={_LABEL})\.(?={_LABEL})", DOT)],
    "card": [(r"(?<=[0-9])\x20(?=[0-9])", SPACE), (r"(?<=[0-9])-(?=[0-9])", DASH)],
}
# A match starts where a run starts, or where the match before ended.
_PATTERNS = {
    "email": rf"(?:\G|(?<![A-Za-z0-9._%+\-{DOT}]))[A-Za-z0-9._%+\-{DOT}]++@"
    rf"[A-Za-z0-9-]++{DOT}[A-Za-z0-9\-{DOT}]++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"[0-9][0-9{SPACE}{DASH}]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a match that counts.
_NEEDED = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){12}",
    "phone": r"\+[0-9]",
}
_TERM = r"\p{L}{4,}+"


@dataclass(frozen=True)
class Disclosure:
    """min_texts: distinct texts in which value and term must meet; generalise and remove: shares
    of IC(e) that a term must give; broadcast_rows: most rows, or entries of arrays, of a table that is
    sent to all executors; broadcast_terms: most disclosing terms that are (some 60 bytes each).
    """

    min_texts: int = 3
    generalise: float = 0.9
    remove: float = 0.98
    broadcast_rows: int = 100_000
    broadcast_terms: int = 1_000_000


def running_sums(values: Column) -> Column:
    """Running sums of an array of numbers: within blocks of 256, then over the blocks' sums.

    Appending to an array copies it, so single appends over a long array would be quadratic.
    """
    block = 256

    def summed(items: Column, start: Column) -> Column:
        return F.aggregate(
            items,
            F.struct(start.cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("all")),
            lambda s, v: F.struct(
                (s["sum"] + v).alias("sum"), F.concat(s["all"], F.array(s["sum"] + v)).alias("all")
            ),
            lambda s: s["all"],
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int")),
        lambda b: F.slice(values, b * block + 1, block),
    )
    parts = F.transform(blocks, lambda b: summed(b, F.lit(0)))
    ends = F.transform(parts, lambda p: F.element_at(p, -1))
    before = F.concat(F.array(F.lit(0).cast("bigint")), summed(ends, F.lit(0)))
    whole = F.flatten(F.zip_with(parts, F.slice(before, 1, F.size(ends)), lambda p, s: F.transform(p, lambda v: v + s)))
    return F.when(F.size(values) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), n), value), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _counts(kind: str, match: Column) -> Column:
    """Whether a match of a kind's pattern is personal data."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    digits = _digits(match)
    size = F.length(digits)
    if kind == "card":
        return F.when((size >= 13) & (size <= 19), _luhn(digits)).otherwise(F.lit(False))
    return (size >= 9) & (size <= 15)


def _joined(kind: str, text: Column) -> Column:
    """The text with joints, as long as before."""
    if kind in _JOINED:
        text = F.translate(text, JOINTS, "\ufffd" * len(JOINTS))
        for pattern, joint in _JOINED[kind]:
            text = F.regexp_replace(text, pattern, joint)
    return text


def _restored(text: Column) -> Column:
    return F.translate(text, JOINTS, ". -")


def _cut(text: Column, pattern: str) -> tuple[Column, Column]:
    """The matches of a pattern, and the texts before, between and after them."""
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), 1), F.split(text, pattern, -1)


def with_spans(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with ``_email`` ... ``_phone``: for each kind the matches that count, as an
    array of (start, end, match).
    """
    columns = documents.columns
    for kind in KINDS:
        found, gaps = _cut(_joined(kind, F.col(text)), _PATTERNS[kind])
        present = F.col(text).contains("@") if kind == "email" else F.col(text).rlike(_NEEDED[kind])
        cut = (
            documents.withColumn("_present", present)
            .withColumn("_found", F.when(F.col("_present"), found))
            .withColumn("_gaps", F.when(F.col("_present"), gaps))
        )
        n = F.size("_found")
        sizes = F.transform("_found", lambda m: F.length(m))
        shifted = F.concat(F.array(F.lit(0)), F.slice(sizes, 1, F.greatest(n - 1, F.lit(0))))
        steps = F.zip_with(
            F.transform(F.slice("_gaps", 1, n), lambda g: F.length(g)), shifted, lambda a, b: a + b
        )
        cut = cut.withColumn("_starts", F.when(n > 0, running_sums(steps)))
        spans = F.transform(
            F.arrays_zip(
                F.col("_starts").alias("start"),
                F.col("_found").alias("match"),
            ),
            lambda z: F.struct(
                z["start"].alias("start"),
                (z["start"] + F.length(z["match"])).alias("end"),
                _restored(z["match"]).alias("match"),
            ),
        )
        good = F.filter(F.when(n > 0, spans), lambda s: _counts(kind, s["match"]))
        empty = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
        documents = cut.withColumn(f"_{kind}", F.coalesce(good, empty)).select(*columns, f"_{kind}")
        columns = documents.columns
    return documents


def _shown(kind: str, spans: Column) -> Column:
    return F.transform(
        spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
    )


def _sent(df: DataFrame, most: int, size: Column | None = None) -> DataFrame:
    """A table for the small side of a join: sent to all only when its measured size allows.

    ``size``: entries of a row that has arrays.
    """
    entries = df.agg(F.sum(F.lit(1) if size is None else size)).first()[0] or 0
    return F.broadcast(df) if entries <= most else df


def _terms_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({_TERM})"), 1))


def disclosing_terms(spans: DataFrame, settings: Disclosure) -> DataFrame | None:
    """(key, _terms): for texts with terms that give ``generalise`` or more of a value's
    information, those terms with their shares. None if there are no terms to look for.

    ``spans``: key and text of each document with the columns of :func:`with_spans`. Values come
    from one pass over the texts; terms count wherever they stand in a text with the value. A second
    pass counts the distinct texts of all terms, each task its own first, so that no pairs of text and
    term are kept; a third one looks up the few that are left.
    """
    every = F.concat(
        *[
            F.transform(F.col(f"_{kind}"), lambda s: F.concat_ws(":", F.lit(kind), s["match"])) for kind in KINDS
        ]
    )
    values = checkpointed(spans.select("key", F.explode(every).alias("value")).distinct())
    per_value = (
        values.groupBy("value").agg(F.count("*").alias("n_value")).where(F.col("n_value") >= settings.min_texts)
    )
    # Texts with a value that enough texts have; a value may be in a third of all texts.
    shared = lookup(values, per_value, "value", ["key"], heavy_keys(values, "value")).where("n_value is not null")
    shared = checkpointed(shared)
    if shared.isEmpty():
        return None
    copies = checkpointed(spans.groupBy("key").agg(F.count("*").alias("_copies")))
    total = float(copies.count())
    holders = _sent(checkpointed(shared.select("key").distinct()), settings.broadcast_rows)
    whole = spans.select("key", "text").join(holders, "key", "left_semi")
    whole = whole.dropDuplicates(["key"]).select("key", _terms_of(F.col("text")).alias("terms"))
    near = whole.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_near"))
    # A term can reach the share only while n(t) <= n(e,t) (N / n(e)) ^ (1 - share). The texts with a
    # shared value that have it already are a part of n(t), so most common terms end here.
    most = F.col("n_both") * F.pow(F.lit(total) / F.col("n_value"), F.lit(1 - settings.generalise))
    met = checkpointed(
        shared.join(whole, "key")
        .select("value", "n_value", F.explode("terms").alias("term"))
        .groupBy("value", "n_value", "term")
        .agg(F.count("*").alias("n_both"))
        .where(F.col("n_both") >= settings.min_texts)
        .join(near, "term")
        .where(F.col("n_near") <= most + 1e-6)
        .drop("n_near")
    )
    if met.isEmpty():
        return None
    # Each of a text's copies counts as a part of it; the sum differs from a whole number by rounding only.
    texts = spans.select("key", "text", F.monotonically_increasing_id().alias("_at"))
    several = copies.where(F.col("_copies") > 1)
    if several.count() <= settings.broadcast_rows:
        weighed = texts.join(F.broadcast(several), "key", "left")
    else:
        weighed = lookup(texts, several, "key", ["_at"], heavy_keys(texts, "key"))
    counted = (
        weighed.select(F.coalesce(F.lit(1.0) / F.col("_copies"), F.lit(1.0)).alias("part"), F.explode(_terms_of(F.col("text"))).alias("term"))
        .groupBy("term")
        .agg(F.round(F.sum("part")).cast("bigint").alias("n_term"))
    )
    pmi = F.log(F.lit(total) * F.col("n_both") / (F.col("n_value") * F.col("n_term")))
    information = F.log(F.lit(total) / F.col("n_value"))
    disclosing = checkpointed(
        met.join(counted, "term")
        .select("term", F.when(information > 0, F.try_divide(pmi, information)).alias("share"))
        .groupBy("term")
        .agg(F.max("share").alias("share"))
        .where(F.col("share") >= settings.generalise)
    )
    few = disclosing.count() <= settings.broadcast_terms
    terms = spans.select("key", F.explode(_terms_of(F.col("text"))).alias("term"))
    found = (
        terms.join(F.broadcast(disclosing), "term")
        if few
        else lookup(terms, disclosing, "term", ["key"], heavy_keys(terms, "term")).where(F.col("share").isNotNull())
    )
    return checkpointed(found.groupBy("key").agg(F.collect_set(F.struct("term", "share")).alias("_terms")))


def sanitise(documents: DataFrame, settings: Disclosure | None = None, text: str = "text") -> DataFrame:
    """``documents`` with n_email, n_ip, n_card, n_phone, n_term, base_spans, spans and sanitised.

    Spans are ``kind:start:end`` in code points with the end exclusive, by kind and start, joined
    by commas. ``sanitised`` has a placeholder for each: the kind's, ``[TERM]`` for a generalised
    term and nothing for a removed one. A null text counts as empty and has no spans. Equal texts
    count once in the statistics, so repeated rows come out repeatedly with the same result. Of equal
    shares for several values the greatest counts, so ties do not matter. Texts of any length are read
    whole; an empty table stays empty. Columns of ``documents`` with names of results are replaced.
    """
    settings = settings or Disclosure()
    results = ["n_email", "n_ip", "n_card", "n_phone", "n_term", "base_spans", "spans", "sanitised"]
    own = [c for c in documents.columns if c not in results and c != text]
    packed = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row") if own else F.lit(None).alias("_row"),
        F.col(text).alias("_original"),
        text_or_empty(text).alias("text"),
    )
    key = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    found = with_spans(packed).withColumn("key", key)
    terms = disclosing_terms(found.select("key", "text", *[f"_{k}" for k in KINDS]), settings)
    if terms is None:
        found = found.withColumn("_terms", F.lit(None).cast("array<struct<term:string,share:double>>"))
    else:
        found = found.join(_sent(terms, settings.broadcast_rows, F.size("_terms")), "key", "left")
    return _finished(found, own, text, settings)


def _finished(found: DataFrame, own: list[str], text: str, settings: Disclosure) -> DataFrame:
    has_terms = F.col("_terms").isNotNull()
    matches, gaps = _cut(F.col("text"), _TERM)
    found = found.withColumn("_words", F.when(has_terms, matches)).withColumn(
        "_between", F.when(has_terms, gaps)
    )
    names = F.transform("_terms", lambda t: t["term"])
    shares = F.map_from_arrays(names, F.transform("_terms", lambda t: t["share"]))
    found = found.withColumn("_shares", F.when(has_terms, shares)).withColumn(
        "_hits", F.transform("_words", lambda w: F.element_at("_shares", F.lower(w)))
    )
    sizes = F.transform("_words", lambda w: F.length(w))
    n = F.size("_words")
    shifted = F.concat(F.array(F.lit(0)), F.slice(sizes, 1, F.greatest(n - 1, F.lit(0))))
    steps = F.zip_with(F.transform(F.slice("_between", 1, n), lambda g: F.length(g)), shifted, lambda a, b: a + b)
    found = found.withColumn("_starts", F.when(n > 0, running_sums(steps)))
    term_spans = F.filter(
        F.transform(
            F.arrays_zip(F.col("_starts").alias("start"), F.col("_words").alias("word"), F.col("_hits").alias("hit")),
            lambda z: F.struct(
                z["start"].alias("start"), (z["start"] + F.length(z["word"])).alias("end"), z["hit"].alias("hit")
            ),
        ),
        lambda s: s["hit"].isNotNull(),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:double>>")
    found = found.withColumn("_term", F.coalesce(term_spans, none))
    replaced = F.concat_ws(
        "",
        F.flatten(
            F.zip_with(
                F.slice("_between", 1, n),
                F.zip_with(
                    "_words",
                    "_hits",
                    lambda w, h: F.when(h.isNull(), w)
                    .when(h >= settings.remove, F.lit(""))
                    .otherwise(F.lit("[TERM]")),
                ),
                lambda g, w: F.array(g, w),
            )
        ),
        F.element_at("_between", -1),
    )
    clean = F.when(F.size("_term") > 0, replaced).otherwise(F.col("text"))
    found = found.withColumn("sanitised", clean)
    for kind in KINDS:
        found = found.withColumn(
            "sanitised",
            F.when(F.size(f"_{kind}") > 0, _without(kind, F.col("sanitised"))).otherwise(F.col("sanitised")),
        )
    base = F.concat(*[_shown(kind, F.col(f"_{kind}")) for kind in KINDS])
    return found.select(
        *[F.col("_row")[c].alias(c) for c in own],
        F.col("_original").alias(text),
        *[F.size(f"_{kind}").cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.size("_term").cast("bigint").alias("n_term"),
        F.concat_ws(",", base).alias("base_spans"),
        F.concat_ws(",", F.concat(base, _shown("term", F.col("_term")))).alias("spans"),
        "sanitised",
    )


def _without(kind: str, text: Column) -> Column:
    """A text with the kind's placeholder for each match that counts."""
    matches, gaps = _cut(_joined(kind, text), _PATTERNS[kind])
    pieces = F.zip_with(
        gaps,
        F.transform(matches, lambda m: F.when(_counts(kind, _restored(m)), F.lit(f"[{kind.upper()}]")).otherwise(m)),
        lambda g, m: F.array(g, F.coalesce(m, F.lit(""))),
    )
    return _restored(F.concat_ws("", F.flatten(pieces)))
