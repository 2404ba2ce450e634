"""Quality rules: lines are judged first, then the document by what is left of it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import SPACES, batch_rows, text_or_empty, to_batch

SYMBOLS = "#*$%&|<>"
SEPARATORS = frozenset("| » « > < · • / - – — :: >> <<".split())
BOILERPLATE = re.compile(
    r"cookie policy|privacy policy|terms of (?:use|service)|enable javascript|click here|"
    r"sign in|log in|subscribe to our|share on (?:facebook|twitter)|lorem ipsum|back to top|"
    r"skip to (?:content|main)",
    re.IGNORECASE,
)

RESULT = pa.schema(
    [
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("n_lines", pa.int64()),
        ("n_bad_lines", pa.int64()),
        ("lost_chars", pa.int64()),
        ("cleaned", pa.string()),
    ]
)


@dataclass(frozen=True)
class LineRules:
    """Limits per line, and how much of a document may go.

    symbols: symbols per word; shouts: share of words that end in two or more marks of
    punctuation; separators: share of words that are bare separators, from min_separators on;
    boilerplate: words of a line that holds such a phrase, at most; loss: share of the word
    characters that may be lost.
    """

    symbols: float = 0.5
    shouts: float = 0.5
    separators: float = 0.25
    min_separators: int = 2
    boilerplate: int = 30
    loss: float = 0.5


def line_fails(line: str, rules: LineRules) -> bool:
    """Whether a line is navigation, boilerplate or has the punctuation of junk."""
    words = line.split()
    if not words:
        return False
    n = len(words)
    bare = sum(w in SEPARATORS for w in words)
    if bare >= rules.min_separators and bare >= rules.separators * n:
        return True
    if sum(map(line.count, SYMBOLS)) - line.count("|") > rules.symbols * n:
        return True
    if "!!" in line or "??" in line:
        if sum(w[-2:] in ("!!", "??", "!?", "?!") for w in words) > rules.shouts * n:
            return True
    return n <= rules.boilerplate and BOILERPLATE.search(line) is not None


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more in the text, the first included."""
    n = len(words)
    if n < 6:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    size = len(known)
    if size == n:
        return 0
    if size < 6000:
        key = ids[: n - 4].copy()
        for i in range(1, 5):
            key *= size
            key += ids[i : n - 4 + i]
    else:  # too many words to number all windows of five in one step
        two = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1].astype(np.int64)
        four = np.unique(two[:-2] * (n + 1) + two[2:], return_inverse=True)[1].astype(np.int64)
        key = four[: n - 4] * size + ids[4:]
    order = np.sort(key)
    again = order[1:][order[1:] == order[:-1]]
    if not len(again):
        return 0
    at = np.isin(key, again)
    covered = np.zeros(n, bool)
    for i in range(5):
        covered[i : n - 4 + i] |= at
    return int(covered.sum())


def judged(text: str, rules: LineRules) -> tuple:
    """The numbers of a text, and its text without the lines that fail."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = text.split("\n")
    seen: set[str] = set()
    duplicates = bad = lost = filled = 0
    kept = []
    for line in lines:
        if not line.strip(SPACES):
            kept.append(line)
            continue
        filled += 1
        duplicates += line in seen
        seen.add(line)
        if line_fails(line, rules):
            bad += 1
            lost += len(line) - sum(map(line.count, SPACES))
        else:
            kept.append(line)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        duplicates,
        repeated_words(words),
        filled,
        bad,
        lost,
        "\n".join(kept) if bad else text,
    )


def clean_lines(documents: DataFrame, rules: LineRules | None = None, text: str = "text") -> DataFrame:
    """``documents`` with the numbers of each text, ``cleaned`` text, base_failed and kept.

    A document is kept when it has ten words or more, at most a fifth of them in repeated
    windows, and loses at most ``rules.loss`` of its word characters to failing lines. A null
    text counts as empty: no words, so base_failed. Columns of ``documents`` with the names of
    results are replaced. Rows are judged one by one, so repeats and ties do not matter.
    """
    rules = rules or LineRules()
    out = [f.name for f in RESULT] + ["base_failed", "kept"]
    source = documents.drop(*out).withColumn("_text", text_or_empty(text))
    schema = source.drop("_text").schema
    for field in RESULT:
        schema = schema.add(field.name, "string" if field.name == "cleaned" else "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batch_rows(whole):
                rows = [judged(t, rules) for t in batch.column("_text").to_pylist()]
                made = to_batch(RESULT, zip(*rows, strict=True)) if rows else None
                if made is None:
                    continue
                keep = [n for n in batch.schema.names if n != "_text"]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n) for n in keep] + made.columns, names=keep + RESULT.names
                )

    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    too_little = F.col("lost_chars") > rules.loss * F.col("word_chars")
    return (
        source.mapInArrow(run, schema)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~too_little)
    )
