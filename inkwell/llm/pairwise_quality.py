"""Quality classifier: a Bradley-Terry model learns from pairs of a better and a worse document.

The probability that one document beats another is the logistic function of the difference of
their scores, and a score is linear in features of the text. The decision threshold is a
quantile of the scores, the share of worse documents among the labelled ones.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.llm.common import SPACES, batch_rows, crc_mod, text_or_empty
from inkwell.llm.line_quality import SYMBOLS, repeated_words

FEATURES = (
    "log_words", "symbols", "separators", "capitals", "exclamations", "same_lines", "repeats",
    "distinct", "word_length", "digits", "commas", "stops", "ended_lines", "line_words",
    "short_words", "long_words", "few_words", "non_ascii",
)
_CAPITALS, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_LETTERS = _CAPITALS + _CAPITALS.lower()
_ENDED = re.compile(r"[.!?:;\"')][^\S\n]*(?:\n|\Z)")


def features(text: str) -> tuple[float, ...]:
    """Shares and logs between 0 and about 1; the empty text has defined values as well."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    per = 1 / max(n, 1)
    size = max(len(raw), 1)
    less = lambda chars: len(raw) - len(raw.translate(None, chars))
    letters, capitals = less(_LETTERS), less(_CAPITALS)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    filled = max(len(lines), 1)
    chars = sum(map(len, words))
    short = sum(len(w) < 4 for w in words)
    return (
        math.log1p(n) / 10,
        min(1.0, sum(map(text.count, SYMBOLS)) * per / 2),
        min(1.0, sum(text.count(f" {s} ") for s in ("|", "»", "·", ">")) * per * 2),
        capitals / max(letters, 1),
        min(1.0, text.count("!!") * per),
        1 - len(set(lines)) / filled,
        repeated_words(words) * per,
        len(set(words)) * per,
        min(1.0, chars * per / 20),
        min(1.0, 5 * less(_DIGITS) / size),
        min(1.0, 5 * text.count(",") * per),
        min(1.0, 5 * text.count(".") * per),
        len(_ENDED.findall(text)) / filled,
        min(1.0, n / filled / 100),
        short * per,
        min(1.0, chars * per / 8) ** 2,
        1 / (1 + n / 8),
        1 - sum(raw.isascii() for raw in words) * per,
    )


@dataclass(frozen=True)
class BradleyTerry:
    """Scores rise with quality: ``scaled(x) @ weights``, put on a scale of 0 to 1.

    The score at the decision quantile becomes ``threshold``.
    """

    weights: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    cut: float
    threshold: float = 0.3

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.spread) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        shift = math.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.cut + shift, -30, 30)))


def fit(
    x: np.ndarray,
    better: np.ndarray,
    pairs: int = 200_000,
    rounds: int = 60,
    ridge: float = 1e-3,
    threshold: float = 0.3,
    seed: int = 7,
) -> BradleyTerry:
    """Maximum likelihood over preference pairs by Newton steps.

    Each pair sets a row of label 1 against one of label 0; ``pairs`` of them are drawn. With one
    label only there are no preferences: all weights are 0 and all scores say that label.
    """
    mean = x.mean(axis=0) if len(x) else np.zeros(len(FEATURES))
    spread = x.std(axis=0) if len(x) else np.ones(len(FEATURES))
    spread = np.where(spread > 1e-9, spread, 1.0)
    scaled = (x - mean) / spread if len(x) else x
    good, bad = scaled[better], scaled[~better]
    weights = np.zeros(len(FEATURES))
    if not len(good) or not len(bad):
        return BradleyTerry(weights, mean, spread, math.inf if len(bad) else -math.inf, threshold)
    rng = np.random.default_rng(seed)
    difference = good[rng.integers(len(good), size=pairs)] - bad[rng.integers(len(bad), size=pairs)]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(difference @ weights, -30, 30)))
        slope = difference.T @ (1 - p) / pairs - ridge * weights
        bend = (difference * (p * (1 - p))[:, None]).T @ difference / pairs + ridge * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    raw = scaled @ weights
    cut = float(np.quantile(raw, (~better).mean()))
    return BradleyTerry(weights, mean, spread, cut, threshold)


def learn(
    documents: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held_out_fold: int = 0,
    max_rows: int = 20_000,
    threshold: float = 0.3,
) -> BradleyTerry:
    """A model from the labelled documents outside the held-out fold of crc32(doc_id).

    About ``max_rows`` of them are used at most, chosen by a hash of the id; the fit itself is a
    small problem on the driver. Labels without id or quality do not count; several labels of an
    id are averaged, and of several documents with an id the one with the least features counts.
    """
    known = (
        labels.select("doc_id", "quality")
        .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .where(crc_mod("doc_id", folds) != held_out_fold)
        .groupBy("doc_id")
        .agg((F.avg(F.col("quality").cast("double")) >= 0.5).alias("better"))
    )
    every = known.count()
    if every > max_rows:
        share = int(max_rows / every * (1 << 30))
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    chosen = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = (
        with_features(chosen).groupBy("doc_id").agg(F.min("features").alias("features"), F.first("better"))
    ).collect()
    x = np.array([r[1] for r in rows], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r[2] for r in rows], bool), threshold=threshold)


def with_features(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` without the text, with ``features``."""
    source = documents.withColumn("_text", text_or_empty(text)).drop(text, "features")
    schema = source.drop("_text").schema.add("features", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batch_rows(whole):
                found = pa.array(
                    [features(t) for t in batch.column("_text").to_pylist()], pa.list_(pa.float64())
                )
                keep = [c for c in batch.schema.names if c != "_text"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), found], names=[*keep, "features"]
                )

    return source.mapInArrow(run, schema)


def scored(documents: DataFrame, model: BradleyTerry, text: str = "text") -> DataFrame:
    """``documents`` with score and predicted (1 from the model's threshold on).

    A null text counts as empty and gets the score of the empty text. Rows are scored one by one;
    columns of ``documents`` called score or predicted are replaced.
    """
    source = documents.drop("score", "predicted").withColumn("_text", text_or_empty(text))
    schema = source.drop("_text").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batch_rows(whole):
                x = np.array([features(t) for t in batch.column("_text").to_pylist()], float)
                made = pa.array(model.scores(x.reshape(-1, len(FEATURES))))
                keep = [c for c in batch.schema.names if c != "_text"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), made], names=[*keep, "score"]
                )

    return source.mapInArrow(run, schema).withColumn(
        "predicted", (F.col("score") >= model.threshold).cast("int")
    )
