"""From raw documents to packed training sequences, in stages that are each written and reread.

The quality classifier drops documents, of each group of near-duplicates one stays, documents that
hold a benchmark item go, personal data is replaced in the texts, and what is left is packed.

A null text counts as empty, in every stage; the sanitised text of a null one is empty. Rows without
doc_id and repeated rows are documents of their own until the near-duplicates, where one of equal
texts stays (the least doc_id, null last; ties by the other columns). Texts of any length go through
whole. An empty table gives no pieces. Other columns of the documents are handed on as they are, also
those with names of the stages' results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import (
    dp_packing,
    order_minhash,
    pairwise_quality,
    pii_sanitise,
    template_decontamination,
)
from inkwell.llm.common import removed, table, written
from inkwell.llm.queries import tokenizer_files

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _aside(docs: DataFrame, *used: str) -> DataFrame:
    """The columns that a stage works on, and all others in one, whatever their names."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, (F.struct(*others) if others else F.lit(None)).alias("_row"))


def _restored(docs: DataFrame, rows: DataFrame, changed: dict[str, Column], *used: str) -> DataFrame:
    """The columns of ``docs`` in their order, from rows that come from :func:`_aside`."""
    own = {c: F.col(c) if c in used else F.col("_row")[c] for c in docs.columns} | changed
    return rows.select(*[own[c].alias(c) for c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, learned from the labels, predicts as label 1."""
    used = ("doc_id", "text")
    model = pairwise_quality.learn(docs.select(*used), table(spark, sf_dir, "labels"))
    good = pairwise_quality.scored(_aside(docs, *used), model).where(F.col("predicted") == 1)
    return _restored(docs, good, {}, *used)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return order_minhash.without_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without benchmark items."""
    return template_decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with placeholders for personal data in the text; n_chars follows the text."""
    clean = pii_sanitise.sanitise(_aside(docs, "text"))
    changed = {"text": F.col("sanitised")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("sanitised").cast(docs.schema["n_chars"].dataType)
    return _restored(docs, clean, changed, "text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 tokens."""
    return dp_packing.pack(docs.select("doc_id", "text"), **tokenizer_files()).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("near_duplicates", unique),
    ("decontamination", decontaminated),
    ("pii", sanitised),
    ("packing", packed),
]
# Trained models, sketches and a tokenizer: not within the reach of SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each stage's table is deleted once the next is written."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, now = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if path:
            removed(spark, path)
        path = now
    return docs
