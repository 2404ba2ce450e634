"""Small helpers the operators share: tables, shared storage and Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Separators of words: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session may go without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="inkwell-llm-"))
    return spark.sparkContext.getCheckpointDir().rsplit("/", 1)[0]


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df`` from reliable storage, with the lineage cut."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str, by: str | None = None) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table in the shared folder, reread; and its path. With a folder per value of ``by``."""
    path = f"{shared_folder(df.sparkSession)}/inkwell-llm/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*([by] if by else [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, *paths: str) -> None:
    """Delete tables made by :func:`written` that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo; the text of null counts as empty."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def batch_rows(batch: pa.RecordBatch, size: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that the Python copies of long texts stay few at a time."""
    for start in range(0, batch.num_rows, size):
        yield batch.slice(start, size)


def to_batch(schema: pa.Schema, columns: Iterable[list]) -> pa.RecordBatch:
    arrays = [pa.array(v, type=f.type) for v, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
