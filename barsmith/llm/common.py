"""What the training-data operators share: table access, scratch tables, Arrow helpers."""

from __future__ import annotations

import uuid
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, scratch_path

#: ASCII white space, ``[\x20\x09-\x0D]``.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_BYTES = SPACE_CHARS.encode()
#: The same set as a Java regular expression class body.
SPACE_CLASS = r"\x20\x09-\x0D"

#: Rows and bytes per Arrow batch handed to a Python worker: narrow rows come in
#: large batches, texts in small ones, however long some are.
BATCH_ROWS = 10_000
BATCH_BYTES = "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: a shared folder, small Arrow batches."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and return a reader of what was written.

    Cuts lineage: a lost executor costs a reread, not a recomputation. The
    folder belongs to the application (below ``spark.checkpoint.dir``);
    :func:`clear_scratch` removes it.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the application's scratch tables once no result reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "llm"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` is called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes an empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def words(text: F.Column) -> F.Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column, native; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed != "", F.split(trimmed, f"[{SPACE_CLASS}]+")).otherwise(
        F.array().cast("array<string>"))
