"""Size checks that guard every broadcast in the library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: Bytes of values up to which a table is broadcast, whatever its rows.
MAX_BYTES = 128 << 20


def value_bytes(df: DataFrame):
    """Bytes of a row's values: the length of texts and binaries, eight bytes for anything else."""
    parts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
             if isinstance(f.dataType, (T.StringType, T.BinaryType))
             else F.coalesce(F.octet_length(F.to_json(F.struct(f"`{f.name}`"))), F.lit(0))
             if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.lit(8) for f in df.schema.fields]
    return sum(parts, F.lit(0)).cast("bigint")


def bounded_broadcast(df: DataFrame, max_rows: int, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only if it is measured to have at most ``max_rows`` rows and ``max_bytes`` of values.

    The inputs passed here are derived lookup tables (one row per symbol, or
    per symbol and time bucket); their size depends on the data, so it is
    measured, not assumed. Above the bounds the table is returned unchanged
    and Spark plans a shuffle join.

    The table is checkpointed (one job writes it to the shared checkpoint
    folder, ``spark.checkpoint.dir``) before it is measured: the measure and the
    join read the written table instead of re-aggregating the input, a lost
    executor costs no recomputation (cached blocks would die with it and be
    rebuilt from the full input), and nothing stays pinned in executor memory.
    """
    ensure_checkpoint_dir(df.sparkSession)
    small = df.checkpoint(eager=True)
    size = small.agg(F.count(F.lit(1)).alias("rows"), F.sum(value_bytes(small)).alias("bytes")).first()
    return F.broadcast(small) if size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes else small
