"""Sinks (K1-K8): NDJSON/Parquet/CSV/text outputs, versioned snapshots with a
``latest`` copy, per-symbol feature outputs and the processing summary.

No writer funnels data through one task: outputs are written by as many
tasks as the data has partitions (the original job's ``coalesce(1)`` is not
kept), and per-symbol layouts use ``partitionBy`` directories, into which
:func:`by_symbol` deals the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Zone names of the object-store layout.
RAW_ZONE = "raw_data"
PROCESSED_ZONE = "processed_data"
LATEST = "latest"
HISTORY = "history"


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K1 / K6: one JSON object per line; NULL fields are left out."""
    df.write.mode(mode).json(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K4: Parquet."""
    df.write.mode(mode).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K4: CSV with a header line."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_table(df: DataFrame, path: str, fmt: str, mode: str = "overwrite") -> str:
    f = fmt.lower()
    if f == "parquet":
        return write_parquet(df, path, mode)
    if f == "csv":
        return write_csv(df, path, mode)
    raise ValueError(f"Unsupported file format: {fmt!r}")


def write_text(df: DataFrame, path: str, column: str = "value", mode: str = "overwrite") -> str:
    """K5: one string column as text lines."""
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)
    return path


def write_json_documents(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K5: rows as JSON documents (struct columns stay nested)."""
    df.write.mode(mode).json(path)
    return path


def by_symbol(df: DataFrame) -> DataFrame:
    """Deal rows out for a layout with one directory per symbol.

    A ``rebalance``: rows of a symbol meet in few tasks, so tasks times symbols
    files do not arise; what is larger than the advisory partition size (a hot
    symbol) is split by size, so a symbol's files follow its bytes.
    """
    return df.hint("rebalance", "symbol")


def zone_path(path: str, src: str = RAW_ZONE, dst: str = PROCESSED_ZONE) -> str:
    """Rewrite a raw-zone location into the processed zone."""
    return path.replace(src, dst)


def zone_path_col(col: str, src: str = RAW_ZONE, dst: str = PROCESSED_ZONE):
    """P11 on a column of paths."""
    return F.replace(F.col(col), F.lit(src), F.lit(dst))


def write_snapshot(df: DataFrame, base: str, snapshot: str, timeframe: str = "daily",
                   zone: str = RAW_ZONE) -> dict[str, str]:
    """K2 / K3: versioned snapshot plus ``latest`` per (timeframe, symbol).

    History: ``{base}/{zone}/history/timeframe=/symbol=/snapshot=``, written
    with dynamic partition overwrite, so a new snapshot id adds partitions and
    a retried job replaces its own snapshot instead of duplicating it.
    Latest: dynamic partition overwrite of ``{base}/{zone}/latest/timeframe=/symbol=``,
    so only the symbols in ``df`` are replaced. It is copied from the snapshot
    just written (partition-pruned read with the known schema), so ``df`` is
    computed once. Both writes must succeed (an exception propagates); the
    paths are returned.
    """
    spark = df.sparkSession
    root = f"{base.rstrip('/')}/{zone}"
    tagged = df.withColumn("timeframe", F.lit(timeframe)).withColumn("snapshot", F.lit(snapshot))
    hist = f"{root}/{HISTORY}"
    latest = f"{root}/{LATEST}"
    (by_symbol(tagged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("timeframe", "symbol", "snapshot").json(hist))
    written = read_snapshot(spark, hist, df.schema, snapshot, timeframe)
    (by_symbol(written).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("timeframe", "symbol").json(latest))
    return {"history": hist, "latest": latest}


def read_snapshot(spark: SparkSession, history: str, schema: StructType, snapshot: str,
                  timeframe: str = "daily") -> DataFrame:
    """Rows of one snapshot of a history zone, with ``timeframe`` and without ``snapshot``.

    ``schema`` is the schema of the written rows (no inference pass); the
    filter on the partition columns prunes the read to that snapshot's
    directories.
    """
    fields = [f for f in schema.fields if f.name not in ("timeframe", "snapshot")]
    full = StructType(fields + [StructField("timeframe", StringType()),
                                StructField("snapshot", StringType())])
    return (spark.read.schema(full).json(history)
            .filter((F.col("timeframe") == timeframe) & (F.col("snapshot") == snapshot))
            .drop("snapshot"))


def _iso(bars: DataFrame):
    """The bars' date as ISO text; a TIMESTAMP keeps its time of day."""
    timed = dict(bars.dtypes)["date"] != "date"
    return F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss" if timed else "yyyy-MM-dd")


def write_envelopes(bars: DataFrame, path: str, period: str = "month",
                    fetched_at: str | None = None) -> str:
    """Store bars as tool envelopes, one per (symbol, period).

    Each envelope holds one period of one symbol, so no envelope grows with
    the length of the history.
    """
    ts = F.lit(fetched_at) if fetched_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    bar = F.struct(_iso(bars).alias("date"), "symbol",
                   "open", "high", "low", "close", "volume")
    env = (bars.groupBy("symbol", F.date_trunc(period, F.col("date").cast("timestamp")).alias("_p"))
               .agg(F.sort_array(F.collect_list(bar)).alias("data"))
               .select(F.lit(True).alias("success"), "symbol",
                       F.size("data").cast("bigint").alias("record_count"), "data",
                       F.create_map(F.lit("period"), F.date_format("_p", "yyyy-MM")).alias("metadata"),
                       ts.alias("fetch_timestamp")))
    env.write.mode("overwrite").json(path)
    return path


def write_vendor_documents(bars: DataFrame, path: str, period: str = "month") -> str:
    """Store bars as nested vendor documents, one document per file.

    One document per (symbol, period) keeps every document bounded; the
    ``partitionBy`` layout puts each in its own file, which is what the
    whole-file reader (S2) expects.
    """
    from ..schema import (VENDOR_CLOSE, VENDOR_HIGH, VENDOR_LOW, VENDOR_META, VENDOR_OPEN,
                          VENDOR_SERIES, VENDOR_SYMBOL, VENDOR_VOLUME)
    point = F.struct(*[F.col(c).cast("string").alias(n) for c, n in
                       (("open", VENDOR_OPEN), ("high", VENDOR_HIGH), ("low", VENDOR_LOW),
                        ("close", VENDOR_CLOSE), ("volume", VENDOR_VOLUME))])
    docs = (bars.groupBy("symbol", F.date_format("date", "yyyy-MM").alias("period"))
                .agg(F.map_from_entries(F.collect_list(
                    F.struct(_iso(bars), point))).alias(VENDOR_SERIES))
                .select("symbol", "period",
                        F.create_map(F.lit(VENDOR_SYMBOL), F.col("symbol")).alias(VENDOR_META),
                        VENDOR_SERIES))
    docs.write.mode("overwrite").partitionBy("symbol", "period").json(path)
    return path


def processing_summary(metadata: DataFrame, output_root: str) -> tuple[DataFrame, DataFrame]:
    """K8: (one-row summary, one row per output) from the metadata table.

    The list of outputs stays a table rather than an array in one row.
    """
    outputs = metadata.select(F.col("Symbol").alias("symbol"),
                              F.concat(F.lit(output_root.rstrip("/") + "/rows/symbol="),
                                       F.col("Symbol")).alias("output"))
    summary = metadata.agg(F.count_distinct("Symbol").alias("files_processed"),
                           F.current_timestamp().alias("processing_date"))
    return summary, outputs


def output_manifest(spark, path: str) -> DataFrame:
    """Q7: file count and total bytes under ``path`` (content is not read); ``ok`` is false if nothing is there."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.range(1).select(F.lit(0).cast("bigint").alias("file_count"),
                                     F.lit(0).cast("bigint").alias("total_bytes"), F.lit(False).alias("ok"))
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(path).select("path", "length"))
    return files.agg(F.count(F.lit(1)).alias("file_count"),
                     F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")) \
                .withColumn("ok", F.col("file_count") > 0)


def output_analysis(df: DataFrame, base_columns: list[str], order: tuple[str, ...] = ()) -> DataFrame:
    """Q6: records, the names and count of non-base columns (from the schema), a sample record.

    ``sample`` is the first record by ``order`` as JSON; without an order, any record.
    """
    extra = [c for c in df.columns if c not in base_columns]
    record = F.to_json(F.struct(*df.columns))
    sample = F.min_by(record, F.struct(*order)) if order else F.first(record)
    return df.agg(F.count(F.lit(1)).alias("records"), sample.alias("sample")).select(
        "records", F.array(*[F.lit(c) for c in extra]).cast("array<string>").alias("feature_columns"),
        F.lit(len(extra)).alias("feature_count"), "sample")


def analyse_output(spark: SparkSession, path: str, schema: StructType, base_columns: list[str],
                   order: tuple[str, ...] = ()) -> DataFrame:
    """Q6 over a written NDJSON output: the analysis of its rows, and its files and bytes."""
    rows = output_analysis(spark.read.schema(schema).json(path), base_columns, order)
    return rows.crossJoin(output_manifest(spark, path))


def write_symbol_documents(rows: DataFrame, metadata: DataFrame, path: str) -> str:
    """K7: per symbol one folder with its metadata record and its rows, as JSON.

    ``metadata`` has one row per ``Symbol``, which names its folder. Rows are dealt out by
    :func:`by_symbol`: a symbol with many is written by many tasks, into many files.
    """
    root = path.rstrip("/")
    by_symbol(rows).write.mode("overwrite").partitionBy("symbol").json(f"{root}/Processed_Data")
    by_symbol(metadata.withColumnRenamed("Symbol", "symbol")).write.mode("overwrite").partitionBy("symbol").json(
        f"{root}/Meta_Data")
    return path
