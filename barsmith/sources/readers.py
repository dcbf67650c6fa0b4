"""Sources (S1-S8): bar tables from NDJSON, vendor documents, envelopes,
Parquet and CSV, plus whole-text and whole-JSON reads.

Bar readers return ``date, symbol, open, high, low, close, volume``; ``date`` is
a DATE for daily bars and a TIMESTAMP where the source holds a time of day, so
intraday bars keep it. NaN prices become NULL at the scan. Table readers (S4-S6)
return all columns of the table; :func:`as_bars` projects one to bars.

JSON numbers are read as text and cast, so ``1000.0`` and ``"1000"`` are
volumes. Lines that are no JSON object are never rows: ``strict`` raises, else
they are left out and :func:`malformed_lines` returns them.

Jobs read raw text once: the ``stage_*`` functions parse it in one scan into a
written table, of which :func:`staged_bars` gives the bars and
:func:`staged_malformed` the quarantine (path, value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import nan_to_null
from ..plans.sizing import bounded_broadcast
from ..plans.tables import written
from ..schema import (BAR_JSON, DOWNLOAD_ENVELOPE, ENVELOPE, PRICE_FIELDS, UNKNOWN_SYMBOL,
                      VENDOR_CLOSE, VENDOR_HIGH, VENDOR_LOW, VENDOR_META, VENDOR_OPEN,
                      VENDOR_SERIES, VENDOR_SYMBOL, VENDOR_VOLUME)

FORMATS = ("parquet", "csv")


#: A time of day after the date, as ISO text has it.
_TIMED = r"^\d{4}-\d{2}-\d{2}[T ]\d"
_CORRUPT = "_corrupt_record"


def as_bars(df: DataFrame) -> DataFrame:
    """Project a table to the bar schema: DATE or TIMESTAMP, NaN-free prices, BIGINT volume.

    Text that is no number becomes NULL.
    """
    return df.select(
        "date", F.col("symbol").cast("string").alias("symbol"),
        *[nan_to_null(F.col(c).try_cast("double")).alias(c) for c in PRICE_FIELDS],
        F.col("volume").try_cast("decimal(38,6)").try_cast("bigint").alias("volume"))


def _timed(df: DataFrame, column: str = "date") -> bool:
    """Whether any value of an ISO text column holds a time of day (an aggregate over the column)."""
    return bool(df.agg(F.max(F.col(column).rlike(_TIMED))).first()[0])


def _typed_date(df: DataFrame, timed: bool | None) -> DataFrame:
    """ISO text dates as TIMESTAMP if they hold a time of day, else as DATE."""
    timed = _timed(df) if timed is None else timed
    return df.withColumn("date", F.to_timestamp("date") if timed else F.to_date("date"))


def _as_text(schema: T.StructType) -> T.StructType:
    """A JSON schema with every leaf as text and room for malformed lines."""
    fields = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    return T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])


def _json_lines(spark: SparkSession, path: str, schema: T.StructType, strict: bool) -> DataFrame:
    reader = spark.read.schema(schema)
    if strict:
        return reader.option("mode", "FAILFAST").json(path)
    return reader.option("columnNameOfCorruptRecord", _CORRUPT).json(path)


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of an NDJSON bar file that are no JSON object, with their file: the quarantine."""
    lines = spark.read.text(path).where(F.trim("value") != "").select(
        F.input_file_name().alias("path"), "value")
    parsed = F.from_json("value", _as_text(BAR_JSON), {"columnNameOfCorruptRecord": _CORRUPT})
    return lines.where(parsed[_CORRUPT].isNotNull())


def read_bars_ndjson(spark: SparkSession, path: str, strict: bool = False, timed: bool | None = None) -> DataFrame:
    """One bar object per line (a missing key reads as NULL).

    ``timed`` says whether dates hold a time of day; unset, they do if any of them does.
    """
    schema = _as_text(BAR_JSON)
    if strict:
        schema = T.StructType([f for f in schema.fields if f.name != _CORRUPT])
    rows = _json_lines(spark, path, schema, strict)
    if not strict:
        rows = rows.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
    return as_bars(_typed_date(rows, timed))


def _require_files(spark: SparkSession, path: str, glob: str) -> None:
    """Fail like the original when a directory holds no matching file.

    Lists file metadata only (the binary content column is pruned).
    """
    found = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path).select("path").limit(1).count())
    if found == 0:
        raise ValueError(f"No {glob} files found in {path}")


#: Files whose bounds a vendor read broadcasts, at most.
VENDOR_FILES = 1 << 18
#: JSON text of one object member before its value: its key.
_LAST_KEY = r'"([^"]*)"\s*:\s*\{[^{]*$'
_SERIES_KEY = f'"{VENDOR_SERIES}"\\s*:\\s*\\{{'.replace("(", r"\(").replace(")", r"\)")


def stage_vendor_points(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S2 in one scan: (points, malformed) of nested vendor documents, one JSON document per file.

    The text is cut at every closing brace, so a day of the series is a record
    of its own: a document is read by as many tasks as its size asks for, and
    none of them holds more than a day. Records are written once; then a file's bounds of
    the series (aggregates of record positions) tell its days from other members.

    A file is malformed if its braces don't pair up (cut short, or a brace inside
    a string) or a record is no JSON; none of its days are rows then, and the
    quarantine (path, value) names what is wrong with it.
    """
    _require_files(spark, path, "*.json")
    meta = F.col("_metadata")
    text = (spark.read.option("lineSep", "}").option("pathGlobFilter", "*.json")
            .option("recursiveFileLookup", "true").text(path))
    body = F.regexp_extract("value", r"\{([^{]*)$", 1)
    blank = F.trim(F.translate("value", "\t\r\n", "   ")) == ""
    opens = F.length("value") - F.length(F.translate("value", "{", ""))
    records = written(text.select(
        meta["file_path"].alias("path"), meta["file_size"].alias("file_size"),
        F.struct(meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("id")).alias("at"),
        "value", F.octet_length("value").alias("bytes"), opens.alias("opens"), blank.alias("blank"),
        F.regexp_extract("value", _LAST_KEY, 1).alias("key"),
        F.col("value").rlike(_SERIES_KEY).alias("starts"),
        F.when(opens > 0, F.from_json(F.concat(F.lit("{"), body, F.lit("}")), "map<string,string>")).alias("fields"),
    ).withColumn("value", F.when((F.col("opens") > 0) & F.col("fields").isNull(), F.substring("value", 1, 1000))),
        "vendor-records")

    broken = F.col("value").isNotNull()
    files = records.groupBy("path").agg(
        F.sum("opens").alias("opens"), (F.max("file_size") - F.sum("bytes")).alias("closes"),
        F.count_if(broken).alias("broken"), F.min(F.when(F.col("starts"), F.col("at"))).alias("first"),
        # A series that opens and closes at once has no days.
        F.min(F.when(F.col("starts") & (F.col("key") == VENDOR_SERIES), F.col("at"))).alias("empty"),
        F.max(F.when(F.col("key") == VENDOR_META, F.col("fields")[VENDOR_SYMBOL])).alias("symbol"))
    files = files.withColumn("paired", (F.col("opens") == F.col("closes")) & (F.col("opens") > 0))
    files = bounded_broadcast(files, VENDOR_FILES)
    good = files.where("paired and broken = 0")
    # The series ends at the first brace that closes nothing opened in its record.
    ends = (records.where("blank").select("path", "at").join(good.select("path", "first"), "path")
            .where("at > first").groupBy("path").agg(F.min("at").alias("end")))
    bounds = bounded_broadcast(good.where("first is not null and empty is null").join(ends, "path").select(
        "path", "first", "end", F.coalesce("symbol", F.lit(UNKNOWN_SYMBOL)).alias("symbol")), VENDOR_FILES)
    points = (records.where("opens > 0").join(bounds, "path").where("at >= first and at < end")
              .select("symbol", F.col("key").alias("date"), "fields"))
    unpaired = files.where("not paired").select("path", F.format_string(
        "%d opening and %d closing braces", "opens", "closes").alias("value"))
    unparsed = records.where(broken).select("path", "value").join(files.where("paired").select("path"), "path", "left_semi")
    return points, unpaired.unionByName(unparsed)


def vendor_bars(points: DataFrame, lenient: bool = False, timed: bool | None = None) -> DataFrame:
    """Bars of staged vendor points (see :func:`stage_vendor_points`)."""
    def field(name: str, t: str) -> Column:
        c = F.col("fields")[name]
        return c.try_cast(t) if lenient else c.cast(t)

    return _typed_date(points, timed).select(
        "date", "symbol",
        nan_to_null(field(VENDOR_OPEN, "double")).alias("open"),
        nan_to_null(field(VENDOR_HIGH, "double")).alias("high"),
        nan_to_null(field(VENDOR_LOW, "double")).alias("low"),
        nan_to_null(field(VENDOR_CLOSE, "double")).alias("close"),
        field(VENDOR_VOLUME, "decimal(38,6)").cast("bigint").alias("volume"))


def read_vendor_series(spark: SparkSession, path: str, lenient: bool = False,
                       timed: bool | None = None) -> DataFrame:
    """Nested vendor documents (one JSON document per file) -> bars.

    The series is a map keyed by date string; each value holds the five
    fields as text. A document without series yields no rows; a missing
    symbol becomes ``Unknown``. Text that is not a number raises (ANSI
    cast) unless ``lenient`` is set, which turns it into NULL. Malformed files
    yield no rows: :func:`stage_vendor_points` returns them besides.
    """
    return vendor_bars(stage_vendor_points(spark, path)[0], lenient, timed)


def _staged_lines(spark: SparkSession, path: str, parsed: Column, good: Column) -> DataFrame:
    """(path, at, parsed, value) of all non-blank lines of text files, in one scan; value is kept of bad lines."""
    meta = F.col("_metadata")
    lines = spark.read.text(path).where(F.trim("value") != "").select(
        meta["file_path"].alias("path"),
        F.struct(meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("id")).alias("at"),
        "value", parsed.alias("parsed"))
    return written(lines.select("path", "at", F.when(good, F.col("parsed")).alias("parsed"),
                                F.when(~F.coalesce(good, F.lit(False)), F.col("value")).alias("value")), "lines")


def stage_bar_lines(spark: SparkSession, path: str) -> DataFrame:
    """S1 in one scan: parsed bars and malformed lines of NDJSON files."""
    parsed = F.from_json("value", _as_text(BAR_JSON), {"columnNameOfCorruptRecord": _CORRUPT})
    return _staged_lines(spark, path, parsed, F.col("parsed")[_CORRUPT].isNull())


def stage_envelopes(spark: SparkSession, path: str, download: bool = False) -> DataFrame:
    """S3 in one scan: envelopes and malformed input of files in either form.

    A file with a line that is an envelope is one of lines. The lines of
    any other file, written by then, are put together to one document; no line
    of a file of lines takes part in that.
    """
    schema = _TEXT_DOWNLOAD if download else _TEXT_ENVELOPE
    good = F.col("parsed")["success"].isNotNull()
    lines = _staged_lines(spark, path, F.from_json("value", schema), good)
    of_lines = lines.where("parsed is not null").select("path").distinct()
    whole = (lines.join(of_lines, "path", "left_anti").groupBy("path")
             .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("lines"))
             .select("path", F.array_join("lines.value", "\n").alias("text"))
             .select("path", F.from_json("text", schema).alias("parsed"), F.col("text").alias("value")))
    documents = whole.select("path", F.when(good, F.col("parsed")).alias("parsed"),
                             F.when(~F.coalesce(good, F.lit(False)), F.col("value")).alias("value"))
    return lines.join(of_lines, "path", "left_semi").drop("at").unionByName(documents)


def staged_malformed(staged: DataFrame) -> DataFrame:
    """The quarantine of staged text: (path, value)."""
    return staged.where("parsed is null").select("path", "value")


def staged_bars(staged: DataFrame, timed: bool | None = None) -> DataFrame:
    """Bars of :func:`stage_bar_lines`."""
    return as_bars(_typed_date(staged.where("parsed is not null").select("parsed.*"), timed))


def staged_envelope_bars(staged: DataFrame, download: bool = False, timed: bool | None = None) -> DataFrame:
    """Bars of the successful envelopes of :func:`stage_envelopes`."""
    return _envelope_bars(staged.where("parsed is not null").select("parsed.*"), download, timed)


def _envelope_bars(env: DataFrame, download: bool, timed: bool | None) -> DataFrame:
    if download:
        env = env.filter(F.col("success")).select("data.*")
    rows = (env.filter(F.coalesce(F.col("success"), F.lit(False)))
               .select(F.col("symbol").alias("_env_symbol"), F.explode("data").alias("bar"))
               .select("_env_symbol", "bar.*"))
    rows = rows.withColumn("symbol", F.coalesce(F.col("symbol"), F.col("_env_symbol"))).drop("_env_symbol")
    return as_bars(_typed_date(rows, timed))


def read_envelopes(spark: SparkSession, path: str, download: bool = False, document: bool | None = False,
                   timed: bool | None = None) -> DataFrame:
    """S3: stored tool envelopes -> bars of the successful ones.

    ``document=True`` reads one envelope per file, indented or not (the stored
    form); ``False`` reads every line as one; ``None`` takes either form, file by
    file (see :func:`stage_envelopes`). ``download=True`` reads the download
    envelope, one level deeper. A bar without its own symbol takes the
    envelope's.
    """
    if document is None:
        return staged_envelope_bars(stage_envelopes(spark, path, download), download, timed)
    schema = _TEXT_DOWNLOAD if download else _TEXT_ENVELOPE
    return _envelope_bars(spark.read.option("multiLine", document).schema(schema).json(path), download, timed)


_TEXT_BARS = T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in BAR_JSON.fields]))
_TEXT_ENVELOPE = T.StructType([T.StructField("data", _TEXT_BARS) if f.name == "data" else f for f in ENVELOPE.fields])
_TEXT_DOWNLOAD = T.StructType([T.StructField("data", _TEXT_ENVELOPE) if f.name == "data" else f
                               for f in DOWNLOAD_ENVELOPE.fields])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, all its columns."""
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV table with a header line, all its columns.

    With a schema there is no inference pass over the input.
    """
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Format switch with an allow-list (case-insensitive)."""
    f = fmt.lower()
    if f == "parquet":
        return read_parquet(spark, path)
    if f == "csv":
        return read_csv(spark, path, schema)
    raise ValueError(f"Unsupported file format: {fmt!r}; expected one of {FORMATS}")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Each file as one string (``path``, ``value``)."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")


def read_json_document(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Whole JSON documents (one per file)."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)
