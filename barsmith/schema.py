"""Schemas of the bar table, the vendor document and the tool envelope."""

from __future__ import annotations

from pyspark.sql import types as T

# The fundamental row: one bar per (symbol, date).
BAR_FIELDS = ["date", "symbol", "open", "high", "low", "close", "volume"]
PRICE_FIELDS = ["open", "high", "low", "close"]
REQUIRED_FIELDS = ["open", "high", "low", "close", "volume"]

BAR = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

# NDJSON as written by producers: the date stays an ISO string on disk.
BAR_JSON = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

# Key names of the nested vendor document (must match the
# producer byte for byte).
VENDOR_META = "Meta Data"
VENDOR_SYMBOL = "2. Symbol"
VENDOR_SERIES = "Time Series (Daily)"
VENDOR_OPEN = "1. open"
VENDOR_HIGH = "2. high"
VENDOR_LOW = "3. low"
VENDOR_CLOSE = "4. close"
VENDOR_VOLUME = "5. volume"
UNKNOWN_SYMBOL = "Unknown"

VENDOR_POINT = T.StructType([
    T.StructField(VENDOR_OPEN, T.StringType()),
    T.StructField(VENDOR_HIGH, T.StringType()),
    T.StructField(VENDOR_LOW, T.StringType()),
    T.StructField(VENDOR_CLOSE, T.StringType()),
    T.StructField(VENDOR_VOLUME, T.StringType()),
])

VENDOR_DOC = T.StructType([
    T.StructField(VENDOR_META, T.MapType(T.StringType(), T.StringType())),
    T.StructField(VENDOR_SERIES, T.MapType(T.StringType(), VENDOR_POINT)),
])

# Stored tool envelope: {success, symbol, record_count, data:[bar], metadata, fetch_timestamp}
ENVELOPE = T.StructType([
    T.StructField("success", T.BooleanType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("data", T.ArrayType(BAR_JSON)),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("fetch_timestamp", T.StringType()),
])

# Download envelope: {success, key, data:<envelope>, download_timestamp}
DOWNLOAD_ENVELOPE = T.StructType([
    T.StructField("success", T.BooleanType()),
    T.StructField("key", T.StringType()),
    T.StructField("data", ENVELOPE),
    T.StructField("download_timestamp", T.StringType()),
])

ERROR_RECORD = T.StructType([
    T.StructField("error", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("node_name", T.StringType()),
])

# Run and stage status names, and the known stage names.
STATUS_PENDING = "pending"
STATUS_RUNNING = "running"
STATUS_COMPLETED = "completed"
STATUS_FAILED = "failed"
STATUS_PAUSED = "paused"
STATUSES = [STATUS_PENDING, STATUS_RUNNING, STATUS_COMPLETED, STATUS_FAILED, STATUS_PAUSED]
STAGES = ["ingestion", "preprocessing", "training"]

RUN_LOG = T.StructType([
    T.StructField("workflow_id", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("errors", T.ArrayType(ERROR_RECORD)),
])
