"""Line dedup: documents probe a sharded perfect-hash index of repeated lines.

A line's key is the line without ASCII white space at its ends, A-Z
lower-cased. A key of at least ``min_chars`` code points found in at least
``min_docs`` documents loses all its lines except in the document with the
largest id that holds it.

1. Each document emits the 128-bit hashes of its distinct keys; a hash
   aggregate (map-side combined, so a line in a third of all documents is one
   row a task) counts documents and keeps the largest id.
2. The repeated hashes (a key below ``min_docs`` needs no entry: a probe that
   misses means "keep") are cut into shards by hash. Every shard becomes one
   :class:`~.mph.FingerprintTable`: perfect hash, 64-bit fingerprints, counts
   and largest ids in flat arrays, built inside a Spark task of bounded size.
3. Documents probe. Hashes held by more than 1/``HOT_KEYS`` of all holdings
   (at most ``HOT_KEYS`` of them, by counting) sit in one small table that is
   broadcast and probed where the document lies, so no hot line is ever sent
   anywhere. The other probes are routed to their shard, stream past its
   arrays, and only hits come back, to be applied by document id.

Two lines are taken as equal when all 128 hash bits agree.

Defined results: a null text is one empty line; rows are documents (a repeated
row counts again; its lines stay if its id is the largest); a null id is
smaller than any other; an empty table gives an empty result. Other columns
are passed through; ``n_lines`` and ``n_dropped`` of the input are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE_BYTES, free_name, partitions, stored, texts_as_bytes
from .mph import FingerprintTable

MIN_DOCS = 3
MIN_CHARS = 20
#: Largest number of hashes in the broadcast table (24 bytes each and a few bits).
HOT_KEYS = 1 << 14
#: Hashes a shard holds about, at most: it is built and probed in one task's memory.
SHARD_KEYS = 1 << 17
#: The id a null doc_id counts as.
NULL_ID = -(2**63)

_HASHES = "h1 long, h2 long, doc long"


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Key of a line that is already lower-cased (A-Z), None if it is too short."""
    key = line.strip(SPACE_BYTES)
    if len(key) < min_chars:
        return None
    if len(key) < 4 * min_chars and not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key


def _text_hashes(text: bytes, min_chars: int) -> list[bytes | None]:
    """The 16-byte hash of every line's key, in line order; None for lines without one."""
    digest = xxhash.xxh3_128_digest
    keys = (line_key(x, min_chars) for x in text.lower().split(b"\n"))
    return [None if k is None else digest(k) for k in keys]


def _halves(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(hashes), dtype=np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _doc_ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def _distinct(batch: pa.RecordBatch, min_chars: int) -> tuple[list[bytes], np.ndarray]:
    """Distinct key hashes of every document of the batch, and the documents' ids."""
    hashes, counts = [], []
    for text in texts_as_bytes(batch.column("text")):
        own = dict.fromkeys(_text_hashes(text, min_chars))
        own.pop(None, None)
        hashes.extend(own)
        counts.append(len(own))
    return hashes, np.repeat(_doc_ids(batch.column("doc_id")), counts)


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, n_docs, last_doc) of the keys held by at least ``min_docs`` documents."""
    def emit(batches):
        for batch in batches:
            hashes, ids = _distinct(batch, min_chars)
            h1, h2 = _halves(hashes)
            yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(ids)],
                                             names=["h1", "h2", "doc"])
    lines = docs.select("doc_id", "text").mapInArrow(emit, _HASHES)
    return (lines.groupBy("h1", "h2")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("last_doc"))
            .where(F.col("n_docs") >= min_docs))


def _pack(frame: pd.DataFrame) -> bytes:
    return FingerprintTable.build(*(frame[c].to_numpy() for c in ("h1", "h2", "n_docs", "last_doc"))).to_bytes()


def build_shards(index: DataFrame, n_shards: int) -> DataFrame:
    """(shard, table): one serialised fingerprint table per shard of the repeated hashes."""
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        # h1 is the perfect hash's key: the rare second key with the same h1
        # goes to a further table of the shard.
        nth = frame.groupby("h1").cumcount()
        return pd.DataFrame([(int(frame["shard"].iloc[0]), _pack(part)) for _, part in frame.groupby(nth)],
                            columns=["shard", "table"])
    return (index.withColumn("shard", _shard_of(n_shards)).groupBy("shard")
            .applyInPandas(pack, "shard int, table binary"))


def _shard_of(n_shards: int) -> F.Column:
    return F.pmod("h2", F.lit(n_shards)).cast("int")


def _hot_table(index: DataFrame, total: int, hot_keys: int) -> tuple[bytes, F.Column]:
    """The broadcast table and the condition that picks its rows.

    A hash in it is held by at least ``total / hot_keys`` documents, so there
    are at most ``hot_keys`` of them whatever the corpus.
    """
    is_hot = F.col("n_docs") * hot_keys >= total
    rows = index.where(is_hot).toPandas()
    return _pack(rows.drop_duplicates("h1")), is_hot


def dropped_hashes(docs: DataFrame, index: DataFrame, hot: bytes, is_hot: F.Column, n_cold: int,
                   min_chars: int, shard_keys: int) -> DataFrame:
    """(doc, h1) of the cold keys whose lines a document loses, found by probing the shards."""
    spark = docs.sparkSession
    n_shards = max(4 * partitions(spark), -(-n_cold // shard_keys))

    def emit(batches):
        table = FingerprintTable.from_bytes(hot)
        for batch in batches:
            hashes, ids = _distinct(batch, min_chars)
            h1, h2 = _halves(hashes)
            cold = ~table.probe(h1, h2)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.mod(h2[cold], n_shards).astype(np.int32)), pa.array(h1[cold]),
                 pa.array(h2[cold]), pa.array(ids[cold])], names=["shard", "h1", "h2", "doc"])

    probes = docs.select("doc_id", "text").mapInArrow(emit, f"shard int, {_HASHES}")
    shards = build_shards(index.where(~is_hot), n_shards)
    # A shard's tables sort before its probes: one pass holds one shard.
    null = lambda kind: F.lit(None).cast(kind)
    both = shards.select("shard", "table", null("long").alias("h1"), null("long").alias("h2"),
                         null("long").alias("doc"))
    both = both.unionByName(probes.select("shard", null("binary").alias("table"), "h1", "h2", "doc"))
    routed = both.repartition("shard").sortWithinPartitions("shard", F.col("table").isNull())

    def probe(batches):
        shard, tables = None, []
        for batch in batches:
            at, tabs = batch.column("shard").to_numpy(), batch.column("table")
            h1, h2, doc = (batch.column(c).fill_null(0).to_numpy() for c in ("h1", "h2", "doc"))
            cuts = np.flatnonzero(np.diff(at)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(at)]):
                if at[lo] != shard:
                    shard, tables = at[lo], []
                n_tabs = hi - lo - tabs.slice(lo, hi - lo).null_count
                tables += [FingerprintTable.from_bytes(x) for x in tabs.slice(lo, n_tabs).to_pylist()]
                lo += n_tabs
                for t in tables:
                    found, _, last = t.probe(h1[lo:hi], h2[lo:hi])
                    lost = found & (last != doc[lo:hi])
                    if lost.any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc[lo:hi][lost]), pa.array(h1[lo:hi][lost])], names=["doc", "h1"])

    return routed.mapInArrow(probe, "doc long, h1 long")


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                hot_keys: int = HOT_KEYS, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``docs`` with ``text`` reduced to its kept lines, plus ``n_lines`` and ``n_dropped``."""
    docs = docs.drop("n_lines", "n_dropped")
    index = stored(repeated_lines(docs, min_docs, min_chars), "repeated-lines")
    total, size = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.count(F.lit(1))).first()
    hot, is_hot = _hot_table(index, total, hot_keys)
    lost = dropped_hashes(docs, index, hot, is_hot, size, min_chars, shard_keys)
    doc_name, lost_name = free_name(docs, "__doc"), free_name(docs, "__lost")
    by_doc = lost.groupBy(F.col("doc").alias(doc_name)).agg(F.collect_set("h1").alias(lost_name))
    joined = docs.join(by_doc, F.coalesce("doc_id", F.lit(NULL_ID)) == F.col(doc_name), "left").drop(doc_name)

    out = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()),
                        T.StructField("n_dropped", T.LongType())])
    columns_in, names_out = docs.columns, out.names
    text_at = columns_in.index("text")

    def apply(batches):
        table = FingerprintTable.from_bytes(hot)
        for batch in batches:
            texts = texts_as_bytes(batch.column("text"))
            lists = [_text_hashes(t, min_chars) for t in texts]
            flat = [h for own in lists for h in own if h is not None]
            owner = np.repeat(_doc_ids(batch.column("doc_id")),
                              [sum(h is not None for h in own) for own in lists])
            h1, h2 = _halves(flat)
            found, _, last = table.probe(h1, h2)
            gone = iter((found & (last != owner)).tolist())
            keys = iter(h1.tolist())
            kept, n_lines, n_dropped = [], [], []
            for text, own, lost in zip(texts, lists, batch.column(lost_name).to_pylist()):
                lost = set(lost or ())
                keep = []
                for h in own:
                    keep.append(h is None or not (next(gone) | (next(keys) in lost)))
                n_lines.append(len(own))
                n_dropped.append(len(own) - sum(keep))
                kept.append(text if all(keep) else
                            b"\n".join(x for x, k in zip(text.split(b"\n"), keep) if k))
            columns = [batch.column(c) for c in columns_in]
            columns[text_at] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=names_out)

    return joined.mapInArrow(apply, out)


QUERY_SQL = r"""
WITH lines AS (
  SELECT doc_id, row, i, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, row_number() OVER () AS row,
               unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
        FROM documents)),
repeated AS (
  SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT row) >= 3),
marked AS (
  SELECT l.doc_id, l.row, l.i, l.line, r.key IS NOT NULL AND l.doc_id <> r.last_doc AS gone
  FROM lines l LEFT JOIN repeated r ON l.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row
"""


def query(docs: DataFrame) -> DataFrame:
    """The digest columns of :func:`dedup_lines` with production parameters."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
