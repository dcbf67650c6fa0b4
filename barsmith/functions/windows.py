"""Ordered per-symbol windows that do not funnel a symbol into one task.

``Window.partitionBy("symbol").orderBy("date")`` puts every bar of a symbol
into a single task; one symbol holding a third of all rows would then hold a
third of the job in one task. Every feature set in this library therefore
runs its windows over ``(symbol, chunk)`` partitions instead:

1. count the bars per symbol (map-side combined). If no symbol has more than
   ``chunk_rows``, every symbol is one chunk and nothing more is needed;
2. for the longer ones a sketch of their key: quantiles of the dates, whose
   densest stretch gives the symbol a bucket width of about
   ``chunk_rows / BUCKETS_PER_CHUNK`` bars, be they daily or a second apart;
3. count the bars per (symbol, time bucket) -- again map-side combined; its
   output is small (symbols x buckets, not rows);
4. running row offset of each bucket within its symbol (window over that
   small table);
5. ``chunk = offset // chunk_rows``; a bucket is additionally sent, marked as
   *halo*, to each later chunk whose first rows need it as look-back;
6. join the bars to that table (broadcast only behind a row-count check);
7. window ``partitionBy(symbol, chunk).orderBy(date)``; halo rows only feed
   the look-back and are removed by :func:`finish`.

Each partition is bounded by ``chunk_rows`` plus the look-back plus one
bucket, whatever the skew. The global 0-based row number of a bar within its
symbol is ``base + row_number() - 1`` where ``base`` is the offset of the
first bucket that reaches the partition (partitions are contiguous runs of
buckets, so this is exact). Bars without a date come first, in no particular
order; they are dealt over buckets of their own by a hash of the row.

The counting passes read the bars' keys again: a job that builds its bars
(from ticks, text or documents) writes them first, see
:func:`barsmith.plans.jobs.bar_table`.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..plans.sizing import bounded_broadcast

TB = "_seg_tb"
CHUNK = "_seg_chunk"
BASE = "_seg_base"
HALO = "_seg_halo"
RN = "_seg_rn"

#: Buckets that the rows of a chunk are counted in, about.
BUCKETS_PER_CHUNK = 8
#: Stretches of equal row count in which the density of a long series is looked at, and the
#: accuracy of their bounds (rank error of one in so many rows).
SKETCH_PARTS = 64
SKETCH_ACCURACY = 10_000
#: Buckets of dateless bars are numbered from here on: they come first, as nulls do.
DATELESS = -(1 << 62)


@dataclass(frozen=True)
class Layout:
    """How a bar table is cut into bounded window partitions.

    key / order: series identity and ordering column (date or timestamp).
    chunk_rows: target rows per window partition (plus halo).
    bucket_seconds: width of the counting bucket of the long series; unset,
        each takes its width from a sketch of its own dates.
    broadcast_rows: the segment table is broadcast only if it has at most
        this many rows (checked by a count), otherwise it is shuffle-joined.
    """

    key: str = "symbol"
    order: str = "date"
    chunk_rows: int = 1 << 18
    bucket_seconds: float | None = None
    broadcast_rows: int = 1 << 21

    def with_(self, **kw) -> "Layout":
        return replace(self, **kw)

    def seconds(self) -> Column:
        """The order column in seconds."""
        return F.unix_micros(F.col(self.order).cast("timestamp")) / F.lit(1e6)

    def window(self) -> WindowSpec:
        """Series order within a chunk; the bucket orders the dateless bars as it dealt them out."""
        return Window.partitionBy(self.key, CHUNK).orderBy(TB, self.order)


DEFAULT_LAYOUT = Layout()


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` treating NULL = NULL (bars with a NULL key stay)."""
    la, ra = left.alias("_l"), right.alias("_r")
    cond = reduce(lambda a, b: a & b,
                  [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys])
    rest = [] if how == "left_semi" else [c for c in right.columns if c not in keys]
    return la.join(ra, cond, how).select(
        *[F.col(f"_l.{c}") for c in left.columns], *[F.col(f"_r.{c}") for c in rest])


def _widths(df: DataFrame, counts: DataFrame, target: int, layout: Layout) -> DataFrame:
    """Per series its bucket width in seconds and the buckets of its dateless bars.

    Short series have no width: they are one bucket. A long one's is so narrow that the
    densest of ``SKETCH_PARTS`` stretches of equal row count fills a bucket with ``target`` rows.
    """
    k = layout.key
    blanks = F.ceil(F.col("_seg_blank") / F.lit(target)).alias("_seg_blanks")
    if layout.bucket_seconds is not None:
        return counts.select(k, F.lit(float(layout.bucket_seconds)).alias("_seg_width"), blanks)
    long = counts.where(F.col("_seg_n") > layout.chunk_rows).select(k)
    at = [i / SKETCH_PARTS for i in range(SKETCH_PARTS + 1)]
    keys = df.where(F.col(layout.order).isNotNull()).select(k, layout.seconds().alias("_seg_t"))
    sketch = (_null_safe_join(keys, F.broadcast(long) if long.count() <= layout.broadcast_rows else long, [k], "left_semi")
              .groupBy(k).agg(F.percentile_approx("_seg_t", at, SKETCH_ACCURACY).alias("_seg_q"),
                              F.count(F.lit(1)).alias("_seg_m")))
    gap = F.array_min(F.transform(F.sequence(F.lit(0), F.lit(SKETCH_PARTS - 1)),
                                  lambda i: F.col("_seg_q")[i + 1] - F.col("_seg_q")[i]))
    # A stretch of equal dates has no width: a microsecond then.
    width = F.greatest(gap * F.lit(float(target * SKETCH_PARTS)) / F.col("_seg_m"), F.lit(1e-6))
    widths = sketch.select(k, width.alias("_seg_width"))
    return _null_safe_join(counts.select(k, blanks), widths, [k], "left")


def _bucketed(df: DataFrame, widths: DataFrame, layout: Layout) -> DataFrame:
    """``df`` with its bucket number: by date, or by a hash of the row without one."""
    spread = F.lit(DATELESS) + F.pmod(F.xxhash64(*df.columns), F.greatest(F.col("_seg_blanks"), F.lit(1)))
    by_date = F.coalesce(F.floor(layout.seconds() / F.col("_seg_width")), F.lit(0))
    return _null_safe_join(df, widths, [layout.key]).select(
        *df.columns, F.when(F.col(layout.order).isNull(), spread).otherwise(by_date).cast("bigint").alias(TB))


def segment_table(df: DataFrame, lookback: int, layout: Layout = DEFAULT_LAYOUT,
                  carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame] | None:
    """How the series are cut: their bucket widths, and (key, bucket) -> one row per target chunk.

    The latter holds (chunk, base, halo) and, for the columns of ``carry``, their
    last value before the chunk. None if every series is one chunk.
    """
    k = layout.key
    chunk = max(int(layout.chunk_rows), int(lookback) + 1)
    blank = F.count_if(F.col(layout.order).isNull()).alias("_seg_blank")
    counts = bounded_broadcast(df.groupBy(k).agg(F.count(F.lit(1)).alias("_seg_n"), blank), layout.broadcast_rows)
    if counts.where(F.col("_seg_n") > chunk).isEmpty():
        return None
    target = max(chunk // BUCKETS_PER_CHUNK, 1)
    widths = bounded_broadcast(_widths(df, counts, target, layout), layout.broadcast_rows)
    # Null dates are the first rows; a struct of one is not null, so they can hold the last value.
    last = [F.max_by(F.struct(c), F.when(F.col(c).isNotNull(), F.struct(layout.order))).alias(f"_seg_last_{c}")
            for c in carry]
    buckets = (_bucketed(df, widths, layout).groupBy(k, TB)
               .agg(F.count(F.lit(1)).alias("_seg_n"), *last))
    wk = Window.partitionBy(k).orderBy(TB).rowsBetween(Window.unboundedPreceding, -1)
    c1 = buckets.select(k, TB, "_seg_n",
                        F.coalesce(F.sum("_seg_n").over(wk), F.lit(0)).alias("_seg_off"),
                        *[F.last(f"_seg_last_{c}", ignorenulls=True).over(wk)[c].alias(f"_seg_carry_{c}") for c in carry])
    own = F.floor(F.col("_seg_off") / F.lit(chunk))
    last_chunk = F.floor((F.col("_seg_off") + F.col("_seg_n") - 1 + F.lit(int(lookback))) / F.lit(chunk))
    c2 = c1.select("*", own.alias("_seg_own"),
                   F.explode(F.sequence(own, F.greatest(own, last_chunk))).alias(CHUNK))
    # base = offset of the first bucket that reaches a chunk (a window over the
    # small table, not a self-join, so the counts are computed once)
    reach = Window.partitionBy(k, CHUNK)
    cuts = c2.select(k, TB, CHUNK, F.min("_seg_off").over(reach).alias(BASE),
                     (F.col(CHUNK) != F.col("_seg_own")).alias(HALO),
                     *[F.first(f"_seg_carry_{c}").over(reach.orderBy(TB)).alias(f"_seg_carry_{c}") for c in carry])
    return widths, bounded_broadcast(cuts, layout.broadcast_rows)


def segment(df: DataFrame, lookback: int, layout: Layout = DEFAULT_LAYOUT,
            with_rn: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Attach chunk / halo columns (and the global row number ``_seg_rn``).

    ``lookback`` is the number of preceding rows any output row may read. For
    columns of ``carry`` (``lookback`` 0) ``_seg_carry_<column>`` is the last
    value before the row's chunk.
    """
    cut = segment_table(df, lookback, layout, carry)
    if cut is None:
        types = dict(df.dtypes)
        out = df.select("*", *[F.lit(0).cast("bigint").alias(c) for c in (TB, CHUNK, BASE)],
                        F.lit(False).alias(HALO),
                        *[F.lit(None).cast(types[c]).alias(f"_seg_carry_{c}") for c in carry])
    else:
        widths, cuts = cut
        out = _null_safe_join(_bucketed(df, widths, layout), cuts, [layout.key, TB])
    if with_rn:
        out = out.withColumn(RN, F.col(BASE) + F.row_number().over(layout.window()) - 1)
    return out


def finish(df: DataFrame) -> DataFrame:
    """Remove halo rows and helper columns."""
    return df.filter(~F.col(HALO)).drop(*[c for c in df.columns if c.startswith("_seg_") or c.startswith("_blk")])


def rows(w: WindowSpec, n: int) -> WindowSpec:
    """Trailing frame of ``n`` rows ending at the current row."""
    return w.rowsBetween(-(int(n) - 1), 0)


def partial(agg, c: str | Column, n: int, w: WindowSpec) -> Column:
    """Spark default: aggregate over whatever of the last ``n`` rows exist."""
    c = F.col(c) if isinstance(c, str) else c
    return agg(c).over(rows(w, n))
