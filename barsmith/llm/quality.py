"""Quality rules: importance weights from hashed n-grams, thresholded (native).

Every document gets (a) a handful of base counts and a base verdict and
(b) the mean log-likelihood ratio of its hashed word uni- and bigrams between
two multinomials: *target*, estimated on trusted documents, and *raw*,
estimated on the whole corpus (the weight that data selection by importance
resampling draws with). Instead of drawing, every document is compared with one
threshold, so the verdict is deterministic. All trusted documents take part: half
of them fit the target; the other half, held out, says what a good unseen document scores.

Everything is a DataFrame expression. The corpus pass explodes the n-gram
buckets into a hash aggregate of ``buckets`` keys (map-side combined, so the
shuffle holds ``buckets`` rows a task however large the corpus is); the weight
table has ``buckets`` rows, a proven bound, and is broadcast to the scoring
pass. Documents are scored where they lie. The trusted ids grow with the labels and
are joined by a shuffle, of whole texts only where a bitmap of fixed size over the
hashed ids, broadcast, lets a document through: the fitting half's and few others
(one in four at 20 million ids, most of them beyond 100 million).
The threshold's percentiles are exact, read off the held-out scores in ranges.

Defined results: null or empty text has no words, fails the base rules and is
not kept; repeated rows are scored alike; an empty corpus gives an empty
result; without trusted documents every weight is 0 and only the base rules
decide. Extra columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, free_name, partitions, stored, words

#: Hash buckets of the two multinomials (documented size bound of the model).
BUCKETS = 1 << 16
#: Bits of the bitmap over hashed ids, 64 to a row (documented size bound of its broadcast).
FILTER_BITS = 1 << 26
#: A document is kept while its mean log-likelihood ratio (nats per n-gram) lies at most
#: max(MIN_MARGIN, SPREADS * (median - 10th percentile)) below the median of trusted
#: documents that were held out of the fit.
MIN_MARGIN = 0.1
SPREADS = 3.0
#: Pseudo-count of every bucket, as a share of the mean bucket count.
SMOOTHING = 0.05

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def _shifted(ws: str, by: int) -> Column:
    return F.slice(ws, F.lit(by + 1), F.greatest(F.size(ws), F.lit(1)))


def _ngrams(docs: DataFrame, keys: list[Column], buckets: int) -> DataFrame:
    """``keys`` and the buckets ``uni`` and ``bi`` of every word and of it with its successor.

    Neighbours are zipped and hashed after the generator, so the per-word work
    is generated code. The last word of a text is paired with nothing.
    """
    names = [f"k{i}" for i in range(len(keys))]
    cut = docs.select(*[k.alias(n) for k, n in zip(keys, names)], words(F.col("text")).alias("ws"))
    return (cut.select(*names, F.inline(F.arrays_zip(F.col("ws").alias("a"),
                                                     _shifted("ws", 1).alias("b"))))
            .select(*names, _bucket(F.xxhash64("a"), buckets).alias("uni"),
                    _bucket(F.xxhash64("a", "b", F.lit(2)), buckets).alias("bi")))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids labelled good and not toxic, in two ``half``s told by a hash."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
                        & F.col("doc_id").isNotNull())
    return (good.select("doc_id").distinct()
            .select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")))


def _slot_of(doc_id: str, bits: int) -> tuple[Column, Column]:
    """Row and bit of an id in a bitmap of ``bits`` bits."""
    slot = F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(bits))
    return F.shiftright(slot, 6).cast("int"), slot.bitwiseAND(F.lit(63)).cast("int")


def likely_of_ids(docs: DataFrame, ids: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows (doc_id, text) of ``docs`` whose bit one of ``ids`` has set: all of theirs and few others."""
    at, bit = _slot_of("doc_id", bits)
    bitmap = stored(ids.select(at.alias("at"), bit.alias("bit")).groupBy("at")
                    .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")), "bitmap")
    return (docs.select("doc_id", "text", at.alias("at"), bit.alias("bit"))
            .join(F.broadcast(bitmap), "at").where("getbit(mask, bit) = 1").select("doc_id", "text"))


def texts_of_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``text`` of the rows of ``docs`` whose ``doc_id`` is in ``ids``.

    The exact join moves the texts of :func:`likely_of_ids` only, and by one plan at every size.
    """
    # Joined to distinct ids: Spark would push a semi join below the bitmap's and move every text.
    return likely_of_ids(docs, ids).join(ids.select("doc_id").distinct().hint("merge"), "doc_id").select("text")


def fit_weights(docs: DataFrame, ids: DataFrame, buckets: int = BUCKETS,
                smoothing: float = SMOOTHING) -> DataFrame:
    """(bucket, weight) of all ``buckets``: log p_target - log p_raw.

    Raw counts cover all documents, target counts all of ``ids``
    (:func:`trusted_ids`) in the half that fits.
    """
    def counts(rows: DataFrame, name: str) -> DataFrame:
        return (_ngrams(rows, [], buckets).select(F.explode(F.array("uni", "bi")).alias("bucket"))
                .groupBy("bucket").agg(F.count(F.lit(1)).alias(name)))

    raw = counts(docs, "raw")
    target = counts(texts_of_ids(docs, ids.where("half = 0")), "target")
    dense = stored(docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
             .join(raw, "bucket", "left").join(target, "bucket", "left")
             .select("bucket", F.coalesce("raw", F.lit(0)).alias("raw"),
                     F.coalesce("target", F.lit(0)).alias("target")), "buckets")
    total = dense.agg(F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target")).first()

    def log_p(count: Column, all_: int) -> Column:
        mean = all_ / buckets
        return F.ln((count + smoothing * mean) / (all_ * (1 + smoothing)))

    weight = (log_p(F.col("target"), total["all_target"]) - log_p(F.col("raw"), total["all_raw"])
              if total["all_target"] else F.lit(0.0))
    return dense.select("bucket", weight.alias("weight"))


def _repeated_windows(tri: Column) -> Column:
    """Positions of the 3-word windows that occur at least twice, ascending."""
    by_sort = F.transform(
        F.array(F.sort_array(F.transform(tri, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))),
        lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: F.get(s, i - 1)["g"].eqNullSafe(x["g"])
                     | F.get(s, i + 1)["g"].eqNullSafe(x["g"])),
            lambda x: x["i"])))[0]
    # The usual text repeats a handful of windows: look those up instead of
    # sorting (hash, position) records. ``array(x)`` binds x once.
    few = lambda dup: F.filter(
        F.transform(tri, lambda g, i: F.when(F.array_contains(dup, g), i)), lambda i: i.isNotNull())
    return F.transform(
        F.array(F.transform(
            F.array(F.sort_array(tri)),
            lambda s: F.array_distinct(F.filter(s, lambda g, i: F.get(s, i - 1) == g)))[0]),
        lambda dup: F.when(F.size(dup) == 0, F.array().cast("array<int>"))
                     .when(F.size(dup) <= 32, few(dup)).otherwise(by_sort))[0]


def _covered(at: Column) -> Column:
    """Words covered by 3-word windows starting at the ascending positions ``at``."""
    return F.aggregate(
        F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1), p + 3) - p)),
        F.lit(0).cast("long"), lambda acc, x: acc + x)


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def base_counts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` and the base counts of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), text.alias("text"),
                      words(F.col("text")).alias("ws"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    windows = cut.select(
        "doc_id", "text_key", F.size("ws").cast("long").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        (F.size(F.split("text", "[#*$%&|<>]")) - 1).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform(F.slice(F.arrays_zip(F.col("ws").alias("a"), _shifted("ws", 1).alias("b"),
                                         _shifted("ws", 2).alias("c")),
                            F.lit(1), F.greatest(F.size("ws") - 2, F.lit(0))),
                    lambda z: F.xxhash64(z)).alias("tri"))
    repeated = windows.select(
        "doc_id", "text_key", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("tri")) < F.size("tri"), _repeated_windows(F.col("tri")))
        .otherwise(F.array().cast("array<int>")).alias("at"))
    return repeated.select("doc_id", "text_key", "n_words", "word_chars", "n_symbols",
                           "n_dup_lines", _covered(F.col("at")).alias("n_repeat_words"))


def scores(docs: DataFrame, weights: DataFrame, buckets: int) -> DataFrame:
    """``llr``: the mean weight of a text's n-grams, by (doc_id, text_key).

    The weight table has ``buckets`` rows whatever the corpus, so it is
    broadcast. Summed over exploded words in generated code; a row's words lie
    in one task, so the aggregate is all but complete before its shuffle;
    repeated rows fall together, which leaves their mean as it is.
    """
    grams = _ngrams(docs, [F.col("doc_id"), text_key(F.col("text"))], buckets)
    of = lambda name: F.broadcast(weights.select(F.col("bucket").alias(name), F.col("weight").alias(f"w_{name}")))
    return (grams.join(of("uni"), "uni").join(of("bi"), "bi")
            .groupBy(F.col("k0").alias("s_doc"), F.col("k1").alias("s_key"))
            .agg((F.sum(F.col("w_uni") + F.col("w_bi")) / (2 * F.count(F.lit(1)))).alias("llr")))


def percentiles(values: DataFrame, name: str, shares: list[float]) -> list[float] | None:
    """Exact percentiles of the column ``name`` as ``percentile`` has them; None without rows.

    Values are written in ascending ranges; the driver sees one count a range and
    the few values at the ranks it asks for.
    """
    ranges = stored(values.select(F.col(name).alias("v")).repartitionByRange(partitions(values.sparkSession), "v")
                    .select("v", F.spark_partition_id().alias("part")), "ranges")
    counts = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    total, starts = 0, []
    for r in counts:
        starts.append((r["part"], total, r["n"]))
        total += r["n"]
    if not total:
        return None
    ranks = {f((total - 1) * share) for share in shares for f in (math.floor, math.ceil)}
    wanted = [(part, rank - start + 1, rank) for rank in ranks for part, start, n in starts
              if start <= rank < start + n]
    at = F.row_number().over(Window.partitionBy("part").orderBy("v"))
    rows = (ranges.where(F.col("part").isin(*{part for part, _, _ in wanted})).withColumn("at", at)
            .where(" or ".join(f"(part = {part} and at = {n})" for part, n, _ in wanted)).collect())
    found = {(r["part"], r["at"]): r["v"] for r in rows}
    value = {rank: found[part, n] for part, n, rank in wanted}

    def between(position: float) -> float:
        low, high = math.floor(position), math.ceil(position)
        if low == high or value[low] == value[high]:
            return value[low]
        return (high - position) * value[low] + (position - low) * value[high]

    return [between((total - 1) * share) for share in shares]


def threshold(scored: DataFrame, ids: DataFrame, spreads: float = SPREADS,
              min_margin: float = MIN_MARGIN) -> float:
    """The lowest score that is kept, from the :func:`scores` of the held-out trusted documents."""
    held_out = scored.join(ids.where("half = 1").select(F.col("doc_id").alias("s_doc")), "s_doc", "left_semi")
    mid, low = percentiles(held_out, "llr", [0.5, 0.1]) or (0.0, 0.0)
    return mid - max(min_margin, spreads * (mid - low))


def apply_rules(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
                smoothing: float = SMOOTHING, spreads: float = SPREADS,
                min_margin: float = MIN_MARGIN, min_words: int = MIN_WORDS,
                max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """Base counts, score and verdicts of every row of ``docs`` (doc_id, text)."""
    ids = stored(trusted_ids(labels), "trusted")
    weights = stored(fit_weights(docs, ids, buckets, smoothing), "weights")
    by_text = stored(scores(docs, weights, buckets), "scores")
    min_score = threshold(by_text, ids, spreads, min_margin)
    base = base_counts(docs)
    scored = base.join(by_text, base["doc_id"].eqNullSafe(by_text["s_doc"])
                       & (base["text_key"] == by_text["s_key"]), "left").select(
        "doc_id", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr")
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    return (scored.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.coalesce("llr", F.lit(0.0)) >= min_score)))


def keep_good(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that :func:`apply_rules` keeps, with all their columns.

    Verdicts depend on the text (and the model) alone, so a row is matched to
    its verdict by id and text.
    """
    # Written first: a filter on the verdict would be pushed into the counts'
    # definitions and evaluate them many times over.
    judged = stored(apply_rules(docs, labels, **parameters).select("doc_id", "text_key", "kept"), "verdicts")
    id_name, key_name = free_name(docs, "__id"), free_name(docs, "__key")
    good = judged.where("kept").select(F.col("doc_id").alias(id_name), F.col("text_key").alias(key_name))
    return docs.join(good.distinct(), docs["doc_id"].eqNullSafe(F.col(id_name))
                     & (text_key(docs["text"]) == F.col(key_name)), "left_semi")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's counts and verdicts with production parameters."""
    return apply_rules(docs, labels).drop("text_key")
