"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. *Seeds.* Every ``width``-word n-gram of the test items is a seed candidate.
   How many documents hold each is counted over the whole corpus (one pass that
   emits only n-grams of the benchmark). Per item a seed is *rare* if no more
   documents hold it than hold the item's median n-gram, or at most
   ``ALWAYS_RARE``; so at least half of an item's n-grams seed, however often
   the item was copied into the corpus.
2. *Join.* Training passages meet items on rare seeds: the word positions of a
   document where a seed of the item begins. A seed table of a checked size
   travels to the documents; a shuffle join beyond that.
3. *Align.* Around the hits, stretches of words (hits closer than an item's
   length are one stretch) are aligned with the item's words by Smith-Waterman
   (match 2, mismatch -1, gap -1), so edits, insertions and losses only cost
   their words. The score of a pair is the best alignment over what the item
   aligned with itself scores: 1 is a verbatim copy.

Results: one row per (document, item) with at least ``min_score``.

Words are split at white space, lower-cased, without punctuation at their ends;
an item of fewer than ``width`` words seeds with its whole text.

Defined results: null or wordless texts and items match nothing; repeated rows
give one row per doc_id (the best score); a null doc_id or item_id never
matches; empty tables give an empty result. Only doc_id, text, item_id and the
item's text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .shingles import windows

SEED_WORDS = 3
MIN_SCORE = 0.5
ALWAYS_RARE = 20
#: Seed rows (40 bytes each about) up to which the seed table is broadcast.
BROADCAST_SEEDS = 1 << 18
MATCH, MISMATCH, GAP = 2, -1, -1

#: ASCII characters that are neither letters nor digits: most edges hold no others.
_ASCII_EDGE = "".join(c for c in map(chr, range(128)) if not c.isalnum())
_EDGE = regex.compile(r"\P{Alnum}*")


def plain_words(text: str | None) -> list[str]:
    """Lower-case words without punctuation at their ends; words of punctuation only vanish."""
    return [p for w in (text or "").lower().split() if (p := w if w.isalnum() else _plain(w))]


def _plain(w: str) -> str:
    cut = w.strip(_ASCII_EDGE)
    if not cut or (cut[0].isascii() and cut[-1].isascii()):
        return cut
    if not (w[0].isalnum() and w[-1].isalnum()):
        # From either end, so that a long word of punctuation is read twice at most.
        w = w[_EDGE.match(w).end():]
        w = w[:len(w) - _EDGE.match(w[::-1]).end()]
    return w


def word_codes(text: str | None) -> np.ndarray:
    """64-bit hash of every plain word."""
    words = plain_words(text)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def item_ngrams(benchmark: DataFrame, width: int = SEED_WORDS) -> DataFrame:
    """(gram, item_id, words, gram_words) of every distinct n-gram of every item."""
    def emit(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                codes = word_codes(text)
                if item is None or not len(codes):
                    continue
                own = min(width, len(codes))
                for g in dict.fromkeys(windows(codes, width).view(np.int64).tolist()):
                    rows.append((g, item, codes.view(np.int64).tolist(), own))
            if rows:
                g, i, w, n = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g, pa.int64()), pa.array(i, pa.int64()), pa.array(w, pa.list_(pa.int64())),
                     pa.array(n, pa.int32())], names=["gram", "item_id", "words", "gram_words"])
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        emit, "gram long, item_id long, words array<long>, gram_words int")


def _doc_grams(docs: DataFrame, grams: DataFrame, widths: list[int], fits: bool,
               once: bool = False) -> DataFrame:
    """(gram, doc, at) of every place in every document that holds one of ``grams``.

    A bounded gram set travels to the documents and picks places before
    anything is emitted. Beyond the bound all places are emitted and joined.
    ``once`` gives a document's first place of a gram only.
    """
    known = (np.sort(np.array([r[0] for r in grams.select("gram").distinct().collect()], np.int64))
             if fits else None)

    def emit(batches):
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                codes = word_codes(text)
                if doc is None or (known is not None and not len(known)):
                    continue
                for width in widths:
                    if len(codes) < width:
                        continue
                    g = windows(codes, width).view(np.int64)
                    hit = np.arange(len(g)) if known is None else np.flatnonzero(
                        known[np.minimum(np.searchsorted(known, g), len(known) - 1)] == g)
                    if once:
                        hit = hit[np.unique(g[hit], return_index=True)[1]]
                    if len(hit):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(g[hit]), pa.array(np.full(len(hit), doc, np.int64)),
                             pa.array(hit.astype(np.int32))], names=["gram", "doc", "at"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        emit, "gram long, doc long, at int")
    return rows if fits else rows.join(grams.select("gram").distinct(), "gram", "left_semi")


def rare_seeds(docs: DataFrame, benchmark: DataFrame, width: int = SEED_WORDS,
               always_rare: int = ALWAYS_RARE, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """The n-grams of :func:`item_ngrams` that are rare, with ``df``, the documents that hold them."""
    grams = stored(item_ngrams(benchmark, width), "item-ngrams")
    fits = grams.count() <= broadcast_seeds
    widths = [r[0] for r in grams.select("gram_words").distinct().collect()]
    counts = (_doc_grams(docs, grams, widths, fits, once=True)
              .groupBy("gram").agg(F.count(F.lit(1)).alias("df")))
    known = stored(grams.join(counts, "gram", "left").withColumn("df", F.coalesce("df", F.lit(0))), "gram-counts")
    middle = known.groupBy("item_id").agg(F.expr("percentile(df, 0.5)").alias("mid"))
    return known.join(middle, "item_id").where(
        (F.col("df") <= F.greatest(F.col("mid"), F.lit(always_rare)))).drop("mid")


def align(item: np.ndarray, passage: np.ndarray) -> int:
    """Best local alignment score of two word sequences (Smith-Waterman, linear gaps).

    Row by row over the item; inside a row, gaps along the passage are a
    running maximum, so every row is a handful of vector operations.
    """
    ramp = np.arange(len(passage) + 1) * -GAP
    row = np.zeros(len(passage) + 1, dtype=np.int64)
    best = 0
    for word in item:
        step = row[:-1] + np.where(passage == word, MATCH, MISMATCH)
        now = np.zeros_like(row)
        now[1:] = np.maximum(np.maximum(step, row[1:] + GAP), 0)
        row = np.maximum.accumulate(now + ramp) - ramp
        best = max(best, int(row.max()))
    return best


def stretches(at: np.ndarray, margin: int, length: int) -> list[tuple[int, int]]:
    """Word ranges around the sorted hits ``at``, joined where they meet."""
    cuts = np.flatnonzero(np.diff(at) > 2 * margin) + 1
    return [(max(0, int(part[0]) - margin), min(length, int(part[-1]) + margin))
            for part in np.split(at, cuts)]


def item_scores(codes: np.ndarray, hits: dict[int, np.ndarray], items: dict[int, np.ndarray],
                min_score: float) -> list[tuple[int, float, int, int]]:
    """(item, score, first word, last word) of the items that align well around their hits."""
    out = []
    for item_id, at in hits.items():
        item, best = items[item_id], (0, 0, 0)
        for lo, hi in stretches(at, 2 * len(item), len(codes)):
            best = max(best, (align(item, codes[lo:hi]), -lo, hi))
        share = best[0] / (MATCH * len(item))
        if share >= min_score:
            out.append((item_id, share, -best[1], best[2]))
    return out


_LEAKS = "doc_id long, item_id long, score double, first_word int, last_word int"


def _leak_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["doc_id", "item_id", "score", "first_word", "last_word"])


def _leaks_in_place(docs: DataFrame, seeds: DataFrame, widths: list[int], min_score: float) -> DataFrame:
    """Leaks found where the documents lie: the bounded seed table travels to them."""
    rows = seeds.select("gram", "item_id").collect()
    items = {r["item_id"]: np.array(r["words"], np.int64).view(np.uint64)
             for r in seeds.groupBy("item_id").agg(F.first("words").alias("words")).collect()}
    rows.sort()
    grams = np.array([r["gram"] for r in rows], np.int64)
    owners = np.array([r["item_id"] for r in rows], np.int64)
    sent = docs.sparkSession.sparkContext.broadcast((grams, owners, items))

    def emit(batches):
        grams, owners, items = sent.value
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                codes = word_codes(text)
                if doc is None or not len(codes) or not len(grams):
                    continue
                found: dict[int, list[int]] = {}
                for width in widths:
                    if len(codes) < width:
                        continue
                    g = windows(codes, width).view(np.int64)
                    lo = np.searchsorted(grams, g)
                    for at in np.flatnonzero(grams[np.minimum(lo, len(grams) - 1)] == g).tolist():
                        for i in range(lo[at], np.searchsorted(grams, g[at], side="right")):
                            found.setdefault(int(owners[i]), []).append(at)
                hits = {k: np.unique(v) for k, v in found.items()}
                rows += [(doc, *x) for x in item_scores(codes, hits, items, min_score)]
            if rows:
                yield _leak_batch(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(emit, _LEAKS)


def _leaks_by_join(docs: DataFrame, seeds: DataFrame, widths: list[int], min_score: float) -> DataFrame:
    """Leaks through shuffle joins only, for a seed table of any size."""
    places = _doc_grams(docs, seeds, widths, fits=False)
    hits = places.join(seeds.select("gram", "item_id"), "gram")
    # One row per document and item; a document's hits are bounded by its words.
    pairs = hits.groupBy("doc", "item_id").agg(F.sort_array(F.collect_set("at")).alias("at"))
    items = seeds.groupBy("item_id").agg(F.first("words").alias("words"))
    by_doc = (pairs.select(F.col("doc").alias("doc_id"), "item_id", "at").join(items, "item_id")
              .groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "words", "at")).alias("items")))
    seeded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(by_doc, "doc_id")

    def emit(batches):
        for batch in batches:
            rows = []
            for doc, text, found in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                                        batch.column("items").to_pylist()):
                hits = {e["item_id"]: np.array(e["at"]) for e in found}
                items = {e["item_id"]: np.array(e["words"], np.int64).view(np.uint64) for e in found}
                rows += [(doc, *x) for x in item_scores(word_codes(text), hits, items, min_score)]
            if rows:
                yield _leak_batch(rows)

    return seeded.mapInArrow(emit, _LEAKS)


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = SEED_WORDS,
               min_score: float = MIN_SCORE, always_rare: int = ALWAYS_RARE,
               broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of every document that holds an item."""
    seeds = stored(rare_seeds(docs, benchmark, width, always_rare, broadcast_seeds), "seeds")
    widths = [r[0] for r in seeds.select("gram_words").distinct().collect()]
    by = _leaks_in_place if seeds.count() <= broadcast_seeds else _leaks_by_join
    found = by(docs, seeds, widths, min_score)
    best = F.max_by(F.struct("score", "first_word", "last_word"),
                    F.struct(F.col("score"), -F.col("first_word"))).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """``docs`` without the rows that hold a test item."""
    leaks = find_leaks(docs, benchmark, **parameters).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti")


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every leak with production parameters."""
    return find_leaks(docs, benchmark).select("doc_id", "item_id", F.round("score", 6).alias("score"))
