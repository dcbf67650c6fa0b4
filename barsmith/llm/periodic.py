"""Periodic runs of words, enumerated as maximal pairs of a bottom-up LCP-interval tree.

A run is a stretch of words with smallest period q, of at least
``max(MIN_LENGTH, MIN_EXPONENT * q)`` words, that no neighbouring word extends.

1. *Suffix order.* Suffixes of all texts of a batch are ordered together by prefix
   doubling (numpy); a word counts with its document, so no two documents share a
   prefix. Only suffixes that share their first ``LEAST_LCP`` words with another
   are of interest and go on; in prose that is hardly any.
2. *LCP-interval tree.* Their LCPs follow from the ranks of every doubling. The tree is
   walked bottom-up with a stack; a node holds its positions in lists by the word
   to their left. Joining two children of a node of LCP l, every position of the
   smaller one looks up the other's lists of different left words: a pair with
   distance d is maximal, as its left and right words both differ.
3. *Runs.* A maximal pair with ``l >= (MIN_EXPONENT - 1) * d`` and
   ``l + d >= MIN_LENGTH`` covers exactly one run from its first position, of
   l + d words; only distances that short are looked up, and nothing is extended.
   Multiples of a period give the same stretch: the smallest distance stays.

A document is worked on by one task, texts stream past in batches of a few MB; nothing is
shuffled.

Defined results: a null, empty or blank text has no words and no run; words are
compared exactly (case and all); repeated rows are rows of their own; an empty
table gives no rows. Only doc_id and text are read, whatever other columns are called.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_BYTES, texts_as_bytes, words

MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Words that the two ends of any run's maximal pair share at least: the power of
#: two below ``MIN_LENGTH * (MIN_EXPONENT - 1) / MIN_EXPONENT``.
LEAST_LCP = 16
#: Left words up to which a node's lists are searched one by one.
FEW_CLASSES = 16

_TO_SPACE = bytes.maketrans(SPACE_BYTES, b" " * len(SPACE_BYTES))


def split_words(text: bytes) -> list[bytes]:
    return [w for w in text.translate(_TO_SPACE).split(b" ") if w]


def _first_of_equal(keys: np.ndarray) -> np.ndarray:
    """For ascending keys, the index at which each one's run of equal keys starts."""
    new = np.r_[True, keys[1:] != keys[:-1]]
    return np.flatnonzero(new)[np.cumsum(new) - 1]


def _shared(ranks: np.ndarray) -> np.ndarray:
    """Mask of the ascending ranks that occur more than once."""
    same = ranks[1:] == ranks[:-1]
    return np.r_[False, same] | np.r_[same, False]


def suffix_ranks(tokens: np.ndarray) -> list[np.ndarray]:
    """Per level k the rank of every position by its first 2^k tokens, until all differ.

    Equal ranks are equal stretches. Tokens that end a text have to be unique.
    """
    order = np.argsort(tokens, kind="stable")
    rank = np.empty(len(tokens), np.int64)
    rank[order] = _first_of_equal(tokens[order]) if len(order) else 0
    levels, width = [rank], 1
    open_ = order[_shared(rank[order])] if len(order) else order
    while len(open_):
        rank = levels[-1]
        key = rank[open_] * len(tokens) + rank[open_ + width]
        by = np.argsort(key, kind="stable")
        at, key = open_[by], key[by]
        old = rank[at]
        now = rank.copy()
        now[at] = old + _first_of_equal(key) - _first_of_equal(old)
        levels.append(now)
        open_ = at[_shared(now[at])]
        width *= 2
    return levels


def _common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at a and b."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        length += (levels[k][a + length] == levels[k][b + length]).astype(np.int64) << k
    return length


class _Node:
    """Positions of an LCP interval, in ascending lists by their left word."""

    __slots__ = ("size", "lists", "all")

    def __init__(self, position: int, left: int):
        self.size = 1
        self.lists = {left: [position]}
        self.all: list[int] | None = None

    def near(self, position: int, left: int, most: int):
        """The positions within ``most`` of one whose left word is not ``left``."""
        lo, hi = position - most, position + most
        if len(self.lists) <= FEW_CLASSES:
            for word, held in self.lists.items():
                if word != left:
                    yield from held[bisect_left(held, lo):bisect_right(held, hi)]
            return
        own = self.lists.get(left, ())
        held = self.all
        for p in held[bisect_left(held, lo):bisect_right(held, hi)]:
            at = bisect_left(own, p)
            if at == len(own) or own[at] != p:
                yield p

    def take(self, other: _Node) -> None:
        for word, held in other.lists.items():
            mine = self.lists.get(word)
            if mine is None:
                self.lists[word] = held
            else:
                for p in held:
                    insort(mine, p)
            if self.all is not None:
                for p in held:
                    insort(self.all, p)
        self.size += other.size
        if self.all is None and len(self.lists) > FEW_CLASSES:
            self.all = sorted(p for held in self.lists.values() for p in held)


def _join(a: _Node, b: _Node, lcp: int, found: dict) -> _Node:
    """The node of two children of an interval; its runs go to ``found``."""
    if a.size < b.size:
        a, b = b, a
    most = lcp // (MIN_EXPONENT - 1)
    for left, held in b.lists.items():
        for p in held:
            for q in a.near(p, left, most):
                start, period = (p, q - p) if p < q else (q, p - q)
                if lcp + period >= MIN_LENGTH:
                    key = start, lcp + period
                    if period < found.get(key, period + 1):
                        found[key] = period
    a.take(b)
    return a


def _runs_of_group(positions: list[int], lcps: list[int], lefts: list[int], found: dict) -> None:
    """Walk the LCP-interval tree over suffixes in order; ``lcps[i]`` is that of i and i + 1."""
    stack: list[tuple[_Node, int]] = []
    for position, left, lcp in zip(positions, lefts, lcps):
        node = _Node(position, left)
        while stack and stack[-1][1] >= lcp:
            before, depth = stack.pop()
            node = _join(before, node, depth, found)
        stack.append((node, lcp))


def periodic_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of every word list, by start, then period."""
    ids: dict[bytes, int] = {}
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths + 1)
    first = ends - lengths - 1
    total = int(ends[-1]) if len(texts) else 0
    doc = np.repeat(np.arange(len(texts)), lengths + 1)
    word = np.empty(total, np.int64)
    for t, lo in zip(texts, first):
        word[lo:lo + len(t)] = [ids.setdefault(w, len(ids)) for w in t]
    # Word 0 of every document ends it and is unique, as all words are of their document.
    word += 1
    word[ends - 1] = 0
    tokens = word * len(texts) + doc
    levels = suffix_ranks(tokens)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    least = LEAST_LCP.bit_length() - 1
    if len(levels) <= least:
        return out
    group = levels[least]
    order = np.argsort(group, kind="stable")
    order = order[_shared(group[order])]
    order = order[np.argsort(levels[-1][order], kind="stable")]
    if not len(order):
        return out
    lcp = np.zeros(len(order), np.int64)
    linked = np.flatnonzero(group[order[1:]] == group[order[:-1]])
    lcp[linked] = _common_prefix(levels, order[linked], order[linked + 1])
    left = np.where(order == first[doc[order]], 0, tokens[order - 1])
    bounds = np.flatnonzero(lcp == 0) + 1
    found: dict[tuple[int, int], int] = {}
    positions, lcps, lefts = order.tolist(), lcp.tolist(), left.tolist()
    for lo, hi in zip([0, *bounds[:-1].tolist()], bounds.tolist()):
        _runs_of_group(positions[lo:hi], lcps[lo:hi], lefts[lo:hi], found)
    for (start, length), period in found.items():
        at = int(doc[start])
        out[at].append((start - int(first[at]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest exact length / period; ties by start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(text: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, without those that a run holds after its first period, joined by a space."""
    if runs:
        keep = np.ones(len(text), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        text = [text[i] for i in np.flatnonzero(keep)]
    return b" ".join(text)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_SQL = "struct<start:long,length:long,period:long>"


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, best, collapsed) of every row of (doc_id, text)."""
    keys = ("start", "length", "period")

    def as_run(run):
        return None if run is None else dict(zip(keys, run))

    def emit(batches):
        for batch in batches:
            texts = [split_words(t) for t in texts_as_bytes(batch.column("text"))]
            runs = periodic_runs(texts)
            collapsed = pa.array([collapse(t, r) for t, r in zip(texts, runs)], pa.large_binary())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([[as_run(r) for r in rs] for rs in runs], pa.list_(RUN)),
                pa.array([as_run(best_run(rs)) for rs in runs], RUN),
                collapsed.cast(pa.large_string()).cast(pa.string())],
                names=["doc_id", "runs", "best", "collapsed"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        emit, f"doc_id {id_type}, runs array<{_RUN_SQL}>, best {_RUN_SQL}, collapsed string")


def periodised(doc_id: Column, text: Column) -> Column:
    """The query's planted periods: a tenth of the texts repeat a stretch up to their end."""
    crc = F.crc32(doc_id.cast("string"))
    g = F.floor(crc / 10)

    def planted(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = F.floor((n - a) / (g % 8 + 3)) + 1
        return F.array_join(F.transform(w, lambda x, i: F.when(
            i >= a, F.get(w, (a + (i - a) % p).cast("int"))).otherwise(x)), " ")

    # transform over an array of one splits a text once.
    split = F.transform(F.array(words(text)), planted)
    has_words = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r")) != ""
    return F.when((crc % 10 == 0) & has_words, F.get(split, F.lit(0))).otherwise(text)


def query(docs: DataFrame) -> DataFrame:
    """Run counts, the strongest run and digests of every document, some with planted periods."""
    texts = docs.select("doc_id", periodised(F.col("doc_id"), F.col("text")).alias("text"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return find_runs(texts).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


#: CRC-32 of the decimal doc_id, bit by bit.
CRC_SQL = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
  list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""

QUERY_SQL = fr"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce({CRC_SQL}, 1) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
placed AS (
  SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a FROM split),
shaped AS (
  SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
texts AS (
  SELECT doc_id, r, n, unnest(range(n)) AS i,
    CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END])
         ELSE w END AS w FROM shaped),
word AS (SELECT r, i, n, w[i + 1] AS x FROM texts),
same AS (
  SELECT r, a.i, b.i - a.i AS q FROM word a JOIN word b USING (r, x)
  WHERE b.i > a.i AND b.i - a.i <= a.n // 3),
island AS (
  SELECT r, i, q, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM same),
stretch AS (
  SELECT r, min(i) AS start, count(*) + q AS length, q FROM island GROUP BY r, q, g
  HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT r, start, length, min(q) AS period FROM stretch GROUP BY r, start, length),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s
  FROM runs GROUP BY r),
best AS (
  SELECT r, start, length, period FROM runs a
  WHERE NOT EXISTS (SELECT 1 FROM runs b WHERE b.r = a.r AND (b.length * a.period > a.length * b.period
    OR b.length * a.period = a.length * b.period AND (b.start, b.period) < (a.start, a.period)))),
kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY i) AS s FROM word
  WHERE NOT EXISTS (SELECT 1 FROM runs b WHERE b.r = word.r
    AND word.i >= b.start + b.period AND word.i < b.start + b.length) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
  1000 * length // period AS exponent_milli,
  sha256(coalesce(listed.s, '')) AS runs_sha256, sha256(coalesce(kept.s, '')) AS collapsed_sha256
FROM split LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""
