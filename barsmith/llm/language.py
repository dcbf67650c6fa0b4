"""Language identification: a linear-chain conditional random field over words.

Every word of a text is a position, languages are the labels. A word's
features are its affixes (up to three characters at either end), its character
2- and 3-grams and its entry in a lexicon of frequent words; all are hashed
into ``FEATURES`` slots. Transitions between neighbouring labels are learned.
Forward-backward gives every word a distribution over languages, in texts that
switch language too; a document's language is the one with the largest sum of
word marginals, its score that sum's share.

Fitting (bounded, documented): at most ``MAX_DOCS`` distinct labelled texts,
picked by hash evenly over the languages, of each at most ``MAX_WORDS`` words,
as stretches of ``STRETCH`` words at hashed places of the whole text (every
stretch of a text that has no more); their words carry the document's label,
and every training sequence is a
concatenation of stretches of different documents, so that transitions are
learned on switches as well as on runs. The lexicon is counted over the whole
training corpus. The weights are fitted by averaged stochastic gradient steps
on the chain's log-likelihood.

Prediction covers whole texts where they lie: the distinct words of a slice are
scored together, their pieces' slots read from tables by character, and the recursions
run over all texts of a batch in lockstep, in slices of equal length, so a very
long text costs its length and nothing is padded to it.

Words are maximal runs of letters (and marks), lower-cased.

Defined results: a text that is null or has no letter is ``und`` with score 0;
ties go to the smaller language name; without labelled documents everything is
``und``; repeated rows are predicted alike; an empty table gives an empty
result. Only text and the labels of the training documents are used.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache
from itertools import chain as joined
from operator import add
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

FEATURES = 1 << 16
#: Distinct labelled texts the chain is fitted on, at most, and words of each (in whole stretches).
MAX_DOCS = 1_200
MAX_WORDS = 120
#: Words of the lexicon, per language.
LEXICON_WORDS = 5_000
EPOCHS = 2
RATE = 0.3
#: Words of one training stretch; a training sequence holds ``STRETCHES`` of them.
STRETCH = 12
STRETCHES = 5
#: Words whose emissions are summed at a time.
CHUNK = 4_096
#: Pieces of one kind whose slots a worker remembers before it starts afresh.
PIECES = 1 << 16
#: Characters whose pieces' slots stand in tables, the boundary marks included, and what their codes
#: stay below (alphabets do, ideographs don't); words with others are cut one by one.
ALPHABET = 128
ALPHABETIC = 0x2000
#: Words of all texts of one lockstep slice, about.
SLICE = 1 << 18

_WORD = regex.compile(r"[\p{L}\p{M}]+")
_ASCII_WORD = re.compile("[a-z]+")
_LETTER = regex.compile(r"\p{L}")


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    return _ASCII_WORD.findall(text) if text.isascii() else _WORD.findall(text)


def _slot(name: str) -> int:
    return crc32(name.encode()) % FEATURES


class _Slots(dict):
    """Slots of the affixes or n-grams of one kind, remembered: words are many, their pieces few."""

    def __init__(self, kind: str):
        super().__init__()
        self.kind = kind

    def __missing__(self, piece: str) -> int:
        if len(self) >= PIECES:
            self.clear()
        slot = self[piece] = _slot(self.kind + piece)
        return slot


_BIAS = _slot("bias")
_STARTS, _ENDS = ([(n, _Slots(f"{kind}{n}")) for n in (1, 2, 3)] for kind in "ps")
_PAIRS, _TRIPLES = _Slots("2"), _Slots("3")


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Hashed slots of a word's affixes, n-grams and lexicon entry; bias first."""
    w = f"^{word}$"
    slots = [_BIAS]
    slots += [of[word[:n]] for n, of in _STARTS if n <= len(word)]
    slots += [of[word[-n:]] for n, of in _ENDS if n <= len(word)]
    pairs = list(map(add, w, w[1:]))
    slots += map(_PAIRS.__getitem__, pairs)
    slots += map(_TRIPLES.__getitem__, map(add, pairs, w[2:]))
    if word in lexicon:
        slots += [_slot(f"w{word}"), _slot(f"l{lexicon[word]}")]
    return slots


class _PieceTable:
    """Slots of the pieces of ``size`` characters of one kind, by the characters' numbers; filled as pieces are met."""

    def __init__(self, kind: str, size: int):
        self.kind, self.size = kind, size
        self.slots = np.full(ALPHABET ** size, -1, np.int32)

    def look_up(self, numbers: list[np.ndarray], letters: list[str]) -> np.ndarray:
        at = numbers[0]
        for more in numbers[1:]:
            at = at * ALPHABET + more
        found = self.slots[at]
        if found.size and found.min() < 0:
            for key in np.unique(at[found < 0]).tolist():
                piece = [letters[key // ALPHABET ** i % ALPHABET] for i in range(self.size)]
                self.slots[key] = _slot(self.kind + "".join(reversed(piece)))
            found = self.slots[at]
        return found


class _Cutter:
    """:func:`features` of many words at once, of those written in the first ``ALPHABET`` characters met."""

    def __init__(self):
        self.letters: list[str] = []
        self.number = np.full(0x110000, -1, np.int16)
        self.starts = [_PieceTable(f"p{n}", n) for n in (1, 2, 3)]
        self.ends = [_PieceTable(f"s{n}", n) for n in (1, 2, 3)]
        self.pairs, self.triples = _PieceTable("2", 2), _PieceTable("3", 3)

    def numbers(self, text: str) -> np.ndarray:
        """The number of every character, -1 beyond the alphabet."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        numbers = self.number[codes]
        if numbers.min() < 0 and len(self.letters) < ALPHABET:
            new = np.unique(codes[(numbers < 0) & (codes < ALPHABETIC)])
            for code in new[:ALPHABET - len(self.letters)].tolist():
                self.number[code] = len(self.letters)
                self.letters.append(chr(code))
            numbers = self.number[codes]
        return numbers.astype(np.int32)

    def slots(self, words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of all words, one word after the other, and how many each has."""
        code = self.numbers("^" + "$^".join(words) + "$")
        n = np.fromiter(map(len, words), np.int64, len(words))
        listed = [(i, w) for i, w in enumerate(words) if w in lexicon]
        affixes = np.minimum(n, 3)
        sizes = 2 + 2 * affixes + 2 * n
        sizes[[i for i, _ in listed]] += 2
        first = np.cumsum(n + 2) - (n + 2)
        strange = np.minimum.reduceat(code, first) < 0
        alone = {i: features(words[i], lexicon) for i in np.flatnonzero(strange).tolist()}
        code[code < 0] = 0  # stands in where a word is cut alone
        at = np.cumsum(sizes) - sizes
        flat = np.empty(int(sizes.sum()), np.int64)
        flat[at] = _BIAS
        usual = ~strange
        for k, (start, end) in enumerate(zip(self.starts, self.ends), 1):
            own = np.flatnonzero((n >= k) & usual)
            lo, hi = first[own] + 1, first[own] + 1 + n[own] - k
            flat[at[own] + k] = start.look_up([code[lo + i] for i in range(k)], self.letters)
            flat[at[own] + affixes[own] + k] = end.look_up([code[hi + i] for i in range(k)], self.letters)
        # The characters of usual words, marks included: each but the last begins a pair, each but the last two a triple.
        length = np.where(usual, n + 2, 0)
        word = np.repeat(np.arange(len(words)), length)
        place = np.arange(len(word)) - np.repeat(np.cumsum(length) - length, length)
        here = first[word] + place
        to = (at + 1 + 2 * affixes)[word] + place
        left = n[word] - place
        pair, triple = left >= 0, left > 0
        flat[to[pair]] = self.pairs.look_up([code[here[pair] + i] for i in range(2)], self.letters)
        flat[to[triple] + n[word[triple]] + 1] = self.triples.look_up([code[here[triple] + i] for i in range(3)], self.letters)
        ends = (at + sizes).tolist()
        for i, w in listed:
            flat[ends[i] - 2], flat[ends[i] - 1] = _slot(f"w{w}"), _slot(f"l{lexicon[w]}")
        for i, own in alone.items():
            flat[ends[i] - len(own):ends[i]] = own
        return flat, sizes


@cache
def _cutter() -> _Cutter:
    """The worker's tables."""
    return _Cutter()


class Chain:
    """Weights of the field: emissions by feature slot, transitions, labels."""

    def __init__(self, labels: list[str], lexicon: dict[str, int]):
        n = len(labels)
        self.labels, self.lexicon = labels, lexicon
        self.emit = np.zeros((FEATURES, n))
        self.move = np.zeros((n, n))

    def emission(self, word: str) -> np.ndarray:
        """Scores of a word under every label; a mean over its features keeps long words in scale."""
        slots = features(word, self.lexicon)
        return self.emit[slots].sum(axis=0) / np.sqrt(len(slots))

    def emissions(self, words: list[str]) -> np.ndarray:
        """:meth:`emission` of every word, in one sum over their slots."""
        flat, sizes = _cutter().slots(words, self.lexicon)
        return np.add.reduceat(self.emit[flat], np.cumsum(sizes) - sizes, axis=0) / np.sqrt(sizes)[:, None]

    def marginals(self, scores: np.ndarray) -> np.ndarray:
        """Posterior label distributions of one sequence, by forward-backward (for fitting and tests)."""
        n = len(scores)
        e = np.exp(scores - scores.max(axis=1, keepdims=True))
        m = np.exp(self.move)
        a, b = np.empty_like(e), np.ones_like(e)
        a[0] = e[0] / e[0].sum()
        for t in range(1, n):
            a[t] = (a[t - 1] @ m) * e[t]
            a[t] /= a[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = m @ (e[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        p = a * b
        return p / p.sum(axis=1, keepdims=True), a, b, e, m

    def step(self, slots: list[list[int]], gold: np.ndarray, rate: float) -> None:
        """One gradient step on a sequence's log-likelihood."""
        scores = np.array([self.emit[s].sum(axis=0) / np.sqrt(len(s)) for s in slots])
        p, a, b, e, m = self.marginals(scores)
        off = -p
        off[np.arange(len(gold)), gold] += 1
        sizes = [len(s) for s in slots]
        flat = np.concatenate(slots)
        np.add.at(self.emit, flat, rate * np.repeat(off / np.sqrt(np.array(sizes))[:, None], sizes, axis=0))
        pair = a[:-1, :, None] * m[None] * (e[1:] * b[1:])[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        expected = -pair.sum(axis=0)
        np.add.at(expected, (gold[:-1], gold[1:]), 1)
        self.move += rate / len(gold) * expected


def lockstep_marginal_sums(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Sum of word marginals of every text: forward-backward over all texts side by side.

    ``scores`` holds the texts one after the other, longest first: at step t
    the texts still running are a prefix, so every step is one small matrix
    product and no text is padded. Words are laid out step by step first, so
    a step reads and writes one block.
    """
    n, labels = len(lengths), scores.shape[1]
    longest = int(lengths[0]) if n else 0
    alive = np.searchsorted(-lengths, -np.arange(longest), side="left")  # texts longer than t
    ends = np.cumsum(alive)
    owner = np.repeat(np.arange(n), lengths)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = (ends - alive)[step] + owner
    e = np.empty_like(scores)
    e[place] = np.exp(scores - scores.max(axis=1, keepdims=True))
    m, back_m = np.exp(move), np.exp(move).T
    blocks = list(zip((ends - alive).tolist(), ends.tolist()))
    forward, back = np.empty_like(e), np.ones_like(e)
    add, state = np.add.reduce, None
    for lo, hi in blocks:
        now = np.multiply(e[lo:hi] if state is None else state[:hi - lo] @ m, 1.0 if state is None else e[lo:hi],
                          out=forward[lo:hi])
        now /= add(now, axis=1, keepdims=True)
        state = now
    for (lo, hi), (before, _) in zip(blocks[:0:-1], blocks[-2::-1]):
        # A text that ends at the step before keeps its ones there.
        now = np.matmul(e[lo:hi] * back[lo:hi], back_m, out=back[before:before + hi - lo])
        now /= add(now, axis=1, keepdims=True)
    forward *= back
    forward /= forward.sum(axis=1, keepdims=True)
    text = np.empty_like(owner)
    text[place] = owner
    return np.stack([np.bincount(text, forward[:, k], minlength=n) for k in range(labels)], axis=1)


def stretches_of(text: str, max_words: int) -> list[str]:
    """At most ``max_words`` words in stretches of ``STRETCH``: those with the lowest hashes of text and place."""
    words = words_of(text)
    cut = [" ".join(words[i:i + STRETCH]) for i in range(0, len(words), STRETCH)]
    seed = xxhash.xxh3_64_intdigest(text.encode())
    order = sorted(range(len(cut)), key=lambda i: (xxhash.xxh3_64_intdigest(str(i), seed), i))
    return [cut[i] for i in sorted(order[:max(1, max_words // STRETCH)])]


def training_rows(docs: DataFrame, max_docs: int = MAX_DOCS, max_words: int = MAX_WORDS) -> list[tuple[str, list[str]]]:
    """(lang, stretches) of at most ``max_docs`` distinct labelled texts, by hash, evenly over languages."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    langs = [r[0] for r in known.select("lang").distinct().orderBy("lang").collect()]
    per = max(1, max_docs // max(1, len(langs)))

    def emit(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([stretches_of(t, max_words) for t in batch.column("text").to_pylist()],
                                               pa.list_(pa.string()))], names=["key", "stretches"])

    out = []
    for lang in langs:
        own = known.where(F.col("lang") == lang).select(F.sha2("text", 256).alias("key"), "text")
        # Digests are picked first: copies of a text are one, and only picked texts travel.
        picked = own.select("key").distinct().orderBy("key").limit(per)
        rows = (own.join(F.broadcast(picked), "key", "left_semi").mapInArrow(emit, "key string, stretches array<string>")
                .groupBy("key").agg(F.first("stretches").alias("stretches")).orderBy("key").collect())
        out += [(lang, r["stretches"]) for r in rows]
    return out


def lexicon_of(docs: DataFrame, per_language: int = LEXICON_WORDS) -> dict[str, int]:
    """word -> index of its most frequent language, of the most frequent words over all labelled documents."""
    def emit(batches):
        for batch in batches:
            counts: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                counts.setdefault(lang, Counter()).update(words_of(text))
            for lang, own in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.string()),
                     pa.array(list(own.values()), pa.int64())], names=["lang", "word", "n"])

    counted = (docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
               .mapInArrow(emit, "lang string, word string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n")))
    best = stored(counted.groupBy("word").agg(F.sum("n").alias("n"), F.max_by("lang", F.struct("n", "lang")).alias("lang"))
                  .where("n > 1"), "lexicon")
    out: dict[str, int] = {}
    langs = [r[0] for r in best.select("lang").distinct().orderBy("lang").collect()]
    for i, lang in enumerate(langs):
        top = best.where(F.col("lang") == lang).orderBy(F.desc("n"), "word").limit(per_language).collect()
        out.update((r["word"], i) for r in top)
    return out


def fit(docs: DataFrame, max_docs: int = MAX_DOCS, max_words: int = MAX_WORDS, epochs: int = EPOCHS,
        rate: float = RATE, seed: int = 7) -> Chain | None:
    """A chain learned from labelled documents; None without any."""
    rows = training_rows(docs, max_docs, max_words)
    if not rows:
        return None
    labels = sorted({lang for lang, _ in rows})
    chain = Chain(labels, lexicon_of(docs))
    pieces = []
    for lang, stretches in rows:
        pieces += [(labels.index(lang), [features(w, chain.lexicon) for w in s.split(" ")]) for s in stretches]
    rng = np.random.default_rng(seed)
    steps, total_emit, total_move = 0, np.zeros_like(chain.emit), np.zeros_like(chain.move)
    for epoch in range(epochs):
        order = rng.permutation(len(pieces))
        # Half of the neighbours share a language: switches and runs.
        order = sorted(order, key=lambda i: (pieces[i][0] if i % 2 else rng.integers(len(labels)))) \
            if epoch % 2 else list(order)
        for k in range(0, len(order), STRETCHES):
            own = [pieces[i] for i in order[k:k + STRETCHES]]
            slots = [s for _, stretch in own for s in stretch]
            if len(slots) > 1:
                gold = np.concatenate([[label] * len(stretch) for label, stretch in own]).astype(int)
                chain.step(slots, gold, rate / (1 + epoch))
        total_emit += chain.emit
        total_move += chain.move
        steps += 1
    chain.emit, chain.move = total_emit / steps, total_move / steps
    return chain


def predict_texts(chain: Chain, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, score) of every text."""
    out = [("und", 0.0)] * len(texts)
    cut = [(i, words_of(t)) for i, t in enumerate(texts) if t and _LETTER.search(t)]
    cut = sorted([c for c in cut if c[1]], key=lambda c: -len(c[1]))
    at = 0
    while at < len(cut):
        held, end = 0, at
        while end < len(cut) and (end == at or held + len(cut[end][1]) <= SLICE):
            held += len(cut[end][1])
            end += 1
        part = cut[at:end]
        # One vector a distinct word, then a row a place.
        coded = pa.array(list(joined.from_iterable(ws for _, ws in part)), pa.large_string()).dictionary_encode()
        distinct, places = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        vectors = np.concatenate([chain.emissions(distinct[lo:lo + CHUNK]) for lo in range(0, len(distinct), CHUNK)])
        lengths = np.array([len(ws) for _, ws in part])
        sums = lockstep_marginal_sums(vectors[places], lengths, chain.move)
        shares = sums / sums.sum(axis=1, keepdims=True)
        for (i, _), share in zip(part, shares):
            k = int(np.argmax(share))
            out[i] = (chain.labels[k], float(min(1.0, share[k])))
        at = end
    return out


def predict(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; its other columns are passed through."""
    docs = docs.drop("lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    text_at = docs.columns.index("text")
    names = [*docs.columns, "lang_pred", "score"]

    def run(batches):
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            found = [("und", 0.0)] * len(texts) if sent.value is None else \
                predict_texts(sent.value, texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=names)

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def query(docs: DataFrame) -> DataFrame:
    """Every document's language, learned from those whose crc32(doc_id) mod 4 is not 2."""
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    rows = docs.select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    # A null id has no remainder: its document is neither held out nor learned from.
    chain = fit(rows.where(~F.col("held_out") & F.col("doc_id").isNotNull()).select("text", "lang"))
    return predict(rows.select("doc_id", "held_out", "text"), chain).select(
        "doc_id", "held_out", "lang_pred", "score")
