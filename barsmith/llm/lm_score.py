"""LM scoring: masked pseudo-likelihood under a bidirectional window network.

The network predicts every token from ``SIDE`` tokens on either side and never
sees the token itself: position-wise embeddings of the neighbours are summed,
passed through tanh, and a two-step softmax (class, then token within its
class) gives the conditional probability. A document's score is the sum of the
conditional log-probabilities of all its tokens, its pseudo-log-likelihood.

Tokens are words (ASCII white space, A-Z lower-cased), all counted over all
documents in a Spark table that grows with the corpus. The network's tokens are
the ``VOCABULARY - 1 - TAILS`` most frequent words; any other word is one of
``TAILS`` hashed tail tokens. Tokens are numbered by frequency and dealt over
``CLASSES`` classes of equal size. A tail word is scored by its own probability,
P(tail token | neighbours) * P(word | tail token), the second its share of the
tail token's occurrences in the corpus, joined by word. Neighbours that are tail
words act through their tail token only.

Training is data-parallel, in numpy inside Spark tasks: in every round each
partition of the corpus makes one pass of stochastic gradient steps over all of
its tokens, the last, smaller batch included, starting from the round's
parameters and hands back its parameters; Spark averages them, weighted by tokens, row by row with a
map-side combined aggregate. Parameters are a fixed 1.4 MB. Rounds are written
tables; a lost executor repeats its partitions with the same result.

Scoring covers whole texts where they lie, in slices of ``SLICE`` tokens; the
network's sums and every row's tail words are written once, under an id of the
row, and the tail words' shares are joined and added by that id.

Defined results: a null text or one without words has no tokens and score 0;
a tail word that the counted corpus does not hold scores as one seen once;
repeated rows score alike; an empty table gives an empty result. Other columns
are passed through; ``n_tokens`` and ``pll`` of the input are replaced.
"""

from __future__ import annotations

from collections import Counter
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, stored, texts_as_bytes

#: Tokens: padding (0), frequent words, hashed tail tokens. CLASSES * CLASSES of them.
CLASSES = 64
VOCABULARY = CLASSES * CLASSES
TAILS = 256
SIDE = 2
HIDDEN = 24
ROUNDS = 2
#: Every so many tokens one is trained on: all of them.
TRAIN_SHARE = 1
RATE = 0.5
BATCH = 256
#: Rows of one class in a block of a step, classes whose gradients are added at a
#: time, and tokens whose steps are laid out at a time.
BLOCK = 8
PART = 32
LAID = 64 * BATCH
#: Words a worker keeps: counts before they are handed on, tokens of tail words.
KEPT = 1 << 17
#: Tokens held for scoring, and of these, scored at a time.
SLICE = 1 << 16
SCORED = 1 << 13

_ONES = np.ones(CLASSES, np.float32)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of every word of all documents, a written table."""
    def emit(batches):
        counts: Counter[bytes] = Counter()

        def counted():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "n"])

        for batch in batches:
            for text in texts_as_bytes(batch.column("text")):
                counts.update(words_of(text))
                if len(counts) >= KEPT:
                    yield counted()
                    counts.clear()
        yield counted()

    return stored(docs.select("text").mapInArrow(emit, "word binary, n long").groupBy("word")
                  .agg(F.sum("n").alias("n")), "word-counts")


def vocabulary(counts: DataFrame) -> dict[bytes, int]:
    """word -> token, of the most frequent words of :func:`word_counts` (1 is the most frequent)."""
    size = VOCABULARY - 1 - TAILS
    rows = counts.orderBy(F.desc("n"), "word").limit(size).select("word").collect()
    return {bytes(r["word"]): i + 1 for i, r in enumerate(rows)}


def tail_of(word: bytes) -> int:
    """Which tail token a word outside the vocabulary is."""
    return xxhash.xxh3_64_intdigest(word) % TAILS


def tail_totals(counts: DataFrame, vocab: dict[bytes, int]) -> list[int]:
    """Occurrences of every tail token in the corpus."""
    sent = counts.sparkSession.sparkContext.broadcast(vocab)

    def emit(batches):
        sums = [0] * TAILS
        for batch in batches:
            for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                if w not in sent.value:
                    sums[tail_of(w)] += n
        yield pa.RecordBatch.from_arrays([pa.array(range(TAILS), pa.int32()), pa.array(sums, pa.int64())],
                                         names=["tail", "n"])

    sums = counts.mapInArrow(emit, "tail int, n long").groupBy("tail").agg(F.sum("n").alias("n")).collect()
    out = [0] * TAILS
    for r in sums:
        out[r["tail"]] = r["n"]
    return out


class Tokens(dict):
    """word -> token: a vocabulary to which tail words are added as they come, up to ``KEPT`` words."""

    def __missing__(self, word: bytes) -> int:
        token = VOCABULARY - TAILS + tail_of(word)
        if len(self) < KEPT:
            self[word] = token
        return token


def tokens_of_words(words: list[bytes], vocab: dict[bytes, int]) -> np.ndarray:
    known = vocab if isinstance(vocab, Tokens) else Tokens(vocab)
    return np.fromiter(map(known.__getitem__, words), np.int32, len(words))


def tokens_of(text: bytes, vocab: dict[bytes, int]) -> np.ndarray:
    return tokens_of_words(words_of(text), vocab)


def contexts(tokens: np.ndarray) -> np.ndarray:
    """The 2 * SIDE neighbours of every token, 0 beyond the text's ends."""
    padded = np.zeros(len(tokens) + 2 * SIDE, np.int32)
    padded[SIDE:-SIDE] = tokens
    offsets = [*range(SIDE), *range(SIDE + 1, 2 * SIDE + 1)]
    return np.stack([padded[o:o + len(tokens)] for o in offsets], axis=1)


class Network:
    """Parameters: neighbour embeddings per position, class and in-class output weights and biases."""

    SHAPES = {"embed": (2 * SIDE * VOCABULARY, HIDDEN), "classes": (CLASSES, HIDDEN + 1),
              "members": (VOCABULARY, HIDDEN + 1)}

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def fresh(cls, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        return cls(**{k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in cls.SHAPES.items()})

    def copy(self) -> Network:
        return Network(**{k: getattr(self, k).copy() for k in self.SHAPES})

    def hidden(self, near: np.ndarray) -> np.ndarray:
        """Hidden values of the tokens with these embedding rows (side by token), and a 1 for the biases."""
        total = self.embed.take(near[0], axis=0)
        for rows in near[1:]:
            total += self.embed.take(rows, axis=0)
        h = np.ones((len(total), HIDDEN + 1), np.float32)
        np.tanh(total, out=h[:, :-1])
        return h

    def log_probs(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log P(target | neighbours) of every row."""
        out = np.empty(len(target))
        by_class = np.ascontiguousarray(_by_class(self.members))
        for lo in range(0, len(target), SCORED):
            part = target[lo:lo + SCORED]
            order, klass, bounds = _class_order(part)
            h, inner = self.hidden(_near_rows(around[lo:lo + SCORED][order])), part[order] // CLASSES
            logs = _log_softmax_at(h @ self.classes.T, klass)
            for k in np.flatnonzero(np.diff(bounds)):
                own = slice(bounds[k], bounds[k + 1])
                logs[own] += _log_softmax_at(h[own] @ by_class[k], inner[own])
            out[lo + order] = logs
        return out


def _near_rows(around: np.ndarray) -> np.ndarray:
    """Embedding rows of the neighbours, side by token."""
    return np.ascontiguousarray((around + np.arange(2 * SIDE) * VOCABULARY).T)


def _by_class(members: np.ndarray) -> np.ndarray:
    """(class, hidden, member in class): the members of class k are the tokens k, k + CLASSES, ..."""
    return members.reshape(CLASSES, CLASSES, HIDDEN + 1).transpose(1, 2, 0)


def _class_order(target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of rows by class, the classes in that order, and where each class begins."""
    klass = (target % CLASSES).astype(np.uint8)
    order = np.argsort(klass, kind="stable")
    klass = klass[order]
    return order, klass, np.searchsorted(klass, np.arange(CLASSES + 1))


def _exp(x: np.ndarray) -> np.ndarray:
    """exp in place, of every row up to a factor: rows are shifted only where they could overflow."""
    if max(x.max(), -x.min()) > 40:
        x -= x.max(axis=-1, keepdims=True)
    return np.exp(x, out=x)


def _log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log of the softmax of every row at one column; ``x`` is overwritten."""
    if max(x.max(), -x.min()) > 40:
        x -= x.max(axis=1, keepdims=True)
    own = x[np.arange(len(x)), at].astype(np.float64)
    return own - np.log(np.exp(x, out=x) @ _ONES)


class Steps:
    """Stochastic gradient steps on a network, batch after batch.

    A batch's rows are ordered by class. In the second softmax they lie in
    blocks of ``BLOCK`` rows of one class: one block for every class, further
    ones for classes with more rows, so that a batch takes a few products of
    stacked matrices. Everything that depends on tokens only (orders, blocks,
    cells) is laid out for up to ``LAID`` tokens at once.
    """

    def __init__(self, net: Network):
        self.net = net.copy()
        self.by_class = np.ascontiguousarray(_by_class(self.net.members))

    def network(self) -> Network:
        """The network after the steps made so far."""
        _by_class(self.net.members)[:] = self.by_class
        return self.net

    def run(self, around: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One step for every ``BATCH`` rows in turn and one for the rest, if any; ``rate`` for 32 rows."""
        for lo in range(0, len(target), LAID):
            self._run(around[lo:lo + LAID], target[lo:lo + LAID], rate)

    def _run(self, around: np.ndarray, target: np.ndarray, rate: float) -> None:
        n = len(target)
        starts = np.minimum(np.arange(0, n + BATCH, BATCH), n)
        batch, klass = np.arange(n) // BATCH, target % CLASSES
        order = np.argsort((batch * CLASSES + klass).astype(np.uint16), kind="stable")
        around, klass, inner = around[order], klass[order], target[order] // CLASSES
        # Runs of one class in one batch, and the block every row lies in.
        firsts = np.flatnonzero(np.diff(batch * CLASSES + klass, prepend=-1))
        sizes = np.diff(firsts, append=n)
        place = np.arange(n) - np.repeat(firsts, sizes)
        more = (sizes - 1) // BLOCK
        more_class = np.repeat(klass[firsts], more)
        more_ends = np.concatenate([[0], np.cumsum(more)])
        more_from = more_ends[np.searchsorted(firsts, starts)]
        after = np.repeat(more_ends[:-1] - more_from[batch[firsts]], sizes) + place // BLOCK - 1
        slot = np.where(place < BLOCK, klass, CLASSES + after) * BLOCK + place % BLOCK
        class_cell, member_cell = np.arange(n) % BATCH * CLASSES + klass, slot * CLASSES + inner
        near = _near_rows(around)
        for b in range(len(starts) - 1):
            rows = slice(starts[b], starts[b + 1])
            self._step(near[:, rows], class_cell[rows], slot[rows], member_cell[rows],
                       more_class[more_from[b]:more_from[b + 1]], rate / 32)

    def _step(self, near_rows, class_cell, slot, member_cell, more_class, rate):
        net, by_class = self.net, self.by_class
        h = net.hidden(near_rows)
        e = _exp(h @ net.classes.T)
        sums = e @ _ONES
        # exp less the sum at the target: the gradient, negative and not yet divided by the sum.
        e.ravel()[class_cell] -= sums
        factor = (-1 / sums)[:, None]
        back = (e @ net.classes)[:, :-1] * factor
        net.classes += e.T @ (h * (factor * rate))
        blocks = CLASSES + len(more_class)
        near = np.zeros((blocks * BLOCK, HIDDEN + 1), np.float32)
        near[slot] = h
        stacked = near.reshape(blocks, BLOCK, HIDDEN + 1)
        more = by_class[more_class]
        e = np.empty((blocks, BLOCK, CLASSES), np.float32)
        np.matmul(stacked[:CLASSES], by_class, out=e[:CLASSES])
        np.matmul(stacked[CLASSES:], more, out=e[CLASSES:])
        _exp(e)
        sums = (e.reshape(-1, CLASSES) @ _ONES).take(slot)
        e.ravel()[member_cell] -= sums
        factor = -1 / sums
        e.reshape(-1, CLASSES)[slot] *= (factor * rate)[:, None]
        down = np.empty((blocks, BLOCK, HIDDEN + 1), np.float32)
        for lo in range(0, CLASSES, PART):
            part = slice(lo, lo + PART)
            np.matmul(e[part], by_class[part].transpose(0, 2, 1), out=down[part])
            by_class[part] += stacked[part].transpose(0, 2, 1) @ e[part]
        np.matmul(e[CLASSES:], more.transpose(0, 2, 1), out=down[CLASSES:])
        for k, more in zip(more_class.tolist(), stacked[CLASSES:].transpose(0, 2, 1) @ e[CLASSES:]):
            by_class[k] += more
        back *= rate
        back += down.reshape(-1, HIDDEN + 1).take(slot, axis=0)[:, :-1]
        z = h[:, :-1]
        back *= 1 - z * z
        # Rows that occur several times in the batch add up; two numbers an addition.
        pairs, back = net.embed.reshape(-1).view(np.complex64), back.reshape(-1).view(np.complex64)
        for rows in near_rows:
            np.add.at(pairs, (rows[:, None] * (HIDDEN // 2) + np.arange(HIDDEN // 2)).ravel(), back)


def _trained_positions(n: int, at: int, share: int) -> np.ndarray:
    """Positions of a text that are trained on: every ``share``-th token of the stream from ``at``."""
    return np.arange(-at % share, n, share)


def train_round(docs: DataFrame, vocab: dict[bytes, int], net: Network, turn: int, share: int) -> Network:
    """One data-parallel round: a pass per partition, then a token-weighted average of parameters."""
    sent = docs.sparkSession.sparkContext.broadcast((vocab, net))

    def emit(batches):
        vocab, start = sent.value
        known, steps, seen, used = Tokens(vocab), Steps(start), turn, 0
        around, target, held = [], [], 0
        rate = RATE / (1 + turn)

        for batch in batches:
            for text in texts_as_bytes(batch.column("text")):
                tokens = tokens_of(text, known)
                at = _trained_positions(len(tokens), seen, share)
                seen += len(tokens)
                around.append(contexts(tokens)[at])
                target.append(tokens[at])
                held += len(at)
                if held >= LAID:
                    a, t = np.concatenate(around), np.concatenate(target)
                    rest = len(t) - len(t) % BATCH
                    steps.run(a[:rest], t[:rest], rate)
                    used += rest
                    around, target, held = [a[rest:]], [t[rest:]], len(t) - rest
        if held:
            steps.run(np.concatenate(around), np.concatenate(target), rate)
            used += held
        if used:
            own, names, rows, values = steps.network(), [], [], []
            for i, k in enumerate(Network.SHAPES):
                array = getattr(own, k)
                # Only rows this partition changed: its share of the average.
                moved = np.flatnonzero((array != getattr(start, k)).any(axis=1))
                names.append(np.full(len(moved), i, np.int32))
                rows.append(moved.astype(np.int32))
                values.append((array[moved] - getattr(start, k)[moved]).astype(np.float64))
            widths = np.concatenate([np.full(len(v), v.shape[1]) for v in values])
            delta = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(widths)]), pa.int32()),
                                             pa.array(np.concatenate([v.ravel() for v in values])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(names)), pa.array(np.concatenate(rows)),
                 pa.array(np.full(len(widths), used, np.int64)), delta],
                names=["array", "row", "used", "delta"])

    moved = docs.select("text").mapInArrow(emit, "array int, row int, used long, delta array<double>")
    width = HIDDEN + 1
    # Rounded to integers before they are added: the sum does not depend on the order of tasks.
    parts = [F.sum(F.round(F.coalesce(F.get("delta", F.lit(i)), F.lit(0.0)) * F.col("used") * 1e6).cast("long"))
             .alias(f"d{i}") for i in range(width)]
    rows = stored(moved.groupBy("array", "row").agg(F.sum("used").alias("used"), *parts), "round").toPandas()
    out = net.copy()
    for i, (k, shape) in enumerate(Network.SHAPES.items()):
        own = rows[rows["array"] == i]
        delta = own[[f"d{j}" for j in range(shape[1])]].to_numpy() / 1e6 / own["used"].to_numpy()[:, None]
        getattr(out, k)[own["row"].to_numpy()] += delta.astype(np.float32)
    return out


def train(docs: DataFrame, rounds: int = ROUNDS, share: int = TRAIN_SHARE,
          counts: DataFrame | None = None) -> tuple[dict[bytes, int], Network]:
    """Vocabulary and network of a corpus; ``counts`` is its :func:`word_counts` if there already."""
    vocab, net = vocabulary(word_counts(docs) if counts is None else counts), Network.fresh()
    for turn in range(rounds):
        net = train_round(docs, vocab, net, turn, share)
    return vocab, net


def score(docs: DataFrame, vocab: dict[bytes, int], net: Network, counts: DataFrame | None = None,
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``pll``, the sum of conditional log-probabilities (nats).

    ``counts`` are the :func:`word_counts` of the corpus, by default of ``docs``;
    ``keep`` names the columns passed through, by default all.
    """
    docs = docs.drop("n_tokens", "pll")
    counts = word_counts(docs) if counts is None else counts
    keep = docs.columns if keep is None else keep
    sent = docs.sparkSession.sparkContext.broadcast((vocab, net))

    def emit(batches):
        vocab, net = sent.value
        known = Tokens(vocab)
        for batch in batches:
            sums, n_tokens = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            tail_words, times, ends = [], [], [0]
            held, size = [], 0

            def flush():
                owner = np.concatenate([np.full(len(t), i) for i, _, t in held])
                logs = net.log_probs(np.concatenate([a for _, a, _ in held]), np.concatenate([t for _, _, t in held]))
                np.add.at(sums, owner, logs)

            for i, text in enumerate(texts_as_bytes(batch.column("text"))):
                words = words_of(text)
                tokens = tokens_of_words(words, known)
                n_tokens[i] = len(tokens)
                tails = Counter(filterfalse(vocab.__contains__, words))
                tail_words += tails
                times += tails.values()
                ends.append(len(times))
                around = contexts(tokens)
                for lo in range(0, len(tokens), SLICE):
                    held.append((i, around[lo:lo + SLICE], tokens[lo:lo + SLICE]))
                    size += len(held[-1][2])
                    if size >= SLICE:
                        flush()
                        held, size = [], 0
            if held:
                flush()
            tails = pa.StructArray.from_arrays(
                [pa.array(tail_words, pa.binary()), pa.array(tokens_of_words(tail_words, known) - (VOCABULARY - TAILS)),
                 pa.array(times, pa.int64())], names=["word", "tail", "times"])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(n_tokens), pa.array(sums),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tails)], names=names)

    net_name, tails_name, row, shares = (free_name(docs, c) for c in ("_net", "_tails", "_row", "_shares"))
    names = [*keep, "n_tokens", net_name, tails_name]
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("n_tokens", T.LongType()),
                           T.StructField(net_name, T.DoubleType()),
                           T.StructField(tails_name, T.ArrayType(T.StructType([
                               T.StructField("word", T.BinaryType()), T.StructField("tail", T.IntegerType()),
                               T.StructField("times", T.LongType())])))])
    # An id of the row, written once: repeated rows and null ids stay apart.
    rows = stored(docs.mapInArrow(emit, schema).withColumn(row, F.monotonically_increasing_id()), "scored")
    totals = F.array(*[F.lit(float(np.log(max(1, n)))) for n in tail_totals(counts, vocab)])
    # Shares as whole nanonats: their sum does not depend on the order of tasks.
    share = F.round((F.log(F.coalesce("n", F.lit(1)).cast("double")) - F.get(totals, F.col("tail"))) * 1e9).cast("long")
    tails = (rows.select(F.col(row).alias("at"), F.inline(tails_name)).join(counts.select("word", "n"), "word", "left")
             .groupBy("at").agg(F.sum(F.col("times") * share).alias("shares")).select(
                 F.col("at").alias(row), F.col("shares").alias(shares)))
    pll = F.col(net_name) + F.coalesce(shares, F.lit(0)) / 1e9
    return rows.drop(tails_name).join(tails, row, "left").select(*keep, "n_tokens", pll.alias("pll"))


def query(docs: DataFrame) -> DataFrame:
    """Pseudo-log-likelihood of every document, in total and per token."""
    counts = word_counts(docs)
    vocab, net = train(docs.select("text"), counts=counts)
    return score(docs.select("doc_id", "text"), vocab, net, counts, ["doc_id"]).select(
        "doc_id", "n_tokens", F.round("pll", 3).alias("pll"),
        F.round(F.when(F.col("n_tokens") > 0, F.col("pll") / F.col("n_tokens")), 5).alias("pll_per_token"))
