"""BPE encoding and decoding with a memory-mapped transducer lexicon.

Texts are normalised and cut into words as the vocabulary file's tokenizer
does; every word is one lookup.

1. Spark counts the words of the whole corpus (map-side combined) and keeps
   the ``lexicon_words`` most frequent ones, the documented size of the lexicon.
2. In one task, their encodings become a *minimal acyclic transducer*: a deterministic
   automaton over the words' bytes in which equal suffixes are one state and
   every arc carries the longest token ids that all words through it share. It
   is flat arrays in one file, in the application's shared scratch folder.
3. Spark hands the file to every executor (``SparkContext.addFile``); the
   Python workers of an executor map the same pages.
4. Documents are encoded where they lie. A word is followed through the
   transducer; one it does not accept is merged exactly, lowest rank first.
   A worker remembers words in a bounded table.

Decoding is the library's without a decoder section: the tokens' strings
joined by one space.

Defined results: null is the empty text, which has no tokens and decodes to
the empty text; special tokens' strings in a text are ordinary text only as
far as the library takes them so (their ids are produced, as it does);
repeated rows are encoded alike; an empty table gives an empty result. Other
columns are passed through; ``ids`` and ``decoded`` of the input are replaced.
"""

from __future__ import annotations

import json
import mmap
import re
import unicodedata
import uuid
from collections import Counter
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, normalizers

from ..session import scratch_path

#: Words the lexicon holds (documented size: some MB mapped per executor).
LEXICON_WORDS = 50_000
#: Words a worker remembers, or counts, before it starts afresh.
REMEMBERED = 300_000
#: Below this code point nothing is changed by NFC, and letters, digits and lower
#: case are the same in every Unicode version: the fast path of cutting.
PLAIN = 0x180
#: Unicode white space.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
END = "</w>"
#: Token ids and merge ranks fit these bits.
ID_BITS = 24
ID_MASK = (1 << ID_BITS) - 1
NEVER = 1 << 62
#: Bytes of a word from which it is merged over a heap.
LONG_WORD = 100


def byte_chars() -> dict[int, str]:
    """The printable character that stands for every byte in byte-level vocabularies."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _plain_class(kind: str) -> str:
    """The characters below ``PLAIN`` of a general category, as a regular expression class body."""
    return "".join(re.escape(chr(c)) for c in range(PLAIN) if unicodedata.category(chr(c))[0] == kind)


class Vocabulary:
    """Ids, merge ranks and text cutting of a word-level BPE file (JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        self.ids: dict[str, int] = spec["model"]["vocab"]
        # (left id, right id) in one number -> (rank, merged id) in one number.
        self.merges = {self.ids[a] << ID_BITS | self.ids[b]: i << ID_BITS | self.ids[a + b]
                       for i, (a, b) in enumerate(map(_pair, spec["model"]["merges"]))}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: t for t, i in (self.ids | self.special).items()}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", SPACE)
        self.cut = regex.compile(split).findall
        plain = split
        for kind in "LN":
            plain = plain.replace(rf"[\p{{{kind}}}]", rf"\p{{{kind}}}").replace(
                rf"[^{SPACE}\p{{L}}\p{{N}}]", "OTHER").replace(rf"\p{{{kind}}}", f"[{_plain_class(kind)}]")
        plain = plain.replace("OTHER", f"[^{SPACE}{_plain_class('L')}{_plain_class('N')}]")
        self.cut_plain = re.compile(plain).findall
        self.beyond_plain = re.compile(f"[{chr(PLAIN)}-\U0010ffff]").search
        self.around_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        # The file's own normalizer section, run by the library (Unicode tables differ by version).
        steps = {"NFC": lambda s: normalizers.NFC(), "Lowercase": lambda s: normalizers.Lowercase(),
                 "Replace": lambda s: normalizers.Replace(Regex(s["pattern"]["Regex"]), s["content"])}
        self.normal = normalizers.Sequence(
            [steps[s["type"]](s) for s in spec["normalizer"]["normalizers"]]).normalize_str
        chars = byte_chars()
        self.inner = [self.ids[chars[b]] for b in range(256)]
        self.last = [self.ids[chars[b] + END] for b in range(256)]

    def _cut(self, text: str) -> list[str]:
        if self.beyond_plain(text):
            return self.cut(self.normal(text))
        # Turning white space into blanks changes no cut: neither is part of a word.
        return self.cut_plain(text.lower())

    def words(self, text: str) -> list[str]:
        """The words of a text; a special token's string is a word of its own, unchanged."""
        if "<|" not in text:
            return self._cut(text)
        out = []
        for part in self.around_special(text):
            if part in self.special:
                out.append(part)
            elif part:
                out.extend(self._cut(part))
        return out

    def merge(self, word: str) -> list[int]:
        """Token ids of one word by exact merging, lowest rank first, leftmost first."""
        if word in self.special:
            return [self.special[word]]
        data = word.encode("utf-8")
        ids = [self.inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        get, never = self.merges.get, NEVER
        ranks = [get(a << ID_BITS | b, never) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            i = ranks.index(best)
            ids[i:i + 2] = [best & ID_MASK]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << ID_BITS | ids[i], never)
            if i < len(ranks):
                ranks[i] = get(ids[i] << ID_BITS | ids[i + 1], never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges in n log n: a heap of (rank, position) over a linked list."""
        n, get = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(v, i) for i in range(n - 1) if (v := get(ids[i] << ID_BITS | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            v, i = heappop(heap)
            j = after[i]
            if j >= n or ids[i] < 0 or get(ids[i] << ID_BITS | ids[j]) != v:
                continue  # one side was merged since
            ids[i], ids[j] = v & ID_MASK, -1
            after[i] = j = after[j]
            if j < n:
                before[j] = i
            for left, right in ((before[i], i), (i, j)):
                if left >= 0 and right < n and (v := get(ids[left] << ID_BITS | ids[right])) is not None:
                    heappush(heap, (v, left))
        return [x for x in ids if x >= 0]


def _pair(merge: str | list[str]) -> tuple[str, str]:
    """A merge of the file, which is a list of two strings or both with a blank between."""
    left, right = merge.split(" ") if isinstance(merge, str) else merge
    return left, right


def _common(a: tuple, b: tuple) -> int:
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    return n


class Transducer:
    """Words to token ids: arcs sorted by state, one output range per arc.

    ``first[s] .. first[s+1]`` are the arcs of state s, ordered by label; arc i
    goes to ``target[i]`` on byte ``label[i]`` and puts out
    ``out[out_at[i] : out_at[i+1]]``. A final state adds
    ``out[end_at[s] : end_at[s+1]]``; ``final[s]`` tells that a word may end there.
    """

    ARRAYS = ("first", "label", "target", "out_at", "final", "end_at", "out")

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, entries: dict[bytes, tuple[int, ...]]) -> Transducer:
        """Incremental construction from sorted words; states are shared by what follows them."""
        register: dict[tuple, int] = {}
        frozen: list[tuple] = []  # (final, end output, arcs (label, output, target))

        def freeze(state) -> int:
            final, end, arcs = state
            key = (final, end, tuple((c, tuple(o), t) for c, o, t in arcs))
            if key not in register:
                register[key] = len(frozen)
                frozen.append(key)
            return register[key]

        # A path of unfrozen states: each [final, end output, arcs]; the last arc
        # of a path state leads to the next path state (target None until frozen).
        path = [[False, (), []]]
        previous = b""
        for word in sorted(entries):
            output, shared = entries[word], _common(previous, word)
            while len(path) > shared + 1:
                child = freeze(path.pop())
                path[-1][2][-1][2] = child
            # Outputs on the shared path are cut back to what the new word shares.
            for depth in range(shared):
                arc = path[depth][2][-1]
                keep = _common(arc[1], output)
                rest, arc[1] = arc[1][keep:], arc[1][:keep]
                if rest:
                    child = path[depth + 1]
                    for a in child[2]:
                        a[1] = rest + a[1]
                    if child[0]:
                        child[1] = rest + child[1]
                output = output[keep:]
            for depth in range(shared, len(word)):
                path[depth][2].append([word[depth], output if depth == shared else (), None])
                path.append([False, (), []])
            path[-1][0] = True
            if shared == len(word):
                path[-1][1] = output
            previous = word
        while len(path) > 1:
            child = freeze(path.pop())
            path[-1][2][-1][2] = child
        root = freeze(path[0])
        return cls._flat(frozen, root)

    @classmethod
    def _flat(cls, frozen: list[tuple], root: int) -> Transducer:
        order = [root] + [s for s in range(len(frozen)) if s != root]
        number = {s: i for i, s in enumerate(order)}
        first, label, target, out_at, final, end_at, out = [0], [], [], [0], [], [], []
        ends = []
        for s in order:
            is_final, end, arcs = frozen[s]
            for c, o, t in arcs:
                label.append(c)
                target.append(number[t])
                out.extend(o)
                out_at.append(len(out))
            first.append(len(label))
            final.append(is_final)
            ends.append(end)
        end_at.append(len(out))
        for end in ends:
            out.extend(end)
            end_at.append(len(out))
        return cls(first=np.array(first, np.int32), label=np.array(label, np.uint8),
                   target=np.array(target, np.int32), out_at=np.array(out_at, np.int32),
                   final=np.array(final, np.uint8), end_at=np.array(end_at, np.int32),
                   out=np.array(out, np.int32))

    def to_bytes(self) -> bytes:
        """Header of array lengths, then the arrays, each at a multiple of 8 bytes."""
        arrays = [getattr(self, k) for k in self.ARRAYS]
        parts = [np.array([len(a) for a in arrays], np.int64).tobytes()]
        parts += [a.tobytes() + bytes(-a.nbytes % 8) for a in arrays]
        return b"".join(parts)


class MappedTransducer:
    """A transducer file mapped into memory; lookups touch its pages, nothing is loaded."""

    SIZES = {"label": 1, "final": 1}

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        whole = memoryview(self.data)
        at = 8 * len(Transducer.ARRAYS)
        for name, n in zip(Transducer.ARRAYS, whole[:at].cast("q")):
            size = n * self.SIZES.get(name, 4)
            setattr(self, name, whole[at:at + size].cast("B" if name in self.SIZES else "i"))
            if name == "label":
                self.labels_at = at
            at += size + -size % 8

    def lookup(self, word: bytes) -> list[int] | None:
        """Token ids of a word of the lexicon, None for any other."""
        state, arcs, base = 0, [], self.labels_at
        first, target, find = self.first, self.target, self.data.find
        for i in range(len(word)):
            arc = find(word[i:i + 1], base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return None
            arcs.append(arc)
            state = target[arc]
        if not self.final[state]:
            return None
        ids, out_at, out = [], self.out_at, self.out
        for arc in arcs:
            if out_at[arc + 1] > out_at[arc]:
                ids += out[out_at[arc]:out_at[arc + 1]].tolist()
        return ids + out[self.end_at[state]:self.end_at[state + 1]].tolist()


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=1)
def _mapped(path: str) -> MappedTransducer:
    return MappedTransducer(path)


def frequent_words(docs: DataFrame, vocab_path: str, limit: int = LEXICON_WORDS) -> DataFrame:
    """(word, n) of the ``limit`` most frequent words over all documents."""
    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"])

    def emit(batches):
        vocab, counts = vocabulary(vocab_path), Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(vocab.words(text or ""))
                if len(counts) > REMEMBERED:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    return (docs.select("text").mapInArrow(emit, "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(limit))


def build_lexicon(docs: DataFrame, vocab_path: str, limit: int = LEXICON_WORDS) -> str:
    """Compile the lexicon of a corpus, add it to the application's files, return its name.

    One task compiles the ``limit`` words; the driver only sees the file's bytes.
    """
    def compile_words(batches):
        vocab = vocabulary(vocab_path)
        words = [w for batch in batches for w in batch.column("word").to_pylist() if w not in vocab.special]
        data = Transducer.build({w.encode(): tuple(vocab.merge(w)) for w in words}).to_bytes()
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["lexicon"])

    words = frequent_words(docs, vocab_path, limit).select("word").coalesce(1)
    built = words.mapInArrow(compile_words, "lexicon binary").first()
    return _publish(docs.sparkSession, bytes(built["lexicon"]) if built else Transducer.build({}).to_bytes())


def _publish(spark: SparkSession, data: bytes) -> str:
    """Write a file to the shared scratch folder and have Spark bring it to every executor."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'llm')}/{name}")
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(hadoop)
    out.write(data)
    out.close()
    spark.sparkContext.addFile(fs.makeQualified(hadoop).toString())
    return name


@lru_cache(maxsize=1)
def _encoder(vocab_path: str, lexicon_path: str) -> Encoder:
    """A worker process keeps its encoder, and the words it remembers, from task to task.

    Only the last one: the words of an earlier job's encoder would stay in memory for nothing.
    """
    return Encoder(vocabulary(vocab_path), _mapped(lexicon_path))


class _Decimals(dict):
    """Words to their ids in decimal; a new word is learnt when it is asked for."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> str:
        return self.learn(word)


class Encoder:
    """Encodes and decodes texts of one worker: lexicon first, exact merges for the rest.

    What a word gives is remembered, its ids as ``decimals`` and as their
    ``strings``. Words outside the lexicon are forgotten between two texts once
    there are ``REMEMBERED`` of them.
    """

    def __init__(self, vocab: Vocabulary, lexicon: MappedTransducer):
        self.vocab, self.lexicon = vocab, lexicon
        self.decimals, self.strings = _Decimals(self._learn), {}
        self.rare: list[str] = []

    def _learn(self, word: str) -> str:
        ids = None if word in self.vocab.special else self.lexicon.lookup(word.encode())
        if ids is None:
            ids = self.vocab.merge(word)
            self.rare.append(word)
        self.strings[word] = " ".join([self.vocab.strings[i] for i in ids])
        self.decimals[word] = decimals = " ".join(map(str, ids))
        return decimals

    def encode(self, text: str) -> tuple[str, str]:
        """The ids of a text in decimal and their strings, both joined by one space."""
        if len(self.rare) > REMEMBERED:
            for word in self.rare:
                del self.decimals[word], self.strings[word]
            self.rare.clear()
        words = self.vocab.words(text)
        decimals = " ".join(map(self.decimals.__getitem__, words))
        return decimals, " ".join(map(self.strings.__getitem__, words))


def _id_lists(decimals: list[str], counts: list[int]) -> pa.Array:
    """Lists of ids from their decimals; numbers only ever stand in one flat array."""
    flat = np.fromstring(" ".join(filter(None, decimals)), np.int32, sep=" ") if any(counts) else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, vocab_path: str, lexicon_words: int = LEXICON_WORDS,
           as_text: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (token ids) and ``decoded`` (their text).

    ``as_text`` gives the ids as decimals joined by one space instead of an array.
    """
    docs = docs.drop("ids", "decoded", "n_tokens")
    lexicon = build_lexicon(docs, vocab_path, lexicon_words)
    kind = T.StringType() if as_text else T.ArrayType(T.IntegerType())
    out = T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids", kind), T.StructField("decoded", T.StringType())])
    names = out.names

    def run(batches):
        encoder = _encoder(vocab_path, SparkFiles.get(lexicon))
        for batch in batches:
            coded = [encoder.encode(text or "") for text in batch.column("text").to_pylist()]
            counts = [d.count(" ") + 1 if d else 0 for d, _ in coded]
            ids = [d for d, _ in coded]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()),
                 pa.array(ids, pa.string()) if as_text else _id_lists(ids, counts),
                 pa.array([s for _, s in coded], pa.string())], names=names)

    return docs.mapInArrow(run, out)


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def query(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """The digest columns of :func:`encode` with production parameters."""
    coded = encode(docs.select("doc_id", "text"), vocab_path or default_vocabulary(), as_text=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
