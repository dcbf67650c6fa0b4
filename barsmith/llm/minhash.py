"""Near duplicates by fast similarity sketching, banding and exact verification.

A document is its set of distinct 2-word shingles; two link when
100 * |intersection| >= PERCENT * |union|.

1. *Sketch.* ``BINS`` coordinates. In round i every shingle is hashed to a bin and
   a value; a bin keeps the smallest (round, value) it ever got. The rounds of a
   set end once all its bins are filled: large sets need one, and from round
   ``BINS`` on, round i puts all shingles into bin i - ``BINS``, so that even
   a set of one shingle is done after twice ``BINS`` rounds. Two sets agree in a
   coordinate with a probability of their Jaccard similarity, and the number of
   agreements is concentrated as for independent coordinates.
2. *Collapse.* Equal sets become one class, by a map-side combined aggregate.
3. *Banding.* ``ROWS`` coordinates each make one of ``BANDS`` keys. A pair at the
   limit misses all keys with a probability of (1 - 0.8^5)^48 = 5e-9. Keys that
   one class holds alone are dropped.
4. *Candidates.* First a star: a key names as centre its class of smallest rank
   (a combinable aggregate), and a class takes one partner, the centre of smallest rank of
   all its keys: at most one pair a class, however crowded its keys. What shares
   a key but lies in two components after that is looked through in blocks of
   bounded size, those outside a key's largest component against its others, each pair
   under the first key that it shares (told by 32 bits of a key). Parity bitmaps
   (a lower bound of the symmetric difference, near exact with ``SHINGLE_BITS`` bits
   a shingle) and sizes rule out what can't link. In the first such round a class
   names only its nearest partner in a block, which joins most of what belongs
   together; in the last one all pairs left in two components are named.
5. *Verification.* Every pair is settled by the intersection of its
   full sets, made again from the texts of the classes that share a key.
6. Links become components by star contraction.

No pair is given up by a cap: pairs inside one component, which can't change the
result, are the only ones left out. Shingles are compared by 64-bit hash.

Defined results: a text without words (null, empty, blank) has no shingles and is its
own component; one word is one shingle; every row is a document of its own, also
where a doc_id repeats; a null doc_id takes part, but names a component only if
none of it has an id (then null); ``kept`` is true where doc_id equals component_id, null
ones included; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, texts_as_bytes
from .components import connected_components
from .mph import mix
from .shingles import max_difference, shingle_set

PERCENT = 80
WIDTH = 2
ROWS = 5
BANDS = 48
BINS = ROWS * BANDS
#: Bits of a parity bitmap for a shingle, at least; up to twice as many.
SHINGLE_BITS = 8
#: Expected rows of a side of a block of pairs.
BLOCK = 1024
#: Ids (8 bytes each) up to which an id table is broadcast.
BROADCAST_IDS = 1 << 20

_EMPTY = np.uint64(2**64 - 1)


def sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` coordinates, (round << 32 | value), for every set of hashes."""
    out = np.full((len(sets), bins), _EMPTY)
    flat_out = out.reshape(-1)
    sizes = np.array([len(s) for s in sets], np.int64)
    hashes = np.concatenate([np.empty(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    low = np.uint64(0xFFFFFFFF)
    for i in range(2 * bins):
        if not len(hashes):
            break
        spread = mix(hashes, i)
        if i < bins:
            at = (((spread >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
        else:
            at = i - bins
        np.minimum.at(flat_out, owner * bins + at, (spread & low) | np.uint64(i << 32))
        open_ = (out == _EMPTY).any(axis=1) if i == 0 else _still_open(out, owner)
        left = open_[owner]
        hashes, owner = hashes[left], owner[left]
    return out


def _still_open(out: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Mask of the sets that have an empty bin, among those of ``owner``."""
    mask = np.zeros(len(out), bool)
    now = owner[np.r_[True, owner[1:] != owner[:-1]]]
    mask[now] = (out[now] == _EMPTY).any(axis=1)
    return mask


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key of every ``rows`` coordinates, told apart by their band."""
    bands = sketch.reshape(len(sketch), -1, rows)
    out = mix(np.broadcast_to(np.arange(bands.shape[1], dtype=np.uint64), bands.shape[:2]), 1)
    for i in range(rows):
        out = mix(out ^ bands[:, :, i], 2)
    return out


def _binary(rows) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _digests(sets: list[np.ndarray]) -> list[pa.Array]:
    """128 bits of every set, as two columns."""
    out = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
    return [pa.array(out[:, 0]), pa.array(out[:, 1])]


def bitmap(hashes: np.ndarray) -> bytes:
    """Bit i is the parity of the shingles whose hash is i modulo the length, a power of two.

    Sets that differ in d shingles differ in at most d bits.
    """
    m = max(64, 1 << int(SHINGLE_BITS * len(hashes) - 1).bit_length())
    at = (mix(hashes, 7) & np.uint64(m - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=m) & 1).astype(np.uint8), bitorder="little").tobytes()


def sketched(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(row, doc, n, s1, s2, keys) of every row: set size, set hash, band keys."""
    def emit(batches):
        for batch in batches:
            sets = [shingle_set(t, width) for t in texts_as_bytes(batch.column("text"))]
            keys = band_keys(sketches(sets))
            ends = np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int32()), *_digests(sets),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64)))],
                names=["doc", "n", "s1", "s2", "keys"])
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(
        emit, f"doc {id_type}, n int, s1 long, s2 long, keys array<long>")
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "sketched")


def _small(ids: DataFrame) -> DataFrame:
    """A written id table, broadcast if a count proves it small; a shuffle join beyond that."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def full_sets(docs: DataFrame, classes: DataFrame, width: int = WIDTH) -> DataFrame:
    """(g, shingles, bits) of ``classes`` (g, doc, s1, s2): made from texts of their document, told by the set's hash."""
    wanted = _small(stored(classes.select("doc").distinct(), "wanted"))
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("doc")), "left_semi")

    def emit(batches):
        for batch in batches:
            sets = [shingle_set(t, width) for t in texts_as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*_digests(sets), _binary(sets), pa.array([bitmap(s) for s in sets], pa.binary())],
                names=["s1", "s2", "shingles", "bits"])

    found = (texts.mapInArrow(emit, "s1 long, s2 long, shingles binary, bits binary")
             .join(classes.select("g", "s1", "s2"), ["s1", "s2"]))
    return stored(found.groupBy("g").agg(F.first("shingles").alias("shingles"), F.first("bits").alias("bits")), "full-sets")


def _sizes_fit(a: str, b: str, percent: int) -> str:
    return f"100L * least({a}, {b}) >= {percent}L * greatest({a}, {b})"


def _labelled(live: DataFrame, links: DataFrame) -> DataFrame:
    """The classes of the shared keys with their component so far as ``c``."""
    comp = connected_components(links).select(F.col("node").alias("g"), F.col("component").alias("c"))
    return live.join(comp, "g", "left").withColumn("c", F.coalesce("c", "g"))


def star_pairs(centred: DataFrame, percent: int) -> DataFrame:
    """At most one pair (a, b) a class of (key, g, n, centre): with the centre of smallest rank of its keys."""
    offers = centred.where(f"g != centre.g and {_sizes_fit('n', 'centre.n', percent)}")
    best = offers.groupBy("g").agg(F.min(F.struct("centre.rank", "centre.g")).alias("best"))
    return best.select(F.least("g", "best.g").alias("a"), F.greatest("g", "best.g").alias("b")).distinct()


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Parity bitmaps (one a row) folded to ``words`` 64-bit words."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, words), axis=1)


def _near_in_block(run: pa.Table, percent: int, nearest: bool):
    """Pairs of a block's left and right rows in different components that sizes and bitmaps allow.

    Only those of which the block's key is the first that they share; with
    ``nearest`` a left row's closest only.
    """
    g, n, c = (run.column(x).to_numpy() for x in ("g", "n", "c"))
    n = n.astype(np.int64)
    marks = run.column("marks").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(g), -1)
    here = run.column("key")[0].as_py() >> 32
    bits = run.column("bits").to_pylist()
    words = np.array([len(b) // 8 for b in bits])
    right = np.flatnonzero(run.column("right").to_numpy(zero_copy_only=False))
    groups = {int(w): right[words[right] == w] for w in np.unique(words[right])}
    held = {w: np.frombuffer(b"".join(bits[i] for i in at), np.uint64).reshape(-1, w) for w, at in groups.items()}
    folded: dict[tuple[int, int], np.ndarray] = {}
    for x in np.flatnonzero(run.column("left").to_numpy(zero_copy_only=False)):
        own = np.frombuffer(bits[x], np.uint64).reshape(1, -1)
        found, distances = [], []
        for w, at in groups.items():
            to = min(w, own.shape[1])
            ok = (c[at] != c[x]) & (100 * np.minimum(n[at], n[x]) >= percent * np.maximum(n[at], n[x]))
            if not ok.any():
                continue
            if (w, to) not in folded:
                folded[w, to] = _folded(held[w], to)
            y = at[ok]
            apart = np.bitwise_count(folded[w, to][ok] ^ _folded(own, to)).sum(axis=1, dtype=np.int64)
            fit = apart <= max_difference(n[x], n[y], percent)
            y, apart = y[fit], apart[fit]
            first = marks[x][(marks[y] == marks[x]).argmax(axis=1)] == here
            found.append(y[first])
            distances.append(apart[first])
        if sum(map(len, found)):
            y = np.concatenate(found)
            if nearest:
                y = y[[int(np.argmin(np.concatenate(distances)))]]
            yield np.stack([np.minimum(g[x], g[y]), np.maximum(g[x], g[y])])


def block_pairs(labelled: DataFrame, bits: DataFrame, percent: int, block: int = BLOCK,
                nearest: bool = False) -> DataFrame:
    """Pairs (a, b) of one key and two components whose sizes and bitmaps allow a link, or the nearest ones.

    ``bits`` has (g, bits, marks) of every class: bitmap, and the upper half of all its keys.

    A key's classes outside its largest component are cut into blocks by hash, and
    those inside as well; a task gets one block of the former and one of either.
    """
    parts = labelled.groupBy("key", "c").agg(F.count(F.lit(1)).alias("members"))
    cuts = (parts.groupBy("key").agg(
        F.max(F.struct("members", "c")).alias("top"), F.sum("members").alias("all"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select("key", F.col("top.c").alias("main"),
                F.ceil(F.col("top.members") / block).cast("int").alias("main_blocks"),
                F.ceil((F.col("all") - F.col("top.members")) / block).cast("int").alias("blocks")))
    rows = (labelled.join(cuts, "key").join(bits, "g")
            .withColumn("inside", F.expr("c = main"))
            .withColumn("own", F.expr("if(inside, blocks + pmod(xxhash64(g), main_blocks), pmod(xxhash64(g), blocks))"))
            # Blocks (i, j), i of those outside, j from i on: a row stands left, right or both.
            .withColumn("cell", F.explode(F.expr(
                "concat(transform(sequence(0, if(inside, blocks, cast(own as int) + 1) - 1), "
                "         i -> named_struct('i', i, 'j', cast(own as int))),"
                " filter(transform(sequence(0, blocks + main_blocks - 1), "
                "         j -> named_struct('i', cast(own as int), 'j', j)), x -> not inside and x.j > x.i))")))
            .select("key", "cell.i", "cell.j", F.expr("own = cell.i").alias("left"), F.expr("own = cell.j").alias("right"),
                    "g", "n", "c", "bits", "marks"))
    cell = ["key", "i", "j"]
    dealt = rows.repartition(*cell).sortWithinPartitions(*cell)

    def emit(run: pa.Table):
        found = list(_near_in_block(run, percent, nearest))
        if found:
            both = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

    def scan(batches):
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            ids = np.stack([held.column(x).to_numpy() for x in cell])
            new = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *new[:-1]], new):
                yield from emit(held.slice(lo, hi - lo))
            held = held.slice(new[-1]) if len(new) else held
        if held is not None and held.num_rows:
            yield from emit(held)

    return dealt.mapInArrow(scan, "a long, b long").distinct()


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by the exact intersection of their sets."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("g")).distinct()
    sets = sets.join(_small(stored(ids, "pair-ids")), "g", "left_semi")
    both = (pairs.join(sets.select(F.col("g").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("g").alias("b"), F.col("shingles").alias("y")), "b"))

    def emit(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return both.select("a", "b", "x", "y").mapInArrow(emit, "a long, b long")


def link(docs: DataFrame, rows: DataFrame, classes: DataFrame, percent: int = PERCENT, width: int = WIDTH,
         block: int = BLOCK) -> DataFrame:
    """Verified links (a, b) between classes, enough of them for all components."""
    heads = rows.join(classes.select(F.col("g").alias("row")), "row", "left_semi")
    postings = heads.select(F.explode("keys").alias("key"), F.col("row").alias("g"), "n")
    centre = F.struct(F.xxhash64("g").alias("rank"), "g", "n")
    shared = (postings.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min(centre).alias("centre"))
              .where("m > 1").drop("m"))
    live = stored(postings.join(shared, "key"), "shared-keys")
    alive = _small(stored(live.select("g").distinct(), "alive"))
    sets = full_sets(docs, classes.select("g", F.col("least").alias("doc"), "s1", "s2").join(alive, "g", "left_semi"), width)
    marks = rows.select(F.col("row").alias("g"), F.transform("keys", lambda k: F.shiftright(k, 32).cast("int")).alias("marks"))
    bits = stored(sets.select("g", "bits").join(marks.join(alive, "g", "left_semi"), "g"), "bits")

    tested = stored(star_pairs(live, percent), "star-pairs")
    links = stored(verify(tested, sets, percent), "links")
    for nearest in (True, False):
        more = block_pairs(_labelled(live.drop("centre"), links), bits, percent, block, nearest)
        more = stored(more.join(tested, ["a", "b"], "left_anti"), "block-pairs")
        links = stored(links.unionByName(verify(more, sets, percent)), "links")
        tested = tested.unionByName(more)
    return links


def near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    rows = sketched(docs, width)
    same_set = ["n", "s1", "s2"]
    classes = stored(rows.where("n > 0").groupBy(*same_set).agg(
        F.min("row").alias("g"), F.min("doc").alias("least")), "classes")
    comp = connected_components(link(docs, rows, classes, percent, width, block))
    placed = classes.join(comp.withColumnRenamed("node", "g"), "g", "left").withColumn(
        "component", F.coalesce("component", "g"))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(placed.select(*same_set, "component").join(names, "component").drop("component"), "named")
    out = rows.select("doc", *same_set).join(named, same_set, "left")
    return out.select(
        F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def query(docs: DataFrame) -> DataFrame:
    """Component of every document with production parameters."""
    return near_duplicates(docs)


QUERY_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM split, LATERAL (SELECT unnest(range(1, greatest(len(w), 2))) AS i) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id != b.doc_id GROUP BY ALL),
linked AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * o >= 80 * (x.n + y.n - o)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM split
  UNION
  SELECT reach.a, linked.b FROM reach JOIN linked ON linked.a = reach.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM split LEFT JOIN size USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""
