"""N-gram Jaccard join by groups of equal prefixes.

Documents are sets of distinct 5-word shingles; two link when
100 * |intersection| >= percent * |union|. A set's *prefix* are its first
shingles in one global order, so many that linked sets share at least one. The
order is by hash, but shingles of popular passages come last: a heavy-hitter
count over all documents names at most ``STOP_SHINGLES`` of them. Any order
gives the same result; this one keeps passages out of the prefixes.

1. *Collapse.* Equal sets become one class (its smallest doc_id); classes of
   equal prefix and size become one group. Both are hash aggregates combined
   on the map side: thousands of copies are one row a task.
2. *Filter group pairs.* Prefix hashes are dealt out by hash; a hash's run
   streams past one task, sorted by set size.
   - A run of at most ``RUN`` groups gives its pairs of compatible size and
     prefix position.
   - A longer run is a shared passage or a cluster of copies. Its groups move
     to finer keys: the set is cut into parts by shingle hash, so many that
     linked sets cannot differ in all of them (see :func:`finer_keys`).
     Unrelated documents that share a passage share no part; clusters do.
   - A group of such runs pairs with one of their centres (a run's group of smallest
     rank): the one it meets in most runs. Then, links known, every group outside a
     run's largest component pairs with the nearest of another one, and last
     every pair of a run that is still in two
     components is given: a pair inside one component can't change the result.
   Pairs survive if the parity bitmaps of their sets (a lower bound of the
   symmetric difference, a few bits a shingle) allow a link.
3. *Expand and verify.* Surviving group pairs are expanded to their member
   classes; each pair is settled by the exact intersection of the two sets.
4. Links become components by star contraction; members get their class's.

No pair is dropped by a cap: a run's length only chooses how its pairs are
enumerated. Shingles are compared by 64-bit hash.

Defined results: without words (null, empty or blank text) a document has no
shingles and links with nothing; fewer than five words are one shingle;
rows of one doc_id are one node, linked by any of their texts; a null doc_id
takes part and, as smallest id, stands for its component as null; an empty
table gives an empty result. Only doc_id and text are read.
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
from .shingles import (SHINGLE_WORDS, max_difference, parity_bitmap, parity_distance,
                       part_signatures, prefix_length, shingle_set)

PERCENT = 80
#: Groups of a prefix hash up to which all its pairs are enumerated.
RUN = 64
#: Popular shingles (8 bytes each, broadcast) that the order puts last, at most.
STOP_SHINGLES = 1 << 19
#: Share of the hash space in which popular shingles are counted: prefixes rarely reach further.
COUNTED_SHARE = 0.5
#: Shingles a task gathers before it hands on those it saw repeatedly.
COUNT_CHUNK = 1 << 22
#: Ids (8 bytes each) up to which an id table is broadcast.
BROADCAST_IDS = 1 << 20
#: The id a null doc_id counts as.
NULL_ID = -(2**63)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    """An array<long> column from numpy arrays of hashes."""
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def popular_shingles(docs: DataFrame, width: int = SHINGLE_WORDS, run: int = RUN,
                     limit: int = STOP_SHINGLES) -> np.ndarray:
    """At most ``limit`` hashes of the shingles held by over ``run // 4`` documents, ascending.

    A lossy count over all documents: a task hands on what it saw at least
    twice in a chunk, which loses at most one document a chunk and shingle.
    Only the order of shingles depends on it, never the result.
    """
    top = np.uint64(int(COUNTED_SHARE * 2**64))

    def emit(batches):
        held, size = [], 0

        def flush():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            again = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(values[again].view(np.int64)), pa.array(counts[again])], names=["h", "n"])

        for batch in batches:
            for text in texts_as_bytes(batch.column("text")):
                own = shingle_set(text, width)
                held.append(own[:np.searchsorted(own, top)])
                size += len(held[-1])
            if size > COUNT_CHUNK:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    counted = docs.select("text").mapInArrow(emit, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") > run // 4).orderBy(F.desc("n"), "h").limit(limit).select("h").toPandas()
    return np.sort(rows["h"].to_numpy(dtype=np.int64).view(np.uint64))


def in_order(own: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A set's shingles in the global order: by hash, the popular ones last."""
    if not len(stop) or not len(own):
        return own
    late = stop[np.minimum(np.searchsorted(stop, own), len(stop) - 1)] == own
    return np.concatenate([own[~late], own[late]])


def shingle_rows(docs: DataFrame, stop: np.ndarray, percent: int = PERCENT,
                 width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc, n, s1, s2, p, prefix, bits) per row: size, set hash, prefix hash, prefix, parity bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(stop)

    def emit(batches):
        for batch in batches:
            sets = [shingle_set(t, width) for t in texts_as_bytes(batch.column("text"))]
            prefixes = [in_order(s, shared.value)[:prefix_length(len(s), percent)] for s in sets]
            digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets),
                                    np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([
                pa.array(_ids(batch.column("doc_id"))),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                pa.array(np.array([xxhash.xxh3_64_intdigest(p.tobytes()) for p in prefixes],
                                  np.uint64).view(np.int64)),
                _lists(prefixes),
                pa.array([parity_bitmap(s) for s in sets], pa.binary())],
                names=["doc", "n", "s1", "s2", "p", "prefix", "bits"])
    return docs.select("doc_id", "text").mapInArrow(
        emit, "doc long, n int, s1 long, s2 long, p long, prefix array<long>, bits binary")


def _runs(rows: DataFrame, emit_run, schema: str) -> DataFrame:
    """Deal (key, n, g, ...) out by key and stream every key's rows, sorted by n and g, past a task."""
    dealt = rows.repartition("key").sortWithinPartitions("key", "n", "g")
    columns = rows.columns

    def scan(batches):
        held = None
        for batch in batches:
            now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in columns}
            if held is not None:
                now = {c: np.concatenate([held[c], now[c]]) for c in columns}
            keys = now["key"]
            last = np.searchsorted(keys, keys[-1]) if len(keys) else 0  # the last run may go on
            yield from emit_run({c: v[:last] for c, v in now.items()})
            held = {c: v[last:] for c, v in now.items()}
        if held is not None:
            yield from emit_run(held)

    return dealt.mapInArrow(scan, schema)


def _spans(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and length of every run of at least two equal keys."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    length = np.diff(np.r_[first, len(keys)])
    return first[length > 1], length[length > 1]


def _pairs_of(length: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(length, 1)


_PAIRS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _short_run_pairs(run, percent: int, limit: int):
    """Pairs (a, b) of the runs up to ``limit`` whose sizes and positions can link."""
    first, length = _spans(run["key"])
    out_a, out_b = [], []
    for size in np.unique(length[length <= limit]):
        i, j = _PAIRS.setdefault(int(size), _pairs_of(int(size)))
        starts = first[length == size][:, None]
        out_a.append((starts + i).ravel())
        out_b.append((starts + j).ravel())
    if not out_a:
        return
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    size, at = run["n"] >> 32, run["n"] & 0xFFFFFFFF
    n1, n2 = size[a], size[b]
    need = -(-(percent * (n1 + n2)) // (100 + percent))
    most = np.minimum(at[a], at[b]) + np.minimum(n1 - at[a], n2 - at[b])
    ok = (100 * n1 >= percent * n2) & (most >= need) & (run["g"][a] != run["g"][b])
    if ok.any():
        yield _pair_batch(run["g"][a[ok]], run["g"][b[ok]])


def _long_run_groups(run, limit: int):
    """(g, null) of the groups in runs over ``limit``."""
    first, length = _spans(run["key"])
    at = [np.arange(lo, lo + size) for lo, size in zip(first, length) if size > limit]
    if at:
        g = np.unique(run["g"][np.concatenate(at)])
        yield pa.RecordBatch.from_arrays([pa.array(g), pa.nulls(len(g), pa.int64())], names=["a", "b"])


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def star_pairs(runs: DataFrame, percent: int, turn: int) -> DataFrame:
    """At most one pair (a, b) a group of the runs (key, n, g, c), c being its component so far.

    A key names as centre its group of smallest rank, by a combinable
    aggregate; of its keys' centres of a compatible size and another component, a
    group takes the one it meets under most keys. Every turn ranks anew.
    """
    centre = F.min(F.struct(F.xxhash64("g", F.lit(turn)).alias("rank"), "g", "n", "c")).alias("centre")
    met = (runs.join(runs.groupBy("key").agg(centre), "key")
           .where(f"c != centre.c and 100 * least(n, centre.n) >= {percent} * greatest(n, centre.n)")
           .groupBy("g", F.col("centre.g").alias("o"), F.col("centre.rank").alias("rank")).agg(F.count(F.lit(1)).alias("keys")))
    best = met.groupBy("g").agg(F.max(F.struct("keys", "rank", "o")).alias("best"))
    return best.select(F.least("g", "best.o").alias("a"), F.greatest("g", "best.o").alias("b")).distinct()


def _folded(bitmaps: np.ndarray) -> np.ndarray:
    """Parity bitmaps of a run as rows of equal length: the longer ones folded."""
    words = min(map(len, bitmaps)) // 8
    rows = []
    for b in bitmaps:
        x = np.frombuffer(b, np.uint64).reshape(-1, words)
        rows.append(np.bitwise_xor.reduce(x, axis=0))
    return np.stack(rows)


def _cross_pairs(run, percent: int):
    """Pairs of a run in different components whose sizes and parity bitmaps allow a link."""
    first, length = _spans(run["key"])
    for lo, size in zip(first, length):
        c = run["c"][lo:lo + size]
        if (c == c[0]).all():
            continue
        g, n = run["g"][lo:lo + size], run["n"][lo:lo + size].astype(np.int64)
        bits = _folded(run["bits"][lo:lo + size])
        out_a, out_b = [], []
        for i in range(size - 1):  # sizes ascend: the partners of i end where they grow too large
            hi = np.searchsorted(n, 100 * n[i] // percent, side="right")
            j = np.arange(i + 1, hi)
            j = j[c[j] != c[i]]
            apart = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
            j = j[apart <= max_difference(n[i], n[j], percent)]
            out_a.append(np.full(len(j), g[i]))
            out_b.append(g[j])
        if out_a and sum(map(len, out_a)):
            yield _pair_batch(np.concatenate(out_a), np.concatenate(out_b))


def _nearest_pairs(run, percent: int):
    """Of every group outside its run's largest component the pair with the nearest group of another one.

    Sizes and parity bitmaps have to allow the link.
    """
    first, length = _spans(run["key"])
    for lo, size in zip(first, length):
        names, at, members = np.unique(run["c"][lo:lo + size], return_inverse=True, return_counts=True)
        if len(names) == 1:
            continue
        g, n = run["g"][lo:lo + size], run["n"][lo:lo + size].astype(np.int64)
        bits = _folded(run["bits"][lo:lo + size])
        out_a, out_b = [], []
        for i in np.flatnonzero(at != np.argmax(members)):
            j = np.flatnonzero((at != at[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])))
            apart = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
            fit = apart <= max_difference(n[i], n[j], percent)
            if fit.any():
                out_a.append(g[i])
                out_b.append(g[j[fit][np.argmin(apart[fit])]])
        if out_a:
            yield _pair_batch(np.array(out_a), np.array(out_b))


def size_level(n: int, percent: int) -> int:
    """Number of the size class of ``n``; linked sets lie in one class or in two neighbouring ones."""
    level, top = 0, 1
    while n > top:
        level, top = level + 1, 100 * top // percent + 1
    return level


def level_top(level: int, percent: int) -> int:
    """The largest size of a size class."""
    top = 1
    for _ in range(level):
        top = 100 * top // percent + 1
    return top


def finer_keys(own: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set of which linked sets share one.

    Sets of at most ``top`` shingles that link differ in at most d of them,
    hence in at most d parts. A set with more than d non-empty parts thus has
    one that its partner has too. A set with fewer (small ones, by chance)
    gives all its shingles as further keys, which meet only their like: of two
    linked sets, one has enough parts or both give their shingles.
    Sets of neighbouring size classes meet in the higher one.
    """
    level = size_level(len(own), percent)
    keys = []
    for x in (level, level + 1):
        most = 2 * level_top(x, percent) * (100 - percent) // (100 + percent)
        parts = part_signatures(own, most + 1 + (most + 1) // (2 if most < 40 else 4) + 1, x)
        keys.append(parts)
        if len(parts) <= most:
            keys.append(mix(own, 1000 + x))
    return np.concatenate(keys)


def part_rows(docs: DataFrame, wanted: DataFrame, percent: int, width: int) -> DataFrame:
    """(key, n, g) of the finer keys of the ``wanted`` (g) documents."""
    def emit(batches):
        for batch in batches:
            sets = [shingle_set(t, width) for t in texts_as_bytes(batch.column("text"))]
            keys = [finer_keys(s, percent) for s in sets]
            counts = [len(k) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.empty(0, np.uint64), *keys]).view(np.int64)),
                 pa.array(np.repeat([len(s) for s in sets], counts).astype(np.int64)),
                 pa.array(np.repeat(_ids(batch.column("doc_id")), counts))], names=["key", "n", "g"])
    return _texts(docs, wanted).mapInArrow(emit, "key long, n long, g long")


def _small(ids: DataFrame) -> DataFrame:
    """A written id table, broadcast if a count proves it small; a shuffle join beyond that."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, text) of the ids ``g`` of ``wanted``."""
    ids = stored(wanted.select(F.col("g").alias("doc_id")).distinct(), "wanted")
    return (docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "text")
            .join(_small(ids), "doc_id", "left_semi"))


def _bitmap_filter(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose parity bitmaps allow a link."""
    left = sizes.select(F.col("c").alias("a"), F.col("n").alias("n1"), F.col("bits").alias("x"))
    right = sizes.select(F.col("c").alias("b"), F.col("n").alias("n2"), F.col("bits").alias("y"))
    both = pairs.join(left, "a").join(right, "b").where(
        f"100 * least(n1, n2) >= {percent} * greatest(n1, n2)")

    def near(batches):
        for batch in batches:
            n1, n2 = (batch.column(c).to_numpy().astype(np.int64) for c in ("n1", "n2"))
            most = max_difference(n1, n2, percent)
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            ok = [parity_distance(p, q) <= m for p, q, m in zip(x, y, most)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "n1", "n2", "x", "y").mapInArrow(near, "a long, b long")


def verify(pairs: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) of class ids that link, by the exact intersection of their sets."""
    wanted = pairs.select(F.col("a").alias("g")).unionByName(pairs.select(F.col("b").alias("g")))

    def emit(batches):
        for batch in batches:
            sets = [shingle_set(t, width) for t in texts_as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_ids(batch.column("doc_id"))), _lists(sets)], names=["c", "s"])

    sets = stored(_texts(docs, wanted).mapInArrow(emit, "c long, s array<long>"), "pair-sets")
    both = (pairs.join(sets.select(F.col("c").alias("a"), F.col("s").alias("x")), "a")
            .join(sets.select(F.col("c").alias("b"), F.col("s").alias("y")), "b")
            .withColumn("o", F.size(F.array_intersect("x", "y")).cast("long")))
    return both.where(F.expr(f"100 * o >= {percent} * (size(x) + size(y) - o)")).select("a", "b")


def link(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE_WORDS,
         run: int = RUN) -> tuple[DataFrame, DataFrame]:
    """Membership (doc, n, c) of every row and the verified links (a, b) between classes c.

    The links are all there are, but for pairs of a crowded run that other
    links had already put into one component.
    """
    stop = popular_shingles(docs, width, run)
    rows = stored(shingle_rows(docs, stop, percent, width), "shingle-rows")
    # One row a class and task leaves the map side, whatever the copies.
    classes = stored(rows.where("n > 0").groupBy("n", "s1", "s2", "p").agg(F.min("doc").alias("c")), "classes")
    members = rows.select("doc", "n", "s1", "s2").join(
        classes.select("n", "s1", "s2", "c"), ["n", "s1", "s2"], "left").select(
        "doc", "n", F.coalesce("c", "doc").alias("c"))
    groups = stored(classes.groupBy("n", "p").agg(F.min("c").alias("g"), F.count(F.lit(1)).alias("size")),
                    "groups")
    heads = stored(classes.join(groups, ["n", "p"]).select("c", "g", "n", "size"), "heads")
    sizes = rows.select(F.col("doc").alias("c"), "n", "bits")

    # Prefix runs: the pairs of the short ones, and (g, null) for the crowded.
    prefixes = rows.select("doc", "n", "prefix").join(
        _small(groups.select(F.col("g").alias("doc"))), "doc", "left_semi")
    postings = prefixes.select(F.posexplode("prefix").alias("at", "key"), "n", F.col("doc").alias("g")).select(
        "key", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("at")).alias("n"), "g")

    def by_prefix(batch):
        yield from _short_run_pairs(batch, percent, run)
        yield from _long_run_groups(batch, run)

    found = stored(_runs(postings, by_prefix, "a long, b long").distinct(), "prefix-runs")
    crowded = found.where("b is null").select(F.col("a").alias("g")).unionByName(
        groups.where(F.col("size") > run).select("g")).distinct()
    # Crowded groups leave the short runs: a pair of two of them is found by its
    # finer keys, and a pair with another group by their short runs.
    in_crowd = stored(heads.join(crowded, "g", "left_semi").select(F.col("c").alias("g")), "crowded")
    finer = stored(part_rows(docs, in_crowd, percent, width), "part-rows")

    of = heads.select("g", "c")
    short_pairs = (found.where("b is not null")
                   .join(of.select(F.col("g").alias("a"), F.col("c").alias("ca")), "a")
                   .join(of.select(F.col("g").alias("b"), F.col("c").alias("cb")), "b")
                   .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")))
    # The members of one group are a run as well, keyed by the group.
    inner = heads.where("size > 1").select(F.col("g").alias("key"), F.col("n").cast("long").alias("n"),
                                           F.col("c").alias("g"))
    dense = finer.unionByName(inner)

    def check(pairs: DataFrame) -> DataFrame:
        return verify(stored(_bitmap_filter(pairs, sizes, percent), "near"), docs, percent, width)

    def open_runs(links: DataFrame) -> DataFrame:
        """Runs labelled with components ``c``, without those that lie in one component."""
        comp = connected_components(links).select(F.col("node").alias("g"), F.col("component").alias("c"))
        labelled = dense.join(comp, "g", "left").select("key", "n", "g", F.coalesce("c", "g").alias("c"))
        # A map-side combined aggregate finds the keys that are still open.
        split = (labelled.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                 .where("lo != hi").select("key"))
        return labelled.join(split, "key", "left_semi")

    def in_runs(pairs_of) -> DataFrame:
        """Pairs of the open runs, which carry parity bitmaps."""
        def scan(batch):
            yield from pairs_of(batch, percent)
        still = open_runs(links).join(sizes.select(F.col("c").alias("g"), "bits"), "g").select("key", "n", "g", "c", "bits")
        return _runs(still, scan, "a long, b long").distinct()

    alone = dense.select("key", "n", "g", F.col("g").alias("c"))
    links = stored(check(short_pairs.unionByName(star_pairs(alone, percent, 0)).distinct()), "links")
    # Nearest partners join most of what the star leaves open; then all pairs of one run in two
    # components that the bitmaps allow.
    for pairs_of in (_nearest_pairs, _cross_pairs):
        links = stored(links.unionByName(check(in_runs(pairs_of))).distinct(), "links")
    return members, links


def jaccard_components(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE_WORDS,
                       run: int = RUN) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    members, links = link(docs, percent, width, run)
    comp = connected_components(links)
    named = members.join(comp.withColumnRenamed("node", "c"), "c", "left")
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return named.select(real("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                        F.coalesce("component", "c").alias("component")).select(
        "doc_id", "n_shingles", real("component").alias("component_id"))


def query(docs: DataFrame) -> DataFrame:
    """Component of every document with production parameters."""
    return jaccard_components(docs)


QUERY_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM split, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 2))) AS i) WHERE len(w) > 0),
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
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM split LEFT JOIN size USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""
