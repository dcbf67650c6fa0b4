"""Fast similarity sketching, banding and the near-duplicate components against plain versions."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from barsmith.llm import minhash
from barsmith.llm.shingles import shingle_set

from llm_fixtures import awkward, base_words, docs_of  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_sets(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[i:i + 2]) for i in range(max(1, len(w) - 1))} if w else set())
    return sets


def plain_near_duplicates(rows):
    sets = plain_sets(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(j)] = find(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        c = find(i)
        if doc is not None:
            least[c] = min(doc, least.get(c, doc))
    return sorted(((doc, len(s), least.get(find(i)), doc == least.get(find(i)))
                   for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)


def test_sketch_agreement_estimates_similarity():
    rng = np.random.default_rng(0)
    for size in (1, 2, 7, 40, 3000):
        for share in (0.0, 0.5, 0.8, 1.0):
            agree = []
            for _ in range(40):
                both = rng.integers(0, 2**63, round(size * share)).astype(np.uint64)
                a, b = (np.unique(np.r_[both, rng.integers(0, 2**63, size - len(both)).astype(np.uint64)])
                        for _ in range(2))
                x, y = minhash.sketches([a, b])
                agree.append((x == y).mean())
            similarity = len(both) / (2 * size - len(both))
            assert abs(np.mean(agree) - similarity) < 0.05


def test_every_bin_fills_and_small_values_win():
    one = np.array([12345], np.uint64)
    many = np.arange(1, 5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sketch = minhash.sketches([one, many, np.empty(0, np.uint64)])
    assert (sketch[:2] != 2**64 - 1).all() and (sketch[2] == 2**64 - 1).all()
    assert (sketch[1] >> np.uint64(32)).max() == 0  # one round fills a large set
    assert (sketch[0] >> np.uint64(32)).max() < 2 * minhash.BINS
    # A set's sketch does not depend on what it is sketched with.
    assert (minhash.sketches([many])[0] == sketch[1]).all()


def family(rng, base, edits):
    own = list(base)
    for _ in range(edits):
        own[rng.randrange(len(own))] = "edit%d" % rng.randrange(10**6)
    return " ".join(own)


@pytest.mark.parametrize("block", [1024, 3])
def test_components_match_plain_version(docs_of, block):
    rng = random.Random(5)
    passage = base_words(99, 40)
    rows = []
    for f in range(5):
        base = base_words(f, 60 + 30 * f)
        rows += [(len(rows) + i, family(rng, base, rng.randrange(0, 9))) for i in range(14)]
    rows += [(100 + i, " ".join(passage + base_words(200 + i, 10 + 9 * i))) for i in range(12)]
    rows += [(130, rows[0][1]), (131, rows[0][1].upper()), (132, "a b"), (133, "A  b"), (134, ""), (135, None),
             (136, "a"), (137, "A"), (None, rows[3][1]), (None, "alone here"), (50, rows[5][1]), (136, "a")]
    got = minhash.near_duplicates(docs_of(rows), block=block)
    found = sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    want = [(d, n, c, d == c) for d, n, c, _ in plain_near_duplicates(rows)]
    assert found == sorted(want, key=str)


def test_a_crowded_key_gives_at_most_one_pair_a_class(docs_of):
    rng = random.Random(7)
    base = base_words(3, 200)
    docs = docs_of([(i, family(rng, base, 4)) for i in range(120)])
    rows = minhash.sketched(docs)
    live = rows.select(F.explode("keys").alias("key"), F.col("row").alias("g"), "n")
    centres = live.groupBy("key").agg(F.min(F.struct(F.xxhash64("g").alias("rank"), "g", "n")).alias("centre"))
    assert minhash.star_pairs(live.join(centres, "key"), 80).count() <= 120
    assert minhash.near_duplicates(docs).where("kept").count() == 1


def test_block_pairs_cover_every_open_pair_once(spark):
    rng = random.Random(9)
    bands = 4
    held = {g: [((band << 8) + rng.randrange(2) + 1 << 32) + 5 for band in range(bands)] for g in range(40)}
    rows = [(key, g, 100, g if g % 3 else -1) for g in range(40) for key in held[g]]
    labelled = spark.createDataFrame(rows, "key long, g long, n int, c long")
    bits = spark.createDataFrame([(g, bytearray(8 << g % 2), [k >> 32 for k in held[g]]) for g in range(40)],
                                 "g long, bits binary, marks array<int>")
    want = {(min(a[1], b[1]), max(a[1], b[1])) for a in rows for b in rows if a[0] == b[0] and a[3] != b[3]}
    for block in (3, 1000):
        got = minhash.block_pairs(labelled, bits, 80, block).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    few = [tuple(r) for r in minhash.block_pairs(labelled, bits, 80, 1000, nearest=True).collect()]
    assert few and set(few) <= want and len(few) < len(want)  # one a class and key at most


def test_awkward(awkward, docs_of):
    clash = awkward.withColumn("row", F.lit("x")).withColumn("keys", F.lit(1)).withColumn("kept", F.lit(2))
    got = minhash.query(clash).collect()
    assert len(got) == awkward.count()
    assert all(r["component_id"] == r["doc_id"] and r["kept"] for r in got)
    assert minhash.query(docs_of([])).count() == 0


def test_shingles_are_two_words():
    assert len(shingle_set(b"a b c a b", 2)) == 3 and len(shingle_set(b"one", 2)) == 1 and not len(shingle_set(b" \n", 2))
