"""Line dedup, the Jaccard join and decontamination against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barsmith.llm import decontaminate, jaccard_join, line_dedup
from barsmith.llm.mph import FingerprintTable, PerfectHash

from llm_fixtures import awkward, base_words, docs_of  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_perfect_hash_is_minimal_and_survives_bytes():
    keys = np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64)
    mph = PerfectHash.build(keys)
    assert sorted(mph.index(keys)) == list(range(5000))
    table = FingerprintTable.build(keys.view(np.int64), keys.view(np.int64) ^ 5, np.arange(5000), np.arange(5000) * 3)
    back = FingerprintTable.from_bytes(table.to_bytes())
    found, count, value = back.probe(keys.view(np.int64), keys.view(np.int64) ^ 5)
    assert found.all() and (count == np.arange(5000)).all() and (value == np.arange(5000) * 3).all()
    assert not back.probe(keys.view(np.int64), keys.view(np.int64) ^ 6)[0].any()


def plain_line_dedup(rows):
    holders = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        for key in {k.strip(" \t\n\x0b\x0c\r").translate(LOWER) for k in (text or "").split("\n")}:
            if len(key) >= 20:
                holders[key].append(-(2**63) if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keep = []
        for line in lines:
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            gone = len(holders.get(key, ())) >= 3 and (-(2**63) if doc is None else doc) != max(holders[key])
            if not gone:
                keep.append(line)
        out.append((doc, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot_keys", [1 << 14, 2])
def test_line_dedup_matches_plain_version(docs_of, hot_keys):
    rng = random.Random(3)
    shared = ["  Shared Line number %02d é  " % i for i in range(30)] + ["short", ""]
    rows = [(i, "\n".join(rng.choice(shared) if rng.random() < .6 else " ".join(base_words(i, 6))
                          for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    rows += [(None, shared[0]), (61, None), (62, ""), (5, rows[5][1])]
    got = line_dedup.dedup_lines(docs_of(rows), hot_keys=hot_keys).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_line_dedup(rows)


def test_line_dedup_awkward(awkward, docs_of):
    assert line_dedup.query(awkward.withColumn("n_lines", F.lit("clash"))).count() == awkward.count()
    assert line_dedup.query(docs_of([])).count() == 0


def plain_components(rows):
    sets = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[doc] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("run", [64, 3])
def test_jaccard_components_match_plain_version(docs_of, run):
    rng = random.Random(5)
    passage = base_words(99, 40)
    rows = []
    for family in range(6):
        base = base_words(family, 60 + 30 * family)
        for _ in range(12):
            own = list(base)
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(len(own))] = "edit%d" % rng.randrange(10**6)
            rows.append((len(rows), " ".join(own)))
    # Unrelated documents that share a passage, exact copies, short ones.
    rows += [(100 + i, " ".join(passage + base_words(200 + i, 10 + 9 * i))) for i in range(12)]
    rows += [(130, rows[0][1]), (131, rows[0][1].upper()), (132, "a b"), (133, "A  b"), (134, ""), (135, None)]
    got = jaccard_join.jaccard_components(docs_of(rows), run=run).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_components(rows)
    assert len(got) == len(rows)


def test_finer_keys_meet_for_every_linked_pair():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 9, 20, 60, 150, 400):
        for _ in range(40):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            cut = rng.integers(0, n // 9 + 1)
            b = np.unique(np.r_[a[cut:], rng.integers(0, 2**63, n // 9 - cut if n // 9 > cut else 0).astype(np.uint64)])
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert len(np.intersect1d(jaccard_join.finer_keys(a, 80), jaccard_join.finer_keys(b, 80)))


def test_jaccard_awkward(awkward, docs_of):
    got = jaccard_join.query(awkward.withColumn("component_id", F.lit("clash"))).collect()
    assert len(got) == awkward.count()
    assert all(r["component_id"] == r["doc_id"] for r in got)
    assert jaccard_join.query(docs_of([])).count() == 0


@pytest.fixture()
def benchmark(spark):
    rows = [(i, " ".join(base_words(500 + i, 30))) for i in range(5)] + [(9, None), (None, "x"), (10, "two words")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("bound", [1 << 18, 0])
def test_leaks_verbatim_and_edited(docs_of, benchmark, bound):
    item = base_words(500, 30)
    edited = [w if i % 6 else "changed%d" % i for i, w in enumerate(base_words(501, 30))]
    filler = base_words(77, 200)
    rows = [(1, " ".join(filler[:50] + item + filler[50:])), (2, " ".join(filler[:100] + edited + filler[100:])),
            (3, " ".join(filler)), (4, " ".join(base_words(502, 30)).upper() + "!"), (4, "twice the id"),
            (5, None), (6, ""), (None, " ".join(item)), (7, "only two words here")]
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in
           decontaminate.find_leaks(docs_of(rows), benchmark, broadcast_seeds=bound).collect()}
    assert set(got) == {(1, 0), (2, 1), (4, 2), (7, 10)}
    assert got[1, 0] == 1.0 and got[4, 2] == 1.0 and 0.5 <= got[2, 1] < 1.0
    assert decontaminate.decontaminate(docs_of(rows), benchmark).count() == 4


def test_alignment_matches_plain_dynamic_programme():
    rng = random.Random(2)
    for _ in range(50):
        a = [rng.randrange(5) for _ in range(rng.randrange(1, 12))]
        b = [rng.randrange(5) for _ in range(rng.randrange(1, 20))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                table[i][j] = max(0, table[i - 1][j - 1] + (2 if x == y else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
        assert decontaminate.align(np.array(a), np.array(b)) == max(map(max, table))


def test_leaks_empty(docs_of, spark, benchmark):
    assert decontaminate.query(docs_of([]), benchmark).count() == 0
    assert decontaminate.query(docs_of([(1, "a b c d")]), benchmark.where("false")).count() == 0
