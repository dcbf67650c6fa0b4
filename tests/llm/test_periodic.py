"""Periodic runs against a plain scan of all periods."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from barsmith.llm import periodic

from llm_fixtures import awkward, base_words, docs_of  # noqa: F401


def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(24, 3 * q):
                found[start, length] = min(q, found.get((start, length), q))
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def shapes(rng):
    n, k = rng.randrange(0, 250), rng.choice([1, 2, 3, 5, 50])
    w = [b"w%d" % rng.randrange(k) for _ in range(n)]
    shape = rng.randrange(4)
    if shape == 1 and n:
        a = rng.randrange(n)
        p = 1 + (n - a) // (3 + rng.randrange(8))
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    if shape == 2:
        part = [b"w%d" % rng.randrange(9) for _ in range(rng.randrange(1, 30))]
        w = [x for _ in range(rng.randrange(1, 16))
             for x in part * rng.randrange(1, 5) + [b"x%d" % rng.randrange(100)] * rng.randrange(3)]
    if shape == 3:
        w = ([b"w%d" % rng.randrange(2) for _ in range(rng.randrange(1, 6))] * 200)[:n]
        for _ in range(rng.randrange(4)):
            if w:
                w[rng.randrange(len(w))] = b"z"
    return w


@pytest.mark.parametrize("few", [periodic.FEW_CLASSES, 1])
def test_runs_match_plain_scan(monkeypatch, few):
    monkeypatch.setattr(periodic, "FEW_CLASSES", few)
    rng = random.Random(1)
    seen = 0
    for _ in range(25):
        texts = [shapes(rng) for _ in range(16)]
        for text, got in zip(texts, periodic.periodic_runs(texts)):
            assert got == plain_runs(text)
            seen += len(got)
    assert seen > 200


def test_runs_keep_their_smallest_period_and_bounds():
    w = [b"x"] + [b"a", b"b"] * 12 + [b"y"]
    assert periodic.periodic_runs([w, w[1:24]]) == [[(1, 24, 2)], []]
    assert periodic.periodic_runs([[b"a"] * 5000, []]) == [[(0, 5000, 1)], []]
    assert periodic.best_run([(0, 30, 10), (5, 24, 8), (9, 60, 20)]) == (0, 30, 10)
    assert periodic.collapse(w, [(1, 24, 2)]) == b"x a b y"


def plain_row(doc, text):
    w = [x for x in (text or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if x]
    if doc is not None and w:
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(len(w))]
    runs = plain_runs(w)
    best = periodic.best_run(runs) or (None, None, None)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}

    def digest(s):
        return hashlib.sha256(s.encode()).hexdigest()
    return (doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            digest("".join("%d,%d,%d\n" % r for r in runs)),
            digest(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def test_query_matches_plain_version(docs_of):
    rng = random.Random(4)
    rows = [(i, b" ".join(shapes(rng)).decode() if i % 3 else " \t".join(base_words(i, 10 * i))) for i in range(60)]
    rows += [(61, None), (62, ""), (None, "a " * 30), (5, rows[5][1]), (63, "été " * 40)]
    got = periodic.query(docs_of(rows)).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                                               "runs_sha256", "collapsed_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((plain_row(*r) for r in rows), key=str)


def test_awkward(awkward, docs_of):
    clash = awkward.withColumn("runs", F.lit("x")).withColumn("best", F.lit(1)).withColumn("start", F.lit(2))
    assert periodic.query(clash).count() == awkward.count()
    assert periodic.query(docs_of([])).count() == 0


def test_hostile_texts_stay_fast():
    stretch = [b"p%d" % i for i in range(16)]
    texts = [[b"a"] * 40_000, [x for i in range(2000) for x in [b"x%d" % i, *stretch]],
             [x for i in range(800) for x in [b"x%d" % i] + [b"a"] * 40]]
    found = periodic.periodic_runs(texts)
    assert found[0] == [(0, 40_000, 1)] and found[1] == [] and len(found[2]) == 800
