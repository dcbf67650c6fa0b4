"""The Merkle manifest against a plain tree, and what a changed row does to its proof."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from barsmith.llm import merkle

from llm_fixtures import DOCS, awkward, docs_of  # noqa: F401


def digest(s):
    return sha256(s.encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row, more=0):
    doc, text, lang, source, n = row
    n = n + more if n is not None else None
    return digest("".join(map(encoded, (doc, source, lang, n, text))))


def tree_of(nodes, arity):
    """Levels of a tree and every leaf's (left, right) siblings."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([digest("".join(now[i:i + arity])) for i in range(0, len(now), arity)])
    proofs = []
    for i in range(len(nodes)):
        proof = []
        for now in levels[:-1]:
            lo = i // arity * arity
            proof.append(("".join(now[lo:i]), "".join(now[i + 1:lo + arity])))
            i //= arity
        proofs.append(proof)
    return levels[-1][0], proofs


def plain(rows, arity=2):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((own, *tree_of([leaf_of(r) for r in own], arity)))
    root, above = tree_of([t[1] for t in trees], arity)
    out = []
    for (own, subroot, proofs), upper in zip(trees, above):
        for row, proof in zip(own, proofs):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf_of(row, 1 if hit else 0)
            for left, right in proof + upper:
                node = digest(left + node + right)
            out.append((row[0], leaf_of(row), subroot, root,
                        digest("".join(a + b for a, b in proof + upper)), node, node == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def make(n):
    rows = [(i * 3, "text %d é" % i, [None, "en", "dé", "zz"][i % 7 % 4], "s%d" % (i % 3), i) for i in range(n)]
    return rows + [(7, None, "lone", None, None), (None, "", "en", "", 0), (None, "x", "en", "s", 1),
                   (0, "text 0 é", None, "s0", 0), (14, "", None, "s", None)]


@pytest.mark.parametrize("n,block_levels", [(90, 8), (90, 2), (0, 1), (33, 1)])
def test_manifest_matches_plain_tree(spark, docs_of, monkeypatch, n, block_levels):
    monkeypatch.setattr(merkle.grow, "__defaults__", (merkle.ARITY, block_levels))
    monkeypatch.setattr(merkle.manifest, "__defaults__", (merkle.ARITY, block_levels))
    rows = make(n)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = merkle.query(docs).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)
    tampered = [r for r in got if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0]
    assert len({r["root"] for r in got}) == 1 and all(
        r["verified"] != (r["doc_id"] in {t["doc_id"] for t in tampered} - {7, 14}) for r in got)


@pytest.mark.parametrize("arity", [3, 5])
def test_other_arities(spark, docs_of, arity):
    rows = make(70)
    flat = spark.createDataFrame(rows, DOCS).select(
        "lang", merkle.leaf_hash(*map(F.col, merkle.FIELDS)).alias("leaf"), F.col("doc_id").alias("order_by"),
        F.struct("doc_id").alias("payload"))
    got = merkle.manifest(flat, arity, 2).select(
        "payload.doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("proof")),
        merkle.fold(F.col("leaf"), F.col("proof")).alias("folded")).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted((r[:5] for r in plain(rows, arity)), key=str)
    assert all(r["folded"] == r["root"] for r in got)


def test_repeated_rows_and_one_tree(spark, docs_of):
    rows = [(1, "same", "en", "s", 4)] * 40
    got = merkle.query(spark.createDataFrame(rows, DOCS)).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_awkward(awkward, docs_of):
    clash = awkward.withColumn("tree", F.lit("x")).withColumn("leaf", F.lit(1)).withColumn("pos", F.lit(2))
    got = merkle.query(clash).collect()
    assert len(got) == awkward.count()
    assert merkle.query(docs_of([])).count() == 0
