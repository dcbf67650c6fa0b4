"""A Merkle manifest of a table, built from levels kept as concatenated hex strings.

Every row is a leaf: the SHA-256 of its encoded fields. The leaves of a tree (one
tree a ``lang``), in their order, are hashed in runs of ``arity`` nodes, level by
level, until one node is left; the subroots of all trees are reduced in the same
way to one root.

1. *Positions.* Leaves are sorted by range partitions, so that no tree goes
   through one task; a partition's count and the counts before it number them.
2. *Blocks.* ``arity ** BLOCK_LEVELS`` consecutive leaves are one block: aligned,
   so all their parents up to the block's top are in it. A block keeps each level
   as one string of 64 hex digits a node; a parent is the hash of a fixed-width
   substring, and what flanks a node inside that substring is its siblings.
3. *Recursion.* The tops of the blocks are the leaves of the next round, until
   every tree is one block. A row's proof is its segments inside its block, then
   those of the block's top.

All of it are SQL expressions; a task holds one block at a time, the driver one
flag a round. Small tables are broadcast by Spark's own size check of written files.

Defined results: a null field is encoded as ``-``; leaves of one doc_id (null ids
come first) follow each other by their hash, repeated rows are leaves of their
own; null, empty and very long texts are hashed whole; a table without rows gives
no rows; a tree of one leaf has that leaf as subroot and no siblings. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored

#: Hex digits of a node.
WIDTH = 64
#: Children of a node.
ARITY = 2
#: Levels reduced inside a block: 256 leaves of an ``ARITY`` of 2, 32 KB of strings.
BLOCK_LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
ROW_BITS = 33


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, their place in their ``tree`` by ``order``, and the tree's ``total``.

    Rows that are equal in all of ``order`` are told apart by where they were read.
    """
    spread = nodes.withColumn("read_at", F.monotonically_increasing_id())
    keys = ["tree", *order, "read_at"]
    dealt = spread.repartitionByRange(partitions(nodes.sparkSession), *keys).sortWithinPartitions(*keys)
    placed = stored(dealt.drop("read_at").withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("at", ROW_BITS)
    counts = placed.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"),
                                                            F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part")) - F.col("n")
    shifts = stored(counts.select("tree", "part", (before - F.col("first")).alias("shift"),
                                  F.sum("n").over(tree).alias("total")), "merkle-shifts")
    return (placed.withColumn("part", part).join(shifts, ["tree", "part"])
            .withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift"))


def _levels(arity: int) -> str:
    """SQL: the strings of the ``height`` levels above ``level``, that one first."""
    run = arity * WIDTH
    parents = (f"encode(array_join(transform(sequence(0L, (length(s) - 1) div {run}), "
               f"j -> sha2(substring(s, cast(j * {run} + 1 as int), {run}), 256)), ''), 'UTF-8')")
    return (f"aggregate(slice(sequence(0, height), 2, height), array(level), "
            f"(built, l) -> concat(built, transform(array(element_at(built, -1)), s -> {parents})))")


def _segments(arity: int) -> str:
    """SQL: per level, what stands left and right of node ``i``'s ancestor in its run."""
    run = arity * WIDTH
    at = f"(i div cast(power({arity}, l) as bigint))"
    start = f"({at} div {arity}) * {run}"
    left = f"substring(levels[l], cast({start} + 1 as int), cast({at} % {arity} * {WIDTH} as int))"
    right = (f"substring(levels[l], cast(({at} + 1) * {WIDTH} + 1 as int), "
             f"cast(({arity - 1} - {at} % {arity}) * {WIDTH} as int))")
    return (f"transform(slice(sequence(-1, height - 1), 2, height), "
            f"l -> named_struct('left', {left}, 'right', {right}))")


def grow(nodes: DataFrame, arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """Reduce every tree of (tree, pos, total, node, payload).

    Returns (tree, payload, proof, top) of every node, ``proof`` being an array of
    (left, right) siblings from the bottom up, and (tree, top) of every tree.
    """
    size = arity ** block_levels
    block = F.expr(f"pos div {size}")
    gathered = nodes.groupBy("tree", block.alias("block"), F.expr(f"(total - 1) div {size} + 1").alias("n_blocks")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "node", "payload"))).alias("items"))
    # A block of many keeps all its levels; a tree's only one ends at its single node.
    height = F.expr(f"if(n_blocks > 1, {block_levels}, size(filter(sequence(0, {block_levels - 1}), "
                    f"l -> power({arity}, l) < size(items))))")
    blocks = stored(
        gathered.withColumn("height", height)
        .withColumn("level", F.encode(F.array_join(F.col("items.node"), ""), "UTF-8"))
        .select("tree", "block", "n_blocks", "height", F.col("items.payload").alias("payloads"),
                F.expr(_levels(arity)).alias("levels")), "merkle-blocks")
    top = F.decode(F.element_at("levels", -1), "UTF-8")
    own = F.expr(f"transform(payloads, (p, i) -> named_struct('payload', p, 'proof', {_segments(arity)}))")
    if blocks.where("n_blocks > 1").isEmpty():
        rows = blocks.select("tree", F.explode(own).alias("row"), top.alias("top"))
        return rows.select("tree", "row.payload", "row.proof", "top"), blocks.select("tree", top.alias("top"))
    tops = blocks.select("tree", F.col("block").alias("pos"), F.col("n_blocks").alias("total"),
                         top.alias("node"), F.struct("block").alias("payload"))
    upper, roots = grow(tops, arity, block_levels)
    above = upper.select("tree", F.col("payload.block").alias("block"), F.col("proof").alias("above"), "top")
    rows = blocks.select("tree", "block", F.explode(own).alias("row")).join(above, ["tree", "block"])
    return rows.select("tree", "row.payload", F.concat("row.proof", "above").alias("proof"), "top"), roots


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(
        F.concat(s["left"], F.encode(node, "UTF-8"), s["right"]), 256))


def proof_hash(proof: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    siblings = F.aggregate(proof, F.lit(b""), lambda all_, s: F.concat(all_, s["left"], s["right"]))
    return F.sha2(siblings, 256)


def manifest(rows: DataFrame, arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """(payload, leaf, proof, subroot, root) of every row of (lang, leaf, order_by, payload).

    Trees are ordered by ``lang``, null first, bytewise; ``proof`` leads from the
    leaf over its tree's subroot to the root.
    """
    leaves = rows.select(encoded(F.col("lang")).alias("tree"), "order_by", F.col("leaf").alias("node"),
                         F.struct("lang", "leaf", "payload").alias("payload"))
    ordered = numbered(stored(leaves, "merkle-leaves"), ["order_by", "node"])
    inside, subroots = grow(ordered, arity, block_levels)
    # The key of a tree tells its lang: "-" or "<bytes>:<lang>".
    lang = F.when(F.col("tree") != "-", F.expr("substring(tree, locate(':', tree) + 1)"))
    trees = subroots.select(F.lit("").alias("tree"), lang.alias("lang"), F.col("top").alias("node"),
                            F.struct("tree").alias("payload"))
    between, _ = grow(numbered(trees, ["lang"]), arity, block_levels)
    roots = stored(between.select(F.col("payload.tree").alias("tree"), F.col("proof").alias("above"),
                                  F.col("top").alias("root")), "merkle-roots")
    return inside.join(roots, "tree").select(
        "payload.payload", "payload.leaf", F.concat("proof", "above").alias("proof"),
        F.col("top").alias("subroot"), "root")


def query(docs: DataFrame) -> DataFrame:
    """Leaf, roots, proof digest and proof check of every document; every 7th id's hash is tampered with."""
    docs = docs.select(*FIELDS)
    fields = [F.col(c) for c in FIELDS]
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    tampered = leaf_hash(*[more if c == "n_chars" else F.col(c) for c in FIELDS])
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    rows = docs.select("lang", leaf_hash(*fields).alias("leaf"), F.col("doc_id").alias("order_by"),
                       F.struct("doc_id", F.when(hit, tampered).alias("tampered")).alias("payload"))
    found = manifest(rows)
    shown = F.coalesce("payload.tampered", "leaf")
    return found.select(
        F.col("payload.doc_id").alias("doc_id"), "leaf", "subroot", "root",
        proof_hash(F.col("proof")).alias("proof_sha256"), fold(shown, F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _field_sql(column: str) -> str:
    return f"coalesce(strlen(({column})::VARCHAR)::VARCHAR || ':' || ({column})::VARCHAR, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"


#: CRC-32 of the decimal doc_id, bit by bit.
CRC_SQL = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
  list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""

QUERY_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, {_field_sql('lang')} AS tree, lang, {_leaf_sql('n_chars')} AS leaf,
    CASE WHEN {CRC_SQL} % 7 = 0 THEN {_leaf_sql('n_chars + 1')} ELSE {_leaf_sql('n_chars')} END AS shown
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
inner_nodes AS (
  SELECT tree, 0 AS lvl, pos AS idx, leaf AS node FROM placed
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, sha256(node || coalesce(next, ''))
  FROM (SELECT *, lead(node) OVER (PARTITION BY tree ORDER BY idx) AS next,
               count(*) OVER (PARTITION BY tree) AS n FROM inner_nodes)
  WHERE n > 1 AND idx % 2 = 0),
subroots AS (
  SELECT t.tree, t.lvl AS height, t.node AS subroot,
    row_number() OVER (ORDER BY l.lang NULLS FIRST) - 1 AS pos
  FROM inner_nodes t JOIN (SELECT tree, max(lvl) AS lvl FROM inner_nodes GROUP BY tree) m USING (tree, lvl)
  JOIN (SELECT DISTINCT tree, lang FROM leaves) l USING (tree)),
outer_nodes AS (
  SELECT 0 AS lvl, pos AS idx, subroot AS node FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, sha256(node || coalesce(next, ''))
  FROM (SELECT *, lead(node) OVER (ORDER BY idx) AS next, count(*) OVER () AS n FROM outer_nodes)
  WHERE n > 1 AND idx % 2 = 0),
top AS (SELECT max(lvl) AS height, max_by(node, lvl) AS root FROM outer_nodes),
steps AS (
  SELECT p.tree, p.pos, l.lvl AS step, p.pos >> l.lvl AS at, n.node AS sibling
  FROM placed p JOIN subroots s USING (tree), LATERAL (SELECT unnest(range(s.height)) AS lvl) l
  LEFT JOIN inner_nodes n ON n.tree = p.tree AND n.lvl = l.lvl AND n.idx = xor(p.pos >> l.lvl, 1)
  UNION ALL
  SELECT p.tree, p.pos, s.height + l.lvl, s.pos >> l.lvl, n.node
  FROM placed p JOIN subroots s USING (tree), top t, LATERAL (SELECT unnest(range(t.height)) AS lvl) l
  LEFT JOIN outer_nodes n ON n.lvl = l.lvl AND n.idx = xor(s.pos >> l.lvl, 1)),
proofs AS (
  SELECT tree, pos, sha256(string_agg(coalesce(sibling, ''), '' ORDER BY step)) AS proof_sha256
  FROM steps GROUP BY tree, pos),
folded AS (
  SELECT tree, pos, 0 AS step, shown AS node FROM placed
  UNION ALL
  SELECT f.tree, f.pos, f.step + 1, sha256(CASE WHEN s.at % 2 = 1 THEN s.sibling || f.node
                                                ELSE f.node || coalesce(s.sibling, '') END)
  FROM folded f JOIN steps s USING (tree, pos, step)),
ends AS (SELECT tree, pos, max_by(node, step) AS folded_root FROM folded GROUP BY tree, pos)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM placed JOIN subroots USING (tree) JOIN ends ON ends.tree = placed.tree AND ends.pos = placed.pos
LEFT JOIN proofs ON proofs.tree = placed.tree AND proofs.pos = placed.pos, top
"""
