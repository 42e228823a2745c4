"""Merkle manifest of a table, stored in van Emde Boas blocks.

Every group (source) has a 16-ary hash tree over its rows, and one more tree
stands over the groups' roots. A tree is cut into aligned blocks of ``levels``
levels (4096 rows at 4 levels); the roots of the blocks are the leaves of the
next tier of blocks, until one block is left. A block is one row of a table:
its nodes are one byte string in van Emde Boas order (split at half height,
the upper part first, then the lower ones from left to right, each laid out
the same way), without gaps although the last runs are short. Addresses are
arithmetic on (leaves of the block, level, index), so building a block and
reading a node's siblings need no pointers.

Spark numbers the rows (range-partitioned sort), groups them by block, and
folds the proofs; Python sees one block (at most ``16 ** (levels - 1)`` rows)
at a time.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.common import keep
from sparklab.operators.relational import number_rows

#: Children of a node, bytes of a digest
FAN = 16
DIGEST = 32
#: Fixed value: what makes up a leaf of ``documents``
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ------------------------------------------------------- address arithmetic
def height(n: int) -> int:
    """Levels of a tree of its own over ``n`` leaves, leaves included."""
    levels, width = 1, 1
    while width < n:
        levels, width = levels + 1, width * FAN
    return levels


def nodes_of(n, levels: int):
    """Nodes of a tree of ``levels`` levels over ``n`` leaves, filled from the left (numbers or arrays)."""
    total = 0 * n
    for _ in range(levels):
        total, n = total + n, -(-n // FAN)
    return total


def address(n, levels: int, level: int, index):
    """Place of node ``index`` (from the left) of ``level`` (leaves are 0) in van Emde Boas order."""
    if levels == 1:
        return 0 * index
    low = levels // 2
    high = levels - low
    tops = -(-n // FAN ** low)  # leaves of the upper part
    if level >= low:
        return address(tops, high, level - low, index)
    span, below = FAN ** (low - 1), FAN ** (low - 1 - level)
    part = index // below
    own = np.minimum(span, n - part * span)
    return nodes_of(tops, high) + part * nodes_of(span, low) + address(own, low, level, index - part * below)


def _digest(run: bytes) -> bytes:
    return hashlib.sha256(run).digest()


def build_block(leaves: np.ndarray, levels: int) -> np.ndarray:
    """(nodes, 32) bytes in van Emde Boas order from the leaves' digests, (n, 32) bytes."""
    n = len(leaves)
    nodes = np.zeros((nodes_of(n, levels), DIGEST), np.uint8)
    nodes[address(n, levels, 0, np.arange(n))] = leaves
    width = n
    for level in range(1, levels):
        below = hexlify(nodes[address(n, levels, level - 1, np.arange(width))].tobytes())
        step = FAN * 2 * DIGEST
        made = b"".join(_digest(below[i:i + step]) for i in range(0, len(below), step))
        width = -(-width // FAN)
        nodes[address(n, levels, level, np.arange(width))] = np.frombuffer(made, np.uint8).reshape(-1, DIGEST)
    return nodes


def siblings(nodes: np.ndarray, n: int, levels: int, at: np.ndarray):
    """For each leaf in ``at``, level by level: its place in its run, and the hex text of the run's others."""
    slots, others = [], []
    for level in range(levels - 1):
        index = at // FAN ** level
        width = -(-n // FAN ** level)
        runs, own = np.unique(index // FAN, return_inverse=True)
        members = (runs[:, None] * FAN + np.arange(FAN)).ravel()
        members = members[members < width]
        text = hexlify(nodes[address(n, levels, level, members)].tobytes()).decode()
        start = np.searchsorted(members, runs * FAN)
        end = np.append(start[1:], len(members))
        run = [text[2 * DIGEST * a:2 * DIGEST * b] for a, b in zip(start, end, strict=True)]
        slot = index % FAN
        slots.append(slot)
        others.append([run[r][:2 * DIGEST * s] + run[r][2 * DIGEST * (s + 1):] for r, s in zip(own.ravel(), slot, strict=True)])
    return slots, others


# ----------------------------------------------------------------- the table
def leaf_of(columns: dict[str, Column], fields=FIELDS) -> Column:
    """Digest of a row: each field as ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    parts = []
    for f in fields:
        c = columns[f].cast("string")
        parts.append(F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)))
    return F.sha2(F.concat(*parts), 256)


@dataclass
class Manifest:
    """Tables of a manifest. ``leaves``: tree, pos, n (leaves of the tree), key, leaf and the carried columns.
    ``tiers`` and ``tops``: blocks (tree, block, n, nodes, root) of the groups' trees and of the tree over them,
    lowest tier first. ``subroots``: tree, group, pos, subroot. ``root`` is None for an empty table."""

    leaves: DataFrame
    tiers: list[DataFrame]
    tops: list[DataFrame]
    subroots: DataFrame
    root: str | None
    levels: int


BLOCK = "tree long, block long, n long, nodes binary, root string"


def grow(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Tiers of blocks over ``nodes(tree, pos, n, digest)``, the lowest first, written to the shared folder."""
    span = FAN ** (levels - 1)

    def build(t: pa.Table) -> pa.Table:
        tree, n = t["tree"][0].as_py(), t["n"][0].as_py()
        pos = t["pos"].to_numpy()
        order = np.argsort(pos, kind="stable")
        block, own = int(pos[order[0]]) // span, min(span, n - int(pos[order[0]]) // span * span)
        if t.num_rows != own:
            raise ValueError(f"block {block} of tree {tree} has {t.num_rows} of {own} leaves")
        raw = bytes.fromhex("".join(t["digest"].take(pa.array(order)).to_pylist()))
        made = build_block(np.frombuffer(raw, np.uint8).reshape(-1, DIGEST), levels if n > span else height(n))
        # the root's address is 0 at any height
        return pa.table({"tree": [tree], "block": [block], "n": [n], "nodes": [made.tobytes()], "root": [made[0].tobytes().hex()]},
                        pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("nodes", pa.binary()), ("root", pa.string())]))

    most, tiers = nodes.agg(F.max("n")).first()[0] or 0, []
    while True:
        d = nodes.select("tree", F.floor(F.col("pos") / span).alias("block"), "pos", "n", "digest")
        tiers.append(keep(d.groupBy("tree", "block").applyInArrow(build, BLOCK)))
        if most <= span:
            return tiers
        most = -(-most // span)
        nodes = tiers[-1].where(F.col("n") > span).select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / span).alias("n"),
                                                          F.col("root").alias("digest"))


def manifest(docs: DataFrame, carry: dict[str, Column] | None = None, fields=FIELDS, key: str = "doc_id", group: str = "source",
             levels: int = 4) -> Manifest:
    """Hash trees over the rows of ``docs``, one per ``group``, ordered by ``key``, and one over the groups.

    A null field counts as ``-``, so it differs from an empty one; texts are hashed whole. Groups are ordered by
    UTF-8 bytes, null first; the rows of a group by key, null first, equal keys by digest (rows equal in all fields
    are interchangeable, each is a leaf). Other columns don't count, whatever their names. ``carry`` names columns
    computed in the same scan and kept with the leaves. An empty table has no root.
    """
    carry = carry or {}
    cols = {c: F.col(f"`{c}`") for c in {*fields, key, group}}
    d = keep(docs.select(cols[group].alias("group"), cols[key].alias("key"), leaf_of(cols, fields).alias("leaf"), *[c.alias(a) for a, c in carry.items()]))
    d = number_rows(d.withColumn("_tie", F.monotonically_increasing_id()), ["group", "key", "leaf", "_tie"], name="no", start=0)
    # a tree is named by the number of its first row, so trees ascend as their groups do
    trees = keep(d.groupBy("group").agg(F.min("no").alias("tree"), F.count("*").alias("n")))
    of = trees.select(F.col("group").alias("_group"), "tree", "n")
    d = keep(d.join(of, F.col("group").eqNullSafe(F.col("_group"))).select("tree", (F.col("no") - F.col("tree")).alias("pos"), "n", "group", "key", "leaf", *carry))
    tiers = grow(d.select("tree", "pos", "n", F.col("leaf").alias("digest")), levels)
    span = FAN ** (levels - 1)
    subroots = tiers[0].where(F.col("n") <= span)
    for tier in tiers[1:]:
        subroots = subroots.unionByName(tier.where(F.col("n") <= span))
    subroots = number_rows(subroots.select("tree", F.col("root").alias("subroot")), ["tree"], name="pos", start=0)
    subroots = keep(subroots.join(trees.select("tree", "group"), "tree"))
    tops = grow(subroots.select(F.lit(-1).cast("long").alias("tree"), "pos", F.lit(trees.count()).cast("long").alias("n"), F.col("subroot").alias("digest")), levels)
    root = tops[-1].select("root").first()
    return Manifest(d, tiers, tops, subroots, root and root[0], levels)


PATH = T.StructType([T.StructField("slots", T.ArrayType(T.IntegerType())), T.StructField("siblings", T.ArrayType(T.StringType()))])


def _paths(members: DataFrame, tier: DataFrame, levels: int) -> DataFrame:
    """``members(tree, pos, ...)`` with the path from their leaf to the root: in their block, then the block's own.

    ``tier`` has the blocks with their paths (slots, siblings)."""
    span = FAN ** (levels - 1)
    schema = T.StructType([*members.schema.fields, *PATH.fields])

    def read(own: pa.Table, block: pa.Table) -> pa.Table:
        own = own.drop_columns(["_block"])
        n, b = block["n"][0].as_py(), block["block"][0].as_py()
        nodes = np.frombuffer(block["nodes"][0].as_py(), np.uint8).reshape(-1, DIGEST)
        at = own["pos"].to_numpy() - b * span
        slots, others = siblings(nodes, min(span, n - b * span), levels if n > span else height(n), at)
        up, up_text = block["slots"][0].as_py(), block["siblings"][0].as_py()
        slots = [[int(s) for s in x] + up for x in zip(*slots, strict=True)] if slots else [up] * len(at)
        others = [list(x) + up_text for x in zip(*others, strict=True)] if others else [up_text] * len(at)
        return (own.append_column("slots", pa.array(slots, pa.list_(pa.int32()))).append_column("siblings", pa.array(others, pa.list_(pa.string()))))

    left = members.withColumn("_block", F.floor(F.col("pos") / span))
    return left.groupBy("tree", "_block").cogroup(tier.groupBy("tree", "block")).applyInArrow(read, schema)


def _with_paths(tiers: list[DataFrame], crown: DataFrame, levels: int) -> DataFrame:
    """The lowest tier with the paths of its blocks' roots; ``crown(tree, slots, siblings)`` goes on from a tree's root."""
    span, above = FAN ** (levels - 1), None
    for tier in reversed(tiers):
        found = crown.select("tree", F.lit(0).cast("long").alias("block"), "slots", "siblings").join(
            tier.where(F.col("n") <= span).select("tree"), "tree", "left_semi")
        if above is not None:
            inner = _paths(tier.where(F.col("n") > span).select("tree", F.col("block").alias("pos")), above, levels)
            found = found.unionByName(inner.select("tree", F.col("pos").alias("block"), "slots", "siblings"))
        above = keep(tier.join(found, ["tree", "block"]))
    return above


def proofs(m: Manifest) -> DataFrame:
    """Inclusion proofs: the columns of ``m.leaves``, the subroot, and per level, from the leaf's run up to the root,
    ``slots`` (place in its run) and ``siblings`` (hex digests of the run's others, joined)."""
    none = m.tops[-1].select("tree", F.array().cast("array<int>").alias("slots"), F.array().cast("array<string>").alias("siblings"))
    tops = _with_paths(m.tops, none, m.levels)
    crown = _paths(m.subroots.select(F.lit(-1).cast("long").alias("tree"), "pos", F.col("tree").alias("_tree"), "subroot"), tops, m.levels)
    crown = keep(crown.select(F.col("_tree").alias("tree"), "subroot", "slots", "siblings"))
    d = _paths(m.leaves, _with_paths(m.tiers, crown.drop("subroot"), m.levels), m.levels)
    return d.join(crown.select("tree", "subroot"), "tree")


def fold(leaf: str | Column, slots: str = "slots", siblings: str = "siblings") -> Column:
    """The root that a leaf's digest and its proof give."""
    leaf = F.col(leaf) if isinstance(leaf, str) else leaf
    width = 2 * DIGEST

    def up(digest, level):
        cut = level["slot"] * width
        return F.sha2(F.concat(F.substring(level["others"], F.lit(1), cut), digest, F.substring(level["others"], cut + 1, F.lit(FAN * width))), 256)

    return F.aggregate(F.arrays_zip(F.col(slots).alias("slot"), F.col(siblings).alias("others")), leaf, up)


def verify(docs: DataFrame, changed: dict[str, Column], when: Column, **options) -> DataFrame:
    """Manifest of ``docs``, and a check of each row after ``changed`` columns replaced it where ``when`` holds.

    Returns key, leaf, subroot, root, proof_sha256 (of all siblings, left to right, level by level), folded_root (from
    the changed row's leaf and the original proof) and verified. A row whose condition is null is unchanged."""
    fields, key = options.get("fields", FIELDS), options.get("key", "doc_id")
    cols = {c: F.col(f"`{c}`") for c in fields}
    m = manifest(docs, {"now": F.when(when, leaf_of(cols | changed, fields))}, **options)
    p = proofs(m)
    root = F.lit(m.root).cast("string")
    p = p.select("key", "leaf", "subroot", root.alias("root"), F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
                 fold(F.coalesce("now", "leaf")).alias("folded_root"))
    return p.select(F.col("key").alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered(docs: DataFrame) -> DataFrame:
    """``verify`` after lower-casing A-Z in the texts whose id has a CRC-32 that 5 divides (a null id: never)."""
    return verify(docs, {"text": F.translate("text", UPPER, LOWER)}, F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0)


#: DuckDB has no CRC-32: bit by bit over the digits of {0}
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len({0}::VARCHAR) + 1), lambda i: ascii(substr({0}::VARCHAR, i::INT, 1))::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::BIGINT[]), lambda c, k: xor(c >> 1, (c & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)"""

_PART = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"

SQL = f"""
WITH RECURSIVE
docs AS (SELECT doc_id, source, sha256({' || '.join(map(_PART, FIELDS))}) AS leaf,
    CASE WHEN {CRC.format('doc_id')} % 5 = 0 THEN sha256({' || '.join(map(_PART, FIELDS[:-1]))} || {_PART(f"translate(text, '{UPPER}', '{LOWER}')")}) END AS now
  FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM docs),
t(tree, level, i, h, n) AS (SELECT tree, 0, pos, leaf, n FROM d
  UNION ALL SELECT tree, level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM t WHERE n > 1 GROUP BY tree, level, i // 16, n),
sub AS (SELECT tree, level, h FROM t WHERE n = 1),
top(level, i, h, n) AS (SELECT 0, tree, h, (SELECT count(*) FROM sub) FROM sub
  UNION ALL SELECT level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY level, i // 16, n),
nodes AS (SELECT tree, level, i, h FROM t WHERE n > 1 UNION ALL SELECT -1, level, i, h FROM top WHERE n > 1),
way AS (SELECT row_number() OVER () AS r, d.*, sub.level AS up FROM d JOIN sub USING (tree)),
steps AS (SELECT r, l AS level, tree, l AS at, pos // (16 ** l)::BIGINT AS i FROM way, range(8) AS x(l) WHERE l < up
  UNION ALL SELECT r, up + l, -1, l, tree // (16 ** l)::BIGINT FROM way, range(8) AS x(l) WHERE l < (SELECT max(level) FROM top)),
sib AS (SELECT s.r, s.level, nodes.i, nodes.h, s.i AS own FROM steps s JOIN nodes ON nodes.tree = s.tree AND nodes.level = s.at AND nodes.i // 16 = s.i // 16),
proof AS (SELECT r, sha256(coalesce(string_agg(h, '' ORDER BY level, i) FILTER (i <> own), '')) AS p FROM sib GROUP BY r),
runs AS (SELECT r, level, coalesce(string_agg(h, '' ORDER BY i) FILTER (i < own), '') AS a, coalesce(string_agg(h, '' ORDER BY i) FILTER (i > own), '') AS b
  FROM sib GROUP BY r, level),
f(r, level, h) AS (SELECT r, 0, coalesce(now, leaf) FROM way
  UNION ALL SELECT f.r, f.level + 1, sha256(a || h || b) FROM f JOIN runs ON runs.r = f.r AND runs.level = f.level),
folded AS (SELECT r, arg_max(h, level) AS h FROM f GROUP BY r)
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, coalesce(p, sha256('')) AS proof_sha256, folded.h AS folded_root, folded.h = top.h AS verified
FROM way JOIN sub USING (tree) JOIN folded USING (r) LEFT JOIN proof USING (r), top WHERE top.n = 1
"""
