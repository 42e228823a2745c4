"""Prefix trie of conversations by whole-sequence collapse.

Identical conversations become one weighted sequence; sequences that are a
proper prefix of another are no leaves (anti-join); nodes are the weighted
prefixes. A prefix is named by 128 bits: the XOR of a hash of (position, turn)
over its turns, so names are running aggregates of narrow rows, can be added
up block by block, and texts are hashed once and never shuffled. Sums over
subtrees are suffix sums along the leaf sequences: every node is charged to
one leaf sequence below it, so the rows stay as many as the turns.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.common import keep
from sparklab.llm.merkle import CRC
from sparklab.operators.relational import rank_within_groups

#: Conversations share their start with the one whose id is their own less the rest by this; turns shared are a CRC-32 by that
SHARED, MOST = 5, 9
#: running values along a conversation are taken in blocks of so many turns, then carried from block to block
BLOCK = 4096
#: bytes of joined ids hashed at a time
CHUNK = 1 << 16


def turn_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns without their texts: conv, pos (from 0, by turn, null first; ties by role, then the text's MD5), digest, bytes.

    A null role or text counts as empty. Equal rows are turns of their own; rows without a conversation id belong to
    no conversation and are left out."""
    r, t = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text))
    d = rows.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), r.alias("role"), F.md5(F.encode(t, "UTF-8")).alias("tie"),
        F.unhex(F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t), 256)).alias("digest"), F.octet_length(t).cast("long").alias("bytes"))
    return keep(rank_within_groups(keep(d), "conv", ["turn", "role", "tie"], "pos").select("conv", "pos", "digest", "bytes"))


def sequences(turns: DataFrame) -> DataFrame:
    """``turns`` with ``x`` and ``y``, the hashes of (position, turn) that prefixes are named by."""
    return turns.withColumns({n: F.xxhash64(F.lit(i), "pos", "digest") for i, n in enumerate("xy")})


def rebuild(turns: DataFrame, shared: int = SHARED, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first h turns of another one: (lengths(conv, length), turns as above).

    The other one is conv - conv % shared, h the CRC-32 of conv % most; its turns are taken as far as it has them
    (none if it isn't there), then come conv's own turns after its first h."""
    sizes = keep(turns.groupBy("conv").agg(F.count("*").alias("n")))
    base = F.col("conv") - F.pmod(F.col("conv"), F.lit(shared))
    c = sizes.select("conv", "n", base.alias("base"), (F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % most).alias("h"))
    c = c.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("_has")), "base", "left")
    c = keep(c.withColumn("k", F.least("h", F.coalesce("_has", F.lit(0)))).select("conv", "base", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    own = turns.join(c.select("conv", "h", "k"), "conv").where("pos >= h").select("conv", (F.col("k") + F.col("pos") - F.col("h")).alias("pos"), "digest", "bytes")
    first = turns.where(F.col("pos") < most).withColumnRenamed("conv", "base").join(c.select("conv", "base", "h"), "base").where("pos < h")
    return c.select("conv", "length"), keep(own.unionByName(first.select("conv", "pos", "digest", "bytes")))


def _along(d: DataFrame, values: dict[str, tuple], last_first: bool = False) -> DataFrame:
    """Running aggregates of ``d`` along pos within ``seq``: {name: (aggregate, column)}, own row included.

    In blocks of BLOCK turns first, so a conversation with a third of all turns is not one task's; then each block
    takes up what the blocks before it (behind it, if ``last_first``) come to."""
    d = d.withColumn("_block", F.floor(F.col("pos") / BLOCK))
    order = (lambda c: F.col(c).desc()) if last_first else F.col
    block = d.groupBy("seq", "_block").agg(*[f(c).alias(f"_{n}") for n, (f, c) in values.items()])
    before = Window.partitionBy("seq").orderBy(order("_block")).rowsBetween(Window.unboundedPreceding, -1)
    block = block.select("seq", "_block", *[f(f"_{n}").over(before).alias(f"_{n}") for n, (f, _) in values.items()])
    inside = Window.partitionBy("seq", "_block").orderBy(order("pos")).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({n: f(c).over(inside) for n, (f, c) in values.items()}).join(block, ["seq", "_block"])
    both = {F.bit_xor: lambda a, b: a.bitwiseXOR(b), F.sum: lambda a, b: a + b}
    zero = {F.bit_xor: F.lit(0).cast("long"), F.sum: F.lit(0).cast("decimal(38,0)")}
    return d.withColumns({n: both[f](F.col(n), F.coalesce(F.col(f"_{n}"), zero[f])) for n, (f, _) in values.items()}).drop("_block", *[f"_{n}" for n in values])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(x, y, depth, ends_sha256) of ``ends(x, y, depth, conv)``: digest of the ids, ascending, decimal, comma-joined.

    Rows are range-partitioned and sorted, so the ids of one sequence that a third of all conversations follow are
    joined to chunks by many tasks; the digest then runs over the chunks in their order."""
    key = ["x", "y", "depth"]
    n = max(int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    d = ends.repartitionByRange(n, *key, "conv").sortWithinPartitions(*key, "conv")
    kind = T.StructType([*[ends.schema[k] for k in key], T.StructField("first", T.LongType()), T.StructField("ids", T.StringType())])

    def table(rows, schema):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], schema)

    def join(batches):
        now, first, held, size = None, None, [], 0
        for b in batches:
            done = []
            for x, y, depth, c in zip(*[b[k].to_pylist() for k in (*key, "conv")], strict=True):
                if (x, y, depth) != now or size >= CHUNK:
                    if held:
                        done.append((*now, first, ",".join(held)))
                    now, first, held, size = (x, y, depth), c, [], 0
                held.append(str(c))
                size += len(held[-1]) + 1
            if done:
                yield table(done, kind.names)
        if held:
            yield table([(*now, first, ",".join(held))], kind.names)

    chunks = keep(d.mapInArrow(join, kind))
    chunks = chunks.repartition(*key).sortWithinPartitions(*key, "first")
    kind2 = T.StructType([*kind.fields[:3], T.StructField("ends_sha256", T.StringType())])

    def digest(batches):
        now, h = None, None
        for b in batches:
            done = []
            for x, y, depth, ids in zip(*[b[k].to_pylist() for k in (*key, "ids")], strict=True):
                if (x, y, depth) != now:
                    if now is not None:
                        done.append((*now, h.hexdigest()))
                    now, h = (x, y, depth), hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.encode())
            if done:
                yield table(done, kind2.names)
        if now is not None:
            yield table([(*now, h.hexdigest())], kind2.names)

    return chunks.mapInArrow(digest, kind2)


def build(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per trie node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256, from conversations (conv, length) and their turns (conv, pos, digest, bytes).

    The root (depth 0) is there if any conversation is. ``saved_tokens`` is the sum, over the node's subtree, of
    (n_convs - 1) times the bytes of a node's last text."""
    none = F.lit(0).cast("long")
    turns = sequences(turns)
    # identical conversations become one sequence, named by its smallest member
    whole = turns.groupBy("conv").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    whole = keep(lengths.join(whole, "conv", "left").select("conv", F.col("length").alias("depth"), F.coalesce("x", none).alias("x"), F.coalesce("y", none).alias("y")))
    key = ["x", "y", "depth"]
    seqs = keep(whole.groupBy(*key).agg(F.min("conv").alias("seq"), F.count("*").alias("weight")))
    # their prefixes
    own = turns.join(seqs.select(F.col("seq").alias("conv"), "seq", "weight"), "conv").select("seq", "weight", "pos", "bytes", "x", "y")
    prefixes = _along(own, {n: (F.bit_xor, n) for n in "xy"}).select("seq", "weight", (F.col("pos") + 1).alias("depth"), "x", "y", "bytes")
    roots = seqs.select("seq", "weight", none.alias("depth"), none.alias("x"), none.alias("y"), none.alias("bytes"))
    prefixes = keep(prefixes.unionByName(roots))
    # sequences that are a proper prefix of another are no leaves
    length = seqs.select("seq", F.col("depth").alias("length"))
    proper = prefixes.join(length, "seq").where("depth < length").groupBy(*key).agg(F.lit(True).alias("inner"))
    leaves = keep(seqs.join(keep(proper), key, "left_anti").select("seq", F.lit(True).alias("leaf")))
    prefixes = prefixes.join(leaves, "seq", "left")
    # nodes: weighted prefixes; one leaf sequence below each stands for it in sums over subtrees
    nodes = prefixes.groupBy(*key).agg(F.sum("weight").alias("n_convs"), F.min("seq").alias("conv_id"), F.max("bytes").alias("bytes"),
                                       F.count("leaf").alias("n_leaves"), F.min(F.when(F.col("leaf"), F.col("seq"))).alias("charged"))
    nodes = keep(nodes)
    path = prefixes.where("leaf").select("seq", *key).join(nodes, key)
    mine = F.col("seq") == F.col("charged")
    path = keep(path.select("seq", *key, F.col("depth").alias("pos"), "conv_id", mine.alias("mine"),
                            F.when(mine, (F.col("n_convs") - 1).cast("decimal(38,0)") * F.col("bytes")).otherwise(0).cast("decimal(38,0)").alias("value")))
    # the neighbours along a leaf sequence are a node's parent and child
    up = path.select("seq", (F.col("pos") + 1).alias("pos"), F.col("conv_id").alias("parent_conv_id"))
    down = path.select("seq", (F.col("pos") - 1).alias("pos"), F.col("mine").cast("int").alias("child"))
    sums = _along(path, {"saved": (F.sum, "value")}, last_first=True).join(up, ["seq", "pos"], "left").join(down, ["seq", "pos"], "left")
    sums = sums.groupBy(*key).agg(F.sum("saved").cast("long").alias("saved_tokens"), F.max("parent_conv_id").alias("parent_conv_id"),
                                  F.coalesce(F.sum("child"), none).alias("n_children"))
    one = whole.join(seqs.where("weight > 1").select(*key), key, "left_semi")
    ends = ends_digest(one).unionByName(seqs.where("weight = 1").select(*key, _sha(F.col("seq").cast("string")).alias("ends_sha256")))
    return nodes.join(keep(sums), key).join(keep(ends), key, "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n_convs").cast("long").alias("n_convs"), "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", _sha(F.lit(""))).alias("ends_sha256"))


def _sha(c: Column) -> Column:
    return F.sha2(F.encode(c, "UTF-8"), 256)


def prefix_trie(rows: DataFrame, shared: int = SHARED, most: int = MOST) -> DataFrame:
    """The trie of the rebuilt conversations of ``rows(conv_id, turn, role, text)``; see ``turn_rows``, ``rebuild``, ``build``.

    Texts of any length count by digest and byte length; extra columns are ignored; an empty table gives no rows."""
    return build(*rebuild(turn_rows(rows), shared, most))


SQL = f"""
WITH r AS (SELECT conv_id, sha256(strlen(role)::VARCHAR || ':' || role || text) AS h, strlen(text) AS b,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) - 1 AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
s AS (SELECT conv_id, count(*) AS n, {CRC.format('conv_id')} % {MOST} AS h FROM r GROUP BY conv_id),
c AS (SELECT s.conv_id AS c, s.conv_id - s.conv_id % {SHARED} AS base, s.h AS cut, least(s.h, coalesce(o.n, 0)) AS k FROM s LEFT JOIN s o ON o.conv_id = s.conv_id - s.conv_id % {SHARED}),
t AS (SELECT c, k + pos - cut AS p, h, b FROM c JOIN r ON conv_id = c WHERE pos >= cut UNION ALL SELECT c, pos, h, b FROM c JOIN r ON conv_id = base WHERE pos < cut),
pre AS (SELECT c, p + 1 AS depth, string_agg(h, '') OVER (PARTITION BY c ORDER BY p) AS way, b FROM t UNION ALL SELECT c, 0, '', 0 FROM c),
tip AS (SELECT c, max(depth) AS depth FROM pre GROUP BY c),
node AS (SELECT pre.depth AS depth, way, min(c) AS conv_id, count(*) AS n, max(b) AS b,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (tip.depth = pre.depth), '') AS ends FROM pre JOIN tip USING (c) GROUP BY pre.depth, way),
kids AS (SELECT left(way, 64 * (depth - 1)::INT) AS way, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
sub AS (SELECT a.way, count(*) FILTER (d.way NOT IN (SELECT way FROM kids)) AS n_leaves, sum((d.n - 1) * d.b) AS saved
  FROM node a JOIN node d ON starts_with(d.way, a.way) GROUP BY a.way)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0) AS n_children, n_leaves,
  saved::BIGINT AS saved_tokens, sha256(node.ends) AS ends_sha256
FROM node JOIN sub USING (way) LEFT JOIN kids USING (way) LEFT JOIN node parent ON parent.depth = node.depth - 1 AND parent.way = left(node.way, 64 * (node.depth - 1)::INT)
"""
