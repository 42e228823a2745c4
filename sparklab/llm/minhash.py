"""Near-dedup by a chosen-path set similarity join.

Equal shingle sets are one class. In each of ``TREES`` independent trees the
classes branch by their minwise token of the level, while a node holds more
than ``LEAF`` and the level is not the last. Two sets of similarity s share a node at depth d of a tree with
probability s**d; the deeper a level, the more trees its classes are in
(``DEEP``), so that at 0.8 a level misses a pair with probability of 2e-5 at
most. Within a node, sizes and sketches say which classes may be linked. No
such pairs are listed: each class names its closest partner, partners make
homes, and the full sets of a home are compared inside one task, block by
block if there are many. Nodes then name the pairs of blocks in which classes
of different components may still be linked.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.llm.common import components, free_name, keep, with_rows
from sparklab.llm.words import PLAIN, grams, pieces, signed

TREES, LEVELS, LEAF = 16, 8, 64
FIRST_LEVEL, LAST_LEVEL = 2, 4
#: classes of a node of the last level that are still compared there
LAST_LEAF = 512
#: classes that are compared at once; members of a large home that each of its blocks is compared with
BLOCK, COMMON = 256, 16
#: trees at the deeper levels; those beyond TREES take their tokens from all places at random
DEEP = {4: 24}
#: sketches of 128 bits differ in (1 - s) / 2 of them; at 0.8 that is 12.8 (sd 3.4), a candidate may differ in up to 30
MOST_BITS = 30

_RNG = np.random.default_rng(20)
_A = _RNG.integers(1, 1 << 63, TREES * LEVELS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, TREES * LEVELS, dtype=np.uint64)
#: places of the tokens of each tree, level by level
PLACES = np.concatenate([np.arange(TREES * LEVELS).reshape(TREES, LEVELS),
                         [np.random.default_rng(21 + t).permutation(TREES * LEVELS)[:LEVELS] for t in range(DEEP[LAST_LEVEL] - TREES)]])


def shingle_sets(column, k: int):
    """The sorted set of hashed ``k``-word shingles of every text, in order: all words as one if there are fewer, empty without words."""
    for _, _, w in pieces(column, PLAIN, lower=True):
        h = w.hashes()
        g = grams(h, k)
        for a, z in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            if z - a >= k:
                yield np.unique(g[a:z - k + 1])
            elif z > a:
                one = h[a:z]
                yield grams(one, z - a)[:1] ^ np.uint64(z - a)
            else:
                yield h[:0]


def _minima(s: np.ndarray) -> np.ndarray:
    out = np.full(len(_A), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(s), 4096):
        out = np.minimum(out, (s[i:i + 4096] * _A[:, None] + _B[:, None]).min(axis=1))
    return out


def _describe(k: int):
    """Per text: set size, 128-bit name of the set, 128-bit sketch, and one hashed token per tree and level."""
    m1, m2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

    def run(batches):
        for batch in batches:
            n, name, sketch, tokens = [], [], [], []
            for s in shingle_sets(batch["_text"], k):
                n.append(len(s))
                name.append((int(np.bitwise_xor.reduce(s * m1 ^ (s >> np.uint64(31)) * m2)) if len(s) else 0, int(s.sum(dtype=np.uint64))))
                v = _minima(s)
                bits = (v * m2 >> np.uint64(63)).astype(np.uint8)
                sketch.append(np.packbits(bits).view(">i8"))
                tokens.append((v >> np.uint64(32)).astype(np.uint32).view(np.int32))
            name = np.array(name, dtype=np.uint64).reshape(-1, 2)
            sketch = np.array(sketch, dtype=np.int64).reshape(-1, 2)
            tokens = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * len(_A), pa.int32()), pa.array(np.concatenate(tokens) if tokens else [], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch["_row"], batch["doc_id"], pa.array(n, pa.int64()), pa.array(signed(name[:, 0].copy())), pa.array(signed(name[:, 1].copy())),
                 pa.array(sketch[:, 0].copy()), pa.array(sketch[:, 1].copy()), tokens],
                names=["_row", "doc_id", "n", "k1", "k2", "s1", "s2", "tokens"])
    return run


def _whole(batches, key: str):
    """The rows of batches sorted by ``key``, regrouped so that no key's rows are parted: (table, first row of each key and the end)."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t])
        at = t[key].to_numpy()
        cut = int(np.searchsorted(at, at[-1])) if len(at) else 0
        rest = t.slice(cut)
        if cut:
            yield t.slice(0, cut).combine_chunks(), _starts(at[:cut])
    if rest is not None and len(rest):
        yield rest.combine_chunks(), _starts(rest[key].to_numpy())


def _starts(at: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)]])


def _close(t, starts: np.ndarray, percent: int):
    """Pairs of rows of one node whose sizes and sketches allow a link, by distance of the rows: (earlier, later, bits)."""
    n, s1, s2 = t["n"].to_numpy(), *(t[c].to_numpy().view(np.uint64) for c in ("s1", "s2"))
    end = np.repeat(starts[1:], np.diff(starts))
    at = np.arange(len(n))
    for d in range(1, int(np.diff(starts).max())):
        at = at[at + d < end[at]]
        x, y = at, at + d
        bits = np.bitwise_count(s1[x] ^ s1[y]).astype(np.int64) + np.bitwise_count(s2[x] ^ s2[y])
        ok = (bits <= MOST_BITS) & (np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent)
        yield x[ok], y[ok], bits[ok]


def _nearest(percent: int):
    """Per row its closest partner in the node of a smaller id, or of a larger one if there is none: (_id, larger, bits, other)."""
    def run(batches):
        for t, starts in _whole(batches, "node"):
            ids = t["_id"].to_numpy()
            none = np.iinfo(np.int64).max
            rank, other = np.full((2, len(ids)), none), np.zeros((2, len(ids)), np.int64)
            for x, y, bits in _close(t, starts, percent):
                for side, at, to in ((0, y, x), (1, x, y)):
                    better = bits < rank[side, at]
                    rank[side, at[better]], other[side, at[better]] = bits[better], ids[to[better]]
            larger = (rank[0] == none).astype(np.int64)
            pick = np.arange(len(ids))
            bits, other = rank[larger, pick], other[larger, pick]
            has = bits < none
            yield pa.RecordBatch.from_arrays([pa.array(v[has]) for v in (ids, larger, bits, other)], names=["_id", "larger", "bits", "other"])
    return run


def _crossing(percent: int):
    """Pairs of blocks (x, y) that hold classes of one node, close, and of different components."""
    def run(batches):
        for t, starts in _whole(batches, "node"):
            comp, block, wide = (t[c].to_numpy() for c in ("_c", "block", "wide"))
            found = [np.empty((0, 2), np.int64)]
            for x, y, _ in _close(t, starts, percent):
                ok = (comp[x] != comp[y]) & ((block[x] != block[y]) | (wide[x] > 0))
                p = np.sort(np.stack([block[x[ok]], block[y[ok]]], axis=1), axis=1)
                found.append(np.unique(p, axis=0) if len(p) else p)
            p = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(p[:, 0].copy()), pa.array(p[:, 1].copy())], names=["x", "y"])
    return run


def links_between(sets: list[np.ndarray], label: np.ndarray, percent: int):
    """Confirmed links (i, j) of a few sets that join what ``label`` holds apart, until all links between labels are used."""
    label = label.copy()
    sizes = np.array([len(s) for s in sets])
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")
    tokens, own = tokens[order], np.repeat(np.arange(len(sets)), sizes)[order]
    left = np.ones(len(sets), dtype=bool)
    while True:
        # whatever is left in the most frequent label needs no look at each other
        values, at, n = np.unique(label[left], return_inverse=True, return_counts=True)
        if len(values) < 2:
            return
        odd = np.flatnonzero(left)[at != n.argmax()]
        i = odd[0]
        left[i] = False
        lo, hi = np.searchsorted(tokens, sets[i], "left"), np.searchsorted(tokens, sets[i], "right")
        n = hi - lo
        both = np.bincount(own[np.repeat(hi - n.cumsum(), n) + np.arange(n.sum())], minlength=len(sets))
        linked = np.flatnonzero((100 * both >= percent * (sizes[i] + sizes - both)) & (label != label[i]))
        for j in linked[np.unique(label[linked], return_index=True)[1]]:
            yield int(i), int(j)
            label[label == label[j]] = label[i]


def _confirm(k: int, percent: int):
    """What links on the full sets join between the rows of a group that have different ``_c``: each with the smallest of its part (a, b, shared)."""
    def run(batches):
        for t, starts in _whole(batches, "group"):
            comp, shared = t["_c"].to_numpy(), t["shared"].to_numpy(zero_copy_only=False)
            out, sets = [], shingle_sets(t["_text"], k)
            for i, j in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                own = comp[i:j]
                least = own.copy()
                for x, y in links_between([next(sets) for _ in range(i, j)], own, percent):
                    least[(least == least[x]) | (least == least[y])] = min(least[x], least[y])
                at = np.unique(own, return_index=True)[1]
                at = at[least[at] != own[at]]
                out.append((own[at], least[at], shared[i:j][at]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip(*out, strict=True)], names=["a", "b", "shared"])
    return run


def _grouped(rows: DataFrame, key: str, run, schema: str) -> DataFrame:
    """``run`` over the rows, those of a key after one another, ascending by id."""
    return rows.repartition(key).sortWithinPartitions(key, "_id").mapInArrow(run, schema)


def chosen_paths(classes: DataFrame, percent: int):
    """The closest partner of each class (_id, other), the leaves and the nodes that stay large (both node, _id, n, s1, s2)."""
    narrow = ["_id", "n", "s1", "s2"]
    ids = classes.select(*narrow, "tokens")
    active = ids.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
    leaves = []
    for level in range(FIRST_LEVEL, LAST_LEVEL + 1):
        path = F.slice("tokens", F.col("tree") * LEVELS + 1, level)
        if level in DEEP:
            path = F.transform(F.slice(F.lit(PLACES.ravel().tolist()), F.col("tree") * LEVELS + 1, level), lambda p: F.element_at("tokens", p + 1))
        rows = active.select(*narrow, "tree", F.xxhash64("tree", path).alias("node"))
        size = rows.groupBy("node").agg(F.count("*").alias("_n")).where("_n > 1")
        rows = keep(rows.join(size, "node"))
        most = LAST_LEAF if level == LAST_LEVEL else LEAF
        leaves.append(rows.where(F.col("_n") <= most).select("node", *narrow))
        large = rows.where(F.col("_n") > most)
        if level == LAST_LEVEL or large.isEmpty():
            break
        # a pair may share large nodes in trees that part further down: its classes enter more trees
        trees = large.groupBy("_id").agg(F.collect_list("tree").alias("trees"))
        if level + 1 in DEEP:
            trees = trees.withColumn("trees", F.concat("trees", F.sequence(F.lit(DEEP.get(level, TREES)), F.lit(DEEP[level + 1] - 1))))
        nxt = keep(ids.join(trees, "_id"))
        ids = nxt.drop("trees")
        active = nxt.withColumn("tree", F.explode("trees")).drop("trees")
    leaves = reduce(DataFrame.unionByName, leaves)
    # large nodes are dealt out to look for a partner of each class; what the parts hold between them is left to the blocks
    part = F.xxhash64("node", F.pmod(F.xxhash64("_id"), F.ceil(F.col("_n") * 2 / LEAF)))
    near = _grouped(leaves.unionByName(large.select(part.alias("node"), *narrow)), "node", _nearest(percent), "_id long, larger long, bits long, other long")
    near = near.groupBy("_id").agg(F.min(F.struct("larger", "bits", "other")).alias("_best")).select("_id", F.col("_best.other").alias("other"))
    return keep(near), leaves, large.select("node", *narrow)


def _homes(near: DataFrame, rounds: int = 60) -> DataFrame:
    """(_id, home): every class follows closest partners of smaller ids to the last one, each round doubling the way.

    A class that has none of a smaller id goes on from the partner of its own
    partner, if that is smaller. One join a round, whatever the length of the
    ways that are left.
    """
    to = near.select(F.col("_id").alias("_at"), F.col("other").alias("_then"))
    onward = F.when(F.col("other") < F.col("_id"), F.least("other", "_then")).otherwise(F.least("_id", "_then"))
    tree = keep(near.join(to, F.col("other") == F.col("_at"), "left").select("_id", onward.alias("home")))
    for _ in range(rounds):
        to = tree.select(F.col("_id").alias("_at"), F.col("home").alias("_then"))
        tree = keep(tree.join(to, F.col("home") == F.col("_at")).select("_id", F.col("_then").alias("home"), (F.col("_then") < F.col("home")).alias("_on")))
        if tree.where("_on").isEmpty():
            return tree.drop("_on")
    raise RuntimeError(f"homes not found in {rounds} rounds")


def _dealt(n, *key):
    """Block of a class: its group, dealt out to parts of at most about ``BLOCK`` classes."""
    return F.xxhash64(*key, F.pmod(F.xxhash64("_id"), F.ceil(n / BLOCK)))


def linked_components(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(id, component) of classes, of all that have a link, by confirmed links that span every component.

    Classes that are joined by closest partners are a home. Homes are compared
    exhaustively on the full sets, large ones in blocks, each with a few
    members of the whole home. What nodes hold between different components of
    different blocks is then compared block by block.
    """
    near, leaves, large = chosen_paths(classes, percent)
    home = _homes(near)
    size = home.groupBy("home").agg(F.count("*").alias("_n"))
    home = keep(home.join(size, "home").withColumn("block", _dealt(F.col("_n"), "home")))
    texts = keep(docs.withColumnRenamed("_row", "_id").join(home.hint("shuffle_hash"), "_id").select("_id", "home", "_n", "block", "_text"))

    def confirm(rows):
        return keep(_grouped(rows.select("group", "_id", "_c", "shared", "_text"), "group", _confirm(k, percent), "a long, b long, shared boolean"))

    shared = ((F.col("_n") > BLOCK) & (F.pmod(F.xxhash64("_id", F.lit(1)), F.col("_n")) < COMMON)).alias("shared")
    own = texts.select(F.col("block").alias("group"), "_id", F.col("_id").alias("_c"), shared, "_text")
    common = texts.where(shared)
    common = common.withColumn("_part", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_n") / BLOCK).cast("int") - 1)))
    common = common.withColumn("group", F.xxhash64("home", F.col("_part").cast("long"))).where("`group` <> block")
    links = confirm(own.unionByName(common.select("group", "_id", F.col("_id").alias("_c"), F.lit(True).alias("shared"), "_text")))
    # a class that is in one block has its smallest there; only the members that blocks share lead on from one to another
    over = components(links.where("shared").select("a", "b")).select(F.col("id").alias("_at"), "component")
    inside = links.where("NOT shared").select(F.col("a").alias("_id"), F.col("b").alias("_first"))
    now = home.join(inside, "_id", "left").withColumn("_first", F.coalesce("_first", "_id")).join(over, F.col("_first") == F.col("_at"), "left")

    # blocks anew: those of a wide home's largest component hold nothing else
    now = keep(now.select("_id", "home", "_n", "block", F.coalesce("component", "_first").alias("_c")))
    most = now.where(F.col("_n") > BLOCK).groupBy("home", "_c").agg(F.count("*").alias("_k")).groupBy("home").agg(F.max(F.struct("_k", "_c")).alias("_main"))
    main = F.col("_c") == F.col("_main._c")
    again = _dealt(F.when(main, F.col("_main._k")).otherwise(F.col("_n") - F.col("_main._k")), "home", main)
    now = keep(now.join(most, "home", "left").select("_id", "_c", F.col("_main").isNotNull().cast("long").alias("wide"),
                                                     F.when(F.col("_main").isNull(), F.col("block")).otherwise(again).alias("block")))
    pairs = _grouped(leaves.join(now, "_id"), "node", _crossing(percent), "x long, y long")
    held = keep(large.join(now, "_id").groupBy("node", "block").agg(F.min("_c").alias("lo"), F.max("_c").alias("hi"), F.max("wide").alias("wide")))
    x, y = held.alias("x"), held.alias("y")
    apart = F.least("x.lo", "y.lo") < F.greatest("x.hi", "y.hi")
    both = x.join(y, (F.col("x.node") == F.col("y.node")) & apart & ((F.col("x.block") < F.col("y.block")) | (F.col("x.block") == F.col("y.block")) & (F.col("x.wide") > 0)))
    pairs = keep(pairs.unionByName(both.select(F.col("x.block").alias("x"), F.col("y.block").alias("y"))).distinct())
    comp = now.select(F.col("_id").alias("id"), F.col("_c").alias("component"))
    if pairs.isEmpty():
        return comp
    group = F.xxhash64("x", "y").alias("group")
    sides = pairs.select(group, F.col("x").alias("block")).unionByName(pairs.where("x <> y").select(group, F.col("y").alias("block")))
    rows = sides.join(now, "block").select("group", "_id", "_c").join(texts.select("_id", "_text"), "_id")
    more = confirm(rows.withColumn("shared", F.lit(True)))
    if more.isEmpty():
        return comp
    # what is joined anew are components, so only those are followed
    joined = components(more.select("a", "b")).select(F.col("id").alias("component"), F.col("component").alias("_joined"))
    return comp.join(joined, "component", "left").select("id", F.coalesce("_joined", "component").alias("component"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, row: str | None = None) -> DataFrame:
    """Per row of ``docs``: _row, doc_id, n_shingles, component_id, kept, first.

    Texts are linked if ``100 * |A & B| >= percent * |A | B|`` for their sets
    of ``k``-word shingles (lower-cased A-Z). ``component_id`` is the smallest
    doc_id of the component, ``kept`` whether it is the row's own; ``first``
    marks exactly one row of each component, also where doc_ids repeat.
    Texts that are null, empty or without words have an empty set and link
    with nothing. Null doc_ids count as larger than any other. Rows go
    by the scan's own numbers, see ``with_rows``, or by those in the column ``row``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit("")).alias("_text")
    d = docs.select(F.col(row).alias("_row"), "doc_id", text) if row else with_rows(docs.select("doc_id", text), "_row")
    rows = keep(d.mapInArrow(_describe(k), f"_row long, doc_id {kind}, n long, k1 long, k2 long, s1 long, s2 long, tokens array<int>"))
    name = ["n", "k1", "k2"]
    equal = keep(rows.where("n > 0").groupBy(name).agg(F.min("_row").alias("_id"), F.min("doc_id").alias("_least")))
    classes = rows.join(equal.select(F.col("_id").alias("_row")), "_row", "left_semi").withColumnRenamed("_row", "_id")
    comp = linked_components(d.select("_row", "_text"), keep(classes), k, percent)
    equal = keep(equal.join(comp.withColumnRenamed("id", "_id"), "_id", "left").withColumn("_comp", F.coalesce("component", "_id")).drop("component"))
    least = equal.groupBy("_comp").agg(F.min("_least").alias("_component"))
    equal = keep(equal.join(least, "_comp").select(*name, "_comp", "_component"))
    out = rows.select("_row", "doc_id", *name).join(equal, name, "left")
    out = out.withColumn("component_id", F.coalesce("_component", "doc_id"))
    out = out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    single = out.where("kept AND n > 0").groupBy("_comp").agg(F.min("_row").alias("_one"))
    out = keep(out).join(single, "_comp", "left")
    return out.select("_row", "doc_id", F.col("n").alias("n_shingles"), "component_id", "kept",
                      ((F.col("n") == 0) | (F.col("_row") == F.col("_one"))).alias("first"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id; see ``near_duplicates``."""
    row = free_name(docs, "_doc_row")
    d = with_rows(docs, row)
    first = near_duplicates(d, k, percent, row).where("first").select(F.col("_row").alias(row))
    return d.join(first.hint("shuffle_hash"), row, "left_semi").drop(row)
