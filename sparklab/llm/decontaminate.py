"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of whole documents in one task. Its words, reduced to the
alphabet of the benchmark, are indexed (suffix order, BWT, wavelet tree,
sampled suffix positions); the windows of all items are searched backwards
together, located, and merged into removal spans.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.llm.words import ALNUM, join_hash, pieces

WINDOW = 10
#: every so many suffix positions are kept; others walk back to one
SAMPLE = 8
#: bytes of text indexed together
SHARD_BYTES = 8 << 20
#: benchmark words broadcast together; a larger benchmark takes several passes
BLOCK_WORDS = 200_000
#: symbols that are no words: the end of the shard, and a break between runs
END, BREAK = 0, 1


class WaveletTree:
    """Rank queries over a sequence of symbols below ``2**bits``, stored level by level (a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.ones, self.zeros, self.bits = [], [], bits
        for b in range(bits - 1, -1, -1):
            bit = (symbols >> b) & 1
            ones = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        lo, hi = np.zeros_like(at), at
        for level, ones in enumerate(self.ones):
            bit = (symbol >> (self.bits - 1 - level)) & 1 == 1
            lo1, hi1 = ones[lo], ones[hi]
            lo, hi = np.where(bit, self.zeros[level] + lo1, lo - lo1), np.where(bit, self.zeros[level] + hi1, hi - hi1)
        return hi - lo


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling until all ranks differ."""
    n, size = len(symbols), 1
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    while True:
        ahead = np.zeros(n, dtype=np.int64)
        ahead[:max(0, n - size)] = rank[size:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if new[-1] == n - 1:
            return order
        rank[order] = new
        size *= 2


class FMIndex:
    """Backward search and location over a sequence of symbols whose last, and only its last, is 0."""

    def __init__(self, symbols: np.ndarray, top: int):
        order = suffix_order(symbols)
        bits = max(1, top.bit_length())
        self.bwt = symbols[order - 1]  # the suffix at 0 has the last symbol before it
        self.tree = WaveletTree(self.bwt, bits)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=1 << bits))])
        marked = order % SAMPLE == 0
        self.kept_before = np.concatenate([[0], np.cumsum(marked)])
        self.marked, self.kept = marked, order[marked]

    def extend(self, symbol, lo, hi):
        """Ranges of suffixes for patterns with one more symbol in front."""
        return self.below[symbol] + self.tree.rank(symbol, lo), self.below[symbol] + self.tree.rank(symbol, hi)


def search(symbols: np.ndarray, patterns: np.ndarray, lengths: np.ndarray):
    """(pattern, position) of every occurrence. ``patterns`` is right-aligned, one row each."""
    fm = FMIndex(symbols, int(max(symbols.max(), patterns.max())))
    lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(symbols), np.int64)
    live = np.arange(len(patterns))
    for step in range(patterns.shape[1]):
        more = live[lengths[live] > step]
        if not more.size:
            break
        s = patterns[more, patterns.shape[1] - 1 - step]
        lo[more], hi[more] = fm.extend(s, lo[more], hi[more])
        live = more[hi[more] > lo[more]]
    found = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(patterns)), found)
    row = np.repeat(lo, found) + np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found)
    # locate each row once: step back through the text until a sampled suffix
    rows, back = np.unique(row, return_inverse=True)
    at, steps, pos = rows.copy(), np.zeros(len(rows), np.int64), np.full(len(rows), -1)
    todo = np.arange(len(rows))
    while todo.size:
        hit = fm.marked[at[todo]]
        done = todo[hit]
        pos[done] = fm.kept[fm.kept_before[at[done]]] + steps[done]
        todo = todo[~hit]
        s = fm.bwt[at[todo]]
        at[todo] = fm.below[s] + fm.tree.rank(s, at[todo])
        steps[todo] += 1
    return which, pos[back]


class Block:
    """Windows of a bounded part of the benchmark, as symbols over its own alphabet."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        column = pa.array([t for _, t in items], pa.large_string())
        found: dict[tuple, set] = {}
        ids: dict[int, int] = {}
        for i, _, w in pieces(column, ALNUM, lower=True, limit=1 << 40):
            symbols = [ids.setdefault(h, len(ids) + 2) for h in w.hashes().tolist()]
            for k, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
                for s in range(a, max(a + 1, b - window + 1) if b > a else a):
                    found.setdefault(tuple(symbols[s:min(b, s + window)]), set()).add(items[i + k][0])
        self.items = [sorted(x) for x in found.values()]
        self.lengths = np.array([len(x) for x in found], dtype=np.int64)
        self.patterns = np.zeros((len(found), window), dtype=np.int64)
        for n, x in enumerate(found):
            self.patterns[n, window - len(x):] = x
        self.hash = np.array(sorted(ids), dtype=np.uint64)
        self.symbol = np.array([ids[h] for h in self.hash.tolist()], dtype=np.int64)
        pairs = {x[j:j + 2] for x in found for j in range(len(x) - 1)}
        own = np.zeros(len(ids) + 2, dtype=np.uint64)
        own[self.symbol] = self.hash
        p = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.pairs = np.sort(join_hash(own[p[:, 0]], own[p[:, 1]]))
        self.maybe = np.zeros(1 << 20, dtype=bool)  # a quick no for most pairs
        self.maybe[(self.pairs >> np.uint64(44)).astype(np.int64)] = True
        self.least = int(self.lengths.min()) if len(found) else 0

    def candidates(self, w) -> tuple[np.ndarray, np.ndarray]:
        """Words that can lie in a window, in runs, and their hashes.

        Neighbours in a window are neighbours in the benchmark, so words
        outside of runs of such pairs, as long as the shortest window, need no index.
        """
        h = w.hashes()
        if self.least == 0 or not w.n:
            return np.zeros(0, np.int64), h
        pair = join_hash(h[:-1], h[1:])
        linked = self.maybe[(pair >> np.uint64(44)).astype(np.int64)] & (w.left()[:-1] > 1)
        at = np.flatnonzero(linked)
        linked[at] = _among(pair[at], self.pairs)
        edge = np.flatnonzero(np.concatenate([[True], ~linked, [True]]))
        long = np.diff(edge) >= self.least  # runs edge[i]..edge[i+1]
        starts, sizes = edge[:-1][long], np.diff(edge)[long]
        at = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return at[_among(h[at], self.hash)] if self.least == 1 else at, h

    def find(self, w) -> tuple[np.ndarray, np.ndarray]:
        """(window, first word) of every occurrence in the texts of ``w``."""
        at, h = self.candidates(w)
        if not at.size:
            return at, at
        # a break wherever the words are not neighbours of one text
        cut = np.flatnonzero((np.diff(at) > 1) | (w.left()[at[:-1]] == 1)) + 1
        symbols = np.insert(self.symbol[np.searchsorted(self.hash, h[at])], cut, BREAK)
        word = np.insert(at, cut, -1)
        which, pos = search(np.append(symbols, [BREAK, END]), self.patterns, self.lengths)
        return which, word[pos]


def _among(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(x), dtype=bool)
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


def _pass(block, out_schema: pa.Schema):
    """Adds one block's occurrences to _spans (merged, in words), _cuts (the same in characters) and _items."""
    def run(batches):
        b = Block.__new__(Block)
        b.__dict__ = block.value
        for batch in batches:
            spans = [list(map(tuple, x)) for x in _pairs(batch["_spans"])]
            items = [set(x) for x in batch["_items"].to_pylist()]
            words = np.zeros(batch.num_rows, np.int64)
            cuts = [[] for _ in spans]
            for i, j, w in pieces(batch["_text"], ALNUM, lower=True, limit=SHARD_BYTES):
                words[i:j] = np.diff(w.first)
                which, at = b.find(w)
                doc = np.searchsorted(w.first, at, "right") - 1
                order = np.lexsort((at, doc))
                for n in order.tolist():
                    d, s = int(doc[n]), int(at[n] - w.first[doc[n]])
                    items[i + d].update(b.items[which[n]])
                    spans[i + d].append((s, s + int(b.lengths[which[n]])))
                for d in np.unique(doc).tolist():
                    spans[i + d] = merged(spans[i + d])
                for d in range(i, j):
                    if spans[d]:
                        base = w.first[d - i]
                        lead = (w.bytes[:-8] & 0xC0) != 0x80
                        low = w.text_start[d - i]
                        cuts[d] = [(int(lead[low:w.start[base + s]].sum()), int(lead[low:w.end[base + e - 1]].sum())) for s, e in spans[d]]
            out = [batch[c] if c not in ("_spans", "_items", "_words", "_cuts") else None for c in out_schema.names]
            own = {"_spans": [[{"s": s, "e": e} for s, e in x] for x in spans], "_cuts": [[{"s": s, "e": e} for s, e in x] for x in cuts],
                   "_items": [sorted(x) for x in items], "_words": words.tolist()}
            yield pa.RecordBatch.from_arrays([x if x is not None else pa.array(own[c], out_schema.field(c).type) for c, x in
                                              zip(out_schema.names, out, strict=True)], schema=out_schema)
    return run


def _pairs(column) -> list[list[tuple[int, int]]]:
    return [[(x["s"], x["e"]) for x in row] for row in column.to_pylist()]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def blocks(benchmark: DataFrame, window: int, block_words: int = BLOCK_WORDS):
    """Blocks of whole items, read from Spark row by row; each is bounded in words."""
    items, size = [], 0
    for r in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text").toLocalIterator():
        items.append((r[0], r[1] or ""))
        size += 1 + len(items[-1][1].split())
        if size >= block_words:
            yield Block(items, window)
            items, size = [], 0
    yield Block(items, window)


SPANS = "array<struct<s:int,e:int>>"


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``_words``, ``_spans`` (merged word spans), ``_cuts`` (the same
    in characters) and ``_items`` (ids as strings, sorted).

    No shuffle: documents stay in their tasks, each block of the benchmark is
    one more pass over them. Null text has no words. An item without words has
    no windows, an empty benchmark hits nothing; items sharing an id are one
    item; rows with null or repeated doc_ids are documents of their own.
    """
    spark = docs.sparkSession
    names = [f"_c{i}" for i in range(len(docs.columns))]
    d = docs.toDF(*names).select(
        *names, F.coalesce(F.col(names[docs.columns.index("text")]), F.lit("")).alias("_text"),
        F.lit(0).cast("bigint").alias("_words"), F.array().cast(SPANS).alias("_spans"), F.array().cast(SPANS).alias("_cuts"),
        F.array().cast("array<string>").alias("_items"))
    from pyspark.sql.pandas.types import to_arrow_schema

    for b in blocks(benchmark, window):
        d = d.mapInArrow(_pass(spark.sparkContext.broadcast(vars(b)), to_arrow_schema(d.schema)), d.schema)
    return d.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)], "_words", "_spans", "_cuts", "_items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Digest per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (see ``occurrences``)."""
    d = occurrences(docs.select("doc_id", "text"), benchmark, window)
    hit = F.aggregate("_spans", F.lit(0), lambda acc, s: acc + s["e"] - s["s"]).cast("long")
    return d.select("doc_id", F.col("_words").alias("n_words"), hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
                    F.sha2(F.encode(F.array_join("_items", ","), "UTF-8"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the merged spans cut out of ``text``; rows and other columns stay as they are.

    A cut runs from the first to the last character of the hit words; the text
    before and after it is kept unchanged. Null text stays null.
    """
    d = occurrences(docs, benchmark, window)
    gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), F.transform("_cuts", lambda c: c["e"])).alias("a"),
                        F.concat(F.transform("_cuts", lambda c: c["s"]), F.array(F.length("text"))).alias("b"))
    kept = F.array_join(F.transform(gaps, lambda g: F.substring(F.col("text"), g["a"] + 1, g["b"] - g["a"])), "")
    text = F.when(F.size("_cuts") == 0, F.col("text")).otherwise(kept)
    return d.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
