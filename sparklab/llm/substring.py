"""Substring dedup by seed and extend on winnowed anchors.

Seeds: of every 35 consecutive words the anchor is the 8-word shingle with the
smallest hash (the last of equal ones), so two equal windows choose the same
anchor at the same offset. Documents are joined on their anchors; a seed is
extended both ways to the span of all windows that chose it. Spans that are
equal as a whole are repeats as a whole; where the spans of a seed differ,
their windows are compared one by one. What the repeated windows cover are the
maximal repeats of at least 35 words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.llm.common import keep, release, with_rows
from sparklab.llm.words import PLAIN, grams, join_hash, pieces, signed

WINDOW = 35
SEED = 8


def _choices(h: np.ndarray, left: np.ndarray, window: int, seed: int):
    """For every window start: its anchor's word. Starts without a whole window are left out."""
    starts = np.flatnonzero(left >= window)
    if not starts.size:
        return starts, starts
    g = grams(h, seed)
    best, size, most = np.arange(len(g)), 1, window - seed + 1

    def lower(i, j):  # the later of two places wins a tie
        return np.where(g[j] <= g[i], j, i)

    while size * 2 <= most:
        best = lower(best[:-size], best[size:])
        size *= 2
    if size < most:
        best = lower(best[:len(best) - (most - size)], best[most - size:])
    return starts, best[starts]


def _windows(w, window: int):
    """128 bits for the window at each word (meaningless where less is left)."""
    a, b = w.hashes(), w.hashes(1)
    return a, grams(a, window), grams(b, window)


def _seeds(window: int, seed: int):
    def run(batches):
        for batch in batches:
            rows = batch["_row"].to_numpy()
            for i, _, w in pieces(batch["_text"], PLAIN, limit=1 << 20):
                h, x, y = _windows(w, window)
                starts, anchor = _choices(h, w.left(), window, seed)
                if not starts.size:
                    continue
                doc = w.of()[starts]
                new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(doc) != 0)]))
                first, last = starts[new], starts[np.concatenate([new[1:], [len(starts)]]) - 1]
                g = grams(h, seed)[anchor[new]]
                # equal spans: first and last window are equal and as far apart
                shape = ((anchor[new] - first) * (2 * window) + last - first).astype(np.uint64)
                span = join_hash(join_hash(x[first], x[last]), join_hash(join_hash(y[first], y[last]), shape))
                place = (first - w.first[doc[new]]) * 64 + (last - first)
                yield pa.RecordBatch.from_pydict({"anchor": signed(g), "span": signed(span), "_row": rows[i + doc[new]], "place": place})
    return run


def _expand(window: int):
    """Windows of the open spans of a text: (x, y, _row, start)."""
    def run(batches):
        for batch in batches:
            rows, spans = batch["_row"].to_numpy(), batch["_open"]
            for i, j, w in pieces(batch["_text"], PLAIN, limit=1 << 20):
                _, x, y = _windows(w, window)
                own = spans.slice(i, j - i)
                p = own.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(j - i), [len(v) for v in own])
                n = p % 64 + 1
                s = np.repeat(p // 64, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                doc = np.repeat(doc, n)
                at = s + w.first[doc]
                yield pa.RecordBatch.from_pydict({"x": signed(x[at]), "y": signed(y[at]), "_row": rows[i + doc], "start": s})
    return run


def _cut(window: int, keep_text: bool):
    """Counts and kept words of whole texts; ``_runs`` holds start * 64 + further starts."""
    def run(batches):
        for batch in batches:
            rows = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
            for i, j, w in pieces(batch["_text"], PLAIN):
                for k in range(j - i):
                    a, z = int(w.first[k]), int(w.first[k + 1])
                    gone = np.zeros(z - a + 1, dtype=np.int64)
                    runs = batch["_runs"][i + k]
                    if runs.is_valid:
                        p = np.asarray(runs.values.to_numpy(zero_copy_only=False), dtype=np.int64)
                        np.add.at(gone, p // 64, 1)
                        np.add.at(gone, p // 64 + p % 64 + window, -1)
                    stay = np.cumsum(gone)[:-1] == 0
                    s, e = w.start[a:z][stay], w.end[a:z][stay]
                    raw = w.bytes.tobytes() if k == 0 else raw
                    text = b" ".join([raw[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)])
                    rows["n_words"].append(z - a)
                    rows["n_removed"].append(z - a - len(s))
                    rows["kept_sha256"].append(hashlib.sha256(text).hexdigest())
                    rows["kept"].append(text.decode("utf-8", "replace") if keep_text else None)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(rows["n_words"], pa.int64()), pa.array(rows["n_removed"], pa.int64()),
                                              pa.array(rows["kept_sha256"], pa.string()), pa.array(rows["kept"], pa.string())],
                                             names=["doc_id", *rows])
    return run


def repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Runs of repeated windows per row of ``docs(_row, doc_id, _text)``: (_row, _runs)."""
    found = keep(docs.select("_row", "_text").mapInArrow(_seeds(window, seed), "anchor long, span long, _row long, place long"))
    # aggregates are written before they are joined: then both sides of the
    # join are plain shuffles, and AQE splits an anchor or window that is hot
    shared = keep(found.groupBy("anchor").agg(F.count("*").alias("_n")).where("_n > 1").select("anchor"))
    shared = keep(found.join(shared, "anchor"))
    release(found)
    # per anchor: do all its spans agree? (map-side aggregates of longs)
    spans = keep(shared.groupBy("anchor").agg(F.min("span").alias("_a"), F.max("span").alias("_b")))
    placed = shared.join(spans, "anchor").select("_row", "place", (F.col("_a") == F.col("_b")).alias("_same"))
    per_row = keep(placed.groupBy("_row").agg(F.collect_list(F.when(F.col("_same"), F.col("place"))).alias("_runs"),
                                              F.collect_list(F.when(~F.col("_same"), F.col("place"))).alias("_open")))
    release(shared)
    opened = per_row.where(F.size("_open") > 0).select(F.col("_row").alias("_r"), "_open")
    texts = docs.select("_row", "_text").join(opened.hint("shuffle_hash"), F.col("_row") == F.col("_r")).select("_row", "_text", "_open")
    windows = keep(texts.mapInArrow(_expand(window), "x long, y long, _row long, start long"))
    twice = keep(windows.groupBy("x", "y").agg(F.count("*").alias("_n")).where("_n > 1").select("x", "y"))
    more = windows.join(twice, ["x", "y"]).groupBy("_row").agg(F.collect_list(F.col("start") * 64).alias("_runs"))
    return per_row.select("_row", "_runs").unionByName(more).groupBy("_row").agg(F.flatten(F.collect_list("_runs")).alias("_runs"))


def cut_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with ``keep_text``, the kept words.

    A word goes if a window of ``window`` words covering it starts anywhere
    else too, the same document included; all copies go, judged on the input.
    Words are separated as the contract says and otherwise unchanged. Null and
    empty texts have no words; texts shorter than a window lose none; rows with
    null or repeated doc_ids are documents of their own, so two equal rows are
    copies of each other. Other columns are not read. Rows go by the scan's own
    numbers, see ``with_rows``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    d = with_rows(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")), "_row")
    runs = repeats(d, window, seed).select(F.col("_row").alias("_r"), "_runs")
    d = d.join(runs.hint("shuffle_hash"), F.col("_row") == F.col("_r"), "left").select("doc_id", "_text", "_runs")
    d = d.mapInArrow(_cut(window, keep_text), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept string")
    return d if keep_text else d.drop("kept")
