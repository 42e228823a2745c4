"""Language-model scores: a hashed maximum-entropy model over words.

P(word | context) = P(class | context) * P(member | class, context) * P(word | slot).
A word's hash names its class and its member number; both factors are
softmaxes over hashed n-gram and skip features of the two words before. A slot
is a (class, member) pair; within it, words have add-one counts, with one more
event for unknown words, so all probabilities add up to one.

Counts are exact: each block of documents fetches the counts of its own words
through a join, so no vocabulary is broadcast. The weights, of fixed size, are
trained by tasks that walk over all training documents from the same start;
their updates are averaged per round, weighted by tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.llm.common import keep, with_rows
from sparklab.llm.toxicity import held_out
from sparklab.llm.words import PLAIN, join_hash, mix, pieces, signed

CLASSES = MEMBERS = 32
#: hashed feature rows for the class factor and for the member factor
CLASS_ROWS, MEMBER_ROWS = 1 << 13, 1 << 14
ROUNDS = 2
RATE, FIRST_SQUARE, SHARE = 0.3, 1.0, 8
BATCH = 8192
#: rows that come so often in a batch are summed one by one, the others occurrence by occurrence
OFTEN = 8
#: rows of a block: what one task scores together
BLOCK_BITS = 11
END, BOS = np.uint64(0x6A09E667F3BCC908), np.uint64(0xBB67AE8584CAA73B)
FEATURES = 4  # none (bias), word before, the one before that (skip), both (n-gram)


def tokens(w) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts with an end after each text, and where each text starts."""
    t = np.insert(w.hashes(), w.first[1:], END)
    return t, w.first + np.arange(len(w.first))


def contexts(t: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashed context features of every token, one row each."""
    one = np.concatenate([[BOS], t[:-1]])
    one[first[:-1]] = BOS
    two = np.concatenate([[BOS], one[:-1]])
    two[first[:-1]] = BOS
    return np.stack([mix(one ^ BOS), mix(two ^ END), join_hash(two, one)])


def slots(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (t % np.uint64(CLASSES)).astype(np.int64), (t // np.uint64(CLASSES) % np.uint64(MEMBERS)).astype(np.int64)


def _rows(ctx, cls):
    """Weight rows of the class factor, and of the member factor given the class.

    16-bit row numbers, so that sorting them is a radix sort."""
    hashed = (ctx % np.uint64(CLASS_ROWS - 1)).astype(np.uint16) + np.uint16(1)
    top = np.concatenate([np.zeros((1, len(cls)), np.uint16), hashed])
    hashed = (mix(ctx + cls.astype(np.uint64) * END) % np.uint64(MEMBER_ROWS - CLASSES)).astype(np.uint16) + np.uint16(CLASSES)
    under = np.concatenate([cls.astype(np.uint16)[None], hashed])
    return top, under


def _logits(weights, rows):
    z = np.take(weights, rows[0], axis=0)
    for r in rows[1:]:
        z += np.take(weights, r, axis=0)
    z -= z.max(axis=1, keepdims=True)
    return z


def _log_softmax(weights, rows):
    z = _logits(weights, rows)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _step(weights, square, rows, target, rate):
    """One Adagrad update from a batch, with one step size a row; gradients of equal rows are summed first."""
    g = _logits(weights, rows)
    np.exp(g, out=g)
    g /= g.sum(axis=1, keepdims=True)
    g[np.arange(len(target)), target] -= 1.0

    bias = rows[0]  # few rows that come very often: one product
    many = np.zeros((int(bias.max()) + 1, len(bias)), np.float32)
    many[bias, np.arange(len(bias))] = 1
    sums = [(np.arange(len(many)), many @ g)]
    for row in rows[1:]:
        order = np.argsort(row, kind="stable")
        r = row[order]
        new = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        s = np.take(g, order[new], axis=0)
        size = np.diff(new, append=len(r))
        for i in np.flatnonzero(size > OFTEN):
            s[i] = g[order[new[i]:new[i] + size[i]]].sum(axis=0)
        some = np.flatnonzero((size > 1) & (size <= OFTEN))
        for k in range(1, OFTEN):  # second occurrences, third ones, ...
            some = some[size[some] > k]
            s[some] += np.take(g, order[new[some] + k], axis=0)
        sums.append((r[new], s))
    for at, s in sums:
        q = square[at] + np.einsum("ij,ij->i", s, s)[:, None] / SHARE
        square[at] = q
        s *= rate / np.sqrt(q)
        weights[at] -= s


def _learn(model, square, t, first):
    ctx, (cls, member) = contexts(t, first), slots(t)
    for i in range(0, len(t), BATCH):
        part = slice(i, i + BATCH)
        top, under = _rows(ctx[:, part], cls[part])
        _step(model[0], square[0], top, cls[part], RATE)
        _step(model[1], square[1], under, member[part], RATE)


def _log_probs(model, t, first):
    """Natural log of P(slot | context) of every token."""
    out = np.empty(len(t))
    ctx, (cls, member) = contexts(t, first), slots(t)
    for i in range(0, len(t), BATCH):
        part = slice(i, i + BATCH)
        top, under = _rows(ctx[:, part], cls[part])
        n = np.arange(top.shape[1])
        out[part] = _log_softmax(model[0], top)[n, cls[part]] + _log_softmax(model[1], under)[n, member[part]]
    return out


def _start(slot_n: np.ndarray):
    """Weights that give every slot its frequency in the training texts: the bias rows hold log shares."""
    n = slot_n.reshape(CLASSES, MEMBERS)
    top, under = np.zeros((CLASS_ROWS, CLASSES), np.float32), np.zeros((MEMBER_ROWS, MEMBERS), np.float32)
    top[0] = np.log((n.sum(axis=1) + 1) / (n.sum() + CLASSES))
    under[:CLASSES] = np.log((n + 1) / (n.sum(axis=1, keepdims=True) + MEMBERS))
    return top, under


def _train(start):
    """Walks over the texts of a task from the common weights; yields its weighted update row by row."""
    def run(batches):
        model = tuple(x.copy() for x in start.value)
        square = tuple(np.full((len(x), 1), FIRST_SQUARE, np.float32) for x in model)
        seen = 0
        for batch in batches:
            for _, _, w in pieces(batch["_text"], PLAIN, lower=True, limit=1 << 20):
                t, first = tokens(w)
                _learn(model, square, t, first)
                seen += len(t)
        if seen:
            at = 0
            for now, was in zip(model, start.value, strict=True):
                d = (now - was) * np.float32(seen)
                for i in range(0, len(d), 2048):
                    yield pa.RecordBatch.from_arrays([pa.array(range(at + i, at + i + len(d[i:i + 2048])), pa.int32()),
                                                      pa.array([x.tobytes() for x in d[i:i + 2048]], pa.binary()),
                                                      pa.array([seen] * len(d[i:i + 2048]), pa.int64())], names=["row", "d", "n"])
                at += len(d)
    return run


def _sum(batches):
    """Sums the updates of the rows of this partition."""
    total: dict[int, list] = {}
    for b in batches:
        for row, d, n in zip(b["row"].to_pylist(), b["d"].to_pylist(), b["n"].to_pylist(), strict=True):
            x = total.setdefault(row, [np.zeros(len(d) // 4), 0])
            x[0] += np.frombuffer(d, np.float32)
            x[1] += n
    yield pa.RecordBatch.from_pydict({"row": pa.array(list(total), pa.int32()), "d": pa.array([x[0].astype(np.float32).tobytes() for x in total.values()], pa.binary()),
                                      "n": pa.array([x[1] for x in total.values()], pa.int64())})


def train(docs: DataFrame, slot_n: np.ndarray, rounds: int = ROUNDS):
    """Weights, from the slots' frequencies on, after one walk over all of ``docs(_row, _text)``, a part of them in each round."""
    spark, model = docs.sparkSession, _start(slot_n)
    for k in range(rounds):
        part = docs.where(F.pmod(F.xxhash64("_row"), F.lit(rounds)) == k).select("_text")
        start = spark.sparkContext.broadcast(model)
        updates = part.mapInArrow(_train(start), "row int, d binary, n long").repartition(8, "row").mapInArrow(_sum, "row int, d binary, n long")
        model = tuple(x.copy() for x in model)
        flat = updates.toArrow()
        for row, d, n in zip(flat["row"].to_pylist(), flat["d"].to_pylist(), flat["n"].to_pylist(), strict=True):
            x, r = (model[0], row) if row < CLASS_ROWS else (model[1], row - CLASS_ROWS)
            x[r] += np.frombuffer(d, np.float32) / np.float32(n)
    return model


def _words(batches):
    """Distinct tokens of each block with their count in training texts; a batch's tokens are counted piece by piece."""
    for batch in batches:
        block, train_ = batch["_block"].to_numpy(), batch["_train"].to_numpy(zero_copy_only=False)
        found: dict[int, list] = {}
        for i, j, w in pieces(batch["_text"], PLAIN, lower=True, limit=1 << 20):
            t, first = tokens(w)
            cuts = np.flatnonzero(np.diff(block[i:j], prepend=-1, append=-1))
            for d, e in zip(cuts[:-1], cuts[1:], strict=True):  # texts of one block
                h, back = np.unique(t[first[d]:first[e]], return_inverse=True)
                n = np.repeat(train_[i + d:i + e], np.diff(first[d:e + 1]))
                found.setdefault(int(block[i + d]), []).append((h, np.bincount(back, n, len(h)).astype(np.int64)))
        for k in sorted(found):
            t, n = (np.concatenate(x) for x in zip(*found.pop(k), strict=True))
            h, back = np.unique(t, return_inverse=True)
            yield pa.RecordBatch.from_pydict({"_block": np.full(len(h), k), "h": signed(h),
                                              "c": np.bincount(back, n, len(h)).astype(np.int64)})


def _score(model, stats):
    total, known, slot_n, slot_v = stats

    def run(words: pa.Table, texts: pa.Table) -> pa.Table:
        weights = model.value
        h = words["h"].combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64) if words.num_rows else np.zeros(0, np.uint64)
        c = words["n"].combine_chunks().to_numpy(zero_copy_only=False) if words.num_rows else np.zeros(0, np.int64)
        order = np.argsort(h)
        h, c = h[order], c[order]
        out = []
        for i, j, w in pieces(texts["_text"], PLAIN, lower=True, limit=1 << 20):
            t, first = tokens(w)
            n = c[np.searchsorted(h, t)].astype(np.float64)
            cls, member = slots(t)
            slot = cls * MEMBERS + member
            inside = np.log10((n + 1) / (slot_n[slot] + slot_v[slot] + 1))
            lp = _log_probs(weights, t, first) / np.log(10) + inside
            base = np.log10((n + 1) / (total + known + 1))
            doc = np.repeat(np.arange(j - i), np.diff(first))
            out.append((np.diff(first), np.bincount(doc, n > 0, j - i).astype(np.int64), np.bincount(doc, base, j - i), np.bincount(doc, lp, j - i)))
        a = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.table({"doc_id": texts["doc_id"], "held_out": texts["held_out"], "n_tokens": a[0], "n_known": a[1],
                         "train_tokens": np.full(len(a[0]), total), "base_score": a[2], "score": a[3]})
    return run


def score(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    Counts and weights come from the rows that are not held out; a null id is
    never held out. A null or empty text has one token, its end. Rows with
    repeated doc_ids are documents of their own and count as such. Words are
    told apart by a 64-bit hash. Rows go by the scan's own numbers, see ``with_rows``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    d = with_rows(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")), "_row")
    d = d.withColumn("_block", F.shiftright("_row", BLOCK_BITS)).withColumn("held_out", held_out(F.col("doc_id"), folds, fold))
    words = keep(d.select("_block", "_text", (~F.col("held_out")).cast("long").alias("_train")).mapInArrow(_words, "_block long, h long, c long"))
    counts = keep(words.groupBy("h").agg(F.sum("c").alias("n")))
    slot_n, slot_v = np.zeros(CLASSES * MEMBERS), np.zeros(CLASSES * MEMBERS)
    low = F.col("h").bitwiseAND(CLASSES * MEMBERS - 1)  # the bits that name the slot
    for r in counts.where("n > 0").groupBy(low.alias("s")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        cls, member = r["s"] % CLASSES, r["s"] // CLASSES
        slot_n[cls * MEMBERS + member], slot_v[cls * MEMBERS + member] = r["n"], r["v"]
    stats = int(slot_n.sum()), int(slot_v.sum()), slot_n, slot_v
    model = docs.sparkSession.sparkContext.broadcast(train(d.where(~F.col("held_out")).select("_row", "_text"), slot_n))
    own = words.select("_block", "h").join(counts, "h").select("_block", "h", "n")
    texts = d.select("_block", "doc_id", "held_out", "_text")
    return own.groupBy("_block").cogroup(texts.groupBy("_block")).applyInArrow(
        _score(model, stats), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
