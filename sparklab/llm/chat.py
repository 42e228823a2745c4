"""Chat formatting by token-level assembly.

Every turn's text is encoded on its own with a public byte-level vocabulary;
the marks of the template are reserved ids spliced between the segments, so no
text can produce one. As the output is also read as text, control strings
that occur in a text are escaped first: a backslash goes after their first
character, one more where backslashes stand there already, and reading takes
one away again. The loss mask follows from prefix sums over the marks.

Template: ``<s>`` once, then per turn ``[SYS]text[/SYS]`` (system),
``[INST]text[/INST]`` (user), ``text</s>`` (assistant) or
``[TURN]role[TEXT]text[/TURN]`` (any other role).
"""

from __future__ import annotations

import base64
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: byte-level vocabulary: lines of a base64 token and its rank
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how texts are split before the vocabulary's merges
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The template's marks; their ids follow the vocabulary's in this order
MARKS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[TURN]", "[TEXT]", "[/TURN]")
BOS, EOS, USER, USER_END, SYSTEM, SYSTEM_END, TURN, TEXT, TURN_END = range(len(MARKS))
#: a longer conversation is several rows of about so many tokens, cut between turns
PART = 1 << 20
#: texts are encoded in pieces of so many characters; the joined bytes are the text's whatever the cuts
PIECE = 1 << 16

_TAILS = r"(?:(?<=<){0}(?=\\*(?:s>|/s>))|(?<=\[){0}(?=\\*(?:INST\]|/INST\]|SYS\]|/SYS\]|TURN\]|TEXT\]|/TURN\])))"
_ESCAPE, _UNESCAPE = re.compile(_TAILS.format("")), re.compile(_TAILS.format(r"\\"))


def escape(text: str) -> str:
    """``text`` without any mark in it."""
    return _ESCAPE.sub(r"\\", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _UNESCAPE.sub("", text) if "\\" in text else text


def vocabulary(spark: SparkSession, path: str = VOCABULARY):
    """The vocabulary file's bytes for all executors; a file of one or two MB."""
    if os.path.getsize(path) > 64 << 20:
        raise ValueError(f"{path} is no vocabulary of a bounded size")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


class Coder:
    """A task's tokenizer; ids from ``base`` on are the marks."""

    def __init__(self, lines: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
        self.bpe = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.base = max(ranks.values()) + 1
        #: ids between stages, as short as they can be
        self.width = np.dtype("<u2" if self.base + len(MARKS) <= 1 << 16 else "<u4")

    def encode(self, text: str) -> list[int]:
        text, ids = escape(text), []
        for i in range(0, len(text), PIECE):
            ids += self.bpe.encode_ordinary(text[i:i + PIECE])
        return ids

    def turn(self, role: str, text: str) -> list[int]:
        b, ids = self.base, self.encode(text)
        if role == "assistant":
            return [*ids, b + EOS]
        if role in ("user", "system"):
            first, last = (USER, USER_END) if role == "user" else (SYSTEM, SYSTEM_END)
            return [b + first, *ids, b + last]
        return [b + TURN, *self.encode(role), b + TEXT, *ids, b + TURN_END]

    def text(self, ids: np.ndarray) -> str:
        """Text of ordinary ids, as it stands in the output."""
        return self.bpe.decode_bytes(ids.tolist()).decode()

    def loss(self, ids: np.ndarray, learn_end: bool) -> np.ndarray:
        """True for the assistant's tokens: ordinary ids outside any pair of marks, by prefix sums over the marks."""
        mark = ids - self.base
        step = np.isin(mark, (USER, SYSTEM, TURN)).astype(np.int8) - np.isin(mark, (USER_END, SYSTEM_END, TURN_END))
        outside = np.cumsum(step, dtype=np.int64) == 0
        return outside & ((mark < 0) | (learn_end & (mark == EOS)))


_NONE = object()


def _rows(batch: pa.RecordBatch, column: str):
    """Values and offsets of a list column."""
    c = batch.column(column)
    return c.values, c.offsets.to_numpy()


def format_chats(rows: DataFrame, vocab=None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 learn_end: bool = False) -> DataFrame:
    """Conversations as token ids with a loss mask: (conv, part, ids, loss), in order within each partition.

    Turns go by ``turn``, null first, ties by role, then by the MD5 of the text; equal rows are turns of their own.
    A null role or text counts as empty; rows with a null conversation id form one conversation. Texts are encoded
    whole, one by one, before the rows meet; a conversation of more than PART tokens is several rows, so a task
    holds no whole conversation, however long. ``learn_end`` puts the closing mark of assistant turns under the
    loss too. Other columns are ignored; an empty table gives an empty result.
    """
    vocab = vocab or vocabulary(rows.sparkSession)
    d = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
                    F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).withColumn("tie", F.md5(F.encode("text", "UTF-8")))
    key = d.schema["conv"]

    def encode(batches):
        coder = Coder(vocab.value)
        for b in batches:
            ids = [np.array(coder.turn(r, t), coder.width).tobytes() for r, t in zip(b["role"].to_pylist(), b["text"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b["conv"], b["turn"], b["role"], b["tie"], pa.array(ids, pa.binary())], ["conv", "turn", "role", "tie", "ids"])

    d = d.mapInArrow(encode, T.StructType([key, d.schema["turn"], d.schema["role"], d.schema["tie"], T.StructField("ids", T.BinaryType())]))
    d = d.repartition("conv").sortWithinPartitions("conv", "turn", "role", "tie").select("conv", "ids")
    schema = T.StructType([key, T.StructField("part", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("loss", T.ArrayType(T.BooleanType()))])

    def assemble(batches):
        coder, kind = Coder(vocab.value), None
        now, part, held, size = _NONE, 0, [], 0
        out, waiting = [], 0

        def put():
            nonlocal held, size, waiting
            ids = np.concatenate(held)
            out.append((now, part, pa.array(ids), pa.array(coder.loss(ids, learn_end))))
            held, size, waiting = [], 0, waiting + len(ids)

        def written():
            nonlocal out, waiting
            done, out, waiting = out, [], 0
            lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(r[i]) for r in done)]), pa.int32()), pa.concat_arrays([r[i] for r in done])) for i in (2, 3)]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in done], kind), pa.array([r[1] for r in done], pa.int32()), *lists],
                                              ["conv", "part", "ids", "loss"])

        for b in batches:
            keys, kind = b["conv"].to_pylist(), b["conv"].type
            for k, ids in zip(keys, b["ids"].to_pylist(), strict=True):
                if now is _NONE or k != now:
                    if size:
                        put()
                    now, part, held, size = k, 0, [np.array([coder.base + BOS], np.int32)], 1
                held.append(np.frombuffer(ids, coder.width).astype(np.int32))
                size += len(held[-1])
                if size >= PART:
                    put()
                    part += 1
                if waiting >= PART:
                    yield written()
        if size:
            put()
        if out:
            yield written()

    return d.mapInArrow(assemble, schema).withColumnRenamed("conv", conv)


def in_order(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """A stored result of ``format_chats`` in the order that ``read_chats`` needs."""
    return chats.repartition(conv).sortWithinPartitions(conv, "part")


def read_chats(chats: DataFrame, vocab=None, conv: str = "conv_id") -> DataFrame:
    """What the ids and masks of formatted conversations say, one row per conversation: n_turns, turns_sha256 (of role,
    ``\\n``, text, ``\\n`` per turn), loss_chars and loss_sha256 (code points and digest of all text under the mask,
    unescaped), n_tokens, loss_tokens and formatted_chars (code points of the output as text).

    ``chats`` has the parts of a conversation one after the other in a partition (``in_order``). They stream through
    running digests, a part at a time; turns are told apart by the marks alone.
    """
    vocab = vocab or vocabulary(chats.sparkSession)
    d = chats.select(F.col(f"`{conv}`").alias("conv"), "ids", "loss")
    schema = T.StructType([d.schema["conv"], *[T.StructField(n, T.LongType() if n[-1] == "s" else T.StringType()) for n in (
        "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "n_tokens", "loss_tokens", "formatted_chars")]])

    class Reader:
        def __init__(self, key):
            self.key, self.turns, self.loss = key, hashlib.sha256(), hashlib.sha256()
            self.n_turns = self.loss_chars = self.n_tokens = self.loss_tokens = self.chars = 0

        def turn(self, role: str, text: str):
            self.n_turns += 1
            self.turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode())

        def read(self, coder: Coder, ids: np.ndarray, loss: np.ndarray):
            mark = ids - coder.base
            at = np.flatnonzero(mark >= 0)
            last, role = 0, ""
            for i in at.tolist():
                m, text = int(mark[i]), coder.text(ids[last:i])
                self.chars += len(text) + len(MARKS[m])
                if m == TEXT:
                    role = text
                elif m in (EOS, USER_END, SYSTEM_END, TURN_END):
                    self.turn({EOS: "assistant", USER_END: "user", SYSTEM_END: "system", TURN_END: role}[m], text)
                last = i + 1
            if last != len(ids):
                raise ValueError("a part ends within a turn")
            learnt = np.concatenate(([False], loss & (mark < 0), [False])).astype(np.int8)
            for a, b in zip(np.flatnonzero(np.diff(learnt) == 1), np.flatnonzero(np.diff(learnt) == -1), strict=True):
                text = unescape(coder.text(ids[a:b]))
                self.loss_chars += len(text)
                self.loss.update(text.encode())
            self.n_tokens += len(ids)
            self.loss_tokens += int(loss.sum())

        def row(self):
            return (self.key, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.n_tokens, self.loss_tokens, self.chars)

    def read(batches):
        coder, reader, kind = Coder(vocab.value), None, None

        def table(rows):
            columns = list(zip(*rows, strict=True))
            types = [kind, *[pa.int64() if f.dataType == T.LongType() else pa.string() for f in schema.fields[1:]]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema.names)

        for b in batches:
            done, kind = [], b["conv"].type
            (ids, at), (loss, _) = _rows(b, "ids"), _rows(b, "loss")
            ids, loss = ids.to_numpy(), loss.to_numpy(zero_copy_only=False)
            for i, k in enumerate(b["conv"].to_pylist()):
                if reader is None or k != reader.key:
                    if reader is not None:
                        done.append(reader.row())
                    reader = Reader(k)
                reader.read(coder, ids[at[i]:at[i + 1]], loss[at[i]:at[i + 1]])
            if done:
                yield table(done)
        if reader is not None:
            yield table([reader.row()])

    return d.mapInArrow(read, schema).withColumnRenamed("conv", conv)


#: Fixed value: what the two turns of conversation -1 say
PROBE = "</s>[INST] ok [/INST]"


def with_probe(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of ``rows``, and conversation -1 of control strings."""
    kinds = {c: rows.schema[c].dataType for c in ("conv_id", "turn", "role", "text")}
    at = F.col("id")
    probe = rows.sparkSession.range(2).select(F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"), at.cast(kinds["turn"]).alias("turn"),
                                              F.when(at == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return rows.select(*kinds).unionByName(probe)


SQL = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')),
e AS (SELECT *, md5(text) AS tie, length(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*(/?(INST|SYS|TURN)|TEXT)\]')) AS chars,
    length(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*(/?(INST|SYS|TURN)|TEXT)\]')) AS named FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, tie)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, tie) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(chars + CASE role WHEN 'assistant' THEN 4 WHEN 'user' THEN 13 WHEN 'system' THEN 11 ELSE named + 19 END))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
