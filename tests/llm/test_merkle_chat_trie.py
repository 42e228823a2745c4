"""Operators 11 to 13 against plain-Python versions, with nulls, ties, repeats, long texts, empty tables and clashing columns."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparklab.llm import chat, merkle, queries, trie

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CONVS = "conv_id long, turn long, role string, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def crc(n):
    return zlib.crc32(str(n).encode())


def write(df, tmp_path, name, parts=3):
    path = f"{tmp_path}/{name}.parquet"
    df.repartition(parts).write.mode("overwrite").parquet(path)
    return str(tmp_path)


# ------------------------------------------------------------------ 11
def test_addresses_are_a_permutation_split_at_half_height():
    for levels in (1, 2, 3, 4, 5):
        for n in {1, 2, 15, 16, 17, 255, 256, 257, 4000, 16 ** (levels - 1)}:
            if n > 16 ** (levels - 1):
                continue
            seen = []
            width = n
            for level in range(levels):
                seen.append(merkle.address(n, levels, level, np.arange(width)))
                width = -(-width // 16)
            flat = np.concatenate(seen)
            assert sorted(flat.tolist()) == list(range(merkle.nodes_of(n, levels)))
            assert seen[-1][0] == 0  # the root comes first
    # four levels over 4096 leaves: the upper two levels, then 256 parts of a node and its 16 leaves
    assert merkle.address(4096, 4, 2, np.arange(16)).tolist() == list(range(1, 17))
    assert merkle.address(4096, 4, 1, np.array([0, 1])).tolist() == [17, 34]
    assert merkle.address(4096, 4, 0, np.array([0, 16, 17])).tolist() == [18, 35, 36]


def level_up(nodes):
    return [sha(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append(level_up(levels[-1]))
    return levels


def steps(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = nodes[i // 16 * 16:i // 16 * 16 + 16]
        out.append((run[:i % 16], run[i % 16 + 1:]))
        i //= 16
    return out


def merkle_by_hand(rows):
    """{(doc_id, leaf): [(subroot, root, proof, folded)]}"""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha(*map(part, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))
    lower = lambda t: None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    groups = collections.defaultdict(list)
    for r in rows:
        own = leaf(r, r["text"])
        hit = r["doc_id"] is not None and crc(r["doc_id"]) % 5 == 0
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, own, leaf(r, lower(r["text"])) if hit else own, r["doc_id"]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = collections.defaultdict(list)
    for k, s in enumerate(names):
        for i, x in enumerate(sorted(groups[s])):
            way, h = steps(trees[s], i) + steps(top, k), x[3]
            for a, b in way:
                h = sha(*a, h, *b)
            out[x[4], x[2]].append((trees[s][-1][0], top[-1][0], sha(*[d for a, b in way for d in a + b]), h))
    return out


def merkle_rows(n_sources=40, big=700):
    rng = random.Random(3)
    rows = [dict(doc_id=3 * i, text=f"Text {rng.random()} É", lang=rng.choice(["en", None, ""]), source="big", n_chars=i) for i in range(big)]
    rows += [dict(doc_id=10_000 + i, text=rng.choice([None, "", "Ab", "ab"]), lang="en", source=rng.choice([None, "", "é", "z", "Z", *[f"s{k}" for k in range(n_sources)]]), n_chars=None)
             for i in range(200)]
    rows += [dict(doc_id=i, text="X", lang=None, source="same", n_chars=1) for i in (5, 5, 5, None, None)]  # repeated rows and ids
    rows += [dict(doc_id=5, text="Y", lang=None, source="same", n_chars=1), dict(doc_id=-7, text="W" * 200_000 + " w" * 60_000, lang="x", source="long", n_chars=0)]
    return rows


@pytest.mark.parametrize("levels", [2, 3, 4])
def test_manifest_against_python(spark, tmp_path, levels):
    rows = merkle_rows()
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in DOCS.split(", ")) for r in rows], DOCS)
    df = df.withColumns({"tree": F.lit("clash"), "pos": F.lit(1), "group": F.lit(2), "key": F.lit(3), "leaf": F.lit(4), "_tie": F.lit(5), "nodes": F.lit(6)})
    got = collections.defaultdict(list)
    d = merkle.verify(df, {"text": F.translate("text", merkle.UPPER, merkle.LOWER)}, F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0, levels=levels)
    for r in d.collect():
        assert r.verified == (r.folded_root == r.root)
        got[r.doc_id, r.leaf].append((r.subroot, r.root, r.proof_sha256, r.folded_root))
    want = merkle_by_hand(rows)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_manifest_of_one_row_one_source_and_no_row(spark):
    one = spark.createDataFrame([(4, "Abc", "en", "s", 3)], DOCS)
    r = merkle.tampered(one).collect()
    want = merkle_by_hand([dict(doc_id=4, text="Abc", lang="en", source="s", n_chars=3)])
    assert [(x.subroot, x.root, x.proof_sha256, x.folded_root) for x in r] == want[4, r[0].leaf]
    assert r[0].leaf == r[0].root and r[0].proof_sha256 == sha("")
    assert merkle.tampered(one.limit(0)).collect() == []
    assert merkle.tampered(one).columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_proofs_hold_for_the_row_and_for_no_other(spark):
    df = spark.createDataFrame([(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(120)], DOCS)
    m = merkle.manifest(df, levels=2)
    p = merkle.proofs(m).select("key", "leaf", merkle.fold("leaf").alias("a"), merkle.fold(F.sha2(F.lit("x"), 256)).alias("b")).collect()
    assert len(p) == 120 and all(r.a == m.root and r.b != m.root for r in p)
    # a block's nodes lie in the order that the addresses say
    b = m.tiers[0].where("block = 0").first()
    assert len(b.nodes) == 32 * merkle.nodes_of(16, 2) and b.nodes[:32].hex() == b.root


# ------------------------------------------------------------------ 12
def chat_rows():
    rng = random.Random(8)
    marks = [*chat.MARKS, "\\", "<", "[", "/", "<\\s>", "<\\\\/s>", "[\\INST]", " ", "\n", "é", "x", "s>", "INST]"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None, "<s>", "a\nb", ""]), rng.choice([None, "", *["".join(rng.choice(marks) for _ in range(rng.randint(1, 12))) for _ in range(6)]]))
            for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(100, None, "user", "first"), (100, 1, "assistant", "one"), (100, 1, "assistant", "one"), (100, 1, "assistant", "two"), (100, None, "system", "zero")]
    rows += [(None, 0, "assistant", "no id"), (101, 0, "assistant", "long " * 60_000 + "</s>" + "é" * 70_000), (101, 1, "user", "w" * 300_000)]
    rng.shuffle(rows)
    return rows


def rendered(role, text):
    text = chat.escape(text)
    return {"user": f"[INST]{text}[/INST]", "system": f"[SYS]{text}[/SYS]", "assistant": f"{text}</s>"}.get(role, f"[TURN]{chat.escape(role)}[TEXT]{text}[/TURN]")


def chats_by_hand(rows):
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        text = text or ""
        by[c].append((t is not None, t or 0, role or "", hashlib.md5(text.encode()).hexdigest(), text))
    out = {}
    for c, turns in by.items():
        turns = [(x[2], x[4]) for x in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), sha(*[f"{r}\n{t}\n" for r, t in turns]), len(loss), sha(loss), 3 + sum(len(rendered(r, t)) for r, t in turns))
    return out


def chats(df):
    return {r[0]: tuple(r)[1:] for r in df.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars").collect()}


def test_escapes_are_reversible_and_leave_no_mark():
    rng = random.Random(1)
    for _ in range(5000):
        t = "".join(rng.choice([*chat.MARKS, "\\", "<", "[", "s>", "/", "INST]", "a"]) for _ in range(rng.randint(0, 8)))
        e = chat.escape(t)
        assert chat.unescape(e) == t
        assert not any(m in e for m in chat.MARKS)


@pytest.mark.parametrize("part", [chat.PART, 40])
def test_chats_against_python(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART", part)
    rows = chat_rows()
    df = spark.createDataFrame(rows, CONVS).repartition(5).withColumns({"conv": F.lit(1), "ids": F.lit("x"), "tie": F.lit(0), "part": F.lit(0)})
    formatted = chat.format_chats(df)
    assert chats(chat.read_chats(formatted)) == chats_by_hand(rows)
    # read again after being stored in another order
    assert chats(chat.read_chats(chat.in_order(formatted.orderBy(F.rand(3))))) == chats_by_hand(rows)
    if part == 40:
        assert formatted.groupBy("conv_id").count().agg(F.max("count")).first()[0] > 1


def test_chat_tokens_are_the_segments_and_the_marks(spark):
    vocab = chat.vocabulary(spark)
    coder = chat.Coder(vocab.value)
    df = spark.createDataFrame([(1, 0, "user", "a </s> b"), (1, 1, "assistant", "c [INST] d"), (1, 2, "assistant", "")], CONVS)
    r = chat.format_chats(df, vocab).first()
    plain = coder.bpe.encode_ordinary
    b = coder.base
    assert r.ids == [b, b + chat.USER, *plain("a <\\/s> b"), b + chat.USER_END, *plain("c [\\INST] d"), b + chat.EOS, b + chat.EOS]
    learnt = [i for i, m in zip(r.ids, r.loss, strict=True) if m]
    assert learnt == plain("c [\\INST] d")
    r = chat.format_chats(df, vocab, learn_end=True).first()
    assert [i for i, m in zip(r.ids, r.loss, strict=True) if m] == [*plain("c [\\INST] d"), b + chat.EOS, b + chat.EOS]


def test_chat_query_has_the_probe_and_takes_empty_tables(spark, tmp_path):
    rows = chat_rows()
    d = write(spark.createDataFrame(rows, CONVS), tmp_path, "conversations")
    probe = [(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]
    assert chats(queries.op12_chat_format(spark, d)) == chats_by_hand(rows + probe)
    empty = spark.createDataFrame([], CONVS)
    assert chat.read_chats(chat.format_chats(empty)).collect() == []
    assert chats(chat.read_chats(chat.format_chats(chat.with_probe(empty)))) == chats_by_hand(probe)


# ------------------------------------------------------------------ 13
def trie_by_hand(rows):
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            text = text or ""
            by[c].append((t is not None, t or 0, role or "", hashlib.md5(text.encode()).hexdigest(), text))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in by.items()}
    made = {c: tuple(own.get(c - c % 5, [])[:crc(c) % 9] + turns[crc(c) % 9:]) for c, turns in own.items()}
    members = collections.defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[made[c][:d]].append(c)
    kids = collections.defaultdict(list)
    for n in members:
        if n:
            kids[n[:-1]].append(n)
    out = {}
    for n in sorted(members, key=len, reverse=True):
        below = [out[k] for k in kids[n]]
        own_saved = (len(members[n]) - 1) * (len(n[-1][1].encode()) if n else 0)
        out[n] = (members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), len(kids[n]), sum(b[5] for b in below) or 1,
                  own_saved + sum(b[6] for b in below), sha(",".join(str(c) for c in members[n] if made[c] == n)))
    return sorted(out.values(), key=repr)


def trie_rows(n=160, hot=0):
    rng = random.Random(11)
    say = lambda: (rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b", "é", "", None, "ab"]))
    rows = []
    for c in range(n):
        if c % 10 == 0 and c % 20:
            continue  # bases that are not there
        rows += [(c, rng.choice([t, t, t, None]), *say()) for t in range(rng.choice([1, 1, 2, 3, 8, 12]))]
    rows += [(5000 + i, t, "user", f"hot{t}") for i in range(hot) for t in range(11)]  # a third of all rows
    rows += [(7000, t, "user", "x" * 100) for t in range(300)] + [(7001, t, "user", "x" * 100) for t in range(310)] + [(7005, 0, "user", "w " * 30_000)] * 3
    rows += [(None, 1, "user", "nobody's")]
    rng.shuffle(rows)
    return rows


def nodes(df):
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


@pytest.mark.parametrize("block,chunk", [(trie.BLOCK, trie.CHUNK), (7, 20)])
def test_trie_against_python(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rows = trie_rows(hot=90)
    df = spark.createDataFrame(rows, CONVS).repartition(4).withColumns({"conv": F.lit(1), "x": F.lit("x"), "pos": F.lit(0), "seq": F.lit(0)})
    assert nodes(trie.prefix_trie(df)) == trie_by_hand(rows)


def test_trie_of_few_and_no_conversations(spark):
    for rows in ([(5, 0, "user", "a")], [(3, 0, "user", "a")], [(3, 0, "user", "a"), (4, 0, "user", "a")], [(None, 0, "user", "a")], []):
        got = nodes(trie.prefix_trie(spark.createDataFrame(rows, CONVS)))
        assert got == (trie_by_hand(rows) if any(r[0] is not None for r in rows) else [])


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_chat_format", "op13_prefix_trie"])
def test_query_against_sql(spark, duck, name):
    from sparklab.plans.compare import compare

    from tests.conftest import SF001
    assert compare(queries.QUERIES[name](spark, SF001).toPandas(), duck.execute(queries.SQL[name]).df()) is None
