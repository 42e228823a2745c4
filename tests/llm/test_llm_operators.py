"""The ten operators against plain-Python versions on small tables with the awkward cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm import decontaminate, embeddings, line_dedup, lm, minhash, mixing, pii, quality, substring, toxicity
from sparklab.plans.compare import compare

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def texts():
    """Prose with copies, near copies, shared passages and lines, personal data, and empty, null and long rows."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéño") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = prose(200), prose(60)
    lines = "\n".join(prose(4) for _ in range(6))
    out = [base, base, base + " tail", "Head " + base, prose(30) + "\n" + passage + "\n" + prose(20), passage, passage.upper(),
           lines, lines + "\nmore", "x\n" + lines.split("\n", 1)[1], "the same " * 300, "the same " * 300 + "end", "", None, " \t\n", "one", "One", "a b",
           "mail a.b@c.example.org, then a@b or x_y@z.de_f@q.uk; ip 1.2.3.4.5 999.1.1.1 010.020.030.255",
           "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 4 1 1 x; call +1 (017) 555-7713 or +12 34", "konto DE89 3704 0044 0532 0130 00 ok, GB82WEST12345698765432",
           "ssn 123-45-6789 is social", "é" * 50 + " 8.8.8.8 " + "ü", "w" * 700 + " " + "w" * 700, prose(3000)]
    out += [prose(rng.randint(1, 60)) for _ in range(15)]
    near = base.split(" ")
    for k in range(6):
        near = near.copy()
        near[rng.randrange(len(near))] = f"new{k}"
        out.append(" ".join(near))
    return out


def frame(spark):
    rows = [(3 * i + 1, t, random.Random(i).choice(["en", None, "de"]), random.Random(i).choice(["b", "a", None, "é"]), None if i % 5 == 0 else len(t or ""))
            for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs")) + "/documents.parquet"
    frame(spark).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def rows(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def duck(docs, sql, **tables):
    import duckdb

    con = duckdb.connect()
    for name, df in {"documents": docs, **tables}.items():
        con.register(name, df.toArrow())
    return con.sql(sql).df()


# ------------------------------------------------------------ brute force
def windows_removed(words, window=35):
    count = collections.Counter(tuple(w[s:s + window]) for w in words.values() for s in range(len(w) - window + 1))
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if count[tuple(w[s:s + window])] > 1:
                gone[s:s + window] = [True] * window
        out[i] = gone
    return out


def shingles(text, k):
    w = WORDS.findall(lower(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def union(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
             ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
    for kind, pattern in kinds:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(p) > 255 for p in m.group().split(".")) or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 8 <= len(digits) <= 15):
                continue
            yield f"{kind}:{m.start()}:{m.end()}"


# ---------------------------------------------------------------- 1: lines
def test_line_dedup_equals_sql(docs):
    got = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
    assert compare(got.toPandas(), duck(docs, line_dedup.SQL)) is None
    assert got.agg(F.sum("n_removed")).first()[0] >= 6


def test_line_dedup_counts_long_lines_by_their_words(spark):
    word = lambda n, w: " ".join([w] * n)
    a, b, c, d = word(50, "a"), word(49, "b"), word(25, "c"), word(24, "d")
    texts = [a, f"x\n{a}\ny", b, b, f"{c}\n{c}", f"p\n{c}\n{c}\nq", f"{c}\n{d}", f"{c}\n{d}"]
    left = [a, "x\ny", b, b, f"{c}\n{c}", "p\nq", f"{c}\n{d}", f"{c}\n{d}"]
    t = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.text for r in line_dedup.dedup_lines(t).orderBy("doc_id").collect()] == left
    assert [r.text for r in line_dedup.dedup_lines(t, min_words=None).orderBy("doc_id").collect()] == texts


def test_line_dedup_depths_and_columns(spark, docs):
    lines = [(1, "a\nb\nc\nd\ne\nf"), (2, "x\nb\nc\nd\ne\ny"), (3, "b\nc\nz"), (None, "q\nq\nq\nq\nq"), (4, None)]
    d = spark.createDataFrame([(i, t, 5, "k") for i, t in lines], "doc_id long, text string, N_Lines int, _runs string")
    for depth, want in ((1, {2: "x\ny", 3: "z", None: "q"}), (2, {2: "x\ny", 3: "z", None: "q"}), (4, {2: "x\ny", 3: "b\nc\nz", None: "q"}),
                        (5, {2: "x\nb\nc\nd\ne\ny", 3: "b\nc\nz", None: "q\nq\nq\nq\nq"})):
        out = line_dedup.dedup_lines(d, depth)
        got = {r.doc_id: r.text for r in out.collect()}
        # the repeated q is its own copy: the run that starts at the second line
        want = {1: "a\nb\nc\nd\ne\nf", 4: None, **want}
        assert got == want, depth
        assert out.columns[:4] == d.columns


# -------------------------------------------------------------- 3: substring
def test_substring_dedup_equals_brute_force(docs, rows):
    words = {i: WORDS.findall(t or "") for i, t in rows.items()}
    gone = windows_removed(words)
    assert sum(map(sum, gone.values())) > 1000
    for r in substring.cut_repeats(docs).collect():
        kept = " ".join(w for w, g in zip(words[r.doc_id], gone[r.doc_id], strict=True) if not g)
        assert (r.n_words, r.n_removed, r.kept_sha256, r.kept) == (len(words[r.doc_id]), sum(gone[r.doc_id]), sha(kept), kept)


@pytest.mark.parametrize("window, seed", [(8, 8), (12, 5), (20, 3)])
def test_substring_windows_of_other_sizes(docs, rows, window, seed):
    words = {i: WORDS.findall(t or "") for i, t in rows.items()}
    gone = windows_removed(words, window)
    got = {r.doc_id: r.n_removed for r in substring.cut_repeats(docs, window, seed, keep_text=False).collect()}
    assert got == {i: sum(g) for i, g in gone.items()}


# ------------------------------------------------------------------ 4: mix
def test_mixing_equals_sql_and_its_bounds(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 0), (7, None, 1)], "doc_id long, quality int, toxic int")
    d = mixing.with_labels(mixing.sized(docs), labels)
    got = mixing.mix_sources(d, F.col("_quality")).toPandas()
    assert compare(got, duck(docs, mixing.SQL, labels=labels)) is None
    assert (got.taken <= 3 * got["size"]).all()
    per = got.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(per.taken - per.target) <= 1).all()


def test_mixing_reshares_what_small_sources_cannot_take(spark):
    rows = [(i, " w" * n, s, None) for i, (n, s) in enumerate([(100, "a"), (1, "b"), (2, "c"), (50, None), (0, "z")])]
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string, size string")).toPandas()
    t = {s if isinstance(s, str) else None: x for s, x in zip(out.source, out.target, strict=True)}
    assert t["b"] == 3 and t["c"] == 6 and t["z"] == 0 and abs(sum(t.values()) - 153) < 1e-9 and t[None] / t["a"] == pytest.approx(2)


# ------------------------------------------------------------------ 5: pii
def test_pii_equals_brute_force(docs, rows):
    found = 0
    for r in pii.redact(docs).collect():
        spans = list(base_spans(rows[r.doc_id]))
        kinds = collections.Counter(s.split(":")[0] for s in spans)
        assert r.base_sha256 == sha(",".join(spans)), r.spans
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in pii.BASE)
        assert set(spans) <= set(r.spans.split(",") if r.spans else [])
        found += len(spans)
    assert found >= 8


def test_pii_checksums_and_context(spark):
    d = spark.createDataFrame([(1, "IBAN DE89370400440532013000 ok"), (2, "IBAN DE89370400440532013001 ok"), (3, "ssn 123-45-6789"), (4, "123-45-6789"),
                               (5, "our card 4111111111111111"), (6, "order 4111111111111111")], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(d).collect()}
    kinds = {i: [(s.kind, s.start, s.end) for s in r.spans] for i, r in got.items()}
    assert kinds[1] == [("iban", 5, 27)] and kinds[3] == [("ssn", 4, 15)] and kinds[4] == [] and ("iban", 5, 27) not in kinds[2]
    assert got[5].spans[0].score > got[6].spans[0].score


# -------------------------------------------------------------- 6: minhash
@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(docs, rows, k):
    sets = {i: shingles(t, k) for i, t in rows.items()}
    ids = sorted(sets)
    pairs = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = union(ids, pairs)
    got = minhash.near_duplicates(docs, k).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) == r.first for r in got)


def test_large_nodes_of_near_copies_are_one_component(spark):
    """More near copies than a leaf holds, and a looser ring that only links step by step."""
    rng = random.Random(9)
    base = [f"w{n}" for n in range(120)]
    rows = []
    for i in range(80):
        w = base.copy()
        w[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(w)))
    drift = [f"v{n}" for n in range(60)]
    for i in range(40):
        drift = drift.copy()
        drift[rng.randrange(60)] = f"y{i}"
        rows.append((100 + i, " ".join(drift)))
    sets = {i: shingles(t, 2) for i, t in rows}
    ids = sorted(sets)
    want = union(ids, [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 2).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_only_link_into_a_large_group_is_found(spark):
    """300 near copies, and 300 texts each linked, at just over 0.8, to one of them only."""
    rng = random.Random(11)
    base, rows = [f"w{n}" for n in range(400)], []
    for i in range(300):
        own = base.copy()
        for p in rng.sample(range(0, 400, 4), 1):
            own[p] = f"x{i}_{p}"
        far = own.copy()
        for p in rng.sample(range(2, 400, 4), 22):
            far[p] = f"y{i}_{p}"
        rows += [(i, " ".join(own)), (1000 + i, " ".join(far))]
    sets = {i: shingles(t, 2) for i, t in rows}
    alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    links = [(a, b) for n, (a, _) in enumerate(rows) for b, _ in rows[n + 1:] if alike(a, b)]
    assert all([a for a, b in links if b == 1000 + i] + [b for a, b in links if a == 1000 + i] == [i] for i in range(300))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 2).collect()
    assert {r.doc_id: r.component_id for r in got} == union(sorted(sets), links)


def _near_misses(m, words=60, changed=5, seed=3):
    """Texts that mostly lie just under 0.8 of each other, links among them."""
    rng = random.Random(seed)
    base, rows = [f"w{n}" for n in range(words)], []
    for i in range(m):
        own = base.copy()
        for p in rng.sample(range(words), rng.randrange(changed + 1)):
            own[p] = f"x{rng.randrange(3)}_{p}"
        rows.append((i, " ".join(own)))
    sets = {i: shingles(t, 2) for i, t in rows}
    return rows, sets, [(a, b) for a in range(m) for b in range(a + 1, m) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]


def test_near_misses_are_not_listed_pair_by_pair(spark, monkeypatch):
    rows, sets, links = _near_misses(300, changed=9)
    kept, keep = [], minhash.keep

    def counted(df):
        out = keep(df)
        if {"a", "b"} <= set(out.columns):
            kept.append(out.count())
        return out

    monkeypatch.setattr(minhash, "keep", counted)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 2).collect()
    assert {r.doc_id: r.component_id for r in got} == union(sorted(sets), links)
    assert kept and max(kept) <= 2 * len(rows)


def test_only_what_blocks_share_is_followed_round_by_round(spark, monkeypatch):
    for name, value in (("LEAF", 4), ("LAST_LEAF", 8), ("BLOCK", 30), ("COMMON", 2)):
        monkeypatch.setattr(minhash, name, value)
    rows, sets, links = _near_misses(300)
    followed, components = [], minhash.components

    def counted(edges):
        followed.append(edges.count())
        return components(edges)

    monkeypatch.setattr(minhash, "components", counted)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 2).collect()
    assert {r.doc_id: r.component_id for r in got} == union(sorted(sets), links)
    assert followed and followed[0] < len(rows) / 4


def test_homes_of_long_ways_take_few_rounds(spark, monkeypatch):
    """Ways of 500 partners, and classes whose only partners are larger."""
    near = [(i, i - 1) for i in range(1, 500)] + [(0, 1), (1000, 1002), (1002, 1001), (1001, 1002), (2000, 2001), (2001, 2000)]
    rounds, keep = [], minhash.keep
    monkeypatch.setattr(minhash, "keep", lambda df: rounds.append(1) or keep(df))
    got = {r["_id"]: r.home for r in minhash._homes(spark.createDataFrame(near, "_id long, other long")).collect()}
    assert got == {i: 0 for i in range(500)} | {1000: 1000, 1001: 1001, 1002: 1001, 2000: 2000, 2001: 2000}
    assert len(rounds) <= 11


def test_wide_homes_are_compared_block_by_block(spark, monkeypatch):
    for name, value in (("LEAF", 4), ("LAST_LEAF", 8), ("BLOCK", 10), ("COMMON", 2)):
        monkeypatch.setattr(minhash, name, value)
    rows, sets, links = _near_misses(120, changed=8)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 2).collect()
    want = union(sorted(sets), links)
    assert len(set(want.values())) > 3
    assert {r.doc_id: r.component_id for r in got} == want


def test_links_between_labels():
    rows, sets, links = _near_misses(80, changed=8)
    hashed = [np.sort(np.array([zlib.crc32(repr(x).encode()) for x in sets[i]], dtype=np.uint64)) for i in range(80)]
    got = list(minhash.links_between(hashed, np.arange(80), 80))
    assert set(map(tuple, map(sorted, got))) <= set(links) and len(got) < 80
    assert union(list(range(80)), got) == union(list(range(80)), links)
    label = np.arange(80) % 2
    assert len(list(minhash.links_between(hashed, label, 80))) == 1


def test_near_duplicates_keep_one_row_of_repeated_ids(spark):
    d = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, ""), (2, ""), (None, None)], "doc_id long, text string").coalesce(1)
    kept = minhash.drop_near_duplicates(d, 2).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, ""), (1, "a b c d"), (2, ""), (2, "")]


# --------------------------------------------------------- 2, 7: classifiers
def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = toxicity.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert len(out) and out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.7)).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.doc_id]).all()
    held = out[out.held_out]
    rank = held.score.rank()
    n1 = (held.toxic == 1).sum()
    auc = (rank[held.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(held) - n1))
    assert auc > 0.95
    assert (held[held.predicted == 1].toxic == 1).mean() > 0.9


def test_toxicity_awkward_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.classify(docs, none).collect()
    assert len(out) == docs.count() and len({r.score for r in out}) == 1
    one = spark.createDataFrame([(1, 1, 1), (None, 1, 0), (4, 1, None), (7, 1, 1)], "doc_id long, quality int, toxic int")
    assert all(r.score > 0.9 for r in toxicity.classify(docs, one).collect())
    assert toxicity.classify(docs.limit(0), one).count() == 0


def test_ngrams_are_distinct_and_see_whole_texts():
    a, b = toxicity.ngrams("x" * 100_000), toxicity.ngrams("x" * 100_000 + "y")
    assert len(a) == len(set(a.tolist())) and len(b) > len(a)  # the last character tells
    assert len(toxicity.ngrams(None)) == len(toxicity.ngrams("")) == 0


def test_quality_keeps_good_and_rejects_bad(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    out = quality.score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()  # labels it never saw
    good = out._score >= 0.5
    assert good[out.quality == 1].mean() > 0.99 and good[out.quality == 0].mean() < 0.1


def test_co_training_teaches_the_other_view():
    """A pool row is named by one view only; the other view learns from it."""
    rng = np.random.default_rng(1)
    y = (rng.random(400) < 0.5).astype(float)
    xt = np.column_stack([y * 4 + rng.normal(size=400), rng.normal(size=400)])
    xm = np.column_stack([y * 2 + rng.normal(size=400)])
    yp = (rng.random(2000) < 0.5).astype(float)
    pt, pm = np.column_stack([yp * 4 + rng.normal(size=2000), rng.normal(size=2000)]), np.column_stack([yp * 2 + rng.normal(size=2000)])
    few = slice(0, 40)
    alone = quality.co_train(xt[few], xm[few], y[few], np.ones(40), pt[:0], pm[:0])
    both = quality.co_train(xt[few], xm[few], y[few], np.ones(40), pt, pm)
    right = lambda m: ((m.score(xt[40:], xm[40:])[2] >= 0.5) == (y[40:] == 1)).mean()
    assert right(both) >= right(alone) - 0.01 and right(both) > 0.95


def test_quality_features_need_little_memory_besides_the_texts():
    import tracemalloc

    import pyarrow as pa

    text = ["", None, *[f"Word{i} {{x}} 12 word{i} \u00e9t\u00e9 " * 40 for i in range(3000)], "a b " * 500_000]
    column = pa.array(text)
    tracemalloc.start()
    got = quality.text_features(column.slice(0, 3002))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6  # 3 MB of texts
    # a text's features are its own, whatever stands before it
    for k in (0, 1, 2, 1777, 3001):
        assert np.array_equal(got[k], quality.text_features(column.slice(k, 1))[0])
    assert np.array_equal(quality.text_features(column)[-1], quality.text_features(column.slice(3002))[0])


def test_quality_hands_texts_over_once_and_only_scores_back(spark):
    docs = spark.createDataFrame([(i, f"some words {i}" * 20, None, "s", i) for i in range(30)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = quality.score(docs, quality.CoTrained(None, None, 1.0)).where("_score > 0.1 AND _text_score > 0.1")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1
    assert [r[:5] for r in sorted(kept.collect())] == sorted(tuple(r) for r in docs.collect())


def test_quality_awkward_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep_good(docs, none).count() == docs.count()
    odd = docs.select("doc_id", "text").withColumn("_score", F.lit("x")).withColumn("_Text", F.lit(1))
    out = quality.keep_good(odd, none)
    assert out.columns == odd.columns and out.count() == docs.count()


# -------------------------------------------------------------------- 8: lm
def test_lm_tokens_of_a_batch_are_counted_piece_by_piece():
    """Counts per block are right where blocks and pieces cut each other, in memory of a few times the texts."""
    import tracemalloc
    from collections import Counter

    import numpy as np
    import pyarrow as pa

    from sparklab.llm import lm
    from sparklab.llm.words import PLAIN, pieces

    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(300)])
    texts = [" ".join(words[rng.integers(0, 300, 800)]) if i % 50 else None for i in range(2500)]
    block = [i // 700 for i in range(2500)]
    batch = pa.RecordBatch.from_pydict({"_block": pa.array(block, pa.int64()), "_text": texts, "_train": pa.array([i % 3 % 2 for i in range(2500)], pa.int64())})
    tracemalloc.start()
    got = [b.to_pydict() for b in lm._words([batch])]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * batch.nbytes  # 14 times before
    hashed = {}
    for _, _, w in pieces(pa.array(list(words)), PLAIN, lower=True):
        hashed = dict(zip(w.hashes().view(np.int64).tolist(), words.tolist(), strict=True))
    for b in got:
        k = b["_block"][0]
        want, seen = Counter(), set()
        for i, t in enumerate(texts):
            if block[i] == k:
                for x in [*(t or "").split(), None]:
                    want[x] += i % 3 % 2
                    seen.add(x)
        assert len(set(b["h"])) == len(b["h"]) and {hashed.get(h) for h in b["h"]} == seen
        assert {hashed.get(h): c for h, c in zip(b["h"], b["c"], strict=True)} == {x: want[x] for x in seen}
    assert sorted(b["_block"][0] for b in got) == [0, 1, 2, 3]


def test_lm_counts_equal_brute_force(docs, rows):
    tokens = {i: [*WORDS.findall(lower(t)), None] for i, t in rows.items()}
    count = collections.Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    out = lm.score(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        ws = tokens[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(count[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws))
        assert r.score < 0 and math.isfinite(r.score)


def test_lm_beats_its_base_on_held_out_texts(spark):
    out = lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out")
    r = out.agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_lm_softmax_is_normalised():
    rng = np.random.default_rng(3)
    w = rng.normal(size=(64, lm.CLASSES)).astype(np.float32)
    p = np.exp(lm._log_softmax(w, rng.integers(0, 64, (lm.FEATURES, 50))))
    assert p.sum(axis=1) == pytest.approx(np.ones(50), abs=1e-5)


# --------------------------------------------------------- 9: benchmark
def occurrences(rows, items, window=10):
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = collections.defaultdict(set)
    for i, t in items:
        w = words.findall(lower(t))
        for s in range(max(1, len(w) - window + 1) if w else 0):
            wins[tuple(w[s:s + window])].add(str(i))
    for i, t in rows.items():
        w, hit, found = words.findall(lower(t)), set(), set()
        for size in {len(x) for x in wins}:
            for s in range(len(w) - size + 1):
                if x := wins.get(tuple(w[s:s + size])):
                    found |= x
                    hit.update(range(s, s + size))
        yield i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


@pytest.mark.parametrize("short", [None, "one", "a b"])
@pytest.mark.parametrize("block_words", [200_000, 20])
def test_contamination_equals_brute_force(spark, docs, rows, short, block_words, monkeypatch):
    texts_ = [t for t in rows.values() if t]
    passage = next(t for t in texts_ if len(t.split()) == 60)
    items = [(1, passage), (10, " ".join(passage.split()[5:30])), (2, ""), (3, None), (2, "the same " * 6), (7, passage.title())]
    items += [(20, short)] if short else []
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", (block_words,))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.contamination(docs, benchmark).collect()}
    want = set(occurrences(rows, items))
    assert got == want and sum(x[5] for x in want) >= 3
    if not short:
        cut = decontaminate.remove_spans(docs, benchmark)
        assert cut.columns == docs.columns
        assert not decontaminate.contamination(cut, benchmark).where("contaminated").count()
        clean = {x[0] for x in want if not x[5]}
        assert all(r.text == rows[r.doc_id] for r in cut.collect() if r.doc_id in clean)


def test_empty_benchmark_hits_nothing(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none).where("contaminated").count() == 0


def test_fm_index_counts_and_locates_everything():
    rng = np.random.default_rng(4)
    s = np.concatenate([rng.integers(2, 6, 400), [2, 2, 2, 2] * 20, [decontaminate.BREAK, decontaminate.END]])
    patterns = [tuple(s[i:i + n]) for i, n in ((3, 4), (50, 2), (401, 7))] + [(5, 2, 5, 2, 3), (9, 9)]
    table = np.zeros((len(patterns), 8), np.int64)
    for i, p in enumerate(patterns):
        table[i, 8 - len(p):] = p
    which, pos = decontaminate.search(s, table, np.array([len(p) for p in patterns]))
    want = {(i, j) for i, p in enumerate(patterns) for j in range(len(s)) if tuple(s[j:j + len(p)]) == p}
    assert set(zip(which.tolist(), pos.tolist(), strict=True)) == want


# ------------------------------------------------------------- 10: vectors
def test_embedding_links_against_brute_force(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 24))
    near = x[:120] + rng.normal(scale=0.05, size=(120, 24))
    v = np.vstack([x, near, x[:10], x[:10], 2 * x[20:25]]).astype(np.float32)
    label = [int(i % 3) for i in range(300)] + [int(i % 3) for i in range(120)] + [int(i % 3) for i in range(10)] * 2 + [int(i % 3) for i in range(20, 25)]
    rows = [(i, [float(a) for a in r], k) for i, (r, k) in enumerate(zip(v, label, strict=True))]
    odd = [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 24, 1), (1003, [float("nan")] + [1.0] * 23, 1), (1004, [None] + [1.0] * 23, 1), (1005, rows[0][1], None),
           (1006, [1.0, 2.0], 1), (1007, [1.0, 2.0], 1), (1008, [float("inf")] * 24, 1), (None, rows[3][1], 0)]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])
    got = embeddings.dedup(spark.createDataFrame(rows + odd, schema).coalesce(1)).collect()
    by = {r.vec_id: r for r in got}
    assert len(got) == len(rows) + len(odd)
    for i in (1000, 1001, 1002, 1003, 1004, 1005, 1008):
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True)
    assert (by[1006].n_links, by[1007].component_id, by[None].component_id, by[None].kept) == (1, 1006, 3, False)
    u = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    linked = (u @ u.T >= 0.93) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(linked, False)
    want = linked.sum(axis=1)
    want[np.array([i for i in range(len(want)) if i == 3 or linked[3, i]])] += 1  # the row without an id
    links = np.array([by[i].n_links for i in range(len(v))])
    assert (links <= want).all() and links.sum() >= 0.9 * want.sum()
    comp = union(range(len(v)), [(a, b) for a, b in zip(*np.nonzero(np.triu(linked)), strict=True)])
    assert sum(by[i].component_id == comp[i] for i in range(len(v))) >= 0.95 * len(v)


# ----------------------------------------------------------------- all of them
def test_empty_tables(spark, docs):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for out in (line_dedup.dedup_lines(none), quality.classify(none, labels), substring.cut_repeats(none), mixing.mix_sources(none), pii.redact(none),
                minhash.near_duplicates(none), toxicity.classify(none, labels), lm.score(none), decontaminate.contamination(none, benchmark),
                embeddings.dedup(vectors)):
        assert out.count() == 0


def test_null_and_repeated_ids(spark):
    d = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (1, "c d"), (1, "c d"), (2, None)], "doc_id long, text string")
    d = d.select("*", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("n_chars"),
                 F.lit(1).alias("n"), F.lit("x").alias("_row"), F.lit("y").alias("spans")).coalesce(1)
    benchmark = spark.createDataFrame([(None, "a b"), (1, "c d e")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    for out in (line_dedup.dedup_lines(d), quality.classify(d, labels), substring.cut_repeats(d), mixing.mix_sources(d), pii.redact(d), minhash.near_duplicates(d, 2),
                toxicity.classify(d, labels), lm.score(d), decontaminate.contamination(d, benchmark)):
        assert out.count() == 6
    assert [r.n_hit for r in decontaminate.contamination(d, benchmark).collect()] == [2, 2, 2, 0, 0, 0]


SPLITS = {"spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}


@pytest.mark.parametrize("module, call", [
    (line_dedup, lambda d: line_dedup.dedup_lines(d).select("doc_id", "text", "n_lines", "n_removed")),
    (substring, lambda d: substring.cut_repeats(d).select("doc_id", "n_removed", "kept")),
    (minhash, lambda d: minhash.near_duplicates(d, 2).drop("_row", "first")),
    (minhash, lambda d: minhash.drop_near_duplicates(d, 2).select("doc_id", "text")),
    (lm, lambda d: lm.score(d).select("doc_id", "n_tokens", "n_known", F.round("base_score", 6))),
], ids=["line_dedup", "substring", "near_duplicates", "drop_near_duplicates", "lm"])
def test_splits_may_change_during_a_query(spark, docs, monkeypatch, module, call):
    """The scan falls into other splits after the first table was written, as on a cluster that loses an executor."""
    def result():
        return sorted(map(repr, call(docs).collect()))

    want, keep = result(), module.keep

    def other_splits(df):
        out = keep(df)
        for k, v in SPLITS.items():
            spark.conf.set(k, v)
        return out

    monkeypatch.setattr(module, "keep", other_splits)
    try:
        assert result() == want
    finally:
        for k in SPLITS:
            spark.conf.unset(k)
