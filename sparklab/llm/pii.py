"""Personal data: patterns propose spans, checksums confirm, context adjusts.

DataFrame functions only. Offsets of matches come from splitting the text at
the pattern: a match starts after all pieces and matches before it, so one
window sum per document and kind gives code point offsets without Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Kinds in the order they are listed, their patterns and priors.
# The patterns of the first four accept what the contract's patterns accept;
# possessive quantifiers and the start conditions only keep Java's matcher
# linear on long runs (a leftmost match begins at the start of a run or where
# the match before ended).
KINDS = [
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9),
    ("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", 0.7),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])", 0.8),
    ("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", 0.3),
]
BASE = ("email", "ip", "card", "phone")
#: Words that raise a kind's score when they stand nearby
CONTEXT = {
    "email": "mail|contact|write", "ip": "ip|host|server|address", "card": "card|visa|credit|payment|kredit|tarjeta|carte",
    "phone": "phone|call|tel|fax|mobile", "iban": "iban|bank|account|konto|cuenta|compte", "ssn": "ssn|social|security",
}
#: words that lower it
DENY = "version|example|serial|order|isbn"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _ip_ok(hit: Column) -> Column:
    part = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(part, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _mod97(hit: Column) -> Column:
    """ISO 13616: country and check digits last, letters as 10..35, remainder 1."""
    s = F.regexp_replace(hit, " ", "")
    s = F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4))
    code = lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    return F.aggregate(F.split(s, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(
        (acc * F.when(c >= "A", 100).otherwise(10) + code(c)) % 97).cast("int")) == 1


def _proposed(text: Column, no: int, kind: str, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias(f"_h{no}")


def find(docs: DataFrame, threshold: float = 0.5, context_chars: int = 40) -> DataFrame:
    """All spans with their scores: doc_id, _row and ``spans``, one row per row.

    ``spans`` is an array of (kind, start, end, score, base), by kind as listed
    in ``KINDS`` and then start; offsets count code points, end exclusive.
    Scores: the kind's prior, +0.25 for a confirmed checksum (Luhn, mod 97),
    +0.2 for a context word within ``context_chars``, -0.2 for a word that
    speaks against it, held within 0..1. Spans of the base kinds that pass
    their checks stay whatever the score; others need ``threshold``, and an
    IBAN its checksum. Spans of an added kind may lie inside others.

    Null text counts as empty; null or repeated doc_ids are separate rows (the
    row number of the scan tells them apart); other columns are not read.
    """
    d = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id"), F.coalesce("text", F.lit("")).alias("_t"))
    d = d.select("*", *[_proposed(F.col("_t"), n, k, p) for n, (k, p, _) in enumerate(KINDS)])
    empty = F.array().cast("array<string>")
    d = d.select("*", *[F.when(F.size(f"_h{n}") > 0, F.split("_t", p, -1)).otherwise(empty).alias(f"_p{n}")
                        for n, (_, p, _) in enumerate(KINDS)])

    def hits(n: int) -> Column:
        h, p = F.col(f"_h{n}"), F.col(f"_p{n}")
        return F.when(F.size(h) == 0, F.array().cast("array<struct<k:int,i:int,gap:int,hit:string,around:string>>")).otherwise(
            F.transform(F.arrays_zip(h.alias("h"), F.slice(p, 1, F.size(h)).alias("a"), F.slice(p, 2, F.size(h)).alias("b")),
                        lambda x, i: F.struct(F.lit(n).alias("k"), i.alias("i"), F.length(x["a"]).alias("gap"), x["h"].alias("hit"),
                                              F.concat(F.substring(x["a"], -context_chars, context_chars), F.lit(" "),
                                                       F.substring(x["b"], 1, context_chars)).alias("around"))))

    d = d.select("_row", "doc_id", F.explode_outer(F.concat(*[hits(n) for n in range(len(KINDS))])).alias("e"))
    d = d.select("_row", "doc_id", "e.*").repartition("_row")
    end = F.sum(F.col("gap") + F.length("hit")).over(Window.partitionBy("_row", "k").orderBy("i"))
    d = d.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit"))
    digits = F.length(_digits(F.col("hit")))
    luhn = (F.col("k") == 2) & digits.between(16, 19) & F.call_function("luhn_check", _digits(F.col("hit")))
    mod97 = (F.col("k") == 4) & F.regexp_replace("hit", " ", "").rlike("^.{15,34}$") & _mod97(F.col("hit"))
    valid = (F.when(F.col("k") == 0, F.lit(True)).when(F.col("k") == 1, _ip_ok(F.col("hit"))).when(F.col("k") == 2, luhn)
             .when(F.col("k") == 3, digits.between(8, 15)).when(F.col("k") == 4, mod97).when(F.col("k") == 5, F.lit(True)).otherwise(F.lit(False)))
    near = F.lit(False)
    prior = F.lit(0.0)
    for n, (k, _, p) in enumerate(KINDS):
        near = F.when(F.col("k") == n, F.col("around").rlike(rf"(?i)\b(?:{CONTEXT[k]})")).otherwise(near)
        prior = F.when(F.col("k") == n, F.lit(p)).otherwise(prior)
    score = (prior + F.when(F.col("k").isin(2, 4), 0.25).otherwise(0.0) + F.when(near, 0.2).otherwise(0.0)
             - F.when(F.col("around").rlike(rf"(?i)\b(?:{DENY})\b"), 0.2).otherwise(0.0))
    d = d.withColumn("score", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 2))
    kept = valid & ((F.col("k") < len(BASE)) | (F.col("score") >= threshold))
    name = F.element_at(F.array(*[F.lit(k) for k, _, _ in KINDS]), F.col("k") + 1)
    span = F.when(kept, F.struct("k", "start", "end", name.alias("kind"), "score", (F.col("k") < len(BASE)).alias("base")))
    return d.groupBy("_row", "doc_id").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``find`` with the digest columns: counts of base spans and the spans as text.

    A document without spans has counts 0, ``base_sha256`` of the empty string
    and empty ``spans``.
    """
    f = find(docs)
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda n: F.size(F.filter("spans", lambda s: s["k"] == n)).cast("long")
    return f.select(
        "doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(BASE)],
        F.sha2(F.encode(text(base), "UTF-8"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"))
