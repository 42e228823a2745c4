"""Line dedup over a suffix array of line ids, built by prefix doubling.

DataFrame functions only. A suffix is a position (document, line); its rank
after doubling to depth k is the concatenation of its first k line ids, 16
bytes each, so sorting by rank is the suffix array at depth k and suffixes
that share a rank are one LCP interval of depth >= k. Suffixes whose rank is
theirs alone can start no repeat and leave before the next doubling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparklab.llm.common import keep, with_rows

#: bytes of a line id
ID = 16


def _shared(suffixes: DataFrame) -> DataFrame:
    """Suffixes whose rank another one has too. The counts combine on the map
    side; written first, they are shuffled on their own in the join, so that
    AQE can split a rank that a third of all lines have."""
    n = keep(suffixes.groupBy("rank").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    return suffixes.join(n, "rank")


def suffix_ranks(lines: DataFrame, depth: int):
    """(k, suffixes) for k = 1, 2, 4, ... and ``depth``: suffixes (_row, doc_id, pos, rank, words) with a common
    prefix of k lines elsewhere, by prefix doubling from ``lines`` of the same columns; ``words`` are those of the prefix
    (at ``depth`` not defined)."""
    active, k = keep(_shared(lines)), 1
    yield k, active
    while k < depth:
        step = min(k, depth - k)
        tail = active.select(F.col("_row").alias("_r"), (F.col("pos") - step).alias("_p"),
                             F.substring("rank", (k - step) * ID + 1, step * ID).alias("_tail"), F.col("words").alias("_more"))
        longer = active.join(tail, (F.col("_row") == F.col("_r")) & (F.col("pos") == F.col("_p")))
        longer = longer.select("_row", "doc_id", "pos", F.concat("rank", "_tail").alias("rank"), (F.col("words") + F.col("_more")).alias("words"))
        active, k = _shared(keep(longer)), k + step
        yield k, active


def line_runs(rows: DataFrame, min_lines: int = 3, min_words: int | None = 50) -> DataFrame:
    """Maximal runs of lines of ``rows(_row, doc_id, text)`` that repeat an earlier place: (_row, start, end), end exclusive.

    Earlier is by doc_id (null first), then row of the scan, then line. The
    first place of an LCP interval of depth >= ``min_lines`` is kept, all
    others start a copy, and so do those of 1, 2, 4, ... lines below it that
    hold ``min_words`` words or more (None: no such rule); copies that touch or
    overlap in a document are one run.
    """
    lines = rows.select("_row", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "_line"))
    words = F.regexp_count("_line", F.lit(r"[^\x20\x09-\x0D]+")) if min_words else F.lit(0)
    lines = lines.select("_row", "doc_id", "pos", F.unhex(F.md5(F.col("_line").cast("binary"))).alias("rank"), words.alias("words"))
    # ranks of different depths differ in length, so the intervals of all depths stay apart
    long = [active.where(F.lit(k == min_lines) | (F.col("words") >= (min_words or 0))).withColumn("_k", F.lit(k))
            for k, active in suffix_ranks(lines, min_lines) if min_words or k == min_lines]
    suffixes = reduce(DataFrame.unionByName, long).drop("words")
    # place as one number, so that the minimum is a hash aggregate: doc_id above row above line; ids that are no
    # integers go by their text, null as the empty one
    whole = rows.schema["doc_id"].dataType.typeName() in ("long", "integer", "short", "byte")
    doc = F.coalesce("doc_id", F.lit(-(1 << 63))) if whole else F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    low = keep(suffixes.groupBy("rank").agg(F.min(doc).alias("_d")))
    first = suffixes.join(low, "rank").where(doc == F.col("_d"))
    place = F.col("_row").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(12,0)") + F.col("pos")
    first = keep(first.groupBy("rank").agg(F.min("_d").alias("_d"), F.min(place).alias("_place")))
    later = suffixes.join(first, "rank").where((doc != F.col("_d")) | (place != F.col("_place")))
    by = Window.partitionBy("_row").orderBy("pos")
    later = later.groupBy("_row", "pos").agg((F.col("pos") + F.max("_k")).alias("_end"))
    reached = F.max("_end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    run = later.withColumn("_new", F.coalesce(F.col("pos") > reached, F.lit(True)).cast("int")).withColumn("_run", F.sum("_new").over(by))
    return run.groupBy("_row", "_run").agg(F.min("pos").alias("start"), F.max("_end").alias("end")).drop("_run")


def dedup_lines(docs: DataFrame, min_lines: int = 3, min_words: int | None = 50) -> DataFrame:
    """``docs`` with later copies of repeated line runs cut out of ``text``: runs of ``min_lines`` lines, or of
    fewer (see ``line_runs``) with ``min_words`` words.

    Lines end at ``\\n`` and are compared as they are, empty lines included.
    Added columns: ``n_lines``, ``n_removed`` (underscored if taken). All rows
    stay: null text stays null with 0 lines, a document whose every line was a
    copy gets empty text. Rows with a null or repeated doc_id are documents of
    their own; of two equal rows the later one (in the scan) is the copy.
    Rows go by the scan's own numbers, see ``with_rows``.
    """
    n_lines, n_removed = "n_lines", "n_removed"
    while {n_lines, n_removed} & {c.lower() for c in docs.columns}:
        n_lines, n_removed = n_lines + "_", n_removed + "_"
    names = [f"_c{i}" for i in range(len(docs.columns))]  # own names can't clash with the input's
    d = with_rows(docs.toDF(*names), "_id")
    c = dict(zip(docs.columns, names, strict=True))
    runs = line_runs(d.select(F.col("_id").alias("_row"), F.col(c["doc_id"]).alias("doc_id"), F.col(c["text"]).alias("text")), min_lines, min_words)
    runs = runs.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_runs"))
    text = F.col(c["text"])
    d = d.join(runs.hint("shuffle_hash"), F.col("_id") == F.col("_row"), "left")
    d = d.withColumn("_lines", F.when(F.col("_runs").isNotNull(), F.split(text, "\n", -1)))
    # what stands between the runs: from the end of one to the start of the next
    gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), F.transform("_runs", lambda r: r["end"])).alias("a"),
                        F.concat(F.transform("_runs", lambda r: r["start"]), F.array(F.size("_lines"))).alias("b"))
    kept = F.flatten(F.transform(gaps, lambda g: F.slice("_lines", g["a"] + 1, g["b"] - g["a"])))
    removed = F.coalesce(F.aggregate("_runs", F.lit(0), lambda acc, r: acc + r["end"] - r["start"]), F.lit(0))
    count = F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    return d.select(
        *[F.when(F.col("_runs").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("text") if c == "text" else F.col(n).alias(c)
          for c, n in zip(docs.columns, names, strict=True)],
        count.cast("long").alias(n_lines), removed.cast("long").alias(n_removed))


SQL = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, pos, k, list_slice(lines, pos, pos + k - 1) AS run
      FROM (SELECT doc_id, lines, k, unnest(range(1, len(lines) - k + 2)) AS pos FROM l, (SELECT unnest([1, 2, 3]) AS k))),
q AS (SELECT * FROM w WHERE k = 3 OR len(regexp_extract_all(array_to_string(run, chr(10)), '[^\x20\x09-\x0D]+')) >= 50),
c AS (SELECT doc_id, pos, k FROM (SELECT doc_id, pos, k, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS n FROM q) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, pos + o AS pos FROM c, (SELECT unnest([0, 1, 2]) AS o) WHERE o < k),
g AS (SELECT doc_id, list(pos) AS pos FROM gone GROUP BY doc_id)
SELECT l.doc_id, coalesce(len(l.lines), 0)::BIGINT AS n_lines, coalesce(len(g.pos), 0)::BIGINT AS n_removed,
  CASE WHEN l.text IS NULL THEN NULL ELSE sha256(coalesce(array_to_string(
    list_filter(list_transform(l.lines, lambda x, i: CASE WHEN list_contains(coalesce(g.pos, []), i) THEN NULL ELSE x END), lambda x: x IS NOT NULL), chr(10)), '')) END AS kept_sha256
FROM l LEFT JOIN g ON l.doc_id = g.doc_id
"""
