"""Quality rules: base rules within a text, and how often its lines recur on its host.

Only DataFrame functions; no Python runs on the executors.

The base rules look at one row. Repeated 3-word windows are found by sorting the
row's (window hash, position) pairs, so a long text costs n log n. The line rule hashes
normalised lines (lower case, white space collapsed, lines without a word left out),
counts per host the documents that hold a line, and removes lines found in more than
``min_docs`` documents and more than ``share`` of the host's documents, or in more than
``enough_docs`` documents however large the host is. A document that loses more than ``max_lost`` of its characters that way is rejected.

Counts are partial sums before they shuffle, so a line or host that holds a third of
all rows moves one row per task. The table of lines above the limits has, per host, at
most (mean lines a document) / share rows, and one row for each ``enough_docs`` lines of
the rest; it is broadcast only after it was counted.

Defined cases. Null or empty text: no words, so ``base_failed``. Null host: the host
''. Repeated rows and exact copies each count as a document. An empty table gives no
rows. Window hashes have 64 bits: two windows of a text that differ count as equal with
a chance of about n^2 / 2^65.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebook.llm.shared import WHITE, lookup, stored

MIN_DOCS, SHARE, MAX_LOST = 10, 0.01, 0.5
#: Documents of a host that make a line common by themselves; the share decides alone on
#: hosts of up to ENOUGH_DOCS / SHARE documents.
ENOUGH_DOCS = 1_000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _lines(text: Column) -> Column:
    """Normalised lines that hold a word, as (h, n): hash and characters."""
    flat = F.lower(F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " "))
    trimmed = F.transform(F.split(flat, "\n"), lambda line: F.trim(line))  # trim itself would take the index
    return F.transform(
        F.filter(trimmed, lambda line: line != ""),
        lambda line: F.struct(F.xxhash64(line).alias("h"), F.length(line).alias("n")),
    )


def _base(frame: DataFrame) -> DataFrame:
    """The base counts of ``_lb_text``, in steps that each are computed once a row."""
    text = F.col("_lb_text")
    with_word = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")) != "")
    rows = frame.withColumns(
        {
            "_lb_words": F.array_remove(F.split(text, f"[{WHITE}]+"), ""),
            "_lb_with_word": with_word,
            "n_symbols": (
                F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
            ).cast("long"),
        }
    )
    windows = F.expr(
        "if(size(_lb_words) < 3, cast(array() as array<struct<h:bigint,i:int>>),"
        " sort_array(transform(sequence(0, size(_lb_words) - 3), i -> struct("
        "xxhash64(get(_lb_words, i), get(_lb_words, i + 1), get(_lb_words, i + 2)) as h, i as i))))"
    )
    rows = rows.select(
        *[c for c in frame.columns if c != "_lb_text"],
        F.size("_lb_words").cast("long").alias("n_words"),
        F.length(F.array_join("_lb_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lb_with_word") - F.size(F.array_distinct("_lb_with_word"))).cast("long").alias("n_dup_lines"),
        windows.alias("_lb_windows"),
    )
    # A window is repeated if a sorted neighbour has its hash.
    repeated = F.expr(
        "transform(array(_lb_windows), w -> sort_array(transform(filter(w, (x, i) ->"
        " get(w, i - 1).h <=> x.h or get(w, i + 1).h <=> x.h), x -> x.i)))[0]"
    )
    rows = rows.withColumn("_lb_repeated", repeated).drop("_lb_windows")
    covered = F.expr(
        "aggregate(_lb_repeated, struct(0L as n, -3 as last), (a, p) -> struct("
        "a.n + least(3, p - a.last) as n, p as last), a -> a.n)"
    )
    return rows.withColumn("n_repeat_words", covered).drop("_lb_repeated")


def frequent_lines(
    frame: DataFrame, text: str = "text", host: str = "source",
    min_docs: int = MIN_DOCS, share: float = SHARE, enough_docs: int = ENOUGH_DOCS,
) -> DataFrame:
    """(host, h, n_docs) of the lines above the limits; stored."""
    docs = frame.select(
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(text), F.lit("")).alias("_lb_text"),
    )
    hosts = docs.groupBy("host").agg(F.count("*").alias("host_docs"))
    distinct = F.array_distinct(F.transform(_lines(F.col("_lb_text")), lambda x: x["h"]))
    lines = (
        docs.select("host", F.explode(distinct).alias("h"))
        .groupBy("host", "h")
        .agg(F.count("*").alias("n_docs"))
        .where(F.col("n_docs") > min_docs)
    )
    common = (F.col("n_docs") > share * F.col("host_docs")) | (F.col("n_docs") > enough_docs)
    above = lines.join(hosts, "host").where(common)
    return stored(above.select("host", "h", "n_docs"), "lines")


def quality_rules(
    frame: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source",
    min_docs: int = MIN_DOCS, share: float = SHARE, max_lost: float = MAX_LOST,
    keep_text: bool = False, enough_docs: int = ENOUGH_DOCS,
) -> DataFrame:
    """One row per document: the base counts, what lines it loses, and the verdicts.

    With ``keep_text`` the text without the removed lines follows as ``clean_text``.
    """
    above = lookup(frequent_lines(frame, text, host, min_docs, share, enough_docs))
    raw = F.coalesce(F.col(text), F.lit(""))
    extra = {"_lb_kept_text": raw} if keep_text else {}
    docs = frame.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        *[c.alias(name) for name, c in extra.items()],
        raw.alias("_lb_text"),
    ).withColumns({"_lb_row": F.monotonically_increasing_id(), "_lb_lines": _lines(F.col("_lb_text"))})
    rows = _base(docs)
    keys = ["_lb_row", "doc_id", *BASE, *extra]
    lines = rows.withColumn(
        "line_chars", F.aggregate("_lb_lines", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    ).select(*keys, "line_chars", "host", F.explode_outer("_lb_lines").alias("line"))
    found = lines.select(
        *keys, "line_chars", "host", F.col("line.h").alias("h"), F.col("line.n").alias("n")
    ).join(above, ["host", "h"], "left")
    gone = F.col("n_docs").isNotNull()
    hashes = [F.collect_set(F.when(gone, F.col("h"))).alias("_lb_gone")] if keep_text else []
    totals = found.groupBy(*keys, "line_chars").agg(
        F.count(F.when(gone, 1)).alias("n_removed_lines"),
        F.coalesce(F.sum(F.when(gone, F.col("n"))), F.lit(0)).cast("long").alias("removed_chars"),
        *hashes,
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.col("removed_chars") > max_lost * F.col("line_chars")
    result = totals.select(
        "doc_id", *BASE, failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
        "n_removed_lines", "removed_chars", "line_chars",
        *([_clean(F.col("_lb_kept_text"), F.col("_lb_gone")).alias("clean_text")] if keep_text else []),
    )
    return result


def _clean(text: Column, gone: Column) -> Column:
    def stays(line: Column) -> Column:
        flat = F.trim(F.lower(F.regexp_replace(line, r"[\x20\x09\x0B-\x0D]+", " ")))
        return ~F.array_contains(gone, F.xxhash64(flat))

    return F.array_join(F.filter(F.split(text, "\n"), stays), "\n")
