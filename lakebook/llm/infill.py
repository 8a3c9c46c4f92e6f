"""Fill-in-middle: texts rearranged as prefix, suffix and middle, cut between lines.

A text of n lines has n + 1 boundaries, and a cut is the rank of one of them. Where a
rank stands in the text is answered by a learned rank index, made once per text:

* A greedy cone fits straight lines to all (rank, offset) pairs. A line starts at a
  boundary and is carried on while some slope keeps every boundary within ``ERROR`` code
  points of it; the first boundary that no slope keeps starts the next line.
* The differences between offsets and predictions are stored, one signed byte each.

A cut finds its line, predicts its offset, and adds the stored difference: exact, and
the index takes a byte a line of text and 24 bytes a fitted line, where plain offsets
would take 8 bytes a line. Cutting, joining and restoring are Spark's own expressions.

Ranks come from a hash of the id (``draws``), so every run cuts alike. Markers must not
occur in a text that is cut, for the parts to be found again; such texts stay plain.

Defined cases. Null text: empty, no lines, plain. A null id is hashed as if written as
nothing. Equal rows are cut alike, equal texts with other ids are not. Very long texts are
cut whole; a text without a line break is one line. Columns of any name stay apart, since
results carry the names below only. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebook.llm.shared import small_batches

#: Code points that a fitted line may be off, so that a difference fits a signed byte.
ERROR = 120
#: Boundaries that a fit looks ahead at once.
LOOK_AHEAD = 256
INDEX = "n int, first binary, start binary, slope binary, rest binary"


@dataclass(frozen=True)
class Markers:
    """What stands before each part of a rearranged text."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


# Learned rank index ------------------------------------------------------------


def boundaries(text: str) -> np.ndarray:
    """Offsets, in code points, between lines: 0, behind each line break, and the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    behind = np.flatnonzero(points == 10) + 1
    if len(points) and (not len(behind) or behind[-1] != len(points)):
        behind = np.append(behind, len(points))
    return np.concatenate(([0], behind)).astype(np.int64)


def fit_lines(offsets: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first rank, offset there, slope) of lines that miss no offset by more than ``error``."""
    first, slope = [], []
    at, n = 0, len(offsets)
    while at < n:
        low, high, end = -np.inf, np.inf, at + 1
        while end < n:
            ahead = np.arange(end, min(end + LOOK_AHEAD, n))
            run, rise = ahead - at, offsets[ahead] - offsets[at]
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            inside = lows <= highs
            kept = len(ahead) if inside.all() else int(inside.argmin())
            if kept:
                low, high = lows[kept - 1], highs[kept - 1]
                end += kept
            if kept < len(ahead):
                break
        first.append(at)
        slope.append((low + high) / 2 if end > at + 1 else 0.0)
        at = end
    ranks = np.array(first, dtype=np.int64)
    return ranks, offsets[ranks], np.array(slope)


def predict(rank: np.ndarray, first: np.ndarray, start: np.ndarray, slope: np.ndarray) -> np.ndarray:
    line = np.searchsorted(first, rank, side="right") - 1
    return start[line] + np.rint(slope[line] * (rank - first[line])).astype(np.int64)


def line_index(text: Column) -> Column:
    """The index of a text's line boundaries, a struct as in ``INDEX``."""

    @F.pandas_udf(INDEX)
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            offsets = boundaries(text or "")
            first, start, slope = fit_lines(offsets)
            rest = offsets - predict(np.arange(len(offsets)), first, start, slope)
            rows.append(
                (len(offsets) - 1, first.astype("<i4").tobytes(), start.astype("<i8").tobytes(),
                 slope.astype("<f8").tobytes(), rest.astype(np.int8).tobytes())
            )
        return pd.DataFrame(rows, columns=["n", "first", "start", "slope", "rest"])

    return of(text)


def offset_at(index: Column, *ranks: Column) -> Column:
    """Offsets of boundaries by rank, in code points: predicted, then corrected."""

    @F.pandas_udf("array<long>")
    def of(indexes: pd.DataFrame, asked: pd.Series) -> pd.Series:
        found = []
        for first, start, slope, rest, wanted in zip(
            indexes["first"], indexes["start"], indexes["slope"], indexes["rest"], asked, strict=True
        ):
            rank = np.asarray(wanted, dtype=np.int64)
            near = predict(rank, np.frombuffer(first, "<i4"), np.frombuffer(start, "<i8"), np.frombuffer(slope, "<f8"))
            found.append(near + np.frombuffer(rest, np.int8)[rank])
        return pd.Series(found, dtype=object)

    return of(index, F.array(*[r.cast("long") for r in ranks]))


# Rearranging -------------------------------------------------------------------


def draws(id_col: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the SHA-256 of ``seed:id``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    digest = F.sha2(named.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def rearranged(form: str, prefix: str, middle: str, suffix: str, markers: Markers) -> Column:
    """The parts joined in the order of the form; a plain text has all of it in ``prefix``."""
    before, after, between = (F.lit(m) for m in markers.all())
    return (
        F.when(F.col(form) == "psm", F.concat(before, F.col(prefix), after, F.col(suffix), between, F.col(middle)))
        .when(F.col(form) == "spm", F.concat(after, F.col(suffix), before, F.col(prefix), between, F.col(middle)))
        .otherwise(F.col(prefix))
    )


def restored(output: Column, form: Column, markers: Markers | None = None) -> Column:
    """The text that was rearranged, from the output and its form alone."""
    markers = markers or Markers()
    before, after, between = (r"\Q" + m + r"\E" for m in markers.all())
    psm, spm = f"(?s)^{before}(.*?){after}(.*?){between}(.*)$", f"(?s)^{after}(.*?){before}(.*?){between}(.*)$"
    return (
        F.when(form == "psm", F.regexp_replace(output, psm, "$1$3$2"))
        .when(form == "spm", F.regexp_replace(output, spm, "$2$3$1"))
        .otherwise(output)
    )


def fill_in_middle(
    frame: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = 7,
    percent: int = 100, spm_percent: int = 50, markers: Markers | None = None,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, index) of every row.

    ``percent`` of the texts are cut, ``spm_percent`` of these put their suffix first.
    ``n`` counts lines.
    """
    small_batches(frame.sparkSession)
    markers = markers or Markers()
    given = frame.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.array(*draws(F.col(id_col), seed)).alias("h"),
    ).withColumn("index", line_index(F.col("text")))
    marked = [F.contains("text", F.lit(m)) for m in markers.all()]
    plain = (F.col("text") == "") | marked[0] | marked[1] | marked[2] | (F.col("h")[2] % 100 >= percent)
    units = F.col("index.n") + 1
    drawn = given.withColumns(
        {
            "form": F.when(plain, "plain").when(F.col("h")[3] % 100 < spm_percent, "spm").otherwise("psm"),
            "cut": offset_at(F.col("index"), *[F.pmod(F.col("h")[i], units) for i in (0, 1)]),
        }
    )
    whole = F.col("form") == "plain"
    first, last = F.array_min("cut").cast("int"), F.array_max("cut").cast("int")
    parts = drawn.select(
        "doc_id", F.col("index.n").cast("long").alias("n"), "form", "index",
        F.when(~whole, F.array_min("cut")).alias("prefix_chars"),
        F.when(~whole, F.array_max("cut") - F.array_min("cut")).alias("middle_chars"),
        F.when(whole, F.col("text")).otherwise(F.substring("text", F.lit(1), first)).alias("prefix"),
        F.substring("text", first + 1, last - first).alias("middle"),
        F.substring("text", last + 1, F.length("text")).alias("suffix"),
    )
    return parts.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        rearranged("form", "prefix", "middle", "suffix", markers).alias("output"), "index",
    )
