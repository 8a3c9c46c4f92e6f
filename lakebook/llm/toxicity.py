"""Toxicity by a weighted finite-state grammar over clauses.

A text is cut into clauses, and ``grammar`` scores each: an insult weighs more near a
target and less after a negation or a report, a threat is a phrase with its object, and a
word without company is no clause and scores nothing. Marks (``. ! ? ; :`` and line ends)
end a clause, but not after a single word: one word between marks belongs to the clause
that follows, so "YOU!! ARE!! A!! MORON!!" is one clause.

Which words are insults is learned from labelled rows: words, and stems of four to six
letters, that stand in toxic documents far more often than in others, weighted by their
log-odds. All that pass ``MIN_DOCS``, ``MIN_SHARE`` and ``MIN_ODDS`` are kept; each stands in
a share of at least ``MIN_SHARE`` of the toxic rows learned from, so there are at most
1 / ``MIN_SHARE`` times as many as such a row holds on average. Two thirds of the learning
rows give the lexicon; the others, which have not shaped it, fit a logistic curve from
clause scores to the chance that a document is toxic. About ``SAMPLE_DOCS`` labelled rows are
used, chosen by a hash of their id; every text is scored whole.

Defined cases. Null and empty texts: no clauses, and the score of a text without any
match. Very long texts: scored whole, clause by clause. Repeated rows: scored alike, one
result each. Repeated labels of a document: toxic if one says so. Rows without a known
label teach nothing. With labels of one kind only, every score is that kind's share. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebook.llm.grammar import INSULT, OTHER, PHRASES, THREAT, THREAT_WEIGHT, Event, clause_score
from lakebook.llm.shared import lookup, small_batches, stored

SAMPLE_DOCS = 20_000
STEMS = (4, 5, 6)
MIN_DOCS, MIN_SHARE, MIN_ODDS = 3, 0.004, 2.0
REMEMBER = 300_000

MARKS = frozenset(".!?;:\n")
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")


# Scoring -----------------------------------------------------------------------


def in_clauses(tokens: list[str]) -> tuple[list[str], list[int]]:
    """The words, and where clauses end: at marks after two words or more since the last mark, and at the end."""
    words, ends, last = [], [], 0
    for token in tokens:
        if token not in MARKS:
            words.append(token)
        else:
            if len(words) - last > 1:
                ends.append(len(words))
            last = len(words)
    return words, [*ends, len(words)]


class Matcher:
    """Finds a text's clause scores with a lexicon of words and stems."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]) -> None:
        self.words, self.stems = words, stems
        #: Of each word met: its weight as an insult, or 0 if it only begins phrases; None is any other.
        self.known: dict[str, float | None] = {}

    def weight(self, word: str) -> float | None:
        learned = max([self.words.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in STEMS if len(word) > n)])
        return learned if learned > 0 or word in PHRASES.arcs[0] else None

    def events(self, words: list[str], places: list[int], end: int) -> list[Event]:
        """What the phrase machine writes for the words before ``end``, from those at ``places``."""
        found, past = [], -1
        for at in places:
            if at < past:
                continue
            phrase = PHRASES.longest(words, at, end)
            learned = self.known[words[at]]
            if phrase and (phrase[0] == THREAT or not learned):
                found.append((at, phrase[0], THREAT_WEIGHT if phrase[0] == THREAT else 0.0))
                past = phrase[1]
            elif learned:
                found.append((at, INSULT, learned))
        return found

    def clauses(self, text: str) -> list[float]:
        """The scores above 0."""
        tokens = _TOKEN.findall(text.lower())
        known = self.known
        if len(known) > REMEMBER:
            known.clear()
        for word in set(tokens).difference(known, MARKS):
            known[word] = self.weight(word)
        words, ends = in_clauses(tokens)
        hits = [i for i, w in enumerate(words) if known[w] is not None]
        scores, begin, hit = [], 0, 0
        for end in ends:
            first = hit
            while hit < len(hits) and hits[hit] < end:
                hit += 1
            if hit > first:
                events = self.events(words, hits[first:hit], end)
                if any(e[1] in (INSULT, THREAT) for e in events):
                    if len(events) < end - begin:  # words beside the phrases
                        events.insert(0, (events[0][0], OTHER, 0.0))
                    scores.append(clause_score(events))
            begin = end
        return [s for s in scores if s > 0]

    def features(self, text: str) -> tuple[float, float, float, float]:
        scores = self.clauses(text)
        if not scores:
            return 0.0, 0.0, 0.0, 0.0
        return max(scores), float(np.log1p(sum(scores))), float(np.log1p(len(scores))), sum(scores) / (20 + len(text) / 50)


FEATURES = 4


@dataclass
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # the last one stands alone

    def chance(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.centre) / self.spread) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


# Learning ----------------------------------------------------------------------


def _document_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many toxic and other documents hold each word and each stem (marked with *)."""
    for batch in batches:
        toxic, other = Counter(), Counter()
        for text, label in zip(batch["text"], batch["toxic"], strict=True):
            words = {w for w in _TOKEN.findall((text or b"").decode("utf-8", "replace").lower()) if w.isalpha()}
            stems = {f"{w[:n]}*" for w in words for n in STEMS if len(w) > n}
            (toxic if label else other).update(words | stems)
        keys = list(toxic.keys() | other.keys())
        yield pd.DataFrame({"word": keys, "toxic": [toxic[k] for k in keys], "other": [other[k] for k in keys]})


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps on the ridge-penalised likelihood."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.diag([ridge * len(x) / 100 + ridge] * (x.shape[1] - 1) + [1e-9])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(labelled: DataFrame) -> Model:
    """From ``labelled`` (fold 0 to 2, text as binary, toxic boolean), a bounded stored table."""
    lexicon_rows, curve_rows = labelled.where("fold < 2"), labelled.where("fold = 2")
    totals = {r["toxic"]: r["n"] for r in lexicon_rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_other = totals.get(True, 0), totals.get(False, 0)
    odds = F.log((F.col("toxic") + 0.1) / (n_toxic + 1.0)) - F.log((F.col("other") + 0.1) / (n_other + 1.0))
    counted = (
        lexicon_rows.select("text", "toxic")
        .mapInPandas(_document_words, "word string, toxic long, other long")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where(F.col("toxic") >= max(MIN_DOCS, MIN_SHARE * n_toxic))
        .withColumn("odds", odds)
        .where(F.col("odds") >= MIN_ODDS)
        .collect()
    )
    words = {r["word"]: r["odds"] for r in counted if not r["word"].endswith("*")}
    stems = {r["word"][:-1]: r["odds"] for r in counted if r["word"].endswith("*")}

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(words, stems)
        for batch in batches:
            rows = [matcher.features((t or b"").decode("utf-8", "replace")) for t in batch["text"]]
            yield pd.DataFrame({"f": rows, "toxic": batch["toxic"].to_numpy()})

    measured = curve_rows.select("text", "toxic").mapInPandas(measure, "f array<double>, toxic boolean").collect()
    x = np.array([r["f"] for r in measured], dtype=float).reshape(-1, FEATURES)
    y = np.array([float(r["toxic"]) for r in measured])
    centre = x.mean(axis=0) if len(x) else np.zeros(FEATURES)
    spread = np.maximum(x.std(axis=0), 1e-6) if len(x) else np.ones(FEATURES)
    if not 0 < y.sum() < len(y):
        share = (n_toxic + 0.5 * (not n_toxic + n_other)) / max(1, n_toxic + n_other)
        weights = np.zeros(FEATURES + 1)
        weights[-1] = np.log((share + 1e-6) / (1 - share + 1e-6))
        if words or stems:  # both kinds shaped the lexicon: any full match counts
            weights[1] = 3.0
        return Model(words, stems, np.zeros(FEATURES), np.ones(FEATURES), weights)
    return Model(words, stems, centre, spread, fit_logistic((x - centre) / spread, y))


def learning_rows(
    frame: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text",
    label: str = "toxic", sample: int = SAMPLE_DOCS,
) -> DataFrame:
    """About ``sample`` labelled rows that ``learn`` (a condition on ``id_col``) allows; stored."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & learn)
        .groupBy(F.col(id_col).alias("_lb_id"))
        .agg((F.max(label) > 0).alias("toxic"))
    )
    place = F.pmod(F.xxhash64(F.col("_lb_id")), F.lit(3 << 20))
    share = min(1.0, sample / max(known.count(), 1))
    chosen = known.where(F.floor(place / 3) < int(share * (1 << 20))) if share < 1 else known
    chosen = stored(chosen.withColumn("fold", (place % 3).cast("int")), "labels")
    rows = frame.select(F.col(id_col).alias("_lb_id"), F.col(text).cast("binary").alias("text"))
    return stored(rows.join(lookup(chosen), "_lb_id").select("fold", "text", "toxic"), "labelled")


def score(frame: DataFrame, model: Model, text: str = "text") -> Column:
    """The chance, 0 to 1, that a text is toxic."""
    shared = frame.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        matcher = Matcher(own.words, own.stems)
        for batch in batches:
            rows = [matcher.features((t or b"").decode("utf-8", "replace")) for t in batch]
            yield pd.Series(own.chance(np.array(rows, dtype=float).reshape(-1, FEATURES)))

    return of(F.col(text).cast("binary"))


def toxicity(
    frame: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS
) -> DataFrame:
    """(doc_id, score) of every row of ``frame``."""
    small_batches(frame.sparkSession)
    model = train(learning_rows(frame, labels, learn, id_col, text, sample=sample))
    return frame.select(F.col(id_col).alias("doc_id"), score(frame, model, text).alias("score"))
