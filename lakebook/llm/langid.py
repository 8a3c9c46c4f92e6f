"""Language ID of mixed text: script ranges, word scores, and Viterbi with a switching penalty.

Each word is scored for every learned language by its letter trigrams. The word's
script leaves only the languages that are written in it: another costs more than two
switches, so it is never a word's language. Scripts that write no blanks between words
are cut into pieces of ``PIECE`` letters, which count as words. Viterbi finds the language of
every word that makes the sum of scores, less ``SWITCH`` for each change of language,
greatest; runs of one language are the text's spans. Most texts are shown to be one
span without the search: running sums of what each word gains in the best other language,
whichever it is, bound all that a path can gain by leaving the language of the text.

The model learns from text and language of training rows, of which about
``SAMPLE_DOCS`` are used, chosen by a hash of their text. Trigrams are counted in
``BUCKETS`` hashed buckets, so the model has a fixed size per language.

Defined cases. A text that is null or has no letter: language ``und``, score 0, no
spans. Without training rows every text is ``und``. A script that no language was seen
in leaves all languages. Equal totals go to the language with more training letters.

The score compares learned languages with each other, so a text in none of them can score
high. What may stay is told by evidence that does not depend on how many there are: the
share of the letters that stand in trigrams and scripts seen in training for the language
that their word was given (``evidence``).
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebook.llm.shared import releasing, small_batches

UNDETERMINED = "und"
SAMPLE_DOCS = 20_000
BUCKETS = 1 << 16
SWITCH = 12.0
#: The furthest that one word can stand below its best language.
FLOOR = 6.0
#: Letters of a piece where a script has no blanks between words.
PIECE = 4
#: Share of a language's letters from which it counts as written in a script.
SCRIPT_SHARE = 0.01
#: Share of a language's trigrams from which a bucket counts as seen in it; less is noise.
SEEN_SHARE = 1e-6
#: Evidence from which a language counts as told.
MIN_EVIDENCE = 0.4
#: Distinct words whose scores a task remembers.
REMEMBER = 100_000

# First code point of each range, and its script; fixed values of Unicode's blocks.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"),
    (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Odia"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"),
    (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1780, "Khmer"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"), (0x3040, "Kana"),
    (0x3100, "Han"), (0xAC00, "Hangul"), (0xD7B0, "Han"), (0xFB00, "Latin"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFF00, "Latin"), (0x10000, "Other"),
    (0x20000, "Han"),
)
_STARTS = [start for start, _ in SCRIPTS]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT_AT = {name: i for i, name in enumerate(SCRIPT_NAMES)}
_WORD = re.compile(r"[^\W\d_]+")
# Thai, Lao, Myanmar, Khmer, Kana and Han.
_NO_BLANKS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_HAS_NO_BLANKS = re.compile(f"[{_NO_BLANKS}]")
_CUT = re.compile(rf"[^\W\d_{_NO_BLANKS}]+|(?:(?=[^\W\d_])[{_NO_BLANKS}]){{1,{PIECE}}}")


def pattern(text: str) -> re.Pattern:
    """What finds the words of a text."""
    return _CUT if not text.isascii() and _HAS_NO_BLANKS.search(text) else _WORD


def words_of(text: str) -> list[str]:
    lowered = text.lower()
    return pattern(lowered).findall(lowered)


def script(word: str) -> int:
    """The number of the script of a word's first letter."""
    return _SCRIPT_AT[SCRIPTS[bisect_right(_STARTS, ord(word[0])) - 1][1]]


def buckets(word: str) -> list[int]:
    """The buckets of a word's letter trigrams, with its ends marked."""
    marked = f"^{word}$"
    return [zlib.crc32(marked[i : i + 3].encode("utf-8", "replace")) % BUCKETS for i in range(len(marked) - 2)]


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # (BUCKETS, languages)
    allowed: np.ndarray  # (scripts, languages)
    seen: np.ndarray | None = None  # (BUCKETS, languages), bool; none: all were seen
    written: np.ndarray | None = None  # (scripts, languages), bool: seen in training


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        words: dict[str, Counter] = defaultdict(Counter)
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            words[lang].update(words_of(text.decode("utf-8", "replace")))
        rows = []
        for lang, found in words.items():
            grams, letters = Counter(), Counter()
            for word, n in found.items():
                letters[BUCKETS + script(word)] += n * len(word)
                for bucket in buckets(word):
                    grams[bucket] += n
            rows.extend((lang, b, n) for b, n in [*grams.items(), *letters.items()])
        yield pd.DataFrame(rows, columns=["lang", "bucket", "n"])


def train(labelled: DataFrame, lang: str = "lang", text: str = "text", sample: int = SAMPLE_DOCS) -> Model:
    """A model from rows whose language is known; all rows given may be learned from."""
    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    n = rows.count()
    share = min(1.0, sample / max(n, 1))
    chosen = rows.where(F.pmod(F.xxhash64(text), F.lit(1 << 20)) < int(share * (1 << 20))) if share < 1 else rows
    counted = (
        chosen.select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text"))
        .mapInPandas(releasing(_count), "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    letters: Counter = Counter()
    for row in counted:
        if row["bucket"] >= BUCKETS:
            letters[row["lang"]] += row["n"]
    languages = sorted(letters, key=lambda name: (-letters[name], name))
    at = {name: i for i, name in enumerate(languages)}
    grams = np.zeros((BUCKETS, len(languages)))
    scripts = np.zeros((len(SCRIPT_NAMES), len(languages)))
    for name, bucket, count in counted:
        if bucket >= BUCKETS:
            scripts[bucket - BUCKETS, at[name]] += count
        else:
            grams[bucket, at[name]] += count
    if not languages:
        return Model([], grams.astype(np.float32), scripts > 0)
    seen = max(1, int((grams.sum(axis=1) > 0).sum()))
    logs = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * seen))
    written = scripts >= SCRIPT_SHARE * scripts.sum(axis=0)
    allowed = written | ~written.any(axis=1, keepdims=True)
    common = grams >= np.maximum(1, SEEN_SHARE * grams.sum(axis=0))
    return Model(languages, logs.astype(np.float32), allowed, common, written)


class Labeller:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))
        self.seen = np.zeros((0, len(model.languages)), dtype=np.float32)
        self.letters = np.zeros(0, dtype=np.int64)

    def _learn(self, words: list[str]) -> None:
        """Scores of words not met before, below 0 by how far a language is from the best.

        Languages that the script excludes stand at minus infinity.
        """
        grams = [buckets(w) for w in words]
        sizes = np.array([len(g) for g in grams])
        flat = np.concatenate([np.asarray(g) for g in grams])
        starts = np.concatenate(([0], sizes[:-1].cumsum()))
        sums = np.add.reduceat(self.model.logs[flat], starts, axis=0)
        scripts = [script(w) for w in words]
        allowed = self.model.allowed[scripts]
        most = np.where(allowed, sums, -np.inf).max(axis=1, keepdims=True)
        scores = np.where(allowed, np.maximum(sums - most, -FLOOR), -np.inf)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.scores = np.concatenate([self.scores, scores])
        seen = np.ones_like(scores)
        if self.model.seen is not None:
            seen = np.add.reduceat(self.model.seen[flat], starts, axis=0, dtype=np.int64) / sizes[:, None]
        if self.model.written is not None:
            seen = seen * self.model.written[scripts]
        self.seen = np.concatenate([self.seen, seen.astype(np.float32)])
        self.letters = np.concatenate([self.letters, [sum(c.isalpha() for c in w) for w in words]])

    def look_up(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of each text's words; without languages words have none."""
        if not self.model.languages:
            return [np.zeros(0, dtype=np.int64) for _ in texts]
        words = [words_of(t) for t in texts]
        if len(self.known) > REMEMBER:
            self.known, self.scores, self.letters, self.seen = {}, self.scores[:0], self.letters[:0], self.seen[:0]
        new = list({w for ws in words for w in ws if w not in self.known})
        if new:
            self._learn(new)
        get = self.known.__getitem__
        return [np.fromiter(map(get, ws), dtype=np.int64, count=len(ws)) for ws in words]

    def path(self, scores: np.ndarray, switch: float) -> np.ndarray:
        """The language number of each word."""
        best = int(scores.sum(axis=0).argmax())
        if scores.shape[1] == 1:
            return np.zeros(len(scores), dtype=np.int64)
        # No path over a stretch without the best language gains more than the best other
        # language of each word. It pays a switch at each end that lies within the text;
        # over the whole text it pays one, or is a single language and no better.
        gain = np.cumsum(np.delete(scores, best, axis=1).max(axis=1) - scores[:, best])
        before = np.concatenate(([0.0], gain[:-1]))
        inside = (gain - np.minimum.accumulate(before)).max()
        if max(gain.max(), gain[-1] - before.min()) <= switch and inside <= 2 * switch:
            return np.full(len(scores), best, dtype=np.int64)
        return viterbi(scores, switch)

    def label(self, numbers: np.ndarray, switch: float) -> tuple[str, float, np.ndarray, float]:
        """Language, score, the language number of each word (-1: no letter), and evidence."""
        lettered = self.letters[numbers] > 0 if len(numbers) else np.zeros(0, dtype=bool)
        if not lettered.any() or not self.model.languages:
            return UNDETERMINED, 0.0, np.full(len(numbers), -1), 0.0
        kept = numbers[lettered]
        # Below this, switching there and back for a word always costs less.
        scores = np.maximum(self.scores[kept], -(2 * switch + FLOOR + 1))
        path = self.path(scores, switch)
        share = np.bincount(path, weights=self.letters[kept], minlength=len(self.model.languages))
        best = int(share.argmax())
        own = scores[path == best].sum(axis=0)
        sure = 1.0 / np.exp(np.minimum(own - own[best], 50)).sum()
        whole = np.full(len(numbers), -1)
        whole[lettered] = path
        evidence = float(self.seen[kept, path] @ self.letters[kept] / share.sum())
        return self.model.languages[best], float(share[best] / share.sum() * sure), whole, evidence


def viterbi(scores: np.ndarray, switch: float) -> np.ndarray:
    """The path of greatest sum, less ``switch`` a change; ties stay, then go to the first."""
    rows = scores.tolist()
    sums, back = rows[0], []
    languages = range(len(sums))
    for row in rows[1:]:
        top = max(sums)
        leap, at = top - switch, sums.index(top)
        back.append([i if sums[i] >= leap else at for i in languages])
        sums = [(sums[i] if sums[i] >= leap else leap) + row[i] for i in languages]
    last = sums.index(max(sums))
    path = [last]
    for step in reversed(back):
        last = step[last]
        path.append(last)
    return np.array(path[::-1])


def _spans(text: str, path: np.ndarray, languages: list[str]) -> list[tuple[int, int, str]]:
    """(start, end, language) in characters; words without a letter belong to no span."""
    found: list[list] = []
    for match, number in zip(pattern(text).finditer(text), path.tolist(), strict=bool(languages)):
        if number < 0:
            continue
        if found and found[-1][2] == languages[number]:
            found[-1][1] = match.end()
        else:
            found.append([match.start(), match.end(), languages[number]])
    return [tuple(s) for s in found]


RESULT = "lang_pred string, score double"
SPANS = "spans array<struct<start: int, end: int, lang: string>>"
EVIDENCE = "evidence double"


def detect(
    model: Model, frame: DataFrame, text: Column, switch: float = SWITCH, spans: bool = False, evidence: bool = False
) -> Column:
    """A struct column: language, score 0 to 1 and, if asked for, the spans of ``text`` and its evidence.

    The score is the share of letters in that language times how sure its words are. The
    evidence is the share of letters in trigrams and scripts seen in training.
    """
    small_batches(frame.sparkSession)
    shared = frame.sparkSession.sparkContext.broadcast(model)
    fields = [RESULT, *([SPANS] if spans else []), *([EVIDENCE] if evidence else [])]
    names = ["lang_pred", "score", *(["spans"] if spans else []), *(["evidence"] if evidence else [])]

    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(shared.value)
        for batch in batches:
            rows = []
            for begin in range(0, len(batch), 256):
                texts = [(t or b"").decode("utf-8", "replace") for t in batch.iloc[begin : begin + 256]]
                for body, numbers in zip(texts, labeller.look_up(texts), strict=True):
                    lang, score, path, told = labeller.label(numbers, switch)
                    more = ()
                    if spans:
                        lowered = body.lower()
                        # No language, no spans. A letter whose lower case is longer would shift the places.
                        more = (_spans(body if len(lowered) == len(body) else lowered, path, labeller.model.languages),)
                    rows.append((lang, score, *more, *((told,) if evidence else ())))
            yield pd.DataFrame(rows, columns=names)

    @F.pandas_udf(", ".join(fields))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from releasing(labelled)(batches)

    return of(text.cast("binary"))


def language_id(
    frame: DataFrame, train_on: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
    spans: bool = False,
) -> DataFrame:
    """(doc_id, lang_pred, score) and, if asked for, spans, of every row of ``frame``."""
    found = frame.select(F.col(id_col).alias("doc_id"), detect(train(train_on, lang, text), frame, F.col(text), spans=spans).alias("_lb"))
    return found.select("doc_id", "_lb.*")


def keep_identified(
    frame: DataFrame, train_on: DataFrame, text: str = "text", lang: str = "lang", min_evidence: float = MIN_EVIDENCE
) -> DataFrame:
    """The rows, all columns, whose language could be told with at least ``min_evidence``."""
    found = frame.withColumn("_lb_found", detect(train(train_on, lang, text), frame, F.col(text), evidence=True))
    good = (F.col("_lb_found.lang_pred") != UNDETERMINED) & (F.col("_lb_found.evidence") >= min_evidence)
    return found.where(good).drop("_lb_found")
