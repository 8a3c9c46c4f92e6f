"""The grammar of hurtful clauses: machines one by one against the composed one, and what acts on what."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakebook.llm import grammar, toxicity
from lakebook.llm.grammar import INSULT, NEGATION, OTHER, PARTS, REPORT, TARGET, THREAT, clause_score, tape


def every_tape(machine, symbols):
    """All (written symbols, factors) of accepted paths of one machine over a whole tape."""
    paths = [(0, [], [])]
    for symbol in symbols:
        paths = [
            (to, [*written, out], [*factors, factor])
            for state, written, factors in paths
            for out, factor, to in machine.read(state, symbol)
        ]
    return [(written, factors) for state, written, factors in paths if state in machine.final]


def one_after_the_other(events):
    symbols, weights = zip(*tape(events), strict=True)
    tapes = [(list(symbols), [1.0] * len(symbols))]
    for machine in PARTS:
        tapes = [
            (written, [f * g for f, g in zip(before, factors, strict=True)])
            for read, before in tapes
            for written, factors in every_tape(machine, read)
        ]
    return max((sum(w * f for w, f in zip(weights, factors, strict=True)) for _, factors in tapes), default=0.0)


def test_composed_machine_equals_its_parts():
    draw = random.Random(5)
    scored = 0
    for _ in range(1500):
        place, events = 0, []
        for _ in range(draw.randint(1, 7)):
            place += draw.choice([1, 1, 2, 3, 9])
            symbol = draw.choice([OTHER, INSULT, INSULT, THREAT, TARGET, NEGATION, REPORT])
            events.append((place, symbol, draw.uniform(0.5, 9) if symbol in (INSULT, THREAT) else 0.0))
        expected = one_after_the_other(events)
        assert clause_score(events) == pytest.approx(expected)
        scored += expected > 0
    assert scored > 500


def test_longest_phrase_wins():
    words = "people like you are not far from it".split()
    assert grammar.PHRASES.longest(words, 0, len(words)) == (TARGET, 3)
    assert grammar.PHRASES.longest(words, 0, 2) == (TARGET, 1)  # a clause's end cuts a phrase
    assert grammar.PHRASES.longest(words, 5, len(words)) == (NEGATION, 7)
    assert grammar.PHRASES.longest(words, 7, len(words)) is None


@pytest.fixture(scope="module")
def best():
    matcher = toxicity.Matcher({"moron": 3.0}, {"vequ": 2.0})
    return lambda text: max(matcher.clauses(text), default=0.0)


@pytest.mark.parametrize("text", ["", "moron", "Moron!", "kill", "we kill time", "you said not, never", "...", "hope"])
def test_single_words_and_verbs_are_no_clauses(best, text):
    assert best(text) == 0


def test_what_raises_and_lowers_a_clause(best):
    bare = best("the moron was a film")
    assert bare == 3.0
    assert best("you moron") == best("moron like you") == best("you are a moron") == 4.5 > bare
    assert best("he said you are a moron") < bare  # reported, though aimed
    assert best("according to them you are a moron") < bare
    assert best("you are not a moron") < bare
    assert best("you are far from a vequxx") == 2.0 * 1.5 * 0.5
    assert best("moron, moron, you") > best("you moron")  # more of it
    assert best("not one two three four five six a moron") == bare  # out of reach
    assert best("moron one two three four five six you") == bare  # a promise of a target that came too late
    assert best("it is you. the moron") == bare
    assert best("i hope you die") == 2 * grammar.THREAT_WEIGHT > best("he said i hope you die") > 0


def test_one_word_between_marks_is_no_clause_of_its_own(best):
    assert best("YOU!! ARE!! A!! MORON!!") == 4.5
    assert best("Moron! Go away.") == 3.0
    assert best("Go away. Moron!") == 0


def test_rows_that_are_long_repeated_or_have_clashing_columns(spark):
    long = "a fine day. " * 60_000 + "you idiot. " + "a fine day. " * 60_000
    texts = ["you idiot moron"] * 12 + ["a nice day"] * 30 + [long, long]
    rows = [(i, t, 1.0, "x", 0, 0) for i, t in enumerate(texts)] + [(42, long, 1.0, "x", 0, 0), (None, long, 1.0, "x", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, _lb_id string, toxic int, fold int")
    labels = spark.createDataFrame([(i, 0, int(i < 12)) for i in range(42)], "doc_id long, quality int, toxic int")
    got = defaultdict(set)
    scored = toxicity.toxicity(docs, labels, F.lit(True))
    assert scored.columns == ["doc_id", "score"]
    for r in scored.collect():
        got[r.doc_id].add(r.score)
    assert scored.count() == len(rows) and got[42] == got[43] == got[None] and len(got[42]) == 1
    assert max(got[42]) > max(got[20])
