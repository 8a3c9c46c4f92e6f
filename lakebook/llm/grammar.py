"""A weighted finite-state grammar of hurtful clauses.

Transducers read one tape and write another. The first reads the words of a clause: its
arcs spell phrases, the longest that fits, and it writes what they are: an insult, threat,
target, negation or report, other words, or a gap where phrases stand too far apart to
bear on each other. Four small machines follow, each reading what the one before wrote:

* ``NEGATED`` lowers what a negation reaches, and takes the negation off the tape.
* ``REPORTED`` lowers what follows a report in the clause, and takes the report off.
* ``AIMED`` rewrites an insult whose target stands before it, or after it: it guesses the
  latter, and the guess dies at a gap or at the end if no target came.
* ``CLAUSE`` accepts a clause in which something hurtful has company, and gives the weights.

``compose`` makes one machine of the four, whose arcs pair theirs wherever the tapes fit.
A clause's score is the weight of its best accepted path, found state by state; a clause
without an accepted path, such as a single word, scores nothing. Threats are phrases
with their object in them, so a verb alone ("we kill time") is no threat.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from itertools import product

# Fixed phrase lists of the grammar (English, German, French, Spanish).
TARGETS = (
    "you", "your", "yours", "you are", "people like you", "all of you", "he", "him", "his", "she", "her",
    "they", "them", "their", "all of them", "everyone", "people",
    "du", "dich", "dir", "dein", "du bist", "euch", "ihr", "sie", "er", "ihn",
    "tu", "tu es", "te", "toi", "ton", "vous", "vous êtes", "votre", "il", "elle", "ils", "elles",
    "usted", "ustedes", "tú", "eres", "ti", "él", "ella", "ellos",
)
NEGATIONS = (
    "not", "no", "never", "nobody", "nothing", "cannot", "without", "isn t", "aren t", "wasn t", "don t",
    "doesn t", "didn t", "far from", "by no means", "anything but",
    "nicht", "kein", "keine", "nie", "niemals", "ohne", "keineswegs",
    "pas", "jamais", "aucun", "sans", "loin d être",
    "ni", "nunca", "jamás", "ningún", "sin", "de ninguna manera",
)
REPORTS = (
    "said", "says", "say", "wrote", "writes", "called", "calls", "claimed", "reported", "quoted", "told",
    "according to", "is said to", "in the words of",
    "sagte", "sagt", "schrieb", "nannte", "berichtete", "nach angaben",
    "dit", "écrit", "appelé", "rapporte", "selon", "d après",
    "dijo", "dice", "escribió", "llamó", "según",
)
THREAT_VERBS = ("kill", "murder", "hurt", "destroy", "strangle", "stab", "beat up")
THREAT_OBJECTS = ("you", "him", "her", "them", "your family")
THREATS = (
    *(f"{verb} {target}" for verb in THREAT_VERBS for target in THREAT_OBJECTS),
    "hope you die", "hope they die", "should die", "deserve to die", "deserves to die", "drop dead",
    "dich umbringen", "dich töten", "dich schlagen", "euch umbringen", "bring dich um", "sollst sterben",
    "te tuer", "vous tuer", "te frapper", "mérites de mourir",
    "voy a matarte", "te voy a matar", "te mataré", "ojalá te mueras", "mereces morir",
)
#: The weight of a threat; insults bring the log-odds they were learned with.
THREAT_WEIGHT = 6.0
#: Words between two phrases beyond which they do not bear on each other.
REACH = 4

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, GAP, AIMED_INSULT = range(8)
#: What the phrase machine writes; the last symbol is only written by ``AIMED``.
READ = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, GAP)

Arc = tuple[int, float, int]  # symbol written, factor, next state
Event = tuple[int, int, float]  # place, symbol, weight


# Phrases -----------------------------------------------------------------------


class Phrases:
    """The machine over words: states are beginnings of phrases, arcs are words."""

    def __init__(self, symbols: dict[int, Iterable[str]]) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.written: list[int | None] = [None]
        for symbol, phrases in symbols.items():
            for phrase in phrases:
                state = 0
                for word in phrase.split():
                    if word not in self.arcs[state]:
                        self.arcs[state][word] = len(self.arcs)
                        self.arcs.append({})
                        self.written.append(None)
                    state = self.arcs[state][word]
                self.written[state] = symbol

    def longest(self, words: list[str], at: int, end: int) -> tuple[int, int] | None:
        """(symbol, place after) of the longest phrase that begins at ``at``."""
        state, found = 0, None
        while at < end and (state := self.arcs[state].get(words[at], -1)) >= 0:
            at += 1
            if self.written[state] is not None:
                found = self.written[state], at
        return found


PHRASES = Phrases({TARGET: TARGETS, NEGATION: NEGATIONS, REPORT: REPORTS, THREAT: THREATS})


# Machines over symbols ---------------------------------------------------------


@dataclass(frozen=True)
class Transducer:
    """arcs[(state, symbol)]: choices; what is not listed is copied, at factor 1, without a move."""

    states: int
    arcs: dict[tuple[int, int], tuple[Arc, ...]]
    final: frozenset[int]

    def read(self, state: int, symbol: int) -> tuple[Arc, ...]:
        return self.arcs.get((state, symbol), ((symbol, 1.0, state),))


NEGATED = Transducer(
    2,
    {
        (0, NEGATION): ((OTHER, 1.0, 1),),
        (1, NEGATION): ((OTHER, 1.0, 0),),  # twice is not at all
        (1, GAP): ((GAP, 1.0, 0),),
        (1, INSULT): ((INSULT, 0.5, 1),),
        (1, THREAT): ((THREAT, 0.3, 1),),
    },
    frozenset((0, 1)),
)
REPORTED = Transducer(
    2,
    {
        (0, REPORT): ((OTHER, 1.0, 1),),
        (1, REPORT): ((OTHER, 1.0, 1),),
        (1, INSULT): ((INSULT, 0.4, 1),),
        (1, THREAT): ((THREAT, 0.4, 1),),
    },
    frozenset((0, 1)),
)
AIMED = Transducer(
    3,  # no target in reach, a target in reach, a target promised
    {
        (0, TARGET): ((TARGET, 1.0, 1),),
        (0, INSULT): ((INSULT, 1.0, 0), (AIMED_INSULT, 1.0, 2)),
        (1, GAP): ((GAP, 1.0, 0),),
        (1, INSULT): ((AIMED_INSULT, 1.0, 1),),
        (2, TARGET): ((TARGET, 1.0, 1),),
        (2, INSULT): ((AIMED_INSULT, 1.0, 2),),
        (2, GAP): (),
    },
    frozenset((0, 1)),
)
_BARE, _AIMED, _THREAT, _MORE = 1.0, 1.5, 2.0, 1.2
CLAUSE = Transducer(
    4,  # nothing, company only, something hurtful alone, something hurtful in company
    {
        **{(s, x): ((x, 0.0, 1),) for s in (0, 1) for x in (OTHER, TARGET, NEGATION, REPORT)},
        **{(s, x): ((x, 0.0, 3),) for s in (2, 3) for x in (OTHER, TARGET, NEGATION, REPORT)},
        **{(s, GAP): ((GAP, 0.0, s),) for s in range(4)},
        **{
            (s, x): ((x, factor * (_MORE if s > 1 else 1.0), 2 if s == 0 and x != THREAT else 3),)
            for s in range(4)
            for x, factor in ((INSULT, _BARE), (AIMED_INSULT, _AIMED), (THREAT, _THREAT))
        },
    },
    frozenset((3,)),
)
PARTS = (NEGATED, REPORTED, AIMED, CLAUSE)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """One machine that writes what ``second`` writes on reading what ``first`` writes."""
    pairs = list(product(range(first.states), range(second.states)))
    number = {pair: i for i, pair in enumerate(pairs)}
    arcs = {
        (number[a, b], x): tuple(
            (written, f * g, number[to_a, to_b])
            for middle, f, to_a in first.read(a, x)
            for written, g, to_b in second.read(b, middle)
        )
        for a, b in pairs
        for x in READ
    }
    final = frozenset(number[a, b] for a, b in pairs if a in first.final and b in second.final)
    return Transducer(len(pairs), arcs, final)


GRAMMAR = reduce(compose, PARTS)


def tape(events: list[Event], reach: int = REACH) -> list[tuple[int, float]]:
    """The symbols and weights of a clause, with gaps where places are further apart than the reach."""
    out, last = [], None
    for place, symbol, weight in events:
        if last is not None and place - last > reach:
            out.append((GAP, 0.0))
        out.append((symbol, weight))
        last = place
    return out


def clause_score(events: list[Event], machine: Transducer = GRAMMAR) -> float:
    """The weight of the best accepted path, the sum of weights times factors; 0 without one."""
    best = {0: 0.0}
    for symbol, weight in tape(events):
        reached: dict[int, float] = {}
        for state, total in best.items():
            for _, factor, to in machine.arcs[state, symbol]:
                worth = total + weight * factor
                if worth > reached.get(to, -1.0):
                    reached[to] = worth
        best = reached
    return max((total for state, total in best.items() if state in machine.final), default=0.0)
