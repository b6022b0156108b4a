"""Weighted finite-state pattern grammar over word classes.

Small transducers each watch one thing in a clause: an insult, a threat, a
target, a negation whose scope reaches over the next words, reported speech.
``compose`` builds their product as one transition table. Fed with the classes
of a clause's words, the product machine ends in a state whose output is the
clause's kind, a set of flags; a kind carries a weight that is learned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

#: word classes
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, INTENT = range(7)

#: fixed words of the classes that are not learned, in English, German, French and Spanish
WORDS = {
    THREAT: "kill hurt destroy beat stab shoot punch burn töten umbringen schlagen verletzen tuer frapper matar golpear pegar",
    TARGET: "you your yourself they them he she him her du dich dir ihr euch sie tu toi vous te tú ti usted ustedes",
    NEGATION: "not never no nobody without nicht kein keine niemals ne pas jamais sin nunca jamás",
    REPORT: "said says say wrote called claimed quoted sagte sagt schrieb nannte dit disait écrit dijo dice escribió llamó",
    INTENT: "will gonna going shall must werde wirst wird soll vais va doit voy vamos debe",
}

#: flags of a clause's kind
IS_INSULT, IS_THREAT, HAS_TARGET, IS_NEGATED, IS_REPORTED = 1, 2, 4, 8, 16


@dataclass(frozen=True)
class Machine:
    """states 0..n-1, start 0; ``step(state, cls)`` gives the next state, ``flags(state)`` its output."""
    states: int
    step: Callable[[int, int], int]
    flags: Callable[[int], int]


def _seen(cls: int, flag: int) -> Machine:
    return Machine(2, lambda s, c: 1 if s or c == cls else 0, lambda s: flag * s)


def _threat() -> Machine:
    """A threat word, counted once an intent word or a target stands in the same clause."""
    def step(s, c):
        return s | (1 if c == THREAT else 0) | (2 if c in (INTENT, TARGET) else 0)
    return Machine(4, step, lambda s: IS_THREAT if s == 3 else 0)


def _negated(scope: int = 3) -> Machine:
    """States 1..scope count down after a negation; the last state remembers a match inside the scope."""
    done = scope + 1

    def step(s, c):
        if s == done or (0 < s and c in (INSULT, THREAT)):
            return done
        return scope if c == NEGATION else max(s - 1, 0)
    return Machine(scope + 2, step, lambda s: IS_NEGATED if s == done else 0)


def _reported() -> Machine:
    """A reporting word before the match."""
    def step(s, c):
        return 2 if s == 2 or (s == 1 and c in (INSULT, THREAT)) else 1 if s or c == REPORT else 0
    return Machine(3, step, lambda s: IS_REPORTED if s == 2 else 0)


def compose(machines: list[Machine]) -> tuple[list[list[int]], list[int]]:
    """Product machine: next state by [state][class], and the flags of each state."""
    index = {(0,) * len(machines): 0}
    order = list(index)
    table: list[list[int]] = []
    for state in order:  # grows while it is read
        row = []
        for c in range(7):
            after = tuple(m.step(s, c) for m, s in zip(machines, state))
            if after not in index:
                index[after] = len(index)
                order.append(after)
            row.append(index[after])
        table.append(row)
    return table, [sum(m.flags(s) for m, s in zip(machines, state)) for state in order]


TABLE, KINDS = compose([_seen(INSULT, IS_INSULT), _threat(), _seen(TARGET, HAS_TARGET), _negated(), _reported()])


def clause_kind(classes) -> int:
    state = 0
    for c in classes:
        state = TABLE[state][c]
    return KINDS[state]
