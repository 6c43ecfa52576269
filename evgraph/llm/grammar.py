"""Weighted finite-state transducers over clauses, and their composition.

A symbol is a kind of word with marks, such as ("insult", {"negated"}). A transducer is deterministic: from a state and a symbol
it goes to a state and writes one symbol. Five of them are composed, each reading what the one before wrote:

1. reported speech: a verb of saying opens a span, up to the clause's end, in which insults and threats are `reported`;
2. negation: marks insults and threats among the next REACH words as `negated`;
3. target: a person addressed or named, before an insult or threat or after it, makes it `targeted`;
4. threat: a threat counts only with a target, so what isn't targeted becomes an ordinary word;
5. insult: tells a clause's first insult from those that follow (`again`).

The composition is one table over the reachable tuples of states. Each arc that writes an insult or a threat is an event of the
clause and carries that event's weight; a clause's weight is the sum along its path.
"""

from __future__ import annotations

from collections.abc import Callable

KINDS = ("other", "insult", "threat", "target", "negation", "report", "end")
#: Words that a negation reaches, and within which a target belongs to an insult or threat.
REACH = 3
TARGET_REACH = 5
Symbol = tuple[str, frozenset]
Step = Callable[[object, Symbol], tuple[object, Symbol]]
HURTS = ("insult", "threat")


def plain(kind: str) -> Symbol:
    return kind, frozenset()


def marked(symbol: Symbol, mark: str) -> Symbol:
    return symbol[0], symbol[1] | {mark}


def reported_speech(open_, symbol: Symbol):
    if symbol[0] in ("report", "end"):
        return symbol[0] == "report", symbol
    return open_, marked(symbol, "reported") if open_ and symbol[0] in HURTS else symbol


def negation(left, symbol: Symbol):
    if symbol[0] in ("negation", "end"):
        return REACH if symbol[0] == "negation" else 0, symbol
    return max(0, left - 1), marked(symbol, "negated") if left and symbol[0] in HURTS else symbol


def target(state, symbol: Symbol):
    """State: how far the last target reaches, and the hurt without target that waits for one, with its own reach."""
    seen, waiting, left = state
    if symbol[0] == "end":
        return (0, None, 0), symbol
    if symbol[0] == "target":
        found = marked(waiting, "targeted") if waiting else symbol
        return (TARGET_REACH, None, 0), found
    seen_next, left_next = max(0, seen - 1), max(0, left - 1)
    waiting_next = waiting if left_next else None
    if symbol[0] in HURTS:
        if seen:
            return (seen_next, None, 0), marked(symbol, "targeted")
        return (seen_next, marked(symbol, "late"), TARGET_REACH), symbol
    return (seen_next, waiting_next, left_next if waiting_next else 0), symbol


def threat(state, symbol: Symbol):
    return state, plain("other") if symbol[0] == "threat" and "targeted" not in symbol[1] else symbol


def insult(state, symbol: Symbol):
    if symbol[0] == "end":
        return 0, symbol
    if symbol[0] == "insult" and "late" not in symbol[1]:
        return 1, marked(symbol, "again") if state else symbol
    return state, symbol


#: (start state, step) of each transducer, in the order of composition.
CASCADE: tuple[tuple[object, Step], ...] = ((False, reported_speech), (0, negation), ((0, None, 0), target), (None, threat), (0, insult))


def cascade(states: tuple, symbol: Symbol) -> tuple[tuple, Symbol]:
    """One symbol through all transducers, one after another."""
    out = []
    for state, (_, step) in zip(states, CASCADE, strict=True):
        state, symbol = step(state, symbol)
        out.append(state)
    return tuple(out), symbol


def compose() -> tuple[list[list[int]], list[list[int]], list[Symbol]]:
    """The composed transducer: next state and event (-1: none) for each state and kind, and the events. State 0 is the start, and
    the end of a clause leads back to it."""
    start = tuple(s for s, _ in CASCADE)
    number, queue = {start: 0}, [start]
    after: list[list[int]] = []
    written: list[list[int]] = []
    events: dict[Symbol, int] = {}
    for states in queue:
        row, out = [], []
        for kind in KINDS:
            new, symbol = cascade(states, plain(kind))
            if new not in number:
                number[new] = len(queue)
                queue.append(new)
            row.append(number[new])
            out.append(events.setdefault(symbol, len(events)) if symbol[0] in HURTS else -1)
        after.append(row)
        written.append(out)
    return after, written, list(events)


def prior_weight(event: Symbol) -> float:
    """What an event adds to a text's log odds before anything is learned. An insult that a target follows was an event already."""
    kind, marks = event
    weight = 6.5 if kind == "threat" else 0.5 if "late" in marks else 5.5 if "targeted" in marks else 5.0
    weight *= 0.4 if "reported" in marks else 1.0
    weight *= 0.2 if "negated" in marks else 1.0
    return weight * (0.2 if "again" in marks else 1.0)
