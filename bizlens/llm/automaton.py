"""Rules as one deterministic automaton over bytes.

Each rule's expression becomes a nondeterministic automaton; subset construction over all rules together, with a new start at
every byte, and minimisation by partition refinement give one array of transitions by state and class of bytes.  A state knows
which rules have a match under way (``live``) and which could end one here (``accept``).  So one pass over the bytes finds, for
every rule, the stretches that can hold matches; a match never leaves its stretch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bytes of a lane; all lanes of a step move on together.
LANE = 512


@dataclass(frozen=True)
class Rule:
    """Matches of ``head`` and then ``body`` whose body has ``least`` bytes or more; both match as long as they can.

    Expressions know literals, ``\\xNN``, escaped signs, classes, groups, ``|``, ``?``, ``*``, ``+`` and ``{n}``, over bytes.
    A shorter match is passed over as a whole, and the search goes on behind it.
    """

    kind: str
    head: str
    body: str
    least: int = 1


class _Parser:
    """An expression as nested tuples: ("set", bytes), ("seq", ...), ("alt", ...), ("opt" | "star", item)."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def code(self) -> int:
        sign = self.take()
        if sign == "\\":
            sign = self.take()
            if sign == "x":
                self.at += 2
                return int(self.text[self.at - 2:self.at], 16)
        return ord(sign)

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", *options)

    def sequence(self):
        items = []
        while self.peek() and self.peek() not in "|)":
            item = self.single()
            while self.peek() and self.peek() in "?*+{":
                sign = self.take()
                if sign == "{":
                    end = self.text.index("}", self.at)
                    times, self.at = int(self.text[self.at:end]), end + 1
                    item = ("seq", *[item] * times)
                else:
                    item = {"?": ("opt", item), "*": ("star", item), "+": ("seq", item, ("star", item))}[sign]
            items.append(item)
        return ("seq", *items)

    def single(self):
        if self.peek() == "(":
            self.take()
            inner = self.alternatives()
            self.take()
            return inner
        if self.peek() == "[":
            self.take()
            found = set()
            while self.peek() != "]":
                low = high = self.code()
                if self.peek() == "-" and self.text[self.at + 1] != "]":
                    self.take()
                    high = self.code()
                found |= set(range(low, high + 1))
            self.take()
            return ("set", frozenset(found))
        return ("set", frozenset([self.code()]))


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []
        self.moves: list[tuple[frozenset, int] | None] = []

    def node(self) -> int:
        self.free.append([])
        self.moves.append(None)
        return len(self.free) - 1

    def add(self, tree, start: int) -> int:
        """Nodes for ``tree`` from ``start`` on; returns where it ends."""
        name, items = tree[0], tree[1:]
        if name == "set":
            end = self.node()
            self.moves[start] = (items[0], end)
            return end
        if name == "seq":
            for item in items:
                inner = self.node()
                self.free[start].append(inner)
                start = self.add(item, inner)
            return start
        end = self.node()
        for item in items:
            inner = self.node()
            self.free[start].append(inner)
            done = self.add(item, inner)
            self.free[done].append(end)
            if name == "star":
                self.free[done].append(inner)
        if name in ("opt", "star"):
            self.free[start].append(end)
        return end

    def closure(self, nodes) -> frozenset:
        found, work = set(nodes), list(nodes)
        while work:
            for other in self.free[work.pop()]:
                if other not in found:
                    found.add(other)
                    work.append(other)
        return frozenset(found)


@dataclass
class Automaton:
    """``step[state * width + symbol]``; the last symbol stands between texts and leads to state 0, the start."""

    step: np.ndarray
    width: int
    symbol: np.ndarray
    live: np.ndarray
    accept: np.ndarray

    @property
    def states(self) -> int:
        return len(self.live)


def compile_rules(expressions: list[str], anchored: bool = False) -> Automaton:
    """One minimal automaton for all expressions; ``anchored`` ones start at the first byte only (state 0 after a failure
    is then not the start but dead, and the start is state 1)."""
    nfa, starts, ends = _Nfa(), [], []
    for expression in expressions:
        starts.append(nfa.node())
        ends.append(nfa.add(_Parser(expression).alternatives(), starts[-1]))
    owner = np.searchsorted(starts, np.arange(len(nfa.free)), "right") - 1
    sets = sorted({m[0] for m in nfa.moves if m}, key=sorted)
    marks = np.array([[b in s for s in sets] for b in range(256)], bool).reshape(256, len(sets))
    _, sample, symbol = np.unique(marks, axis=0, return_index=True, return_inverse=True)
    width = len(sample) + 1
    begin = nfa.closure(starts)

    def bits(state: frozenset, wanted) -> int:
        return sum(1 << int(r) for r in {int(owner[n]) for n in state if wanted(n)})

    # Subset construction: a state is the closure of what was reached by bytes, without the start that is always there.
    first = frozenset()
    known = {first: 0} if not anchored else {first: 0, begin: 1}
    order, table, at = list(known), [], 0
    while at < len(order):
        state, row = order[at], []
        base = state if anchored else state | begin
        for byte in sample:
            reached = nfa.closure([nfa.moves[n][1] for n in base if nfa.moves[n] and int(byte) in nfa.moves[n][0]])
            if reached not in known:
                known[reached] = len(order)
                order.append(reached)
            row.append(known[reached])
        table.append([*row, 0])
        at += 1
    table = np.array(table, np.int64)
    live = np.array([bits(s, lambda n: True) if not (anchored and i == 1) else 0 for i, s in enumerate(order)], np.int64)
    accept = np.array([bits(s, lambda n: n in ends) for s in order], np.int64)
    # Partition refinement: states stay together while their marks and their successors' parts are the same.
    _, part = np.unique(np.stack([live, accept], 1), axis=0, return_inverse=True)
    part = part.ravel()
    while True:
        _, finer = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == part.max():
            break
        part = finer
    _, sample_state = np.unique(part, return_index=True)
    rank = np.argsort(np.argsort(sample_state, kind="stable"), kind="stable")
    part, sample_state = rank[part], np.sort(sample_state)
    return Automaton(part[table[sample_state]].astype(np.int32).ravel(), width, symbol.ravel().astype(np.int32),
                     live[sample_state], accept[sample_state])


def states_after(machine: Automaton, symbols: np.ndarray) -> np.ndarray:
    """The state after each symbol, from the start on.

    Lanes of equal length begin in the start state and move on together.  A lane whose predecessor ends in another state is
    gone through again from there until its states are those already found.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.uint16)
    lanes = -(-n // LANE)
    padded = np.full(lanes * LANE, machine.width - 1, np.int32)
    padded[:n] = symbols
    across = np.ascontiguousarray(padded.reshape(lanes, LANE).T)
    found = np.empty((LANE, lanes), np.uint16)
    state = np.zeros(lanes, np.int32)
    step, width = machine.step, machine.width
    for i in range(LANE):
        state = step[state * width + across[i]]
        found[i] = state
    found = np.ascontiguousarray(found.T).ravel()
    turn, came = np.flatnonzero(found[LANE - 1::LANE][:-1]) + 1, None
    while len(turn):
        came = found[turn * LANE - 1].astype(np.int32)
        lane, at = turn, turn * LANE
        for i in range(LANE):
            came = step[came * width + padded[at + i]]
            other = came != found[at + i]
            found[(at + i)[other]] = came[other]
            lane, at, came = lane[other], at[other], came[other]
            if not len(lane):
                break
        turn = lane[lane + 1 < lanes] + 1  # their last state changed
    return found[:n]


class Scanner:
    """All rules in one pass; see :meth:`spans`."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        self.machine = compile_rules([r.head + r.body for r in rules])
        self.whole = [compile_rules([r.head + r.body], anchored=True) for r in rules]
        self.heads = [compile_rules([r.head], anchored=True) if r.head else None for r in rules]

    @staticmethod
    def _longest(machine: Automaton, data: bytes, start: int, end: int) -> int:
        """End of the longest match that begins at ``start``; -1 without one."""
        state, last = 1, start if machine.accept[1] else -1
        step, width, symbol = machine.step, machine.width, machine.symbol
        for at in range(start, end):
            state = step[state * width + symbol[data[at]]]
            if not state:
                break
            if machine.accept[state]:
                last = at + 1
        return last

    def _matches(self, rule: int, data: bytes, start: int, end: int):
        """Leftmost matches, one behind the other, inside a stretch; without those whose body is too short."""
        while start < end:
            last = self._longest(self.whole[rule], data, start, end)
            if last < 0:
                start += 1
                continue
            body = self._longest(self.heads[rule], data, start, last) if self.heads[rule] else start
            if last - body >= self.rules[rule].least:
                yield start, last
            start = last

    def spans(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, rule, first byte and end of each match in texts that lie one after the other (counted in their text)."""
        texts = len(starts) - 1
        symbols = np.insert(self.machine.symbol[data], starts[1:], self.machine.width - 1)
        after = states_after(self.machine, symbols)
        found = []
        whole = data.tobytes()
        met = np.bincount(after, minlength=self.machine.states) > 0
        for rule in range(len(self.rules)):
            bit = 1 << rule
            if not (met & (self.machine.accept & bit > 0)).any():
                continue
            live = (self.machine.live & bit > 0)[after]
            edges = np.flatnonzero(np.diff(live.astype(np.int8), prepend=0, append=0))
            begin, end = edges[::2], edges[1::2]
            long = end - begin >= self.rules[rule].least
            begin, end = begin[long], end[long]
            if not len(begin):
                continue
            ends = np.flatnonzero((self.machine.accept & bit > 0)[after])
            some = np.searchsorted(ends, begin) < np.searchsorted(ends, end)
            for x, y in zip(begin[some].tolist(), end[some].tolist()):
                # each text before adds one symbol, so place x of text t is byte x - t
                text = int(np.searchsorted(starts[1:] + np.arange(texts), x, "right"))
                for first, last in self._matches(rule, whole, x - text, y - text):
                    found.append((text, rule, first - int(starts[text]), last - int(starts[text])))
        columns = np.array(sorted(found), np.int64).reshape(-1, 4)
        return columns[:, 0], columns[:, 1], columns[:, 2], columns[:, 3]
