"""Rule patterns compiled into one minimal deterministic automaton over bytes.

The pattern language is what secret rules need: literals, ``\\`` and ``\\xHH``
escapes, ``[...]`` classes with ranges, groups, ``|`` and the quantifiers
``* + ? {n} {n,} {n,m}``. Patterns are ASCII; all other bytes match nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: A rule set that needs more states than this is refused.
MOST_STATES = 20_000


class Nfa:
    """A Thompson automaton: ``edges`` consume a byte, ``free`` do not."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []
        self.accepts: dict[int, int] = {}

    def state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.free) - 1

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for y in self.free[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        return frozenset(seen)


class _Reader:
    """Recursive descent over a pattern; gives a tree of ('set' | 'seq' | 'any' | 'rep', ...)."""

    def __init__(self, pattern: str, fold: bool):
        self.text, self.at, self.fold = pattern, 0, fold

    def peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self):
        found = [self.sequence()]
        while self.peek() == "|":
            self.take()
            found.append(self.sequence())
        return ("any", found)

    def sequence(self):
        found = []
        while self.peek() not in ("", "|", ")"):
            found.append(self.counted(self.atom()))
        return ("seq", found)

    def counted(self, tree):
        while self.peek() in ("*", "+", "?", "{") and self.peek():
            sign = self.take()
            low, high = {"*": (0, None), "+": (1, None), "?": (0, 1), "{": (0, 0)}[sign]
            if sign == "{":
                end = self.text.index("}", self.at)
                first, comma, last = self.text[self.at : end].partition(",")
                low, high, self.at = int(first), (int(last) if last else None) if comma else int(first), end + 1
            tree = ("rep", tree, low, high)
        return tree

    def atom(self):
        c = self.take()
        if c == "(":
            tree = self.alternatives()
            assert self.take() == ")"
            return tree
        return ("set", self.folded(self.members() if c == "[" else {self.escaped() if c == "\\" else ord(c)}))

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def members(self) -> set[int]:
        found: set[int] = set()
        while (c := self.take()) != "]":
            low = self.escaped() if c == "\\" else ord(c)
            high = low
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                d = self.take()
                high = self.escaped() if d == "\\" else ord(d)
            found |= set(range(low, high + 1))
        return found

    def folded(self, found: set[int]) -> frozenset[int]:
        letters = {ord(s) for b in found if chr(b).isalpha() for s in (chr(b).lower(), chr(b).upper())}
        return frozenset(found | letters if self.fold else found)


def _reversed(tree):
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "rep":
        return ("rep", _reversed(tree[1]), *tree[2:])
    parts = [_reversed(x) for x in tree[1]]
    return (kind, parts[::-1] if kind == "seq" else parts)


def _shortest(tree):
    """``tree`` without the open-ended repeats at its end.

    Every match begins with a word of the result, and each such word is itself
    a match. A search for presence needs no more, and its automaton stays small
    because it forgets a rule once the rule has accepted.
    """
    kind = tree[0]
    if kind == "seq" and tree[1]:
        return ("seq", [*tree[1][:-1], _shortest(tree[1][-1])])
    if kind == "any":
        return ("any", [_shortest(x) for x in tree[1]])
    return ("rep", tree[1], tree[2], tree[2]) if kind == "rep" else tree


def _build(nfa: Nfa, tree, start: int) -> int:
    """Adds ``tree`` behind ``start``; returns the state after it."""
    kind = tree[0]
    if kind == "set":
        end = nfa.state()
        nfa.edges[start].append((tree[1], end))
        return end
    if kind == "seq":
        for part in tree[1]:
            start = _build(nfa, part, start)
        return start
    if kind == "any":
        end = nfa.state()
        for part in tree[1]:
            first = nfa.state()
            nfa.free[start].append(first)
            nfa.free[_build(nfa, part, first)].append(end)
        return end
    _, inner, low, high = tree
    for _ in range(low):
        start = _build(nfa, inner, start)
    if high is None:
        loop = nfa.state()
        nfa.free[start].append(loop)
        nfa.free[_build(nfa, inner, loop)].append(loop)
        return loop
    end = nfa.state()
    for _ in range(high - low):
        nfa.free[start].append(end)
        start = _build(nfa, inner, start)
    nfa.free[start].append(end)
    return end


@dataclass(frozen=True)
class Dfa:
    """``table[state + byte]`` is the next state (states are multiples of 256); states from ``accepting`` on accept.

    ``rules[state // 256]`` has bit k set if rule k accepts there. ``dead`` is
    the state that nothing leaves, or -1.
    """

    table: list[int]
    rules: list[int]
    start: int
    accepting: int
    dead: int


def _determinise(nfa: Nfa, starts: list[int], search: bool) -> tuple[np.ndarray, list[int]]:
    """Subset construction over classes of bytes that no edge tells apart; then the full byte table."""
    marks = np.zeros(256, object)
    for k, members in enumerate({m for edges in nfa.edges for m, _ in edges}):
        for b in members:
            marks[b] |= 1 << k
    kinds = {m: i for i, m in enumerate(dict.fromkeys(marks.tolist()))}
    of_byte = np.array([kinds[m] for m in marks.tolist()])
    sample = [int(np.flatnonzero(of_byte == k)[0]) for k in range(len(kinds))]
    first = nfa.closure(starts)
    ids, todo, rows, accepts = {first: 0}, [first], [], []
    while todo:
        here = todo.pop(0)
        row = []
        for byte in sample:
            to = {y for x in here for members, y in nfa.edges[x] if byte in members}
            there = nfa.closure(to) | first if search else nfa.closure(to)
            if there not in ids:
                if len(ids) >= MOST_STATES:
                    raise ValueError("these rules need too many states; check lengths after the match instead of counting")
                ids[there] = len(ids)
                todo.append(there)
            row.append(ids[there])
        rows.append(row)
        accepts.append(sum(1 << k for k in {nfa.accepts[x] for x in here if x in nfa.accepts}))
    return np.array(rows)[:, of_byte], accepts


def _minimised(table: np.ndarray, accepts: list[int]) -> Dfa:
    """Moore's refinement, then numbering with accepting states last."""
    _, block = np.unique(np.array(accepts, object).astype(str), return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    count = block.max() + 1
    some = np.array([int(np.flatnonzero(block == k)[0]) for k in range(count)])
    order = sorted(range(count), key=lambda k: (accepts[some[k]] != 0, k))
    new = np.empty(count, np.int64)
    new[order] = np.arange(count)
    small = new[block[table[some[order]]]]
    rules = [accepts[some[k]] for k in order]
    dead = [s for s in range(count) if not rules[s] and (small[s] == s).all()]
    return Dfa(
        (small * 256).ravel().tolist(), rules, int(new[block[0]]) * 256, 256 * sum(not r for r in rules), 256 * dead[0] if dead else -1
    )


def compile_rules(patterns: list[tuple[str, bool]], search: bool = True, backward: bool = False) -> Dfa:
    """One automaton for all (pattern, either case) rules; rule k sets bit k where it accepts.

    ``search`` lets matches begin anywhere and accepts them as soon as they are
    complete; ``backward`` reads each pattern from its end, and accepts where a
    match begins.
    """
    nfa, starts = Nfa(), []
    for k, (pattern, fold) in enumerate(patterns):
        reader = _Reader(pattern, fold)
        tree = reader.alternatives()
        assert reader.at == len(pattern), f"pattern ends early: {pattern}"
        starts.append(nfa.state())
        tree = _reversed(tree) if backward else _shortest(tree) if search else tree
        nfa.accepts[_build(nfa, tree, starts[-1])] = k
    return _minimised(*_determinise(nfa, starts, search))


class RuleScanner:
    """Leftmost-longest, non-overlapping matches of each rule in a byte string.

    All rules are looked for in one pass of the combined automaton. Only for
    rules that accept somewhere, a pass backward with that rule's reversed
    automaton marks where matches begin, and its own automaton reads each match
    to its end.
    """

    def __init__(self, patterns: list[tuple[str, bool]]):
        self.all = compile_rules(patterns)
        self.back = [compile_rules([p], backward=True) for p in patterns]
        self.ahead = [compile_rules([p], search=False) for p in patterns]

    def present(self, data: bytes) -> tuple[int, int]:
        """(rules that accept, as bits; end of the last match), in one pass over all bytes."""
        table, accepting, rules, state = self.all.table, self.all.accepting, self.all.rules, self.all.start
        found, last = 0, 0
        for at, byte in enumerate(data):
            state = table[state + byte]
            if state >= accepting:
                found |= rules[state >> 8]
                last = at
        return found, last + 1

    def matches(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) in bytes, by rule and start."""
        found, last = self.present(data)
        out = []
        for rule in range(len(self.back)):
            if found >> rule & 1:
                out += ((rule, a, b) for a, b in self._of(rule, data, last))
        return out

    def _of(self, rule: int, data: bytes, last: int):
        back, ahead = self.back[rule], self.ahead[rule]
        table, accepting, state = back.table, back.accepting, back.start
        starts = []
        for at in range(last - 1, -1, -1):
            state = table[state + data[at]]
            if state >= accepting:
                starts.append(at)
        table, accepting, dead = ahead.table, ahead.accepting, ahead.dead
        free = 0
        for start in reversed(starts):
            if start < free:
                continue
            state, end = ahead.start, start
            for at in range(start, len(data)):
                state = table[state + data[at]]
                if state >= accepting:
                    end = at + 1
                elif state == dead:
                    break
            yield start, end
            free = end
