"""Regular rules compiled to one minimal deterministic automaton over bytes.

A rule is parsed to a nondeterministic automaton, rules are united under one start,
made deterministic by subset construction, and minimised by partition refinement.
The result is a transition array of shape (states, 256); accepting states come last
and carry a bit mask of the rules that end there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Syntax: literals, . [..] (..) | ? * + {n} {n,} {n,m} and \\xHH; bytes only, no anchors.
CLASSES = {"d": frozenset(range(48, 58)), "w": frozenset([*range(48, 58), *range(65, 91), *range(97, 123), 95]), "s": frozenset([32, *range(9, 14)])}
ANY = frozenset(range(256)) - {10}


class _Parser:
    """Recursive descent to a tree of ('set', bytes), ('cat', ..), ('alt', ..), ('rep', tree, low, high)."""

    def __init__(self, rule: str, fold: bool):
        self.rule, self.at, self.fold = rule, 0, fold

    def peek(self) -> str:
        return self.rule[self.at : self.at + 1]

    def take(self) -> str:
        c = self.peek()
        self.at += 1
        return c

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.atom()))
        return ("cat", parts)

    def repeated(self, tree):
        while (c := self.peek()) and c in "?*+{":
            self.take()
            if c == "{":
                end = self.rule.index("}", self.at)
                low, comma, high = self.rule[self.at : end].partition(",")
                self.at = end + 1
                tree = ("rep", tree, int(low), int(high) if high else None if comma else int(low))
            else:
                tree = ("rep", tree, int(c == "+"), 1 if c == "?" else None)
        return tree

    def folded(self, members: frozenset) -> frozenset:
        if not self.fold:
            return members
        return members | {b ^ 32 for b in members if 65 <= b & 0xDF <= 90}

    def escaped(self) -> frozenset:
        c = self.take()
        if c == "x":
            self.at += 2
            return frozenset([int(self.rule[self.at - 2 : self.at], 16)])
        return CLASSES.get(c) or frozenset(c.encode())

    def atom(self):
        c = self.take()
        if c == "(":
            if self.rule.startswith("?:", self.at):
                self.at += 2
            tree = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.rule}")
            return tree
        if c == "[":
            return ("set", self.folded(self.members()))
        if c == ".":
            return ("set", ANY)
        if c == "\\":
            return ("set", self.folded(self.escaped()))
        parts = [("set", self.folded(frozenset([b]))) for b in c.encode()]
        return parts[0] if len(parts) == 1 else ("cat", parts)

    def members(self) -> frozenset:
        negated = self.peek() == "^"
        self.at += negated
        found: set[int] = set()
        first = True
        while self.peek() != "]" or first:
            first = False
            c = self.take()
            if not c:
                raise ValueError(f"unclosed class in {self.rule}")
            low = self.escaped() if c == "\\" else frozenset(c.encode())
            if self.peek() == "-" and self.rule[self.at + 1 : self.at + 2] not in ("]", ""):
                self.take()
                c = self.take()
                high = self.escaped() if c == "\\" else frozenset(c.encode())
                found |= set(range(min(low), max(high) + 1))
            else:
                found |= low
        self.take()
        return frozenset(range(256)) - found if negated else frozenset(found)


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.step: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.step.append(None)
        return len(self.empty) - 1

    def build(self, tree, start: int) -> int:
        """Add ``tree`` from ``start``; the state in which it ends."""
        kind = tree[0]
        if kind == "set":
            here, end = self.state(), self.state()
            self.empty[start].append(here)
            self.step[here] = (tree[1], end)
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.build(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for option in tree[1]:
                begin = self.state()
                self.empty[start].append(begin)
                self.empty[self.build(option, begin)].append(end)
            return end
        _, part, low, high = tree
        for _ in range(low):
            start = self.build(part, start)
        if high is None:
            loop, end = self.state(), self.state()
            self.empty[start] += [loop, end]
            self.empty[self.build(part, loop)] += [loop, end]
            return end
        ends = [start]
        for _ in range(high - low):
            ends.append(self.build(part, ends[-1]))
        out = self.state()
        for e in ends:
            self.empty[e].append(out)
        return out

    def closure(self, states) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for n in self.empty[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``table[state, byte]`` is the next state; states from ``accepting`` on accept the rules in ``masks[state]``."""

    table: np.ndarray
    masks: np.ndarray
    start: int
    accepting: int
    dead: int

    @property
    def resets(self) -> np.ndarray:
        """Bytes that lead every state to the start: what texts may be joined by."""
        return np.flatnonzero((self.table == self.start).all(axis=0))


    def states(self, data: np.ndarray, lanes: int) -> np.ndarray:
        """256 times the state behind every byte, from the start on: one pass in lanes side by side.

        Each lane is entered as if at the start. Where the lane before ended in another
        state, it is gone through again from that state until it meets the states that
        were found; what changes a lane's end goes on to the next.
        """
        n = len(data)
        width = -(-n // max(lanes, 1))
        lanes = -(-n // max(width, 1))
        grid = np.zeros(width * lanes, np.int32)
        grid[:n] = data
        grid = np.ascontiguousarray(grid.reshape(lanes, width).T)
        flat = (self.table * 256).astype(np.int32).ravel()
        out = np.empty((width, lanes), np.int32)
        state = np.full(lanes, self.start * 256, np.int32)
        for i in range(width):
            state = flat[state + grid[i]]
            out[i] = state
        entered = np.full(lanes, self.start * 256, np.int32)
        while lanes:
            again = np.flatnonzero(out[-1, :-1] != entered[1:]) + 1
            if not len(again):
                break
            state = entered[again] = out[-1, again - 1]
            if len(again) <= 4:
                for k, at in zip(again.tolist(), state.tolist(), strict=True):
                    self._again(out[:, k], grid[:, k], at)
                continue
            for i in range(width):
                state = flat[state + grid[i, again]]
                other = state != out[i, again]
                if not other.all():
                    again, state = again[other], state[other]
                if not len(again):
                    break
                out[i, again] = state
        return out.T.ravel()[:n]

    def _again(self, out: np.ndarray, data: np.ndarray, state: int) -> None:
        """One lane from another state on."""
        table, known = self.table.tolist(), out.tolist()
        state >>= 8
        for i, byte in enumerate(data.tolist()):
            state = table[state][byte]
            if known[i] == state << 8:
                return
            out[i] = state << 8


def _reversed(tree):
    """The tree of the rule's matches read from their ends."""
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "rep":
        return ("rep", _reversed(tree[1]), *tree[2:])
    parts = [_reversed(t) for t in tree[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


def compile_rules(rules: list[tuple[str, bool]], anywhere: bool, backwards: bool = False) -> Automaton:
    """One automaton of all (rule, ignore case); ``anywhere`` lets a match begin at any byte, ``backwards`` reads them from their ends."""
    nfa = _Nfa()
    root = nfa.state()
    ends: dict[int, int] = {}
    for k, (rule, fold) in enumerate(rules):
        parser = _Parser(rule, fold)
        tree = parser.alternatives()
        if parser.at < len(rule):
            raise ValueError(f"unexpected ) in {rule}")
        begin = nfa.state()
        nfa.empty[root].append(begin)
        ends[nfa.build(_reversed(tree) if backwards else tree, begin)] = 1 << k
    first = nfa.closure([root])
    ids, todo, table, masks = {first: 0}, [first], [], []
    while todo:
        subset = todo.pop(0)
        masks.append(sum(bit for s, bit in ends.items() if s in subset))
        targets: list[set[int]] = [set() for _ in range(256)]
        for s in subset:
            if nfa.step[s]:
                members, to = nfa.step[s]
                for b in members:
                    targets[b].add(to)
        row, known = [0] * 256, {}
        for b in range(256):
            moved = frozenset(targets[b])
            if moved not in known:
                reached = nfa.closure(moved) | first if anywhere else nfa.closure(moved)
                if reached not in ids:
                    ids[reached] = len(ids)
                    todo.append(reached)
                known[moved] = ids[reached]
            row[b] = known[moved]
        table.append(row)
    return _minimised(np.array(table), np.array(masks))


def _minimised(table: np.ndarray, masks: np.ndarray) -> Automaton:
    """Refine the partition by masks until states of a class step to equal classes."""
    _, cls = np.unique(masks, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([cls, cls[table]]), axis=0, return_inverse=True)
        if finer.max() == cls.max():
            break
        cls = finer.ravel()
    n = cls.max() + 1
    pick = np.zeros(n, int)
    pick[cls[::-1]] = np.arange(len(cls))[::-1]
    small, mask = cls[table[pick]], masks[pick]
    order = np.argsort(mask > 0, kind="stable")
    place = np.empty(n, int)
    place[order] = np.arange(n)
    small, mask = place[small[order]], mask[order]
    accepting = int((mask == 0).sum())
    dead = next((s for s in range(accepting) if (small[s] == s).all()), -1)
    return Automaton(small.astype(np.int32), mask.astype(np.int64), int(place[cls[0]]), accepting, dead)
