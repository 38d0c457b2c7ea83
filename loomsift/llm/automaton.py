"""One deterministic automaton for many regular expressions, over bytes.

Rules are parsed, made into one nondeterministic automaton, determinised by
subset construction over byte classes and minimised by partition refinement.
The result is an array of transitions and a bit mask of rules per state; a scan
is one pass over the bytes, whatever the number of rules.

Supported are literals, classes, ., groups, |, and greedy ? * + {m,n}, and a
look-behind, EDGE or KEY, as a pattern's first item. They keep a rule from
beginning inside a token, or inside letters and digits. Other assertions and
back references are refused.

Overlapping counted repeats blow the subset construction up. An automaton of
`heads` has only what a pattern begins with, up to its first long repeat.
"""

from __future__ import annotations

import re
from re import _constants as c
from re import _parser as parser

import numpy as np

MOST_STATES = 200_000
#: Stands between texts; it isn't part of any UTF-8 text, and no rule matches it.
BREAK = 0xFF
LANES = 4096
ROUNDS = 4
EDGE = r"(?<![0-9A-Za-z_.+/-])"
WORD = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz.+/-")
KEY = r"(?<![0-9A-Za-z])"
#: The bytes that mustn't stand before a pattern.
LOOK_BEHIND = {EDGE: WORD, KEY: frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")}
LONG = 16

_CATEGORIES = {
    c.CATEGORY_DIGIT: rb"[0-9]", c.CATEGORY_WORD: rb"[A-Za-z0-9_]", c.CATEGORY_SPACE: rb"[ \t\n\r\f\v]",
    c.CATEGORY_NOT_DIGIT: rb"[^0-9]", c.CATEGORY_NOT_WORD: rb"[^A-Za-z0-9_]", c.CATEGORY_NOT_SPACE: rb"[^ \t\n\r\f\v]",
}


def _members(op, arg) -> frozenset[int]:
    """The bytes that a one-byte item stands for."""
    every = frozenset(range(256)) - {BREAK}
    if op is c.LITERAL:
        return frozenset([arg])
    if op is c.NOT_LITERAL:
        return every - {arg}
    if op is c.ANY:
        return every - {10}
    if op is c.RANGE:
        return frozenset(range(arg[0], arg[1] + 1))
    if op is c.CATEGORY:
        one = re.compile(_CATEGORIES[arg])
        return frozenset(b for b in every if one.fullmatch(bytes([b])))
    if op is c.IN:
        negate = bool(arg) and arg[0][0] is c.NEGATE
        found = frozenset().union(*[_members(o, a) for o, a in arg[negate:]])
        return every - found if negate else found
    raise ValueError(f"unsupported in a rule: {op}")


def split(pattern: str) -> tuple[str, str]:
    """A pattern's look-behind ('' if none), and the rest."""
    edge = next((e for e in LOOK_BEHIND if pattern.startswith(e)), "")
    return edge, pattern.removeprefix(edge)


def _head(tree):
    """The items up to the first repeat of more than LONG; of a pattern that begins with one, the least that it repeats, or any byte."""
    out = []
    for op, arg in tree:
        if op is c.MAX_REPEAT and (arg[1] is c.MAXREPEAT or arg[1] > LONG):
            return out or ([(op, (arg[0], arg[0], arg[2]))] if arg[0] else [(c.IN, [(c.NEGATE, None), (c.LITERAL, BREAK)])])
        if op is c.SUBPATTERN and arg[3].getwidth()[1] > LONG or op is c.BRANCH and max(w.getwidth()[1] for w in arg[1]) > LONG:
            return out or [(c.IN, [(c.NEGATE, None), (c.LITERAL, BREAK)])]
        out.append((op, arg))
    return out


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []  # epsilon moves
        self.moves: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append(None)
        return len(self.free) - 1

    def add(self, tree, start: int, fold: bool) -> int:
        """Appends what the parsed tree matches to state start; returns the state that it ends in."""
        for op, arg in tree:
            if op is c.SUBPATTERN:
                _, on, off, inner = arg
                start = self.add(inner, start, (fold or bool(on & re.I)) and not off & re.I)
            elif op is c.BRANCH:
                end = self.state()
                for way in arg[1]:
                    first = self.state()
                    self.free[start].append(first)
                    self.free[self.add(way, first, fold)].append(end)
                start = end
            elif op is c.MAX_REPEAT:
                least, most, inner = arg
                for _ in range(least):
                    start = self.add(inner, start, fold)
                if most is c.MAXREPEAT:
                    loop = self.state()
                    self.free[start].append(loop)
                    self.free[self.add(inner, loop, fold)].append(loop)
                    start = self.state()
                    self.free[loop].append(start)
                else:
                    end = self.state()
                    for _ in range(most - least):
                        self.free[start].append(end)
                        first = self.state()
                        self.free[start].append(first)
                        start = self.add(inner, first, fold)
                    self.free[start].append(end)
                    start = end
            else:
                found = _members(op, arg)
                if fold:
                    found |= {x for b in found for x in bytes([b]).lower() + bytes([b]).upper()}
                if self.moves[start] is not None:
                    first = self.state()
                    self.free[start].append(first)
                    start = first
                end = self.state()
                self.moves[start] = (found, end)
                start = end
        return start

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


class Automaton:
    """States are numbered so that accepting ones come last. `masks` holds the rules that each state accepts, as bits of an integer of any width."""

    def __init__(self, patterns: list[bytes], anywhere: bool, backward: bool = False, heads: bool = False):
        nfa, ends = _Nfa(), {}
        roots = {edge: nfa.state() for edge in ("", *LOOK_BEHIND)}
        for n, pattern in enumerate(patterns):
            edge, rest = split(pattern.decode())
            tree = parser.parse(rest.encode())
            fold = bool(tree.state.flags & re.I)
            tree = _head(tree) if heads else tree
            first = nfa.state()
            nfa.free[roots[edge]].append(first)
            ends[nfa.add(_reversed(tree) if backward else tree, first, fold)] = n
        sets = {m[0] for m in nfa.moves if m}
        signature = {}
        self.classes = np.zeros(256, np.uint8)
        for b in range(256):
            self.classes[b] = signature.setdefault((b == BREAK, *[b in s for s in LOOK_BEHIND.values()], *[b in s for s in sets]), len(signature))
        sample = {int(k): b for b, k in reversed(list(enumerate(self.classes)))}
        begin = nfa.closure(roots.values())
        behind = {k: nfa.closure([r for e, r in roots.items() if b not in LOOK_BEHIND.get(e, ())]) for k, b in sample.items()}
        number, rows, todo = {begin: 0}, [], [begin]
        for now in todo:
            row = []
            for k in range(len(signature)):
                if k == self.classes[BREAK]:
                    after = begin if anywhere else frozenset()
                else:
                    hit = {nfa.moves[s][1] for s in now if nfa.moves[s] and sample[k] in nfa.moves[s][0]}
                    again = behind[k] if anywhere else frozenset()
                    after = nfa.closure(hit) | again
                if after not in number:
                    if len(number) > MOST_STATES:
                        raise ValueError("the rules need too many states; begin them with EDGE or KEY, use heads, or bound their repeats less")
                    number[after] = len(number)
                    todo.append(after)
                row.append(number[after])
            rows.append(row)
        table = np.array(rows, np.int64)
        masks = np.array([sum(1 << n for e, n in ends.items() if e in s) for s in number], object)  # as wide as there are rules
        if masks[0]:
            raise ValueError("a rule matches the empty string")
        self.built = len(table)
        # minimisation: split states by what they accept, then by where they go, until nothing splits
        block = np.unique(masks, return_inverse=True)[1].ravel()
        while True:
            finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == block.max():
                break
            block = finer
        first = np.array([np.flatnonzero(block == b)[0] for b in range(block.max() + 1)])
        order = np.argsort(masks[first] != 0, kind="stable")
        rank = np.empty(len(first), np.int64)
        rank[order] = np.arange(len(first))
        self.masks = masks[first][order]
        self.table = rank[block[table[first]]][order].astype(np.int32)
        self.start = int(rank[block[0]])
        self.accepting = int((self.masks == 0).sum())
        self.dead = next((s for s in range(self.accepting) if (self.table[s] == s).all()), -1)
        self.steps, self.kinds = self.table.tolist(), self.classes.tobytes()

    def run(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the automaton accepts (index of the last byte), and the state there.

        The bytes are cut into lanes that advance together, each as if it
        began in the start state. A lane whose left neighbour ends elsewhere
        is then run again from there, until it meets its first run; this goes
        on until all lanes fit, so the result is that of a single pass. What a
        few rounds leave is gone through byte by byte, so that a state which
        lasts over many lanes costs no round for each of them.
        """
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lanes = min(LANES, max(1, len(data) // 256))
        steps = -(-len(data) // lanes)
        padded = np.full(lanes * steps, BREAK, np.uint8)
        padded[: len(data)] = data
        kinds = np.ascontiguousarray(self.classes[padded].reshape(lanes, steps).T)
        width = self.table.shape[1]
        flat = (self.table.astype(np.int32) * width).ravel()
        states = np.empty((steps, lanes), np.int32)
        now = np.full(lanes, self.start * width, np.int32)
        begin = now.copy()
        for s in range(steps):
            now = flat[now + kinds[s]]
            states[s] = now
        for _ in range(ROUNDS):
            true = np.concatenate([[self.start * width], states[-1, :-1]]).astype(np.int32)
            wrong = np.flatnonzero(true != begin)
            if not len(wrong):
                break
            begin[wrong] = true[wrong]
            now = true[wrong]
            for s in range(steps):
                now = flat[now + kinds[s, wrong]]
                differ = now != states[s, wrong]
                if not differ.all():
                    wrong, now = wrong[differ], now[differ]
                    if not len(wrong):
                        break
                states[s, wrong] = now
        else:
            self._mend(states, begin, kinds, flat)
        step, lane = np.nonzero(states >= self.accepting * width)
        where = lane * steps + step
        order = np.argsort(where)
        where, at = where[order], states[step[order], lane[order]] // width
        inside = where < len(data)
        return where[inside], at[inside]

    def _mend(self, states: np.ndarray, begin: np.ndarray, kinds: np.ndarray, flat: np.ndarray) -> None:
        """Runs every lane again that didn't begin where its left neighbour ends, from left to right."""
        moves = None
        for lane in range(1, states.shape[1]):
            now = int(states[-1, lane - 1])
            if now != begin[lane]:
                moves = moves or flat.tolist()
                old, new = states[:, lane].tolist(), []
                for k, was in zip(kinds[:, lane].tolist(), old):
                    now = moves[now + k]
                    if now == was:
                        break
                    new.append(now)
                states[: len(new), lane] = new

    def longest(self, kinds: bytes, start: int) -> int:
        """From start the furthest index after which the automaton accepts, or -1; kinds: the classes of a text's bytes (`text.translate(self.kinds)`)."""
        state, found, steps, accepting, dead = self.start, -1, self.steps, self.accepting, self.dead
        for i in range(start, len(kinds)):
            state = steps[state][kinds[i]]
            if state >= accepting:
                found = i
            elif state == dead:
                break
        return found


def _reversed(tree):
    """The parsed tree of the mirrored language."""
    out = []
    for op, arg in reversed(list(tree)):
        if op is c.SUBPATTERN:
            arg = (*arg[:3], _reversed(arg[3]))
        elif op is c.BRANCH:
            arg = (arg[0], [_reversed(way) for way in arg[1]])
        elif op is c.MAX_REPEAT:
            arg = (arg[0], arg[1], _reversed(arg[2]))
        out.append((op, arg))
    return out
