"""One deterministic automaton for many patterns, scanning bytes in parallel lanes.

Patterns are compiled by subset construction and minimised. A state stands for the whole situation of every rule: its
partial matches in order of their beginning, the earliest first. Each rule finds its leftmost matches, longest first and
not overlapping, as if it were searched for alone. The transition table is applied to thousands of stretches of a buffer
at once; a stretch that turns out to have begun in another state than assumed is scanned again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

GAP = 0xFF  # never part of UTF-8: parts texts in a buffer and ends every match


@dataclass
class _Graph:
    """A non-deterministic automaton over bytes."""

    moves: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    skips: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.moves.append([])
        self.skips.append([])
        return len(self.moves) - 1

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in self.skips[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)

    def step(self, states, byte: int) -> frozenset[int]:
        return self.closure({nxt for s in states for over, nxt in self.moves[s] if byte in over})


class Pattern:
    """A pattern of literals, classes, groups, ``|``, ``?``, ``*``, ``+``, ``{m,}`` and ``(?i:...)`` over ASCII."""

    def __init__(self, text: str):
        self.text, self.at, self.graph, self.fold = text, 0, _Graph(), False
        self.start, self.end = self._either()
        if self.at != len(text):
            raise ValueError(f"pattern {text!r} breaks off at {self.at}")

    def reversed(self) -> tuple[_Graph, int, int]:
        turned = _Graph([[] for _ in self.graph.moves], [[] for _ in self.graph.skips])
        for s, moves in enumerate(self.graph.moves):
            for over, nxt in moves:
                turned.moves[nxt].append((over, s))
            for nxt in self.graph.skips[s]:
                turned.skips[nxt].append(s)
        return turned, self.end, self.start

    def _peek(self, ahead: str) -> bool:
        return self.text.startswith(ahead, self.at)

    def _either(self) -> tuple[int, int]:
        start, end = self.graph.state(), self.graph.state()
        while True:
            a, z = self._sequence()
            self.graph.skips[start].append(a)
            self.graph.skips[z].append(end)
            if not self._peek("|"):
                return start, end
            self.at += 1

    def _sequence(self) -> tuple[int, int]:
        start = end = self.graph.state()
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            a, z = self._repeated()
            self.graph.skips[end].append(a)
            end = z
        return start, end

    def _repeated(self) -> tuple[int, int]:
        begin = self.at
        a, z = self._atom()
        after = self.at
        least, most = 1, 1
        if after < len(self.text) and self.text[after] in "?*+{":
            mark = self.text[after]
            self.at += 1
            if mark == "{":
                close = self.text.index("}", self.at)
                least, most = int(self.text[self.at:close].split(",")[0]), None
                if "," not in self.text[self.at:close]:
                    most = least
                self.at = close + 1
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[mark]
        rest = self.at
        start = end = self.graph.state()
        copies = max(least, 1)
        for k in range(copies):
            if k:
                self.at = begin
                a, z = self._atom()
            self.graph.skips[end].append(a)
            last, end = end, z
        self.at = rest
        out = self.graph.state()
        self.graph.skips[end].append(out)
        if least == 0:
            self.graph.skips[last].append(out)
        if most is None:
            self.graph.skips[end].append(a)
        return start, out

    def _atom(self) -> tuple[int, int]:
        if self._peek("(?i:"):
            self.at += 4
            before, self.fold = self.fold, True
            pair = self._closed()
            self.fold = before
            return pair
        if self._peek("("):
            self.at += 1
            return self._closed()
        over = self._class() if self._peek("[") else frozenset({self._char()})
        if self.fold:
            over |= {ord(chr(b).swapcase()) for b in over if chr(b).isalpha()}
        start, end = self.graph.state(), self.graph.state()
        self.graph.moves[start].append((frozenset(over), end))
        return start, end

    def _closed(self) -> tuple[int, int]:
        pair = self._either()
        self.at += 1
        return pair

    def _char(self) -> int:
        if self._peek("\\x"):
            self.at += 4
            return int(self.text[self.at - 2:self.at], 16)
        if self._peek("\\"):
            self.at += 1
        self.at += 1
        return ord(self.text[self.at - 1])

    def _class(self) -> frozenset[int]:
        self.at += 1
        over: set[int] = set()
        while not self._peek("]"):
            low = self._char()
            if self._peek("-") and not self._peek("-]"):
                self.at += 1
                over.update(range(low, self._char() + 1))
            else:
                over.add(low)
        self.at += 1
        return frozenset(over)


class _Search:
    """The situations of one rule: partial matches by beginning, and whether the first has matched."""

    def __init__(self, pattern: Pattern):
        self.graph, self.final = pattern.graph, pattern.end
        self.fresh = self.graph.closure({pattern.start})
        if self.final in self.fresh:
            raise ValueError("a rule must not match the empty string")

    def step(self, state: tuple, byte: int) -> tuple:
        was, groups = state
        moved, seen = [], set()
        for group in groups if was else (*groups, self.fresh):
            new = self.graph.step(group, byte) - seen
            if new:
                seen |= new
                moved.append(frozenset(new))
        if was and not moved:
            new = self.graph.step(self.fresh, byte)
            if self.final in new:
                raise ValueError("a match may not begin where another ends")
            return False, ((new,) if new else ())
        hit = [i for i, group in enumerate(moved) if self.final in group]
        if was and not hit or hit and hit[0]:
            raise ValueError("a match must not be left again before it ends, nor overtake an earlier one")
        return (True, (moved[0],)) if hit else (False, tuple(moved))


class Automaton:
    """All rules as one minimal transition table, with the rules that are in a match as bits of each state."""

    def __init__(self, patterns: list[str]):
        parsed = [Pattern(p) for p in patterns]
        searches = [_Search(p) for p in parsed]
        alike = self._byte_classes(parsed)
        begin = tuple((False, ()) for _ in searches)
        number, order, table = {begin: 0}, [begin], []
        memo: dict = {}
        for state in order:
            row = []
            for byte in alike:
                nxt = []
                for k, search in enumerate(searches):
                    key = (k, state[k], byte)
                    if key not in memo:
                        memo[key] = search.step(state[k], byte)
                    nxt.append(memo[key])
                nxt = tuple(nxt)
                if nxt not in number:
                    number[nxt] = len(order)
                    order.append(nxt)
                row.append(number[nxt])
            table.append(row)
        flags = np.array([sum(1 << k for k, s in enumerate(state) if s[0]) for state in order], dtype=np.uint8)
        self._minimise(np.array(table, dtype=np.int64), flags)
        self.back = [p.reversed() for p in parsed]
        self._steps: dict = {}

    def _byte_classes(self, parsed: list[Pattern]) -> list[int]:
        """One byte of each class; ``self.classes`` maps bytes to classes."""
        sets = sorted({over for p in parsed for moves in p.graph.moves for over, _ in moves}, key=sorted)
        signs: dict = {}
        self.classes = np.zeros(256, dtype=np.uint8)
        first = []
        for byte in range(256):
            sign = tuple(byte in s for s in sets)
            if sign not in signs:
                signs[sign] = len(first)
                first.append(byte)
            self.classes[byte] = signs[sign]
        return first

    def _minimise(self, table: np.ndarray, flags: np.ndarray) -> None:
        block = flags.astype(np.int64)
        while True:
            _, new = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
            new = new.ravel()
            if new.max() == block.max() and len(np.unique(new)) == len(np.unique(block)):
                break
            block = new
        _, pick = np.unique(block, return_index=True)
        block = np.unique(block, return_inverse=True)[1].ravel()
        self.table, self.flags, self.start = block[table[pick]], flags[pick], int(block[0])
        self.width = self.table.shape[1]
        # States are kept as offsets of their rows, so that one step is an addition and a look-up.
        self._flat = np.ascontiguousarray((self.table * self.width).astype(np.int32).ravel())

    def scan(self, buffer: bytes, lanes: int = 4096, lead: int = 64) -> np.ndarray:
        """For every byte, the rules that are in a match after it (bits)."""
        size = len(buffer)
        lanes = max(1, min(lanes, size // (4 * lead)))
        long = -(-size // lanes)
        over = self.classes[np.frombuffer(buffer, np.uint8)]
        gap = self.classes[GAP]
        padded = np.concatenate([np.full(lead, gap, np.uint8), over, np.full(long * lanes - size, gap, np.uint8)])
        ahead = np.stack([padded[k * long:k * long + lead] for k in range(lanes)], axis=1)
        grid = np.ascontiguousarray(padded[lead:].reshape(lanes, long).T)
        state = np.full(lanes, self.start * self.width, dtype=np.int32)
        for row in ahead:
            state = self._flat[state + row]
        begun = state
        history = np.empty((long, lanes), dtype=np.int32)
        self._run(grid, begun, history)
        true = self._begins(grid, begun, history[-1])
        wrong = np.flatnonzero(true != begun)
        if len(wrong):
            again = np.empty((long, len(wrong)), dtype=np.int32)
            self._run(np.ascontiguousarray(grid[:, wrong]), true[wrong], again)
            history[:, wrong] = again
        return np.repeat(self.flags, self.width)[history].T.reshape(-1)[:size]

    def _begins(self, grid: np.ndarray, begun: np.ndarray, ended: np.ndarray) -> np.ndarray:
        """The state in which each lane truly begins: where the lane before it ends, from the first on.

        ``begun`` and ``ended`` are a first guess and what came of it. A begin state that was not guessed is run over all
        lanes from there on at once, for a match that fills one lane tends to fill many; so the runs are as many as there
        are different states, whatever the number of lanes.
        """
        lanes = len(begun)
        known: dict[int, np.ndarray] = {}
        for state in np.unique(begun).tolist():
            known[state] = np.where(begun == state, ended, -1)
        true = np.empty(lanes, dtype=np.int32)
        state = self.start * self.width
        for lane in range(lanes):
            true[lane] = state
            ends = known.get(state)
            if ends is None or ends[lane] < 0:
                ends = known.setdefault(state, np.full(lanes, -1))
                rest = np.full(lanes - lane, state, dtype=np.int32)
                for row in grid[:, lane:]:
                    rest = self._flat[rest + row]
                ends[lane:] = rest
            state = int(ends[lane])
        return true

    def _run(self, grid: np.ndarray, state: np.ndarray, history: np.ndarray) -> None:
        flat = self._flat
        for t in range(len(grid)):
            state = np.take(flat, state + grid[t], out=history[t])

    def begin_of(self, rule: int, buffer: bytes, end: int, low: int) -> int:
        """Where the match of ``rule`` that ends at ``end`` begins: the reversed pattern, read backwards to ``low``."""
        graph, start, final = self.back[rule]
        states, at, found = graph.closure({start}), end, end
        while at > low and states:
            key = (rule, states, buffer[at - 1])
            if key not in self._steps:
                self._steps[key] = graph.step(states, buffer[at - 1])
            states = self._steps[key]
            at -= 1
            if final in states:
                found = at
        return found

    def matches(self, texts: list[bytes], lanes: int = 4096) -> list[tuple[int, int, int, int]]:
        """(text, rule, start, end) in bytes for every match of every rule, by text, rule and place."""
        gap = bytes([GAP])
        buffer = gap.join(texts) + gap
        edge = np.cumsum([0] + [len(t) + 1 for t in texts])
        flags = self.scan(buffer, lanes)
        out = []
        for rule in range(len(self.back)):
            on = (flags >> rule) & 1
            ends = np.flatnonzero((on[:-1] == 1) & (on[1:] == 0)) + 1
            rows = np.searchsorted(edge, ends, side="right") - 1
            low = last = -1
            for row, end in zip(rows.tolist(), ends.tolist()):
                base = int(edge[row])
                low = base if row != last else low
                start = self.begin_of(rule, buffer, end, low)
                out.append((row, rule, start - base, end - base))
                low, last = end, row
        return sorted(out)
