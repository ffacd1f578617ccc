"""Probabilistic automata learned from example strings by state merging."""

from __future__ import annotations

import math
from collections import deque

import numpy as np

#: Probability left for symbols that a state has not seen, together.
UNSEEN = 1e-3
#: How far below its weakest hundredth of examples a format still accepts a string, in log probability per symbol.
SLACK = 0.3


class _State:
    __slots__ = ("count", "final", "steps", "taken")

    def __init__(self):
        self.count = 0
        self.final = 0
        self.steps: dict[int, _State] = {}
        self.taken: dict[int, int] = {}


def prefix_tree(strings: list[bytes]) -> _State:
    root = _State()
    for s in strings:
        node = root
        node.count += 1
        for c in s:
            node.taken[c] = node.taken.get(c, 0) + 1
            after = node.steps.get(c)
            if after is None:
                after = node.steps[c] = _State()
            after.count += 1
            node = after
        node.final += 1
    return root


def _alike(x: int, n: int, y: int, m: int, alpha: float) -> bool:
    """Whether the shares x / n and y / m can be one probability (Hoeffding's bound)."""
    if n == 0 or m == 0:
        return True
    bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
    return abs(x / n - y / m) < bound


def _compatible(a: _State, b: _State, alpha: float) -> bool:
    """Ends, next symbols and all that follows are alike."""
    todo = [(a, b)]
    seen = set()
    while todo:
        a, b = todo.pop()
        if a is b or (id(a), id(b)) in seen:
            continue
        seen.add((id(a), id(b)))
        if not _alike(a.final, a.count, b.final, b.count, alpha):
            return False
        for c in a.taken.keys() | b.taken.keys():
            if not _alike(a.taken.get(c, 0), a.count, b.taken.get(c, 0), b.count, alpha):
                return False
            if c in a.steps and c in b.steps:
                todo.append((a.steps[c], b.steps[c]))
    return True


def _fold(into: _State, tree: _State) -> None:
    """Add a tree's counts to a state and to those that follow it."""
    todo = [(into, tree)]
    while todo:
        into, tree = todo.pop()
        into.count += tree.count
        into.final += tree.final
        for c, k in tree.taken.items():
            into.taken[c] = into.taken.get(c, 0) + k
            if c in into.steps:
                todo.append((into.steps[c], tree.steps[c]))
            else:
                into.steps[c] = tree.steps[c]


def merge_states(root: _State, alpha: float = 0.05) -> list[_State]:
    """Merge the tree's states, nearest to the root first, each with the first compatible state already kept."""
    kept = [root]
    known = {id(root)}
    queue = deque((root, c) for c in sorted(root.steps))
    while queue:
        source, c = queue.popleft()
        state = source.steps[c]
        if id(state) in known:
            continue
        match = next((k for k in kept if _compatible(k, state, alpha)), None)
        if match is None:
            kept.append(state)
            known.add(id(state))
            queue.extend((state, d) for d in sorted(state.steps))
        else:
            source.steps[c] = match
            before = set(match.steps)
            _fold(match, state)
            queue.extend((match, d) for d in sorted(set(match.steps) - before))
            # Folding may hang new trees under kept states further on.
            for k in kept:
                queue.extend((k, d) for d in sorted(k.steps) if id(k.steps[d]) not in known and (k, d) not in queue)
    return kept


class Automaton:
    """Transition tables of a learned automaton, for scoring many strings at once."""

    def __init__(self, strings: list[bytes], alpha: float = 0.05):
        states = merge_states(prefix_tree(strings), alpha)
        number = {id(s): k for k, s in enumerate(states)}
        self.next = np.repeat(np.arange(len(states))[:, None], 256, axis=1)
        self.log_p = np.full((len(states), 256), math.log(UNSEEN / 256))
        self.log_end = np.zeros(len(states))
        for k, s in enumerate(states):
            total = s.count + 1
            for c, n in s.taken.items():
                self.log_p[k, c] = math.log((1 - UNSEEN) * n / total)
                self.next[k, c] = number[id(s.steps[c])]
            self.log_end[k] = math.log((s.final + 0.5) / total)
        own = self.score([*strings])
        #: What a string of this format reaches: strings shorter than the examples score a little less.
        self.typical = float(np.quantile(own, 0.01)) - SLACK if len(own) else 0.0

    def score(self, strings: list[bytes]) -> np.ndarray:
        """Mean log probability per symbol of each string, its end included."""
        raw = np.frombuffer(b"".join(strings), np.uint8)
        length = np.array([len(s) for s in strings], np.int64)
        return self.score_spans(raw, np.cumsum(length) - length, length)

    def score_spans(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        state = np.zeros(len(start), np.int64)
        total = np.zeros(len(start))
        running = np.searchsorted(-length, -np.arange(int(length.max(initial=0))))
        for k, n in enumerate(running.tolist()):
            c = raw[start[:n] + k]
            total[:n] += self.log_p[state[:n], c]
            state[:n] = self.next[state[:n], c]
        total += self.log_end[state]
        out = np.empty(len(total))
        out[order] = total / (length + 1)
        return out
