"""Byte automata from a subset of regular expressions: parsing, subset construction, minimisation.

Understood: literal ASCII, escapes ``\\xHH`` and of punctuation, classes without negation, groups,
alternation, ``?``, ``*``, ``+``, ``{m}``, ``{m,}`` and ``{m,n}``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def parse(pattern: str) -> tuple:
    """The syntax tree: ("set", bytes), ("cat", nodes), ("alt", nodes) or ("rep", node, least, most)."""
    node, rest = _alternatives(pattern)
    if rest:
        raise ValueError(f"unbalanced {rest!r} in {pattern!r}")
    return node


def _alternatives(text: str) -> tuple[tuple, str]:
    node, text = _sequence(text)
    branches = [node]
    while text[:1] == "|":
        node, text = _sequence(text[1:])
        branches.append(node)
    return (branches[0] if len(branches) == 1 else ("alt", branches)), text


def _sequence(text: str) -> tuple[tuple, str]:
    nodes = []
    while text and text[0] not in "|)":
        node, text = _atom(text)
        while text and text[0] in "?*+{":
            bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(text[0])
            if bounds:
                text = text[1:]
            else:
                inside, _, text = text[1:].partition("}")
                least, comma, most = inside.partition(",")
                bounds = int(least), (int(most) if most else None) if comma else int(least)
            node = ("rep", node, *bounds)
        nodes.append(node)
    return ("cat", nodes), text


def _atom(text: str) -> tuple[tuple, str]:
    if text[0] == "(":
        node, rest = _alternatives(text[1:])
        if rest[:1] != ")":
            raise ValueError("a group is not closed")
        return node, rest[1:]
    if text[0] == "[":
        return _class(text[1:])
    if text[0] in ".^$":
        raise ValueError(f"{text[0]} is not supported; escape it if it is meant literally")
    code, rest = _byte(text)
    return ("set", frozenset([code])), rest


def _class(text: str) -> tuple[tuple, str]:
    if text[:1] == "^":
        raise ValueError("negated classes are not supported")
    members: set[int] = set()
    while text and text[0] != "]":
        first, text = _byte(text)
        last = first
        if text[:1] == "-" and text[1:2] not in ("]", ""):
            last, text = _byte(text[1:])
        members.update(range(first, last + 1))
    if not text:
        raise ValueError("a class is not closed")
    return ("set", frozenset(members)), text[1:]


def _byte(text: str) -> tuple[int, str]:
    if text[0] != "\\":
        if ord(text[0]) > 127:
            raise ValueError("only ASCII is supported")
        return ord(text[0]), text[1:]
    if text[1] == "x":
        return int(text[2:4], 16), text[4:]
    if text[1].isalnum():
        raise ValueError(f"escape \\{text[1]} is not supported")
    return ord(text[1]), text[2:]


def backwards(node: tuple) -> tuple:
    """The tree of the mirrored language."""
    kind = node[0]
    if kind == "cat":
        return "cat", [backwards(x) for x in reversed(node[1])]
    if kind == "alt":
        return "alt", [backwards(x) for x in node[1]]
    return (kind, backwards(node[1]), *node[2:]) if kind == "rep" else node


def either_case(node: tuple) -> tuple:
    """The tree that takes ASCII letters in either case."""
    kind = node[0]
    if kind == "set":
        letters = [chr(b) for b in node[1] if chr(b).isalpha()]
        return "set", node[1] | {ord(f(c)) for c in letters for f in (str.lower, str.upper)}
    if kind == "rep":
        return (kind, either_case(node[1]), *node[2:])
    return kind, [either_case(x) for x in node[1]]


class _Nfa:
    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, node: tuple, start: int) -> int:
        """Add the states of a tree behind ``start``; the state where it ends."""
        if node[0] == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if node[0] == "cat":
            for part in node[1]:
                start = self.add(part, start)
            return start
        if node[0] == "alt":
            end = self.state()
            for part in node[1]:
                branch = self.state()
                self.free[start].append(branch)
                self.free[self.add(part, branch)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop, end = self.state(), self.state()
            self.free[start] += [loop, end]
            self.free[self.add(part, loop)] += [loop, end]
            return end
        end = self.state()
        for _ in range(most - least):
            self.free[start].append(end)
            start = self.add(part, start)
        self.free[start].append(end)
        return end

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for after in self.free[todo.pop()]:
                if after not in seen:
                    seen.add(after)
                    todo.append(after)
        return frozenset(seen)


def compile_rules(trees: Sequence[tuple], anywhere: bool) -> tuple[np.ndarray, np.ndarray]:
    """One deterministic, minimal automaton of all trees.

    Returns the transition array (state, byte) and for each state the bit mask of the trees that
    end there; state 0 is the start.  With ``anywhere`` a match may begin at every byte.
    """
    nfa = _Nfa()
    start = nfa.state()
    ends = {nfa.add(tree, start): 1 << k for k, tree in enumerate(trees)}
    if anywhere:
        nfa.moves[start].append((frozenset(range(256)), start))
    sets = {members for moves in nfa.moves for members, _ in moves}
    kinds: dict[tuple, list[int]] = {}
    for byte in range(256):
        kinds.setdefault(tuple(byte in members for members in sets), []).append(byte)
    classes = list(kinds.values())
    first = nfa.closure({start})
    number, todo, rows = {first: 0}, [first], []
    for state in todo:
        moves = [move for s in state for move in nfa.moves[s]]
        row = []
        for members in classes:
            after = nfa.closure({to for allowed, to in moves if members[0] in allowed})
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append(number[after])
        rows.append(row)
    moves = np.array(rows)
    masks = np.array([sum(ends.get(s, 0) for s in state) for state in todo])
    moves, masks = _minimal(moves, masks)
    table = np.empty((len(moves), 256), np.int32)
    for k, members in enumerate(classes):
        table[:, members] = moves[:, [k]]
    return table, masks


def _minimal(moves: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input tells apart, by refining the partition until it is stable."""
    _, part = np.unique(masks, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([part, part[moves]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == part.max():
            break
        part = finer
    _, at = np.unique(part, return_index=True)
    order = np.argsort(at)  # in order of discovery, so that the start is state 0
    name = np.empty_like(order)
    name[order] = np.arange(len(order))
    return name[part[moves[at[order]]]], masks[at[order]]
