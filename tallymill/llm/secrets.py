"""Secret scan with one deterministic automaton for all rules.

The rules' mirrored expressions are compiled together into one minimal automaton.  A single pass
over the bytes of a text, from its end, marks where matches of which rule begin.  From a marked
place the rule's own small automaton runs forwards to the longest match; so only bytes of
matches are read again.  Matches of a rule are taken leftmost first and don't overlap.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymill.llm import automaton
from tallymill.llm.common import map_texts


@dataclass(frozen=True)
class Rule:
    """``value`` behind ``prefix``, kept if the value has ``least`` characters.

    ``begins`` replaces both in the search for beginnings; it may leave out only matches that would
    not be kept and hide no other match.
    """

    kind: str
    prefix: str
    value: str
    least: int
    either_case: bool = False
    begins: str | None = None


# The expressions and least lengths of the base rules.
ASSIGN_PREFIX = "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
BASE_RULES = (
    Rule("assign", ASSIGN_PREFIX, "[A-Za-z0-9+/_.=-]+", 8, either_case=True),
    Rule("access", "", "AKIA[A-Z0-9]+", 16),
    # A run of hexadecimal digits is one match however long; shorter ones need not be marked.
    Rule("hex", "", "[0-9a-f]+", 32, begins="[0-9a-f]{32}"),
)
ADDED_RULES = (
    Rule("pem", "", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
    Rule("hosted", "gh[opsur]_", "[A-Za-z0-9]+", 36),
)
RULES = BASE_RULES + ADDED_RULES


def _linked(table: np.ndarray, masks: np.ndarray) -> list:
    """The start row of the table as linked lists: a row holds the next row by byte, at 256 its mask.

    The mask is -1 where nothing can match any more.
    """
    dead = (masks == 0) & (table == np.arange(len(table))[:, None]).all(axis=1)
    rows: list[list] = [[] for _ in masks]
    for row, after, mask in zip(rows, table.tolist(), np.where(dead, -1, masks).tolist()):
        row += [rows[k] for k in after]
        row.append(mask)
    return rows[0]


class Scanner:
    """All rules, compiled."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        if len(rules) > 8:
            raise ValueError("a mask holds eight rules")
        self.rules, whole, self.single = rules, [], []
        for rule in rules:
            fold = automaton.either_case if rule.either_case else lambda tree: tree
            prefix, value = (fold(automaton.parse(x)) for x in (rule.prefix, rule.value))
            begins = fold(automaton.parse(rule.begins)) if rule.begins else ("cat", [prefix, value])
            whole.append(automaton.backwards(begins))
            self.single.append([automaton.compile_rules([tree], anywhere=False) for tree in (prefix, value)])
        self.combined = automaton.compile_rules(whole, anywhere=True)

    def link(self) -> "Scanner":
        """Unfold the transition arrays; done in each task, as the lists refer to each other."""
        self.start = _linked(*self.combined)
        self.forward = [[_linked(*x) for x in parts] for parts in self.single]
        return self

    def beginnings(self, data: bytes) -> list[list[int]]:
        """For each rule the offsets where a match begins, ascending."""
        masks = bytes(map(itemgetter(256), accumulate(reversed(data), getitem, initial=self.start)))
        found = np.flatnonzero(np.frombuffer(masks, np.uint8))
        marks = np.frombuffer(masks, np.uint8)[found]
        at = len(data) - found
        return [at[(marks >> k & 1) == 1][::-1].tolist() for k in range(len(self.rules))]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, rule's number) in code points, by start and rule."""
        data = text.encode("utf-8")
        found = []
        for k, begins in enumerate(self.beginnings(data)):
            (prefix, value), least, free = self.forward[k], self.rules[k].least, 0
            for start in begins:
                if start < free:
                    continue
                inner = _longest(prefix, data, start)
                free = _longest(value, data, inner)
                if free - inner >= least:
                    found.append((start, free, k))
        found.sort(key=lambda x: (x[0], x[2]))
        if not found or len(data) == len(text):
            return found
        codes = np.frombuffer(data, np.uint8)
        points = np.concatenate([[0], np.cumsum((codes & 0xC0) != 0x80)])
        return [(int(points[a]), int(points[b]), k) for a, b, k in found]


def _longest(row: list, data: bytes, start: int) -> int:
    """The end of the longest match from ``start``, or ``start``."""
    end = start
    for at in range(start, len(data)):
        row = row[data[at]]
        if row[256] < 0:
            break
        if row[256]:
            end = at + 1
    return end


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id``, ``spans``: kind, start, end of every secret of every whole text, by start and rule.

    Ends are exclusive, in code points.  Null and empty texts have no spans; repeated rows are
    scanned each; other columns are not read.  Rules of different kinds may overlap.
    """
    compiled = Scanner(rules)
    kinds = [rule.kind for rule in rules]

    def make():
        scan = compiled.link().spans

        def convert(texts: list[str]) -> list[pa.Array]:
            lists = [scan(t) for t in texts]
            flat = [x for spans in lists for x in spans]
            fields = [pa.array([kinds[x[2]] for x in flat], pa.string())]
            fields += [pa.array([x[k] for x in flat], pa.int64()) for k in (0, 1)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["kind", "start", "end"]))]
        return convert
    return map_texts(docs, make, "spans array<struct<kind:string,start:bigint,end:bigint>>", id_col, text_col)
