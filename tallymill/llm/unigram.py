"""Token counts of a unigram vocabulary by count-only Viterbi.

An Aho-Corasick automaton lists all vocabulary pieces that end at each character; the best score and
its number of pieces are carried along, without a path.  Ties are resolved as the tokenizers library
does: of equal scores the piece that begins first stays, and an unknown character scores ten less
than the worst piece and counts its UTF-8 bytes.

No piece goes on across the beginning of a word or a line end (checked on the vocabulary), so a text
is the sum of its words, and a word met before is looked up.  Scores of the vocabulary file are whole
numbers: sums are exact, and splitting changes no comparison.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymill.llm.common import map_texts

# The sign for a space, and what an unknown character scores below the worst piece.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0

NOTHING = float("-inf")
CACHED = 300_000
CACHED_CHARS = 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores."""

    pieces: dict[str, float]

    def __post_init__(self) -> None:
        if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces):
            raise ValueError("a piece goes on across a word or line end")
        if any(score != int(score) for score in self.pieces.values()):
            raise ValueError("scores must be whole numbers")

    @property
    def unknown_score(self) -> float:
        return min(self.pieces.values()) - UNKNOWN_PENALTY


def read_vocabulary(model_file: str | None = None) -> Vocabulary:
    """The ordinary pieces of a SentencePiece file, without control, byte and unknown pieces."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file or public_tokenizers.path("piece_bpe_32k.model"))
    ordinary = [
        i for i in range(model.vocab_size())
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    return Vocabulary({model.id_to_piece(i): model.get_score(i) for i in ordinary})


class Known(dict):
    """Counts of the words met so far; a new one is counted when it is asked for."""

    def __init__(self, count) -> None:
        self.count, self.long = count, []

    def __missing__(self, unit: str) -> int:
        n = self[unit] = self.count(unit)
        if len(unit) > CACHED_CHARS:
            self.long.append(unit)
        return n

    def forget_long(self) -> None:
        for unit in self.long:
            del self[unit]
        self.long.clear()


class Counter:
    """Counts of one task."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.unknown = vocabulary.unknown_score
        self.single = {p for p in vocabulary.pieces if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.units = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall
        self.known = Known(self.viterbi)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if len(self.known) > CACHED:
            self.known = Known(self.viterbi)
        total = sum(map(self.known.__getitem__, self.units(SPACE + text.replace(" ", SPACE))))
        self.known.forget_long()
        return total

    def viterbi(self, unit: str) -> int:
        """Number of pieces on the best path."""
        size = len(unit)
        score, count = [0.0] + [NOTHING] * size, [0] * (size + 1)
        if self.single.issuperset(unit):
            for end, (length, own) in self.automaton.iter(unit):  # by end, the longest first
                start, end = end + 1 - length, end + 1
                through = score[start] + own
                if through > score[end]:
                    score[end], count[end] = through, count[start] + 1
            return count[size]
        matches = self.automaton.iter(unit)
        end, piece = next(matches, (size, None))
        for at, char in enumerate(unit):
            while end == at:
                length, own = piece
                through = score[at + 1 - length] + own
                if through > score[at + 1]:
                    score[at + 1], count[at + 1] = through, count[at + 1 - length] + 1
                end, piece = next(matches, (size, None))
            if char not in self.single:
                through = score[at] + self.unknown
                if through > score[at + 1]:
                    score[at + 1], count[at + 1] = through, count[at] + len(char.encode("utf-8"))
        return count[size]


def count_tokens(docs: DataFrame, vocabulary: Vocabulary | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id``, ``n_tokens`` of every whole text.

    A text is read as its words with a space before each.  Null and empty texts have 0 tokens;
    repeated rows are counted each; other columns are not read.
    """
    vocabulary = vocabulary or read_vocabulary()

    def make():
        count = Counter(vocabulary).count
        return lambda texts: [pa.array([count(t) for t in texts], pa.int64())]
    return map_texts(docs, make, "n_tokens long", id_col, text_col)
