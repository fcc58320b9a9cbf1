"""BPE encoding and decoding with forced-boundary splitting.

A byte pair that no vocabulary token contains can never be merged, so a text may be cut there
and its fragments encoded on their own.  Fragments are mostly words, so few are distinct:
each is encoded once in a task and looked up afterwards.

A cut must not change how the pre-tokenizer splits the text either.  Its splits look only to
the right, at white space (``\\s+(?!\\S)``) and at contractions (``'s``), so there is no cut after
white space, before an apostrophe or inside a character.  Special tokens are split off first.
"""

from __future__ import annotations

import json
import re
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame

from tallymill.llm.common import map_texts

# Fragments remembered in a task, and the longest such fragment.
CACHED = 150_000
CACHED_BYTES = 64
# Fragments that the pre-tokenizer surely leaves whole: letters of Latin scripts.
ONE_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+").fullmatch

# White space of one byte in UTF-8, and the last bytes of white space of two and three bytes with their
# first bytes.  Some other characters match as well; a possible cut is then left out.
SPACES = b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
SPACE_ENDS = b"\x80\x81\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8e\x9f\xa0\xa8\xa9\xaf\xbf"
FIRST_OF_TWO, FIRST_OF_THREE = b"\xc2", b"\xe1\xe2\xe3\xef"


def _byte_set(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


ENDS_SPACE, STARTS_TWO, STARTS_THREE = map(_byte_set, (SPACE_ENDS, FIRST_OF_TWO, FIRST_OF_THREE))


def byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable bytes stand for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Known(dict):
    """Ids of the fragments met so far; a new one is encoded when it is asked for."""

    def __init__(self, tokenizer: tokenizers.Tokenizer, byte_level: dict[int, str], ids: list[int]) -> None:
        self.encode, self.merge, self.byte_level, self.ids = tokenizer.encode, tokenizer.model.tokenize, byte_level, ids
        self.long: list[bytes] = []

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        text = piece.decode("utf-8")
        if ONE_WORD(text):  # no need to run the pre-tokenizer
            found = [t.id for t in self.merge(piece.decode("latin-1").translate(self.byte_level))]
        else:
            found = self.encode(text, add_special_tokens=False).ids
        ids = tuple([self.ids[i] for i in found])
        self[piece] = ids
        if len(piece) > CACHED_BYTES:
            self.long.append(piece)
        return ids

    def forget_long(self) -> None:
        for piece in self.long:
            del self[piece]
        self.long.clear()


class Codec:
    """Encoder and decoder of one task, from the text of a tokenizer file."""

    def __init__(self, config: str) -> None:
        parsed = json.loads(config)
        before, specials = parsed["pre_tokenizer"] or {}, parsed["added_tokens"]
        if parsed["model"]["type"] != "BPE" or parsed["normalizer"] or before.get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE file without normalizer is needed")
        if before["add_prefix_space"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in specials):
            raise ValueError("prefix spaces and stripping special tokens are not supported")
        parsed["truncation"] = parsed["padding"] = parsed["post_processor"] = None
        self.tokenizer = tokenizers.Tokenizer.from_str(json.dumps(parsed))
        self.special_ids = {t["content"]: t["id"] for t in specials}
        # The library takes the leftmost special token, of several the longest.
        longest_first = sorted(self.special_ids, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest_first))) if specials else None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        byte = byte_of_char()
        self.token_bytes = [b""] * (1 + max([*vocabulary.values(), *self.special_ids.values()]))
        for token, i in vocabulary.items():
            self.token_bytes[i] = bytes(byte[c] for c in token)
        for token, i in self.special_ids.items():
            self.token_bytes[i] = token.encode()
        self.cut = cuttable(self.token_bytes)
        self.byte_level = {b: c for c, b in byte.items()}
        # One object for each id: fragments share them.
        self.ids = list(range(len(self.token_bytes)))
        self.known = Known(self.tokenizer, self.byte_level, self.ids)

    def fragments(self, data: bytes) -> list[bytes]:
        """The pieces between forced boundaries; joined they are ``data``."""
        if len(data) < 2:
            return [data] if data else []
        codes = np.frombuffer(data, np.uint8)
        pairs = codes[:-1].astype(np.uint16) << 8 | codes[1:]
        left = np.flatnonzero(self.cut[pairs])
        unsure = ENDS_SPACE[codes[left]]
        if unsure.any():  # left is at least 1 there: such a byte is not the first of a character
            spaces = unsure & (STARTS_TWO[codes[left - 1]] | STARTS_THREE[codes[left - 2]] & (left > 1))
            left = left[~spaces]
        ends = (left + 1).tolist()
        ends.append(len(data))
        return [data[a:b] for a, b in zip(chain((0,), ends), ends)]

    def encode(self, text: str) -> list[int]:
        if self.special is None:
            return self._encode_plain(text)
        ids, start = [], 0
        for found in self.special.finditer(text):
            ids += self._encode_plain(text[start:found.start()])
            ids.append(self.special_ids[found.group()])
            start = found.end()
        ids += self._encode_plain(text[start:])
        return ids

    def _encode_plain(self, text: str) -> tuple[int, ...]:
        if len(self.known) > CACHED:
            self.known = Known(self.tokenizer, self.byte_level, self.ids)
        ids = tuple(chain.from_iterable(map(self.known.__getitem__, self.fragments(text.encode("utf-8")))))
        self.known.forget_long()
        return ids

    def decode(self, ids: list[int]) -> str:
        """Bytes of the tokens, read as UTF-8 with the replacement character for what isn't."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def cuttable(token_bytes: list[bytes]) -> np.ndarray:
    """For each pair of bytes (first * 256 + second): is there always a boundary between them?"""
    cut = np.ones((256, 256), bool)
    for token in token_bytes:
        for pair in zip(token, token[1:]):
            cut[pair] = False
    cut[np.frombuffer(SPACES, np.uint8), :] = False
    cut[:, ord("'")] = False
    cut[:, 0x80:0xC0] = False
    return cut.ravel()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _codec(tokenizer_file: str | None):
    """The file is read here, once; its text (1.5 MB, fixed by the file) goes to the tasks."""
    config = Path(tokenizer_file or default_tokenizer()).read_text(encoding="utf-8")

    def make() -> Codec:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return Codec(config)
    return make


def _id_lists(lists: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    values = np.fromiter(chain.from_iterable(lists), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode(docs: DataFrame, tokenizer_file: str | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id``, ``ids`` of every whole text.

    Null and empty texts have an empty list.  Repeated rows are encoded each; other columns are not read.
    """
    codec = _codec(tokenizer_file)

    def make():
        encoder = codec().encode
        return lambda texts: [_id_lists([encoder(t) for t in texts])]
    return map_texts(docs, make, "ids array<int>", id_col, text_col)


def decode(encoded: DataFrame, tokenizer_file: str | None = None, id_col="doc_id", ids_col="ids") -> DataFrame:
    """``doc_id``, ``decoded`` of every list of ids; a null list gives the empty text."""
    from tallymill.llm.common import named

    codec = _codec(tokenizer_file)

    def run(batches):
        decoder = codec().decode
        for batch in batches:
            texts = [decoder(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])
    return encoded.select(named(id_col).alias("doc_id"), named(ids_col).alias("ids")).mapInArrow(
        run, "doc_id long, decoded string")


def encode_and_decode(docs: DataFrame, tokenizer_file: str | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id``, ``ids``, ``decoded`` in one pass over the texts; rows as in :func:`encode`."""
    codec = _codec(tokenizer_file)

    def make():
        both = codec()

        def convert(texts: list[str]) -> list[pa.Array]:
            lists = [both.encode(t) for t in texts]
            return [_id_lists(lists), pa.array([both.decode(ids) for ids in lists], pa.string())]
        return convert
    return map_texts(docs, make, "ids array<int>; decoded string", id_col, text_col)
