"""Operators that treat each text on its own, against the libraries or plain Python."""

import random
import re

import pytest
import tokenizers
from pyspark.sql import functions as F

from llm_fixtures import make_docs  # noqa: F401
from tallymill.llm import automaton, byte_bpe, secrets, unigram

PIECES = [
    "a", "b", "s", "'", "'s", "'ll", " ", "  ", "\n", "\t", " ", "é", "à", "ß", "中", "\U0001f642", "1", "23", "!", "<|endoftext|>",
    "　", "​", "\x1c", "\u0085", "re", "’", " ", "Ａ", "﻿", "́", "oiré ",
]


def random_texts(pieces, n, longest, seed=3):
    rand = random.Random(seed)
    return ["".join(rand.choice(pieces) for _ in range(rand.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(byte_bpe.default_tokenizer())


def test_bpe_equals_library(spark, make_docs, library):
    texts = [*random_texts(PIECES, 3000, 14), "", "word " * 5000, "é" * 20000, "a" * 30000, None]
    docs = make_docs([(i, t) for i, t in enumerate(texts)]).withColumn("ids", F.lit("clash"))
    got = {r["doc_id"]: r for r in byte_bpe.encode_and_decode(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert got[i]["ids"] == want, repr(text)[:80]
        assert got[i]["decoded"] == library.decode(want, skip_special_tokens=False) == (text or "")


def test_bpe_round_trip_and_repeats(spark, make_docs):
    docs = make_docs([(1, "same"), (1, "same"), (None, "x y"), (2, None)])
    coded = byte_bpe.encode(docs)
    assert sorted((r["doc_id"], r["decoded"]) for r in byte_bpe.decode(coded).where("doc_id is not null").collect()) == [(1, "same"), (1, "same"), (2, "")]
    assert byte_bpe.encode(docs.limit(0)).isEmpty()


def brute_secrets(text):
    assign = re.compile("(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
    found = [(m.start(), m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda x: (x[0], ["assign", "access", "hex"].index(x[2])))


SECRET_PIECES = [
    "token", "TOKEN", "=", ":", " ", "  ", '"', "'", "secret", "api", "_", "key", "AKIA", "AKIAABCDEF123456", "0123456789abcdef",
    "abcdef", "Z", "é", "\U0001f642", "passwd", "ſ", "K", "\n", "password",
]


def test_secrets_equal_brute_force(spark, make_docs):
    texts = [*random_texts(SECRET_PIECES, 4000, 16), "", None, "token=token:abcdefghij", "f" * 50000, "x" * 50000 + " AKIA" + "A" * 12]
    docs = make_docs(list(enumerate(texts))).withColumn("spans", F.lit(1))
    got = {r["doc_id"]: [(s["start"], s["end"], s["kind"]) for s in r["spans"]] for r in secrets.find_secrets(docs).collect()}
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[2] in ("assign", "access", "hex")] == brute_secrets(text or ""), repr(text)[:90]


def test_added_rules():
    scanner = secrets.Scanner().link()
    assert scanner.spans("é-----BEGIN RSA PRIVATE KEY-----") == [(1, 32, 3)]
    assert scanner.spans("ghp_" + "a1" * 18) == [(0, 40, 4), (4, 40, 2)]  # the base rule's span stays
    assert scanner.spans("ghp_" + "z1" * 18) == [(0, 40, 4)]


@pytest.mark.parametrize("pattern", ["a(b|cd)*e?", "[a-c]{2,3}d", "(ab){2,}", "x?y+z*", "a{0,2}b"])
def test_automaton_equals_re(pattern):
    table, masks = automaton.compile_rules([automaton.parse(pattern)], anywhere=False)
    for text in random_texts(list("abcdexyz"), 1500, 7):
        state = 0
        for byte in text.encode():
            state = table[state, byte]
        assert bool(masks[state]) == bool(re.fullmatch(pattern, text)), text


def test_unsupported_patterns_are_refused():
    for pattern in ("a.b", "[^a]", "(a", "a)", "\\d"):
        with pytest.raises(ValueError):
            automaton.parse(pattern)


def test_unigram_equals_library(spark, make_docs):
    vocabulary = unigram.read_vocabulary()
    low = vocabulary.unknown_score + 10
    rows = [("<unk>", low), *((f"<0x{b:02X}>", low) for b in range(256)), *vocabulary.pieces.items()]
    library = tokenizers.Tokenizer(tokenizers.models.Unigram(rows, unk_id=0, byte_fallback=True))
    library.normalizer = tokenizers.normalizers.Sequence([tokenizers.normalizers.Prepend("▁"), tokenizers.normalizers.Replace(" ", "▁")])
    pieces = ["a", "b", "th", "the", " ", "  ", "    ", "\n", "ing", "中", "\U0001f642", "é", "1", "2023", "q", "Ж", "ла", "\t", "▁", "aaaa"]
    texts = [*random_texts(pieces, 2000, 14), "", "the " * 5000, "aa" * 5000, None]
    got = {r["doc_id"]: r["n_tokens"] for r in unigram.count_tokens(make_docs(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert got[i] == len(library.encode(text or "").ids), repr(text)[:90]


def test_unigram_vocabulary_is_checked():
    with pytest.raises(ValueError):
        unigram.Vocabulary({"a▁b": -1.0})
    with pytest.raises(ValueError):
        unigram.Vocabulary({"a": -1.5})


def test_remembered_fragments_share_their_ids():
    codec = byte_bpe._codec(None)()
    codec.encode("several thousand words, several hundred more words; 12 words")
    found = [i for ids in codec.known.values() for i in ids]
    assert any(i > 256 for i in found) and all(i is codec.ids[i] for i in found)
