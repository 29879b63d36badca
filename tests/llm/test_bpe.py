from __future__ import annotations

import hashlib
import random
from array import array

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from boreline.llm import bpe

PARTS = ["a", "b", " ", "  ", "\n", "\t", "'re", "'", "1", "é", "漢", "🙂", "<|endoftext|>", "<|endof", "text|>", "!!", " ", "the", " don't", "\r\n", "　", "²", "ǅ", "\x00"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(open(bpe.default_vocabulary()).read())


@pytest.fixture(scope="module")
def units(vocabulary):
    return bpe.Units(bpe.Pieces(vocabulary))


def encoded(vocabulary, units, text, step):
    encoder, out = bpe.Encoder(vocabulary, units), array("I")
    for k in range(0, len(text), step):
        out.extend(encoder.feed(text[k : k + step]))
        assert len(encoder.tail) <= bpe.CHUNK + step + 64
    out.extend(encoder.finish())
    return out.tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40), st.sampled_from([1, 7, 1000]))
def test_is_the_library(library, vocabulary, units, parts, step):
    text = "".join(parts)
    want = library.encode(text, add_special_tokens=False).ids
    assert encoded(vocabulary, units, text, step) == want
    decoder = bpe.Decoder(vocabulary)
    assert "".join(decoder.feed([i]) for i in want) + decoder.finish() == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 150_000, " " * 140_000 + "x", "\n" * 140_000, "!" * 140_000 + "<|endoftext|>!!", "x" + " " * 131_072 + "\n", "1" * 70_000 + "a"])
def test_runs_without_end_are_streamed(library, vocabulary, units, text):
    assert encoded(vocabulary, units, text, 5000) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=30))
def test_decodes_any_ids(library, vocabulary, ids):
    decoder = bpe.Decoder(vocabulary)
    assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


class Small:
    """A random merge list over three letters."""

    def __init__(self, seed):
        rng = random.Random(seed)
        self.id_of_byte = [-1] * 256
        self.bytes_of = {}
        for k, c in enumerate(b"abc"):
            self.id_of_byte[c], self.bytes_of[k] = k, bytes([c])
        self.merges = {}
        while len(self.merges) < 12:
            pair = rng.choice(list(self.bytes_of)), rng.choice(list(self.bytes_of))
            made = self.bytes_of[pair[0]] + self.bytes_of[pair[1]]
            if made not in self.bytes_of.values():
                self.bytes_of[len(self.bytes_of)] = made
                self.merges[pair] = (len(self.merges), len(self.bytes_of) - 1)
        self.ranks = {pair: rank for pair, (rank, _) in self.merges.items()}
        self.made = [made for _, made in self.merges.values()]


@pytest.mark.parametrize("seed", range(40))
def test_lookahead_is_enough(seed):
    """Tokens that end that far before the end stay, whatever follows."""
    small, rng = Small(seed), random.Random(seed)
    least = bpe.lookahead(small)
    for _ in range(200):
        text = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 60)))
        more = text + bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 30)))
        ends = []
        for t in (text, more):
            done, out = 0, []
            for i in bpe.merge(small, t):
                done += len(small.bytes_of[i])
                if done <= len(text) - least:
                    out.append((done, i))
            ends.append(out)
        assert ends[0] == ends[1]


def test_table(spark, docs, odd_rows, library):
    rows = bpe.encode_decode(docs(odd_rows), bpe.default_vocabulary(), keep_ids=True).collect()
    want = []
    for key, text in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((key, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), ids))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert bpe.encode_decode(docs([]), bpe.default_vocabulary()).count() == 0


def test_refuses_other_tokenizers(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.Vocabulary(open(public_tokenizers.path("word_bpe_49k.json")).read())
