from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from boreline.llm import simple8b, tokenids
from boreline.llm.bpe import default_vocabulary
from boreline.session import work_path

NUMBERS = st.one_of(st.integers(0, 3), st.integers(0, 50_256), st.integers(0, 2**32 - 1), st.integers(2**59, 2**64 - 1))


@given(st.lists(st.one_of(NUMBERS, st.just(0)), max_size=400))
@settings(max_examples=150, deadline=None)
def test_simple8b_round_trip(values):
    words, escapes = simple8b.encode(np.array(values, np.uint64))
    assert simple8b.decode(words, escapes, len(values)).tolist() == values
    assert len(escapes) == sum(v >= 2**60 for v in values)


def test_words_hold_as_much_as_a_selector_can():
    for count, bits in simple8b.SELECTORS:
        words, _ = simple8b.encode(np.full(count * 3, (1 << bits) - 1, np.uint64))
        assert len(words) == 3
    with pytest.raises(ValueError):
        simple8b.decode(words, np.empty(0, np.uint64), 4)


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(default_vocabulary())
    out.no_truncation()
    out.no_padding()
    return lambda text: out.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def units():
    with open(default_vocabulary(), encoding="utf-8") as file:
        return tokenids.units_of(file.read())


@given(st.lists(st.sampled_from([*" \n\t\x1c\x85\xa0aé'sZ1.,🙂日<|>", "<|endoftext|>", " the", "  "]), max_size=60).map("".join))
@settings(max_examples=300, deadline=None)
def test_units_are_encoded_like_whole_texts(library, units, text):
    texts = [text, "x" + text, text[::-1]]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in units.of(texts)] == [library(t) for t in texts]


def test_forgotten_units_do_not_change_ids(library, units, monkeypatch):
    monkeypatch.setattr(tokenids, "CACHED_UNITS", 5)
    for k in range(6):
        text = " ".join(f"word{j} the" for j in range(k, k + 6))
        assert np.frombuffer(units.of([text])[0], "<u4").tolist() == library(text)


def test_a_file_is_read_by_range(tmp_path):
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 50_257, n).astype("<u4") for n in (0, 1, 70_000, 3, 200_000, 0, 65_536, 5)]
    writer = tokenids.Writer(f"file://{tmp_path}/x.s8b")
    for k, d in enumerate(docs):
        writer.add(None if k == 3 else -k, d.tobytes())
    path, n, total = writer.close()
    whole = np.concatenate(docs)
    assert (n, total) == (len(docs), len(whole))
    reader = tokenids.Reader(path)
    got = [(k, s, m, np.concatenate([*p, np.empty(0, "<u4")]).tolist()) for k, s, m, p in reader.documents()]
    at = np.cumsum([0, *map(len, docs)])
    assert got == [(None if k == 3 else -k, at[k], len(d), d.tolist()) for k, d in enumerate(docs)]
    for start, stop in [(0, 0), (0, 1), (65_535, 65_537), (70_000, 270_000), (len(whole) - 1, len(whole)), (0, len(whole)), (len(whole), len(whole))]:
        assert reader.ids(start, stop).tolist() == whole[start:stop].tolist()
    with pytest.raises(IndexError):
        reader.ids(0, len(whole) + 1)
    data = bytearray((tmp_path / "x.s8b").read_bytes())
    data[-80] ^= 1
    (tmp_path / "y.s8b").write_bytes(data)
    with pytest.raises(ValueError, match="damaged"):
        tokenids.Reader(f"file://{tmp_path}/y.s8b")


def by_hand(library, rows):
    """Starts by key; rows of one key in any order."""
    start, out = 0, []
    for key, text in rows:
        ids = np.array([*library(text), 2], "<u4")
        out.append((key, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out, start


def test_query_equals_the_library(spark, sf_dir, library):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    want, _ = by_hand(library, rows)
    got = tokenids.op11_tokenids(spark, sf_dir).orderBy("start").collect()
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == want
    assert [r.start for r in got] == np.cumsum([0] + [w[1] for w in want])[:-1].tolist()


def test_odd_rows(spark, docs, odd_rows, library):
    rows = odd_rows + [(None, None), (9, "hot")] + [(9, f"hot {k}") for k in range(40)]
    manifest = tokenids.write_ids(docs(rows), default_vocabulary(), work_path(spark, "ids"))
    out = tokenids.read_ids(manifest, with_ids=True).orderBy("start").collect()
    want, total = by_hand(library, rows)
    assert sorted(((r.key is not None, r.key or 0), r.n_tokens, r.ids_crc32) for r in out) == sorted(((k is not None, k or 0), n, c) for k, n, c in want)
    keys = [r.key for r in out]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert [r.start for r in out] == np.cumsum([0] + [r.n_tokens for r in out])[:-1].tolist()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and r.ids[-1] == 2 for r in out)
    assert manifest.agg(F.sum("ids"), F.sum("docs")).first() == (total, len(rows))


def test_empty_table(spark, docs):
    manifest = tokenids.write_ids(docs([]), default_vocabulary(), work_path(spark, "ids"))
    assert manifest.count() == 0 and tokenids.read_ids(manifest).count() == 0
