from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from boreline.llm import toxicity

TERMS = [("moron", False), ("idiot", False), ("scum", False), ("lowei", True), ("clown", False), ("vequ", True)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def by_hand(word):
    out = {}
    for k, (term, stem) in enumerate(TERMS):
        least = min((distance(term, word[:n]) for n in range(len(word))), default=9) if stem else distance(term, word)
        if least == 0 or least == 1 and len(term) >= toxicity.FUZZY_LETTERS:
            out[k] = least
    return out


@settings(max_examples=500, deadline=None)
@given(st.sampled_from([t for t, _ in TERMS]), st.lists(st.tuples(st.integers(0, 9), st.sampled_from(["", "a", "o", "xx"])), max_size=2), st.sampled_from(["", "s", "abc"]))
def test_automaton_is_the_distance(term, edits, tail):
    word = term
    for at, put in edits:
        word = word[:at] + put + word[at + 1 :]
    trie, word = toxicity.Trie(TERMS), word + tail
    assert dict(trie.hits(word)) == by_hand(word)
    assert not by_hand(word) or trie.possible(word)


def test_quotation_is_told_from_abuse():
    finder = toxicity.Finder(toxicity.Trie(TERMS))
    assert finder.read("you are a moron and an idiott")[1] == [(0, 0, False), (1, 1, False)]
    assert finder.read('he wrote "moron" in it')[1] == [(0, 0, True)]
    assert finder.read("the word idiot has five letters")[1] == [(1, 0, True)]
    model = toxicity.Model(TERMS, [[6.0] * 3] * 6, [3.0] * 6, toxicity.PRIOR.tolist())
    plain, quoted, wrong, none = (model.score(*finder.read(t)) for t in ("you are a moron", 'he said "moron" to her', "you are a morron", "you are a man"))
    assert plain > wrong > quoted > none


def test_learns_words_and_stems(spark, docs):
    rng = random.Random(4)
    syllables = "an er on th re ing ou ti sh le".split()

    def word():
        return "".join(rng.choices(syllables, k=rng.randint(1, 4)))

    rows, labels = [], []
    for k in range(600):
        words = [word() for _ in range(rng.randint(20, 120))]
        bad = k % 6 == 0
        if bad:
            for _ in range(max(3, len(words) // 40)):
                words[rng.randrange(len(words))] = rng.choice(["moron", "idiot", "zarf" + word()])
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    labels = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id bigint, toxic int")
    df = docs(rows)
    model = toxicity.fit(df, labels)
    assert {"moron", "idiot"} <= {t for t, stem in model.terms if not stem} and ("zarf", True) in model.terms
    scores = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert sum((s >= 0.5) == (k % 6 == 0) for k, s in scores.items()) >= 590
    clean = rows[1][1]
    more = {r.doc_id: r.score for r in toxicity.score(docs([(1, clean + " morron morron morron"), (2, clean)]), model).collect()}
    assert more[1] > more[2]


def test_held_out_accuracy(spark):
    rows = toxicity.op3_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    toxic = [r for r in rows if r.toxic]
    clean = [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in toxic) / len(toxic) >= 0.88
    assert sum(r.predicted for r in clean) / len(clean) <= 0.01


def test_labels_of_the_fold_are_never_read(spark, docs):
    """Turning every held-out label round changes no score."""
    rows = [(k, "you moron idiot moron" if k % 3 == 0 else f"kind words {k}") for k in range(200)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in rows], "doc_id bigint, toxic int")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    got = [sorted(map(tuple, toxicity.score(docs(rows), toxicity.fit(docs(rows), known)).collect())) for known in (labels, turned)]
    assert got[0] == got[1]


def test_odd_rows(spark, docs, odd_rows):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(docs(odd_rows), none)
    assert model.terms == []
    got = toxicity.score(docs(odd_rows), model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score < 0.5 for r in got)
    assert toxicity.score(docs([]), model).count() == 0
    assert toxicity.fit(docs([]), none).terms == []


@pytest.mark.parametrize(("times", "words", "level"), [(0, 10, 0), (1, 1, 0), (2, 100, 2), (2, 400, 1), (2, 1000, 0), (100, 10_000, 2)])
def test_levels(times, words, level):
    assert toxicity.level_of(times, words) == level


def test_term_counts_are_right_and_small(spark):
    """400,000 terms are held in a worker: those took some 100 MB as tuples and lists."""
    rows = [("Moron morons moron", 1), ("moron", 1), ("moronic", 0), ("", 0), ("xy é", 1)]
    got = {(r.term, r.stem): tuple(r)[2:] for r in toxicity._term_counts(spark.createDataFrame(rows, "text string, label int")).collect()}
    want = {}
    for text, label in rows:
        words = toxicity.WORDS.findall(text.lower())
        uses = Counter((w, False) for w in words if len(w) >= toxicity.STEM[0]) + Counter((w[:k], True) for w in words for k in toxicity.STEM if len(w) > k)
        for term, times in uses.items():
            for k in range(toxicity.level_of(times, len(words)) + 1):
                want.setdefault(term, [0] * 6)[3 * label + k] += 1
    assert got == {t: tuple(c) for t, c in want.items()} and got["moron", False] == (0, 0, 0, 2, 1, 1)

    assert list(toxicity.TermCounts(6).batches(list("abcdef"))) == []
    tracemalloc.start()
    counts = toxicity.TermCounts(6)
    for k in range(100_000):
        counts.add(f"term{k}", k % 2 == 0, 3, 1)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 22e6
    table = pa.Table.from_batches(counts.batches(list("abcdef"), 30_000))
    assert table.num_rows == len(counts) == 100_000
    assert [sum(table[c].to_pylist()) for c in "abcdef"] == [0, 0, 0, 100_000, 100_000, 0]
