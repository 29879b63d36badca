from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from boreline.llm import resample


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features_of(text):
    w = words_of(text)
    return [zlib.crc32(f.encode()) % resample.BUCKETS for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def by_hand(rows, target, percent=25, min_words=20):
    """(key, n_features, weight, score) of every row, and the scores and keys that are drawn, in order."""
    s, t = (Counter(b for x in texts for b in features_of(x)) for texts in ([x for _, x in rows], target))
    n_s, n_t = sum(s.values()) + resample.BUCKETS, sum(t.values()) + resample.BUCKETS
    out, able = [], []
    for key, text in rows:
        f = features_of(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * n_s / ((s[b] + 1) * n_t))) for b in f]
        h = int(sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain) // len(gain) if f else 0
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((key, len(f), weight, score))
        if len(words_of(text)) >= min_words:
            able.append((-score, key is None, key or 0))
    return out, sorted(able)[: percent * len(able) // 100]


def same(rows, got, target, **how):
    want, order = by_hand(rows, target, **how)
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_features, r.weight, r.score)) for r in got)
    placed = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in placed] == list(range(1, len(order) + 1))
    assert [(-r.score, r.doc_id is None, r.doc_id or 0) for r in placed] == order


def test_features_of_odd_and_long_texts():
    features = resample.Features()
    long_word, long_text = "y" * 200, " ".join(f"w{k % 7919} Ünd" for k in range(400_000))
    texts = ["", " .,! ", "a", "A-b É1", f"x {long_word} z {long_word}", "a\x00b\x7fc", "one\n\ttwo  three", long_text, "last one"]
    got = {k: [] for k in range(len(texts))}
    for found, row, _ in features.of(texts):
        for k in np.unique(row):
            got[k].append(found[row == k])
    for k, text in enumerate(texts):
        mine = np.sort(np.concatenate([np.empty(0, np.int64), *got[k]]))
        assert mine.tolist() == sorted(features_of(text)), text[:20]


def test_forgotten_words_do_not_change_features(monkeypatch):
    monkeypatch.setattr(resample, "CACHED_WORDS", 3)
    features = resample.Features()
    for text in ["a b c d e", "f g h a b", "a b x y z q"]:
        assert sorted(np.concatenate([f for f, _, _ in features.of([text])]).tolist()) == sorted(features_of(text))


def test_odd_rows(spark, docs, odd_rows):
    rows = odd_rows + [(None, "t " * 30), (20, "w " * 19), (21, "w " * 20), (22, "red ball " * 20), (22, "red ball " * 20), (None, "t " * 30)]
    target = ["red ball red", None, "", "one two"]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id bigint, text string")
    same(rows, resample.importance_ranks(docs(rows), bench).collect(), target)
    got = resample.importance_ranks(docs(rows), bench, percent=100, min_words=0).collect()
    same(rows, got, target, percent=100, min_words=0)
    assert resample.importance_ranks(docs([]), bench).count() == 0
    got = resample.importance_ranks(docs(rows), bench.where("false")).collect()
    same(rows, got, [])
    kept = resample.resampled(docs(rows), bench, percent=60)
    assert kept.columns == docs(rows).columns and 0 < kept.count() < len(rows)


@pytest.mark.parametrize("accuracy", [2000, 3])
@pytest.mark.parametrize("values", ["id % 7", "0", "id", "case when id < 1500 then 5 else id end"])
def test_the_cutoff_is_exact_on_ties_and_with_a_poor_sketch(spark, values, accuracy):
    df = spark.range(2000).select(F.expr(values).cast("bigint").alias("score"), F.expr("if(id % 3 = 0, null, id div 4)").alias("key"), F.col("id").alias("row"))
    order = sorted(df.collect(), key=lambda r: (-r.score, r.key is None, r.key or 0, r.row))
    for k in (1, 3, 500, 1999, 2000):
        got = df.where(resample.drawn(df, k, 2000, "key", accuracy)).collect()
        assert sorted(r.row for r in got) == sorted(r.row for r in order[:k])
    placed = resample.places(df, *resample._order("key")).orderBy("place").collect()
    assert [r.row for r in placed] == [r.row for r in order] and [r.place for r in placed] == list(range(1, 2001))


def test_only_the_bracket_is_sorted(spark):
    df = spark.range(100_000).select(F.expr("id * 7919 % 100003").alias("score"), F.col("id").alias("key"), F.col("id").alias("row"))
    low, high, above = resample.bracket(df, "score", 25_000, 100_000)
    inside = df.where(F.col("score").between(low, high)).count()
    assert above < 25_000 <= above + inside and inside < 1_000
